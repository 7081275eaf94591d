import gzip
import os

from ledgermill.session import local_frame
from ledgermill.sources.logs import log_tail, parse_lines, read_lines


def write(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_lines_inherit_across_blocks(spark, conf, tmp_path):
    """Files far larger than a block: a traceback that spans blocks still belongs to its event."""
    lines = ["  orphan"]
    for n in range(400):
        lines.append(f"2024-01-02 03:04:{n % 60:02d},{n:03d} [{'ERROR' if n % 7 == 0 else 'INFO'}] etl.sync: event {n}")
        lines += [f"    trace {n}.{k}" for k in range(60 if n % 50 == 0 else n % 3)]
    write(tmp_path, "sync.log", lines)
    write(tmp_path, "sync.log.1", ["    no event yet", "2024-01-01 00:00:00,001 [INFO] etl: a [b]: c"])
    conf(files__maxPartitionBytes="2kb", files__openCostInBytes="0")
    read = read_lines(spark, str(tmp_path))
    assert read.select("block").distinct().count() > 5
    rows = parse_lines(read).orderBy("file", "line_no").collect()
    first = [r for r in rows if r.file.endswith("sync.log")]
    assert [r.line_no for r in first] == list(range(1, len(lines) + 1))
    event = None
    for row, line in zip(first, lines):
        if "event" in line:
            event = line
            assert row.message == line.split(": ")[1]
        else:
            assert row.message == line
        if event is None:
            assert (row.logged_at, row.level, row.logger) == (None, None, None)
        else:
            assert row.logged_at.strftime("%Y-%m-%d %H:%M:%S,%f")[:-3] == event[:23]
            assert row.level == event.split("[")[1].split("]")[0] and row.logger == "etl.sync"
    second = [r for r in rows if r.file.endswith("sync.log.1")]
    assert [(r.level, r.message) for r in second] == [(None, "    no event yet"), ("INFO", "a [b]: c")]


def test_tail(spark, conf, tmp_path):
    lines = [f"line {n}" for n in range(2_000)]
    write(tmp_path, "sync.log", lines)
    conf(files__maxPartitionBytes="1kb", files__openCostInBytes="0")
    assert [r.line for r in log_tail(read_lines(spark, str(tmp_path))).collect()] == lines[-500:]
    assert [r.line for r in log_tail(read_lines(spark, str(tmp_path)), 3).collect()] == lines[-3:]


def test_the_tail_of_rotated_files_is_that_of_the_newest(spark, tmp_path):
    write(tmp_path, "sync.log.1", [f"old {n}" for n in range(20)])
    write(tmp_path, "sync.log", [f"new {n}" for n in range(20)])
    os.utime(tmp_path / "sync.log.1", (1_600_000_000, 1_600_000_000))
    os.utime(tmp_path / "sync.log", (1_700_000_000, 1_700_000_000))
    lines = [r.line for r in log_tail(read_lines(spark, str(tmp_path)), 25).collect()]
    assert lines == [f"old {n}" for n in range(15, 20)] + [f"new {n}" for n in range(20)]


def test_a_file_without_events(spark):
    lines = local_frame(spark, [("f", 0, 0, "x"), ("f", 0, 1, "y")], "file string, block bigint, seq bigint, line string")
    assert {(r.line_no, r.message, r.level) for r in parse_lines(lines).collect()} == {(1, "x", None), (2, "y", None)}


def test_a_compressed_file_is_parsed_in_chunks(spark, tmp_path):
    lines = ["  orphan"] + [
        f"2024-01-02 03:04:05,{n:03d} [INFO] etl: event {n}" if n % 40 == 0 else f"  trace {n}" for n in range(1, 500)
    ]
    with gzip.open(tmp_path / "sync.log.gz", "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    read = read_lines(spark, str(tmp_path))
    assert read.select("block").distinct().count() == 1
    whole, cut = (parse_lines(read, n).orderBy("line_no").collect() for n in (1000, 7))
    assert whole == cut and [r.line_no for r in cut] == list(range(1, 501))
    carried = None
    for row, line in zip(cut, lines):
        carried = int(line.split(",")[1][:3]) * 1000 if "event" in line else carried
        assert (row.logged_at and row.logged_at.microsecond) == carried
    plan = parse_lines(read)._jdf.queryExecution().optimizedPlan().toString()
    assert "chunk" in plan.split("windowspecdefinition(")[1]
