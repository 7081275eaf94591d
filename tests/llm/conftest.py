import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score int, component_id string, class string"


def words(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Texts of every awkward kind: empty, blank, very long, copies, near copies, shared passages, other scripts."""
    draw = random.Random(5)
    base, passage = words(draw, 120), words(draw, 90)
    near = base.split()
    near[60] = "other"
    rows = [
        (0, None), (1, ""), (2, " \t\n "), (3, "one two"), (4, "One TWO"), (5, base), (6, base), (7, " ".join(near)),
        (8, words(draw, 30) + " " + passage + "\n" + words(draw, 30)), (9, passage + " " + words(draw, 200)),
        (10, words(draw, 6000)), (11, "añb ñandú 你好 \U0001f600 é don't  3.14!!\n\n end"), (12, "ha " * 400),
        (13, "x" * 3000), (14, words(draw, 80) + " mail a.b@example.com or +1 (269) 555-3296 4524132264652876 now"),
        (15, "10.0.0.1 and 10.0.0.256, 4524 1322 6465 2876"), (16, "same line here\n" * 8 + words(draw, 60)),
        (16, "same line here\n" * 8 + words(draw, 60)), (17, "w1\x1cw2 w3 \x0b w4 <|endoftext|> <|ENDOFTEXT|>"),
    ]
    rows += [(None, base), (None, "no id here"), (5, base), (-3, passage)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        full = [(i, t, "en", None if i is None else f"s{i % 2}", len(t or ""), "x", 1, "y", "z") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def docs(frame, rows):
    return frame(rows).repartition(3).cache()
