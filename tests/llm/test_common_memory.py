"""What a Python worker holds after a task."""

import gc
import weakref

import public_tokenizers
import pyarrow as pa

from ledgermill.llm import common
from ledgermill.llm.byte_bpe import ByteBpe
from ledgermill.llm.queries import BYTE_RANKS
from ledgermill.llm.toxicity import Scorer


def freed(thing) -> bool:
    """Whether the only reference to ``thing`` was the caller's list."""
    seen = weakref.ref(thing.pop())
    return seen() is None


def test_encoders_and_scorers_go_without_the_garbage_collector():
    gc.disable()
    try:
        bpe, scorer = [ByteBpe(BYTE_RANKS, public_tokenizers.PATTERN)], [Scorer(0.0, {1: 1.0})]
        assert len(bpe[0].encode("two words")[0]) and len(bpe[0].pieces) == 2
        assert 0 <= scorer[0].score("two words") <= 1 and len(scorer[0].known) == 2
        assert freed(bpe) and freed(scorer)
    finally:
        gc.enable()


def test_word_hashes_go_with_the_task():
    def run(rows):
        for batch in rows:
            common.word_hashes(b"some words here")
            yield batch

    batch = pa.RecordBatch.from_pydict({"x": [1]})
    common.WORD_HASHES.clear()
    rows = common.released(run)([batch, batch])
    assert next(rows).equals(batch) and len(common.WORD_HASHES) == 3
    assert len(list(rows)) == 1 and not common.WORD_HASHES
    assert list(common.released(run)([])) == []


def test_workers_forget_between_tasks(spark):
    """Two tasks in one reused worker: the second begins without what the first remembered."""

    def run(rows):
        before = len(common.WORD_HASHES)
        for batch in rows:
            common.word_hashes(b"some words here")
        yield pa.RecordBatch.from_pydict({"before": [before], "after": [len(common.WORD_HASHES)]})

    found = spark.range(0, 64, 1, 64).mapInArrow(common.released(run), "before long, after long").collect()
    assert {(r.before, r.after) for r in found} == {(0, 3)}
