"""The pipeline on a small folder of tables, against its stages done plainly."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ledgermill.llm import byte_bpe, pii, toxicity
from ledgermill.llm.queries import BYTE_RANKS
from tests.llm.test_copies import plain_groups
from tests.llm.test_rules import contained, labelled


@pytest.fixture(scope="module")
def folder(spark, frame, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    draw = random.Random(20)
    marked = labelled(draw, 300)
    texts = [(i, t) for i, t in rows] + [(1000 + k, t) for k, t, _ in marked]
    item = " ".join(f"b{k}" for k in range(30))
    texts += [(2000, "before " + item + " after"), (2001, "call +12 345 678 901 or x@y.org now " + "z " * 5)]
    frame(texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(1000 + k, 1, y) for k, _, y in marked], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, item


def test_run(spark, folder):
    path, texts, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    left = [(i, t) for i, t in texts if model.score(t or "") < 0.5]
    assert len(left) < len(texts)
    stay = {(i, n) for i, n, c in plain_groups(left) if not n or i == c}
    left = [(i, t) for i, t in left if i is None or i in {i for i, _ in stay}]
    dirty = {d for d, *_ in contained(left, [(1, item)])}
    left = [(i, t) for i, t in left if i not in dirty]
    assert dirty == {2000}
    schema = "doc_id long, text string"
    tagger = pii.train(spark.createDataFrame(left, schema))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(BYTE_RANKS), special_tokens={})
    expected = []
    for i, t in left:
        text, end, out = t or "", 0, ""
        for kind, a, b in sorted(pii.all_spans([text], tagger)[0][1], key=lambda s: (s[1], -s[2])):
            if a >= end:
                out += text[end:a] + f"<{kind}>"
            end = max(end, b)
        out += text[end:]
        ids = plain.encode_ordinary(out)
        expected.append((i, len(ids), hashlib.sha256(out.encode()).hexdigest(), tuple(ids)))
    found = [(r.doc_id, r.n_tokens, r.decoded_sha256, tuple(r.ids)) for r in corpus_pipeline.run(spark, path).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_near_copies_by_five_words(spark, frame):
    base = [f"v{k}" for k in range(100)]
    near, far = list(base), list(base)
    near[30] = near[60] = "other"  # 0.811 of five words, 0.848 of four
    far[20] = far[50] = far[80] = "else"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame(rows), "").collect()) == [1, 3]


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, path).schema == docs.schema, name
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        empty_result = step(spark, empty, path)
        assert empty_result.count() == 0
