"""The queries without SQL on a small folder of tables, against plain versions."""

import random
import zlib

import pytest

import __spark_entry__ as driver
from ledgermill.llm import pii, toxicity
from ledgermill.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_copies import plain_repeats
from tests.llm.test_rules import labelled, plain_spans


@pytest.fixture(scope="module")
def folder(spark, frame, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    draw = random.Random(31)
    marked = labelled(draw, 200)
    texts = rows + [(1000 + k, t) for k, t, _ in marked]
    texts += [(3000 + k, f"write to u{k}@mail.example.com or 10.0.{k}.1 now") for k in range(30)]
    frame(texts).write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(1000 + k, y) for k, _, y in marked], "doc_id long, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path, texts


def test_what_is_handed_out_as_sql_is_text():
    assert all(isinstance(sql, str) for sql in ORACLE_SQL.values())
    assert all(isinstance(sql, str) for sql in driver.oracle_sql().values())


def test_toxicity_query(spark, folder):
    path, texts = folder
    model = toxicity.train(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    plain = [(i, i is not None and zlib.crc32(str(i).encode()) % 5 == 0, round(model.score(t or ""), 9)) for i, t in texts]
    found = QUERIES["op7_toxicity"](spark, path).collect()
    assert sorted(((r.doc_id, r.held_out, round(r.score, 9)) for r in found), key=str) == sorted(plain, key=str)
    assert all(r.predicted == (r.score >= 0.5) for r in found) and len({r.predicted for r in found}) == 2


def test_personal_data_query(spark, folder):
    path, texts = folder
    tagger = pii.train(spark.read.parquet(f"{path}/documents.parquet"))
    plain = []
    for i, t in texts:
        own = plain_spans(t or "")
        spans = pii.joined(pii.all_spans([t or ""], tagger)[0][1])
        assert set(filter(None, pii.joined(own).split(","))) <= set(spans.split(","))
        plain.append((i, *(sum(k == kind for k, *_ in own) for kind in pii.KINDS), spans))
    found = QUERIES["op8_personal_data"](spark, path).drop("base_sha256").collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain, key=str)


def test_repeats_query(spark, folder):
    path, texts = folder
    assert sorted(map(tuple, QUERIES["op9_suffix_merge"](spark, path).collect()), key=str) == plain_repeats(texts)
