"""The corpus pipeline, stage by stage, against brute force."""

import hashlib

import corpus_pipeline as pipeline
from keyloom.llm import byte_bpe
from tests.conftest import DATA
from tests.llm.test_near_copies import brute
from tests.llm.test_operators import HARD, SCHEMA, library_encoder, low


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language", "exact dedup", "near dedup", "mix", "encode"]
    rows = {r.doc_id: r for r in docs.collect()}

    named = stages["language"](spark, docs, DATA).cache()
    assert named.columns == pipeline.COLUMNS
    kept = {r.doc_id for r in named.collect()}
    assert all(any(c.isalpha() for c in rows[d].text or "") for d in kept) and len(kept) > 0.98 * len(rows)

    exact = stages["exact dedup"](spark, named, DATA).cache()
    first = {}
    for d in sorted(kept):
        first.setdefault(low(rows[d].text), d)
    assert exact.columns == pipeline.COLUMNS and {r.doc_id for r in exact.collect()} == set(first.values())

    near = stages["near dedup"](spark, exact, DATA).cache()
    want, _ = brute([(d, rows[d].text) for d in first.values()])
    assert near.columns == pipeline.COLUMNS and {r.doc_id for r in near.collect()} == want

    mixed = stages["mix"](spark, near, DATA).cache()
    counts = {}
    for r in mixed.collect():
        assert r == rows[r.doc_id]
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert mixed.columns == pipeline.COLUMNS and set(counts) <= want and max(counts.values()) <= 3

    encoder = library_encoder()
    got = sorted(tuple(r) for r in stages["encode"](spark, mixed, DATA).collect())
    expected = []
    for d, n in counts.items():
        ids = encoder.encode_ordinary(rows[d].text)
        expected += [(d, len(ids), byte_bpe.sha_of(ids), hashlib.sha256(rows[d].text.encode()).hexdigest())] * n
    assert got == sorted(expected)


def test_run_is_the_stages(spark):
    out = pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_hard_rows(spark):
    docs = spark.createDataFrame(HARD, SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0, name
