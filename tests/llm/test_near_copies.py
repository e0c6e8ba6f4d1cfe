"""Near copies against brute-force Jaccard."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline as pipeline
from keyloom.llm import components as components_of, near_copies
from keyloom.plans import lineage
from tests.conftest import DATA
from tests.llm.test_operators import HARD, SCHEMA, plain_components


def plain_set(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def brute(rows, least=0.8):
    """The smallest doc_id of every component of texts that are alike."""
    sets = {d: plain_set(t) for d, t in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if jaccard(sets[a], sets[b]) >= least]
    return set(plain_components(sets, linked).values()), linked


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.getrandbits(40)}"
    return out


def family_rows():
    """Copies at similarities around 0.8, and a large family whose leader is unlike many members."""
    rng = random.Random(6)
    rows = []
    for _ in range(40):
        base = [f"w{rng.getrandbits(30)}" for _ in range(200)]
        rows += [base, edited(rng, base, rng.randint(1, 7))]
    base = [f"f{rng.getrandbits(30)}" for _ in range(150)]
    rows += [edited(rng, base, rng.randint(0, 6)) for _ in range(120)]
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("large,texts,columns", [(256, 256, 8192), (8, 5, 64)])
def test_pipeline_stage_is_brute_force(spark, monkeypatch, large, texts, columns):
    # small limits: leaders, many groups in a bucket, many slices of a matrix
    for name, value in (("LARGE", large), ("GROUP_TEXTS", texts), ("COLUMNS", columns)):
        monkeypatch.setattr(near_copies, name, value)
    rows = family_rows()
    want, linked = brute(rows)
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], SCHEMA)
    kept = pipeline.drop_near(spark, docs, DATA)
    assert kept.columns == pipeline.COLUMNS and {r.doc_id for r in kept.collect()} == want
    sets = {d: plain_set(t) for d, t in rows}
    # the set has pairs near the bound on both sides
    near = [jaccard(sets[a], sets[b]) for a, b in itertools.combinations(sets, 2)]
    assert sum(0.8 <= j < 0.9 for j in near) > 20 and sum(0.7 <= j < 0.8 for j in near) > 20 and len(linked) > 100


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want, _ = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in near_copies.keep_one_of_each(docs).collect()} == want


def test_hard_rows(spark):
    hard = spark.createDataFrame(HARD, SCHEMA)
    kept = near_copies.keep_one_of_each(hard)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8, 9, 11, 12] and kept.schema == hard.schema
    none = [(None, t, "en", "a", 0) for t in ("one two", "One  two", "other words")]
    assert len(near_copies.keep_one_of_each(spark.createDataFrame(none, SCHEMA)).collect()) == 2
    assert near_copies.keep_one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_common_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, n, dtype=np.uint64)) for n in (0, 1, 50, 200, 299, 80)]
    found = near_copies.common_counts(sets[:4], sets[2:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:4]]
    assert near_copies.common_counts([], sets).shape == (0, 6) and near_copies.common_counts(sets[:1], sets[:1]).tolist() == [[0]]


def test_family_without_a_leader(spark):
    """A chain: neighbours are alike, far ones are not, and all share keys with some."""
    rng = random.Random(8)
    words = [f"c{rng.getrandbits(30)}" for _ in range(120)]
    rows = []
    for i in range(70):
        rows.append((i, " ".join(words)))
        words = edited(rng, words, 2)
    want, linked = brute(rows)
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], SCHEMA)
    assert {r.doc_id for r in near_copies.keep_one_of_each(docs).collect()} == want and len(want) < 5


def test_pigeonring_joins_what_keys_miss(spark, monkeypatch):
    # without bucket keys only the ring of fingerprint segments finds candidates, and the sets still decide
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(reversed(words))]
    monkeypatch.setattr(near_copies, "keys", lambda hashes: hashes[:0].view("int64"))
    docs = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in near_copies.keep_one_of_each(docs).collect()} == {0, 2}


def test_hot_family_has_few_cells(spark):
    """Texts sent to cells: many buckets of one family are not as many groups, and a joined component does not meet itself."""
    rng = random.Random(9)
    # apart: 1,500 texts, each in twelve of forty buckets of many sizes; joined: one component of 1,500 and three others
    buckets = [(k, n, n) for n in range(1500) for k in rng.choices(range(40), [1 / (k + 1) for k in range(40)], k=12)]
    joined = [(100 + k, n, min(n, 1500)) for n in range(1500) for k in range(4)] + [(100, n, n) for n in range(1500, 1503)]
    for rows, most in ((buckets, 20_000), ([(k, n, 0 if n < 1500 else c) for k, n, c in joined], 4_000)):
        rest = spark.createDataFrame(sorted(set(rows)), "key long, node long, component long")
        sizes = rest.select("node").distinct().selectExpr("node", "100L AS size")
        groups, cells = near_copies._cells(rest, sizes)
        of = {r.node: r.group for r in groups.collect()}
        met = {(r.x, r.y) for r in cells.collect()}
        held = {g: sum(x == g for x in of.values()) for g in set(of.values())}
        assert len(of) == len({n for _, n, _ in rows}) and sum(held[x] + held[y] * (x != y) for x, y in met) <= most
        # every pair of a bucket that is apart has its cell
        for _ in range(2000):
            k, n, c = rng.choice(rows)
            m, d = rng.choice([(m, d) for j, m, d in rows if j == k])
            assert c == d or tuple(sorted((of[n], of[m]))) in met


def test_few_edges_take_few_partitions(spark, monkeypatch):
    """Steps over few edges write few files, and more edges are still many partitions."""
    links = spark.range(0, 3000).selectExpr("id AS a", "id + 1 - (id % 100) % 7 AS b").repartition(40)
    want = {n: c for n, c in plain_components(range(3001), [tuple(r) for r in links.collect()]).items()}
    for edges, most in ((50_000, 1), (500, 6)):
        monkeypatch.setattr(components_of, "EDGES", edges)
        cuts = []
        monkeypatch.setattr(components_of, "cut", lambda df: cuts.append(lineage.cut(df)) or cuts[-1])
        found = {r.node: r.component for r in components_of.components(links).collect()}
        assert found == {n: want[n] for n in found} and len(found) >= 2990
        assert max(df.rdd.getNumPartitions() for df in cuts[1:]) <= most
