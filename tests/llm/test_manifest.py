"""The Merkle manifest against a plain recursion."""

import zlib
from hashlib import sha256

import pytest

from keyloom.llm import manifest
from keyloom.llm.suite import QUERIES
from tests.conftest import DATA
from tests.llm.test_operators import HARD, SCHEMA, low

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """(root, per node the list of (left, right) siblings)."""
    paths, spot = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for p, s in zip(paths, spot):
            run = runs[s // 16]
            p.append(("".join(run[: s % 16]), "".join(run[s % 16 + 1 :])))
        spot, nodes = [s // 16 for s in spot], [h("".join(run)) for run in runs]
    return nodes[0], paths


def plain_manifest(rows):
    """``rows`` of (doc_id, text, lang, source, n_chars)."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        leaves = sorted(((r[0] is not None, r[0] or 0, leaf_of(r[0], r[3], r[2], r[4], r[1])), r) for r in rows if r[3] == source)
        trees.append((leaves, *climb([k[2] for k, _ in leaves])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (leaves, subroot, paths), more in zip(trees, above):
        for ((_, _, leaf), r), path in zip(leaves, paths):
            whole, folded = path + more, leaf
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                folded = leaf_of(r[0], r[3], r[2], r[4], low(r[1]))
            for left, right in whole:
                folded = h(left + folded + right)
            out.append((r[0], leaf, subroot, root, h("".join(a + b for a, b in whole)), folded, folded == root))
    return out


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("levels", [1, 2])
def test_equals_recursion(spark, levels):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, "one" if r.doc_id < 150 else r.source, r.n_chars) for r in docs.collect()]
    # a source of more than a block, so that block roots are appended to a tree of their own
    rows += [(1000 + i, f"Text {i}", "en", "one", i) for i in range(300)]
    found = manifest.build_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), levels)
    assert found.columns == COLUMNS
    got = sorted((tuple(r) for r in found.collect()), key=key)
    assert got == sorted(plain_manifest(rows), key=key)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_many_sources(spark):
    rows = [(i, "A" * (i % 3), None, f"s{i % 40}", i) for i in range(90)]
    got = sorted((tuple(r) for r in manifest.build_manifest(spark.createDataFrame(rows, SCHEMA), 1).collect()), key=key)
    assert got == sorted(plain_manifest(rows), key=key)


def test_hard_rows(spark):
    from pyspark.sql import functions as F

    rows = HARD + [(None, None, None, None, None), (13, "A\x00B", "", "", -5)]
    clashing = [F.lit(7).alias(c) for c in ("tree", "pos", "block", "size", "digest", "changed", "top", "steps", "of")]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *clashing)
    got = sorted((tuple(r) for r in manifest.build_manifest(docs).collect()), key=key)
    assert got == sorted(plain_manifest(rows), key=key)
    assert manifest.build_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_row(spark):
    row = (4, "x", "en", "s", 1)
    got = [tuple(r) for r in manifest.build_manifest(spark.createDataFrame([row], SCHEMA)).collect()]
    assert got == plain_manifest([row]) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300])
def test_witnesses_grow_with_appends(n):
    digests = [h(str(i)) for i in range(n)]
    tower = manifest.Appender(None, watch=True)
    for k, digest in enumerate(digests, 1):
        tower.append(digest)
        # only completed runs are in a witness, and none needs the nodes to come
        assert len(tower.witnesses[k - 1]) == sum(k % 16**level == 0 for level in (1, 2))
    root, paths = climb(digests)
    assert tower.root() == root and tower.witnesses == paths
    assert all(manifest.fold(d, w) == root for d, w in zip(digests, tower.witnesses))


def test_query_reads_all(spark):
    found = QUERIES["op11_manifest"](spark, DATA)
    assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
