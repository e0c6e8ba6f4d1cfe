"""The filter audit against filters that are really applied, one order after the other."""

import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyloom.llm import filter_audit
from tests.conftest import DATA
from tests.llm.test_operators import HARD, SCHEMA

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int"


def failed(rows):
    """Per row the set of filters it fails."""
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    out = []
    for d, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        out.append(fails | ({"E"} if d is not None and least[text] < d else set()))
    return out


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails, out = failed(rows), []
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        found, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                total[name] += len(gone)
                found.append((
                    part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in mine) - len(gone), sum(f == {name} for _, f in mine),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ))
        out += [(*row, total[row[1][row[2] - 1]]) for row in found]
    return sorted(out)


def test_equals_applied_filters(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    docs += [(5000 + i, docs[i][1], "en", "x", 0) for i in range(30)]  # copies in another part than their first
    got = filter_audit.audit_filters(spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS))
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)


def test_hard_rows(spark):
    rows = HARD + [(None, LONG_COPY, "", "b", 0), (None, LONG_COPY, None, "b", 0), (40, "A#", "en", "b", 0), (41, "A#", "de", "b", 0), (None, "A#", "de", "b", 0)]
    labels = [(40, 1, None), (40, 0, 1), (41, None, 1), (None, 1, 1), (3, 1, 0), (999, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in ("part", "digest", "fails", "n", "of", "salt", "id", "zero", "good", "bad")])
    got = filter_audit.audit_filters(docs, spark.createDataFrame(labels, LABELS).withColumn("lang", F.lit("x")))
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)
    empty = spark.createDataFrame([], SCHEMA)
    assert filter_audit.audit_filters(empty, spark.createDataFrame(labels, LABELS)).count() == 0
    unlabelled = filter_audit.audit_filters(docs, spark.createDataFrame([], LABELS))
    assert sorted(tuple(r) for r in unlabelled.collect()) == plain_audit(rows, [])


LONG_COPY = "x y " * 300


@pytest.mark.parametrize("seed", range(3))
def test_contractions_are_sums(seed):
    cells = np.random.default_rng(seed).integers(0, 1 << 40, (3, 2, 2, 2, 2, 2))
    selection = ((1, 0), (0, 1), (1, 1), (1, 0), (1, 1))
    assert filter_audit.contract(cells, selection).tolist() == [int(t[0, 1, :, 0, :].sum()) for t in cells]


def test_shares_of_all_orders_add_up():
    cells = np.random.default_rng(7).integers(0, 50, (3, 2, 2, 2, 2, 2))
    rows = filter_audit.audit(cells)
    shapley = {order[step - 1]: s for order, step, *_, s in rows}
    assert len(rows) == 600 and sum(shapley.values()) == 120 * int(cells[0].sum() - cells[0, 0, 0, 0, 0, 0])
