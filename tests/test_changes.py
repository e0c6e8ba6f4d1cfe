"""Change-sets against row-by-row loops."""

import random

import numpy as np
import pytest

from fixtures import records
from keyloom.functions.codec import decode_records, encode_records
from keyloom.layout import KeySpec, Layout
from keyloom.operators import changes, stats, translog
from keyloom.plans.lineage import scratch_path
from keyloom.streaming import log_stream
from tests.conftest import rows

A = KeySpec.of("a", duplicates=False)
B = KeySpec.of("b", duplicates=False)


def test_insert_assigns_identity(spark):
    state = spark.createDataFrame([(i, n) for i, n in enumerate(["ALPHA", "BRAVO", "CHARLIE", "DELTA", "ECHO"], 1)], "auto_id long, name string")
    new = spark.createDataFrame([(1, 0, "FOXTROT")], "pos long, auto_id long, name string")
    out, rejects = changes.insert(state, new, recnum="auto_id", identity="auto_id")
    assert rows(out)[-1] == (6, "FOXTROT") and rejects.count() == 0


def test_insert_with_two_unique_keys_matches_loop(spark):
    rng = random.Random(2)
    state = [(i, i * 3, f"s{i * 5}") for i in range(20)]
    new = [(p, rng.choice([None, *range(40)]), f"s{rng.randrange(60)}") for p in range(150)]
    out, rejects = changes.insert(
        spark.createDataFrame(state, "recnum long, a int, b string"), spark.createDataFrame(new, "pos long, a int, b string"), [A, B]
    )
    seen_a, seen_b, accepted = {r[1] for r in state}, {r[2] for r in state}, []
    for p, a, b in new:
        if a not in seen_a and b not in seen_b:
            accepted.append((a, b))
            seen_a.add(a), seen_b.add(b)
    got = [r for r in out.orderBy("recnum").collect()][20:]
    assert [(r.a, r.b) for r in got] == accepted
    assert [r.recnum for r in got] == list(range(20, 20 + len(accepted)))
    assert rejects.count() == 150 - len(accepted)


def test_dependent_inserts_take_few_passes(spark, monkeypatch):
    # every row has a key of the one before it, now one and now the other
    new = [(p, p // 2, f"s{(p + 1) // 2}") for p in range(1000)]
    rows_ = spark.createDataFrame(new, "pos long, a int, b string").repartition(4)
    state = spark.createDataFrame([], "recnum long, a int, b string")
    cuts = []
    monkeypatch.setattr(changes, "cut", lambda df, keep=changes.cut: cuts.append(1) or keep(df))
    out, rejects = changes.insert(state, rows_, [A, B])
    assert len(cuts) <= 15
    assert [r.a for r in out.orderBy("recnum").collect()] == list(range(500)) and rejects.count() == 500


@pytest.mark.parametrize("seed", range(2))
def test_conflicts_over_three_keys_match_loop(spark, seed):
    rng = random.Random(seed)
    keys = [KeySpec.of(c, duplicates=False) for c in "abc"]
    # a key value that a third of all rows share, nulls among the others
    new = [(p, 0 if rng.random() < 0.3 else rng.randrange(60), rng.choice([None, *range(50)]), rng.randrange(40)) for p in rng.sample(range(1000), 120)]
    _, rejects = changes.insert(
        spark.createDataFrame([], "recnum long, a int, b int, c int"), spark.createDataFrame(new, "pos long, a int, b int, c int"), keys
    )
    taken, refused = [set(), set(), set()], set()
    for p, *values in sorted(new):
        if any(v in t for v, t in zip(values, taken)):
            refused.add(p)
        else:
            for v, t in zip(values, taken):
                t.add(v)
    assert {r.pos for r in rejects.collect()} == refused and {r.reason for r in rejects.collect()} == {"repeated"}


def test_insert_batches_match_loop(spark):
    rng = random.Random(4)
    state = [(i, i, f"s{i}") for i in range(10)]
    new = [(b, p, rng.randrange(90), f"s{rng.randrange(400)}") for b in range(12) for p in range(8)]
    out, report = changes.insert_batch(
        spark.createDataFrame(state, "recnum long, a int, b string"),
        spark.createDataFrame(new, "batch int, pos int, a int, b string").repartition(3), [A, B],
    )
    seen_a, seen_b, accepted, counts, stopped = {r[1] for r in state}, {r[2] for r in state}, [], {}, set()
    for b, p, a, t in new:
        counts.setdefault(b, 0)
        if b in stopped:
            continue
        if a in seen_a or t in seen_b:
            stopped.add(b)
            continue
        accepted.append((a, t)), seen_a.add(a), seen_b.add(t)
        counts[b] += 1
    assert [(r.a, r.b) for r in out.orderBy("recnum").collect()][10:] == accepted
    assert {r.batch: (r.inserted, r.status) for r in report.collect()} == {b: (n, 5 if b in stopped else 0) for b, n in counts.items()}


def test_update_and_delete(spark):
    state = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3)], "recnum long, a string, b int")
    change = spark.createDataFrame([(2, None, 9), (7, "q", 7)], "recnum long, a string, b int")
    out, missing = changes.update(state, change)
    assert rows(out) == [(1, "x", 1), (2, None, 9), (3, "z", 3)] and rows(missing) == [(7, "q", 7)]
    out, absent = changes.delete(state, spark.createDataFrame([(1,), (9,), (1,)], "recnum long"))
    assert rows(out, "recnum") == [(2,), (3,)] and rows(absent) == [(9,)]


def test_patch_known_record(spark):
    enc = encode_records(records.customers(spark), records.CUST, keep=["recnum"])
    patch = spark.createDataFrame([(1, 5, 0, 44, bytearray(b"XX"))], "request long, recnum long, chunk int, offset int, data binary")
    out, report = changes.update_chunks(enc, patch, records.CUST.record_length)
    got = {r.recnum: r for r in decode_records(out, records.CUST, keep=["recnum"]).collect()}
    assert got[5].AREA == "XX" and got[4].AREA == "SK" and rows(report) == [(1, 5, 0)]


def test_patches_match_loop(spark):
    rng = random.Random(6)
    recs = {i: bytearray(rng.randbytes(20)) for i in range(6)}
    patches = []
    for request in range(80):
        recnum = 0 if request % 3 == 0 else rng.randrange(7)
        for chunk in range(rng.randrange(1, 4)):
            patches.append((request, recnum, chunk, rng.randrange(0, 21 if request % 5 == 0 else 17), bytearray(rng.randbytes(rng.randrange(0, 4)))))
    df = spark.createDataFrame(patches, "request long, recnum long, chunk int, offset int, data binary")
    out, report = changes.update_chunks(spark.createDataFrame([(i, r) for i, r in recs.items()], "recnum long, rec binary"), df, 20)
    status = {}
    for request in range(80):
        mine = [p for p in patches if p[0] == request]
        recnum = mine[0][1]
        if any(p[3] + len(p[4]) > 20 for p in mine):
            status[request] = 103
        elif recnum not in recs:
            status[request] = 8
        else:
            status[request] = 0
            for _, _, _, off, data in mine:
                recs[recnum][off : off + len(data)] = data
    assert {r.recnum: bytes(r.rec) for r in out.collect()} == {i: bytes(r) for i, r in recs.items()}
    assert {r.request: r.status for r in report.collect()} == status


def test_truncate_report(spark):
    asked = spark.createDataFrame([(1, 1, 19), (2, 1, 20), (3, 2, 30)], "request long, recnum long, length int")
    assert rows(changes.truncate_report(asked, 20), "request", "status") == [(1, 28), (2, 0), (3, 0)]


def random_log(seed, n=260):
    rng = random.Random(seed)
    ops = [2, 3, 3, 4, 19, 20, 21, 1019]
    log = []
    for seq in range(n):
        session = 0 if seq % 3 == 0 else rng.randrange(4)
        op = rng.choice(ops)
        log.append((seq, session, op, rng.randrange(14) if op < 19 else None, f"v{seq}" if op < 19 else None))
    return log


def simulate(state, log):
    """One session after the other decides what counts, then changes apply in order."""
    opened, verdict, status = {}, {}, {}
    for seq, session, op, _, _ in log:
        if op in (19, 1019):
            status[seq] = 37 if session in opened else 0
            opened.setdefault(session, [])
        elif op in (20, 21):
            status[seq] = 0 if session in opened else 39
            for s in opened.pop(session, []):
                verdict[s] = "committed" if op == 20 else "aborted"
        elif session in opened:
            opened[session].append(seq)
        else:
            verdict[seq] = "plain"
    state = dict(state)
    for seq, _, op, recnum, value in log:
        if op > 4 or verdict.get(seq) not in ("plain", "committed"):
            continue
        have = recnum in state
        status[seq] = (5 if have else 0) if op == 2 else (0 if have else 8)
        if status[seq] == 0:
            state.pop(recnum, None)
            if op != 4:
                state[recnum] = value
    return state, status


LOG_DDL = "seq long, session int, op int, recnum long, v string"


@pytest.mark.parametrize("seed", [1, 2])
def test_log_matches_simulation(spark, seed):
    state, log = {i: f"s{i}" for i in range(8)}, random_log(seed)
    out, report = translog.apply_log(
        spark.createDataFrame(list(state.items()), "recnum long, v string"), spark.createDataFrame(log, LOG_DDL).repartition(4)
    )
    want, status = simulate(state, log)
    assert dict(rows(out)) == want
    got = {r.seq: r.status for r in report.collect()}
    assert {s: v for s, v in got.items() if v is not None} == status and len(got) == len(log)


def test_split_log_equals_one_run(spark, monkeypatch):
    monkeypatch.setattr(log_stream, "COMPACT_EVERY", 2)
    state, log = {i: f"s{i}" for i in range(8)}, random_log(9, 200)
    root = scratch_path(spark, "split-log")
    log_stream.start_state(spark.createDataFrame(list(state.items()), "recnum long, v string"), root)
    for i in range(4):
        part = spark.createDataFrame(log[i * 50 : (i + 1) * 50], LOG_DDL)
        log_stream.apply_batch(part, root, i)
        if i == 2:  # a repeated batch changes nothing
            log_stream.apply_batch(part, root, i)
    assert dict(rows(log_stream.finish(spark, root, 4).select("recnum", "v"))) == simulate(state, log)[0]


def test_key_statistics(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a int, b string")
    got = dict(rows(stats.key_cardinality(df, [["a"], ["a", "b"]])))
    assert got == {"a": 2, "a,b": 3}
    lay = Layout.build("t", [("a", 1, 4), ("b", 0, 2)], [KeySpec.of("a", num=1, duplicates=False), KeySpec.of("b", num=2)])
    assert rows(stats.unique_audit(df, lay), "key_number", "copies") == [(1, 2)]
    bare = Layout.build("t", [("a", 1, 4)])
    only = stats.file_stat(df, bare).collect()
    assert len(only) == 1 and only[0].record_count == 4 and only[0].key_number is None


def test_update_with_repeated_numbers(spark):
    state = spark.createDataFrame([(1, "a"), (2, "b")], "recnum long, v string")
    asked = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1), (9, "n", 1)], "recnum long, v string, seq int")
    done, left = changes.update(state, asked, sequence="seq")
    assert rows(done) == [(1, "y"), (2, "z")] and rows(left) == [(1, "x", 1), (9, "n", 1)]
    done, left = changes.update(state, asked)
    assert rows(done) == [(1, "a"), (2, "z")] and rows(left) == [(1, "x", 1), (1, "y", 2), (9, "n", 1)]


@pytest.mark.parametrize("block", [1, 64, 1 << 22])
def test_patches_of_one_record_in_blocks(spark, monkeypatch, block):
    """Most patches are one record's; equal places go in the order of offset and data."""
    monkeypatch.setattr(changes, "_PATCH_BLOCK", block)
    rng = random.Random(block)
    recs = {i: bytearray(rng.randbytes(30)) for i in range(4)}
    patches = [
        (r, 1 if r % 4 else rng.randrange(4), None if r % 7 == 0 else c, rng.randrange(0, 24), bytearray(rng.randbytes(rng.randrange(1, 6))))
        for r in range(300) for c in (0, 1, 1)
    ]
    schema = "request long, recnum long, chunk int, offset int, data binary"
    state = spark.createDataFrame([(i, r, "x") for i, r in recs.items()], "recnum long, rec binary, data string")
    out, _ = changes.update_chunks(state, spark.createDataFrame(patches, schema).repartition(5), 30)
    for _, recnum, _, offset, data in sorted(patches, key=lambda p: (p[0], -1 if p[2] is None else p[2], p[3], bytes(p[4]))):
        recs[recnum][offset : offset + len(data)] = data
    assert {r.recnum: bytes(r.rec) for r in out.collect()} == {i: bytes(r) for i, r in recs.items()}
    assert changes.update_chunks(state, spark.createDataFrame([], schema), 30)[0].count() == 4


def test_many_short_patches_take_bounded_memory(spark):
    """A task's arrays do not grow with the patches it gets, however short they are."""
    import tracemalloc

    import pyarrow as pa

    class Captured:
        schema = None

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    def batches():
        for i in range(100):
            n = np.arange(i * 10_000, (i + 1) * 10_000)
            data = pa.array([b"ab"] * len(n), pa.binary())
            columns = [pa.array(n % 5000), pa.array(n), pa.array(np.zeros(len(n), np.int32)), pa.array(n % 17), data]
            yield pa.RecordBatch.from_arrays(columns, names=["recnum", "request", "chunk", "offset", "data"])

    run = changes._seen_runs(Captured(), "recnum")
    tracemalloc.start()
    try:
        runs = sum(b.num_rows for b in run(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert runs > 0 and peak < 60 << 20
