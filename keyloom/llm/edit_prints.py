"""Document fingerprints by randomised edit embedding.

A walk over the characters of a text emits the current character at every step and moves on by
one or stays, as a random bit shared by all texts says for (step, character).  Texts at a small
edit distance fall back into step soon after every edit, so their emissions have a small Hamming
distance.  The steps that a character is emitted for follow from a table of waiting times, so the
walk takes one table look-up per character, and walks of many texts run side by side.

A fingerprint samples the emissions at places that all texts share: half of them in the upper
half of the text's range of steps, a quarter in the quarter below, and so on, so that texts of
different length still have their places in common.  Bands of sampled places find similar
fingerprints, which are then compared in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from keyloom.llm.common import in_batches
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import sample_ranges

SEED = 7_919
PERIOD = 8192  # steps after which the random bits repeat
CLASSES = 64  # of characters, by hash
SAMPLED = 128
SIMILAR = 0.8
BANDS, BAND = 16, 4
_DEPTHS = (64, 32, 16, 8, 4, 2, 1, 1)
_BLOCK_CHARS = 12_000_000
_SIDE_BY_SIDE = 40
_BROADCAST_RANGES = 200_000
_BLOCK_MEMBERS = 256
_RANGE = "__range"


@lru_cache(maxsize=1)
def _waiting() -> tuple[np.ndarray, list[list[int]]]:
    """Steps from a place until the walk moves on, for every class of characters."""
    moves = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD), dtype=np.int8)
    moves[:, -1] = 1  # no class waits for ever
    out = np.ones((CLASSES, PERIOD), dtype=np.int32)
    for place in range(PERIOD - 2, -1, -1):
        out[:, place] = np.where(moves[:, place] == 1, 1, out[:, place + 1] + 1)
    return out, out.tolist()


def _mixed(codes: np.ndarray) -> np.ndarray:
    mixed = (codes.astype(np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _classes(codes: np.ndarray) -> np.ndarray:
    return (_mixed(codes) >> np.uint64(20)).astype(np.int64) & (CLASSES - 1)


def _symbols(codes: np.ndarray) -> np.ndarray:
    """Four bits of each character."""
    return ((_mixed(codes) >> np.uint64(40)) & np.uint64(15)).astype(np.uint8)


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def walks(classes: np.ndarray, lengths: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(step at which each character is first emitted, step behind the last), for texts in a row."""
    table, rows = _waiting()
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    at, by_length = begin.astype(np.int64)[order].copy(), lengths[order]
    offsets, steps = starts[order], np.zeros(len(classes), dtype=np.int64)
    flat, mask = table.ravel(), PERIOD - 1
    wide = int(by_length[_SIDE_BY_SIDE - 1]) if len(by_length) >= _SIDE_BY_SIDE else 0
    active = np.searchsorted(-by_length, -np.arange(wide), side="left") if wide else np.zeros(0, np.int64)
    for i in range(wide):
        n = active[i]
        place = offsets[:n] + i
        now = at[:n]
        steps[place] = now
        now += flat[classes[place] * PERIOD + (now & mask)]
    # few texts are left: one after the other is faster than side by side
    for k in range(int(np.searchsorted(-by_length, -wide, side="left"))):
        a, b = int(offsets[k]) + wide, int(offsets[k] + by_length[k])
        path = list(accumulate(classes[a:b].tolist(), lambda now, c: now + rows[c][now & mask], initial=int(at[k])))
        steps[a:b], at[k] = path[:-1], path[-1]
    behind = np.empty(len(lengths), dtype=np.int64)
    behind[order] = at
    return steps, behind


@lru_cache(maxsize=64)
def places(scale: int) -> np.ndarray:
    """The sampled steps of texts whose steps end at ``2 ** scale`` or before, over half of it."""
    out = []
    for depth, n in enumerate(_DEPTHS):
        block = scale - depth
        low = 1 << (block - 1) if block > 0 else 0
        width = max(1, (1 << max(block, 0)) - low)
        u = np.random.default_rng([SEED, max(block, 0)]).random(SAMPLED)[:n]
        out.append(low + (u * width).astype(np.int64))
    return np.concatenate(out)


@lru_cache(maxsize=64)
def _shared(gap: int) -> np.ndarray:
    """Where the places of a longer text are among those of one ``gap`` scales shorter; -1: beyond it."""
    begin = np.cumsum((0, *_DEPTHS))
    out = [begin[d - gap] + np.arange(n) if d >= gap else np.full(n, -1) for d, n in enumerate(_DEPTHS)]
    return np.concatenate(out).astype(np.int64)


def scale_of(behind: int) -> int:
    return max(behind - 1, 0).bit_length()


def sampled(symbols: np.ndarray, steps: np.ndarray, behind: int) -> str:
    """Eight hex digits for the number of steps, and one per sampled place (0 beyond the end)."""
    at = places(scale_of(behind))
    out = np.zeros(SAMPLED, dtype=np.uint8)
    if len(steps):
        inside = at < behind
        out[inside] = symbols[np.searchsorted(steps, at[inside], side="right") - 1]
    return f"{behind:08x}" + (out[0::2] << 4 | out[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal emissions among the places that either text reaches; 1 for two empty texts."""
    if a == b:
        return 1.0
    n_a, n_b = int(a[:8], 16), int(b[:8], 16)
    if n_a > n_b:
        a, b, n_a, n_b = b, a, n_b, n_a
    short, long_ = (np.frombuffer(x[8:].encode(), dtype=np.uint8) for x in (a, b))
    at = places(scale_of(n_b))
    pick = _shared(min(scale_of(n_b) - scale_of(n_a), len(_DEPTHS)))
    reached = at < n_b
    both = reached & (at < n_a) & (pick >= 0)
    return float((short[pick[both]] == long_[both]).sum() / max(1, reached.sum()))


def fingerprint(text: str) -> str:
    codes = _codes([text])
    steps, behind = walks(_classes(codes), np.array([len(codes)]), np.zeros(1))
    return sampled(_symbols(codes), steps, int(behind[0]))


def _prints(texts: list[str], followers: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Fingerprints of the texts; their edited texts and the fingerprints of those.

    An edited text shares its head with the text, so its walk goes on from there.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = _codes(texts)
    symbols, starts = _symbols(codes), np.cumsum(lengths) - lengths
    steps, behind = walks(_classes(codes), lengths, np.zeros(len(texts)))
    own = [sampled(symbols[a : a + n], steps[a : a + n], int(m)) for a, n, m in zip(starts, lengths, behind)]
    tails = [f[: n // 4] for f, n in zip(followers, lengths.tolist())]
    heads = lengths - lengths // 4
    begin = np.where(heads < lengths, steps[np.minimum(starts + heads, max(len(steps) - 1, 0))] if len(steps) else 0, behind)
    tail_lengths = np.array([len(t) for t in tails], dtype=np.int64)
    tail_codes = _codes(tails)
    tail_symbols, tail_starts = _symbols(tail_codes), np.cumsum(tail_lengths) - tail_lengths
    tail_steps, tail_behind = walks(_classes(tail_codes), tail_lengths, begin)
    edited, edited_prints = [], []
    for i, (a, h, b, m) in enumerate(zip(starts, heads, tail_starts, tail_lengths)):
        edited.append(texts[i][:h] + tails[i])
        edited_prints.append(sampled(
            np.concatenate((symbols[a : a + h], tail_symbols[b : b + m])), np.concatenate((steps[a : a + h], tail_steps[b : b + m])), int(tail_behind[i])
        ))
    return own, edited, edited_prints


def in_order_with_heads(df: DataFrame) -> DataFrame:
    """``doc_id, text`` in ranges of ascending doc_id, each followed by the row behind it.

    Rows get ``__range`` and ``__guest`` (1 for the copy of the row that comes next, in the last
    range of the first row of all).  Partitions hold whole ranges, sorted.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("__id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    cut = sample_ranges(rows, [("__id", False)])
    placed = cut.assign(rows, _RANGE)
    firsts = placed.groupBy(_RANGE).agg(F.min("__id").alias("head"))
    along, everything = Window.orderBy(_RANGE), Window.partitionBy()
    heads = firsts.select(F.col(_RANGE).alias("of"), F.coalesce(F.lead("head").over(along), F.min("head").over(everything)).alias("head"))
    # one row of two numbers per range; how many there are is known
    if len(cut) <= _BROADCAST_RANGES:
        heads = F.broadcast(heads)
    # a row per range, and per row that repeats the doc_id at its head
    guests = rows.join(heads, F.col("__id") == F.col("head")).select(*rows.columns, F.col("of").alias(_RANGE), F.lit(1).alias("__guest"))
    all_rows = placed.withColumn("__guest", F.lit(0)).unionByName(guests)
    return all_rows.repartition(_RANGE).sortWithinPartitions(_RANGE, "__guest", "__id", "text").select(_RANGE, "__guest", "doc_id", "text")


def edit_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    The edited text has the last quarter of the code points (rounded down) replaced by the first
    as many of the next document in ascending doc_id; after the last document comes the first.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``; equal texts have equal fingerprints.

    Null text counts as empty (two empty texts are fully alike).  A row without doc_id comes
    before all others; rows that share a doc_id follow each other in text order; of a table of
    one row the next document is the row itself.  Texts are walked whole; an empty table gives no
    rows; other columns are not read.
    """
    types = {
        "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
    }
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, each beside the row behind it."""
        texts = [r[3] for r in rows]
        own, edited, edited_prints = _prints(texts, [*texts[1:], ""])
        out = [
            (r[2], len(r[3]), hashlib.sha256(e.encode()).hexdigest(), p, ep, likeness(p, ep), likeness(p, q))
            for r, p, q, e, ep in zip(rows[:-1], own, own[1:], edited, edited_prints) if not r[1]
        ]
        columns = list(zip(*out)) if out else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types.values())], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.append(row)
                size += len(row[3])
                if size > _BLOCK_CHARS:
                    yield finished(held)
                    held, size = held[-1:], len(row[3])
        if held:
            yield finished(held)

    return in_batches(in_order_with_heads(df), run, schema)


def similar_neighbours(prints: DataFrame, least: float = SIMILAR) -> DataFrame:
    """``a, b, likeness``: fingerprints found alike over bands of sampled places, then compared.

    ``prints`` has ``fingerprint`` and ``doc_id``; equal fingerprints count once, under their
    smallest doc_id.  All members of a band's bucket are compared with each other.  A bucket is
    dealt by hash into blocks of about ``_BLOCK_MEMBERS``, and every two blocks meet under a key of
    their own, so a large bucket is many even tasks and loses no pair; its cost is its square, as
    is the number of pairs that a family of similar texts has.
    """
    from pyspark.sql.functions import pandas_udf

    one = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    names = np.random.default_rng(SEED + 1).permutation(SAMPLED // 2)[: BANDS * BAND].reshape(BANDS, BAND).tolist()

    @pandas_udf(T.ArrayType(T.StringType()))
    def keys(prints):
        import pandas as pd

        out = []
        for p in prints:
            behind, own = int(p[:8], 16), p[8:]
            # a text near the border of two scales is also laid out at the upper one
            upper = "".join(own[i] if i >= 0 else "0" for i in _shared(1).tolist())
            out.append([f"{scale_of(behind) + up}:{band}:" + "".join(d[i] for i in at) for up, d in ((0, own), (1, upper)) for band, at in enumerate(names)])
        return pd.Series(out)

    @pandas_udf("double")
    def compared(left, right):
        import pandas as pd

        return pd.Series([likeness(x, y) for x, y in zip(left, right)])

    laid = cut(one.select("doc_id", "fingerprint", F.explode(keys("fingerprint")).alias("key")))
    sizes = laid.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / _BLOCK_MEMBERS).cast("int")
    dealt = laid.join(sizes, "key").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fingerprint"), "blocks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = met.where("own <= other").select("key", F.col("own").alias("x"), F.col("other").alias("y"), F.col("doc_id").alias("id_p"), F.col("fingerprint").alias("p"))
    right = met.where("other <= own").select("key", F.col("other").alias("x"), F.col("own").alias("y"), F.col("doc_id").alias("id_q"), F.col("fingerprint").alias("q"))
    beside = left.join(right, ["key", "x", "y"]).where("x < y OR p < q")
    pairs = beside.select(
        F.least("id_p", "id_q").alias("a"), F.greatest("id_p", "id_q").alias("b"), F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")
    ).distinct()
    return pairs.withColumn("likeness", compared("p", "q")).where(F.col("likeness") >= least).select("a", "b", "likeness")
