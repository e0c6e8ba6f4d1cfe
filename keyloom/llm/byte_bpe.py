"""Byte-level BPE over a global shuffle of distinct words.

Texts are cut into pre-tokens with their positions, block by block: a block is some megabytes of
documents, in which every pre-token is a number (of its place in the block's list of distinct
words).  One shuffle deals the blocks' texts out by block and their word lists by a hash of the
word, so that all mentions of a word meet in one task, once per block however often the word
occurs, and it is encoded once (again only if a bucket has more than ``KEPT_WORDS`` distinct
words: memory stays bounded).  The ids go back to where their block's texts already are, and
the positions put them together again.  Decoding joins the ids with the table of token bytes.

Texts and word lists cross the network once and are stored nowhere else, so a block must come out
the same when a lost executor's part is done again: ``encode_texts`` writes an input down first
unless told that it is read from files as it is.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from keyloom.llm.common import gather, in_batches, texts_of
from keyloom.plans.lineage import scratch_path

BLOCK_BYTES = 8 << 20
PACK_WORDS = 200_000
#: Least number of buckets of words, and distinct words of one bucket that a task keeps.
BUCKETS = 64
KEPT_WORDS = 300_000
_WORDS, _TEXTS = 0, 1
#: Level at which blocks and lists are compressed, and the code of a number beyond two bytes.
LEVEL = 9
_WIDE = 0xFFFF


@lru_cache(maxsize=8)
def library_class(name: str) -> str:
    """Characters of a Unicode class such as ``\\p{L}`` as ranges, as the library's own matcher takes them.

    Its Unicode tables are others than Python's, and letters of newer versions are cut
    differently.  All characters are put through an encoder of single bytes, which leaves out
    what the class does not match.
    """
    import tiktoken

    probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    inside = np.array([ord(c) for c in bytes(probe.encode_ordinary(every)).decode()], dtype=np.int64)
    starts = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    ends = np.append(starts[1:], len(inside)) - 1
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(inside[starts].tolist(), inside[ends].tolist()))


def written_out(pattern: str) -> str:
    """The pattern with its Unicode classes written out, which the standard matcher runs fastest."""
    inner = {name: library_class(name) for name in (r"\s", r"\p{L}", r"\p{N}")}

    def in_class(m: re.Match) -> str:
        body = m.group()
        for name, chars in inner.items():
            body = body.replace(name, chars)
        return body

    out = re.sub(r"\[[^\]]*\]", in_class, pattern)
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        out = out.replace(name, f"[{inner[name]}]")
    return out.replace(r"\S", f"[^{inner[chr(92) + 's']}]")


@lru_cache(maxsize=2)
def pre_tokens(written: str) -> re.Pattern:
    """The matcher of a pattern from ``written_out``."""
    return re.compile(written)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encode_word(word: bytes, table: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of lowest rank, leftmost first, until none is in the table."""
    known = table.get(word)
    if known is not None:
        return [known]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 64:
        return _encode_long(parts, table)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = table.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [table[p] for p in parts]


def _encode_long(parts: list[bytes], table: dict[bytes, int]) -> list[int]:
    """The same with a queue of pairs, for words of any length."""
    import heapq

    n = len(parts)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    queue = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := table.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = right[i]
        if not alive[i] or j >= n or parts[i] + parts[j] != pair:
            continue
        parts[i], alive[j], right[i] = pair, False, right[j]
        if right[j] < n:
            left[right[j]] = i
        for a in (left[i], i):
            b = right[a] if a >= 0 else n
            if a >= 0 and b < n and (r := table.get(parts[a] + parts[b])) is not None:
                heapq.heappush(queue, (r, a, parts[a] + parts[b]))
    return [table[p] for p, live in zip(parts, alive) if live]


def _raw_planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes (the upper ones are almost constant)."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(raw)


def _planes(values: np.ndarray) -> bytes:
    return _squeeze(_raw_planes(values))


def _from_planes(packed: bytes) -> np.ndarray:
    return _from_raw_planes(zstandard.decompress(packed))


def _from_raw_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack_numbers(numbers: np.ndarray, once: int) -> bytes:
    """Word numbers of some texts; those from ``once`` on occur once in a block, in this order.

    Two bytes a word: 0 for the next word that occurs once, ``_WIDE`` for a number that does not
    fit and stands behind the others, else the number plus one.
    """
    single, codes = numbers >= once, numbers.astype(np.int64) + 1
    wide = ~single & (codes >= _WIDE)
    start = int(numbers[single][0]) if single.any() else 0
    codes[wide], codes[single] = _WIDE, 0
    head = np.array([start, np.count_nonzero(wide)], dtype="<u4")
    return _squeeze(head.tobytes() + codes.astype("<u2").tobytes() + _raw_planes(numbers[wide]))


def unpack_numbers(packed: bytes) -> np.ndarray:
    raw = zstandard.decompress(packed)
    start, n_wide = np.frombuffer(raw, "<u4", 2).tolist()
    end = len(raw) - 4 * n_wide
    codes = np.frombuffer(raw[8:end], "<u2")
    numbers, single = codes.astype(np.int64) - 1, codes == 0
    numbers[single] = start + np.arange(np.count_nonzero(single))
    numbers[codes == _WIDE] = _from_raw_planes(raw[end:])
    return numbers


_TYPES = {
    "meet": pa.int64(), "block": pa.int64(), "kind": pa.int32(), "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int32()), "payload": pa.binary(),
}
_SCHEMA = "meet long, block long, kind int, doc_ids array<bigint>, lengths array<int>, payload binary"


def _row(meet: int, block: int, kind: int, doc_ids: list | None, lengths: list | None, payload: bytes) -> pa.RecordBatch:
    out = [[meet], [block], [kind], [doc_ids], [lengths], [payload]]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, _TYPES.values())], names=list(_TYPES))


def cut_into_blocks(df: DataFrame, pattern: str, buckets: int = BUCKETS) -> DataFrame:
    """Blocks of documents as word numbers (``kind`` 1), and their word lists by bucket (0).

    ``meet`` says where a row has to go: a text to its block, a list to its bucket (these are below zero).
    Words are numbered from the most frequent of their block on, which keeps the numbers small;
    those that occur once come last, in the order of the texts, so their numbers need no room.
    A word list holds words of one bucket and the steps between their numbers; ``lengths`` of the
    texts count words.
    """
    written = written_out(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut = pre_tokens(written).findall
        block = TaskContext.get().partitionId() << 32
        numbers: dict[str, int] = {}
        doc_ids: list = []
        texts: list[np.ndarray] = []
        size = 0

        def closed() -> Iterator[pa.RecordBatch]:
            often = np.bincount(np.concatenate(texts), minlength=len(numbers))
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            once = int(np.count_nonzero(often > 1))
            start = held = 0
            for stop, text in enumerate(texts, 1):
                held += len(text)
                if held >= PACK_WORDS or stop == len(texts):
                    some = texts[start:stop]
                    yield _row(block, block, _TEXTS, doc_ids[start:stop], [len(t) for t in some], pack_numbers(rank[np.concatenate(some)], once))
                    start, held = stop, 0
            met = list(numbers)
            words = [met[i].encode() for i in order.tolist()]
            of = np.fromiter((zlib.crc32(w) % buckets for w in words), dtype=np.int32, count=len(words))
            sides = np.argsort(of, kind="stable").astype(np.int32)
            cuts = np.searchsorted(of[sides], np.arange(buckets + 1))
            for bucket in range(buckets):
                mine = sides[cuts[bucket] : cuts[bucket + 1]]
                if len(mine):
                    # a word may hold any byte, so the list carries lengths
                    some = [words[i] for i in mine]
                    head = np.concatenate((np.diff(mine, prepend=0), [len(w) for w in some]))
                    yield _row(-1 - bucket, block, _WORDS, None, None, _squeeze(np.array([len(some)], "<u4").tobytes() + _raw_planes(head) + b"".join(some)))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                words = cut(text)
                for w in words:
                    if w not in numbers:
                        numbers[w] = len(numbers)
                texts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words)))
                doc_ids.append(doc_id)
                size += len(text) + 16
                if size >= BLOCK_BYTES:
                    yield from closed()
                    numbers, doc_ids, texts, size, block = {}, [], [], 0, block + 1
        if texts:
            yield from closed()

    return in_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _SCHEMA)


def encode_lists(lists: DataFrame, ranks_path: str) -> DataFrame:
    """Ids for the words of all lists, which come sorted by bucket; of a bucket each word once.

    Returns rows like the lists', which have to go to their block: steps, then how many ids each
    has, then the ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bucket, known = ranks(ranks_path), None, {}
        for batch in batches:
            for of, block, payload in zip(*(batch.column(n).to_pylist() for n in ("meet", "block", "payload"))):
                if of != bucket:
                    bucket, known = of, {}
                raw = zstandard.decompress(payload)
                n = int(np.frombuffer(raw, "<u4", 1)[0])
                steps, lengths = np.split(_from_raw_planes(raw[4 : 4 + 8 * n]), 2)
                ends = (4 + 8 * n + np.cumsum(lengths, dtype=np.int64)).tolist()
                out = []
                for end, length in zip(ends, lengths.tolist()):
                    word = raw[end - length : end]
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= KEPT_WORDS:
                            known.clear()
                        ids = known[word] = np.array(encode_word(word, table), dtype="<u4").tobytes()
                    out.append(ids)
                sizes = np.array([len(i) // 4 for i in out], dtype=np.int64)
                yield _row(block, block, _WORDS, None, [n], _planes(np.concatenate((steps, sizes, np.frombuffer(b"".join(out), "<u4")))))

    return in_batches(lists.sortWithinPartitions("meet"), run, _SCHEMA)


def buckets_for(partitions: int) -> int:
    """Buckets of words for an input of so many partitions.

    They grow with its root, so that the word lists a bucket gets and the buckets of a block both
    grow with the root only.
    """
    return max(BUCKETS, 8 * math.isqrt(partitions))


def _of_kind(kind: int) -> Column:
    """Rows of a kind; tied to the task that reads them, so that it is not asked before the shuffle that both kinds share."""
    return F.when(F.spark_partition_id() >= 0, F.col("kind")) == kind


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, buckets: int | None = None, stable: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` (32-bit little-endian) for every row of ``df``.

    ``buckets`` of words follow the number of input partitions if not given.  ``stable`` says that
    ``df`` reads files, so that a repeated task meets the same rows in the same order; any other
    input is written down first.

    The ids are those of the ranks' own encoder on each match of ``pattern``, special strings
    being ordinary text.  Null text counts as empty (no ids).  Null doc_ids and repeated rows
    stay rows of their own, as positions belong to rows and not to identifiers; texts are taken
    whole; an empty table gives no rows; other columns are not read.
    """
    spark, docs = df.sparkSession, df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not stable:
        path = scratch_path(spark, "texts")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    dealt = cut_into_blocks(docs, pattern, buckets or buckets_for(docs.rdd.getNumPartitions())).repartition("meet")
    found = encode_lists(dealt.where(_of_kind(_WORDS)), ranks_path)
    types = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}

    def run(texts: pa.Table, lists: pa.Table) -> pa.Table:
        values, starts, sizes = _word_table([(n[0], _from_planes(p)) for n, p in zip(lists.column("lengths").to_pylist(), lists.column("payload").to_pylist())])
        doc_ids, counts, out = [], [], []
        for own, lengths, payload in zip(*(texts.column(n).to_pylist() for n in ("doc_ids", "lengths", "payload"))):
            words = unpack_numbers(payload)
            ids = gather(values, starts[words], sizes[words])
            at = np.concatenate(([0], np.cumsum(sizes[words], dtype=np.int64)))[np.cumsum([0, *lengths])].tolist()
            doc_ids += own
            counts += np.diff(at).tolist()
            out += [ids[a:b].tobytes() for a, b in zip(at, at[1:])]
        return pa.table([pa.array(c, type=t) for c, t in zip((doc_ids, counts, out), types.values())], names=list(types))

    # Both sides are dealt by the block, the texts already.  Both readers of the first shuffle take
    # all its columns: with other ones it would be another shuffle, and the texts be cut twice.
    sides = dealt.where(_of_kind(_TEXTS)).groupBy("meet").cogroup(found.select("meet", "lengths", "payload").groupBy("meet"))
    return sides.applyInArrow(run, "doc_id long, n_tokens long, ids binary")


def _word_table(lists: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all words in a row, where each word's begin, how many it has), by word number."""
    n = sum(k for k, _ in lists)
    starts, sizes = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    values, base = [], 0
    for k, read in lists:
        numbers, lengths, ids = np.cumsum(read[:k]), read[k : 2 * k], read[2 * k :]
        sizes[numbers] = lengths
        starts[numbers] = base + np.cumsum(lengths) - lengths
        values.append(ids.astype("<u4"))
        base += len(ids)
    return np.concatenate(values) if values else np.zeros(0, "<u4"), starts, sizes


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens in a row, where each begins, how many it has), by id."""
    table = ranks(path)
    by_id = {i: t for t, i in table.items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(df: DataFrame, ranks_path: str) -> DataFrame:
    """``df(doc_id, n_tokens, ids)`` with ``decoded``: the bytes of the ids, from the token table.

    The table has one row per id of the vocabulary and is read by every task.  Null ids give null.
    """
    types = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, starts, sizes = token_bytes(ranks_path)
        for batch in batches:
            out = []
            for raw in batch.column("ids").to_pylist():
                if raw is None:
                    out.append(None)
                    continue
                ids = np.frombuffer(raw, dtype="<u4")
                out.append(gather(values, starts[ids], sizes[ids]).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "n_tokens", "ids")), pa.array(out, pa.binary())], names=list(types))

    return in_batches(df.select("doc_id", "n_tokens", "ids"), run, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, stable: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, then decoded."""
    decoded = decode_ids(encode_texts(df, ranks_path, pattern, stable=stable), ranks_path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def sha_of(ids: list[int]) -> str:
    return hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
