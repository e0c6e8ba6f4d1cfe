"""Token files: id sequences in document order, grammar-compressed per shard.

Re-Pair replaces frequent pairs of neighbouring symbols by new ones and writes down the rules.
Here a round counts all pairs of a shard and replaces the most frequent one together with all
that are at least a fiftieth as frequent, leftmost first where they overlap; rounds go on until no
pair occurs often enough to pay for its rule, or the symbols' two bytes are used up.  Rules keep
the length they expand to, and a table of places lets a single document be decoded without the
rest of its shard.  No rule reaches over the end of a document.

A shard is one row of a Parquet container, so that Spark's writer commits it once even if tasks
are repeated.  The payload's layout, little-endian:

    4s  magic "KRP1"    u32 documents    u32 rules    u64 symbols    u64 ids    u32 first new symbol
    i64 doc_id, u8 null, u32 ids        of each document (three arrays)
    u32 left, u32 right, u32 length     of each rule (three arrays)
    u64                                 ids before every 1024th symbol
    u16 or u32                          symbols (u32 if there are more than 65536)
"""

from __future__ import annotations

import codecs
import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keyloom.llm.common import gather, in_batches, texts_of
from keyloom.plans.lineage import scratch_path

END_ID = 1
SHARD_IDS = 1_000_000
#: A round replaces the pairs at least so frequent as its most frequent one.
ROUND_SHARE = 0.02
#: Bytes of a rule; a pair is replaced if the symbols it saves take more.
RULE_BYTES = 12
SKIP = 1024

_HEAD = struct.Struct("<4sIIQQI")
_MAGIC = b"KRP1"
#: Bins only leave out rare pairs; counts of so many stay in a core's cache.
_BIN_BITS = 18
_BINS = 1 << _BIN_BITS
_WORDS = 700_000
_APART = 1000
#: A word of Latin letters and then marks: the pre-tokenizer cuts it exactly there.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]*")
_MARKS = ".,;:!?%&*$#()|"
#: White space for Python that the vocabulary's own pattern takes for a mark.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: All white space that Arrow does not cut at: the above, and white space beyond ASCII.
_FAR_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class WordEncoder:
    """Ids of texts under a vocabulary that drops white space: every word is encoded by itself.

    The library encodes each distinct word; a bounded table keeps them.  Arrow cuts the texts and
    numbers the distinct words of a batch, so that Python meets a word once a batch.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # words of lower-case letters need no normalising and no pattern, only their bytes as the vocabulary writes them
        self.letters = Tokenizer(self.library.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        table = list(map(chr, range(256)))
        for c in range(0xC0, 0x100):
            for byte, char in zip(chr(c).encode(), as_bytes.pre_tokenize_str(chr(c))[0][0], strict=True):
                table[byte] = char
        self.written = "".join(table)
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.final = np.zeros(self.size, dtype=bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Words of lower-case letters only: one call for many, cut where the last piece of a word is."""
        out: list[bytes] = []
        for at in range(0, len(words), _APART):
            some = words[at : at + _APART]
            line = " ".join(some)
            if not line.isascii():
                line = codecs.charmap_decode(line.encode(), "strict", self.written)[0]
            ids = np.array(self.letters.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.final[ids]) + 1)).tolist()
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)] if len(ends) == len(some) else self._encode(some)
        return out

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, which are put into the table: letters and the marks behind them by themselves, any other word whole."""
        if len(self.parts) > _WORDS:
            self.parts = {"": b""}
        parts = self.parts
        heads = list(map(str.rstrip, words, repeat(_MARKS)))
        # the vocabulary lowers letters itself; these have one lower form
        low = list(map(str.lower, heads))
        new = list(set(low).difference(parts))
        letters = list(compress(new, map(_LETTERS.fullmatch, new)))
        parts.update(zip(letters, self._encode_letters(letters)))
        found = list(map(parts.get, low))
        marked = [(k, w[len(h) :]) for k, (w, h) in enumerate(zip(words, heads)) if w is not h]
        marks = list({tail for _, tail in marked}.difference(parts))
        parts.update(zip(marks, self._encode(marks)))
        for k, tail in marked:
            if found[k] is not None:
                found[k] += parts[tail]
        other = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(other, self._encode([words[k] for k in other])):
            found[k] = ids
        self.words.update(zip(words, found))
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # many objects are made and none in cycles
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_texts(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > 2 * _WORDS:
            self.words.clear()
        far = list(map(_FAR_SPACE.search, texts))
        whole = {k for k, t in enumerate(texts) if far[k] and _ODD_SPACE.search(t)}
        plain = [" ".join(t.split()) if far[k] else t for k, t in enumerate(texts) if k not in whole]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        met = split.flatten().dictionary_encode()
        # as objects of Arrow's making, which is many times faster than to_pylist
        words = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.words.get, words))
        new = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(new, self.learn([words[k] for k in new])):
            ids[k] = x
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, codes = np.cumsum(lengths) - lengths, met.indices.to_numpy()
        each = lengths[codes]
        found = gather(np.frombuffer(b"".join(ids), dtype="<u4"), starts[codes], each)
        ends = np.concatenate(([0], np.cumsum(each)))[split.offsets.to_numpy()].tolist()
        cut = (found[i:j] for i, j in zip(ends, ends[1:]))
        return [np.frombuffer(self._encode([t])[0], dtype="<u4") if k in whole else next(cut) for k, t in enumerate(texts)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _bins(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A bin of ``_BINS`` for every pair."""
    return ((left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - _BIN_BITS)).astype(np.int64)


def pair_rules(ids: np.ndarray, first_new: int, end_id: int = END_ID, share: float = ROUND_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): ``rules[k]`` are the two symbols that ``first_new + k`` stands for."""
    seq, rules = ids.astype(np.uint32), np.zeros((0, 2), dtype=np.uint32)
    most, width = ((1 << 16) - first_new, 2) if first_new < 1 << 16 else ((1 << 32) - first_new, 4)
    least = RULE_BYTES // width + 1
    while len(seq) > 1 and len(rules) < most:
        bins = _bins(seq[:-1], seq[1:])
        # pairs with an end in them have a bin of their own
        ends = np.flatnonzero(seq == end_id)
        bins[ends[ends < len(bins)]] = bins[ends[ends > 0] - 1] = _BINS
        heavy = np.bincount(bins, minlength=_BINS + 1) >= least
        heavy[_BINS] = False
        spots = np.flatnonzero(heavy[bins])
        keys = (seq[spots].astype(np.uint64) << np.uint64(32)) | seq[spots + 1]
        pairs, counts = np.unique(keys, return_counts=True)
        often = np.flatnonzero(counts >= max(least, share * counts.max(initial=0)))
        if not len(often):
            break
        often = often[np.lexsort((pairs[often], -counts[often]))[: most - len(rules)]]
        chosen = np.sort(pairs[often])
        marked = np.zeros(_BINS + 1, dtype=bool)
        marked[_bins((chosen >> np.uint64(32)).astype(np.uint32), chosen.astype(np.uint32))] = True
        likely = marked[bins[spots]]
        at, keys = spots[likely], keys[likely]
        rule = np.searchsorted(chosen, keys)
        hit = chosen[np.minimum(rule, len(chosen) - 1)] == keys
        at, rule = at[hit], rule[hit]
        # overlapping pairs are neighbours in ``at``: every other one of a run is taken
        opens = np.concatenate(([True], np.diff(at) > 1))
        begin = np.maximum.accumulate(np.where(opens, at, 0))
        taken = (at - begin) % 2 == 0
        at, rule = at[taken], rule[taken]
        used, rule = np.unique(rule, return_inverse=True)
        seq[at] = first_new + len(rules) + rule
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
        found = chosen[used]
        rules = np.concatenate((rules, np.stack((found >> np.uint64(32), found & np.uint64(0xFFFFFFFF)), axis=1).astype(np.uint32)))
    return seq, rules


def expansion_lengths(rules: np.ndarray, first_new: int) -> np.ndarray:
    lengths = np.ones(len(rules), dtype=np.uint32)
    size = lambda s: 1 if s < first_new else int(lengths[s - first_new])
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[k] = size(a) + size(b)
    return lengths


def write_shard(doc_ids: list[int | None], documents: list[np.ndarray], first_new: int) -> bytes:
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    seq, rules = pair_rules(ids, first_new)
    lengths = expansion_lengths(rules, first_new)
    width = "<u2" if first_new + len(rules) <= 1 << 16 else "<u4"
    spans = np.where(seq < first_new, 1, lengths[np.maximum(seq.astype(np.int64) - first_new, 0)] if len(rules) else 1).astype(np.uint64)
    before = (np.cumsum(spans) - spans).astype("<u8")[::SKIP]
    return b"".join([
        _HEAD.pack(_MAGIC, len(documents), len(rules), len(seq), len(ids), first_new),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        np.array([len(d) for d in documents], dtype="<u4").tobytes(),
        rules[:, 0].astype("<u4").tobytes(), rules[:, 1].astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
        before.tobytes(), seq.astype(width).tobytes(),
    ])


class Shard:
    """A shard's payload, read in place."""

    def __init__(self, payload: bytes):
        magic, docs, rules, symbols, self.n_ids, self.first_new = _HEAD.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=dtype, count=n, offset=at)
            at += out.nbytes
            return out

        ids, null, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, null)]
        self.left, self.right, self.spans = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.before = take("<u8", -(-symbols // SKIP))
        self.symbols = take("<u2" if self.first_new + rules <= 1 << 16 else "<u4", symbols)
        self.ends = np.cumsum(self.lengths, dtype=np.int64)

    @property
    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rules in a row, where each begins)."""
        if not hasattr(self, "_expansions"):
            starts = np.cumsum(self.spans, dtype=np.int64) - self.spans
            flat = np.zeros(int(self.spans.sum()), dtype=np.uint32)
            for k, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
                at = int(starts[k])
                for s in (a, b):
                    if s < self.first_new:
                        flat[at] = s
                        at += 1
                    else:
                        n, own = int(self.spans[s - self.first_new]), int(starts[s - self.first_new])
                        flat[at : at + n] = flat[own : own + n]
                        at += n
            self._expansions = flat, starts
        return self._expansions

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, starts = self.expansions
        symbols = symbols.astype(np.int64)
        new = symbols >= self.first_new
        which = np.where(new, symbols - self.first_new, 0)
        if not len(flat):
            return symbols.astype("<u4")
        lengths = np.where(new, self.spans[which], 1).astype(np.int64)
        # terminals follow the expansions in one table of values
        terminals = symbols[~new].astype(np.uint32)
        begin = np.where(new, starts[which], 0)
        begin[~new] = len(flat) + np.arange(len(terminals))
        return gather(np.concatenate((flat, terminals)), begin, lengths).astype("<u4")

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, expanding only the symbols around it."""
        stop = int(self.ends[k])
        start = stop - int(self.lengths[k])
        a = max(0, int(np.searchsorted(self.before, start, side="right")) - 1) * SKIP
        b = min(len(self.symbols), int(np.searchsorted(self.before, stop, side="left")) * SKIP)
        base = int(self.before[a // SKIP]) if len(self.before) else 0
        return self._expand(self.symbols[a:b])[start - base : stop - base]


def write_token_files(df: DataFrame, vocabulary: str, path: str, shard_ids: int = SHARD_IDS, end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id.

    Ranges of doc_id go to tasks; a task streams its documents into shards of about ``shard_ids``
    ids (a longer document is a shard of its own).  The container has ``part`` and ``shard``
    (both ascending with doc_id), ``first_id``, ``n_docs``, ``n_ids`` and ``payload``.
    """
    types = {"part": pa.int32(), "shard": pa.int32(), "first_id": pa.int64(), "n_docs": pa.int64(), "n_ids": pa.int64(), "payload": pa.binary()}
    schema = "part int, shard int, first_id long, n_docs long, n_ids long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), word_encoder(vocabulary)
        doc_ids: list[int | None] = []
        documents: list[np.ndarray] = []
        held = shards = 0

        def shard() -> pa.RecordBatch:
            nonlocal held, shards
            payload = write_shard(doc_ids, documents, encoder.size)
            out = [[part], [shards], [doc_ids[0]], [len(documents)], [held], [payload]]
            doc_ids.clear(), documents.clear()
            held, shards = 0, shards + 1
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                doc_ids.append(doc_id)
                documents.append(np.append(ids, np.uint32(end_id)))
                held += len(ids) + 1
                if held >= shard_ids:
                    yield shard()
        if documents:
            yield shard()

    # rows that share a doc_id, or have none, are told apart by a hash, so that many of them are many ranges
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    in_batches(ordered.select("doc_id", "text"), run, schema).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (32-bit little-endian) of every document in the files."""
    files = spark.read.parquet(path)
    return _with_starts(_decoded(files), files).select("doc_id", "start", "n_tokens", "ids")


def _decoded(files: DataFrame, digest: bool = False) -> DataFrame:
    """Documents of all shards, with ``inner``: ids before a document within its shard.

    With ``digest`` the ids themselves stay where they are decoded, and their ``ids_crc32`` goes on.
    """
    types = {"part": pa.int32(), "shard": pa.int32(), "doc_id": pa.int64(), "inner": pa.int64(), "n_tokens": pa.int64()}
    types |= {"ids_crc32": pa.int64()} if digest else {"ids": pa.binary()}
    schema = "part int, shard int, doc_id long, inner long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, payload in zip(*(batch.column(n).to_pylist() for n in ("part", "shard", "payload"))):
                read = Shard(payload)
                ids, n = read.ids(), len(read.doc_ids)
                starts = read.ends - read.lengths
                own = [ids[a:b] for a, b in zip(starts.tolist(), read.ends.tolist())]
                out = [[part] * n, [shard] * n, read.doc_ids, starts, read.lengths, [crc_of(i) if digest else i.tobytes() for i in own]]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

    return in_batches(files.select("part", "shard", "payload"), run, schema)


def _with_starts(decoded: DataFrame, files: DataFrame) -> DataFrame:
    """``start``: the ids before a shard (of the parts before, and of those before in its part), and ``inner``."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_part = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before_shard")).join(of_part, "part")
    return decoded.join(bases, ["part", "shard"]).withColumn("start", F.col("before_part") + F.col("before_shard") + F.col("inner"))


def token_file_rows(df: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write token files and return ``doc_id, start, n_tokens, ids_crc32`` read back from them.

    Null text counts as empty (the end id only).  A row without doc_id comes first; rows that
    share one follow each other in an order of their texts; texts are encoded whole, without truncation; an
    empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(df, vocabulary, path)
    files = spark.read.parquet(path)
    # the digest is taken where the ids are decoded, which then cross no border
    return _with_starts(_decoded(files, digest=True), files).select("doc_id", "start", "n_tokens", "ids_crc32")


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
