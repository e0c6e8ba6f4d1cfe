"""Token counts of every prefix by dynamic programming.

A byte-pair encoder has one property that makes prefixes cheap: in the encoding of a text every
two adjacent tokens are also the encoding of their own two-token string, and only one encoding
has that property.  So the last token of each prefix follows from the last tokens of shorter
prefixes: it is the one vocabulary piece that ends there and fits behind the last token of what
is before it.  The count of a prefix is the count of what is before its last token, plus one.
The table of these counts answers every truncation and budget question about a text without
encoding anything again.

No piece of the vocabulary has a space mark behind another character, none has a line feed, and
certain marks follow no letter within a piece.  Stretches between those places are therefore
independent; each distinct stretch is solved once per worker (bounded memory), in sorted order so
that shared beginnings are solved once, and a text's table is the running sum over its stretches.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from keyloom.llm.common import blocks, in_batches, texts_of

SPACE = "▁"
_MARKS = ".,;:!?|%&$#*"
_CACHED_CHARS = 48
_CACHED_STRETCHES = 1_200_000
_CACHED_PAIRS = 1_000_000


class PrefixCounter:
    """Prefix counts under a piece model with byte fallback (``.model`` files)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        # longest piece with these last three characters; others have at most two
        self.reach: dict[str, int] = {}
        for piece in self.score:
            if len(piece) > 2:
                self.reach[piece[-3:]] = max(len(piece), self.reach.get(piece[-3:], 0))
        # a mark is a border only if no piece has it behind a letter
        marks = "".join(m for m in _MARKS if not any(re.search(rf"[^\W\d_]{re.escape(m)}", p) for p in self.score)) or SPACE
        self.stretches = re.compile(rf"{SPACE}*[^\W\d_]++(?=[{re.escape(marks)}])|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The encoder's own rule on a short string: best pair first, leftmost among equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, before: str, piece: str) -> bool:
        """Whether ``piece`` can stand behind ``before`` (empty: at the start) in an encoding."""
        pair = (before, piece)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= _CACHED_PAIRS:
                self.fits.clear()
            known = self.fits[pair] = self.merged(before + piece) == [p for p in pair if p]
        return known

    def solve(self, stretches: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each stretch with the change of the token count at each character, as 16-bit integers.

        What a prefix gives depends on nothing behind it, so in sorted order a stretch goes on
        where it parts from the one before.
        """
        score, reach, fits = self.score, self.reach, self.fits
        before, last, count, out = "", [""], [0], array("h")
        for stretch in sorted(stretches):
            size, shared = len(stretch), 0
            for a, b in zip(before, stretch):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], count[shared + 1 :], out[shared:]
            for end in range(shared + 1, size + 1):
                far = reach.get(stretch[end - 3 : end], 2)
                for start in range(end - far if end > far else 0, end):
                    piece = stretch[start:end]
                    if piece in score:
                        fit = fits.get((last[start], piece))
                        if fit or fit is None and self.follows(last[start], piece):
                            last.append(piece)
                            count.append(count[start] + 1)
                            break
                else:
                    # a character outside the vocabulary: one token per byte, and a barrier
                    last.append("")
                    count.append(count[-1] + len(stretch[end - 1].encode()))
                out.append(count[end] - count[end - 1])
            before = stretch
            yield stretch, out.tobytes()

    def all_changes(self, texts: list[str]) -> list[np.ndarray]:
        """Change of the count at each character of each text: the stored tables."""
        cut = [self.stretches(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        met = set().union(*cut)
        known, passing = self.known, []
        new = [s for s in met if s not in known]
        if len(known) + len(new) > _CACHED_STRETCHES:
            # a table that is emptied now would lose what these texts need
            known.clear()
            new = list(met)
        for stretch, steps in self.solve(new):
            known[stretch] = steps
            if len(stretch) > _CACHED_CHARS:
                passing.append(stretch)
        tables = [self._joined(map(known.__getitem__, c)) for c in cut]
        for stretch in passing:
            del known[stretch]
        return tables

    @staticmethod
    def _joined(steps: Iterable[bytes]) -> np.ndarray:
        out = np.frombuffer(b"".join(steps), dtype="<i2").copy()
        if not len(out):
            return out
        out[1] += out[0]
        return out[1:]

    def changes(self, text: str) -> np.ndarray:
        return self.all_changes([text])[0]

    def counts(self, text: str) -> np.ndarray:
        """Exact number of tokens of ``text[:i]`` for every ``i`` from 0 to its length."""
        return prefix_counts(self.changes(text))


def prefix_counts(changes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(changes, dtype=np.int64)))


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_tables(df: DataFrame, model_path: str, limit: int = 4096, keep_table: bool = True) -> DataFrame:
    """Per document its token count, what fits into ``limit`` tokens, and its prefix table.

    Returns ``doc_id, n_bytes, n_chars, n_tokens, over_limit, fit_chars`` (characters of the
    longest prefix with at most ``limit`` tokens) and, with ``keep_table``, ``prefix_table``: the
    compressed 16-bit changes of the count from prefix to prefix, read by ``tokens_before`` and
    ``fits``.

    Null text counts as empty (no tokens); a null doc_id and repeated rows stay as they are, one
    row out for one row in; texts of any length are taken whole; an empty table gives no rows;
    only ``doc_id`` and ``text`` are read, so other columns of any name do no harm.
    """
    types = {
        "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_chars": pa.int64(), "n_tokens": pa.int64(),
        "over_limit": pa.bool_(), "fit_chars": pa.int64(),
    }
    schema = "doc_id long, n_bytes long, n_chars long, n_tokens long, over_limit boolean, fit_chars long"
    if keep_table:
        types["prefix_table"] = pa.binary()
        schema += ", prefix_table binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in (b for whole in batches for b in blocks(whole)):
            out: dict[str, list] = {n: [] for n in types}
            out["doc_id"] = batch.column("doc_id").to_pylist()
            texts = texts_of(batch)
            for text, changes in zip(texts, model.all_changes(texts)):
                counts = prefix_counts(changes)
                out["n_bytes"].append(len(text.encode()))
                out["n_chars"].append(len(text))
                out["n_tokens"].append(int(counts[-1]))
                out["over_limit"].append(bool(counts[-1] > limit))
                out["fit_chars"].append(longest_within(counts, limit))
                if keep_table:
                    out["prefix_table"].append(pack(changes.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in types.items()], names=list(types))

    return in_batches(df.select("doc_id", "text"), run, schema)


def _counts_in(table: bytes) -> np.ndarray:
    return prefix_counts(np.frombuffer(zstandard.decompress(table) if table else b"", dtype="<i2"))


def tokens_before(table: str, n_chars: str | Column) -> Column:
    """Exact tokens of the first ``n_chars`` characters, from the stored table; null for nulls."""

    @F.pandas_udf("long")
    def read(tables, places):
        import pandas as pd

        return pd.Series([None if t is None or pd.isna(n) else int(_counts_in(t)[min(max(int(n), 0), len(_counts_in(t)) - 1)]) for t, n in zip(tables, places)], dtype="Int64")

    return read(F.col(table), n_chars if isinstance(n_chars, Column) else F.col(n_chars))


def fits(table: str, budget: int) -> Column:
    """Characters of the longest prefix within ``budget`` tokens, from the stored table."""

    @F.pandas_udf("long")
    def read(tables):
        import pandas as pd

        return pd.Series([None if t is None else longest_within(_counts_in(t), budget) for t in tables], dtype="Int64")

    return read(F.col(table))
