"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  The vector of an n-gram binds the vectors of its
letters, each rotated by its place; a document bundles (adds up) the vectors of its n-grams and a
language prototype bundles those of its labelled documents.  The prediction is the prototype
with the largest cosine.

The prototypes are built from n-gram counts per language: tasks count, Spark adds the counts up,
and each distinct (language, n-gram) is bound once.  What reaches the driver is one vector per
language.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keyloom.llm.common import blocks, fold, in_batches, record, texts_of

DIMENSIONS = 512
ORDER = 3
SEED = 20_011
UNKNOWN = "und"
_BLOCK_BYTES = 2 << 20
_COUNTED_GRAMS = 400_000
_BITS = 21  # of a code point
#: Cells of a dense table of counts, n-grams whose vectors are held at once, and characters of a piece of a text.
_DENSE_CELLS = 4 << 20
_SLICE = 8192
_PIECE = 1 << 20


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=20_000)
def _letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The same for a letter everywhere; code 0 is the gap between words."""
    return (np.random.default_rng([seed, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Bind the rotated letter vectors of packed n-grams; one float row per n-gram."""
    out = np.ones((len(grams), dimensions), dtype=np.int8)
    for place in range(ORDER):
        codes, which = np.unique((grams >> (_BITS * place)) & ((1 << _BITS) - 1), return_inverse=True)
        letters = np.array([_letter_vector(int(c), dimensions, seed) for c in codes], dtype=np.int8).reshape(-1, dimensions)[which]
        turn = place % dimensions
        out[:, turn:] *= letters[:, : dimensions - turn]
        out[:, :turn] *= letters[:, dimensions - turn :]
    return out.astype(np.float32)


def pieces(text: str) -> Iterator[str]:
    """The text cut between words into pieces of about ``_PIECE`` characters: their n-grams are those of the text.

    A word that is longer than that is not cut.
    """
    start, end = 0, len(text)
    while end - start > 2 * _PIECE:
        at = start + _PIECE
        while at < end and text[at].isalpha():
            at += 1
        yield text[start:at]
        start = at
    yield text[start:]


def profiles(texts: list[str], dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(bundled vectors, number of n-grams) per text.

    Few different n-grams: a dense table of counts times their vectors.  Many, as in scripts of
    thousands of letters: the vectors of a slice of (text, n-gram) pairs at a time, added up by
    text, so that memory follows the slice.
    """
    n = len(texts)
    grams, which, owner = letter_grams(texts)
    if not len(grams):
        return np.zeros((n, dimensions), np.float32), np.zeros(n, np.int64)
    size = np.bincount(owner, minlength=n)
    if n * len(grams) <= _DENSE_CELLS:
        counts = np.bincount(owner * len(grams) + which, minlength=n * len(grams)).reshape(n, -1).astype(np.float32)
        out = np.zeros((n, dimensions), np.float32)
        for at in range(0, len(grams), _SLICE):
            out += counts[:, at : at + _SLICE] @ gram_vectors(grams[at : at + _SLICE], dimensions, seed)
        return out, size
    pairs, often = np.unique(owner * len(grams) + which, return_counts=True)
    out = np.zeros((n, dimensions), np.float32)
    for at in range(0, len(pairs), _SLICE):
        some = pairs[at : at + _SLICE]
        text, gram = np.divmod(some, len(grams))
        vectors = gram_vectors(grams[gram], dimensions, seed) * often[at : at + _SLICE, None].astype(np.float32)
        begin = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[begin]] += np.add.reduceat(vectors, begin, axis=0)
    return out, size


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed n-grams, their number per occurrence, text per occurrence).

    Letters are lower-cased; anything else is a gap, and gaps are joined.  Every word
    contributes n-grams that reach over its borders, so a word of one letter has one too.
    """
    joined = "\n\n".join(["", *(t.lower() for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.zeros(len(codes), dtype=np.int32)
    at = 2
    for number, text in enumerate(texts):
        stop = at + len(text.lower()) + 2
        owner[at:stop] = number
        at = stop
    letters = np.where(_is_letter()[codes], codes, 0)
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    keep[0] = True
    letters, owner = letters[keep], owner[keep]
    seen = np.zeros(0x110000, dtype=bool)
    seen[letters] = True
    alphabet = np.flatnonzero(seen)
    number_of = np.zeros(0x110000, dtype=np.int32)
    number_of[alphabet] = np.arange(len(alphabet))
    small, width = number_of[letters].astype(np.int64), len(alphabet)
    if len(small) < ORDER or width < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = (small[:-2] * width + small[1:-1]) * width + small[2:]
    owners = owner[1:-1].astype(np.int64)
    # an n-gram with a gap in its middle belongs to two words
    inner = small[1:-1] != 0
    keys, owners = keys[inner], owners[inner]
    if width**3 <= 1 << 23:
        present = np.zeros(width**3, dtype=bool)
        present[keys] = True
        distinct = np.flatnonzero(present)
        place = np.zeros(width**3, dtype=np.int32)
        place[distinct] = np.arange(len(distinct))
        which = place[keys].astype(np.int64)
    else:
        distinct, which = np.unique(keys, return_inverse=True)
    first, second, third = distinct // (width * width), distinct // width % width, distinct % width
    packed = (alphabet[first] << (2 * _BITS)) | (alphabet[second] << _BITS) | alphabet[third]
    return packed.astype(np.int64), which, owners


def gram_counts(df: DataFrame) -> DataFrame:
    """``lang, gram, n``: n-grams of all texts per language, added up by Spark."""
    types = {"lang": pa.string(), "gram": pa.int64(), "n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, grams in held.items():
                yield record({"lang": [lang] * len(grams), "gram": list(grams), "n": list(grams.values())}, types)
            held.clear()

        for batch in batches:
            for part in blocks(batch, size=_BLOCK_BYTES):
                langs, texts = part.column("lang").to_pylist(), texts_of(part)
                names = sorted(set(langs))
                place = {x: k for k, x in enumerate(names)}
                number = np.array([place[x] for x in langs], dtype=np.int64)
                # a block of one row may be a very long text
                for some in [[x] for x in pieces(texts[0])] if len(texts) == 1 else [texts]:
                    grams, which, owner = letter_grams(some)
                    if not len(grams):
                        continue
                    pairs, often = np.unique(number[owner] * len(grams) + which, return_counts=True)
                    lang, gram = np.divmod(pairs, len(grams))
                    for x, g, n in zip(lang.tolist(), grams[gram].tolist(), often.tolist()):
                        held[names[x]][g] += n
                    if sum(map(len, held.values())) > _COUNTED_GRAMS:
                        yield from flush()
        yield from flush()

    counted = in_batches(df.select("lang", "text"), run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_prototypes(df: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """One bundled vector per language from the rows of ``df`` (``text``, non-null ``lang``).

    All rows count.  The driver gets ``languages x dimensions`` numbers.
    """
    types = {"lang": pa.string(), "place": pa.int32(), "total": pa.float64()}

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            grams, n = batch.column("gram").to_numpy(), batch.column("n").to_numpy().astype(np.float64)
            vectors = gram_vectors(grams, dimensions, seed)
            for lang in sorted(set(langs)):
                mine = langs == lang
                held[lang] = held.get(lang, 0) + n[mine] @ vectors[mine]
        for lang, vector in held.items():
            yield record({"lang": [lang] * dimensions, "place": np.arange(dimensions), "total": vector}, types)

    counts = gram_counts(df.where("lang IS NOT NULL"))
    parts = in_batches(counts, bundle, "lang string, place int, total double")
    out: dict[str, np.ndarray] = {}
    for lang, place, total in parts.groupBy("lang", "place").agg(F.sum("total")).collect():
        out.setdefault(lang, np.zeros(dimensions))[place] = total
    return {lang: out[lang] for lang in sorted(out) if np.any(out[lang])}


def predict_language(df: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` of ``df`` with ``lang_pred`` and ``score`` (the cosine, 0 at least).

    Reads nothing of a row but its text.
    """
    langs = list(prototypes)
    sides = np.array([prototypes[x] / np.linalg.norm(prototypes[x]) for x in langs], dtype=np.float32).reshape(-1, dimensions)
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "__text", size=_BLOCK_BYTES):
                n, texts = part.num_rows, texts_of(part, "__text")
                found = [profiles([x], dimensions, seed) for x in pieces(texts[0])] if n == 1 else [profiles(texts, dimensions, seed)]
                own, with_letters = sum(p for p, _ in found), sum(k for _, k in found) > 0
                names, scores = [UNKNOWN] * n, np.zeros(n)
                if langs:
                    size = np.linalg.norm(own, axis=1)
                    cosines = (own @ sides.T) / np.maximum(size, 1e-9)[:, None]
                    best = cosines.argmax(axis=1)
                    names = [langs[b] if some else UNKNOWN for b, some in zip(best, with_letters)]
                    scores = np.where(with_letters, np.clip(cosines[np.arange(n), best], 0.0, 1.0), 0.0)
                arrays = [part.column(f.name) for f in fields] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*(f.name for f in fields), "lang_pred", "score"])

    return in_batches(df.select(*(f.name for f in fields), F.col("text").alias("__text")), run, schema)


def held_out(parts: int = 4, part: int = 2) -> Column:
    """The fold that is never learned from; a row without identifier is outside it."""
    return F.coalesce(fold("doc_id", parts) == part, F.lit(False))


def identify_languages(df: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``df``.

    Learns from the text and non-null ``lang`` of all rows outside the held-out fold.

    Null or empty text and text without a letter give ``und`` with score 0, as does a table with
    nothing to learn from.  Null doc_id, repeated rows and ties stay rows of their own (equal
    texts get equal answers; among equal cosines the first language in order wins).  Texts are
    taken whole.  Other columns, whatever their names, are not read.
    """
    prototypes = learn_prototypes(df.where(~held_out()).select("lang", "text"))
    named = predict_language(df.select("doc_id", "text"), prototypes)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
