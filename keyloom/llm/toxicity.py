"""Toxic passages as maximum-scoring segments of token log-odds.

Each word has a log-odds score of toxic against clean documents, shrunk by a Dirichlet prior in
proportion to the class sizes; a word that is not in the table has the score of the longest of
its beginnings that is, so that insults are known in forms not seen before.  Words without
evidence score nothing, and a small drift is taken off every word.  One linear scan finds all disjoint maximal-scoring segments of a text.
Extreme-value statistics turn a segment's score into a normalised one that allows for the length
of the text, and the significant segments of a text add up to its evidence.  A logistic curve
fitted on labelled documents makes a probability of the evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keyloom.llm.common import fold, in_batches, texts_of

WORD = re.compile(r"[^\W\d_]+")
#: Labelled documents learned from, at most so many of each class, the first by a hash of doc_id.
LEARNED = 30_000
#: Words of the score table, the most telling ones, and the least z-score and log-odds of one.
TABLE = 50_000
LEAST_Z = 4.0
LEAST_ODDS = 2.0
#: Strength of the prior in documents per word, and what every word costs a segment.
PRIOR = 2.0
DRIFT = 0.05
#: Expected number of equal segments in a random text of that length, below which one counts.
SIGNIFICANT = 0.5
TOXIC = 0.7
#: Lengths of the beginnings that stand for a word, and the mark they carry in the table.
BEGINNINGS = (6, 5, 4)
STEM = "*"
_COUNTED_WORDS = 500_000
_SCORED_WORDS = 500_000


def units_of(word: str) -> list[str]:
    """The word and its beginnings, longest first."""
    return [word, *(word[:n] + STEM for n in BEGINNINGS if len(word) > n)]


class WordScores(dict):
    """Scores of the words met, from the table; emptied when full."""

    def __init__(self, table: dict[str, float]):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        score = next((self.table[u] for u in units_of(word) if u in self.table), 0.0)
        if len(self) >= _SCORED_WORDS:
            self.clear()
        self[word] = score
        return score

    def __reduce__(self):
        return WordScores, (self.table,)


@dataclass(frozen=True)
class ToxicModel:
    """Word scores, extreme-value parameters and the curve; small and sent to the tasks."""

    scores: WordScores
    decay: float
    curve: tuple[float, float]

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Maximal segments as (first word, end, score), in order."""
        found = list(map(self.scores.__getitem__, words))
        return maximal_segments([(i, s - DRIFT) for i, s in enumerate(found) if s], DRIFT)

    def significant(self, words: list[str]) -> list[tuple[int, int, float]]:
        """The segments that chance would give to few texts of this length; scores normalised.

        ``decay * score - log(words)`` follows the extreme-value law, so its expected number of
        exceedances is ``exp(-value)``.
        """
        if not words:
            return []
        base = math.log(len(words))
        found = [(a, b, self.decay * s - base) for a, b, s in self.segments(words)]
        return [x for x in found if math.exp(-x[2]) < SIGNIFICANT]

    def evidence(self, words: list[str]) -> float:
        """Normalised scores of the significant segments, added up on a logarithmic scale."""
        return math.log1p(sum(s for _, _, s in self.significant(words)))

    def probability(self, evidence: float) -> float:
        at = self.curve[0] + self.curve[1] * evidence
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, at))))


def maximal_segments(scored: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All disjoint maximal-scoring segments, in linear time.

    ``scored`` has (place, score) of the places that differ from ``-drift``, in order; the places
    between them only cost.  A candidate joins earlier ones as long as one that began lower has
    ended below its own end.
    """
    # first, end, sum before, sum behind, and which earlier one began lower
    held: list[tuple[int, int, float, float, int]] = []
    total, after = 0.0, 0
    for place, score in scored:
        total -= drift * (place - after)
        before, total, after = total, total + score, place + 1
        if score <= 0:
            continue
        first, low, high = place, before, total
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= low:
                k = held[k][4]
            if k < 0 or held[k][3] >= high:
                break
            first, low = held[k][0], held[k][2]
            del held[k:]
        held.append((first, place + 1, low, high, k))
    return [(a, b, high - low) for a, b, low, high, _ in held]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def training_labels(labels: DataFrame, each: int = LEARNED) -> DataFrame:
    """``label_id, toxic``: at most ``each`` labelled documents per class, outside the held-out fold.

    A document with several labels is toxic if one says so; null labels say nothing.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sides = [known.where(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for side in ("toxic", "NOT toxic")]
    return sides[0].union(sides[1]).select(F.col("doc_id").alias("label_id"), "toxic")


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    # at most 2 * LEARNED rows of nine bytes
    side = F.broadcast(training_labels(labels))
    return df.select("doc_id", "text").join(side, F.col("doc_id") == F.col("label_id")).select("text", "toxic")


def word_totals(labelled: DataFrame) -> DataFrame:
    """``word, toxic_n, clean_n``: documents per class with the word or beginning, counted in tasks and added up by Spark."""
    types = {"word": pa.string(), "toxic_n": pa.int64(), "clean_n": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(held[0].keys() | held[1].keys())
            out = [words, [held[1][w] for w in words], [held[0][w] for w in words]]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

        for batch in batches:
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                held[bool(toxic)].update({u for w in set(words_of(text)) for u in units_of(w)})
                if len(held[0]) + len(held[1]) > _COUNTED_WORDS:
                    yield flush()
        yield flush()

    counted = in_batches(labelled, run, "word string, toxic_n long, clean_n long")
    return counted.groupBy("word").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"))


def word_scores(totals: DataFrame, table: int = TABLE) -> list[tuple[str, float, float]]:
    """(word, log-odds, clean frequency) of the most telling words, at most ``table``.

    The prior adds ``PRIOR`` documents to every word, split between the classes like all words,
    so a word that is as frequent in both classes, or rare, scores about 0 whatever the class
    sizes.  A word counts if its toxic documents are ``LEAST_Z`` deviations from that split and its
    log-odds are at least ``LEAST_ODDS``.
    """
    sums = totals.agg(F.sum("toxic_n"), F.sum("clean_n")).first()
    n1, n0 = float(sums[0] or 0), float(sums[1] or 0)
    if not n1 or not n0:
        return []
    q, n = n1 / (n1 + n0), F.col("toxic_n") + F.col("clean_n")
    odds = F.log((F.col("toxic_n") + PRIOR * q) / q) - F.log((F.col("clean_n") + PRIOR * (1 - q)) / (1 - q))
    z = (F.col("toxic_n") - n * q) / F.sqrt(n * q * (1 - q))
    told = totals.select("word", odds.alias("odds"), z.alias("z"), ((F.col("clean_n") + PRIOR * (1 - q)) / n0).alias("clean"))
    best = told.where((F.abs("z") >= LEAST_Z) & (F.abs("odds") >= LEAST_ODDS)).orderBy(F.abs("z").desc(), "word").limit(table)
    return [(r.word, r.odds, r.clean) for r in best.collect()]


def decay_of(scored: list[tuple[str, float, float]]) -> float:
    """The positive root of the clean words' exponential moment: the decay of segment scores."""
    rest = max(0.0, 1.0 - sum(p for _, _, p in scored))
    odds, share = np.array([s for _, s, _ in scored]), np.array([p for _, _, p in scored])

    def moment(x: float) -> float:
        return float(share @ np.exp(x * (odds - DRIFT)) + rest * math.exp(-x * DRIFT))

    low, high = 0.0, 1.0
    while moment(high) < 1.0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 1.0 else (low, mid)
    return max(high, 1e-3)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature, with a weak pull that keeps the curve finite."""
    at = np.stack([np.ones_like(evidence), evidence], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ beta, -500, 500)))
        step = np.linalg.solve((at * (p * (1 - p))[:, None]).T @ at + 0.05 * np.eye(2), at.T @ (toxic - p) - 0.05 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def learn_toxicity(df: DataFrame, labels: DataFrame) -> ToxicModel:
    """Word scores and the curve from the labelled rows of ``df`` outside the held-out fold."""
    labelled = _labelled(df, labels)
    scored = word_scores(word_totals(labelled))
    model = ToxicModel(WordScores({w: s for w, s, _ in scored}), decay_of(scored) if scored else 1.0, (0.0, 0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.evidence(words_of(t)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column("toxic")], names=["evidence", "toxic"])

    # at most 2 * LEARNED pairs of numbers
    pairs = in_batches(labelled, run, "evidence double, toxic boolean").toPandas().sort_values(["evidence", "toxic"])
    curve = fit_curve(pairs["evidence"].to_numpy(dtype=float), pairs["toxic"].to_numpy(dtype=float)) if len(pairs) else (0.0, 0.0)
    return ToxicModel(model.scores, model.decay, curve)


def held_out(parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(fold("doc_id", parts) == part, F.lit(False))


def score_toxicity(df: DataFrame, model: ToxicModel, passages: bool = False) -> DataFrame:
    """``doc_id, score, predicted, n_passages`` and, on request, the ``passages`` themselves.

    Passages are (start, end, score) in code points; reads nothing of a row but its text.
    """
    types = {"doc_id": pa.int64(), "score": pa.float64(), "predicted": pa.int32(), "n_passages": pa.int64()}
    schema = "doc_id long, score double, predicted int, n_passages long"
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    if passages:
        types["passages"], schema = passage, schema + ", passages array<struct<start: bigint, end: bigint, score: double>>"
    context = df.sparkSession.sparkContext.broadcast(model)  # at most TABLE words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = context.value
        for batch in batches:
            out: dict[str, list] = {n: [] for n in types}
            out["doc_id"] = batch.column("doc_id").to_pylist()
            for text in texts_of(batch):
                words = words_of(text)
                found = model.significant(words)
                score = model.probability(math.log1p(sum(s for _, _, s in found)))
                out["score"].append(score)
                out["predicted"].append(int(score >= TOXIC))
                out["n_passages"].append(len(found))
                if passages:
                    at = [m.span() for m in WORD.finditer(text.lower())] if found else []
                    out["passages"].append([{"start": at[a][0], "end": at[b - 1][1], "score": s} for a, b, s in found])
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in types.items()], names=list(types))

    return in_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def assess_toxicity(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` for every row of ``df``.

    Null and empty text has no passage and gets the score of no evidence, as does every text if
    nothing can be learned (score 0.5 then).  Repeated rows and null doc_ids stay rows of their
    own; texts are scanned whole; an empty table gives no rows; other columns are not read.
    """
    model = learn_toxicity(df, labels)
    return score_toxicity(df, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_passages")
