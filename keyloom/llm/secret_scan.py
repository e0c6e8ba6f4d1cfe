"""Secret scan: fixed patterns, and random strings found by token efficiency.

Text written by people is in a tokenizer's vocabulary: it takes few tokens.  Random strings are
not: they take about a token for every one or two characters.  A long run of key characters
whose characters-per-token ratio is low is therefore reported, unless its form is that of a
known digest or identifier.  Of a run that is readable as a whole, the parts between '/', '=',
'_' and '-' are judged by themselves, and then every stretch of tokens in what is left, so a key
behind a path or a name is found too.  The pattern matches are reported whatever their ratio.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from keyloom.llm.common import in_batches, texts_of

# The kinds in their order, the base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
#: Runs are maximal, so asking for the least length at once finds the same matches.
HEX = re.compile(r"[0-9a-f]{24,}")

#: Token efficiency: runs of at least so many characters, with fewer characters per token.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_RATIO = 2.1
#: Forms of digests and identifiers that look random and are no secrets.
KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"  # MD5, SHA-1, SHA-2
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # UUID
    r"|(?:sha1|sha256|sha384|sha512)-[A-Za-z0-9+/]+=*"  # subresource digests
    r"|[0-9+/_=-]+)"  # numbers, dates, rules
)
#: A digit and a letter, or letters of both cases.
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])|(?=.*[a-z])(?=.*[A-Z])")
LEAST_LENGTH = 20
#: A stretch that is twice the least length has a random one within it, so no longer ones are looked at.
_WIDEST = 64
#: Numbers and dates of so many characters are no part of a key.
_NUMBERS = 8
_PART = re.compile(r"[A-Za-z0-9+]{20,}")
_BREAK = re.compile(r"[/=_-]")
_DIGITS, _LOWER, _UPPER = frozenset("0123456789"), frozenset("abcdefghijklmnopqrstuvwxyz"), frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_KNOWN_WITHIN = re.compile(rf"(?<![A-Za-z0-9])(?:{KNOWN.pattern})(?![A-Za-z0-9])")


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _is_random(part: str, encoder, least_ratio: float) -> bool:
    return bool(_MIXED.match(part)) and not KNOWN.fullmatch(part) and len(part) < least_ratio * len(encoder.encode_ordinary(part))


def _gaps(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of ``start:end`` no taken span covers, if long enough."""
    out = []
    for a, b in [*sorted(taken), (end, end)]:
        if a - start >= LEAST_LENGTH:
            out.append((start, a))
        start = max(start, b)
    return out


def _tokens(text: str, encoder) -> tuple[list[int], list[int]]:
    """(where tokens begin, where they end) in a text of ASCII characters."""
    ends = list(accumulate(map(len, encoder.decode_tokens_bytes(encoder.encode_ordinary(text)))))
    return [0, *ends[:-1]], ends


def _stretches(text: str, starts: list[int], ends: list[int], least_ratio: float) -> list[tuple[int, int]]:
    """Disjoint stretches of tokens of the least length or more that are random; the most random of those that meet."""
    found = []
    for i, a in enumerate(starts):
        for j in range(bisect_left(ends, a + LEAST_LENGTH), len(ends)):
            b = ends[j]
            if b - a > _WIDEST:
                break
            gain = least_ratio * (j - i + 1) - (b - a)
            if gain > 0 and _MIXED.match(text, a, b):
                found.append((-gain, a, b))
    spans: list[tuple[int, int]] = []
    for _, a, b in sorted(found):
        at = bisect_left(spans, (a, b))
        if (at == 0 or spans[at - 1][1] <= a) and (at == len(spans) or b <= spans[at][0]):
            spans.insert(at, (a, b))
    return spans


class _Stretch:
    """A stretch of key characters, encoded once: what any part of it holds is the difference of two counts."""

    def __init__(self, text: str, encoder):
        self.text = text
        self.starts, self.ends = _tokens(text, encoder)
        self.breaks = [m.start() for m in _BREAK.finditer(text)]
        self.counts = [[0, *accumulate(map(kind.__contains__, text))] for kind in (_DIGITS, _LOWER, _UPPER)]

    def is_random(self, a: int, b: int, least_ratio: float) -> bool:
        digits, lower, upper = (c[b] > c[a] for c in self.counts)
        if not ((digits and (lower or upper)) or (lower and upper)):
            return False
        tokens = bisect_left(self.starts, b) - bisect_right(self.ends, a)
        return b - a < least_ratio * tokens and not KNOWN.fullmatch(self.text, a, b)

    def random_parts(self, least_ratio: float) -> Iterator[tuple[int, int]]:
        """Its random stretches, each with the whole part between '/', '=', '_', '-' that it begins or ends in, if that is random with it."""
        for x, y in _stretches(self.text, self.starts, self.ends, least_ratio):
            before, behind = bisect_left(self.breaks, x), bisect_left(self.breaks, y)
            left = self.breaks[before - 1] + 1 if before else 0
            right = self.breaks[behind] if behind < len(self.breaks) else len(self.text)
            left = left if self.is_random(left, y, least_ratio) else x
            yield left, right if self.is_random(left, right, least_ratio) else y


def _within(run: str, encoder, least_ratio: float) -> list[tuple[int, int]]:
    """The random pieces of a run that is not random as a whole; every character is encoded twice at most."""
    known = [m.span() for m in _KNOWN_WITHIN.finditer(run) if _MIXED.match(m.group()) or len(m.group()) >= _NUMBERS]
    found: list[tuple[int, int]] = []
    for a, b in _gaps(0, len(run), known):
        for m in _PART.finditer(run, a, b):
            if _is_random(m.group(), encoder, least_ratio):
                found.append(m.span())
    for a, b in _gaps(0, len(run), known + found):
        found += [(a + x, a + y) for x, y in _Stretch(run[a:b], encoder).random_parts(least_ratio)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def random_spans(text: str, encoder, least_ratio: float = LEAST_RATIO) -> list[tuple[int, int, int]]:
    """Runs of key characters that take many tokens for their length, or the pieces of a run that do."""
    found = []
    for m in RUN.finditer(text):
        run, at = m.group(), m.start()
        if KNOWN.fullmatch(run) or not _MIXED.match(run):
            continue
        if _is_random(run, encoder, least_ratio):
            found.append((at, 3, m.end()))
        else:
            found += [(at + a, 3, at + b) for a, b in _within(run, encoder, least_ratio)]
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(df: DataFrame, ranks_path: str, pattern: str, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row.

    ``spans`` lists all findings as ``kind:start:end`` by start, then kind; places count code
    points and ends are exclusive.  ``base_sha256`` is the digest of the same list without the
    ``random`` ones.

    Null text counts as empty (no spans, the digest of the empty list).  Texts are scanned whole,
    whatever their length; null doc_id and repeated rows stay rows of their own; an empty table
    gives no rows; other columns are not read.
    """
    types = {
        "doc_id": pa.int64(), "n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "n_random": pa.int64(),
        "base_sha256": pa.string(), "spans": pa.string(),
    }
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks_path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                base = base_spans(text)
                more = random_spans(text, encoder, least_ratio)
                kinds = [k for _, k, _ in base]
                rows.append((
                    doc_id, kinds.count(0), kinds.count(1), kinds.count(2), len(more),
                    hashlib.sha256(written(base).encode()).hexdigest(), written(sorted(base + more)),
                ))
            columns = zip(*rows) if rows else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types.values())], names=list(types))

    return in_batches(df.select("doc_id", "text"), run, schema)
