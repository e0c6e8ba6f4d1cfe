"""Large alphabets under a memory limit, and very long runs of key characters in linear time."""

import random
import subprocess
import sys
import time

import numpy as np
import public_tokenizers
import pytest

from keyloom.llm import language_id, secret_scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCRIPTS = {
    "chinese": (0x4E00, 0x9FFF), "thai": (0x0E01, 0x0E2E), "hangul": (0xAC00, 0xD7A3), "letters": (0x00C0, 0x2FFFF),
}

UNDER_LIMIT = """
import random, resource, sys
import numpy, pyarrow
sys.path.insert(0, {root!r})
from keyloom.llm import language_id
rng, letters = random.Random(3), [chr(c) for c in range({first}, {last} + 1) if chr(c).isalpha()]
texts = ["".join(rng.choice(letters) + " " * (rng.random() < 0.2) for _ in range(340)) for _ in range(2048)]
used = int(open("/proc/self/statm").read().split()[0]) * resource.getpagesize()
resource.setrlimit(resource.RLIMIT_AS, (used + (1 << 30), used + (1 << 30)))
vectors, sizes = language_id.profiles(texts, language_id.DIMENSIONS, language_id.SEED)
assert vectors.shape == (2048, 512) and (sizes > 0).all()
"""


@pytest.mark.parametrize("script", SCRIPTS)
def test_large_alphabets_fit(script):
    first, last = SCRIPTS[script]
    root = language_id.__file__.rsplit("/", 3)[0]
    code = UNDER_LIMIT.format(root=root, first=first, last=last)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"})
    assert done.returncode == 0, done.stderr[-800:]


def plain_profile(text, dimensions, seed):
    out, words = np.zeros(dimensions), "".join(c if c.isalpha() else " " for c in text.lower()).split()
    joined = [0, *(ord(c) for c in " ".join(words)), 0] if words else []
    joined = [0 if c == 32 else c for c in joined]
    for a, b, c in zip(joined, joined[1:], joined[2:]):
        if b:
            # the last letter of the three is not rotated
            vectors = [np.roll(language_id._letter_vector(x, dimensions, seed), place).astype(int) for place, x in enumerate((c, b, a))]
            out += vectors[0] * vectors[1] * vectors[2]
    return out


@pytest.mark.parametrize("cells", [0, 1 << 30])
def test_profiles_are_sums_of_bound_letters(monkeypatch, cells):
    monkeypatch.setattr(language_id, "_DENSE_CELLS", cells)
    monkeypatch.setattr(language_id, "_SLICE", 7)
    texts = ["The cat's hat, the cat.", "", "日本語 の テキスト", "  ... 12", "a", "ÄÖ ß"]
    found, sizes = language_id.profiles(texts, 64, 5)
    for text, own, size in zip(texts, found, sizes):
        np.testing.assert_array_equal(own, plain_profile(text, 64, 5))
        assert (size > 0) == any(c.isalpha() for c in text)


def test_pieces_have_the_grams_of_the_text(monkeypatch):
    monkeypatch.setattr(language_id, "_PIECE", 50)
    rng = random.Random(2)
    for text in ("".join(rng.choice("abc  .é") for _ in range(1000)), "x" * 500, "", " " * 400):
        cut = list(language_id.pieces(text))
        assert "".join(cut) == text
        whole, _ = language_id.profiles([text], 64, 5)
        np.testing.assert_array_equal(whole, sum(language_id.profiles([p], 64, 5)[0] for p in cut))
    assert len(list(language_id.pieces("word " * 300))) > 10


def runs(n):
    rng = random.Random(n)
    key = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n // 2))
    readable = ("".join(rng.choice(("Configuration", "Document", "Internal", "Service", "production")) for _ in range(n // 10)))[: n // 2]
    mixed = "".join(readable[i : i + 200] + key[i : i + 30] for i in range(0, n // 2, 200))
    return {"readable then key": readable + key[:40], "mixed": mixed, "parts": "/".join(mixed[i : i + 900] for i in range(0, len(mixed), 900)), "one letter": "x" * n + "Q7"}


@pytest.mark.parametrize("kind", runs(100))
def test_run_of_a_megabyte(kind):
    encoder = secret_scan.rank_encoder(RANKS, public_tokenizers.PATTERN)
    text = runs(1_000_000)[kind]
    began = time.process_time()
    found = secret_scan.random_spans(text, encoder)
    assert time.process_time() - began < 20
    assert (len(found) > 0) == (kind != "one letter")
    assert all(0 <= a < b <= len(text) for a, _, b in found) and found == sorted(found)


# an independent finder of base spans: no regular expressions over the text
def plain_base(text):
    out, key = [], set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    at = 0
    while at < len(text):
        found = None
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(name, at):
                ways = [at + len(name)]
                ways = [w + 1 for w in ways if text[w : w + 1] in ('"', "'") and text[w : w + 1]] + ways
                for w in ways:
                    while text[w : w + 1] == " ":
                        w += 1
                    if text[w : w + 1] not in (":", "=") or not text[w : w + 1]:
                        continue
                    w += 1
                    while text[w : w + 1] == " ":
                        w += 1
                    for start in ([w + 1] if text[w : w + 1] in ('"', "'") and text[w : w + 1] else []) + [w]:
                        end = start
                        while end < len(text) and text[end] in key:
                            end += 1
                        if end > start:
                            found = (start, end)
                            break
                    if found:
                        break
            if found:
                break
        if found:
            if found[1] - found[0] >= 6:
                out.append((at, 0, found[1]))
            at = found[1]
        else:
            at += 1
    for kind, letters, least, head in ((1, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20, "AKIA"), (2, set("0123456789abcdef"), 24, "")):
        at = 0
        while at < len(text):
            if text.startswith(head, at) and text[at] in letters:
                end = at + len(head)
                while end < len(text) and text[end] in letters:
                    end += 1
                if end - at >= least and end > at + len(head):
                    out.append((at, kind, end))
                at = max(end, at + 1) if end > at + len(head) or not head else at + 1
            else:
                at += 1
    return sorted(out)


def test_base_spans_against_a_plain_finder():
    rng = random.Random(11)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", ":", "=", " ", "  ", "'", '"', "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef", "0123456789abcdef", "xYz+/_.=-", "\n", "é", "K"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert secret_scan.base_spans(text) == plain_base(text), text


def test_base_spans_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    found = [(secret_scan.base_spans(r.text), plain_base(r.text)) for r in docs]
    assert all(a == b for a, b in found) and sum(len(a) for a, _ in found) > 10
