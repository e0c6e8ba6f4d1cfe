"""Similar fingerprints against brute force, with large families."""

import itertools
import random

import pytest

from keyloom.llm import edit_prints


def family_prints():
    rng = random.Random(12)
    texts = []
    for size in (90, 40, 25, 1, 1, 1, 1, 1):
        base = [rng.choice("abcdefgh ij") for _ in range(900)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 14)):
                own[rng.randrange(len(own))] = rng.choice("xyz")
            texts.append("".join(own))
    return [edit_prints.fingerprint(t) for t in texts]


@pytest.mark.parametrize("members", [256, 16])
def test_recall_in_large_families(spark, monkeypatch, members):
    monkeypatch.setattr(edit_prints, "_BLOCK_MEMBERS", members)
    own = family_prints()
    first = {}
    for i, p in enumerate(own):
        first.setdefault(p, i)
    want = {(first[p], first[q]) for p, q in itertools.combinations(first, 2) if edit_prints.likeness(p, q) >= 0.8}
    prints = spark.createDataFrame(list(enumerate(own)), "doc_id long, fingerprint string")
    rows = edit_prints.similar_neighbours(prints).collect()
    found = {(r.a, r.b) for r in rows}
    print("found", len(found), "of", len(want))
    assert len(rows) == len(found) and found <= want and len(found) >= 0.9 * len(want) and len(want) > 500
