"""Random keys behind readable text in one run of key characters."""

import random
import string

import public_tokenizers
import pytest

from keyloom.llm import secret_scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BASE62 = string.ascii_letters + string.digits


@pytest.mark.parametrize("readable", ["/home/user/projects/service/configuration/production/credentials/", "documents/internal/reports/archive/customer/account=", "internal_service_production_account_credential_name_"])
@pytest.mark.parametrize("letters", [BASE62, BASE62 + "+/", BASE62 + "-_", string.ascii_letters])
@pytest.mark.parametrize("length", [20, 32, 40])
def test_keys_behind_text(readable, letters, length):
    encoder = secret_scan.rank_encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(60):
        key = "".join(rng.choice(letters) for _ in range(length))
        for text in (key, readable + key, f"see {readable}{key}/internal/documents now"):
            at = text.index(key)
            spans = secret_scan.random_spans(text, encoder)
            covered = sum(max(0, min(end, at + length) - max(start, at)) for start, _, end in spans)
            assert 2 * covered >= length, (text, spans)
            if readable in text and letters == BASE62 and length == 20:
                assert spans == [(at, 3, at + length)]


def test_readable_runs_and_known_forms_stay_out():
    encoder = secret_scan.rank_encoder(RANKS, public_tokenizers.PATTERN)
    for text in (
        "/home/user/projects/service2/configuration/production/credentials", "InternationalizationOfLongNamesFactory",
        "files/documents/123e4567-e89b-12d3-a456-426614174000/internal/configuration/of/documents",
        "internal/configuration/of/documents/da39a3ee5e6b4b0d3255bfef95601890afd80709/configuration/production", "internal/configuration/reports/2024-01-15/2024-02-15/documents/production/credentials",
    ):
        assert secret_scan.random_spans(text, encoder) == [], text
