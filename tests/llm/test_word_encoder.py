"""The word table of token files: same ids as the library, and a word is looked up once a batch."""

import public_tokenizers

from keyloom.llm.token_files import WordEncoder

ODD = [
    "", " ", "\n a\x1cb c", "a\x85b\xa0c d　e  f ​g", "  lead Éa  trail  ", "naïve ÀÉ ß ÿ ẞ İ x.,",
    "﻿a b", "\x00 \x7f a\tb\vc\fd\re", "日本 語", "é a", "don't I'm [CLS] </w> <unk> [UNK]", "x" * 3000, "ÿ,, À! ö",
]


def test_ids_of_the_library_with_any_white_space():
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in ODD]
    for texts in (ODD, ODD[:1], [], [ODD[2]], ODD):
        assert [x.tolist() for x in encoder.encode(texts)] == [want[ODD.index(t)] for t in texts]


def test_a_word_is_looked_up_once_a_batch():
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.words = Counted()
    assert len({x.tobytes() for x in encoder.encode(["und ja, und nein " * 100] * 20)}) == 1
    assert encoder.words.asked <= 3 + 1  # three words and, maybe, the empty one
