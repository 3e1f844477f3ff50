"""Token ids of both encoders against the tokenizers library: every code point of the plain class, and random mixes."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsekit.llm.bpe import BpeEncoder
from pulsekit.llm.tokens import TextEncoder

PLAIN = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F))]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("kind", [TextEncoder, BpeEncoder])
def test_ids_equal_the_library(name, kind):
    path = public_tokenizers.path(name)
    library, enc = Tokenizer.from_file(path), kind(path)
    library.no_truncation()
    library.no_padding()
    rng = random.Random(11)
    letters = [c for c in PLAIN if c.isalpha()]
    texts = [f"a{c}b {c} 1{c}'s {c}{c}" for c in PLAIN]
    texts += ["the Ɗan Ɓala", "ƁƊ", "Ⱥb Ⱦ", "İx", "x" * 20_000, "ab " * 5_000, " " * 3_000, "'S 'Re 'T", "a<|endoftext|>b"]
    for _ in range(15_000):
        pool = rng.choice((PLAIN, letters, "abc XYZ'.1 \n", "ƁƊƎƏƐ Ⱥⱦ éÉßẞ\t"))
        texts.append("".join(rng.choice(pool) for _ in range(rng.randint(1, 25))))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
