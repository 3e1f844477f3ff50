"""Token ids of whole texts with a public tokenizer file, inside tasks.

The tokenizers split a text into pieces first and encode each piece by itself,
so the ids of a text are those of its pieces in a row. Pieces repeat, hence a
worker keeps the ids of those it has met (a bounded memo) and hands only new
ones to the library. The pieces are found here with the tokenizer's own
pattern if the text consists of characters on whose classes every Unicode
version agrees (Latin letters, digits, ASCII and general punctuation), in
lower case too where the tokenizer lowers it, and names no special token; any
other text goes to the library whole.

Where a byte-level vocabulary numbers its tokens in the order of their merges,
the numbers are ranks, and such plain texts are encoded by tiktoken over the
same file's vocabulary, without a memo: the ids are the same, in less time.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

MEMO, GROUP = 400_000, 3_000_000  # pieces remembered, characters encoded together
#: The patterns by which the two public tokenizers split a text are
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+ (byte) and
#: 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+ (word). Here they are spelt out for
#: the plain characters: letters, numbers, and white space (tab, line ends, space) among them.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ", "0-9²³¹¼½¾"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
PATTERNS = {
    "byte": f" ?[{_L}]+|{_SHORT}| ?[{_N}]+| ?[^ \t\n\r{_L}{_N}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+",
    "word": f"[{_L}]+|{_SHORT}|[{_N}]|[^ \t\n\r{_L}{_N}]+",
}
PATTERN_BYTE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])
_PLAIN = r"[^\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‧‰-⁞]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def ids_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    if sys.byteorder == "little" and array("I").itemsize == 4:
        return array("I", ids).tobytes()
    return np.array(ids, "<u4").tobytes()


class TextEncoder:
    """texts -> ids (little-endian unsigned 32-bit) exactly as the tokenizers library gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lower = self.spec["normalizer"] is not None
        self.find = re.compile(PATTERNS["word" if self.lower else "byte"]).findall
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.not_plain = re.compile(_PLAIN).search
        # a word's first token begins with the space before it; in the other kind its last one has the word end
        suffix = self.spec["model"]["end_of_word_suffix"]
        self.edge = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.spec["model"]["vocab"].items():
            self.edge[i] = token.endswith(suffix) if suffix else token.startswith("\u0120")
        self.edge_ends = bool(suffix)
        self.memo: dict[str, bytes] = {}
        self.ranked = self._ranked()

    def _ranked(self):
        """The vocabulary as a tiktoken encoding, or None if its numbers are not ranks of merges."""
        model = self.spec["model"]
        vocab = {s: i for s, i in model["vocab"].items() if s not in self.special}
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if self.lower or self.edge_ends or None in merged or merged != sorted(merged) or len(vocab) != 256 + len(merged):
            return None
        import tiktoken

        value = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(value[c] for c in s): i for s, i in vocab.items()}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN_BYTE, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def odd(self, text: str) -> bool:
        """Whether the text has other than plain characters, or a special token."""
        try:
            strange = bool(text.encode("latin-1").translate(None, _PLAIN_BYTES))
        except UnicodeEncodeError:
            strange = self.not_plain(text) is not None
        return strange or any(t in text for t in self.special)

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a plain text; None if the library must take it whole."""
        if self.odd(text):
            return None
        if self.lower:
            low = text.lower()
            # some Latin capitals have their small letter outside the plain range
            return None if low != text and not low.isascii() and self.not_plain(low) else self.find(low)
        return self.find(text)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [ids_bytes(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: list[str]) -> None:
        """Fill the memo with the ids of new pieces."""
        if self.edge_ends:
            words = [p for p in new if p.isalpha()]
            rest, text = [p for p in new if not p.isalpha()], " ".join(words)
        else:
            words = [p for p in new if p[0] == " " and p[1:].isalpha()]
            rest, text = [p for p in new if p[0] != " " or not p[1:].isalpha()], "".join(words)
        if words:  # in one text: the library splits it into these words again, and each word's edge shows
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.edge[ids])
            cut = [0, *(at + 1).tolist()] if self.edge_ends else [*at.tolist(), len(ids)]
            if len(cut) != len(words) + 1 or cut[0] != 0 or cut[-1] != len(ids):
                rest += words
            else:
                data = ids.tobytes()
                self.memo.update((w, data[4 * a : 4 * b]) for w, a, b in zip(words, cut, cut[1:]))
        self.memo.update(zip(rest, self._library(rest), strict=True))

    def whole(self, text: str) -> bytes:
        return self._library([text])[0]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text (null: empty) as bytes."""
        out, group, size = [], [], 0
        if self.ranked is not None:
            return [self.whole(t) if self.odd(t) else ids_bytes(self.ranked(t)) for t in (x or "" for x in texts)]
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size > GROUP:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """A group of texts: each different piece is looked up once, its ids are gathered to all its places."""
        split = [self.pieces(t) for t in texts]
        flat = pa.array(list(chain.from_iterable(s for s in split if s)), pa.string()).dictionary_encode()
        words, place = flat.dictionary.to_pylist(), flat.indices.to_numpy()
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = list(map(self.memo.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self.learn([words[i] for i in new])
            for i in new:
                found[i] = self.memo[words[i]]
        ids = np.frombuffer(b"".join(found), "<u4")
        many = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(many) - many)[place]
        many = many[place]
        ends = np.cumsum(many)
        data = ids[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - first, many)].tobytes()
        at = np.concatenate([[0], ends])[np.cumsum([0, *(len(s or ()) for s in split)])].tolist()
        return [self.whole(t) if s is None else data[4 * a : 4 * b] for t, s, a, b in zip(texts, split, at, at[1:])]


@lru_cache(maxsize=4)
def encoder(path: str, kind: type = TextEncoder) -> TextEncoder:
    """One encoder a worker and file; workers outlive tasks."""
    return kind(path)
