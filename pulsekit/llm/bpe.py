"""Exact byte-pair encoding by backtracking, and decoding by an offset table (operator 9).

A sequence of tokens is the byte-pair encoding of a word exactly if each token
encodes its own string as itself and each neighbouring pair is compatible,
which means that the two tokens' joined string encodes as just these two. The
encoder takes the longest token at the current place (all found by one pass of
an Aho-Corasick automaton over the reversed word), falls back to the next
shorter prefix token while the pair is incompatible, and steps back if none is
left. A place from which no continuation exists is marked and not tried again,
so the work is linear in the word. Pair compatibility is a table that is filled
as pairs turn up.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from pulsekit.llm.tokens import TextEncoder, byte_symbols, ids_bytes

_END = 0xE000  # a word's last symbol is a symbol of its own


class BackTrackingBpe:
    """Words (in byte symbols) -> ids; ids -> text."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None, special: dict[str, int]):
        import ahocorasick

        self.suffix = suffix
        self.ids = {self._marked(s): i for s, i in vocab.items() if i not in special.values()}
        self.text = {i: s for s, i in self.ids.items()}
        self.rank = {}
        for r, m in enumerate(merges):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[(self._marked(a), self._marked(b))] = r
        self.find = ahocorasick.Automaton()
        for s, i in self.ids.items():
            self.find.add_word(s[::-1], i)
        self.find.make_automaton()
        self.length = {i: len(s) for s, i in self.ids.items()}
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in special.items()}
        blob = [names.get(i, "").encode("utf-8") for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.size = np.array([len(b) for b in blob], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.compatible = lru_cache(maxsize=1 << 18)(self._compatible)
        self.sound = lru_cache(maxsize=1 << 17)(lambda t: self.merged(self.text[t]) == [t])
        self.shorter = lru_cache(maxsize=1 << 17)(self._shorter)

    def _marked(self, s: str) -> str:
        if self.suffix and s.endswith(self.suffix) and len(s) > len(self.suffix):
            s = s[: -len(self.suffix)]
            return s[:-1] + chr(_END + ord(s[-1]))
        return s

    def merged(self, word: str) -> list[int]:
        """The definition: merge the pair of lowest rank, leftmost first, until none is left."""
        parts = list(word)
        while len(parts) > 1:
            best = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts]

    def _compatible(self, a: int, b: int) -> bool:
        return self.merged(self.text[a] + self.text[b]) == [a, b]

    def _shorter(self, token: int) -> int | None:
        s = self.text[token]
        return next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), None)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one piece, given in byte symbols (not empty)."""
        if self.suffix:
            word = word[:-1] + chr(_END + ord(word[-1]))
        n, longest = len(word), {}
        for end, token in self.find.iter(word[::-1]):
            at = n - 1 - end
            if at not in longest or self.length[token] > self.length[longest[at]]:
                longest[at] = token
        out: list[int] = []
        dead, at, token = set(), 0, longest.get(0)
        while at < n:
            while token is not None and (
                at + self.length[token] in dead or not self.sound(token) or out and not self.compatible(out[-1], token)
            ):
                token = self.shorter(token)
            if token is None:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of this word")
                dead.add(at)
                at -= self.length[out[-1]]
                token = self.shorter(out.pop())
            else:
                out.append(token)
                at += self.length[token]
                token = longest.get(at)
        return out

    def decode(self, ids: np.ndarray, joiner: bytes = b" ") -> str:
        """Text of the ids by the offset table; without a decoder the tokens are joined by one space."""
        if not len(ids):
            return ""
        size = self.size[ids] + len(joiner)
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) - np.repeat(ends - size - self.start[ids], size)
        out = self.blob[np.minimum(place, len(self.blob) - 1)]
        for k in range(len(joiner)):
            out[ends - len(joiner) + k] = joiner[k]
        return out[: len(out) - len(joiner)].tobytes().decode("utf-8", "replace")


class BpeEncoder(TextEncoder):
    """A :class:`TextEncoder` whose pieces are encoded by :class:`BackTrackingBpe`."""

    def __init__(self, path: str):
        import regex

        super().__init__(path)
        self.ranked = None  # pieces are encoded here
        model = self.spec["model"]
        self.bpe = BackTrackingBpe(model["vocab"], model["merges"], model["end_of_word_suffix"], self.special)
        symbols = byte_symbols()
        self.symbols = {b: symbols[b] for b in range(256)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _bytes(self, piece: str) -> str:
        return piece.encode("utf-8").decode("latin-1").translate(self.symbols)

    def learn(self, new: list[str]) -> None:
        for p in new:
            self.memo[p] = ids_bytes(self.bpe.encode_word(self._bytes(p)))

    def whole(self, text: str) -> bytes:
        """Special tokens stand for themselves; the rest is normalised and cut by the library, encoded here."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                if self.library.normalizer is not None:
                    part = self.library.normalizer.normalize_str(part)
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(part):
                    out += self.bpe.encode_word(piece)
        return ids_bytes(out)
