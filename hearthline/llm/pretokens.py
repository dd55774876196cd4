"""Encoding with the tokenizers library, each distinct pre-token once.

The library's byte-level pre-tokenisation costs far more than looking up a word that was seen
before. So the texts of a batch are cut into pre-tokens at once by numpy, which asks the library
what kind a character is; every distinct pre-token is encoded by the library's model, and its ids
are kept for the next batches. Pre-tokens are told apart by a hash and then compared. Texts are parted at the tokenizer's added tokens first. The ids equal
those of encoding the whole texts.
"""

from __future__ import annotations

import re

import numpy as np

from .shingles import mixed

_U = np.uint64
OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)
#: Distinct pre-tokens kept; beyond it the memory starts anew.
KEPT = 2_000_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the ranges [start, start + size) in a row."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def _same(x: np.ndarray, start: np.ndarray, size: np.ndarray, y: np.ndarray, other: np.ndarray, other_size: np.ndarray) -> bool:
    """Whether all ranges of x equal those of y."""
    return bool((size == other_size).all() and (x[_places(start, size)] == y[_places(other, size)]).all())


class CachedEncoder:
    """``path`` names a tokenizer whose only pre-tokeniser is byte-level with its usual pattern.

    ``encode_special_tokens`` is the library's switch: true spells special tokens out like other
    text, false (the library's default) gives their own ids. Other added tokens always have theirs.
    """

    def __init__(self, path: str, kept: int = KEPT, encode_special_tokens: bool = True):
        import json

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("only plain byte-level pre-tokenisation is supported")
        added = [x for x in spec["added_tokens"] if x["content"] and not (x["special"] and encode_special_tokens)]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError("added tokens of single words or with stripped white space are not supported")
        self.added = {x["content"]: x["id"] for x in added}
        # Of tokens that start at one place the longest counts.
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.model, self.pre, self.kept = tokenizer.model, tokenizer.pre_tokenizer, kept
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.kinds = np.full(0x110000, 255, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        # The characters of what is kept.
        self.codes = np.zeros(0, np.uint32)
        self.codes_at = np.zeros(0, np.int64)
        self.codes_size = np.zeros(0, np.int64)

    def _kind(self, code: int) -> int:
        if code == 0x20:
            return SPACE
        one = lambda head: len(self.pre.pre_tokenize_str(head + chr(code))) == 1
        return LETTER if one("a") else NUMBER if one("1") else OTHER if one("!") else BLANK

    def starts(self, codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Whether a pre-token starts at each character; ``firsts`` marks the first one of every text.

        Runs of letters, numbers or other marks, with one space before; contractions; white space.
        """
        n = len(codes)
        kind = self.kinds[codes]
        if (kind == 255).any():
            for code in np.unique(codes[kind == 255]).tolist():
                self.kinds[code] = self._kind(code)
            kind = self.kinds[codes]
        run = np.minimum(kind, BLANK)
        begin = firsts.copy()
        begin[1:] |= run[1:] != run[:-1]
        # The last white space before a visible character stands alone, or joins it if it is a space.
        after = np.flatnonzero(begin[1:] & (run[1:] != BLANK) & (run[:-1] == BLANK) & ~firsts[1:]) + 1
        begin[after - 1] = True
        begin[after[kind[after - 1] == SPACE]] = False
        marks = np.flatnonzero((codes == 0x27) & begin)
        if len(marks):
            ahead = np.zeros((2, len(marks)), np.uint32)
            for k in (1, 2):
                ok = marks + k < n
                at = marks[ok] + k
                same = ~firsts[marks[ok] + 1] & ~firsts[at]
                ahead[k - 1, ok] = np.where(same, codes[at], 0)
            short = np.isin(ahead[0], [ord(c) for c in "stmd"])
            long = np.zeros(len(marks), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (ahead[0] == ord(a)) & (ahead[1] == ord(b))
            begin[marks[short | long] + 1] = False
            for chosen, width in ((short, 2), (long, 3)):
                at = marks[chosen] + width
                at = at[at < n]
                begin[at[kind[at] == LETTER]] = True
        return begin

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; added tokens part it, and what is between them is encoded by itself."""
        if self.marks is None:
            return self._plain(texts)
        # Texts at the even places, added tokens at the odd ones.
        parts = [self.marks.split(t) for t in texts]
        ids = iter(self._plain([p for x in parts for p in x[::2]]))
        return [
            next(ids) if len(x) == 1
            else np.concatenate([np.array([self.added[p]], np.uint32) if k % 2 else next(ids) for k, p in enumerate(x)])
            for x in parts
        ]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without added tokens."""
        flat = "".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        if not flat:
            return [np.zeros(0, np.uint32) for _ in texts]
        codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        firsts = np.zeros(len(codes), bool)
        firsts[(ends - lengths)[lengths > 0]] = True
        start = np.flatnonzero(self.starts(codes, firsts))
        stop = np.concatenate([start[1:], [len(codes)]])
        h = self._hashes(codes, start, stop)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        slot = None
        if _same(codes, start, stop - start, codes, start[first][inverse], (stop - start)[first][inverse]):
            slot = self._slots(distinct, flat, codes, start[first], stop[first])
        if slot is None:
            return self._one_by_one(flat, start, stop, ends)
        sizes, where = self.size[slot][inverse], self.where[slot][inverse]
        done = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(where - done[:-1], sizes) + np.arange(done[-1])]
        # Pre-tokens never span texts.
        cut = done[np.searchsorted(start, ends)]
        return np.split(ids, cut[:-1])

    def _hashes(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The sum of a scrambled number for every character at its place, scrambled."""
        place = np.arange(len(codes)) - np.repeat(start, stop - start)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed(codes.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + place.astype(np.uint64) * _U(0xD6E8FEB86659FD93)), out=sums[1:])
        return mixed(sums[stop] - sums[start] + (stop - start).astype(np.uint64))

    def _ids(self, pretoken: str) -> list[int]:
        return [t.id for t in self.model.tokenize(pretoken.encode().decode("latin-1").translate(self.letters))]

    def _one_by_one(self, flat: str, start: np.ndarray, stop: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of texts in which two different pre-tokens share a hash."""
        known: dict[str, list[int]] = {}
        out, at = [[] for _ in ends], 0
        for a, b in zip(start.tolist(), stop.tolist()):
            while a >= ends[at]:
                at += 1
            one = flat[a:b]
            if one not in known:
                known[one] = self._ids(one)
            out[at] += known[one]
        return [np.array(x, np.uint32) for x in out]

    def _slots(self, distinct: np.ndarray, flat: str, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray | None:
        """Rows of the memory for sorted distinct hashes; what is new is encoded. None if other characters have such a hash."""
        if len(self.hashes) > self.kept:
            self._forget()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        old, new = np.flatnonzero(known), np.flatnonzero(~known)
        if not _same(self.codes, self.codes_at[at[old]], self.codes_size[at[old]], codes, start[old], stop[old] - start[old]):
            return None
        if len(new):
            ids = [self._ids(flat[a:b]) for a, b in zip(start[new].tolist(), stop[new].tolist())]
            size = np.array([len(x) for x in ids], np.int64)
            where = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.uint32)])
            put = at[new]
            self.hashes = np.insert(self.hashes, put, distinct[new])
            self.where = np.insert(self.where, put, where)
            self.size = np.insert(self.size, put, size)
            length = stop[new] - start[new]
            self.codes_at = np.insert(self.codes_at, put, len(self.codes) + np.cumsum(length) - length)
            self.codes_size = np.insert(self.codes_size, put, length)
            self.codes = np.concatenate([self.codes, codes[_places(start[new], length)]])
            at = np.searchsorted(self.hashes, distinct)
        return at
