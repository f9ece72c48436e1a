"""Word and shingle hashes of many texts at once, in numpy; a text of any length is taken whole, piece by piece."""

from __future__ import annotations

import numpy as np

from tablex.llm.decontaminate import FOLD

PIECE_BYTES = 1 << 20
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd(seed: int, count: int) -> np.ndarray:
    """Odd multipliers."""
    return np.random.default_rng(seed).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHasher:
    """Hash of every word: a polynomial in its bytes, by prefix sums over a piece of text."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15, size: int = PIECE_BYTES):
        step, back = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        with np.errstate(over="ignore"):
            self.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, step))))
            self.undo = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, back))))

    def piece(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start of each word, its hash) of at most `size` bytes."""
        b = np.frombuffer(folded, np.uint8)
        inside = np.concatenate(([0], (b != 32).astype(np.int8), [0]))
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.powers[: len(b)])))
        return starts, mix((sums[ends] - sums[starts]) * self.undo[starts])

    def long(self, folded: bytes) -> np.ndarray:
        """Hashes of a text of any length; a word beyond a piece is hashed by itself."""
        out, at, size = [], 0, len(self.powers) - 1
        while at < len(folded):
            stop = len(folded)
            if stop - at > size:
                stop = folded.rfind(b" ", at, at + size)
                if stop <= at:
                    stop = folded.find(b" ", at + size)
                    stop = len(folded) if stop < 0 else stop
                    out.append(self.giant(folded[at:stop].strip()))
                    at = stop + 1
                    continue
            out.append(self.piece(folded[at:stop])[1])
            at = stop + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def giant(self, word: bytes) -> np.ndarray:
        total = np.uint64(0)
        for at in range(0, len(word), len(self.powers) - 1):
            total = mix(self.piece(word[at : at + len(self.powers) - 1])[1] + total)[0]
        return np.array([total])

    def words(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, where each text's begin, with the end)."""
        size, hashes, counts = len(self.powers) - 1, [], []
        held: list[bytes] = []

        def flush():
            if not held:
                return
            offsets = np.cumsum([0] + [len(h) + 1 for h in held])
            starts, found = self.piece(b" ".join(held))
            hashes.append(found)
            counts.extend(np.diff(np.searchsorted(starts, offsets)).tolist())
            held.clear()

        length = 0
        for text in texts:
            folded = (text or b"").translate(FOLD)
            if length + len(folded) + 1 > size:
                flush()
                length = 0
            if len(folded) + 1 > size:
                hashes.append(self.long(folded))
                counts.append(len(hashes[-1]))
            else:
                held.append(folded)
                length += len(folded) + 1
        flush()
        return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def plain_shingles(words: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each text (of all its words, if it has fewer), and where each text's begin."""
    weights = odd(11, k)
    sizes = np.diff(first)
    counts = np.where(sizes >= k, sizes - k + 1, (sizes > 0).astype(np.int64))
    starts = np.concatenate(([0], np.cumsum(counts)))
    text = np.repeat(np.arange(len(sizes)), counts)
    at = first[text] + np.arange(starts[-1]) - starts[text]
    end = first[text + 1]
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    for j in range(k):
        total += np.where(at + j < end, padded[at + j] * weights[j], np.uint64(j))
    return mix(total), starts


def marked(plain: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shingles marked by their occurrence: the second of two equal ones of a text differs from the first, so no text has two equal values."""
    total, text = plain.copy(), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    by = mix(total + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(by, kind="stable")
    same = np.concatenate(([False], by[order][1:] == by[order][:-1])) if len(by) else np.zeros(0, bool)
    if same.any():
        place = np.arange(len(order))
        occurrence = place - np.maximum.accumulate(np.where(~same, place, 0))
        total[order] += mix(occurrence.astype(np.uint64)) * (occurrence > 0)
    return total


def shingles(words: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """`plain_shingles`, marked by their occurrence."""
    plain, starts = plain_shingles(words, first, k)
    return marked(plain, starts), starts


def text_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over words and places for each text."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    place = (np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
    full = np.flatnonzero(np.diff(first))
    for side, step in enumerate(odd(13, 2)):
        if len(full):
            out[full, side] = np.add.reduceat(mix(words + place * step), first[full])
    return out
