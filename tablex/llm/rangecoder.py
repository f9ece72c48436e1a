"""Context-mixing range coder for id sequences, in numpy: all blocks of a batch are coded side by side.

Order-2 and order-1 tables predict one id each, with a confidence; order 0 is a distribution of all ids that the blocks
of a batch share (`Order0`, stored beside them). Adaptive weights, one set for each pair of confidences, mix the
three into one distribution of 2^28 parts, so that an id is one step of the coder. Tables and weights
start anew with each block. The coder keeps 48 bits and gives 16 at a time; carries stay above the
48 bits, go into the word that is given next, and are settled at the end.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
LANES = 2048
SLOTS = 1024
#: Shares of an id in order 0, and of order 0 to order 2 in the mix.
PARTS, MIX = 16, 12
ALL = PARTS + MIX
HALF, LOW, MASK = 1 << 32, (1 << 32) - 1, (1 << 48) - 1
#: An entry that predicts nothing: an id that none is, of confidence 0.
NOTHING = 1 << 18
#: What a hit adds to its weight, and each id to both, after a 32nd is taken off; both stay below 4031 of 4096 together.
HIT, MISS = 120, 2
_HIGH, _PACE, _MISSES = 0xFFFF0000, 0x07FF07FF, MISS << 16 | MISS


class Order0:
    """Shares of 65,536 for each id that occurs: one, and more by how often it does."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        if shares.sum() != 1 << PARTS or (np.diff(ids) <= 0).any():
            raise ValueError("not a distribution of ids")
        self.ids, self.shares = ids.astype(np.int64), shares.astype(np.int64)
        self.begins = np.cumsum(self.shares) - self.shares

    @classmethod
    def of(cls, ids: np.ndarray) -> Order0:
        counts = np.bincount(np.asarray(ids).reshape(-1))
        seen = np.flatnonzero(counts)
        if not len(seen):
            return cls(np.zeros(1, np.int64), np.full(1, 1 << PARTS))
        counts = counts[seen]
        shares = 1 + counts * ((1 << PARTS) - len(seen)) // counts.sum()
        shares[counts.argmax()] += (1 << PARTS) - shares.sum()
        return cls(seen, shares)

    def dump(self) -> bytes:
        """Gaps between ids and shares less one, low bytes apart from high ones."""
        gaps = np.diff(self.ids, prepend=0)
        return zlib.compress(np.concatenate([gaps, self.shares - 1]).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())

    @classmethod
    def load(cls, data: bytes) -> Order0:
        try:
            both = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, -1).astype(np.int64)
        except zlib.error as e:
            raise ValueError("a distribution of ids is damaged") from e
        gaps, shares = (both[0] | both[1] << 8).reshape(2, -1)
        return cls(np.cumsum(gaps), shares + 1)

    def by_id(self) -> np.ndarray:
        """Begin and share of each id, packed."""
        packed = np.zeros(1 << 16, np.int64)
        packed[self.ids] = self.begins << 20 | self.shares
        return packed

    def by_place(self) -> np.ndarray:
        """Id, begin and share at each of the 65,536 places, packed."""
        return np.repeat(self.ids << 40 | self.begins << 20 | self.shares, self.shares)


class Model:
    """Predictions and weights of `lanes` blocks.

    A table entry holds an id and its confidence (0: none, 1, 2, 3), a mixing entry the weights of order 2 and of order 1,
    16 bits each: one look-up and one update serve both. Row 0 is order 2, row 1 order 1.
    """

    def __init__(self, lanes: int):
        self.base, self.mix_base = np.arange(2 * lanes).reshape(2, lanes) * SLOTS, np.arange(lanes) * 16
        self.table = np.full(2 * lanes * SLOTS, NOTHING, np.int32)
        self.weights = np.full(lanes * 16, 1024 << 16 | 1024, np.int64)
        self.last, self.before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.at, self.entry, self.packed = np.empty((2, lanes), np.int64), np.empty((2, lanes), np.int32), np.empty(lanes, np.int64)

    def predict(self):
        """Ends of order 2's and of order 1's share of 2^28, and order 0's share of 4096."""
        np.add(self.last, self.before * np.int32(10007), out=self.at[0])
        self.at[1] = self.last
        self.at &= SLOTS - 1
        self.at += self.base
        self.table.take(self.at, out=self.entry, mode="clip")
        self.sure = self.entry & 3
        self.mix = self.sure[0] << 2
        self.mix |= self.sure[1]
        self.mix = self.mix_base + self.mix
        self.weights.take(self.mix, out=self.packed, mode="clip")
        end2 = self.packed & _HIGH
        end1 = (self.packed & 0xFFFF) << PARTS
        end1 += end2
        return end2, end1, (1 << MIX) - (end1 >> PARTS)

    def learn(self, ids: np.ndarray, hit: np.ndarray, by2: np.ndarray, by1: np.ndarray):
        """`hit`: the entries that hold the lane's id. A hit makes an entry sure, a miss takes 1 off or puts the id in."""
        step = self.packed >> 5
        step &= _PACE
        self.packed += _MISSES
        self.packed -= step
        self.packed += by2 * (HIT << 16)
        self.packed += by1 * HIT
        self.weights[self.mix] = self.packed
        kept = self.sure > 1
        kept |= hit
        self.entry -= 1
        self.entry |= hit.view(np.int8) * np.int32(3)
        self.table[self.at] = np.where(kept, self.entry, ids << 2 | 1)
        self.before, self.last = self.last, ids


def encode(blocks: np.ndarray, order0: Order0 | None = None) -> list[bytes]:
    """One byte string for each row of ids (below 65536); `order0` has all of them (None: the ids of the blocks, which start with it)."""
    if order0 is None:
        order0 = Order0.of(blocks)
        head = order0.dump()
        head = len(head).to_bytes(4, "little") + head
        return [head * (k == 0) + data for k, data in enumerate(encode(blocks, order0))]
    lanes, steps = blocks.shape
    model, shares = Model(lanes), order0.by_id()
    width = -(-ALL * steps // 16) + 5
    words, at = np.zeros(lanes * width, np.int32), np.arange(lanes) * width
    low, size = np.zeros(lanes, np.int64), np.full(lanes, MASK)
    for ids in np.ascontiguousarray(blocks.T.astype(np.int32)):
        end2, end1, rest = model.predict()
        hit = model.entry >> 2 == ids
        by2, by1 = hit[0], hit[1] > hit[0]
        packed = shares.take(ids)
        begin = np.where(by2, 0, np.where(by1, end2, end1 + (packed >> 20) * rest))
        share = np.where(by2, end2, np.where(by1, end1 - end2, (packed & 0xFFFFF) * rest))
        part = size >> ALL
        low += begin * part
        size = share * part
        words[at] = low >> 32  # where none is given yet, the next step's overwrites it
        small = size < HALF
        at += small
        low = np.where(small, (low & LOW) << 16, low)
        size <<= small * 16
        some = np.flatnonzero(size < HALF)
        if len(some):  # a second word; there is never a third
            words[at[some]] = low[some] >> 32
            at[some] += 1
            low[some] = (low[some] & LOW) << 16
            size[some] <<= 16
        model.learn(ids, hit, by2, by1)
    count = at - np.arange(lanes) * width
    for shift in (32, 16, 0):
        words[at] = low >> shift if shift == 32 else low >> shift & 0xFFFF
        at += 1
    out = np.ascontiguousarray(words.reshape(lanes, width)[:, : int(count.max()) + 3].T)
    for k in range(len(out) - 1, 0, -1):  # carries run to the left
        over = out[k] >> 16
        if over.any():
            out[k - 1] += np.where(k < count + 3, over, 0)
            out[k] &= 0xFFFF
    packed = np.ascontiguousarray(out.T.astype("<u2"))
    return [packed[k, :n].tobytes() for k, n in enumerate((count + 3).tolist())]


def decode(blocks: list[bytes], steps: int, order0: Order0 | None = None) -> np.ndarray:
    """The rows of ids."""
    if order0 is None:
        size = 4 + int.from_bytes(blocks[0][:4], "little")
        return decode([blocks[0][size:], *blocks[1:]], steps, Order0.load(blocks[0][4:size]))
    lanes = len(blocks)
    sizes = [len(b) // 2 for b in blocks]
    width = max(sizes) + 2
    rows = np.zeros((lanes, width), np.uint16)
    for k, b in enumerate(blocks):
        rows[k, : sizes[k]] = np.frombuffer(b, "<u2", sizes[k])
    first, words = rows[:, :3].astype(np.int64), rows.reshape(-1)
    at = np.arange(lanes) * width + 3
    code, size = first[:, 0] << 32 | first[:, 1] << 16 | first[:, 2], np.full(lanes, MASK)
    model, places = Model(lanes), order0.by_place()
    out = np.empty((steps, lanes), np.int32)
    for k in range(steps):
        end2, end1, rest = model.predict()
        part = size >> ALL
        place = quotient(code, part)
        by2 = place < end2
        by1 = (place < end1) > by2
        packed = places.take(((place - end1) / rest).astype(np.int64), mode="clip")
        begin = np.where(by2, 0, np.where(by1, end2, end1 + (packed >> 20 & 0xFFFFF) * rest))
        share = np.where(by2, end2, np.where(by1, end1 - end2, (packed & 0xFFFFF) * rest))
        guesses = model.entry >> 2
        ids = np.where(by2, guesses[0], np.where(by1, guesses[1], (packed >> 40).astype(np.int32)))
        code -= begin * part
        size = share * part
        small = size < HALF
        code = np.where(small, code << 16 | words.take(at, mode="clip"), code)
        at += small
        size <<= small * 16
        some = np.flatnonzero(size < HALF)
        if len(some):
            code[some] = code[some] << 16 | words.take(at[some], mode="clip")
            at[some] += 1
            size[some] <<= 16
        model.learn(ids, guesses == ids, by2, by1)
        out[k] = ids
    return out.T


def quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b of numbers below 2^48: a double may round up to the next whole number, never down past one."""
    q = (a / b).astype(np.int64)
    return q - (q * b > a)
