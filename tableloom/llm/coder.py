"""Adaptive context-mixing range coder for token ids, in numpy over many blocks at once.

Up to ``LANES`` blocks are coded in step, one vector operation for all. They share
their statistics, which begin afresh with each such group: a group is read as a
whole, and every block has a payload and a checksum of its own.

Three orders predict each id, and their distributions are mixed by learned
weights: order 0 is how often each id came, over all 16 bits; orders 2 and 1 name
the id that followed the same two or one ids, in hashed, unverified slots. The
weights are learned for every combination of their confidences. All statistics
are renewed after 1, 2, 4 and so on up to ``STEPS`` places, the same way when
writing and reading. Ids must be below 65,536.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

BLOCK, LANES = 512, 16384
#: Most places and ids, about, that are coded with the same statistics.
STEPS, ROUND = 32, 1 << 16
#: Slots of order 2, values of a confidence, bits of all shares, and the least share of an id in order 0.
SLOTS, SURE, BITS, LEAST = 1 << 17, 8, 26, 16
IDS, TOTAL = 1 << 16, 1 << BITS
#: The coder's window of 62 bits gives words of 32 as soon as the span is below 30.
_WINDOW, _WORD, _LOW = 62, 32, 30
_BOTTOM, _REST, _MASK = 1 << _LOW, (1 << _LOW) - 1, (1 << _WORD) - 1
#: Parts in which ids are looked up by their place in order 0.
_PARTS = 17


class _Model:
    """Statistics of a group."""

    def __init__(self) -> None:
        # A slot is an id and its confidence above it.
        self.slots = [np.zeros(SLOTS, np.int32), np.zeros(IDS, np.int32)]
        self.count = np.zeros(IDS, np.int64)
        # By state: how often order 2, order 1 and neither of them was right.
        self.right = np.tile(np.array([1, 1, 2]), (2 * SURE * SURE, 1))
        self.renew()

    def renew(self) -> None:
        n = int(self.count.sum())
        size = LEAST + self.count * (TOTAL - LEAST * IDS) // n if n else np.full(IDS, TOTAL // IDS)
        size[size.argmax()] += TOTAL - size.sum()
        self.start = np.concatenate([[0], np.cumsum(size)])
        share = self.right * (TOTAL - TOTAL // 16) // self.right.sum(axis=1, keepdims=True)
        self.two, self.one = share[:, 0].copy(), share[:, 1].copy()
        self.one[SURE * SURE:] = 0  # both name the same id
        self.zero = TOTAL - self.two - self.one
        self.first = None

    def predict(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """Slot of order 2, slots' contents of orders 2 and 1, their ids, the state and the shares of orders 2, 1 and 0."""
        slot = ((before * 40503 + last * 2654435) >> 5) & (SLOTS - 1)
        a, b = self.slots[0].take(slot), self.slots[1].take(last)
        x, y = (a & 0xFFFF).astype(np.int64), (b & 0xFFFF).astype(np.int64)
        state = (a >> 16) * SURE + (b >> 16) + (x == y) * (SURE * SURE)
        return slot, a, b, x, y, state, self.two.take(state), self.one.take(state), self.zero.take(state)

    def bounds(self, ids: np.ndarray, x: np.ndarray, y: np.ndarray, two: np.ndarray, one: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of each id in its mixed distribution."""
        low = (zero * self.start.take(ids)) >> BITS
        size = ((zero * self.start.take(ids + 1)) >> BITS) - low + two * (x == ids) + one * (y == ids)
        return low + two * (x < ids) + one * (y < ids), size

    def find(self, goal: np.ndarray, x: np.ndarray, y: np.ndarray, two: np.ndarray, one: np.ndarray, zero: np.ndarray) -> np.ndarray:
        """Ids whose part of the mixed distribution holds ``goal``."""
        if self.first is None:
            first, shift = np.zeros((1 << _PARTS) + 1, np.int64), BITS - _PARTS
            first[(self.start[:-1] + (1 << shift) - 1) >> shift] = np.arange(IDS)
            self.first = np.maximum.accumulate(first)
        # The shares of orders 2 and 1 lie before their ids' own places in order 0; without them, order 0 is left.
        at = ((zero * self.start.take(x)) >> BITS) + one * (y < x)
        goal = goal - np.minimum(np.maximum(goal - at, 0), two)
        goal = goal - np.minimum(np.maximum(goal - ((zero * self.start.take(y)) >> BITS), 0), one)
        place = (((goal + 1) << BITS) - 1).view(np.uint64) // zero.view(np.uint64)
        place = np.minimum(place.view(np.int64), TOTAL - 1)
        ids = self.first.take(place >> (BITS - _PARTS))
        rest = np.flatnonzero(self.start.take(ids + 1) <= place)
        if len(rest):
            ids[rest] = np.searchsorted(self.start, place[rest], "right") - 1
        return ids

    def learn(self, ids: np.ndarray, last: np.ndarray, slot: np.ndarray, a: np.ndarray, b: np.ndarray, state: np.ndarray) -> None:
        """Ids, with the ids before them and what ``predict`` gave for them. Of one slot's ids the last counts."""
        hits, small = [], ids.astype(np.int32)
        for table, at, held in zip(self.slots, (slot, last), (a, b)):
            hit = (held & 0xFFFF) == small
            hits.append(hit)
            other = np.where(held >= 2 * IDS, held - IDS, small + IDS)
            table[at] = np.where(hit, held + IDS * (held < (SURE - 1) * IDS), other)
        state = state + np.where(hits[0], 0, np.where(hits[1], 2 * SURE * SURE, 4 * SURE * SURE))
        self.right += np.bincount(state, minlength=self.right.size).reshape(3, -1).T
        self.count += np.bincount(ids, minlength=IDS)


def _rounds(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Places (from, to) that are coded with the same statistics, and how many blocks have them. Only the last block may be shorter."""
    low, step, longest, short = 0, 1, int(sizes[0]), int(sizes[-1])
    most = min(STEPS, -(-ROUND // len(sizes)))
    while low < longest:
        high = min(low + step, longest if low >= short else short)
        yield low, high, len(sizes) - (low >= short)
        low, step = high, min(step * 2, most)


def encode(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Payload of each block. ``ids`` [place][block], of which ``sizes`` count."""
    n = len(sizes)
    model, low, span = _Model(), np.zeros(n, np.int64), np.full(n, 1 << _WINDOW)
    rows, words, before = [], [], np.zeros((2, n), np.int64)
    for begin, end, live in _rounds(sizes):
        seen = np.concatenate([before[:, :live], ids[begin:end, :live].astype(np.int64)])
        x, last = seen[2:], seen[1:-1]
        slot, a, b, x2, x1, state, *shares = model.predict(seen[:-2], last)
        start, size = model.bounds(x, x2, x1, *shares)
        for t in range(end - begin):
            part = span[:live] >> BITS
            low[:live] += part * start[t]
            span[:live] = part * size[t]
            full = np.flatnonzero(span[:live] < _BOTTOM)
            if len(full):
                now = low[full]
                rows.append(full)
                words.append(now >> _LOW)  # a carry is its 33rd bit
                low[full] = (now & _REST) << _WORD
                span[full] <<= _WORD
        before = seen[-2:]
        model.learn(*(c.ravel() for c in (x, last, slot, a, b, state)))
        model.renew()
    # One word more, which is in the span whatever follows as zeros.
    row = np.concatenate([*rows, np.arange(n)])
    word = np.concatenate([*words, (low + _REST) >> _LOW])
    word = word[np.argsort(row, kind="stable")]
    carry = np.flatnonzero(word > _MASK)
    while len(carry):
        word[carry] &= _MASK
        carry = carry - 1
        word[carry] += 1
        carry = carry[word[carry] > _MASK]
    edge, raw = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]) * 4, word.astype("<u4").tobytes()
    return [raw[edge[i]: edge[i + 1]] for i in range(n)]


def decode(payloads: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Ids [place][block] of a group's payloads."""
    n, longest = len(payloads), int(sizes[0])
    at = np.cumsum([0, *(len(p) // 4 + 1 for p in payloads)])[:-1]
    word = np.frombuffer(bytes(4).join([*payloads, bytes(4)]), "<u4").astype(np.int64)
    # The window ends inside a word: what follows it are the words moved by that much.
    after = ((word[:-1] << _LOW) & _MASK) | (word[1:] >> (_WORD - _LOW))
    code, span, at = (word[at] << _LOW) | (word[at + 1] >> (_WORD - _LOW)), np.full(n, 1 << _WINDOW), at + 1
    model, out, before = _Model(), np.zeros((longest, n), np.uint16), np.zeros((2, n), np.int64)
    for begin, end, live in _rounds(sizes):
        seen = np.concatenate([before[:, :live], np.zeros((end - begin, live), np.int64)])
        kept = []
        for t in range(end - begin):
            slot, a, b, x2, x1, state, *shares = model.predict(seen[t], seen[t + 1])
            kept.append((slot, a, b, state))
            part = span[:live] >> BITS
            goal = np.minimum((code[:live].view(np.uint64) // part.view(np.uint64)).view(np.int64), TOTAL - 1)
            x = seen[t + 2] = model.find(goal, x2, x1, *shares)
            start, size = model.bounds(x, x2, x1, *shares)
            code[:live] -= part * start
            span[:live] = part * size
            full = np.flatnonzero(span[:live] < _BOTTOM)
            if len(full):
                code[full] = (code[full] << _WORD) | after.take(at[full], mode="clip")
                span[full] <<= _WORD
                at[full] += 1
        out[begin:end, :live], before = seen[2:], seen[-2:]
        model.learn(seen[2:].ravel(), seen[1:-1].ravel(), *(np.concatenate(c) for c in zip(*kept)))
        model.renew()
    return out


def packed_blocks(ids: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(ids, checksum of the ids, payload) of consecutive blocks of ``ids``."""
    out = []
    for low in range(0, len(ids), BLOCK * LANES):
        part = ids[low: low + BLOCK * LANES].astype("<u4")
        if part.max() >= IDS:
            raise ValueError("an id is too large")
        n = -(-len(part) // BLOCK)
        sizes = np.full(n, BLOCK)
        sizes[-1] = len(part) - BLOCK * (n - 1)
        grid = np.zeros((n, int(sizes[0])), np.uint16)
        grid.ravel()[: len(part)] = part
        payloads = encode(np.ascontiguousarray(grid.T), sizes)
        out += [(s, zlib.crc32(part[i * BLOCK: i * BLOCK + s]), p) for i, (s, p) in enumerate(zip(sizes.tolist(), payloads))]
    return out


def unpacked_blocks(blocks: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """Ids of each block, of all blocks that ``packed_blocks`` gave. A block whose ids don't have their checksum raises an error."""
    out: list[np.ndarray] = []
    for low in range(0, len(blocks), LANES):
        some = blocks[low: low + LANES]
        sizes = np.array([n for n, _, _ in some], np.int64)
        grid = np.ascontiguousarray(decode([p for _, _, p in some], sizes).T, "<u4")
        for (n, check, _), row in zip(some, grid):
            ids = row[:n]
            if zlib.crc32(ids) != check:
                raise ValueError("a block's ids don't match its checksum")
            out.append(ids)
    return out
