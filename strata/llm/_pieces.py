"""A worker's memory of encoded pieces: 64-bit hash of the piece's bytes -> packed ids,
as flat numpy arrays with open addressing, probed and filled a batch at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from ._common import _BYTE, _mix, splitmix


class PieceTable:
    """``encode(list of byte strings) -> list of id arrays`` runs once per piece it does not hold.

    ``limit`` bounds the bytes held; beyond it the table starts anew, which never changes a result.  A worker that lives on
    after its partition calls ``clear``, so that the table does not stay beside other operators' memory.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], kind: str, limit: int = 24 << 20):
        self.encode, self.kind, self.limit = encode, kind, limit
        self.clear()

    def clear(self) -> None:
        self.powers = splitmix(1 << 12, 99)
        self._reset(1 << 16)

    def held(self) -> int:
        return sum(a.nbytes for a in (self.slot_key, self.slot_at, self.key, self.start, self.blob))

    def _reset(self, slots: int) -> None:
        self.slot_key = np.zeros(slots, np.uint64)
        self.slot_at = np.zeros(slots, np.int32)
        self.n = 0
        self.key = np.zeros(1 << 14, np.uint64)
        self.start = np.zeros((1 << 14) + 1, np.int64)
        self.blob = np.zeros(1 << 16, self.kind)

    def _hash(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``start``/``end`` cover ``data`` without gaps."""
        length = end - start
        if length.max() > len(self.powers):
            self.powers = splitmix(int(length.max()) * 2, 99)
        with np.errstate(over="ignore"):
            place = np.arange(len(data), dtype=np.int64) - np.repeat(start, length)
            terms = _BYTE[data]
            terms *= self.powers[place]
            h = _mix(np.add.reduceat(terms, start) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        h[h == 0] = 1
        return h

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash in the table, -1 where missing."""
        mask = np.uint64(len(self.slot_key) - 1)
        slot = (h & mask).astype(np.int64)
        got = self.slot_key[slot]
        out = np.where(got == h, self.slot_at[slot], -1)
        open_ = np.flatnonzero((got != h) & (got != 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & int(mask)
            got = self.slot_key[slot]
            hit = got == h[open_]
            out[open_[hit]] = self.slot_at[slot[hit]]
            left = ~hit & (got != 0)
            open_, slot = open_[left], slot[left]
        return out

    def _place(self, h: np.ndarray, at: np.ndarray) -> None:
        """Store distinct new hashes."""
        mask = len(self.slot_key) - 1
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(h):
            free = self.slot_key[slot] == 0
            self.slot_key[slot[free]] = h[free]  # of those that meet in a slot the last stays
            won = free & (self.slot_key[slot] == h)
            self.slot_at[slot[won]] = at[won]
            h, at, slot = h[~won], at[~won], (slot[~won] + 1) & mask

    def _add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        n, m = self.n, len(h)
        while n + m > len(self.key):
            self.key = np.concatenate([self.key, np.zeros(len(self.key), np.uint64)])
            self.start = np.concatenate([self.start, np.zeros(len(self.key) - n, np.int64)])[:len(self.key) + 1]
            self.start = np.concatenate([self.start, np.zeros(len(self.key) + 1 - len(self.start), np.int64)])
        flat = np.concatenate(ids)
        base = self.start[n]
        while base + len(flat) > len(self.blob):
            self.blob = np.concatenate([self.blob, np.zeros(len(self.blob), self.kind)])
        self.blob[base:base + len(flat)] = flat
        self.key[n:n + m] = h
        self.start[n + 1:n + m + 1] = base + np.cumsum([len(x) for x in ids])
        self.n += m
        if 2 * self.n > len(self.slot_key):
            self.slot_key = np.zeros(4 * len(self.slot_key), np.uint64)
            self.slot_at = np.zeros(len(self.slot_key), np.int32)
            self._place(self.key[:self.n].copy(), np.arange(self.n, dtype=np.int32))
        else:
            self._place(h, np.arange(n, n + m, dtype=np.int32))

    def ids(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces of ``data`` in order, and the number of ids of each piece.  Piece i is
        ``data[start[i]:start[i + 1]]``; the pieces cover ``data``."""
        end = np.append(start[1:], len(data))
        h = self._hash(data, start, end)
        at = self._find(h)
        if (at < 0).any():
            miss = np.flatnonzero(at < 0)
            new, first = np.unique(h[miss], return_index=True)
            if self.n and self.held() > self.limit:
                self._reset(1 << 16)
                new, first = np.unique(h, return_index=True)
                miss = np.arange(len(h))
            where = miss[first]
            raw = data.tobytes()
            self._add(new, self.encode([raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist())]))
            at[miss] = self._find(h[miss])
        count = self.start[at + 1] - self.start[at]
        total = np.cumsum(count)
        flat = np.repeat(self.start[at] - (total - count), count)
        flat += np.arange(len(flat))
        return self.blob[flat], count
