"""Draws: the first 15 hex digits of an md5 as a number, for whole Arrow batches.

A draw by SQL (``conv(substr(md5(text), 1, 15), 16, 10)``) takes about 2 us a row, a third of it for digits that are
written and read again.  Here the md5 of a batch is computed by NumPy on all its rows at once; texts that do not fit
one block of md5 (55 bytes with their constant parts) go to ``hashlib`` one by one.  The values are the same.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# the functions travel with the plan: executors need NumPy and Arrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of md5 (RFC 1321).
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_WORDS = ((1, 0), (5, 1), (3, 5), (7, 0))                     # word of step i: (a * i + b) % 16
_ADDED = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_BLOCK_BYTES = 55                                             # of text in one block


def _blocks(data: np.ndarray, offsets: np.ndarray, before: bytes, after: bytes) -> np.ndarray:
    """The padded block of each text (those that do not fit are left empty), as rows of 64 bytes."""
    n, lead = len(offsets) - 1, len(before)
    sizes = np.diff(offsets)
    block = np.zeros((n, 64), np.uint8)
    for size in np.unique(sizes).tolist():
        total = lead + size + len(after)
        if total > _BLOCK_BYTES:
            continue
        frame = np.zeros(64, np.uint8)
        frame[:lead] = np.frombuffer(before, np.uint8)
        frame[lead + size:total] = np.frombuffer(after, np.uint8)
        frame[total] = 0x80
        frame[56:] = np.frombuffer((8 * total).to_bytes(8, "little"), np.uint8)
        rows = np.flatnonzero(sizes == size)
        if len(rows) == n:
            block[:] = frame
            block[:, lead:lead + size] = data[offsets[0]:offsets[-1]].reshape(n, size)
        else:
            part = np.tile(frame, (len(rows), 1))
            part[:, lead:lead + size] = data[offsets[rows][:, None] + np.arange(size)]
            block[rows] = part
    return block


def _md5_start(block: np.ndarray) -> np.ndarray:
    """The first 64 bits of the md5 of each row's block."""
    n = len(block)
    words = np.ascontiguousarray(block.view("<u4").T)
    words = [int(w[0]) if (w == w[0]).all() else w for w in words]       # most of them are equal in all rows
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        times, plus = _WORDS[kind]
        word = words[(times * i + plus) % 16]
        if isinstance(word, int):
            f += np.uint32((word + _ADDED[i]) & 0xFFFFFFFF)
        else:
            f += word
            f += np.uint32(_ADDED[i])
        shift = _SHIFTS[kind][i % 4]
        np.left_shift(f, np.uint32(shift), out=g)
        f >>= np.uint32(32 - shift)
        f |= g
        f += b
        a, d, c, b, f = d, c, b, f, a
    a += np.uint32(_START[0])
    b += np.uint32(_START[1])
    return a.byteswap().astype(np.uint64) << np.uint64(32) | b.byteswap().astype(np.uint64)


def first_60_bits(texts: pa.Array, before: bytes, after: bytes = b"") -> np.ndarray:
    """The first 15 hex digits of md5(before + text + after) of each text, as numbers; a NULL counts as empty."""
    n = len(texts)
    if n == 0:
        return np.empty(0, np.int64)
    column = texts.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, bytes_ = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None else np.empty(0, np.uint8)
    out = (_md5_start(_blocks(data, offsets, before, after)) >> np.uint64(4)).astype(np.int64)
    for i in np.flatnonzero(np.diff(offsets) + len(before) + len(after) > _BLOCK_BYTES).tolist():
        text = data[offsets[i]:offsets[i + 1]].tobytes()
        out[i] = int(hashlib.md5(before + text + after).hexdigest()[:15], 16)
    return out


def draw_bits(value: Column, seed: int, tag: str) -> Column:
    """The draw of md5("<seed>|<value>|<tag>"); a NULL is left out with its separator."""
    before, after = f"{seed}|".encode(), f"|{tag}".encode()
    null = int(hashlib.md5(f"{seed}|{tag}".encode()).hexdigest()[:15], 16)

    @F.arrow_udf("long")
    def draw_md5(text: pa.Array) -> pa.Array:
        bits = first_60_bits(text, before, after)
        if text.null_count:
            bits[text.is_null().to_numpy(zero_copy_only=False)] = null
        return pa.array(bits)

    return draw_md5(value.cast("string"))


def feistel(number: Column, seed: int, rounds: int, half: int, back: bool = False) -> Column:
    """``number`` (0 .. half^2 - 1) after ``rounds`` keyed rounds on its halves, each adding the draw of one half to the
    other, or the number that they lead from; NULL stays."""
    @F.arrow_udf("long")
    def feistel_md5(x: pa.Array) -> pa.Array:
        def drawn(r: int, part: np.ndarray) -> np.ndarray:
            return first_60_bits(pa.array(part).cast(pa.string()), f"{seed}|{r}|".encode()) % half

        left, right = np.divmod(x.fill_null(0).to_numpy(zero_copy_only=False), half)
        for r in range(rounds, 0, -1) if back else range(1, rounds + 1):
            if back:
                left, right = (right - drawn(r, left)) % half, left
            else:
                left, right = right, (left + drawn(r, right)) % half
        out = left * half + right
        return pa.array(out, mask=x.is_null().to_numpy(zero_copy_only=False)) if x.null_count else pa.array(out)

    return feistel_md5(number)
