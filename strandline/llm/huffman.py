"""Canonical length-limited Huffman codes with vectorised, table-driven decoding."""

from __future__ import annotations

import numpy as np

#: Ids between two bit-offset checkpoints.
STRIDE = 256


def limit_for(symbols: int) -> int:
    """Longest code in bits: room for every symbol, 16 at least (24 bits can be peeked at once)."""
    bits = max(16, (max(symbols, 2) - 1).bit_length() + 2)
    if bits > 24:
        raise ValueError("too many different ids for one code table")
    return bits


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal code lengths under the limit (package-merge); 0 for ids that don't occur."""
    used = np.nonzero(counts)[0]
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    limit = limit or limit_for(len(used))
    if len(used) > 1 << limit:
        raise ValueError("the limit has no room for every id")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, packed = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weights, packed])
        leaf = np.concatenate([np.ones(len(weights), bool), np.zeros(len(packed), bool)])
        at = np.argsort(both, kind="stable")
        both, leaf = both[at], leaf[at]
        levels.append(leaf)
        even = len(both) // 2 * 2
        packed = both[:even:2] + both[1:even:2]
    take, lengths = 2 * len(weights) - 2, np.zeros(len(weights), np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


class Code:
    """A canonical code: shorter codes first, then smaller ids."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.nonzero(lengths)[0]
        order = used[np.lexsort((used, self.lengths[used]))]
        size = self.lengths[order]
        self.limit = int(size.max(initial=1))
        step = np.int64(1) << (self.limit - size)
        first = np.cumsum(step) - step  # the code, left-aligned to ``limit`` bits
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (first >> (self.limit - size)).astype(np.uint64)
        self.table = np.zeros(1 << self.limit, np.int32)
        self.sizes = np.ones(1 << self.limit, np.int32)
        filled = int(step.sum())
        self.table[:filled], self.sizes[:filled] = np.repeat(order, step), np.repeat(size, step)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of every STRIDE-th id)."""
        if not len(ids):
            return b"", np.zeros(0, np.uint32)
        size = self.lengths[ids]
        end = np.cumsum(size)
        begin = end - size
        code, room = self.codes[ids], 64 - (begin & 63) - size
        word = begin >> 6
        inside = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        words = np.zeros((int(end[-1]) >> 6) + 1, np.uint64)
        new = np.nonzero(np.append(True, word[1:] != word[:-1]))[0]
        words[word[new]] = np.bitwise_or.reduceat(inside, new)
        over = np.nonzero(room < 0)[0]
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[: (int(end[-1]) + 7) // 8], begin[::STRIDE].astype(np.uint32)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of one block: all checkpoints advance together, one id a step."""
        if not n:
            return np.zeros(0, np.int32)
        raw = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, shift = checkpoints.astype(np.int64), np.uint32(32 - self.limit)
        out = np.zeros((len(at), STRIDE), np.int32)
        last = len(window) - 1
        for k in range(min(STRIDE, n)):
            peek = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> shift
            out[:, k] = self.table[peek]
            at = at + self.sizes[peek]
        return out.ravel()[:n]
