"""Simple-8b word-aligned coding of unsigned integers, and the token file built on it.

A 64-bit word holds a selector (4 bits) and as many values as the selector says, each
with 60 // count bits. Selector 0 is an escape: the next word is one raw 64-bit value.
Every block of BLOCK_IDS ids starts at a word of its own, so blocks decode alone and a block decodes
with one numpy pass per selector.

Token file (little-endian): magic, number of documents, ids, blocks and words (5 x 8 bytes); the
documents' ids and their first id's position in the file (8 bytes each; a document without id is the lowest
value); each block's first word; the words; a crc32 of all that.
"""

from __future__ import annotations

import zlib

import numpy as np

# How many values a word of each selector holds; 0 is the escape.
COUNTS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
PAYLOAD_BITS = 60
BLOCK_IDS = 1 << 16
MAGIC = int.from_bytes(b"S8BTOK01", "little")
NO_ID = np.iinfo(np.int64).min


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; one too many where a value over 2^53 rounds up to a power of two, which only costs room."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(values: np.ndarray) -> np.ndarray:
    """Values as words; the number of values is not stored, unused places of the last word are 0."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    # widest[i]: bits of the widest of values[i:i + count]; beyond the end there are zeros.
    need = np.concatenate([_bit_lengths(values), np.zeros(60, np.uint8)])
    best = np.zeros(n, np.uint8)
    widest, reach = need, 1
    for selector in range(1, len(COUNTS)):
        count = int(COUNTS[selector])
        while reach < count:
            step = min(reach, count - reach)
            shifted = np.zeros_like(widest)
            shifted[:-step] = widest[step:]
            widest, reach = np.maximum(widest, shifted), reach + step
        best[widest[:n] <= PAYLOAD_BITS // count] = selector
    # The words follow one another: each begins where the one before ends.
    advance = np.maximum(COUNTS[best], 1).tolist()
    begins, at = [], 0
    keep = begins.append
    while at < n:
        keep(at)
        at += advance[at]
    begins = np.array(begins, np.int64)
    selectors = best[begins]
    places = np.arange(len(begins)) + np.concatenate([[0], np.cumsum(selectors[:-1] == 0)])
    words = np.zeros(len(begins) + int((selectors == 0).sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for selector in np.unique(selectors):
        of = np.flatnonzero(selectors == selector)
        if selector == 0:
            words[places[of] + 1] = values[begins[of]]
            continue
        count = int(COUNTS[selector])
        bits = np.arange(count, dtype=np.uint64) * np.uint64(PAYLOAD_BITS // count)
        taken = padded[begins[of][:, None] + np.arange(count)] << bits
        words[places[of]] = np.bitwise_or.reduce(taken, axis=1) | np.uint64(int(selector) << PAYLOAD_BITS)
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The n values of packed words."""
    selectors = (words >> np.uint64(PAYLOAD_BITS)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selectors == 0):  # a raw value may look like any selector
        raw[i + 1 : i + 2] = not raw[i]
    counts = np.where(raw, 1, COUNTS[np.minimum(selectors, len(COUNTS) - 1)])
    begins = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    out[begins[raw]] = words[raw]
    for selector in range(1, len(COUNTS)):
        of = np.flatnonzero((selectors == selector) & ~raw)
        if not len(of):
            continue
        count = int(COUNTS[selector])
        width = PAYLOAD_BITS // count
        bits = np.arange(count, dtype=np.uint64) * np.uint64(width)
        out[begins[of][:, None] + np.arange(count)] = (words[of][:, None] >> bits) & np.uint64((1 << width) - 1)
    return out[:n]


class TokenFileWriter:
    """Collects documents of one file; ids are packed block by block as they come."""

    def __init__(self):
        self.doc_ids, self.starts, self.n = [], [], 0
        self._blocks, self._open, self._open_n = [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.starts.append(self.n)
        self.n += len(ids)
        self._open.append(ids)
        self._open_n += len(ids)
        if self._open_n >= BLOCK_IDS:
            self._close(self._open_n // BLOCK_IDS * BLOCK_IDS)

    def _close(self, n: int) -> None:
        ids = np.concatenate(self._open)
        self._blocks += [pack(ids[i : i + BLOCK_IDS]) for i in range(0, n, BLOCK_IDS)]
        self._open, self._open_n = [ids[n:]], len(ids) - n

    def content(self) -> bytes:
        if self._open_n:
            self._close(self._open_n)
        firsts = np.concatenate([[0], np.cumsum([len(b) for b in self._blocks])])
        head = np.array([MAGIC, len(self.doc_ids), self.n, len(self._blocks), firsts[-1]], np.uint64)
        parts = [head, np.array(self.doc_ids, np.int64), np.array(self.starts, np.int64), firsts[:-1].astype(np.int64), *self._blocks]
        body = b"".join(p.astype(p.dtype.newbyteorder("<"), copy=False).tobytes() for p in parts)
        return body + zlib.crc32(body).to_bytes(8, "little")


class TokenFile:
    """Reads documents of a token file; a block is decoded when a document in it is asked for."""

    def __init__(self, content: bytes):
        head = np.frombuffer(content, "<u8", 5)
        if int(head[0]) != MAGIC or zlib.crc32(memoryview(content)[:-8]) != int.from_bytes(content[-8:], "little"):
            raise ValueError("not an intact token file")
        docs, self.n, blocks, words = (int(x) for x in head[1:])
        self.doc_ids = np.frombuffer(content, "<i8", docs, 40)
        self.starts = np.append(np.frombuffer(content, "<i8", docs, 40 + 8 * docs), self.n)
        self._firsts = np.append(np.frombuffer(content, "<i8", blocks, 40 + 16 * docs), words)
        self._words = np.frombuffer(content, "<u8", words, 40 + 16 * docs + 8 * blocks)
        self._block, self._ids = -1, None

    def block(self, b: int) -> np.ndarray:
        if b != self._block:
            n = min(BLOCK_IDS, self.n - b * BLOCK_IDS)
            self._block, self._ids = b, unpack(self._words[self._firsts[b] : self._firsts[b + 1]], n)
        return self._ids

    def ids(self, doc: int) -> np.ndarray:
        start, end = int(self.starts[doc]), int(self.starts[doc + 1])
        if start == end:
            return np.zeros(0, np.uint64)
        first, last = start // BLOCK_IDS, (end - 1) // BLOCK_IDS
        parts = []
        for b in range(first, last + 1):
            base = b * BLOCK_IDS
            parts.append(self.block(b)[max(start - base, 0) : end - base])
        return np.concatenate(parts) if len(parts) > 1 else parts[0]
