"""Hash-compared suffix sort: which fixed-length prefixes of suffixes repeat an earlier one.

Suffixes are sorted by a quicksort of many ways, all classes together. Two suffixes are compared by the length of their common extension,
found by binary search over prefix polynomial hashes. Each member of a group is compared with the group's first; that length, the side and the
eight bytes behind it part the group. What is left together agrees in eight bytes more, so there are at most length / 8 + 1 rounds,
each linear but for sorting the groups that part.
Neighbours that the hashes call equal are compared byte by byte; a class with a collision is sorted again by its bytes.
"""

from __future__ import annotations

import numpy as np

from barspan.llm import texts as tx

_VERIFY = 1 << 16


def _extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length of the common extension of the suffixes at a and b, at most ``length``."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), length, np.int64)
    _, down = tx.powers(len(prefix))
    da, db = down[a], down[b]
    pa, pb = prefix[a], prefix[b]
    for _ in range(int(length).bit_length()):
        middle = (low + high + 1) >> 1
        same = (prefix[a + middle] - pa) * da == (prefix[b + middle] - pb) * db
        low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
    return low


def _agree(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the hashes call the first ``length`` bytes at a and b equal."""
    _, down = tx.powers(len(prefix))
    return (prefix[a + length] - prefix[a]) * down[a] == (prefix[b + length] - prefix[b]) * down[b]


def _words(data: np.ndarray, kind: str = ">u8") -> np.ndarray:
    """The eight bytes from each position on as one number, by default one that sorts as they do; zeros behind the end."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray((len(data) + 1,), kind, padded, 0, (1,))


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at a and at b agree."""
    words, out = _words(data, "=u8"), np.ones(len(a), bool)
    for at in [*range(0, length - 7, 8), length - 8] if length >= 8 else []:
        out &= words[a + at] == words[b + at]
    for at in range(length if length < 8 else 0):
        out &= data[a + at] == data[b + at]
    return out


def _grouped(data: np.ndarray, prefix: np.ndarray, at: np.ndarray, classes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``sort_suffixes``, and for each place the first place whose suffix the hashes call equal to the one there."""
    words, order = _words(data), np.arange(len(at))
    begin = np.searchsorted(classes, classes, side="left")
    open_ = np.flatnonzero((np.searchsorted(classes, classes, side="right") - begin) > 1)
    while len(open_):
        mine, first = at[order[open_]], at[order[begin[open_]]]
        common, key = np.full(len(open_), length, np.int64), np.zeros(len(open_), np.uint64)
        rank = np.zeros(len(open_), np.int64)
        unequal = np.flatnonzero(~_agree(prefix, mine, first, length))
        common[unequal] = _extension(prefix, mine[unequal], first[unequal], length)
        unequal = unequal[common[unequal] < length]
        behind, left = common[unequal], np.maximum(8 - (length - common[unequal]), 0).astype(np.uint64) * np.uint64(8)
        key[unequal] = words[mine[unequal] + behind].astype(np.uint64) >> left
        less = key[unequal] < words[first[unequal] + behind].astype(np.uint64) >> left
        # What is less than the first comes by growing common length, what is greater by falling.
        rank[unequal] = np.where(less, behind - length, length - behind)
        # Only groups with a member unlike the first are sorted; the others are settled.
        group = np.cumsum(np.append(0, begin[open_[1:]] != begin[open_[:-1]]))
        parted = np.zeros(group[-1] + 1, bool)
        parted[group[unequal]] = True
        some = np.flatnonzero(parted[group])
        open_, rank, key = open_[some], group[some] * (2 * length + 1) + rank[some] + length, key[some]
        by = np.lexsort((key, rank))
        order[open_], rank, key = order[open_[by]], rank[by], key[by]
        new = np.flatnonzero(np.append(True, (rank[1:] != rank[:-1]) | (key[1:] != key[:-1]))[: len(open_)])
        sizes = np.diff(np.append(new, len(open_)))
        begin[open_] = np.repeat(open_[new], sizes)
        open_ = open_[np.repeat((sizes > 1) & (rank[new] % (2 * length + 1) != length), sizes)]
    return order, begin


def sort_suffixes(data: np.ndarray, prefix: np.ndarray, at: np.ndarray, classes: np.ndarray, length: int) -> np.ndarray:
    """The order that sorts suffixes by class and then by their first ``length`` bytes, equal ones as they came.

    ``classes`` ascend.
    """
    return _grouped(data, prefix, at, classes, length)[0]


def repeats(data: np.ndarray, at: np.ndarray, classes: np.ndarray, length: int) -> np.ndarray:
    """For each suffix whether one before it (in the given order) of its class has the same first ``length`` bytes.

    Suffixes of different classes are never equal; ``classes`` ascend.
    """
    out = np.zeros(len(at), bool)
    prefix = tx.prefix_hashes(data)
    # A class of one has nothing to repeat.
    several = np.flatnonzero(np.bincount(classes)[classes] > 1) if len(classes) else np.zeros(0, np.int64)
    at, classes = at[several], classes[several]
    if not len(at):
        return out
    order, begin = _grouped(data, prefix, at, classes, length)
    equal = np.append(False, begin[1:] == begin[:-1])
    broken: set[int] = set()
    claimed = np.flatnonzero(equal)
    for i in range(0, len(claimed), _VERIFY):
        some = claimed[i : i + _VERIFY]
        true = same_bytes(data, at[order[some - 1]], at[order[some]], length)
        broken.update(classes[order[some[~true]]].tolist())
    out[several[order[equal]]] = True
    for c in broken:
        members = np.flatnonzero(classes == c)
        seen: set[bytes] = set()
        for m in members:
            text = data[at[m] : at[m] + length].tobytes()
            out[several[m]] = text in seen
            seen.add(text)
    return out
