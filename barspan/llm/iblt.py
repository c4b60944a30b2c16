"""Invertible Bloom lookup sketches of paragraph digests, for many texts at once.

A text's paragraphs (lines) are cut into pieces where the content says so, so a text of one long paragraph still
has parts to compare, and an edit changes the pieces it touches and no others. A piece's digest also counts how often the piece occurred before, so a
text is a set of digests. A sketch has cells of (count, xor of digests, xor of check hashes); each digest is added to one cell of each third.
Subtracting two sketches leaves the digests of one side only, with counts 1 and -1; cells that hold just one are peeled until nothing
is left. If peeling gets stuck the difference was too large for the cells, and both texts are sketched again, larger.
"""

from __future__ import annotations

import base64

import numpy as np

from barspan.llm import texts as tx

#: Cells of the sketch that serves as fingerprint, and the factor for the next try.
CELLS = 24
GROWTH = 4
#: A piece ends after a word whose hash is 0 modulo this, and at each newline.
PIECE_WORDS = 8

_THIRDS = 3
_CHECK = tx.seeds(1, 31)[0]


class Digests:
    """Distinct piece digests of texts; ``offsets`` part them by text."""

    def __init__(self, texts: tx.Texts):
        starts, ends = texts.words()
        owner = texts.owners(starts)
        line = np.searchsorted(np.flatnonzero(texts.data == 10), starts)
        prefix = tx.prefix_hashes(texts.data)
        cut = tx.span_hashes(prefix, starts, ends) % np.uint64(PIECE_WORDS) == 0
        if len(starts):
            last = cut | np.append((owner[1:] != owner[:-1]) | (line[1:] != line[:-1]), True)
            first = np.append(True, last[:-1])
            begin, end, owner = starts[first], ends[last], owner[first]
        else:
            begin = end = owner = np.zeros(0, np.int64)
        hashes = tx.content_hashes(texts.data, prefix, begin, end)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        # How often the same piece came before in its text.
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])) if len(hashes) else np.zeros(0, bool)
        at = np.arange(len(hashes))
        nth = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
        self.values = tx.mix(hashes + nth.astype(np.uint64) * np.uint64(tx.BASE))
        self.offsets = np.searchsorted(owner, np.arange(len(texts) + 1))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The digests of some texts, and for each its place in ``some``."""
        sizes = self.sizes[some]
        ends = np.cumsum(sizes)
        inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        return self.values[np.repeat(self.offsets[some], sizes) + inner], np.repeat(np.arange(len(some)), sizes)


def _cells(digests: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each digest in each third. The hash depends on the size, so a larger sketch is a fresh try."""
    third = cells // _THIRDS
    return np.stack([(tx.mix(digests ^ s) % np.uint64(third)).astype(np.int64) + j * third for j, s in enumerate(tx.seeds(_THIRDS, cells))])


class Sketches:
    """Sketches of several sets with ``cells`` cells each."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.counts = np.zeros(n * cells, np.int32)
        self.keys, self.checks = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)

    def add(self, digests: np.ndarray, owner: np.ndarray, sign) -> np.ndarray:
        """Add (sign 1) or take away (-1) digests; returns the cells that changed."""
        at = _cells(digests, self.cells) + owner * self.cells
        check = tx.mix(digests + _CHECK)
        for cells in at:
            np.add.at(self.counts, cells, sign)
            np.bitwise_xor.at(self.keys, cells, digests)
            np.bitwise_xor.at(self.checks, cells, check)
        return at.reshape(-1)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells)
        out.counts, out.keys, out.checks = self.counts - other.counts, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def text(self, i: int, size: int) -> str:
        """One sketch as text, after the set's size."""
        some = slice(i * self.cells, (i + 1) * self.cells)
        cells = (self.counts[some].astype("<i4"), self.keys[some].astype("<u8"), (self.checks[some] >> np.uint64(32)).astype("<u4"))
        return f"{size}:" + base64.b64encode(b"".join(c.tobytes() for c in cells)).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties the sketches: digests, whose they are, their signs; and which sketches came out empty."""
        found = []
        look = np.arange(len(self.keys))
        while len(look):
            pure = look[(np.abs(self.counts[look]) == 1) & (self.checks[look] == tx.mix(self.keys[look] + _CHECK))]
            digests, owner = self.keys[pure], pure // self.cells
            at = _cells(digests, self.cells) + owner * self.cells
            # A digest may stand alone in several of its cells: its first one counts.
            alone = (self.keys[at] == digests) & (np.abs(self.counts[at]) == 1)
            first = at[np.argmax(alone, axis=0), np.arange(len(pure))] == pure
            digests, owner, sign = digests[first], owner[first], self.counts[pure[first]]
            found.append((digests, owner, sign))
            look = np.unique(self.add(digests, owner, -sign))
        full = ((self.counts != 0) | (self.keys != 0) | (self.checks != 0)).reshape(self.n, self.cells)
        digests, owner, sign = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        return digests, owner, sign, ~full.any(axis=1)


def sketch(digests: Digests, some: np.ndarray, cells: int) -> Sketches:
    out = Sketches(len(some), cells)
    out.add(*digests.of(some), 1)
    return out


def fingerprints(digests: Digests) -> list[str]:
    every = np.arange(len(digests.sizes))
    all_ = sketch(digests, every, CELLS)
    return [all_.text(i, int(n)) for i, n in enumerate(digests.sizes)]


def differences(left: Digests, a: np.ndarray, right: Digests, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of texts (a of left, b of right) the digests that only a and only b has.

    Pairs are first compared by their fingerprints' sketches; those whose difference doesn't peel are sketched again, larger. A sketch of
    more cells than twice all digests peels with near certainty, and every size hashes anew, so the tries end.
    """
    out: list = [None] * len(a)
    open_, cells = np.arange(len(a)), CELLS
    while len(open_):
        rest = sketch(left, a[open_], cells).minus(sketch(right, b[open_], cells))
        digests, owner, sign, done = rest.peel()
        order = np.argsort(owner, kind="stable")
        digests, owner, sign = digests[order], owner[order], sign[order]
        bounds = np.searchsorted(owner, np.arange(len(open_) + 1))
        for i in np.flatnonzero(done):
            d, s = digests[bounds[i] : bounds[i + 1]], sign[bounds[i] : bounds[i + 1]]
            out[open_[i]] = (d[s > 0], d[s < 0])
        open_, cells = open_[~done], cells * GROWTH
    return out


def likeness(left: Digests, a: np.ndarray, right: Digests, b: np.ndarray) -> np.ndarray:
    """Shared digests over all digests of each pair; 1 for two texts without any."""
    found = differences(left, a, right, b)
    only_a, only_b = (np.array([len(f[side]) for f in found], float) for side in (0, 1))
    shared, union = left.sizes[a] - only_a, left.sizes[a] + only_b
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)
