"""Whole texts of Arrow batches as flat byte arrays, and the hashing that the text operators share.

A batch of texts is one byte array with offsets, so words, lines and windows of
thousands of documents are found and hashed by a few numpy passes. A null text counts
as empty. Batches are worked off in slices of bounded bytes; only a single text longer
than the bound makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
BATCH_ROWS = 256
#: 64-bit words of the bitmap that keeps texts without a partner out of a shuffle.
FILTER_WORDS = 1 << 16

# Multipliers of the splitmix64 finaliser, and an odd base for polynomial hashes modulo 2^64.
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15

# The bytes \x20 and \x09 to \x0D part words; A-Z become a-z.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Substrings of more bytes are hashed one by one.
LONG_SPAN = 256

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Few rows a batch from now on: they hold whole texts, some of them very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """n fixed 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(salt))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), SLICE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


_coefficients = [seeds(256, 11), seeds(256, 12)]


def prefix_hashes(data: np.ndarray, family: int = 0) -> np.ndarray:
    """P with P[i] = sum of c(data[j]) * BASE^j over j < i, so any substring's hash takes two look-ups.

    The two families differ in the numbers c that stand for the bytes. See ``content_hashes`` for long substrings.
    """
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_coefficients[family][data] * up, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end)."""
    _, down = powers(len(prefix) + 1)
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def every_span_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """``span_hashes`` of all substrings of ``width`` bytes, by start."""
    _, down = powers(len(prefix) - width)
    return mix((prefix[width:] - prefix[:-width]) * down + np.uint64(width))


def content_hashes(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """Hashes of the substrings [start, end) that also tell long ones apart.

    Sums modulo 2^64 agree for some long texts of a special pattern, whatever the base and the numbers for the bytes; it takes several hundred
    bytes to cancel 64 bits. Longer substrings are hashed from their bytes by another function. Which way is taken depends on the
    length alone, so equal substrings have equal hashes.
    """
    out = span_hashes(prefix, start, end)
    long = np.flatnonzero(end - start > LONG_SPAN)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh3_64_intdigest(view[a:b], family + 1) for a, b in zip(start[long].tolist(), end[long].tolist())]
    return out


class Texts:
    """The texts of one Arrow column: ``data`` holds all bytes, text i is data[offsets[i]:offsets[i + 1]]."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and len(data) else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owners(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position belongs to."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def _first_bytes(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, bool)
        out[self.offsets] = True
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word."""
        space = SPACES[self.data]
        edge = self._first_bytes()
        before = edge[:-1].copy()
        before[1:] |= space[:-1]
        after = edge[1:].copy()
        after[:-1] |= space[1:]
        return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line without its newline, and its text; an empty text has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        owner = np.concatenate([np.arange(len(self)), self.owners(breaks)])
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        ends = np.empty_like(starts)
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        ends[last] = self.offsets[1:][owner[last]]
        inner = np.flatnonzero(~last)
        ends[inner] = starts[inner + 1] - 1
        return starts, ends, owner


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds at most ``limit`` bytes of the column, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(sizes), 0)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Shingles:
    """Hashes of the distinct word shingles of each text; ``offsets`` part them by text.

    Words are runs of bytes other than spaces, A-Z lower-cased. A text with fewer than ``k``
    words has its whole word sequence as its only shingle; one without words has none.
    """

    def __init__(self, texts: Texts, k: int):
        starts, ends = texts.words()
        folded = LOWER[texts.data]
        hashed = content_hashes(folded, prefix_hashes(folded), starts, ends)
        bounds = np.searchsorted(starts, texts.offsets)
        factors = seeds(k, 7)
        total = np.zeros(max(len(hashed) - k + 1, 0), np.uint64)
        for j in range(k):
            total += mix(hashed[j : j + len(total)] + factors[j])
        total = mix(total)
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= k:
                found.append(np.unique(total[a : b - k + 1]))
            elif b > a:
                short = mix(hashed[a:b] + factors[: b - a]).sum(dtype=np.uint64)
                found.append(mix(np.array([short + np.uint64(b - a)], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
        self.counts = np.array([len(x) for x in found], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)
        self.hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)


def per_text(values: np.ndarray, offsets: np.ndarray, reduce: np.ufunc, empty) -> np.ndarray:
    """reduce(values[offsets[i]:offsets[i + 1]]) for each i, ``empty`` where that is empty."""
    out = np.full((len(offsets) - 1, *values.shape[1:]), empty, values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = reduce.reduceat(values, offsets[:-1][full], axis=0)
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks on any machine must see it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def among(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows that may have one of the keys: a filter by a bitmap of hashed keys, at most FILTER_WORDS rows of 64 bits.

    The bitmap is broadcast, being of bounded size whatever the number of keys; rows it lets through wrongly fall out in later joins.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    word, bit = (spot / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    bitmap = ids.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    met = docs.withColumns({"word": word, "bit": bit}).join(F.broadcast(bitmap), "word")
    return met.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select(*docs.columns)


def ordered_blocks(df: DataFrame, key: str, blocks: int, guests: bool = False) -> DataFrame:
    """The rows dealt into blocks of neighbouring keys, each block whole and sorted within one partition.

    Block bounds are approximate percentiles of the key: one pass over that column, at most
    ``blocks`` values. Rows get ``block``; they are sorted by block, ``wrapped``, key and then
    all other columns, nulls first. With ``guests``, a row that opens a block also ends the block
    before (``guest`` true), and the first row of all also ends the last block (``wrapped`` true), so each
    block holds the follower of each of its rows.
    """
    spark = df.sparkSession
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    got = df.agg(
        F.percentile_approx(key, shares, 10 * blocks).alias("bounds"),
        F.min(key).alias("first"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"),
    ).first()
    # A bound equal to the first key would make an empty block, unless rows without a key come before it.
    bounds = sorted({b for b in got["bounds"] or [] if got["nulls"] or b > got["first"]}) if blocks > 1 else []
    kind = df.schema[key].dataType.simpleString()
    known = F.expr(f"cast(array({', '.join(map(repr, bounds))}) as array<{kind}>)")
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)] if bounds else []
    block = F.lit(0)
    if bounds:
        block = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= len(bounds)) & (F.get(known, low + step - 1) <= F.col(key)), low + step
            ).otherwise(low),
        )
    out = df.withColumns({"block": block, "wrapped": F.lit(False), "guest": F.lit(False)})
    if guests:
        opens = F.lit(False) if not bounds else F.coalesce(F.get(known, F.col("block") - 1) == F.col(key), F.lit(False))
        first = F.col(key).isNull() if got["nulls"] else F.coalesce(F.col(key) == F.lit(got["first"]), F.lit(False))
        none = F.lit(None).cast("struct<block:int,wrapped:boolean,guest:boolean>")
        place = lambda b, wrapped, guest: F.struct(b.alias("block"), F.lit(wrapped).alias("wrapped"), F.lit(guest).alias("guest"))
        places = F.array_compact(
            F.array(
                place(F.col("block"), False, False),
                F.when((F.col("block") > 0) & opens, place(F.col("block") - 1, False, True)).otherwise(none),
                F.when(first, place(F.lit(len(bounds)), True, True)).otherwise(none),
            )
        )
        out = out.withColumn("place", F.explode(places)).select(*df.columns, "place.*")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["block", "wrapped", F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in df.columns if c != key]]
    return out.repartition(parts, "block").sortWithinPartitions(*order)


def block_count(spark: SparkSession) -> int:
    """A few blocks a partition, so that dealing them by hash leaves no partition much fuller than others."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
