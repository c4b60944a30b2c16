"""Target-distribution importance resampling over hashed word features, with a head-tail vocabulary.

Features are the runs of one to three words of a text, and a feature's bucket is the CRC32 of its bytes modulo the number of
buckets. Two passes over all texts count words, then pairs of the most frequent ones. Their CRC states are broadcast: a frequent
word brings its state from the start of a feature and its effect after a space, so features of frequent words are
put together by the linear step of the CRC; a frequent pair brings its state and bucket at once. A feature with any other word
takes its CRC directly from its bytes. Both ways give the CRC exactly, so the head only decides how fast a feature is hashed.

A text's buckets are written once; bucket totals over all texts and the texts' weights are read from there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

BUCKETS = 10_000
#: The most words that are broadcast, their longest length in bytes, and of how many of them pairs are counted.
HEAD_WORDS = 1 << 16
HEAD_BYTES = 16
PAIR_WORDS = 1 << 10
#: The most pairs that are broadcast.
HEAD_PAIRS = 1 << 16
#: Distinct words that a task counts before it hands them on.
_COUNTED = 1 << 19
#: Longer pieces take their CRC one by one instead of byte by byte together.
_LONG = 48

# Fixed value: the reflected polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)

# Words are made of these bytes after lower-casing: digits, a-z, and all bytes of characters above 0x7F.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


CRC_TABLE = _crc_table()


def _shift_tables(longest: int) -> np.ndarray:
    """[n, byte, value]: what n further zero bytes make of a register that holds the value in that byte."""
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, longest + 1):
        out[n] = CRC_TABLE[out[n - 1] & np.uint32(255)] ^ (out[n - 1] >> np.uint32(8))
    return out


SHIFTS = _shift_tables(HEAD_BYTES + 1)


def _shifted(register: np.ndarray, by: np.ndarray) -> np.ndarray:
    out = SHIFTS[by, 0, register & np.uint32(255)]
    for byte in (1, 2, 3):
        out ^= SHIFTS[by, byte, (register >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def advance(register: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC registers after data[start:start + length] has gone through each of them."""
    register = register.copy()
    long = np.flatnonzero(length > _LONG)
    for i in long:
        piece = data[start[i] : start[i] + length[i]].tobytes()
        register[i] = zlib.crc32(piece, int(register[i] ^ _ONES)) ^ 0xFFFFFFFF
    short = np.flatnonzero(length <= _LONG)
    order = short[np.argsort(-length[short], kind="stable")]
    left, at, state = length[order], start[order], register[order]
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, side="left"))  # those longer than k come first
        state[:m] = CRC_TABLE[(state[:m] ^ data[at[:m] + k]) & np.uint32(255)] ^ (state[:m] >> np.uint32(8))
    register[order] = state
    return register


class Words:
    """The words of a batch of texts in one array: a space, then the word, for each; so consecutive words of a text are joined as features are."""

    def __init__(self, column: pa.Array):
        texts = tx.Texts(column)
        n = len(texts.data)
        # A gap after each text keeps its last word from running into the next text.
        padded = np.zeros(n + len(texts), np.uint8)
        owner_shift = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
        padded[np.arange(n) + owner_shift] = tx.LOWER[texts.data]
        inside = _IN_WORD[padded]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        lengths = np.flatnonzero(last) - starts + 1
        ends = np.cumsum(lengths + 1)
        self.start, self.length = ends - lengths, lengths
        self.data = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        body = np.ones(len(self.data), bool)
        body[self.start - 1] = False
        self.data[body] = padded[inside]
        gaps = texts.offsets + np.arange(len(texts) + 1)
        self.offsets = np.searchsorted(starts, gaps)  # text i has the words offsets[i]:offsets[i + 1]

    def keys(self) -> np.ndarray:
        """Two 64-bit words that hold the bytes of each word of at most HEAD_BYTES bytes; longer ones get zeros."""
        data = np.concatenate([self.data, np.zeros(HEAD_BYTES, np.uint8)])
        out = data[self.start[:, None] + np.arange(HEAD_BYTES)]
        out *= np.arange(HEAD_BYTES) < np.where(self.length > HEAD_BYTES, 0, self.length)[:, None]
        return np.ascontiguousarray(out).view(np.uint64).reshape(-1, 2)


def _key_hash(keys: np.ndarray) -> np.ndarray:
    return tx.mix(keys[:, 0] + tx.mix(keys[:, 1]))


@dataclass(frozen=True)
class Head:
    """Frequent words by descending count, and pairs of the first PAIR_WORDS of them. At most HEAD_WORDS words of HEAD_BYTES bytes and HEAD_PAIRS pairs."""

    keys: np.ndarray  # (words, 2)
    length: np.ndarray
    state: np.ndarray  # register after the word at the start of a feature
    after: np.ndarray  # what ' ' and the word make of a register that is zero
    order: np.ndarray  # words by hash
    hashes: np.ndarray  # sorted
    pair_codes: np.ndarray  # sorted first * PAIR_WORDS + second
    pair_state: np.ndarray
    pair_bucket: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each word in the head, -1 for others; a place is confirmed by the word's bytes."""
        if not len(self.hashes):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.hashes, _key_hash(keys)), len(self.hashes) - 1)
        place = self.order[at]
        return np.where((self.keys[place] == keys).all(axis=1) & (keys[:, 0] != 0), place, -1)


def make_head(words: list[str], pairs: list[tuple[int, int]]) -> Head:
    """The broadcast head of these words (most frequent first) and of these pairs of their places."""
    encoded = [w.encode() for w in words]
    padded = b"".join(w.ljust(HEAD_BYTES, b"\0") for w in encoded)
    keys = np.frombuffer(padded, np.uint64).reshape(-1, 2)
    data, length = np.frombuffer(b"".join(b" " + w for w in encoded), np.uint8), np.array([len(w) for w in encoded], np.int64)
    start = np.cumsum(length + 1) - length
    state = advance(np.full(len(words), _ONES, np.uint32), data, start, length)
    after = advance(np.zeros(len(words), np.uint32), data, start - 1, length + 1)
    hashes = _key_hash(keys)
    order = np.argsort(hashes, kind="stable")
    codes = np.array(sorted(a * PAIR_WORDS + b for a, b in pairs), np.int64)
    second = codes % PAIR_WORDS
    pair_state = _shifted(state[codes // PAIR_WORDS], length[second] + 1) ^ after[second] if len(codes) else np.zeros(0, np.uint32)
    return Head(keys, length, state, after, order, hashes[order], codes, pair_state, _bucket(pair_state))


def _bucket(register: np.ndarray) -> np.ndarray:
    return ((register ^ _ONES) % np.uint32(BUCKETS)).astype(np.uint16)


def feature_buckets(words: Words, head: Head) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, and how many each text has."""
    n = len(words.start)
    place = head.find(words.keys())
    known = place >= 0
    register = np.full(n, _ONES, np.uint32)
    register[known] = head.state[place[known]]
    other = np.flatnonzero(~known)
    register[other] = advance(register[other], words.data, words.start[other], words.length[other])
    owner = np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))
    buckets, valid = np.zeros((n, 3), np.uint16), np.zeros((n, 3), bool)
    buckets[:, 0], valid[:, 0] = _bucket(register), True
    whole = known  # all words of the feature so far are in the head
    for j in (1, 2):
        first = np.flatnonzero(owner[: max(n - j, 0)] == owner[j:])
        last = first + j
        headed = whole[first] & known[last]
        state, out = register[first], np.zeros(len(first), np.uint32)
        found = np.zeros(len(first), bool)
        if j == 1 and len(head.pair_codes):
            frequent = headed & (place[first] < PAIR_WORDS) & (place[last] < PAIR_WORDS)
            code = np.where(frequent, place[first] * PAIR_WORDS + place[last], -1)
            at = np.minimum(np.searchsorted(head.pair_codes, code), len(head.pair_codes) - 1)
            found = head.pair_codes[at] == code
            out[found] = head.pair_state[at[found]]
            buckets[first[found], 1] = head.pair_bucket[at[found]]
        join, tail = np.flatnonzero(headed & ~found), np.flatnonzero(~headed)
        added = place[last[join]]
        out[join] = _shifted(state[join], head.length[added] + 1) ^ head.after[added]
        out[tail] = advance(state[tail], words.data, words.start[last[tail]] - 1, words.length[last[tail]] + 1)
        rest = np.flatnonzero(~found)
        buckets[first[rest], j] = _bucket(out[rest])
        valid[first, j] = True
        register = np.zeros(n, np.uint32)
        register[first] = out
        whole = np.zeros(n, bool)
        whole[first] = headed
    counts = tx.per_text(valid.sum(axis=1), words.offsets, np.add, 0)
    return buckets[valid], counts


def _most_frequent(counted: DataFrame, value: str, limit: int) -> list:
    """The values counted most often, at most ``limit``: all from a count on that is found from a histogram with eight bins an octave.

    So the driver gets the histogram and the chosen values, however many tasks there are.
    """
    folder = scratch_dir(counted.sparkSession, "counted")
    counted.write.mode("overwrite").parquet(folder)
    counted = counted.sparkSession.read.schema(counted.schema).parquet(folder)
    level = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, None
    for r in sorted(counted.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > limit:
            break
        least = r["level"]
    if least is None:
        return []
    return [r[value] for r in sorted(counted.where(level >= least).collect(), key=lambda r: (-r["n"], r[value]))]


def _frequent_words(texts: DataFrame) -> list[str]:
    """The most frequent words of at most HEAD_BYTES bytes, HEAD_WORDS at most, counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            # Equal words have equal keys, so sorting by both halves brings them together.
            keys, n = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            return keys[first], np.add.reduceat(n, first)

        def told() -> pa.RecordBatch:
            keys, n = held.pop()
            text = [k.tobytes().rstrip(b"\0").decode() for k in keys]
            return pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(n)], ["word", "n"])

        for part in tx.slices(batches, "text"):
            keys = Words(part.column("text")).keys()
            keys = keys[keys[:, 0] != 0]
            if len(keys):
                held.append((keys, np.ones(len(keys), np.int64)))
                held[:] = [summed()]
                if len(held[0][0]) > _COUNTED:
                    yield told()
        if held:
            yield told()

    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return _most_frequent(counted, "word", HEAD_WORDS)


def _frequent_pairs(texts: DataFrame, words: list[str]) -> list[tuple[int, int]]:
    """The most frequent pairs of the first PAIR_WORDS words, HEAD_PAIRS at most; a task counts in an array of fixed size."""
    head = texts.sparkSession.sparkContext.broadcast(make_head(words[:PAIR_WORDS], []))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(PAIR_WORDS * PAIR_WORDS, np.int64)
        for part in tx.slices(batches, "text"):
            found = Words(part.column("text"))
            place = head.value.find(found.keys())
            both = (place[:-1] >= 0) & (place[1:] >= 0)
            both[found.offsets[1:-1][(found.offsets[1:-1] > 0) & (found.offsets[1:-1] < len(place))] - 1] = False
            sums += np.bincount(place[:-1][both] * PAIR_WORDS + place[1:][both], minlength=len(sums))
        code = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(sums[code])], ["code", "n"])

    counted = texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return [divmod(code, PAIR_WORDS) for code in _most_frequent(counted, "code", HEAD_PAIRS)]


def learn_head(docs: DataFrame, text_col: str = "text") -> Head:
    """Frequent words and pairs of all texts. It only speeds hashing up; results are the same with any head."""
    tx.small_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    words = _frequent_words(texts)
    return make_head(words, _frequent_pairs(texts, words) if words else [])


def hashed(docs: DataFrame, head: Head, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, buckets: 16-bit little-endian numbers of all features) of every row, written once."""
    spark = docs.sparkSession
    tx.small_batches(spark)
    shared = spark.sparkContext.broadcast(head)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            words = Words(part.column("text"))
            buckets, counts = feature_buckets(words, shared.value)
            ends = np.cumsum(counts)
            stored = [buckets[e - c : e].astype("<u2").tobytes() for c, e in zip(counts, ends)]
            columns = [part.column("doc_id"), pa.array(np.diff(words.offsets), pa.int64()), pa.array(counts, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "buckets"])

    schema = rows.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_features"), F.lit(b"").alias("buckets")).schema
    folder = scratch_dir(spark, "hashed-features")
    rows.mapInArrow(run, schema).write.mode("overwrite").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def bucket_totals(features: DataFrame) -> np.ndarray:
    """How many features of all rows each bucket holds; the driver gets one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for stored in batch.column("buckets"):
                sums += np.bincount(np.frombuffer(stored.as_buffer(), "<u2"), minlength=BUCKETS)
        bucket = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(sums[bucket])], ["bucket", "n"])

    counted = features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(BUCKETS, np.int64)
    totals[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floor(1000 * log of the smoothed share in the target over that in the source)."""
    s_all, t_all = float(source.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows of ``hashed`` with ``weight``, the sum of the gains of their features, instead of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(b.as_buffer(), "<u2")].sum()) for b in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(sums, pa.int64())], ["doc_id", "n_words", "n_features", "weight"]
            )

    return features.mapInArrow(run, features.drop("buckets").withColumn("weight", F.lit(0).cast("long")).schema)


def ranked(rows: DataFrame, eligible: str, order: list, name: str) -> DataFrame:
    """The rows with ``name``: 1, 2, 3, ... over those where ``eligible`` holds, by ``order``; null for the others. Written twice.

    The rows are range-partitioned by the order and numbered within their partition; what the partitions before hold is added,
    one number per partition. No task sees more than its own range.
    """
    spark = rows.sparkSession
    folder = scratch_dir(spark, "ranked")
    keys = [F.expr(eligible).desc(), *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    # The upper bits of the number are the partition, the lower ones the place in it.
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.withColumn(name, F.when(F.expr(eligible), F.col("_before") + place + 1)).drop("_at", "_part", "_before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, and rank (1, 2, ...) of those drawn, null for others.

    The weight is the log ratio of a text's features in the ``target`` texts and in all of ``docs``, in thousandths. The score adds Gumbel noise that
    depends on seed and id only, so drawing the highest scores samples without replacement in proportion to exp(weight / 1000). ``percent``
    of the texts with ``least_words`` words or more are drawn, rounded down; ties go to the smaller id, nulls first.

    Null and empty texts have no features and weight 0. A null id draws the noise of an empty one. Repeated rows count and are drawn one by one; other columns
    are ignored. An empty table gives no rows; an empty target has a share of 1 / BUCKETS in every bucket.
    """
    head = learn_head(docs, text_col)
    features = hashed(docs, head, id_col, text_col)
    wanted = hashed(target.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")), head)
    rows = weighed(features, gains(bucket_totals(features), bucket_totals(wanted)))
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn.cast("double") + 0.5) / F.lit(4294967296.0))))
    rows = rows.withColumn("score", (F.col("weight") + noise).cast("long"))
    n = features.where(F.col("n_words") >= least_words).count()
    numbered = ranked(rows, f"n_words >= {int(least_words)}", [F.desc("score"), F.col("doc_id").asc_nulls_first(), F.col("weight")], "rank")
    return numbered.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
