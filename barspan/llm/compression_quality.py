"""Quality classifier by compression: a text is like the good texts if a dictionary of good texts compresses it better than one of bad texts.

Two zstandard dictionaries are built from a bounded sample of pieces of labelled texts, one per label. A text is cut into
pieces, so that a long one meets the dictionary at every place; all pieces are compressed with either dictionary. The
difference of the two sizes per byte of the text is the evidence, and a rising curve turns it into a
probability. The curve is fitted on labelled texts that gave no piece to the dictionaries, since a dictionary knows its own texts too well.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

#: Bytes of a text that are compressed at once.
PIECE = 1024
DICTIONARY_BYTES = 131_072
LEVEL = 3
#: Bounds on what is learned from, of each label: about so many documents, and pieces for its dictionary. Those with the smallest hashes are taken.
TRAIN_ROWS = 100_000
SAMPLE_PIECES = 20_000
#: Bins of the curve, and the least texts of a bin.
BINS, _BIN_TEXTS = 200, 10
#: Fewer pieces than this can't train a dictionary: they are used as they are.
_FEW_PIECES = 64


def pieces(text: bytes) -> list[bytes]:
    """The whole text in pieces; an empty text is one empty piece."""
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few or too small to train one."""
    if len(samples) >= _FEW_PIECES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:DICTIONARY_BYTES]


@dataclass(frozen=True)
class Model:
    """``good`` and ``bad`` are dictionaries, None where a label never occurs; the curve runs through ``values`` at ``places``."""

    good: bytes | None
    bad: bytes | None
    places: np.ndarray
    values: np.ndarray

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **options) for d in (self.bad, self.good)]

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return np.interp(evidence, self.places, self.values)


def evidence(texts: list[str | None], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Size with the bad dictionary minus size with the good one, per byte of the text; 0 for null and empty texts."""
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        data = (text or "").encode()
        if data:
            bad, good = (sum(len(c.compress(p)) for p in pieces(data)) for c in compressors)
            out[i] = (bad - good) / len(data)
    return out


def fit_curve(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a curve that never falls: the smoothed share of good texts in bins of equal count, falling neighbours pooled."""
    if not len(x):
        return np.zeros(1), np.full(1, 0.5)
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of x, texts, good ones
    bins = min(BINS, max(1, len(x) // _BIN_TEXTS))
    # Equal values stay in one bin.
    bounds = np.unique(np.searchsorted(x[order], x[order[[len(x) * i // bins for i in range(1, bins)]]]))
    for part in np.split(order, bounds[bounds > 0]):
        blocks.append([float(x[part].sum()), len(part), int(good[part].sum())])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    sums, n, hits = np.array(blocks).T
    # Smoothing may turn neighbours of very different size around by a trifle.
    return sums / n, np.maximum.accumulate((hits + 0.5) / (n + 1))


def _smallest(counts: dict, limit: int, key: str, by: str) -> Column:
    """Whether a row is among about ``limit`` of each value of ``by``, of which there are ``counts``: its hash is in the lowest part of the range.

    A bound on the hash needs no sorting, and no task sends more than its share.
    """
    top = (1 << 63) - 1
    bounds = F.lit(None).cast("long")
    for value, n in counts.items():
        bounds = F.when(F.col(by) == value, F.lit(top if n <= limit else top // n * limit)).otherwise(bounds)
    return F.xxhash64(key, F.lit(2)).bitwiseAND(F.lit(top)) <= bounds


def _labelled(docs: DataFrame, labels: DataFrame, label: str, train: Column, id_col: str, text_col: str) -> DataFrame:
    """(text, good) of the training rows with one known label, written once; ids that are null or have both labels are left out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id"))
    known = known.agg(F.min(label).alias("_good"), F.max(label).alias("_high")).where(F.col("_good") == F.col("_high")).select("_id", "_good")
    counts = {r["_good"]: r["count"] for r in known.groupBy("_good").count().collect()}
    known = known.where(_smallest(counts, TRAIN_ROWS, "_id", "_good"))
    rows = docs.where(train).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most about 2 * TRAIN_ROWS ids, so they may be broadcast whatever the tables' size.
    rows = rows.join(F.broadcast(known), "_id").select("text", (F.col("_good") == 1).alias("good"))
    folder = scratch_dir(docs.sparkSession, "labelled")
    rows.write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Learn from the documents where ``train`` holds and whose ``label`` in ``labels`` is 1 (good) or 0 (bad).

    About TRAIN_ROWS labelled ids of each label are used at most. Half of their texts, chosen by a hash of the text, gives pieces to the dictionaries,
    the other half fits the curve; equal texts fall in one half. The driver gets about SAMPLE_PIECES pieces and TRAIN_ROWS numbers a label at
    most. Without rows of one label there is nothing to compare: the score of every text is then the smoothed share of good ones.
    """
    tx.small_batches(docs.sparkSession)
    rows = _labelled(docs, labels, label, train, id_col, text_col)
    half = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            found = [(g, p) for g, t in zip(part.column("good").to_pylist(), part.column("text").to_pylist()) if t for p in pieces(t.encode())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in found], pa.bool_()), pa.array([p for _, p in found], pa.binary())], ["good", "piece"]
            )

    ours = rows.where(half == 0)
    size = F.ceil(F.octet_length("text") / PIECE)
    counts = {r["good"]: r["n"] for r in ours.where("text <> ''").groupBy("good").agg(F.sum(size).alias("n")).collect()}
    cuts = ours.select("text", "good").mapInArrow(cut, "good boolean, piece binary").where(_smallest(counts, SAMPLE_PIECES, "piece", "good"))
    # Copies of one piece share a hash: they come once.
    cuts = cuts.dropDuplicates(["good", "piece"])
    samples: dict[bool, list[bytes]] = {True: [], False: []}
    for r in cuts.toArrow().to_pylist():
        samples[r["good"]].append(r["piece"])
    samples = {good: sorted(found, key=lambda p: (zlib.crc32(p), p)) for good, found in samples.items()}
    counts = {r["good"]: r["count"] for r in rows.groupBy("good").count().collect()}
    if not (samples[True] and samples[False]):
        share = (counts.get(True, 0) + 1) / (sum(counts.values()) + 2)
        return Model(None, None, np.zeros(1), np.full(1, share))
    raw = Model(build_dictionary(samples[True]), build_dictionary(samples[False]), np.zeros(1), np.zeros(1))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = shared.value.compressors()
        for part in tx.slices(batches, "text"):
            x = evidence(part.column("text").to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays([part.column("good"), part.column("hash"), pa.array(x)], ["good", "hash", "x"])

    shared = docs.sparkSession.sparkContext.broadcast(raw)
    curve = rows.where(half == 1).select("text", "good", F.xxhash64("text").alias("hash")).mapInArrow(weigh, "good boolean, hash long, x double")
    got = curve.orderBy("hash", "x", "good").toArrow()
    return replace(raw, **dict(zip(("places", "values"), fit_curve(got["x"].to_numpy(), got["good"].to_numpy(zero_copy_only=False).astype(bool)))))


def classify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """The rows with all their columns and ``out``, the probability of a good text; a column of that name is replaced.

    It depends on the text alone. Null and empty texts show no evidence and get the curve's value at 0.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    docs = docs.drop(out)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        compressors = known.compressors() if known.good is not None else None
        for part in tx.slices(batches, text_col):
            x = evidence(part.column(text_col).to_pylist(), compressors) if compressors else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(known.scores(x))], [*part.schema.names, out])

    return docs.mapInArrow(score, docs.select("*", F.lit(0.0).alias(out)).schema)
