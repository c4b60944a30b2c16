"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside the tasks and sums small count tables over the cluster, so
the driver receives one row per (language, bucket), however large the corpus. The matrix of
log probabilities (languages x buckets) goes to the tasks with the scoring function; its size is fixed by those two numbers.
A batch is scored as a sparse product: each n-gram picks its bucket's row, rows are summed per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Bound on the training rows: beyond it rare languages keep all rows, and of the others those with the smallest hashes of their text are used.
TRAIN_ROWS = 2_000_000
#: More languages than this are an error; keeps matrix and counts small.
MAX_LANGUAGES = 256

_RANGES = 0x110000


def _letters() -> np.ndarray:
    """Which code points are letters; everything else counts as one kind of gap."""
    return np.array([chr(c).isalpha() for c in range(_RANGES)])


_is_letter: np.ndarray | None = None


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts with gaps as spaces, a gap before and after each text; text offsets; letters."""
    global _is_letter
    if _is_letter is None:
        _is_letter = _letters()
    parts = [f" {t.lower()} ".encode("utf-32-le", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int64)
    points = np.frombuffer(b"".join(parts), np.uint32)
    letter = _is_letter[points]
    return np.where(letter, points, np.uint32(32)), offsets, letter


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams with at least one letter, offsets of each text's n-grams, and each text's number of letters."""
    points, offsets, letter = _points(texts)
    letters = tx.per_text(letter.astype(np.int64), offsets, np.add, 0)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    wide = points.astype(np.uint64)
    buckets, kept = np.zeros((len(points), len(ORDERS)), np.int64), np.zeros((len(points), len(ORDERS)), bool)
    for o, n in enumerate(ORDERS):
        m = len(points) - n + 1
        if m <= 0:
            continue
        code, any_letter = np.full(m, n, np.uint64), np.zeros(m, bool)
        for j in range(n):
            code = code * np.uint64(tx.BASE) + wide[j : j + m]
            any_letter |= letter[j : j + m]
        buckets[:m, o] = (tx.mix(code) % np.uint64(BUCKETS)).astype(np.int64)
        kept[:m, o] = any_letter & (owner[:m] == owner[n - 1 :])
    per = tx.per_text(kept.sum(axis=1), offsets, np.add, 0)
    return buckets[kept], np.concatenate([[0], np.cumsum(per)]), letters


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_probability: np.ndarray  # (buckets, languages)
    log_prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text; UNKNOWN with 0 where there is no letter or nothing was learned."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        buckets, offsets, letters = ngrams(texts)
        sums = tx.per_text(self.log_probability[buckets].astype(np.float64), offsets, np.add, 0.0) + self.log_prior
        best = sums.argmax(axis=1)
        posterior = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        known = letters > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, posterior, 0.0)


def fit(docs: DataFrame, train: Column, lang_col: str = "lang", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the rows where ``train`` holds and language and text are not null.

    Other columns are never read. At most about ``train_rows`` rows are used: all of a language that has no more than an equal share of
    them, of the others those with the smallest text hashes, so equal rows are in or out together. More than MAX_LANGUAGES languages are
    an error; a table without such rows gives a model that answers UNKNOWN.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # Counting rows per language reads no texts.
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    sizes = dict(sorted((r["lang"], r["count"]) for r in sizes))
    languages, total = list(sizes), sum(sizes.values())
    if total > train_rows:
        top = (1 << 63) - 1
        rare = {lang: n for lang, n in sizes.items() if n * len(sizes) <= train_rows}
        part = (train_rows - sum(rare.values())) / (total - sum(rare.values()))
        rows = rows.where(F.col("lang").isin(list(rare)) | (F.xxhash64("text").bitwiseAND(F.lit(top)) <= F.lit(int(part * top))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        place = {lang: i for i, lang in enumerate(languages)}
        for part in tx.slices(batches, "text"):
            buckets, offsets, _ = ngrams(part.column("text").to_pylist())
            rows_lang = np.array([place.get(x, -1) for x in part.column("lang").to_pylist()])
            lang = np.repeat(rows_lang, np.diff(offsets))
            flat = (lang * BUCKETS + buckets)[lang >= 0]
            sums += np.bincount(flat, minlength=sums.size).reshape(sums.shape)
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(sums[lang, bucket])], ["lang", "bucket", "n"]
        )

    counted = rows.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros((BUCKETS, len(languages)))
    got = counted.toArrow()  # at most MAX_LANGUAGES x BUCKETS rows
    sums[got["bucket"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
    smooth = sums + 0.5
    prior = np.log(np.array(list(sizes.values()), float) / total)
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32), prior)


def classify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """The rows with all their columns and a struct column ``out`` (lang, score); a column of that name is replaced.

    The answer depends on the text alone. Null and empty texts and texts without letters get UNKNOWN and 0.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    docs = docs.drop(out)
    broadcast = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, text_col):
            lang, posterior = broadcast.value.predict([t or "" for t in part.column(text_col).to_pylist()])
            found = pa.StructArray.from_arrays([pa.array(lang), pa.array(posterior)], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, out])

    schema = docs.select("*", F.lit(None).cast("struct<lang:string,score:double>").alias(out)).schema
    return docs.mapInArrow(score, schema)
