"""Line dedup: hashed lines are range-partitioned and streamed in order; documents get keep bitmaps, texts stay where they are.

Lines become (hash, document, position) rows, range-partitioned by hash and document and sorted by hash, descending
document and position. A task streams its rows once and remembers little: for a hash, the first document it meets keeps its
lines, and the rows of the others are dropped as soon as enough documents are seen.

The range bounds may cut a hash that very many documents have, so it is spread over tasks. A task can't judge its first
and last hash alone; their rows are marked, counted over tasks with map-side sums, and settled by a join with at most two hashes a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

LEAST_POINTS = 40
LEAST_DOCS = 5

_DROP, _OPEN, _SEEN = 0, 1, 2
_LINES = "ha long, hb long, doc long, version long, line int, n_lines int"
_JUDGED = "ha long, hb long, doc long, version long, line int, n_lines int, verdict byte"


def _keys(rows: DataFrame, least_points: int) -> DataFrame:
    """(ha, hb, doc, version, line, n_lines) of the lines whose key has at least ``least_points`` code points."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            texts = tx.Texts(part.column("text"))
            start, end, owner = texts.lines()
            solid = np.append(np.flatnonzero(~tx.SPACES[texts.data]), len(texts.data))
            low, high = np.searchsorted(solid, start), np.searchsorted(solid, end) - 1
            some = np.flatnonzero(high >= low)
            low, high = solid[low[some]], solid[high[some]] + 1
            points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
            keep = points[high] - points[low] >= least_points
            some, low, high = some[keep], low[keep], high[keep]
            firsts = np.searchsorted(owner, np.arange(len(texts) + 1))
            folded = tx.LOWER[texts.data]
            hashes = [tx.content_hashes(folded, tx.prefix_hashes(folded, f), low, high, f).view(np.int64) for f in (0, 1)]
            doc = owner[some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[0]), pa.array(hashes[1]), part.column("doc").take(pa.array(doc)), part.column("version").take(pa.array(doc)),
                    pa.array((some - firsts[doc]).astype(np.int32)), pa.array(np.diff(firsts)[doc].astype(np.int32)),
                ],
                [c.split()[0] for c in _LINES.split(", ")],
            )

    return rows.select("doc", "version", "text").mapInArrow(lines, _LINES)


def _judge(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Verdicts on sorted rows: rows to drop, rows of the first or last hash (open), and documents already seen of the last hash."""
    key, first, held, docs = None, None, [], []

    def out(batch: pa.RecordBatch, verdict: int) -> pa.RecordBatch:
        marks = pa.array(np.full(batch.num_rows, verdict, np.int8))
        return pa.RecordBatch.from_arrays([*batch.columns, marks], [c.split()[0] for c in _JUDGED.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        ha, hb, doc = (batch.column(c).to_numpy() for c in ("ha", "hb", "doc"))
        bounds = np.flatnonzero((ha[1:] != ha[:-1]) | (hb[1:] != hb[:-1])) + 1
        begins, ends = np.append(0, bounds), np.append(bounds, len(ha))
        # A hash with fewer rows than documents asked for, inside the batch, drops nothing.
        for g in np.flatnonzero((ends - begins >= least_docs) | (begins == 0) | (ends == len(ha))):
            a, b = int(begins[g]), int(ends[g])
            now = (int(ha[a]), int(hb[a]))
            if now != key:
                key, held, docs = now, [], []
                first = now if first is None else first
            if now == first:
                yield out(batch.slice(a, b - a), _OPEN)
                continue
            of = doc[a:b]
            new = of[np.append(True, of[1:] != of[:-1])]
            was = len(docs)
            docs += [int(d) for d in new[: least_docs + 1] if len(docs) < least_docs and (not docs or d != docs[-1])]
            part = batch.slice(a, b - a)
            if len(docs) < least_docs:
                held.append(part)
                continue
            if was < least_docs:
                for h in held:
                    yield out(h.filter(pc.not_equal(h.column("doc"), docs[0])), _DROP)
                held = []
            yield out(part.filter(pc.not_equal(part.column("doc"), docs[0])), _DROP)
    if key is not None and key != first:
        for h in held:
            yield out(h, _OPEN)
        if not held:
            n = len(docs)
            seen = [pa.array([key[0]] * n), pa.array([key[1]] * n), pa.array(docs), *[pa.array([0] * n, t) for t in (pa.int64(), pa.int32(), pa.int32())]]
            yield out(pa.RecordBatch.from_arrays(seen, [c.split()[0] for c in _LINES.split(", ")]), _SEEN)


def keep_bitmaps(
    docs: DataFrame, least_points: int = LEAST_POINTS, least_docs: int = LEAST_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, version, n_lines, n_dropped, keep) for the documents that lose lines.

    A line's key is the line without spaces at its ends, A-Z folded. Keys of ``least_points`` code points or more found in
    ``least_docs`` documents lose all lines but those of the largest id. ``keep`` is a zlib-compressed bitmap, most significant bit first. Rows with
    one id and different texts are versions (``version`` hashes the text) of one document; a null id counts as the
    smallest document. Null and empty texts are one empty line. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    folder = scratch_dir(spark, "lines")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["ha", "hb", F.desc("doc"), "version", "line"]
    keys = _keys(rows, least_points).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    judged = keys.mapInArrow(lambda batches: _judge(batches, least_docs), _JUDGED)
    judged.write.mode("overwrite").parquet(folder)
    judged = spark.read.schema(judged.schema).parquet(folder)
    open_keys = judged.where(F.col("verdict") != _DROP).groupBy("ha", "hb", "doc").agg(F.lit(1)).groupBy("ha", "hb")
    common = open_keys.agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= least_docs).drop("n")
    # At most two hashes per partition of the sort.
    settled = judged.where(F.col("verdict") == _OPEN).join(F.broadcast(common), ["ha", "hb"]).where("doc <> keeper")
    drops = judged.where(F.col("verdict") == _DROP).unionByName(settled.drop("keeper"))
    # One document's dropped lines: no more than its text has.
    by_doc = drops.groupBy("doc", "version").agg(F.max("n_lines").alias("n_lines"), F.collect_set("line").alias("lines"))

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, lines = [], batch.column("lines")
            for i, n in enumerate(batch.column("n_lines").to_pylist()):
                keep = np.ones(n, bool)
                keep[lines[i].values.to_numpy()] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            columns = [*(batch.column(c) for c in ("doc", "version", "n_lines")), pc.list_value_length(lines), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "version", "n_lines", "n_dropped", "keep"])

    found = by_doc.mapInArrow(bitmaps, "doc long, version long, n_lines int, n_dropped int, keep binary")
    return found.select(F.nullif("doc", F.lit(-(1 << 63))).alias("doc_id"), "version", "n_lines", "n_dropped", "keep")


def kept_lines(text: str | None, keep: bytes | None) -> tuple[str, int, int]:
    """The text without the lines its bitmap drops, its number of lines, and how many were dropped."""
    text = text or ""
    if keep is None:
        return text, text.count("\n") + 1, 0
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join([x for x, b in zip(lines, bits) if b]), len(lines), int(len(lines) - bits.sum())


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, keep) of every row; ``keep`` is null where all lines stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    maps = bitmaps.select(F.col("doc_id").alias("of"), F.col("version").alias("v"), "keep")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("v"))
    return rows.join(maps, same, "left").select("doc_id", "text", "keep")
