"""Document fingerprints: paragraph sketches of documents and of other versions of them (see ``iblt``)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import iblt
from barspan.llm import texts as tx


def _digests(texts: list[str]) -> iblt.Digests:
    return iblt.Digests(tx.Texts(pa.array(texts, pa.large_string())))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row. Null and empty texts have the empty sketch; equal texts have equal fingerprints."""
    tx.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            found = iblt.fingerprints(iblt.Digests(tx.Texts(part.column("text"))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def version_changes(versions: DataFrame, id_col: str = "doc_id", old_col: str = "old", new_col: str = "new") -> DataFrame:
    """(doc_id, removed, added, likeness): digests of pieces that only the old or only the new text of a row has, recovered by peeling."""
    tx.small_batches(versions.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "old"):
            old, new = (iblt.Digests(tx.Texts(part.column(c))) for c in ("old", "new"))
            every = np.arange(part.num_rows)
            found = iblt.differences(old, every, new, every)
            lists = [pa.array([np.sort(f[i].view(np.int64)).tolist() for f in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *lists, pa.array(iblt.likeness(old, every, new, every))], ["doc_id", "removed", "added", "likeness"]
            )

    rows = versions.select(F.col(id_col).cast("long").alias("doc_id"), F.col(old_col).alias("old"), F.col(new_col).alias("new"))
    return rows.mapInArrow(run, "doc_id long, removed array<long>, added array<long>, likeness double")


def edited(text: str, follower: str) -> str:
    """The text with its last half of code points replaced by as many from the start of the next text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


_KINDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that text and to the next document.

    The next document is that with the next larger id, the first one's after the last; rows are ordered by id (nulls first) and then by text, so each
    row has a next one. Null texts are empty. A table of one row is followed by itself. Other columns are ignored. Texts move once: documents are dealt
    into blocks of neighbouring ids, and the row that opens a block also ends the block before.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = tx.ordered_blocks(rows, "doc_id", tx.block_count(spark), guests=True).select("block", "guest", "doc_id", "text")

    def compared(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, which only follows."""
        own, follower = texts[:-1], texts[1:]
        changed = [edited(t, f) for t, f in zip(own, follower)]
        mine, other = _digests(texts), _digests(changed)
        every = np.arange(len(own))
        prints = iblt.fingerprints(mine)[:-1]
        columns = [
            pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(prints, pa.string()), pa.array(iblt.fingerprints(other), pa.string()),
            pa.array(iblt.likeness(mine, every, other, every)), pa.array(iblt.likeness(mine, every, mine, every + 1)),
        ]
        return pa.RecordBatch.from_arrays(columns, [k.split()[0] for k in _KINDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, block, ended, size = [], [], None, False, 0
        for part in tx.slices(batches, "text"):
            for b, guest, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("block", "guest", "doc_id", "text"))):
                if b != block:
                    if len(ids) > 1:
                        yield compared(ids, texts)
                    ids, texts, block, ended, size = [], [], b, False, 0
                if ended:
                    continue  # rows with the id that opens the next block: only the first of them follows
                if size >= tx.SLICE_BYTES and len(ids) > 1:
                    yield compared(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                ended = guest
        if len(ids) > 1:
            yield compared(ids, texts)

    return placed.mapInArrow(run, _KINDS)
