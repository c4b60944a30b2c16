"""Token-ID output: whole texts tokenised and written, in document order, as Simple-8b token files.

Documents are dealt into blocks of neighbouring ids (one shuffle of the texts); each task writes a file per block and
returns a row about it. A file name is new for every attempt, and only files named by a finished
task's row are ever read, so a lost executor or a repeated task does no harm.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.llm.word_packing import NO_ID, TokenFile, TokenFileWriter
from barspan.session import scratch_dir

END_ID = 1
#: Entries of a task's word cache; it is emptied when full, so its memory is bounded.
CACHE_WORDS = 800_000

# The printable stand-in of each byte in byte-level vocabularies: Latin letters and signs stand for themselves,
# the other bytes for the characters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_INS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}

_MANIFEST = "path string, block int, n_docs long, n_ids long, n_bytes long"
_tokenizers: dict[str, "WordCache"] = {}


class WordCache(dict):
    """Ids of white-space separated words, as little-endian 32-bit integers.

    Only for tokenizers that drop white space and fold case, as ``splits_at_spaces`` tests: then a text's ids are
    its words' ids, and a corpus has far fewer different words than words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = self._splits_at_spaces()

    def _splits_at_spaces(self) -> bool:
        probe = ["Ab, c's", "\t(x) 12.5\n\n", "É  ß. Q", "naïve vorüber"]
        whole = [self.tokenizer.encode(p.lower(), add_special_tokens=False).ids for p in probe]
        parts = [[i for w in p.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids] for p in probe]
        letters = ["a", "naïve", "vorüber", "señor"]
        plain = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in letters]
        return whole == parts and plain == [self._letters(w) for w in letters]

    def _letters(self, word: str) -> list[int]:
        """Ids of a word of small letters only: it passes normalisation and splitting unchanged, so the model alone is asked."""
        return [t.id for t in self.tokenizer.model.tokenize("".join([_STAND_INS[b] for b in word.encode()]))]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) > 1 and word[-1:] in b".," and word[-2:-1].isalnum():
            # A full stop or comma after a plain letter or digit is a piece of its own.
            found = self[word[:-1]] + self[word[-1:]]
        else:
            text = word.decode()
            if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                ids = self._letters(text)
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        # bytes.lower() folds A-Z and bytes.split() parts at \x20 and \x09-\x0D; a text that may hold a special token keeps its case.
        split = [(b if b"<|" in (b := t.encode()) else b.lower()).split() for t in texts]
        return [b"".join([self[w] for w in words]) for words in split]


def _cache(path: str) -> WordCache:
    if path not in _tokenizers:
        _tokenizers[path] = WordCache(path)
    return _tokenizers[path]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the documents' ids to ``folder`` and return one row per file: path, block, n_docs, n_ids, n_bytes.

    Every text is encoded whole, followed by ``end_id``; files and the documents in them ascend by
    ``id_col`` (nulls first, equal ids by text). A null or empty text is just ``end_id``; rows with equal ids are documents of
    their own; an empty table gives no file. Other columns are ignored. The returned frame writes when it is evaluated, so
    evaluate it once (``token_files`` does) and keep its rows.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    folder = tx.qualified(spark, folder)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words = _cache(tokenizer)
        for part in tx.slices(batches, "text"):
            ids = words.encode(part.column("text").to_pylist())
            yield from zip(part.column("block").to_pylist(), part.column("doc_id").to_pylist(), ids)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for block, members in groupby(of_batches(batches), key=lambda x: x[0]):
            out = TokenFileWriter()
            for _, doc_id, ids in members:
                out.add(doc_id, np.frombuffer(ids + end, "<u4"))
            content = out.content()
            fs.create_dir(root, recursive=True)
            name = f"block-{block:06d}-{uuid.uuid4().hex}.s8b"
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(content)
            row = (f"{folder}/{name}", block, len(out.doc_ids), out.n, len(content))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["path", "block", "n_docs", "n_ids", "n_bytes"],
            )

    placed = tx.ordered_blocks(rows, "doc_id", tx.block_count(spark)).select("block", "doc_id", "text")
    return placed.mapInArrow(write, _MANIFEST)


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write token files (in a new scratch folder by default) and return their manifest, with ``first``: ids in all files before."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    write_token_files(docs, f"{folder}/files", tokenizer, **options).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    # One row per file, so one task orders them.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and tokens.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(at) as f:
                    file = TokenFile(f.read())
                for low in range(0, len(file.doc_ids), tx.BATCH_ROWS):
                    some = range(low, min(low + tx.BATCH_ROWS, len(file.doc_ids)))
                    ids = [file.ids(i).astype("<u4") for i in some]
                    lengths = np.array([len(x) for x in ids], np.int64)
                    doc_ids = file.doc_ids[low : some.stop]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID),
                            pa.array(first + file.starts[low : some.stop], pa.int64()),
                            pa.array(lengths),
                            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                            pa.ListArray.from_arrays(
                                pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(np.concatenate(ids).astype(np.int64))
                            ),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "tokens"],
                    )

    # Dealing out by path spreads the few rows over all tasks.
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = manifest.select("path", "first").repartition(parts, "path")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, tokens array<long>")
