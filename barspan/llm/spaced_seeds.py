"""Benchmark decontamination by spaced seeds.

A mask is laid at every word position and hashes only some of the words below it, so a passage in which other words
were replaced still meets its benchmark item. Test hashes and training hashes meet in an equi-join; around each hit the words
are compared one to one, and the overlap counts if enough of a window agrees.

Most training positions match nothing. A bitmap of the test hashes, of bounded size however large the benchmark is, drops them
inside the tasks; whatever it lets through goes to the join, which decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.session import scratch_dir

#: Positions that are hashed (1) or ignored (0). Wherever three of 15 words are replaced, one of these masks meets none of them
#: (tests go through all cases).
MASKS = ("110100111", "110101011", "110010111", "111100011")
SPAN = 9
#: More masks for items of just so many words: in them the masks above have few places, and not every permitted set of replaced words
#: leaves one of those free (tests go through all cases; 13 and 14 words need none).
SHORT_MASKS = {
    9: ("1111111",),
    10: ("1111011", "1011111", "11101101"),
    11: ("1111111", "11111011", "101111011"),
    12: ("11101111",),
}
#: A window of this many words counts if this many of them agree. Items with fewer words are compared whole, in proportion;
#: those shorter than the masks must agree in all words.
WINDOW, AGREE = 15, 12
#: Items with fewer words prove nothing.
LEAST_WORDS = 6
#: Hits of a text are verified by stretches of this many words, with WINDOW + SPAN more to either side.
STRETCH = 32
MARGIN = WINDOW + SPAN
#: Bits of the bitmap of test hashes (4 MB), two per hash.
FILTER_BITS = 1 << 25


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters a-z folded) and the offsets of each text's words."""
    texts = tx.Texts(column)
    starts, ends = texts.words()
    folded = tx.LOWER[texts.data]
    hashes = tx.content_hashes(folded, tx.prefix_hashes(folded), starts, ends)
    return hashes, np.searchsorted(starts, texts.offsets)


def _seeds(hashes: np.ndarray, offsets: np.ndarray, masks: Iterable[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each mask: its number, the positions where it lies inside one text, and the hashes there."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for number, mask in enumerate(masks):
        n = len(hashes) - len(mask) + 1
        if n <= 0:
            continue
        code = np.full(n, len(mask), np.uint64)
        for j, used in enumerate(mask):
            if used == "1":
                code = code * np.uint64(tx.BASE) + hashes[j : j + n]
        inside = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
        yield number, inside, tx.mix(code[inside] + np.uint64(number))


def _masks(lengths: list[int]) -> dict[str, set[int]]:
    """The masks, and those for short items of the lengths that occur: a full mask below SPAN, else SHORT_MASKS. With each mask the
    lengths of the items that it is for; none are named with masks for all items."""
    masks = {mask: set() for mask in MASKS}
    for n in sorted(lengths):
        for mask in ("1" * n,) if n < SPAN else SHORT_MASKS.get(n, ()):
            masks.setdefault(mask, set()).add(n)
    return masks


def _spots(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in the bitmap."""
    return code % np.uint64(FILTER_BITS), (code >> np.uint64(32)) % np.uint64(FILTER_BITS)


def _has(bits: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _item_seeds(items: DataFrame, masks: dict[str, set[int]]) -> DataFrame:
    """(hash, item_id, item_at) of all items. A mask that names lengths is only for items of these."""
    only = [np.array(sorted(lengths), np.int64) for lengths in masks.values()]

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            hashes, offsets = _word_hashes(part.column("text"))
            lengths = np.diff(offsets)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            ids = part.column("item_id").to_numpy()
            for number, at, code in _seeds(hashes, offsets, masks):
                if len(only[number]):
                    keep = np.isin(lengths[owner[at]], only[number])
                    at, code = at[keep], code[keep]
                columns = [pa.array(code.view(np.int64)), pa.array(ids[owner[at]]), pa.array((at - offsets[owner[at]]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "item_id", "item_at"])

    return items.select("item_id", "text").mapInArrow(seed, "hash long, item_id long, item_at int")


def _item_words(items: DataFrame) -> DataFrame:
    """(item_id, item_words): the item's word hashes, cut to 32 bits."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            hashes, offsets = _word_hashes(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("item_id"), lists], ["item_id", "item_words"])

    return items.select("item_id", "text").mapInArrow(words, "item_id long, item_words array<int>")


def _hit_stretches(rows: DataFrame, masks: Iterable[str], bitmap) -> DataFrame:
    """Stretches of texts with seeds that the bitmap has: (doc_id, stretch, first, words, hits).

    ``words`` are 32-bit word hashes of the stretch and its margins, beginning at word ``first``; ``hits`` are (at, hash).
    """
    kinds = "doc_id long, stretch int, first int, words array<int>, hits array<struct<at:int,hash:long>>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for part in tx.slices(batches, "text"):
            hashes, offsets = _word_hashes(part.column("text"))
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            at, code = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for _, places, codes in _seeds(hashes, offsets, masks):
                one, two = _spots(codes)
                some = np.flatnonzero(_has(bits, one))
                some = some[_has(bits, two[some])]
                at.append(places[some])
                code.append(codes[some])
            at, code = np.concatenate(at), np.concatenate(code)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, code = at[order], code[order]
            doc = owner[at]
            inner = (at - offsets[doc]).astype(np.int32)
            stretch = inner // STRETCH
            new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (stretch[1:] != stretch[:-1])))
            base = offsets[doc[new]]
            low = np.maximum(base + stretch[new] * STRETCH - MARGIN, base)
            high = np.minimum(base + (stretch[new] + 1) * STRETCH + MARGIN, offsets[doc[new] + 1])
            hits = pa.StructArray.from_arrays([pa.array(inner), pa.array(code.view(np.int64))], ["at", "hash"])
            ids = part.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[doc[new]]), pa.array(stretch[new]), pa.array((low - base).astype(np.int32)),
                    _ranges(hashes.astype(np.uint32).view(np.int32), low, high),
                    pa.ListArray.from_arrays(pa.array(np.append(new, len(at)), pa.int32()), hits),
                ],
                [k.split()[0] for k in kinds.split(", ")],
            )

    return rows.select("doc_id", "text").mapInArrow(find, kinds)


def _ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """values[start:end] of each pair of bounds as lists."""
    lengths = end - start
    ends = np.cumsum(lengths)
    inner = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values[np.repeat(start, lengths) + inner]))


def _best_window(words: np.ndarray, first: int, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(agreeing words, window length, first word) of the best window, the item's word 0 lying on the text's word ``shift``."""
    low, high = max(first, shift), min(first + len(words), shift + len(item))
    window = min(WINDOW, len(item))
    if high - low < window:
        return None
    same = (words[low - first : high - first] == item[low - shift : high - shift]).astype(np.int32)
    sums = np.convolve(same, np.ones(window, np.int32), "valid")
    best = int(sums.argmax())
    return int(sums[best]), window, low + best


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, overlap_start, n_agree, n_window): each document's best overlap with each item that it repeats.

    A document repeats an item if in some window of WINDOW words at least AGREE agree with the item's; see the constants for shorter
    items. Words are parted by spaces, with A-Z folded. Null or empty texts and items of fewer
    than LEAST_WORDS words match nothing; null ids are left out; rows with equal ids count as one document or item. Other columns are
    ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    folder = scratch_dir(spark, "seeds")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = items.where("item_id IS NOT NULL").withColumn("n", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))
    items = items.where(F.col("n") >= LEAST_WORDS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")

    short = [r["n"] for r in items.where(F.col("n") <= max(SHORT_MASKS)).select("n").distinct().collect()]  # at most max(SHORT_MASKS) values
    masks = _masks(short)
    tests = _item_seeds(items, masks)
    # FILTER_BITS divides 2^64, so the signed hash has the same remainder as the unsigned one.
    spots = F.explode(F.array(F.pmod("hash", F.lit(FILTER_BITS)), F.pmod(F.shiftrightunsigned("hash", 32), F.lit(FILTER_BITS))))
    words = tests.select(spots.alias("spot")).groupBy((F.col("spot") / 8).cast("int").alias("byte"))
    got = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("spot") % 8).cast("int"))).alias("bits")).toArrow()  # at most FILTER_BITS / 8 rows
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    bits[got["byte"].to_numpy()] = got["bits"].to_numpy()

    _hit_stretches(rows, masks, spark.sparkContext.broadcast(bits)).write.mode("overwrite").parquet(f"{folder}/stretches")
    stretches = spark.read.schema("doc_id long, stretch int, first int, words array<int>, hits array<struct<at:int,hash:long>>").parquet(f"{folder}/stretches")
    hits = stretches.select("doc_id", "stretch", F.explode("hits").alias("h")).select("doc_id", "stretch", "h.at", "h.hash")
    lain = hits.join(tests, "hash").select("doc_id", "stretch", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    joined = lain.join(stretches.select("doc_id", "stretch", "first", "words"), ["doc_id", "stretch"]).join(_item_words(items), "item_id")
    kinds = "doc_id long, item_id long, overlap_start int, n_agree int, n_window int"

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            words, item = (batch.column(c) for c in ("words", "item_words"))
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "item_id", "first", "shift")]
            for i, (doc_id, item_id, first, shift) in enumerate(zip(*columns)):
                best = _best_window(words[i].values.to_numpy(), first, item[i].values.to_numpy(), shift)
                if best and best[0] * WINDOW >= best[1] * AGREE:
                    out.append((doc_id, item_id, best[2], best[0], best[1]))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 5, types)]
            yield pa.RecordBatch.from_arrays(arrays, [k.split()[0] for k in kinds.split(", ")])

    found = joined.select("doc_id", "item_id", "first", "shift", "words", "item_words").mapInArrow(verify, kinds)
    rank = F.struct("n_agree", (-F.col("overlap_start")).alias("start"), "n_window")
    return found.groupBy("doc_id", "item_id").agg(F.max(rank).alias("r")).select(
        "doc_id", "item_id", (-F.col("r.start")).alias("overlap_start"), F.col("r.n_agree").alias("n_agree"), F.col("r.n_window").alias("n_window")
    )
