"""Suffix-array dedup: finds every byte covered by a string of LENGTH bytes that also starts earlier.

1. Each window of LENGTH bytes is owned by its anchor, the smallest hash among its GRAM-byte substrings. Equal windows have equal anchors,
   and windows in a row mostly share theirs, so a text becomes blocks: runs of window starts with one anchor. A block is a row with the
   anchor and a hash of its bytes; the text itself isn't moved. Windows that repeat an earlier one of their block (runs of one character,
   say) are found at once, byte by byte, and the block goes on as the runs between them.
2. Rows are range-partitioned and sorted by anchor, hash, document and place, and streamed: all but the first block with the same bytes are
   repeats as a whole. First blocks that share their anchor with other bytes are undecided.
   Like common anchors the range bounds may cut: the first and last anchor of a task are settled over tasks.
3. Only undecided blocks fetch their bytes. Blocks of one anchor meet in one task and their windows are sorted as suffixes (see
   ``suffix_sort``), in classes by anchor and its offset in the window. Blocks of an anchor with very many undecided windows are first cut into
   parts by that offset, or beyond that into windows which meet by their own hash, so such an anchor is spread too.

Restricting 3 to first blocks loses nothing: a window in a later block of the same bytes occurs at the same place of the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import suffix_sort
from barspan.llm import texts as tx
from barspan.session import scratch_dir

LENGTH = 100
GRAM = 40
#: An anchor with more undecided windows is spread by offsets, PART_OFFSETS together; with more than the second number, by windows.
CROWDED = 500_000, 4_000_000
PART_OFFSETS = 8
#: Bytes of blocks sorted together.
SORT_BYTES = 1 << 20
#: Bytes of texts cut together: few enough for the processor's cache.
CUT_BYTES = 1 << 18
#: Rows judged together.
JUDGED_ROWS = 1 << 16

#: A place is a text's version (19 bits) and a byte position in it.
_PLACE_BITS = 43
_NO_ID = -(1 << 63)

_BLOCKS = "anchor long, bytes_hash long, doc long, place long, n int"
_REPEAT, _UNDECIDED, _OPEN, _SEEN = range(4)
#: Added to the number of starts of a block that is known to repeat.
_KNOWN = 1 << 30


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    version = F.pmod(F.xxhash64(text), F.lit(1 << (62 - _PLACE_BITS)))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), version.alias("version"), text.alias("text"))


def _running(values: np.ndarray, width: int, reduce) -> np.ndarray:
    """reduce over values[i:i + width] for every i that leaves room."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = reduce(values[:-step], values[step:])
        reach += step
    return values


def _blocks_of(texts: tx.Texts, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of all texts' blocks: anchor, hash of the bytes, text, first start, number of starts (negative if it may repeat within itself)."""
    n, grams = len(texts.data), length - gram + 1
    none = np.zeros(0, np.uint64)
    if n < length:
        return none, none, *[np.zeros(0, np.int64)] * 3
    prefix = tx.prefix_hashes(texts.data)
    hashes = tx.every_span_hash(prefix, gram)
    lowest = _running(hashes, grams, np.minimum)
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))[: n - length + 1]
    valid = np.arange(n - length + 1) + length <= texts.offsets[owner + 1]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none, none, *[np.zeros(0, np.int64)] * 3
    value, text = lowest[starts], owner[starts]
    new = np.append(True, (value[1:] != value[:-1]) | (text[1:] != text[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    first = starts[first]
    # Substrings that are the anchor of some window: two alike in a row mean a block that may repeat within itself.
    padded = np.zeros(len(lowest) + 2 * (grams - 1), np.uint64)
    padded[grams - 1 : grams - 1 + len(lowest)] = np.where(valid, lowest, np.uint64(0))
    anchors = np.flatnonzero(_running(padded, grams, np.maximum)[: len(hashes)] == hashes)
    twice = np.append(0, np.cumsum(hashes[anchors[1:]] == hashes[anchors[:-1]]))
    low, high = np.searchsorted(anchors, first), np.searchsorted(anchors, first + count - 1 + grams)
    within = twice[np.maximum(high - 1, 0)] > twice[np.minimum(low, len(twice) - 1)]
    content = tx.content_hashes(texts.data, prefix, first, first + count - 1 + length)
    return lowest[first], content, owner[first], first - texts.offsets[owner[first]], np.where(within, -count, count)


def _own_repeats(texts: tx.Texts, blocks: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
    """The blocks of ``_blocks_of``, those marked cut into runs of windows that repeat an earlier one of their block (_KNOWN added) and runs that don't.

    Only where hashes collide does a run stay marked.
    """
    anchor, content, text, first, count = blocks
    marked = np.flatnonzero(count < 0)
    if not len(marked):
        return blocks
    n = -count[marked]
    sizes = n - 1 + length
    base = np.cumsum(sizes) - sizes
    data = texts.data[np.repeat(texts.offsets[text[marked]] + first[marked] - base, sizes) + np.arange(sizes.sum())]
    prefix = tx.prefix_hashes(data)
    block = np.repeat(np.arange(len(marked)), n)
    inner = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
    at = base[block] + inner
    hashes = tx.span_hashes(prefix, at, at + length)
    order = np.lexsort((hashes, block))
    alike = np.flatnonzero((hashes[order[1:]] == hashes[order[:-1]]) & (block[order[1:]] == block[order[:-1]]))
    later, earlier = order[alike + 1], order[alike]
    true = suffix_sort.same_bytes(data, at[later], at[earlier], length)
    again = np.zeros(len(at), bool)
    again[later[true]] = True
    unsure = np.zeros(len(marked), bool)
    unsure[block[later[~true]]] = True
    cut = np.flatnonzero(np.append(True, (again[1:] != again[:-1]) | (block[1:] != block[:-1])))
    size, known, of = np.diff(np.append(cut, len(at))), again[cut], block[cut]
    hashed = tx.content_hashes(data, prefix, at[cut], at[cut] + size - 1 + length)
    size = np.where(known, size + _KNOWN, np.where(unsure[of], -size, size))
    # What is known needs no anchor: any number that spreads it will do.
    cuts = np.where(known, hashed, anchor[marked][of]), hashed, text[marked][of], first[marked][of] + inner[cut], size
    rest = count > 0
    return tuple(np.concatenate([whole[rest], some]) for whole, some in zip(blocks, cuts))


def _block_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", CUT_BYTES):
            texts = tx.Texts(part.column("text"))
            anchor, content, text, first, count = _own_repeats(texts, _blocks_of(texts, length, gram), length)
            doc, version = part.column("doc").to_numpy(), part.column("version").to_numpy()
            place = (version[text] << _PLACE_BITS) | first
            columns = [anchor.view(np.int64), content.view(np.int64), doc[text], place, count.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _BLOCKS.split(", ")])

    return rows.mapInArrow(cut, _BLOCKS)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of JUDGED_ROWS or somewhat more, and a last one of fewer."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= JUDGED_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts on rows sorted by anchor, hash, document and place."""
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    opening = None  # the first anchor of the task
    anchor = content = at = None  # of the last row
    first_row, several = None, False  # of the last anchor: its first block, and whether other bytes followed
    last_row = None  # the first block with the last row's bytes

    def out(batch: pa.RecordBatch, verdict: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, verdict, np.int8))], [*names, "verdict"])

    for batch in _gathered(batches):
        known = batch.column("n").to_numpy() >= _KNOWN
        if known.any():
            yield out(batch.filter(pa.array(known)), _REPEAT)
            batch = batch.filter(pa.array(~known))
        if not batch.num_rows:
            continue
        a, c, n, doc, place = (batch.column(x).to_numpy() for x in ("anchor", "bytes_hash", "n", "doc", "place"))
        opening = int(a[0]) if opening is None else opening
        same_anchor = np.append(anchor is not None and int(a[0]) == anchor, a[1:] == a[:-1])
        same = same_anchor & np.append(content is not None and int(c[0]) == content, c[1:] == c[:-1])
        # A row given twice is one block, no repeat of itself.
        twice = np.append(at == (doc[0], place[0]), (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]))
        yield out(batch.filter(pa.array(same & ~twice)), _REPEAT)
        firsts = np.flatnonzero(~same)
        if len(firsts):
            fa = a[firsts]
            change = np.append(True, fa[1:] != fa[:-1])
            group = np.cumsum(change) - 1
            sizes = np.bincount(group)
            goes_on = bool(same_anchor[firsts[0]])
            if goes_on:
                # These blocks follow others of the same anchor.
                if not several and int(fa[0]) != opening:
                    yield out(first_row, _UNDECIDED)
                sizes[0] += 1
            undecided = (sizes > 1)[group] & (fa != opening) | (n[firsts] < 0) & (fa != opening)
            closing = group == group[-1]
            lonely = undecided & closing & (sizes[group] == 1)  # repeats within itself; written when its anchor ends
            yield out(batch.take(pa.array(firsts[undecided & ~lonely])), _UNDECIDED)
            yield out(batch.take(pa.array(firsts[fa == opening])), _OPEN)
            if first_row is not None and not goes_on and not several and anchor != opening and first_row.column("n")[0].as_py() < 0:
                yield out(first_row, _UNDECIDED)
            several = bool(sizes[-1] > 1)
            begins = int(firsts[np.flatnonzero(closing)[0]])
            if not (goes_on and group[-1] == 0):
                first_row = batch.slice(begins, 1)
            last_row = batch.slice(int(firsts[-1]), 1)
        anchor, content, at = int(a[-1]), int(c[-1]), (doc[-1], place[-1])
    if anchor is not None and anchor != opening:
        # The last anchor may go on in the next task, there with the last bytes or with others.
        if several:
            yield out(first_row, _SEEN)
            yield out(last_row, _SEEN)
        else:
            yield out(first_row, _OPEN)


def _offsets(prefix: np.ndarray, at: np.ndarray, anchors: np.ndarray, gram: int) -> np.ndarray:
    """How far behind each window start its anchor lies; ``anchors`` tells the anchor at each byte."""
    hashes = tx.every_span_hash(prefix, gram).view(np.int64)
    places = np.flatnonzero(hashes == anchors[: len(hashes)])
    return places[np.searchsorted(places, at)] - at


def _parts(piece: bytes, n: int, anchor: int, length: int, gram: int, level: int) -> list[tuple[int, int, int]]:
    """(first start, number of starts, key) of a crowded anchor's block, cut so that equal windows still share a key."""
    prefix = tx.prefix_hashes(np.frombuffer(piece, np.uint8))
    starts = np.arange(n)
    if level > 1:
        keys = tx.every_span_hash(prefix, length)
        cuts = starts
    else:
        part = _offsets(prefix, starts, np.full(len(piece), anchor, np.int64), gram) // PART_OFFSETS
        keys = tx.mix(np.full(n, anchor, np.int64).view(np.uint64) + (part + 1).astype(np.uint64) * np.uint64(tx.BASE))
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return list(zip(cuts.tolist(), np.diff(np.append(cuts, n)).tolist(), keys[cuts].view(np.int64).tolist()))


def _undecided_bytes(rows: DataFrame, undecided: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, anchor, doc, place, n, bytes) of undecided blocks; those of crowded anchors come in parts."""
    level = F.when(F.col("windows") > CROWDED[1], 2).otherwise(1)
    windows = undecided.groupBy("anchor").agg(F.sum(F.abs("n").cast("long")).alias("windows"))
    crowded = windows.where(F.col("windows") > CROWDED[0]).select("anchor", level.alias("crowded"))
    marked = undecided.join(crowded, "anchor", "left")
    version = F.shiftright("place", _PLACE_BITS)
    block = F.struct("anchor", "place", F.abs("n").alias("n"), F.coalesce("crowded", F.lit(0)).alias("crowded"))
    # A document's undecided blocks are no more than its text has.
    wanted = marked.groupBy("doc", version.cast("long").alias("version")).agg(F.collect_list(block).alias("blocks"))
    texts = tx.among(rows, wanted, "doc").dropDuplicates(["doc", "version"])
    kinds = "key long, anchor long, doc long, place long, n int, bytes binary"

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            out = []
            for doc, text, blocks in zip(*(part.column(c).to_pylist() for c in ("doc", "text", "blocks"))):
                data = text.encode()
                for b in blocks:
                    at = b["place"] & ((1 << _PLACE_BITS) - 1)
                    piece = data[at : at + b["n"] - 1 + length]
                    if not b["crowded"]:
                        out.append((b["anchor"], b["anchor"], doc, b["place"], b["n"], piece))
                        continue
                    for i, n, key in _parts(piece, b["n"], b["anchor"], length, gram, b["crowded"]):
                        out.append((key, b["anchor"], doc, b["place"] + i, n, piece[i : i + n - 1 + length]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*out)) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [k.split()[0] for k in kinds.split(", ")])

    return wanted.join(texts, ["doc", "version"]).select("doc", "text", "blocks").mapInArrow(fetch, kinds)


def _sorted_repeats(blocks: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, place, n): runs of window starts that repeat an earlier window of the same key."""

    def decide(rows: list[tuple]) -> Iterator[tuple]:
        sizes = np.array([len(r[5]) for r in rows])
        data = np.frombuffer(b"".join([r[5] for r in rows]), np.uint8)
        base = np.cumsum(sizes) - sizes
        counts = np.array([r[4] for r in rows])
        block = np.repeat(np.arange(len(rows)), counts)
        inner = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = base[block] + inner
        # Equal windows have their anchor at the same offset.
        anchors = np.repeat(np.array([r[1] for r in rows], np.int64), sizes)
        offset = _offsets(tx.prefix_hashes(data), at, anchors, gram)
        keys = np.array([r[0] for r in rows], np.int64)
        group = np.cumsum(np.append(0, keys[1:] != keys[:-1]))[block]
        by_class = group * (length + 1) + offset
        order = np.argsort(by_class, kind="stable")
        by_class = by_class[order]
        dense = np.cumsum(np.append(0, by_class[1:] != by_class[:-1]))
        found = np.zeros(len(at), bool)
        found[order] = suffix_sort.repeats(data, at[order], dense, length)
        edges = np.flatnonzero(np.append(True, (found[1:] != found[:-1]) | (block[1:] != block[:-1])))
        for low, high in zip(edges, np.append(edges[1:], len(found))):
            if found[low]:
                r = rows[block[low]]
                yield r[2], r[3] + int(inner[low]), int(high - low)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()))], ["doc", "place", "n"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, found = [], 0, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and r[0] != rows[-1][0] and size >= SORT_BYTES:
                    yield batch_of(list(decide(rows)))
                    rows, size = [], 0
                # Of single windows with the same bytes only the first is held.
                if r[4] == 1 and rows and rows[-1][0] == r[0] and rows[-1][5] == r[5]:
                    found.append((r[2], r[3], 1))
                else:
                    rows.append(r)
                    size += len(r[5])
            yield batch_of(found)
            found = []
        if rows:
            yield batch_of(list(decide(rows)))

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(parts, "key").sortWithinPartitions("key", "doc", "place")
    return dealt.mapInArrow(sort, "doc long, place long, n int")


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, starts): for each text with repeats, runs (at, n) of starts of ``length``-byte strings that also start earlier.

    Texts are UTF-8 bytes, null as empty; earlier means a smaller id, or the same document and an earlier byte. A null id is the smallest. Rows
    that agree in id and text count as one document; rows with one id and different texts are versions, ordered by a hash.
    Texts shorter than ``length`` have no starts. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    folder = scratch_dir(spark, "repeats")
    rows = _rows(docs, id_col, text_col)
    order = ["anchor", "bytes_hash", "doc", "place"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = _block_rows(rows, length, gram).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    judged = sorted_.mapInArrow(_judge, f"{_BLOCKS}, verdict byte")
    judged.write.mode("overwrite").parquet(f"{folder}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{folder}/judged")

    # At most two anchors a task are open.
    edge = judged.where(F.col("verdict").isin(_OPEN, _SEEN))
    mixed = edge.groupBy("anchor").agg((F.min("bytes_hash") != F.max("bytes_hash")).alias("mixed"))
    firsts = edge.groupBy("anchor", "bytes_hash").agg(F.min(F.struct("doc", "place")).alias("f"))
    settled = edge.where(F.col("verdict") == _OPEN).join(F.broadcast(mixed), "anchor").join(firsts, ["anchor", "bytes_hash"])
    is_first = (F.col("doc") == F.col("f.doc")) & (F.col("place") == F.col("f.place"))
    again = settled.where(~is_first).select("doc", "place", F.abs("n").alias("n"))
    unsure = settled.where(is_first & (F.col("mixed") | (F.col("n") < 0))).select("anchor", "doc", "place", "n")
    undecided = judged.where(F.col("verdict") == _UNDECIDED).select("anchor", "doc", "place", "n").unionByName(unsure).distinct()
    blocks = _undecided_bytes(rows, undecided, length, gram)
    starts = F.abs("n").bitwiseAND(F.lit(_KNOWN - 1))
    found = judged.where(F.col("verdict") == _REPEAT).select("doc", "place", starts.alias("n")).unionByName(again)
    found = found.unionByName(_sorted_repeats(blocks, length, gram))
    at = F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # A text's runs: no more than it has bytes.
    return found.groupBy("doc", F.shiftright("place", _PLACE_BITS).alias("version")).agg(F.collect_list(F.struct(at.alias("at"), "n")).alias("starts"))


def without_repeats(data: bytes, starts: list[dict] | None, length: int = LENGTH) -> tuple[bytes, int]:
    """The bytes that no repeated string covers, and the number of maximal runs removed."""
    if not starts:
        return data, 0
    cover = np.zeros(len(data) + 1, np.int32)
    at, n = np.array([s["at"] for s in starts]), np.array([s["n"] for s in starts])
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n - 1 + length, -1)
    gone = np.cumsum(cover)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), spans


def with_starts(docs: DataFrame, starts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, starts) of every row, ``starts`` null where nothing repeats."""
    rows = _rows(docs, id_col, text_col)
    return rows.join(starts, ["doc", "version"], "left").select(F.nullif("doc", F.lit(_NO_ID)).alias("doc_id"), "text", "starts")
