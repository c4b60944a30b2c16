"""MinHash near-dedup: an inverted join over signature coordinates, exact confirmation, components.

1. Rows with the same shingle set form a class; its smallest id stands for it. Copies never meet pairwise.
2. Each class gets a signature of COORDINATES minimum hashes and is posted under its (coordinate, value) pairs. Linked classes agree in at
   least ``least_matches`` coordinates (all but one in 10^9), so they share one of the rarest COORDINATES - least_matches + 1 pairs of either:
   only that prefix is posted, and pairs that one class has alone are skipped.
3. Star rounds: each posting list links its members to its most central one (whose pairs are the most shared of all), in later rounds to the
   most central one left over. Pairs are kept if enough coordinates agree, confirmed on the full sets, and contracted to
   components. A group of near copies mostly falls into one component here, with links linear in its size.
4. Closing round: lists whose members are still in several components leave their classes open. Two open classes can be linked only if they
   share a shingle near the front of both sets, rarest first, with enough shingles behind it; so pairs whose common part is just what
   a whole group has in common are skipped without being formed. Enough coordinates must agree, and the full sets decide.

Pairs inside a component can't change it, so no component is lost by leaving them out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspan.llm import texts as tx
from barspan.llm.components import min_labels
from barspan.session import scratch_dir

COORDINATES = 64
STAR_ROUNDS = 2
#: Chance that a link has fewer agreeing coordinates than are asked for.
MISS = 1e-9
#: Slots of the table of shingle counts that orders shingles by rarity (4 MB).
COUNT_SLOTS = 1 << 20

_SIGNED = "doc_id long, hash long, n_shingles long, set_a long, set_b long, signature array<int>"


def least_matches(percent: int) -> int:
    """The most agreeing coordinates that a pair at the least similarity reaches with a chance of 1 - MISS."""
    p, below = percent / 100, 0.0
    for n in range(COORDINATES):
        below += comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if below > MISS:
            return n
    return COORDINATES


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Per row (doc_id, hash, text): doc_id, hash, n_shingles, a 128-bit fingerprint of the shingle set, and its MinHash signature (null if empty)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, factors = tx.seeds(COORDINATES, 1), tx.seeds(COORDINATES, 2) | np.uint64(1)
        for part in tx.slices(batches, "text"):
            found = tx.Shingles(tx.Texts(part.column("text")), k)
            signature = np.zeros((len(found.counts), COORDINATES), np.uint32)
            for i in range(COORDINATES):
                low = tx.per_text((found.hashes ^ seeds[i]) * factors[i], found.offsets, np.minimum, 0)
                # The high half orders as the whole does; its loss of bits only makes two minima look equal more often.
                signature[:, i] = low >> np.uint64(32)
            sums = [tx.per_text(tx.mix(found.hashes + s), found.offsets, np.add, 0) for s in tx.seeds(2, 3)]
            flat = pa.array(signature.reshape(-1).view(np.int32))
            ends = np.arange(len(signature) + 1, dtype=np.int32) * COORDINATES
            lists = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(found.counts == 0))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"), pa.array(found.counts), _i64(sums[0]), _i64(sums[1]), lists],
                ["doc_id", "hash", "n_shingles", "set_a", "set_b", "signature"],
            )

    return docs.select("doc_id", "hash", "text").mapInArrow(sign, _SIGNED)


def _shared(classes: DataFrame) -> DataFrame:
    """(doc_id, pairs, centre): each class's pairs that other classes have too, rarest first; ``centre`` is how shared they are."""
    pairs = classes.select("doc_id", F.posexplode("signature").alias("at", "value"))
    sizes = pairs.groupBy("at", "value").agg(F.count("*").alias("members")).where("members > 1")
    # At most COORDINATES entries a class.
    return pairs.join(sizes, ["at", "value"]).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("members", "at", "value"))).alias("pairs"), F.sum("members").alias("centre")
    )


def _postings(held: DataFrame, matches: int) -> DataFrame:
    """(doc_id, centre, at, value) for the prefix of each class: its COORDINATES - matches + 1 rarest pairs.

    Pairs that occur once are the rarest, so they use up the prefix first; they can't meet another class and are left out.
    """
    free = F.lit(COORDINATES - matches + 1) - (COORDINATES - F.size("pairs"))
    prefix = F.slice("pairs", F.lit(1), F.greatest(free, F.lit(0)))
    return held.select("doc_id", "centre", F.explode(prefix).alias("p")).select("doc_id", "centre", "p.at", "p.value")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose full shingle sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                left = tx.Shingles(tx.Texts(part.column("text_a")), k)
                right = tx.Shingles(tx.Texts(part.column("text_b")), k)
                keep = np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    x = left.hashes[left.offsets[i] : left.offsets[i + 1]]
                    y = right.hashes[right.offsets[i] : right.offsets[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
                keep = pa.array(keep)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in "ab"], ["a", "b"])

    side = lambda name: texts.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per id: n_shingles, class_id, component_id and n_links (confirmed links of its class to others, of those that were tried:
    pairs inside a component are not formed, so this is no count of all links, and it depends on which members became hubs).

    Two texts are linked if 100 * |A and B| >= percent * |A or B| over their sets of distinct k-word shingles; component_id is the
    smallest id reachable. Null, empty and wordless texts have no shingles and no link. Null ids are left out; of rows
    with one id, that with the smallest text hash counts. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tx.small_batches(spark)
    folder = scratch_dir(spark, "near")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    by_set = ["n_shingles", "set_a", "set_b"]
    signed = signatures(rows, k).groupBy("doc_id").agg(F.min(F.struct("hash", *by_set, "signature")).alias("s"))
    signed = stored(signed.select("doc_id", "s.*"), "signed")
    first = F.min(F.struct("doc_id", "hash", "signature")).alias("c")
    classes = stored(signed.where("n_shingles > 0").groupBy(*by_set).agg(first).select("c.*", *by_set), "classes")
    held = stored(_shared(classes), "held")
    matches = least_matches(percent)
    postings = stored(_postings(held, matches), "postings")
    # Only classes with enough shared coordinates can be in a pair; their texts are taken aside once.
    possible = held.where(F.size("pairs") >= matches).select("doc_id").join(classes.select("doc_id", "hash"), "doc_id")
    texts = tx.among(rows, possible, "doc_id").join(possible, ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])
    texts = stored(texts.select("doc_id", "text"), "texts")

    labels = classes.select("doc_id", F.col("doc_id").alias("label"))
    tried = links = None
    for i in range(STAR_ROUNDS + 1):
        placed = postings.join(labels, "doc_id")
        pairs = _stars(placed, i > 0) if i < STAR_ROUNDS else _closing(placed, texts, k, percent)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(_agreeing(pairs, classes, matches), f"pairs{i}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = stored(_confirmed(pairs, texts, k, percent), f"links{i}")
        links = found if links is None else links.unionByName(found)
        labels = stored(min_labels(classes.select("doc_id"), links, f"{folder}/steps{i}"), f"labels{i}")

    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    ids = classes.select(*by_set, F.col("doc_id").alias("class_id"))
    ids = ids.join(labels.toDF("class_id", "component_id"), "class_id").join(degree, "class_id", "left")
    out = signed.select("doc_id", *by_set).join(ids, by_set, "left")
    return out.select(
        "doc_id", "n_shingles",
        *[F.coalesce(c, "doc_id").alias(c) for c in ("class_id", "component_id")], F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _agreeing(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) that agree in enough coordinates."""
    side = lambda name: classes.select(F.col("doc_id").alias(name), F.col("signature").alias(f"s{name}"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(agree >= matches).select("a", "b")


def _main(members: DataFrame, *by: str) -> DataFrame:
    """(by, main): the largest component of each list that has members of several."""
    sizes = members.groupBy(*by, "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy(*by).agg(F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("labels"))
    return most.where("labels > 1").select(*by, F.col("m.label").alias("main"))


def _stars(placed: DataFrame, again: bool) -> DataFrame:
    """Pairs of each list's members with its most central member; ``again``, only among those outside the list's main component."""
    if again:
        placed = placed.join(_main(placed, "at", "value"), ["at", "value"]).where("label <> main")
    rank = F.struct("centre", (-F.col("doc_id")).alias("id"), "label")
    best = placed.groupBy("at", "value").agg(F.max(rank).alias("r"), F.min("label").alias("low"), F.max("label").alias("high"))
    best = best.where("low < high").select("at", "value", (-F.col("r.id")).alias("hub"), F.col("r.label").alias("hub_label"))
    met = placed.join(best, ["at", "value"]).where("label <> hub_label")
    return met.select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct()


def _closing(placed: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of open classes in different components that the order of their shingles leaves possible.

    Shingles are ordered by a table of counts (of hash slots, so of bounded size) and then by hash; any fixed order would be right.
    Sets of n and m shingles are linked only if they share o = ceil(percent * (n + m) / (100 + percent)) of them; so
    of their first common shingle, at places i and j, n - i >= o and m - j >= o.
    """
    spark = texts.sparkSession
    open_ = placed.join(_main(placed, "at", "value"), ["at", "value"]).groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = open_.join(texts, "doc_id").select("doc_id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNT_SLOTS, np.int64)
        for part in tx.slices(batches, "text"):
            shingles = tx.Shingles(tx.Texts(part.column("text")), k)
            np.add.at(sums, (shingles.hashes % np.uint64(COUNT_SLOTS)).astype(np.int64), 1)
        slot = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(sums[slot])], ["slot", "n"])

    got = rows.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most COUNT_SLOTS rows
    counts = np.zeros(COUNT_SLOTS, np.int64)
    counts[got["slot"].to_numpy()] = got["n"].to_numpy()
    counts = spark.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32))
    kinds = "shingle long, doc_id long, label long, n int, i int"

    def fronts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            shingles = tx.Shingles(tx.Texts(part.column("text")), k)
            rarity = counts.value[(shingles.hashes % np.uint64(COUNT_SLOTS)).astype(np.int64)]
            taken, places, owner = [], [], []
            for d, (low, high) in enumerate(zip(shingles.offsets[:-1], shingles.offsets[1:])):
                n = high - low
                front = n - (percent * n + 99) // 100 + 1
                order = np.lexsort((shingles.hashes[low:high], rarity[low:high]))[:front]
                taken.append(shingles.hashes[low:high][order])
                places.append(np.arange(len(order)))
                owner.append(np.full(len(order), d))
            owner = np.concatenate(owner)
            columns = [
                _i64(np.concatenate(taken)), part.column("doc_id").take(pa.array(owner)), part.column("label").take(pa.array(owner)),
                pa.array(shingles.counts[owner].astype(np.int32)), pa.array(np.concatenate(places).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in kinds.split(", ")])

    posted = rows.mapInArrow(fronts, kinds)
    met = posted.join(_main(posted, "shingle"), "shingle")
    side = lambda name: [F.col(c).alias(f"{c}_{name}") for c in ("doc_id", "label", "n", "i")]
    # One side leaves out the list's main component, so a list that is one but for a few members is short there.
    left = met.where("label <> main").select("shingle", "main", *side("x"))
    right = met.select("shingle", *side("y"))
    common = F.ceil(percent * (F.col("n_x") + F.col("n_y")) / F.lit(100 + percent))
    possible = (F.col("n_x") - F.col("i_x") >= common) & (F.col("n_y") - F.col("i_y") >= common)
    other = (F.col("label_x") != F.col("label_y")) & ((F.col("label_y") == F.col("main")) | (F.col("doc_id_x") < F.col("doc_id_y")))
    pairs = left.join(right, "shingle").where(possible & other)
    return pairs.select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct()
