"""Mixing sources to target weights: a token budget flows down a tree, and each leaf gives whole documents up to its share.

The tree's levels are columns (say domain, language, source). A node's budget goes to its children by weight; a child that
has fewer tokens (times ``max_epochs``) than its share is filled, and what it can't take goes to its siblings by weight. Only
what all siblings together can't take counts as their parent's shortage, which its own siblings made up for in the
step above, because each node's capacity is known before its parent's budget is dealt out.

Within a level the filling is closed: sorted by capacity per weight, the children that overflow are a prefix, found by running sums.
Trees are small next to documents; the documents are counted once and filtered once.

A leaf takes its documents in seeded random order, once per epoch; the last epoch is cut to the prefix that fits. The cut is found
by counting tokens per slot of the order key, then ordering only the slot where it falls; no leaf is ever sorted whole.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspan.session import scratch_dir

#: Hex digits of the order key that make a slot: 4096 slots a leaf.
SLOT_DIGITS = 3


def word_count(text_col: str = "text") -> Column:
    """Words as the tokens of a text, null counting 0."""
    return F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def path_of(values: list[Column]) -> Column:
    """Values joined by '/', nulls as empty ones; a '/' or '\\' inside a value gets a '\\' before it, so different values have different paths."""
    return F.concat_ws("/", *[F.regexp_replace(F.coalesce(v.cast("string"), F.lit("")), r"([/\\])", r"\\$1") for v in values])


def _dealt(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Nodes (capacity, weight, given: the parent's budget) with their own ``budget``, in whole tokens."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    nodes = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")))
    order = by.orderBy(F.col("ratio").asc_nulls_last(), "node")
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum(F.greatest("weight", F.lit(0.0))).over(order.rowsBetween(0, Window.unboundedFollowing))
    out = nodes.withColumns({"taken": before, "weights": after})
    # A child is filled if it has no more than its part of what those before it, relatively smaller, left.
    part = (F.col("given") - F.col("taken")) * F.col("weight")
    out = out.withColumn("filled", F.col("ratio").isNotNull() & (F.col("capacity") * F.col("weights") <= part))
    # What the filled ones leave is dealt to all others by weight.
    first = F.min(F.when(~F.col("filled") & F.col("ratio").isNotNull(), F.struct("ratio", "node", "taken", "weights"))).over(by)
    out = out.withColumn("open", first)
    rest = F.floor((F.col("given") - F.col("open.taken")) * F.col("weight") / F.col("open.weights"))
    budget = F.when(F.col("ratio").isNull(), 0).when(F.col("filled"), F.col("capacity")).otherwise(rest).cast("long")
    return out.withColumn("budget", F.least(F.greatest(budget, F.lit(0)), "capacity")).drop("ratio", "taken", "weights", "filled", "open")


def leaf_budgets(sizes: DataFrame, levels: list[str], weights: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """Leaves (levels, tokens) with their ``budget``. ``weights`` has (level, path, weight); a node without a line weighs 1.

    A path is the values of the levels down to that node as ``path_of`` joins them. What a node can take is what its leaves can
    take: tokens below a node of weight 0 or less count nowhere above it, so their share goes to others.
    """
    path = lambda n: path_of([F.col(c) for c in levels[:n]])
    tree = sizes.withColumns({f"path_{n}": path(n) for n in range(1, len(levels) + 1)})
    tree = tree.groupBy(*[f"path_{n}" for n in range(1, len(levels) + 1)]).agg(F.sum("tokens").alias("tokens"))
    for n, level in enumerate(levels, 1):
        known = weights.where(F.col("level") == level).select(F.col("path").alias(f"path_{n}"), F.col("weight").alias(f"weight_{n}"))
        tree = tree.join(known, f"path_{n}", "left").withColumn(f"weight_{n}", F.coalesce(f"weight_{n}", F.lit(1.0)))
    given: DataFrame | None = None
    for n in range(1, len(levels) + 1):
        up = [f"path_{i}" for i in range(1, n)]
        below = [F.col(f"weight_{i}") > 0 for i in range(n + 1, len(levels) + 1)]
        usable = F.when(reduce(and_, below, F.lit(True)), F.col("tokens")).otherwise(0)
        nodes = tree.groupBy(*up, f"path_{n}", F.col(f"weight_{n}").alias("weight")).agg(
            (F.sum(usable) * max_epochs).alias("capacity"), F.sum("tokens").alias("tokens")
        )
        nodes = nodes.withColumn("node", F.col(f"path_{n}"))
        nodes = nodes.withColumn("given", F.lit(budget)) if given is None else nodes.join(given.select(*up, "given"), up)
        given = _dealt(nodes, up[-1:]).select(*up, f"path_{n}", "tokens", "capacity", "weight", F.col("budget").alias("given"))
    return given.withColumnRenamed("given", "budget").withColumnRenamed(f"path_{len(levels)}", "leaf").drop(*[f"path_{n}" for n in range(1, len(levels))])


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: DataFrame, share: float | None = None, budget: int | None = None,
    seed: int = 17, max_epochs: int = 1, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
) -> DataFrame:
    """The documents that the mixture takes, with all their columns, plus ``mix`` (leaf, epochs: how often it is taken).

    ``budget`` tokens (or ``share`` of all) are dealt out over the tree of ``levels``. Whole documents are taken as long as they fit. The
    order of an epoch depends on seed, epoch and id only, so rows with equal ids go together, and null ids share one place. A null
    level value counts as an empty one. Null and empty texts have no tokens: they go with their place in the order. A column named ``mix`` is
    replaced. An empty table gives no rows; a node of weight 0 or less gets nothing.
    """
    spark = docs.sparkSession
    names = list(levels)
    docs = docs.drop("mix")
    text_tokens = word_count(text_col) if tokens is None else tokens
    leaf = path_of(list(levels.values()))
    place = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # Texts are counted once; all planning reads these narrow rows.
    folder = scratch_dir(spark, "mix")
    light = docs.select(
        leaf.alias("leaf"), place.alias("id"), text_tokens.cast("long").alias("tokens"), *[c.cast("string").alias(f"at_{n}") for n, c in levels.items()]
    )
    light.write.mode("overwrite").parquet(folder)
    light = spark.read.schema(light.schema).parquet(folder)

    sizes = light.groupBy(*[F.col(f"at_{n}").alias(n) for n in names]).agg(F.sum("tokens").alias("tokens"))
    if budget is None:
        budget = int((sizes.agg(F.sum("tokens")).first()[0] or 0) * share)
    leaves = leaf_budgets(sizes, names, weights, budget, max_epochs)
    some = F.col("tokens") > 0
    leaves = leaves.select(
        "leaf",
        F.when(some, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int").alias("epochs"),
        F.when(some, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"),
    )

    def drawn(epoch: Column, of: Column) -> Column:
        """The place of an id in an epoch: 64 bits of md5 as hex; its first three digits are the slot."""
        return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), of)), 1, 16)

    keyed = light.join(leaves.where("rest > 0"), "leaf").select("leaf", "rest", "tokens", drawn(F.col("epochs"), F.col("id")).alias("key"))
    slot = F.substring("key", 1, SLOT_DIGITS)
    slots = keyed.groupBy("leaf", "rest", slot.alias("slot")).agg(F.sum("tokens").alias("tokens"))
    slots = slots.withColumn("upto", F.sum("tokens").over(Window.partitionBy("leaf").orderBy("slot"))).where("upto > rest")
    # Whole slots fit before the cut's slot; inside it keys are ordered.
    cut = slots.groupBy("leaf").agg(F.min(F.struct("slot", (F.col("upto") - F.col("tokens")).alias("before"))).alias("s"))
    inside = keyed.join(cut.select("leaf", "s.slot", "s.before"), "leaf").where(slot == F.col("slot"))
    keys = inside.groupBy("leaf", "slot", "before", "rest", "key").agg(F.sum("tokens").alias("tokens"))
    upto = F.col("before") + F.sum("tokens").over(Window.partitionBy("leaf", "slot").orderBy("key"))
    stops = keys.withColumn("upto", upto).where("upto > rest").groupBy("leaf").agg(F.min("key").alias("stop"))
    # ``mix`` is no column of the documents any more, so it can hold the plan.
    plan = leaves.join(stops, "leaf", "left").select(F.struct("leaf", "epochs", "stop").alias("mix"))

    met = docs.join(plan, leaf == F.col("mix.leaf"))
    again = F.col("mix.stop").isNotNull() & (drawn(F.col("mix.epochs"), place) < F.col("mix.stop"))
    met = met.withColumn("mix", F.struct("mix.leaf", (F.col("mix.epochs") + again.cast("int")).alias("epochs")))
    return met.where("mix.epochs > 0")
