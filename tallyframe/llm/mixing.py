"""Mixing sources to target weights with budgets handed down a tree.

The levels, such as domain, language and source, make a tree whose leaves hold
documents. The token budget goes down from the root: every node's budget is split
among its children by their weights. A leaf cannot take more than its tokens times
the epochs allowed; what it leaves goes to its siblings in proportion to their
weights, and only what no sibling can take goes back up to their parent's siblings.
As a node's room is the sum of its leaves' rooms, filling each level up to the rooms
of its children, top down, does exactly that.

Each leaf's documents stand in a seeded order of their own in every epoch, and a
leaf takes the shortest prefix of its epochs that reaches its budget. A running sum
over a leaf would be one task, so the order is cut into slots by the leading digits
of the order's hash: sums of slots first, running sums inside a slot after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.rows import column_of, free_name, others, store

#: Hexadecimal digits of the order's hash that name a slot.
SLOT_DIGITS = 3


def word_tokens(text: Column) -> Column:
    """Words of a text as the measure of its length, at least one."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t-\\r]+")), F.lit(1)).cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], budget: int) -> DataFrame:
    """``budget`` tokens, no more than there is room for, shared among ``leaves(*levels, tokens, room, weight_1, ...)``.

    ``weight_i`` is the weight of a leaf's ancestor at level i among its siblings, a
    positive whole number. Gives the leaves with ``leaf_budget``. Every share is
    rounded down to whole tokens.
    """
    given = leaves.withColumn("leaf_budget", F.lit(float(budget)))
    depth = len(levels)
    for level in range(1, depth + 1):
        above, path, weight = [*levels[: level - 1]], [*levels[:level]], f"weight_{level}"
        nodes = given.groupBy(*path).agg(
            F.sum("room").cast("double").alias("room"), F.max(weight).cast("double").alias("weight"),
            F.max("leaf_budget").alias("parent"),
        )
        # Children in the order in which they fill up when the budget grows.
        filling = Window.partitionBy(*above).orderBy(F.col("room") / F.col("weight"), *path)
        before = F.coalesce(F.sum("room").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("before", before).withColumn("rest", rest)
        # What is left per unit of weight if all earlier children are full; the least
        # such level at which a child does not fill up holds for it and all later ones.
        nodes = nodes.withColumn("left", F.greatest(F.col("parent") - F.col("before"), F.lit(0.0)))
        nodes = nodes.withColumn("fills", F.col("left") * F.col("weight") >= F.col("room") * F.col("rest"))
        nodes = nodes.withColumn("struct", F.when(~F.col("fills"), F.struct("left", "rest")))
        open_ = F.first("struct", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, 0))
        nodes = nodes.withColumn("open", open_)
        share = F.floor(F.col("open.left") * F.col("weight") / F.col("open.rest")).cast("double")
        nodes = nodes.withColumn("own", F.when(F.col("open").isNull(), F.col("room")).otherwise(share))
        nodes = nodes.select(*(F.col(p).alias(f"_{p}") for p in path), "own")
        same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in path]
        given = given.join(nodes, same).withColumn("leaf_budget", F.col("own")).drop("own", *(f"_{p}" for p in path))
    return given.withColumn("leaf_budget", F.col("leaf_budget").cast("long"))


def mix(
    df: DataFrame, levels: dict[str, Column], weights: Sequence[Column], tokens: Column, id: str = "doc_id",
    budget: int | None = None, epochs: int = 2, seed: int = 0, named: bool = False,
) -> DataFrame:
    """The rows that make up the mixture, a row once for each epoch that takes it.

    ``levels`` names the tree's levels and says what node a row belongs to, the root's
    children first. ``weights`` gives, from the level columns, each node's whole and
    positive weight among its siblings, one per level. ``tokens`` is a row's length,
    a whole number; null or less than one counts as one. ``budget`` is in tokens, by
    default all tokens of the table. A leaf gives each row at most ``epochs`` times.

    Within a leaf and epoch rows are ordered by the MD5 of seed, epoch and id; rows of
    the same place in that order (repeated or null ids) are taken or left together.
    A row is taken if the rows before it fall short of the leaf's budget, so every
    leaf passes its budget by less than its last rows. Null level values are a node
    like any other. ``named`` adds ``epoch`` and ``leaf_budget``; else the columns
    stay as they are. An empty table gives no rows.
    """
    names = list(levels)
    inner = [f"_level_{i}" for i in range(len(names))]
    size = F.greatest(F.coalesce(tokens, F.lit(1)), F.lit(1)).cast("long")
    plain = df.select(column_of(df, id).alias("_id"), size.alias("_size"), *(c.alias(i) for c, i in zip(levels.values(), inner, strict=True)))
    plain = store(plain, "lengths")
    leaves = plain.groupBy(*inner).agg(F.sum("_size").alias("tokens"))
    as_level = leaves.select("*", *(F.col(i).alias(n) for i, n in zip(inner, names, strict=True)))
    leaves = as_level.select(
        *inner, "tokens", (F.col("tokens") * epochs).alias("room"),
        *(w.alias(f"weight_{i + 1}") for i, w in enumerate(weights)),
    )
    total = plain.agg(F.sum("_size")).first()[0] or 0
    whole = min(total if budget is None else budget, total * epochs)
    given = store(budgets(leaves, inner, whole).select(*inner, "leaf_budget"), "budgets")

    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("_epoch")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epoch").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"))
    placed = plain.select("*", epoch).withColumn("_order", order).withColumn("_slot", F.substring("_order", 1, SLOT_DIGITS))
    slots = placed.groupBy(*inner, "_epoch", "_slot").agg(F.sum("_size").alias("_sum"))
    earlier = Window.partitionBy(*inner).orderBy("_epoch", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    # Only slots that begin below the budget matter, and only the last of them in part.
    slots = slots.join(given.select(*(F.col(i).alias(f"{i}_b") for i in inner), "leaf_budget"),
                       [F.col(i).eqNullSafe(F.col(f"{i}_b")) for i in inner])
    slots = slots.where(F.col("_before") < F.col("leaf_budget")).select(
        *(F.col(i).alias(f"{i}_s") for i in inner), F.col("_epoch").alias("_epoch_s"), F.col("_slot").alias("_slot_s"), "_before", "leaf_budget")
    same = [F.col(i).eqNullSafe(F.col(f"{i}_s")) for i in inner]
    placed = placed.join(slots, [*same, F.col("_epoch") == F.col("_epoch_s"), F.col("_slot") == F.col("_slot_s")])
    within = Window.partitionBy(*inner, "_epoch", "_slot").orderBy("_order")
    upto = F.sum("_size").over(within)  # rows of one place in the order count together
    own = F.sum("_size").over(Window.partitionBy(*inner, "_epoch", "_slot", "_order"))
    placed = placed.withColumn("_upto", upto).withColumn("_own", own)
    taken = placed.where(F.col("_before") + F.col("_upto") - F.col("_own") < F.col("leaf_budget"))

    # Back to the rows: an id is taken in some epochs, whichever of its rows it is.
    picked = taken.select(F.col("_id").alias("_pick"), *(F.col(i).alias(f"{i}_p") for i in inner), "_epoch", "leaf_budget").distinct()
    picked = picked.groupBy("_pick", *(f"{i}_p" for i in inner)).agg(F.collect_set("_epoch").alias("_epochs"), F.first("leaf_budget").alias("_budget"))
    marked = df.select("*", *(c.alias(free_name(df, i)) for c, i in zip(levels.values(), inner, strict=True)))
    mine = [free_name(df, i) for i in inner]
    same = [column_of(marked, m).eqNullSafe(F.col(f"{i}_p")) for m, i in zip(mine, inner, strict=True)]
    met = marked.join(picked, [column_of(marked, id).eqNullSafe(F.col("_pick")), *same])
    if named:
        return met.select(*others(df, "epoch", "leaf_budget"), F.explode("_epochs").alias("epoch"), F.col("_budget").alias("leaf_budget"))
    once = free_name(df, "epoch_of_row")
    return met.select(*others(df), F.explode("_epochs").alias(once)).drop(once)
