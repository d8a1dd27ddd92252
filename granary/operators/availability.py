"""Relational division of recipes by stock, near misses and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.parsing import name_contains
from granary.functions.ranges import range_of


def core_status(recipes: DataFrame, ingredients: DataFrame, stock: DataFrame, carry: list[str] = ()) -> DataFrame:
    """id, core_size, n_missing, missing: how each recipe's core stands.

    A core item is there if stock holds one serving; an unknown id is missing;
    repeats in core count each; a recipe with no core is left out."""
    core = recipes.select("id", *carry, F.posexplode("core").alias("pos", "ing_id"))
    return core_rows_status(core, ingredients, stock, carry)


def core_rows_status(core: DataFrame, ingredients: DataFrame, stock: DataFrame, carry: list[str] = ()) -> DataFrame:
    """:func:`core_status` of core items that are rows (id, pos, ing_id) already,
    so they are not grouped into lists first."""
    have = ingredients.select(F.col("id").alias("ing_id"), "default").join(stock.select("ing_id", "qty"), "ing_id", "left")
    have = have.select("ing_id", (F.coalesce("qty", F.lit(0.0)) >= F.col("default")).alias("ok"))
    seen = core.join(have, "ing_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    keys = ["id", *carry]
    miss = F.sort_array(F.collect_list(F.when(~F.col("ok"), F.struct("pos", "ing_id"))))
    out = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("core_size"), F.count_if(~F.col("ok")).alias("n_missing"), miss.alias("_m"))
    return out.withColumn("missing", F.transform("_m", lambda x: x["ing_id"])).drop("_m")


def makeable(status: DataFrame) -> DataFrame:
    return status.where("n_missing = 0")


def near_misses(status: DataFrame, most: int = 2) -> DataFrame:
    """One or two missing, and at least one there."""
    return status.where((F.col("n_missing").between(1, most)) & (F.col("core_size") > F.col("n_missing")))


def ranked_near_misses(near: DataFrame, k: int = 6, *ties: str) -> DataFrame:
    return near.orderBy("n_missing", F.desc("core_size"), *(ties or ("id",))).limit(k)


def unlocks(near: DataFrame, k: int = 3, ties: tuple[str, ...] = ("id",)) -> DataFrame:
    """ing_id, recipe_id, rank: the first k near misses a purchase helps."""
    rows = near.select("n_missing", "core_size", *ties, F.explode(F.array_distinct("missing")).alias("ing_id"))
    w = Window.partitionBy("ing_id").orderBy("n_missing", F.desc("core_size"), *ties)
    return rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k).select("ing_id", F.col(ties[-1]).alias("recipe_id"), "rank")


def kitchen_rank(stock: DataFrame, by: Column, order: Column, shards: int = 64) -> DataFrame:
    """Dense position by quantity (greatest first, nulls last), then file order,
    without one task sorting all.

    Rows are cut into ranges by literal bounds; a row's position is its place in
    its range plus the sizes of the ranges before it (one small row each).
    ``order`` must tell rows of one quantity apart."""
    keyed = stock.withColumn("_by", by.cast("double")).withColumn("_o", order)
    parts = keyed.withColumn("_p", range_of(keyed, [F.col("_by").isNull(), -F.col("_by"), F.col("_o")], shards))
    sizes = parts.groupBy("_p").count()
    before = F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    w = Window.partitionBy("_p").orderBy(F.desc_nulls_last("_by"), F.asc("_o"))
    out = parts.withColumn("_n", F.row_number().over(w)).join(F.broadcast(sizes), "_p")
    return out.withColumn("rank", (F.col("_n") + F.col("_before")).cast("long")).drop("_p", "_n", "_before", "_by", "_o")


def kitchen_rows(ranked: DataFrame, q: str = "", expanded: bool = False, limit: int = 12) -> DataFrame:
    """Ranked kitchen rows, those whose name has ``q``; the first ``limit`` unless
    searching or expanded."""
    rows = ranked.where(name_contains(F.col("name"), q)) if q.strip() else ranked
    rows = rows.orderBy("rank")
    return rows if q.strip() or expanded else rows.limit(limit)


def unpinned(recipes: DataFrame, pins: DataFrame) -> DataFrame:
    return recipes.join(pins.select(F.col("recipe_id").alias("id")), "id", "left_anti")


def pinned(recipes: DataFrame, pins: DataFrame) -> DataFrame:
    return recipes.join(pins.select(F.col("recipe_id").alias("id"), "perweek"), "id")
