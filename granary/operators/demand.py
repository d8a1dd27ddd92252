"""Demand and the buy list."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.parsing import run_of

_EXACT = "decimal(18,6)"


def _per_day(plates: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Quantity per item over the number of distinct plate dates.

    Plates without items count as days, so days come from plates alone."""
    days = plates.agg(F.countDistinct("date").alias("_days"))
    ate = items.join(plates.select(F.col("id").alias("plate_id")), "plate_id", "left_semi")
    total = ate.groupBy("ing_id").agg(F.sum(F.col("qty").cast(_EXACT)).cast("double").alias("_q"))
    return total.crossJoin(F.broadcast(days)).select("ing_id", F.try_divide("_q", "_days").alias(name))


def trailing(plates: DataFrame, as_of: date | None, days: int) -> DataFrame:
    """Plates of the last ``days`` dates up to ``as_of``; none without a date.

    Both bounds are literals, so the scan prunes row groups and partitions."""
    if as_of is None:
        return plates.where("false")
    return plates.where(F.col("date").between(F.lit(as_of - timedelta(days=days - 1)), F.lit(as_of)))


def latest(plates: DataFrame) -> date | None:
    """The last date of the plates: the as-of date where none is given."""
    return plates.agg(F.max("date").alias("d")).head().d


def observed_rate(plates: DataFrame, items: DataFrame, as_of: date | None, days: int = 14) -> DataFrame:
    return _per_day(trailing(plates.where("not planned"), as_of, days), items, "rate")


def header_counts(stock: DataFrame, pins: DataFrame, plates: DataFrame, as_of: date | None, days: int = 14) -> DataFrame:
    """One row: items in stock, pinned dishes, and dates logged of the last ``days``."""
    logged = trailing(plates.where("not planned"), as_of, days).agg(F.countDistinct("date").alias("logged_days"))
    stocked = stock.agg(F.count_if(F.coalesce("qty", F.lit(0.0)) > 0).alias("stocked"))
    return stocked.crossJoin(pins.agg(F.countDistinct("recipe_id").alias("pinned"))).crossJoin(logged)


def menu_rate(plates: DataFrame, items: DataFrame, from_date: Column | None = None) -> DataFrame:
    """All planned plates; past ones too unless ``from_date`` is given."""
    planned = plates.where("planned")
    return _per_day(planned if from_date is None else planned.where(F.col("date") >= from_date), items, "menu")


def pinned_demand(pins: DataFrame, recipes: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Default serving times perweek / 7 over each pinned recipe's distinct
    ingredients; dangling ids are skipped."""
    used = pins.join(recipes.select(F.col("id").alias("recipe_id"), "core", "opt"), "recipe_id")
    used = used.select("perweek", F.explode(F.array_union("core", "opt")).alias("ing_id"))
    used = used.join(ingredients.select(F.col("id").alias("ing_id"), "default"), "ing_id")
    return used.groupBy("ing_id").agg((F.sum((F.col("default") * F.col("perweek")).cast(_EXACT)).cast("double") / 7).alias("pin"))


def driver(rate: Column, pin: Column, any_menu: Column) -> Column:
    return F.when(any_menu, "menu").when(pin > rate, "pinned").otherwise("eaten")


def buy_list(ingredients: DataFrame, stock: DataFrame, rate: DataFrame, pin: DataFrame, menu: DataFrame, horizon: int) -> DataFrame:
    """What to buy: need above 0.05, capped by shelf life, in whole packs.

    Any planned slot turns every item to menu demand, items off the menu to
    none.  Need and packs are rounded before comparing and ``ceil`` to keep
    float noise from buying a pack."""
    any_menu = menu.limit(1).agg(F.count(F.lit(1)).alias("_menus"))
    shelf = F.when(F.coalesce(F.col("shelf"), F.lit(0)) == 0, 30).otherwise(F.col("shelf"))
    pack = F.when(F.coalesce(F.col("pack"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("pack").cast("double"))
    out = ingredients.select("id", "name", shelf.alias("shelf"), pack.alias("pack"), "sort")
    for side, column in ((stock, "qty"), (rate, "rate"), (pin, "pin"), (menu, "menu")):
        out = out.join(side.select(F.col("ing_id").alias("id"), column), "id", "left").withColumn(column, F.coalesce(column, F.lit(0.0)))
    out = out.crossJoin(F.broadcast(any_menu))
    out = out.withColumn("driver", driver(F.col("rate"), F.col("pin"), F.col("_menus") > 0))
    daily = F.when(F.col("driver") == "menu", F.col("menu")).when(F.col("driver") == "pinned", F.col("pin")).otherwise(F.col("rate"))
    days = F.least(F.lit(horizon), F.col("shelf"))
    out = out.withColumn("daily", daily).withColumn("cap_days", days).withColumn("need", F.round(daily * days - F.col("qty"), 6))
    packs = F.when(F.col("need") > 0, F.ceil(F.round(F.col("need") / F.col("pack"), 9))).otherwise(0).cast("long")
    out = out.withColumn("packs", packs).withColumn("capped", days < horizon).withColumn("run", run_of(F.col("shelf")))
    return out.where("need > 0.05").select("id", "name", "run", "driver", "daily", "cap_days", "need", "packs", "capped", "sort")


def shopping_progress(rows: DataFrame, ticked: DataFrame) -> DataFrame:
    """Items left per run."""
    left = rows.join(ticked.select(F.col("ing_id").alias("id"), F.lit(True).alias("_t")), "id", "left")
    return left.groupBy("run").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("_t").isNull()).alias("left"))
