"""Menu generator and prep queue, from the reference's prose (no code to match).

Rules that fix a choice are checks or ranks over DataFrames; the greedy repairs
of a day run as one bounded group per day.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE_RANK = {"sour": 1, "green": 2, "seed": 3}


def affinity(recipes: DataFrame, eaten: DataFrame) -> DataFrame:
    """Score of a dish: its distinct core ingredients that were eaten (SP1)."""
    core = recipes.select("id", F.explode(F.array_distinct("core")).alias("ing_id"))
    hit = core.join(eaten.select("ing_id").distinct().withColumn("_e", F.lit(1)), "ing_id", "left")
    return hit.groupBy("id").agg(F.count("_e").alias("score"))


def repeats(menu: DataFrame, days: int = 3) -> DataFrame:
    """Slots whose dish was also on one of the days before (SP2)."""
    w = Window.partitionBy("recipe_id").orderBy("date", "meal")
    return menu.withColumn("_last", F.lag("date").over(w)).where(F.datediff("date", "_last") < days).drop("_last")


def daily_contract(items: DataFrame) -> DataFrame:
    """Which parts of the daily contract a day breaks (SP3).

    ``items``: date, meal, ing_id, role, qty, green, probiotic, legume, iron."""
    is_id = lambda x: F.col("ing_id") == x
    day = items.groupBy("date").agg(
        F.sum(F.when(is_id("egg"), F.col("qty")).otherwise(0)).alias("eggs"),
        F.coalesce(F.bool_or("legume"), F.lit(False)).alias("legume"),
        F.coalesce(F.bool_or(F.col("green") & (F.col("meal") == "lunch")), F.lit(False)).alias("green_lunch"),
        F.coalesce(F.bool_or(F.col("green") & (F.col("meal") == "dinner")), F.lit(False)).alias("green_dinner"),
        F.coalesce(F.bool_or("probiotic"), F.lit(False)).alias("probiotic"),
        F.coalesce(F.bool_or(is_id("flax")), F.lit(False)).alias("flax"),
        F.countDistinct(F.when((F.col("role") == "seed") & ~is_id("flax"), F.col("ing_id"))).alias("other_seeds"),
    )
    broken = F.array_compact(F.array(F.when(F.col("eggs") < 3, "eggs"), F.when(~F.col("legume"), "legume"), F.when(~F.col("green_lunch") | ~F.col("green_dinner"), "green"), F.when(~F.col("probiotic"), "probiotic"), F.when(~F.col("flax") | (F.col("other_seeds") < 1), "seeds")))
    return day.select("date", broken.alias("broken"))


def sour_missing(items: DataFrame, iron: float = 5.0) -> DataFrame:
    """Iron-heavy plates without a sour."""
    p = items.groupBy("date", "meal").agg(F.sum(F.col("iron") * F.col("qty")).alias("iron"), F.coalesce(F.bool_or(F.col("role") == "sour"), F.lit(False)).alias("sour"))
    return p.where((F.col("iron") >= iron) & ~F.col("sour"))


def repair(gaps: DataFrame, toppers: pd.DataFrame, schema: str = "date date, ing_id string, nkey string") -> DataFrame:
    """Close each day's gaps with toppers, one serving of each a day (SP4).

    ``gaps``: date, nkey, gap, sort.  Gaps are walked in target order; the
    topper that gives most of the nutrient is taken."""

    def one(day: pd.DataFrame) -> pd.DataFrame:
        left = {r.nkey: r.gap for r in day.sort_values("sort").itertuples()}
        free, out = toppers.copy(), []
        for key in list(left):
            while left[key] > 1e-9 and key in free and len(free) and free[key].max() > 0:
                i = free.sort_values([key, "id"], ascending=[False, True]).index[0]
                out.append((day["date"].iat[0], free.at[i, "id"], key))
                for k in left:
                    left[k] -= float(free.at[i, k]) if k in free else 0.0
                free = free.drop(index=i)
        return pd.DataFrame(out, columns=["date", "ing_id", "nkey"])

    return gaps.groupBy("date").applyInPandas(one, schema)


def protein_pass(days: DataFrame, goal: float) -> DataFrame:
    """What to add for protein: a fourth egg, then whey (SP5)."""
    short = F.col("protein") < goal
    return days.withColumn("add", F.when(short & (F.col("eggs") < 4), "egg").when(short, "whey"))


def trim(items: DataFrame, ceiling: float) -> DataFrame:
    """Days above their ceiling, cut until they are not (SP6): the items that go,
    largest fat contributor first, with the energy left after each.

    ``items``: date, ing_id, kcal, fat, of whole contributions.  A day's items
    are ranked once; an item goes while those before it leave the day above the
    ceiling, so the loop is a running sum."""
    day = Window.partitionBy("date")
    order = day.orderBy(F.desc("fat"), "ing_id")
    left = F.sum("kcal").over(day) - F.sum("kcal").over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = items.withColumn("left", left).withColumn("before", F.col("left") + F.col("kcal"))
    rank = F.row_number().over(order)
    return out.withColumn("rank", rank).where(F.col("before") > ceiling).select("date", "rank", F.col("ing_id").alias("cut"), F.col("before").alias("kcal"), "left")


def optional_cap(options: DataFrame, most: int = 3) -> DataFrame:
    """At most three optional items per slot, sour, green, seed first (SP7)."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in ROLE_RANK.items() for x in kv)), F.col("role")), F.lit(9))
    w = Window.partitionBy("slot").orderBy(rank, "pos")
    return options.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def within_effort(dishes: DataFrame, cap: int) -> DataFrame:
    """Dishes within the effort cap, cheaper first; unknown effort counts 40 (SP8)."""
    shown = F.when(F.coalesce(F.col("effort"), F.lit(0)) == 0, 40).otherwise(F.col("effort"))
    return dishes.withColumn("shown_effort", shown).where(F.col("shown_effort") <= cap).orderBy("shown_effort", "id")


def filler_shave(items: DataFrame) -> DataFrame:
    """Half a serving less of each day's base item with least protein per kcal (SP9)."""
    w = Window.partitionBy("date").orderBy(F.try_divide("protein", "kcal"), "ing_id")
    return items.where(F.col("role") == "base").withColumn("_n", F.row_number().over(w)).where("_n = 1").select("date", "ing_id", (F.col("qty") - 0.5).alias("qty"))


def gaps(targets: DataFrame, totals: DataFrame) -> DataFrame:
    """Every target with what is missing, in target order; targets without any
    total stay, and only per-meal ones block (SP10, SP11)."""
    out = targets.where("coalesce(daily, 0) > 0").join(totals, "nkey", "left")
    gap = F.greatest(F.lit(0.0), F.col("daily") - F.coalesce("total", F.lit(0.0)))
    return out.withColumn("gap", gap).withColumn("blocks", F.col("permeal") & (gap > 0)).orderBy("sort")


def prep_queue(menu_items: DataFrame, ingredients: DataFrame, stock: DataFrame) -> DataFrame:
    """When to start what (SP12): items with lead hours, and kept items that ran out.

    ``menu_items``: slot_ts, ing_id."""
    ing = ingredients.select(F.col("id").alias("ing_id"), "lead", "keep")
    due = menu_items.join(ing.where("lead > 0"), "ing_id").select("ing_id", F.expr("slot_ts - make_interval(0, 0, 0, 0, cast(lead as int), cast((lead - cast(lead as int)) * 60 as int), 0)").alias("start_at"), F.lit("lead").alias("why"))
    out = ing.where("keep").join(stock.where("qty > 0").select("ing_id"), "ing_id", "left_anti")
    return due.unionByName(out.select("ing_id", F.lit(None).cast(due.schema["start_at"].dataType).alias("start_at"), F.lit("empty").alias("why")))


def prep_done(ingredient: DataFrame, now: Column) -> DataFrame:
    """Ledger events of a finished prep: its outputs come in now (SP13)."""
    return ingredient.select(F.explode("makes").alias("ing_id"), F.lit(1.0).alias("delta"), now.alias("ts"))


def form_variants(forms: DataFrame, ingredients: DataFrame) -> DataFrame:
    """A row for each form and ingredient it applies to (SP15)."""
    pairs = forms.select(F.col("id").alias("form_id"), F.explode("applies").alias("id"))
    return pairs.join(ingredients, "id").withColumn("variant_id", F.concat_ws("_", "id", "form_id"))
