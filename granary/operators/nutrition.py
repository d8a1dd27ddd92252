"""Nutrient roll-ups, gates, targets, absorption and energy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sources.schema import NUTRIENTS

#: Molar masses of phytic acid, iron and zinc.
PHYTATE, IRON, ZINC = 660.04, 55.85, 65.38
#: slots' energy and protein budgets.
SLOTS = {"breakfast": (475.0, 30.0), "lunch": (625.0, 32.0), "snack": (100.0, 8.0), "dinner": (575.0, 30.0)}
_SUM = "decimal(24,6)"


def gated(column: str, value: Column | None = None) -> Column:
    """0 where the ingredient needs a form and its gates name the nutrient, by
    long or short key."""
    key = NUTRIENTS.get(column, (column,))[0]
    named = F.array_contains("gated", column) | F.array_contains("gated", key)
    blocked = (F.coalesce(F.col("needform"), F.lit("")) != "") & F.coalesce(named, F.lit(False))
    return F.when(blocked, F.lit(0.0)).otherwise(F.coalesce(value if value is not None else F.col(column), F.lit(0.0)))


def totals(items: DataFrame, ingredients: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Sum of delivered nutrient times quantity per group, one aggregate pass."""
    columns = columns or [c for c in NUTRIENTS if c in ingredients.columns]
    joined = items.join(ingredients.withColumnRenamed("id", "ing_id"), "ing_id")
    return joined.groupBy(*by).agg(*(F.sum((gated(c) * F.col("qty")).cast(_SUM)).cast("double").alias(c) for c in columns))


def unpivot(totals_: DataFrame, by: list[str]) -> DataFrame:
    columns = [c for c in totals_.columns if c in NUTRIENTS]
    pairs = ", ".join(f"'{NUTRIENTS[c][0]}', `{c}`" for c in columns)
    return totals_.select(*by, F.expr(f"stack({len(columns)}, {pairs}) as (nkey, total)"))


def target_status(long_totals: DataFrame, targets: DataFrame) -> DataFrame:
    """Share of target; LOW under 70 %, over above 200 %; a failure under 50 %
    of a per-meal target.  Targets of 0 or none are skipped."""
    t = targets.where("coalesce(daily, 0) <> 0").select("nkey", "daily", "permeal")
    out = long_totals.join(F.broadcast(t), "nkey").withColumn("pct", 100 * F.col("total") / F.col("daily"))
    status = F.when(F.col("pct") < 70, "LOW").when(F.col("pct") > 200, "over").otherwise("ok")
    return out.withColumn("status", status).withColumn("failed", (F.col("pct") < 50) & F.col("permeal"))


def slot_check(slots: DataFrame) -> DataFrame:
    """Energy above 115 % of the slot's budget fails; protein under 80 % warns."""
    budget = F.create_map(*(F.lit(x) for k, v in SLOTS.items() for x in (k, v[0])))
    protein = F.create_map(*(F.lit(x) for k, v in SLOTS.items() for x in (k, v[1])))
    out = slots.where(F.col("meal").isin(*SLOTS))
    out = out.withColumn("failed", F.col("kcal") > 1.15 * F.element_at(budget, F.col("meal")))
    return out.withColumn("warned", F.col("protein") < 0.8 * F.element_at(protein, F.col("meal")))


def grams(qty: Column, per: Column) -> Column:
    return qty * per


def molar_ratio(phytate: Column, mineral: Column, weight: float) -> Column:
    """Phytate to mineral by moles; null where there is no mineral."""
    return F.try_divide(phytate / PHYTATE, mineral / weight)


def zinc_class(ratio: Column) -> Column:
    return F.when(ratio > 15, "poor").when(ratio >= 5, "moderate").when(ratio < 5, "good")


def iron_class(ratio: Column) -> Column:
    """The band from 0.4 to 1 has no name."""
    return F.when(ratio > 1, "inhibited").when(ratio < 0.4, "good")


def after_form(phytate: Column, reduction: Column) -> Column:
    """Phytate left by a form; a blank reduction is not measured, so null."""
    return phytate * (1 - reduction / 100)


def delivered(raw: Column, retention: Column, absorption: Column) -> Column:
    """Blank retention or absorption is no factor."""
    return raw * F.coalesce(retention, F.lit(100.0)) / 100 * F.coalesce(absorption, F.lit(1.0))


def atwater_fat(kcal: Column, protein: Column, carbs: Column) -> Column:
    return (kcal - 4 * protein - 4 * carbs) / 9


#: Shares of the day that the four slots carry.
SHARES = {"breakfast": 0.3, "lunch": 0.3, "dinner": 0.3, "snack": 0.1}


def meal_targets(targets: DataFrame, share: float = 0.3) -> DataFrame:
    return targets.withColumn("meal", F.round(F.col("daily") * share, 6))


def slot_targets(targets: DataFrame) -> DataFrame:
    """A row per target and slot: the slot's share of the day."""
    shares = F.explode(F.create_map(*(F.lit(x) for kv in SHARES.items() for x in kv)))
    return targets.select("*", shares.alias("slot", "share")).withColumn("slot_target", F.round(F.col("daily") * F.col("share"), 6))


def day_report(items: DataFrame, ingredients: DataFrame, targets: DataFrame, energy: float = 1775.0) -> DataFrame:
    """(scope, name, got, wanted, pct, status) of a day: energy and protein of
    every slot against its budget, then every nutrient against its target.

    ``items``: meal, ing_id, qty.  Energy of the day is ``OVER`` above 105 % of
    ``energy``; a slot fails above 115 % of its energy and warns under 80 % of its
    protein; a per-meal target fails under 50 %."""
    slots = slot_check(totals(items, ingredients, ["meal"], ["kcal", "protein"]))
    budget = F.create_map(*(F.lit(x) for k, v in SLOTS.items() for x in (k, F.array(F.lit(v[0]), F.lit(v[1])))))
    want = F.element_at(budget, F.col("meal"))
    per_slot = slots.select(F.col("meal").alias("scope"), F.explode(F.array(F.struct(F.lit("kcal").alias("name"), F.col("kcal").alias("got"), want[0].alias("wanted"), F.when(F.col("failed"), "failed").otherwise("ok").alias("status")), F.struct(F.lit("protein").alias("name"), F.col("protein").alias("got"), want[1].alias("wanted"), F.when(F.col("warned"), "warned").otherwise("ok").alias("status")))).alias("r"))
    per_slot = per_slot.select("scope", "r.name", "r.got", "r.wanted", F.try_divide(100 * F.col("r.got"), F.col("r.wanted")).alias("pct"), "r.status")
    day = totals(items.withColumn("day", F.lit("day")), ingredients, ["day"])
    found = target_status(unpivot(day, ["day"]), targets)
    status = F.when(F.col("failed"), "failed").when((F.col("nkey") == "kcal") & (F.col("total") > 1.05 * energy), "OVER").when(F.col("nkey") == "kcal", "ok").otherwise(F.col("status"))
    return per_slot.unionByName(found.select(F.col("day").alias("scope"), F.col("nkey").alias("name"), F.col("total").alias("got"), F.col("daily").alias("wanted"), "pct", status.alias("status")))


def energy(weight: Column, fat: Column, bmr: Column, pal: Column, target: Column) -> dict[str, Column]:
    tdee = bmr * pal
    return {"ffm": weight - fat, "tdee": tdee, "deficit": tdee - target}


def rolling(daily: DataFrame, date: str, value: str, days: int = 7, by: list[str] = ()) -> DataFrame:
    """Sum over the last ``days`` dates, dates without rows counted as 0.

    Missing dates need no rows: the frame is a range of days."""
    w = Window.partitionBy(*by).orderBy(F.unix_date(F.to_date(date))).rangeBetween(-(days - 1), 0)
    return daily.withColumn(f"{value}_{days}d", F.sum(F.col(value).cast(_SUM)).over(w).cast("double"))


def effort_tiers(dishes: DataFrame) -> DataFrame:
    tier = F.when(F.col("effort") <= 6, "assembly").when(F.col("effort").between(8, 15), "one-pan").when(F.col("effort") >= 20, "multi-step")
    return dishes.withColumn("tier", tier).where("tier is not null").groupBy("tier").agg(
        F.count(F.lit(1)).alias("dishes"), F.avg("protein").alias("protein"), F.avg("fat").alias("fat"), F.try_divide(100 * F.sum("protein"), F.sum("kcal")).alias("protein_per_100kcal")
    )


def quartiles(rows: DataFrame, key: str, value: Column, least: int = 3) -> DataFrame:
    """Exact p25, median and p75 with n, where at least ``least`` rows exist."""
    p = rows.withColumn("_v", value).groupBy(key).agg(F.count("_v").alias("n"), F.percentile("_v", [0.25, 0.5, 0.75]).alias("p"))
    return p.where(F.col("n") >= least).select(key, "n", F.col("p")[0].alias("p25"), F.col("p")[1].alias("median"), F.col("p")[2].alias("p75"))


def serving_basis(rows: DataFrame, key: str, value: Column, is_core: Column, least: int = 3) -> DataFrame:
    """Median over core dishes where there are enough, else over all."""
    d = rows.select(key, value.alias("_v"), is_core.alias("_c")).groupBy(key).agg(
        F.count_if("_c").alias("n_core"), F.count(F.lit(1)).alias("n_all"), F.percentile(F.when(F.col("_c"), F.col("_v")), 0.5).alias("m_core"), F.percentile("_v", 0.5).alias("m_all")
    )
    core = F.col("n_core") >= least
    return d.select(key, F.when(core, "core").otherwise("all").alias("basis"), F.when(core, F.col("n_core")).otherwise(F.col("n_all")).alias("n"), F.when(core, F.col("m_core")).otherwise(F.col("m_all")).alias("serving"))
