"""Data-quality rules: rows (level, file, key, rule, detail), one frame per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.parsing import NUMBER, num, stripped, tokens
from granary.operators.nutrition import IRON, ZINC, molar_ratio
from granary.sources.schema import FLAGS, NUTRIENTS

KEYS = {k for c, v in NUTRIENTS.items() for k in (c, v[0])}


def violation(df: DataFrame, condition: Column, level: str, file: str, rule: str, key: str = "id", detail: Column | None = None) -> DataFrame:
    """The rows of ``df`` where the condition holds, as violations."""
    return df.where(F.coalesce(condition, F.lit(False))).select(F.lit(level).alias("level"), F.lit(file).alias("file"), F.col(key).cast("string").alias("key"), F.lit(rule).alias("rule"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def wrong_width(ragged: DataFrame, file: str, rule: str) -> DataFrame:
    return violation(ragged.withColumn("id", F.col("cells")[0]), F.col("wrong_width"), "E", file, rule, detail=F.col("width"))


#: The rule that reports rows of a wrong width in each file.
WIDTH_RULES = {"ingredients": "DQ1", "forms": "DQ14", "phytate": "DQ25", "retention": "DQ30", "recipes": "DQ32"}


def width_rules(files: dict[str, DataFrame]) -> list[DataFrame]:
    """Rows of a wrong width, by file of :func:`granary.sources.files.ragged`
    rows.  Those of the target file are skipped without a word (DQ20), see
    :func:`right_width`."""
    return [wrong_width(files[f], f, rule) for f, rule in WIDTH_RULES.items() if f in files]


def right_width(ragged: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the header's width as named text columns; all other rules look
    at these alone."""
    return ragged.where(~F.col("wrong_width")).select(*(F.col("cells")[i].alias(c) for i, c in enumerate(columns)))


def duplicates(df: DataFrame, file: str, rule: str, key: str = "id") -> DataFrame:
    return violation(df.groupBy(key).count(), F.col("count") > 1, "E", file, rule, key, F.col("count"))


def dangling(df: DataFrame, ref: Column, known: DataFrame, file: str, rule: str, key: str = "id", level: str = "E") -> DataFrame:
    """References that are not ids of ``known``, by anti-join."""
    rows = df.select(F.col(key).alias("_k"), ref.alias("_r")).where(F.col("_r").isNotNull() & (F.col("_r") != ""))
    rows = rows.join(known.select(F.col("id").alias("_r")).distinct(), "_r", "left_anti")
    return violation(rows, F.lit(True), level, file, rule, "_k", F.col("_r"))


def _cells(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    return df.select(key, F.expr("stack({}, {}) as (column, cell)".format(len(columns), ", ".join(f"'{c}', `{c}`" for c in columns))))


def _no_number() -> Column:
    """A cell that is neither blank nor a number."""
    return (F.coalesce(stripped(F.col("cell")), F.lit("")) != "") & ~F.col("cell").rlike(NUMBER)


def unparsed(df: DataFrame, columns: list[str], file: str, rule: str, key: str = "id") -> DataFrame:
    """Text cells that are no number."""
    return violation(_cells(df, columns, key), _no_number(), "E", file, rule, key, F.col("column"))


def numbers(df: DataFrame, columns: list[str], file: str, negative: str, no_number: str, key: str = "id", most: float | None = None) -> DataFrame:
    """Text cells that are no number, or out of [0, most]; blank is neither."""
    value = num(F.col("cell"), 0.0)
    out_of = ~_no_number() & ((value < 0) | (value > most) if most is not None else value < 0)
    return violation(_cells(df, columns, key), out_of, "E", file, negative, key, F.col("column")).unionByName(unparsed(df, columns, file, no_number, key))


def unreachable(ingredients: DataFrame, gated: str = "gated") -> DataFrame:
    """(id, nutrient) gated with no other ingredient that supplies it ungated.

    Gates are taken to long names first.  Suppliers are counted once per
    nutrient, so no ingredient is compared with every other."""
    long_name = F.create_map(*(F.lit(x) for c, v in NUTRIENTS.items() for k in {c, v[0]} for x in (k, c)))
    cols = [c for c in NUTRIENTS if c in ingredients.columns]
    base = ingredients.withColumn("_g", F.transform(F.col(gated), lambda k: F.element_at(long_name, k)))
    long_ = base.select("id", "_g", F.expr("stack({}, {}) as (nutrient, amount)".format(len(cols), ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols))))
    supplies = long_.where((F.col("amount") > 0) & ~F.coalesce(F.array_contains("_g", F.col("nutrient")), F.lit(False)))
    count = supplies.groupBy("nutrient").agg(F.count(F.lit(1)).alias("suppliers"))
    asks = base.select("id", F.explode(F.array_distinct("_g")).alias("nutrient")).where("nutrient is not null")
    return asks.join(F.broadcast(count), "nutrient", "left").where(F.coalesce("suppliers", F.lit(0)) == 0).select("id", "nutrient")


def ingredient_rules(raw: DataFrame, numeric: list[str]) -> list[DataFrame]:
    """Rules on the text cells of the ingredient file (columns as strings)."""
    f = "ingredients"
    kcal, p, c = (num(F.col(x)) for x in ("kcal", "protein", "carbs"))
    macro = 4 * p + 4 * c
    # Without three numbers there is nothing to compare.
    parsed = F.col("kcal").rlike(NUMBER) & F.col("protein").rlike(NUMBER) & F.col("carbs").rlike(NUMBER)
    impossible = (kcal > 0) & (macro > 1.12 * kcal) & (macro - kcal > 3) & parsed
    flags = reduce(lambda a, b: a | b, (~F.coalesce(stripped(F.col(x)), F.lit("")).isin("0", "1", "") for x in FLAGS))
    ids = raw.select("id")
    makes = raw.select("id", F.explode(tokens(F.col("makes"))).alias("_r"))
    blank = lambda x: F.coalesce(stripped(F.col(x)), F.lit("")) == ""
    fat = F.greatest(F.lit(0.0), kcal - macro)
    return [
        duplicates(raw, f, "DQ2"),
        numbers(raw, numeric, f, "DQ3", "DQ4"),
        violation(raw, flags, "E", f, "DQ5"),
        violation(raw, blank("unit"), "E", f, "DQ6"),
        violation(raw, blank("role"), "W", f, "DQ7"),
        violation(raw, impossible, "E", f, "DQ8", detail=macro),
        violation(raw, ~impossible & parsed & (kcal > 60) & (macro < 0.25 * kcal) & ~F.coalesce(F.col("role"), F.lit("")).isin("seed", "condiment"), "W", f, "DQ9", detail=fat),
        dangling(makes, F.col("_r"), ids, f, "DQ10"),
        violation(raw, (stripped(F.col("keep")) == "1") & blank("makes"), "W", f, "DQ11"),
    ]


def target_rules(targets: DataFrame) -> list[DataFrame]:
    names = [v[1] for v in NUTRIENTS.values()]
    return [violation(targets, ~F.col("fname").isin(names), "W", "targets", "DQ12", "fname"), violation(targets, ~F.coalesce(F.col("cadence").isin("meal", "day", "week"), F.lit(False)), "E", "targets", "DQ13", "fname")]


def form_rules(ingredients: DataFrame, forms: DataFrame) -> list[DataFrame]:
    """``gated`` and ``gates`` are arrays; the rest are the cells."""
    i, form = "ingredients", F.coalesce(F.col("needform"), F.lit(""))
    n = F.size("gated")
    gates = ingredients.select("id", F.explode("gated").alias("_g"))
    far = unreachable(ingredients)
    measured = F.coalesce(stripped(F.col("phyt_red").cast("string")), F.lit("")) != ""
    return [
        dangling(ingredients, form, forms, i, "DQ15"),
        violation(ingredients, (n > 0) & (form == ""), "E", i, "DQ16"),
        violation(ingredients, (n <= 0) & (form != ""), "W", i, "DQ17"),
        violation(gates, ~F.col("_g").isin(list(KEYS)), "E", i, "DQ18", detail=F.col("_g")),
        violation(far, F.lit(True), "E", i, "DQ19", detail=F.col("nutrient")),
        violation(forms, ~F.coalesce(F.col("mechanism").isin("phytate", "heat", "matrix", "fat"), F.lit(False)), "E", "forms", "DQ21"),
        violation(forms, measured & (F.col("mechanism") != "phytate"), "E", "forms", "DQ22"),
        numbers(forms.withColumn("phyt_red", F.col("phyt_red").cast("string")), ["phyt_red"], "forms", "DQ23", "DQ23", most=100),
        violation(forms.select("id", F.explode("gates").alias("_g")), ~F.col("_g").isin(list(KEYS)), "E", "forms", "DQ24", detail=F.col("_g")),
    ]


def phytate_rules(phytate: DataFrame, ingredients: DataFrame) -> list[DataFrame]:
    f, out = "phytate", []
    cells = ["phytate", "iron", "zinc", "phy_fe", "phy_zn"]
    out.append(dangling(phytate, F.col("id"), ingredients, f, "DQ26"))
    out.append(unparsed(phytate.select("id", *(F.col(c).cast("string").alias(c) for c in cells)), cells, f, "DQ27"))
    phytate = phytate.select("id", *(F.when(F.col(c).cast("string").rlike(NUMBER), num(F.col(c).cast("string"))).alias(c) for c in cells))
    for given, mineral, weight in (("phy_fe", "iron", IRON), ("phy_zn", "zinc", ZINC)):
        ratio = molar_ratio(F.col("phytate"), F.col(mineral), weight)
        out.append(violation(phytate, F.abs(ratio - F.col(given)) > 0.05, "E", f, "DQ28", detail=F.lit(given)))
    own = ingredients.select("id", F.col("iron").alias("_iron"), F.col("zinc").alias("_zinc"))
    j = phytate.join(own, "id")
    for m in ("iron", "zinc"):
        known = (F.col(m) > 0) & (F.col(f"_{m}") > 0)
        out.append(violation(j, known & (F.abs(F.col(m) - F.col(f"_{m}")) > 0.35 * F.greatest(m, f"_{m}")), "W", f, "DQ29", detail=F.lit(m)))
    return out


def retention_rules(retention: DataFrame, columns: list[str]) -> list[DataFrame]:
    return [numbers(retention, columns, "retention", "DQ31", "DQ31", "class", most=100)]


def recipe_rules(recipes: DataFrame, ingredients: DataFrame) -> list[DataFrame]:
    """``meals``, ``core`` and ``opt`` are arrays, ``effort`` a text cell."""
    f = "recipes"
    refs = recipes.select("id", F.explode(F.concat("core", "opt")).alias("_r"))
    meals = recipes.select("id", F.explode("meals").alias("_m"))
    effort = F.coalesce(stripped(F.col("effort")), F.lit(""))
    whole = effort.rlike(r"^[+-]?\d+$")
    minutes = F.when(whole, effort.try_cast("int"))
    both = F.array_intersect("core", "opt")
    return [
        duplicates(recipes, f, "DQ33"),
        dangling(refs, F.col("_r"), ingredients, f, "DQ34"),
        violation(recipes, F.size("core") <= 0, "E", f, "DQ35"),
        violation(meals, ~F.col("_m").isin("breakfast", "lunch", "dinner", "snack"), "E", f, "DQ36", detail=F.col("_m")),
        violation(recipes, ~minutes.between(0, 120), "W", f, "DQ37", detail=effort),
        violation(recipes, (effort != "") & ~whole, "E", f, "DQ37", detail=effort),
        violation(recipes, F.size(both) > 0, "W", f, "DQ38", detail=F.array_join(both, " ")),
    ]


def store_rules(file_rows: DataFrame, store_rows: DataFrame, numeric: list[str], exact: list[str], name: str, tolerance: float = 0.001, level: str = "E") -> DataFrame:
    """A file against a store: row counts, ids that either side lacks, differing
    columns.  Null and blank numbers count as 0, null texts as empty."""
    n = file_rows.agg(F.count(F.lit(1)).alias("_a")).crossJoin(store_rows.agg(F.count(F.lit(1)).alias("_b"))).withColumn("id", F.lit(name))
    a = file_rows.select(F.col("id").alias("a_id"), *(F.col(c).alias(f"a_{c}") for c in numeric + exact))
    b = store_rows.select(F.col("id").alias("b_id"), *(F.col(c).alias(f"b_{c}") for c in numeric + exact))
    j = a.join(b, F.col("a_id") == F.col("b_id"), "full_outer").withColumn("id", F.coalesce("a_id", "b_id"))
    here = F.col("a_id").isNotNull() & F.col("b_id").isNotNull()
    off = lambda c: F.abs(F.coalesce(f"a_{c}", F.lit(0.0)) - F.coalesce(f"b_{c}", F.lit(0.0))) > tolerance
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    # All findings of a row in one pass over the join.
    found = [F.when(F.col("b_id").isNull(), "missing"), F.when(F.col("a_id").isNull(), "not in file"), *(F.when(here & off(c), c) for c in numeric), *(F.when(here & (blank(f"a_{c}") != blank(f"b_{c}")), c) for c in exact)]
    rows = j.select("id", F.explode(F.array_compact(F.array(*found))).alias("_what"))
    return union([violation(n, F.col("_a") != F.col("_b"), level, name, "DQ39", detail=F.concat_ws("/", "_a", "_b")), violation(rows, F.lit(True), "E", name, "DQ40", detail=F.col("_what"))])


def summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
