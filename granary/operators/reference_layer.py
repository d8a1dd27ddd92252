"""Values derived from a composition table (per 100 g, grams; energy in kJ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nutrient -> (component, multiplier to the nutrient's unit).
COMPONENTS = {
    "protein": ("protcnt", 1.0),
    "carbs": ("choavldf", 1.0),
    "fibre": ("fibtg", 1.0),
    "iron": ("fe", 1e3),
    "calcium": ("ca", 1e3),
    "vitc": ("vitc", 1e3),
    "folate": ("folsum", 1e6),
    "omega3": ("f18d3n3", 1.0),
    "omega3_dha": ("f22d6n3", 1.0),
    "zinc": ("zn", 1e3),
    "magnesium": ("mg", 1e3),
    "potassium": ("k", 1e3),
}


#: What energy and vitamin A are made of.
_MADE_OF = ("enerc", "fatce", "retol", "cartbeq")


def _z(c: str) -> Column:
    return F.coalesce(F.col(f"_comp.{c}"), F.lit(0.0))


def derived() -> dict[str, Column]:
    """Nutrients of one serving of ``grams``, by expression over ``_comp``."""
    s = F.col("grams") / 100
    out = {n: _z(c) * mul * s for n, (c, mul) in COMPONENTS.items()}
    from_energy = _z("enerc") / 4.184 * s
    out["kcal"] = F.when((_z("enerc") == 0) & (_z("fatce") != 0), 9 * _z("fatce") * s).otherwise(from_energy)
    out["vita"] = (_z("retol") * 1e6 + _z("cartbeq") * 1e6 / 12) * s
    return out


def derive(ingredients: DataFrame, composition: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each ingredient with ``source`` (UNSOURCED, MISSING CODE, MATCHED) and
    ``new_<nutrient>`` columns, by one join instead of a lookup per row."""
    has = (F.coalesce(F.col("ifct_code"), F.lit("")) != "") & (F.coalesce(F.col("grams"), F.lit(0.0)) > 0)
    # One struct, so no name of the composition table meets one of the ingredients'.
    used = [c for c in (*(c for c, _ in COMPONENTS.values()), *_MADE_OF) if c in composition.columns]
    comp = composition.select(F.col("code").alias("_code"), F.struct(*used).alias("_comp"))
    j = ingredients.join(comp, has & (F.col("ifct_code") == F.col("_code")), "left")
    source = F.when(~has, "UNSOURCED").when(F.col("_code").isNull(), "MISSING CODE").otherwise("MATCHED")
    new = {k: v for k, v in derived().items() if columns is None or k in columns}
    j = j.withColumn("source", source)
    return j.select(*ingredients.columns, "source", *(F.when(F.col("source") == "MATCHED", v).alias(f"new_{k}") for k, v in new.items()))


def drift(derived_: DataFrame, key: str = "id") -> DataFrame:
    """(key, column, old, new) where they differ by more than the larger of
    0.05 and 2 % of the old value."""
    cols = [c.removeprefix("new_") for c in derived_.columns if c.startswith("new_")]
    rows = derived_.where("source = 'MATCHED'").select(key, F.expr("stack({}, {}) as (column, old, new)".format(len(cols), ", ".join(f"'{c}', cast({c} as double), new_{c}" for c in cols))))
    return rows.where(F.abs(F.col("old") - F.col("new")) > F.greatest(F.lit(0.05), 0.02 * F.abs("old")))


def drift_report(derived_: DataFrame, key: str = "id") -> DataFrame:
    return drift(derived_, key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("column", "old", "new"))).alias("drift"))


def write_back(ingredients: DataFrame, derived_: DataFrame) -> DataFrame:
    """Snapshot with the matched rows' nutrients replaced."""
    cols = {c.removeprefix("new_") for c in derived_.columns if c.startswith("new_")}
    return derived_.select(*(F.when(F.col("source") == "MATCHED", F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in ingredients.columns))


def source_counts(derived_: DataFrame) -> DataFrame:
    return derived_.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def search(composition: DataFrame, q: str, columns: list[str], order: str, limit: int = 25) -> DataFrame:
    """Case-insensitive substring over several columns; % and _ in the text stay
    wildcards."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).ilike(f"%{q}%"), F.lit(False))
    return composition.where(hit).orderBy(order).limit(limit)
