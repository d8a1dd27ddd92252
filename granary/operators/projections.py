"""What clients read: tables with the falsy defaults and order of the server layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.parsing import falsy, pairs, tokens
from granary.sources.schema import FLAGS, NUTRIENTS


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c)


def _text(c: str) -> Column:
    return falsy(F.col(c).cast("string"), "", zero=False).alias(c)


def _list(c: str, kind: str) -> Column:
    """A token text, or a list as it is; empty for null."""
    return (F.coalesce(F.col(c), F.array().cast(kind)) if kind.startswith("array") else tokens(F.col(c))).alias(c)


def ingredients(df: DataFrame, client: bool = False) -> DataFrame:
    """Ingredients by sort and id.  Falsy shelf is 30, pack 1, lead and grams 0;
    ``client`` also takes a falsy default serving as 1, as the browser does."""
    kinds = dict(df.dtypes)
    serving = F.col("default_qty")
    return df.orderBy("sort", "id").select(
        "id", "name", "unit", (falsy(serving, 1.0) if client else serving).alias("default"), "role", _text("note"), falsy(F.col("shelf"), 30).alias("shelf"), falsy(F.col("pack"), 1.0).alias("pack"), _text("packname"),
        falsy(F.col("lead"), 0.0).alias("lead"), _text("prep"), _list("makes", kinds["makes"]), _flag("keep"), _text("needform"), _list("gated", kinds["gated"]), _text("ifct_code"), falsy(F.col("grams"), 0.0).alias("grams"), _text("grams_src"),
        *map(_flag, FLAGS), *NUTRIENTS,
    )


def targets(df: DataFrame) -> DataFrame:
    """Targets by sort and fname, ``nkey`` as ``key``."""
    return df.orderBy("sort", "fname").select("fname", F.col("nkey").alias("key"), "name", "unit", "cadence", "daily", "meal", _flag("permeal"))


def recipes(df: DataFrame) -> DataFrame:
    """Recipes, seed rows first, by id.  Unknown cuisine is empty, unknown effort 0."""
    kinds = dict(df.dtypes)
    amounts = F.col("amounts") if kinds["amounts"].startswith("map") else pairs(F.col("amounts"))
    none = F.create_map().cast("map<string,double>")
    return df.orderBy("is_user", "id").select(
        "id", "name", *(_list(c, kinds[c]) for c in ("meals", "core", "opt")), _text("method"), _text("cuisine"), falsy(F.col("effort"), 0).alias("effort"), F.coalesce(amounts, none).alias("amounts"), _text("src"), F.coalesce(F.col("is_user").cast("boolean"), F.lit(False)).alias("user")
    )


def dataset(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The bundle that every client read starts with."""
    return {"ingredients": ingredients(tables["ingredients"]), "targets": targets(tables["targets"]), "recipes": recipes(tables["recipes"])}


def stock(df: DataFrame) -> DataFrame:
    """ing_id, qty, bought, useup; ``bought`` is the purchase, else the last change, else empty."""
    said = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    return df.select("ing_id", "qty", F.coalesce(said("bought_at"), said("updated_at"), F.lit("")).alias("bought"), _flag("useup"))


def pins(df: DataFrame) -> DataFrame:
    return df.select("recipe_id", "perweek")
