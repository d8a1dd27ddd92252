"""Registered mutations of the state, bodies and write-backs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import merge, plates, reference_layer
from granary.plans.registry import query
from granary.sources import analog, files, schema


def _now():
    return F.lit("2001-01-01").cast("timestamp")



def _stock(spark, d, qty) -> DataFrame:
    k = F.col("ing_id")
    none = F.lit(None).cast("timestamp")
    return analog.stock(spark, d).select("ing_id", qty(k).cast("double").alias("qty"), none.alias("updated_at"), F.when(k % 3 == 0, F.lit("2000-01-01").cast("timestamp")).alias("bought_at"), F.lit(False).alias("useup"))


def _state(spark, d) -> dict[str, DataFrame]:
    return {"plates": analog.plates(spark, d), "plate_items": analog.items(spark, d).select("plate_id", "ing_id", "qty"), "stock": _stock(spark, d, lambda k: k % 5)}


@query("""
SELECT p_partkey AS ing_id, CASE WHEN p_partkey % 2 = 0 THEN greatest(0, p_partkey % 9 - 3) ELSE p_partkey % 5 END::DOUBLE AS qty,
  CASE WHEN p_partkey % 4 = 0 THEN DATE '2001-02-03' WHEN p_partkey % 3 = 0 THEN DATE '2000-01-01' END AS bought_on FROM part""")
def stock_set(spark, d):
    """Absolute, floored at 0; the purchase clock moves only if one is given."""
    k = F.col("ing_id")
    values = analog.stock(spark, d).where(k % 2 == 0).select("ing_id", (k % 9 - 3).cast("double").alias("qty"), F.when(k % 4 == 0, F.lit("2001-02-03").cast("timestamp")).alias("bought_at"))
    return merge.set_stock(_stock(spark, d, lambda k: k % 5), values, _now()).select("ing_id", "qty", F.to_date("bought_at").alias("bought_on"))


def _apart(id_, known: bool):
    """A key that tells known ids from made-up ones, which a large table may have too."""
    return F.struct(id_.alias("id"), F.lit(known).alias("known"))


@query("SELECT p_partkey AS ing_id, (p_partkey % 5)::DOUBLE AS qty, p_partkey % 2 = 0 AS useup FROM part UNION ALL SELECT p_partkey + 1000000, 0.0, TRUE FROM part WHERE p_partkey % 50 = 0")
def useup_set(spark, d):
    k = F.col("ing_id")
    s = analog.stock(spark, d)
    flags = s.where(k % 2 == 0).select(_apart(k, True).alias("ing_id")).unionByName(s.where(k % 50 == 0).select(_apart(k + 1000000, False).alias("ing_id"))).withColumn("useup", F.lit(True))
    state = _stock(spark, d, lambda k: k % 5).withColumn("ing_id", _apart(k, True))
    return merge.set_useup(state, flags).select("ing_id.id", "qty", "useup").withColumnRenamed("id", "ing_id")


_TIMED = "p_partkey % 2 = 0 AND p_partkey * 7 % 700 BETWEEN 1 AND 600"


@query(f"SELECT p_partkey AS id, CASE WHEN {_TIMED} THEN p_partkey * 7 % 700 ELSE p_size END::INTEGER AS effort, CASE WHEN {_TIMED} THEN 'user' ELSE '' END AS effort_src FROM part")
def effort_record(spark, d):
    """Only 1 to 600 minutes count, unknown dishes are nobody's."""
    k = F.col("id")
    base = analog.ingredients(spark, d).select("id", F.col("shelf").alias("effort"))
    efforts = base.where(k % 2 == 0).select(_apart(k, True).alias("id"), (k * 7 % 700).cast("int").alias("effort")).unionByName(base.where(k % 50 == 0).select(_apart(k + 1000000, False).alias("id"), F.lit(5).alias("effort")))
    state = base.select(_apart(k, True).alias("id"), "effort", F.lit("").alias("effort_src"))
    return merge.record_effort(state, efforts)[0].select("id.id", "effort", "effort_src")


@query("SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey <> 3")
def recipe_delete(spark, d):
    """Dish 3 is a user's and goes; dish 4 is a seed and stays."""
    state = analog.ingredients(spark, d).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2 == 1).alias("is_user"))
    return merge.delete_recipe(merge.delete_recipe(state, "3"), "4").select("id")


@query("""
SELECT l_orderkey::VARCHAR AS id, CASE WHEN l_orderkey % 97 = 0 THEN 'Recipe' ELSE 'Dish "' || l_orderkey || '", hot' END AS name, l_orderkey % 7 = 0 OR l_orderkey % 97 = 0 AS is_user,
  count(*) FILTER (l_linenumber <= 3) AS n_core, CASE WHEN l_orderkey % 97 = 0 THEN 7 WHEN l_orderkey % 4 <> 0 THEN l_orderkey % 60 ELSE 0 END::INTEGER AS effort FROM lineitem GROUP BY l_orderkey""")
def recipe_save(spark, d):
    """Dishes built by hand replace what has their id and are the user's."""
    table = analog.recipe_table(spark, d).drop("amounts", "src")
    built = table.where(F.col("id").cast("long") % 97 == 0).withColumn("name", F.lit("")).withColumn("effort", F.lit("7.5"))
    out = merge.save_recipe(table, merge.user_recipes(built, F.lit(1)))
    return out.select("id", "name", "is_user", F.size("core").cast("long").alias("n_core"), F.coalesce("effort", F.lit(0)).alias("effort"))


_CREDIT = "c AS (SELECT l_partkey AS id, sum(l_quantity) AS c FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 100 = 0 AND o_orderstatus <> 'P' GROUP BY 1)"


@query(f"""
WITH {_CREDIT}, m AS (SELECT o_orderkey % 50 AS id, 3.0 * count(*) AS m FROM orders WHERE o_orderkey % 100 = 0 GROUP BY 1)
SELECT p_partkey AS ing_id, greatest(0, p_partkey % 5 + coalesce(c, 0) - coalesce(m, 0))::DOUBLE AS qty FROM part LEFT JOIN c ON c.id = p_partkey LEFT JOIN m ON m.id = p_partkey""")
def plate_save(spark, d):
    """Saving over an eaten plate gives its items back before the new ones go."""
    k = F.col("id")
    new = analog.plates(spark, d).where(k % 100 == 0).withColumn("planned", F.lit(False))
    items = new.select(k.alias("plate_id"), (k % 50).alias("ing_id"), F.lit(3.0).alias("qty"))
    return plates.save_plate(_state(spark, d), new, items, _now())["stock"].select("ing_id", "qty")


@query(f"""
WITH {_CREDIT} SELECT p_partkey AS ing_id, (p_partkey % 5 + coalesce(c, 0))::DOUBLE AS qty, (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 100 <> 0) AS n_items FROM part LEFT JOIN c ON c.id = p_partkey""")
def plate_delete(spark, d):
    """Eaten plates give their items back; items go with their plate."""
    after = plates.delete_plates(_state(spark, d), analog.plates(spark, d).where(F.col("id") % 100 == 0), _now())
    n = after["plate_items"].agg(F.count(F.lit(1)).alias("n_items"))
    return after["stock"].select("ing_id", "qty").crossJoin(F.broadcast(n))


@query("""
WITH s AS (SELECT min(o_orderkey) AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'), m AS (SELECT l_partkey AS id, sum(l_quantity) AS m FROM lineitem JOIN s ON l_orderkey = k GROUP BY 1)
SELECT p_partkey AS ing_id, greatest(0, p_partkey % 5 - coalesce(m, 0))::DOUBLE AS qty, (SELECT count(*) - 1 FROM orders WHERE o_orderstatus = 'P') AS planned FROM part LEFT JOIN m ON m.id = p_partkey""")
def slot_cook(spark, d):
    """The first planned slot with items is eaten."""
    state = _state(spark, d)
    first = state["plates"].where("planned").join(state["plate_items"].select(F.col("plate_id").alias("id")), "id", "left_semi").agg(F.min("id").alias("id")).head().id
    after = plates.cook_slot(state, first, _now())
    n = after["plates"].agg(F.count_if("planned").alias("planned"))
    return after["stock"].select("ing_id", "qty").crossJoin(F.broadcast(n))


@query("SELECT o_orderkey AS recipe_id, 1.0::DOUBLE AS perweek FROM orders")
def schema_evolved(spark, d):
    """A table of before the column existed."""
    old = analog.table(spark, d, "orders").select(F.col("o_orderkey").alias("recipe_id"))
    return schema.with_missing_columns(old, schema.PINS, {"perweek": 1.0})


@query("SELECT (props->>'k')::BIGINT AS k FROM events")
def json_bodies(spark, d):
    return files.read_json_body(analog.table(spark, d, "events"), "props", "k long")


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS json FROM nation""")
def json_rows(spark, d):
    return files.to_json(analog.table(spark, d, "nation").select("n_nationkey", "n_name"))


# ---- all columns of the composition table -----------------------------------

_PARTS = {"protein": "CASE WHEN k % 6 <> 0 THEN p_size / 8.0 ELSE 0 END", "carbs": "k % 31 / 3.0", "fibre": "k % 7 / 2.0", "iron": "k % 17 / 1000.0 * 1e3", "calcium": "k % 19 / 1000.0 * 1e3", "vitc": "k % 11 / 1000.0 * 1e3", "folate": "k % 37 / 1e6 * 1e6", "omega3": "k % 5 / 10.0", "omega3_dha": "k % 3 / 10.0", "zinc": "k % 41 / 1000.0 * 1e3", "magnesium": "k % 43 / 1000.0 * 1e3", "potassium": "k % 47 / 1000.0 * 1e3",
          "kcal": "CASE WHEN k % 9 <> 0 AND k % 1500 <> 0 THEN k % 1500 / 4.184 ELSE 9 * p_size / 4.0 END", "vita": "k % 23 / 1e6 * 1e6 + k % 29 / 1e6 * 1e6 / 12"}


def _linked(spark, d) -> DataFrame:
    k = F.col("id").cast("long")
    return analog.ingredient_table(spark, d).withColumn("ifct_code", F.when(k % 10 == 0, "").otherwise(k.cast("string"))).withColumn("grams", F.when(k % 8 == 0, 0.0).otherwise((k % 50 + 50).cast("double")))


@query("WITH i AS (SELECT p_partkey AS k, p_size, (p_partkey % 50 + 50) / 100.0 AS s FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 8 <> 0 AND p_partkey % 4 <> 3) SELECT k::VARCHAR AS id, " + ", ".join(f"round((({x}) * s)::DOUBLE, 6) AS {c}" for c, x in _PARTS.items()) + " FROM i")
def derive_all(spark, d):
    """Every nutrient of the matched rows, by one join."""
    out = reference_layer.derive(_linked(spark, d), analog.composition(spark, d)).where("source = 'MATCHED'")
    return out.select("id", *(F.round(f"new_{c}", 6).alias(c) for c in _PARTS))


@query(f"""
WITH i AS (SELECT p_partkey AS k, p_size, p_retailprice, (p_partkey % 50 + 50) / 100.0 AS s, p_partkey % 10 <> 0 AND p_partkey % 8 <> 0 AND p_partkey % 4 <> 3 AS hit FROM part)
SELECT k::VARCHAR AS id, round((CASE WHEN hit THEN ({_PARTS['kcal']}) * s ELSE p_retailprice END)::DOUBLE, 6) AS kcal, round((CASE WHEN hit THEN ({_PARTS['iron']}) * s ELSE k % 13 / 8.0 END)::DOUBLE, 6) AS iron FROM i""")
def derive_written(spark, d):
    """The table after the write-back: rows without a match keep their values."""
    i = _linked(spark, d)
    return reference_layer.write_back(i, reference_layer.derive(i, analog.composition(spark, d))).select("id", F.round("kcal", 6).alias("kcal"), F.round("iron", 6).alias("iron"))
