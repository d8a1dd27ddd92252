"""Registered queries over the star-schema analogs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.parsing import half_up, pairs, run_of, tokens
from granary.operators import availability, demand, dq, ledger, menu, merge, nutrition, plates, projections, reference_layer
from granary.plans.registry import QUERIES, SQL, query
from granary.sources import analog, files
from granary.sources.schema import FLAGS

# ---- demand -----------------------------------------------------------------

_RATE = """
as_of AS (SELECT max(o_orderdate)::DATE AS d FROM orders),
ate AS (SELECT o_orderkey, o_orderdate::DATE AS dt FROM orders, as_of WHERE o_orderstatus <> 'P' AND o_orderdate::DATE BETWEEN d - 13 AND d),
rate AS (SELECT l_partkey AS id, sum(l_quantity)::DOUBLE / (SELECT count(DISTINCT dt) FROM ate) AS rate FROM lineitem JOIN ate ON o_orderkey = l_orderkey GROUP BY 1)"""
_PIN = """
pinned AS (SELECT o_orderkey, 1.0 + o_orderkey % 3 AS perweek FROM orders WHERE o_orderkey % 97 = 0),
used AS (SELECT DISTINCT o_orderkey, perweek, l_partkey FROM pinned JOIN lineitem ON l_orderkey = o_orderkey),
pin AS (SELECT l_partkey AS id, sum(10.0 * perweek)::DOUBLE / 7 AS pin FROM used JOIN part ON p_partkey = l_partkey GROUP BY 1)"""
_MENU = """
slots AS (SELECT o_orderkey, o_orderdate::DATE AS dt FROM orders WHERE o_orderstatus = 'P'),
menu AS (SELECT l_partkey AS id, sum(l_quantity)::DOUBLE / (SELECT count(DISTINCT dt) FROM slots) AS menu FROM lineitem JOIN slots ON o_orderkey = l_orderkey GROUP BY 1)"""


def _buy_sql(h: int, menu: bool) -> str:
    return f"""
WITH {_RATE}, {_PIN}, {_MENU},
b AS (SELECT p_partkey AS id, p_name AS name, coalesce(nullif(p_size, 0), 30) AS shelf, 1.0 + p_partkey % 4 AS pack, (p_partkey % 5)::DOUBLE AS qty,
  coalesce(rate, 0) AS rate, coalesce(pin, 0) AS pin, coalesce(menu, 0) AS menu, p_partkey AS sort
  FROM part LEFT JOIN rate ON rate.id = p_partkey LEFT JOIN pin ON pin.id = p_partkey LEFT JOIN menu ON menu.id = p_partkey),
d AS (SELECT *, CASE WHEN {'(SELECT count(*) FROM slots) > 0' if menu else 'FALSE'} THEN 'menu' WHEN pin > rate THEN 'pinned' ELSE 'eaten' END AS driver, least({h}, shelf) AS cap_days FROM b),
e AS (SELECT *, CASE driver WHEN 'menu' THEN menu WHEN 'pinned' THEN pin ELSE rate END AS daily FROM d),
n AS (SELECT *, round(daily * cap_days - qty, 6) AS need FROM e)
SELECT id, name, CASE WHEN shelf <= 3 THEN 'fresh' WHEN shelf <= 14 THEN 'weekly' ELSE 'staple' END AS run, driver, daily, cap_days, need,
  CASE WHEN need > 0 THEN ceil(round(need / pack, 9)) ELSE 0 END::BIGINT AS packs, cap_days < {h} AS capped, sort FROM n WHERE need > 0.05"""


def _buy(spark, d, horizon: int, use_menu: bool) -> DataFrame:
    p, i, ing = analog.plates(spark, d), analog.items(spark, d), analog.ingredients(spark, d)
    menu = demand.menu_rate(p, i)
    return demand.buy_list(ing, analog.stock(spark, d), demand.observed_rate(p, i, demand.latest(p)), demand.pinned_demand(analog.pins(spark, d), analog.recipes(spark, d), ing), menu if use_menu else menu.where("false"), horizon)


@query(_buy_sql(30, False))
def buy_list(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: eaten against pinned demand over 30 days."""
    return _buy(spark, d, 30, False)


@query(_buy_sql(7, True))
def buy_list_menu(spark, d):
    """Any planned slot turns all items to menu demand."""
    return _buy(spark, d, 7, True)


@query(f"WITH {_RATE} SELECT id AS ing_id, rate FROM rate")
def observed_rate(spark, d):
    p = analog.plates(spark, d)
    return demand.observed_rate(p, analog.items(spark, d), demand.latest(p))


@query(f"WITH {_PIN} SELECT id AS ing_id, pin FROM pin")
def pin_demand(spark, d):
    return demand.pinned_demand(analog.pins(spark, d), analog.recipes(spark, d), analog.ingredients(spark, d))


@query(f"WITH {_MENU} SELECT id AS ing_id, menu FROM menu")
def menu_demand(spark, d):
    return demand.menu_rate(analog.plates(spark, d), analog.items(spark, d))


@query("""
SELECT p_partkey AS id, coalesce(sum(l_quantity) FILTER (l_linenumber <= 3), 0)::DOUBLE AS rate, coalesce(sum(l_quantity) FILTER (l_linenumber > 3), 0)::DOUBLE AS pin,
  CASE WHEN coalesce(sum(l_quantity) FILTER (l_linenumber > 3), 0) > coalesce(sum(l_quantity) FILTER (l_linenumber <= 3), 0) THEN 'pinned' ELSE 'eaten' END AS driver
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1""")
def driver_pick(spark, d):
    q = F.col("qty").cast("decimal(18,2)")
    s = analog.items(spark, d).groupBy("ing_id").agg(F.sum(F.when(F.col("line") <= 3, q)).cast("double").alias("rate"), F.sum(F.when(F.col("line") > 3, q)).cast("double").alias("pin"))
    out = analog.ingredients(spark, d).select("id").join(s, F.col("id") == F.col("ing_id"), "left").select("id", F.coalesce("rate", F.lit(0.0)).alias("rate"), F.coalesce("pin", F.lit(0.0)).alias("pin"))
    return out.withColumn("driver", demand.driver(F.col("rate"), F.col("pin"), F.lit(False)))


@query(f"""
WITH b AS ({_buy_sql(30, False)}) SELECT run, count(*) AS items, count(*) FILTER (id % 2 = 1) AS left_ FROM b GROUP BY run""".replace("left_", '"left"'))
def shopping_progress(spark, d):
    rows = buy_list(spark, d)
    ticked = analog.ingredients(spark, d).where(F.col("id") % 2 == 0).select(F.col("id").alias("ing_id"))
    return demand.shopping_progress(rows, ticked)


# ---- availability -----------------------------------------------------------

_STATUS = """
s AS (SELECT l_orderkey AS id, count(*) AS core_size, count(*) FILTER (p_size IS NULL OR p_size < 25) AS n_missing
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 3 GROUP BY 1)"""
_MISS = "m AS (SELECT DISTINCT s.*, l_partkey AS ing_id FROM s JOIN lineitem ON l_orderkey = s.id AND l_linenumber <= 3 LEFT JOIN part ON p_partkey = l_partkey WHERE (p_size IS NULL OR p_size < 25) AND n_missing BETWEEN 1 AND 2 AND core_size > n_missing)"


def _status(spark, d) -> DataFrame:
    servings = analog.ingredients(spark, d).withColumn("default", F.lit(25.0))
    return availability.core_rows_status(analog.core_rows(spark, d), servings, analog.stock_by_size(spark, d))


@query(f"WITH {_STATUS} SELECT id, core_size, n_missing, n_missing = 0 AS makeable FROM s")
def makeable_status(spark, d):
    return _status(spark, d).select("id", "core_size", "n_missing", (F.col("n_missing") == 0).alias("makeable"))


@query(f"WITH {_STATUS} SELECT id, core_size, n_missing FROM s WHERE n_missing BETWEEN 1 AND 2 AND core_size > n_missing")
def near_misses(spark, d):
    return availability.near_misses(_status(spark, d)).select("id", "core_size", "n_missing")


@query(f"WITH {_STATUS} SELECT id, core_size, n_missing FROM s WHERE n_missing BETWEEN 1 AND 2 AND core_size > n_missing ORDER BY n_missing, core_size DESC, id LIMIT 6")
def near_miss_top6(spark, d):
    return availability.ranked_near_misses(availability.near_misses(_status(spark, d))).select("id", "core_size", "n_missing")


@query(f"WITH {_STATUS}, {_MISS}, r AS (SELECT ing_id, id AS recipe_id, row_number() OVER (PARTITION BY ing_id ORDER BY n_missing, core_size DESC, id) AS rank FROM m) SELECT * FROM r WHERE rank <= 3")
def unlocks_top3(spark, d):
    return availability.unlocks(availability.near_misses(_status(spark, d)))


@query("SELECT p_partkey AS id, p_size::DOUBLE AS qty, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part")
def kitchen_rank(spark, d):
    s = analog.stock_by_size(spark, d).withColumnRenamed("ing_id", "id")
    return availability.kitchen_rank(s, F.col("qty"), F.col("id")).select("id", "qty", "rank")


@query("SELECT l_orderkey AS id FROM lineitem WHERE l_orderkey % 97 <> 0 GROUP BY 1")
def unpinned_recipes(spark, d):
    return availability.unpinned(analog.recipes(spark, d), analog.pins(spark, d)).select("id")


@query("SELECT l_orderkey AS id, 1.0::DOUBLE + l_orderkey % 3 AS perweek, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 97 = 0 GROUP BY 1, 2")
def pinned_recipes(spark, d):
    return availability.pinned(analog.recipes(spark, d), analog.pins(spark, d)).select("id", "perweek", (F.size("core") + F.size("opt")).cast("long").alias("n"))


# ---- ledger -----------------------------------------------------------------

_LOG = "e AS (SELECT user_id AS item, ts, event_id, (CASE WHEN event_type IN ({adds}) THEN value ELSE -value END)::DECIMAL(18,2) AS v, event_type = 'signup' AS is_set FROM events)"


def _ledger_sql(sets: bool) -> str:
    adds = "'purchase', 'signup'" if sets else "'purchase'"
    seg = "sum(CASE WHEN is_set THEN 1 ELSE 0 END) OVER (PARTITION BY item ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)" if sets else "0"
    return f"""
WITH {_LOG.format(adds=adds)},
g AS (SELECT *, {seg} AS seg FROM e),
s AS (SELECT *, sum(v) OVER (PARTITION BY item, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT item, event_id, (s - least(0, min(s) OVER (PARTITION BY item, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)))::DOUBLE AS qty FROM s"""


@query(_ledger_sql(False))
def ledger_floor(spark, d):
    log = analog.ledger(spark, d).withColumn("delta", F.when(F.col("is_set"), -F.col("delta")).otherwise(F.col("delta")))
    return ledger.history(log, "item", ["ts", "event_id"], F.col("delta")).select("item", "event_id", "qty")


@query(_ledger_sql(True))
def ledger_set_reset(spark, d):
    return ledger.history(analog.ledger(spark, d), "item", ["ts", "event_id"], F.col("delta"), F.col("is_set")).select("item", "event_id", "qty")


@query(f"WITH h AS ({_ledger_sql(True)}) SELECT item, arg_max(qty, (e.ts, h.event_id)) AS qty FROM h JOIN events e USING (event_id) GROUP BY item")
def stock_state(spark, d):
    return ledger.state(analog.ledger(spark, d), "item", ["ts", "event_id"], F.col("delta"), F.col("is_set"))


@query("SELECT user_id AS item, max(ts) FILTER (event_type = 'purchase') AS bought_at FROM events GROUP BY 1")
def purchase_clock(spark, d):
    return ledger.purchase_clock(analog.ledger(spark, d), "item", ["ts", "event_id"], "ts", F.col("bought").cast("int"))


@query("""
WITH c AS (SELECT user_id AS item, max(ts) FILTER (event_type = 'purchase') AS bought_at FROM events GROUP BY 1)
SELECT item, bought_at, coalesce(bought_at::DATE + (1 + item % 20)::INTEGER < (SELECT max(ts)::DATE FROM events), FALSE) AS expired FROM c""")
def freshness_expired(spark, d):
    as_of = analog.table(spark, d, "events").agg(F.max("ts").alias("as_of"))
    clock = purchase_clock(spark, d).crossJoin(F.broadcast(as_of))
    return ledger.expired(clock, 1 + F.col("item") % 20, F.col("as_of")).drop("as_of")


# ---- plates -----------------------------------------------------------------


@query("""
SELECT o_orderkey AS id, o_orderdate::DATE AS date, o_orderpriority AS meal, count(l_orderkey) AS n_items, coalesce(sum(l_quantity), 0)::DOUBLE AS qty
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderdate >= DATE '2001-01-01' GROUP BY ALL""")
def plates_with_items(spark, d):
    p = plates.kept_plates(analog.plates(spark, d), since="2001-01-01")
    nested = plates.with_items(p, plates.items_of(analog.items(spark, d), p))
    total = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["qty"])
    return nested.select("id", "date", "meal", F.size("items").cast("long").alias("n_items"), total.alias("qty"))


@query("""
SELECT o_orderkey AS id, o_orderdate::DATE AS date, o_orderpriority AS meal, o_orderstatus = 'P' AS planned, count(l_orderkey) AS n_items, coalesce(sum(l_quantity), 0)::DOUBLE AS qty
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def plates_with_items_all(spark, d):
    """Every plate, eaten or planned; plates_with_items shows the date bound."""
    p = analog.plates(spark, d)
    nested = plates.with_items(p, plates.items_of(analog.items(spark, d), p))
    total = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["qty"])
    return nested.select("id", "date", "meal", "planned", F.size("items").cast("long").alias("n_items"), total.alias("qty"))


@query("SELECT o_orderkey AS id FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')")
def menu_clear(spark, d):
    return plates.clear_menu(analog.plates(spark, d), "1998-01-01", "1998-12-31").select("id")


@query("""
WITH b AS (SELECT o_orderkey + 100000000 AS id, o_orderdate::DATE AS date FROM orders WHERE o_orderkey % 50 = 0 AND year(o_orderdate) = 1997),
s AS (SELECT min(date) AS lo, max(date) AS hi FROM b)
SELECT o_orderkey AS id, o_orderdate::DATE AS date, o_orderstatus = 'P' AS planned FROM orders, s WHERE NOT (o_orderstatus = 'P' AND o_orderdate::DATE BETWEEN coalesce(lo, DATE '0001-01-01') AND coalesce(hi, DATE '0001-01-01'))
UNION ALL SELECT id, date, TRUE FROM b""")
def range_replace(spark, d):
    p = analog.plates(spark, d)
    batch = p.where((F.col("id") % 50 == 0) & (F.year("date") == 1997)).withColumn("id", F.col("id") + 100000000)
    return plates.save_menu(p, batch).select("id", "date", "planned")


# ---- nutrition --------------------------------------------------------------

_DELIVERED = "CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN 0 ELSE p_partkey % 13 END"


@query(f"""
SELECT o_orderdate::DATE AS date, sum((p_retailprice * l_quantity)::DECIMAL(24,6))::DOUBLE AS kcal, sum((p_size / 10.0 * l_quantity)::DECIMAL(24,6))::DOUBLE AS protein, sum(({_DELIVERED}) * l_quantity)::DOUBLE AS iron
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P' GROUP BY 1""")
def nutrient_rollup_day(spark, d):
    p = plates.kept_plates(analog.plates(spark, d)).select(F.col("id").alias("plate_id"), "date")
    return nutrition.totals(analog.items(spark, d).join(p, "plate_id"), analog.ingredients(spark, d), ["date"])




def _targets(spark) -> DataFrame:
    return spark.createDataFrame([("p", 1500.0, True), ("fe", 3000.0, False), ("kcal", 0.0, True)], "nkey string, daily double, permeal boolean")


@query(f"""
WITH r AS (SELECT o_orderdate::DATE AS date, sum((p_size / 10.0 * l_quantity)::DECIMAL(24,6))::DOUBLE AS p, sum(({_DELIVERED}) * l_quantity)::DOUBLE AS fe
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P' GROUP BY 1),
l AS (SELECT date, 'p' AS nkey, p AS total, 1500.0::DOUBLE AS daily, TRUE AS permeal FROM r UNION ALL SELECT date, 'fe', fe, 3000.0, FALSE FROM r),
c AS (SELECT *, 100 * total / daily AS pct FROM l)
SELECT date, nkey, total, pct, CASE WHEN pct < 70 THEN 'LOW' WHEN pct > 200 THEN 'over' ELSE 'ok' END AS status, pct < 50 AND permeal AS failed FROM c""")
def target_status(spark, d):
    long_ = nutrition.unpivot(nutrient_rollup_day(spark, d), ["date"])
    return nutrition.target_status(long_, _targets(spark)).select("date", "nkey", "total", "pct", "status", "failed")


@query(f"SELECT l_orderkey AS plate_id, sum(({_DELIVERED}) * l_quantity)::DOUBLE AS iron FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def gated_total(spark, d):
    return nutrition.totals(analog.items(spark, d), analog.ingredients(spark, d), ["plate_id"], ["iron"])


@query("""
WITH v AS (SELECT o_orderdate::DATE AS date, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS value FROM orders WHERE o_orderdate >= DATE '2001-06-01' GROUP BY 1)
SELECT date, value, sum(value::DECIMAL(24,6)) OVER (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)::DOUBLE AS value_7d FROM v""")
def rolling_7day(spark, d):
    o = analog.table(spark, d, "orders").where("o_orderdate >= '2001-06-01'")
    daily = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return nutrition.rolling(daily, "date", "value")


@query("""
WITH v AS (SELECT o_orderdate::DATE AS date, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS value FROM orders GROUP BY 1)
SELECT date, value, sum(value::DECIMAL(24,6)) OVER (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)::DOUBLE AS value_7d FROM v""")
def rolling_7day_all(spark, d):
    """Every date of orders; rolling_7day shows the last months only."""
    daily = analog.table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return nutrition.rolling(daily, "date", "value")


@query("""
SELECT l_partkey AS id, count(*) AS n, round(quantile_cont(l_quantity / (1 + l_linenumber % 4), 0.25), 1) AS p25, round(quantile_cont(l_quantity / (1 + l_linenumber % 4), 0.5), 1) AS median,
  round(quantile_cont(l_quantity / (1 + l_linenumber % 4), 0.75), 1) AS p75 FROM lineitem GROUP BY 1 HAVING count(*) >= 3""")
def portion_quartiles(spark, d):
    out = nutrition.quartiles(analog.items(spark, d).withColumnRenamed("ing_id", "id"), "id", F.col("qty") / (1 + F.col("line") % 4))
    return out.select("id", "n", *(F.round(c, 1).alias(c) for c in ("p25", "median", "p75")))


@query("""
WITH g AS (SELECT l_partkey AS id, count(*) FILTER (l_linenumber <= 2) AS nc, count(*) AS na, quantile_cont(l_quantity, 0.5) FILTER (l_linenumber <= 2) AS mc, quantile_cont(l_quantity, 0.5) AS ma FROM lineitem GROUP BY 1)
SELECT id, CASE WHEN nc >= 3 THEN 'core' ELSE 'all' END AS basis, CASE WHEN nc >= 3 THEN nc ELSE na END AS n, round(CASE WHEN nc >= 3 THEN mc ELSE ma END, 1) AS serving FROM g""")
def serving_basis(spark, d):
    out = nutrition.serving_basis(analog.items(spark, d).withColumnRenamed("ing_id", "id"), "id", F.col("qty"), F.col("line") <= 2)
    return out.withColumn("serving", F.round("serving", 1))


@query("""
WITH t AS (SELECT CASE WHEN p_size <= 6 THEN 'assembly' WHEN p_size BETWEEN 8 AND 15 THEN 'one-pan' WHEN p_size >= 20 THEN 'multi-step' END AS tier, p_size / 10.0 AS protein, p_retailprice AS kcal, (p_partkey % 9)::DOUBLE AS fat FROM part)
SELECT tier, count(*) AS dishes, round(avg(protein), 6) AS protein, round(avg(fat), 6) AS fat, round(100 * sum(protein) / sum(kcal), 6) AS protein_per_100kcal FROM t WHERE tier IS NOT NULL GROUP BY tier""")
def effort_tiers(spark, d):
    dishes = analog.ingredients(spark, d).select(F.col("shelf").alias("effort"), "protein", "kcal", (F.col("id") % 9).cast("double").alias("fat"))
    out = nutrition.effort_tiers(dishes)
    return out.select("tier", "dishes", *(F.round(c, 6).alias(c) for c in ("protein", "fat", "protein_per_100kcal")))


@query("""
SELECT p_partkey AS id, round(((p_size / 660.04) / nullif((p_partkey % 7) / 55.85, 0)), 9) AS ratio,
  CASE WHEN (p_size / 660.04) / nullif((p_partkey % 7) / 55.85, 0) > 1 THEN 'inhibited' WHEN (p_size / 660.04) / nullif((p_partkey % 7) / 55.85, 0) < 0.4 THEN 'good' END AS iron_class FROM part""")
def phytate_ratio(spark, d):
    r = nutrition.molar_ratio(F.col("shelf").cast("double"), (F.col("id") % 7).cast("double"), nutrition.IRON)
    return analog.ingredients(spark, d).select("id", F.round(r, 9).alias("ratio"), nutrition.iron_class(r).alias("iron_class"))


# ---- merge ------------------------------------------------------------------


@query("""
WITH t AS (SELECT p_partkey AS id, p_name AS name, p_size AS effort, CASE WHEN p_partkey % 5 = 0 THEN 'user' ELSE '' END AS effort_src, p_partkey % 7 = 0 AS is_user FROM part WHERE p_partkey % 3 <> 0),
s AS (SELECT p_partkey AS id, 'new ' || p_name AS name, p_size + 100 AS effort FROM part WHERE p_partkey % 2 = 0)
SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL OR (s.id IS NOT NULL AND NOT is_user) THEN s.name ELSE t.name END AS name,
  CASE WHEN t.id IS NULL OR (s.id IS NOT NULL AND NOT is_user AND effort_src <> 'user') THEN s.effort ELSE t.effort END AS effort, coalesce(is_user, FALSE) AS is_user
FROM t FULL JOIN s ON t.id = s.id""")
def merge_guarded(spark, d):
    k = F.col("id")
    base = analog.ingredients(spark, d).select("id", "name", F.col("shelf").alias("effort"))
    state = base.where(k % 3 != 0).withColumn("effort_src", F.when(k % 5 == 0, "user").otherwise("")).withColumn("is_user", k % 7 == 0)
    seed = base.where(k % 2 == 0).withColumn("name", F.concat(F.lit("new "), "name")).withColumn("effort", F.col("effort") + 100)
    return merge.merge_recipes(state, seed).select("id", "name", "effort", "is_user")


@query("SELECT p_partkey AS ing_id, CASE WHEN p_partkey % 3 = 0 THEN p_size::DOUBLE ELSE 1.0 + p_partkey % 4 END AS qty FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0")
def merge_do_nothing(spark, d):
    state = analog.stock_by_size(spark, d).where(F.col("ing_id") % 3 == 0).select("ing_id", "qty", *(F.lit(None).cast("timestamp").alias(c) for c in ("updated_at", "bought_at")), F.lit(False).alias("useup"))
    return merge.seed_stock(state, analog.ingredients(spark, d), F.lit("2001-01-01").cast("timestamp")).select("ing_id", "qty")


@query("SELECT p_partkey AS ing_id, greatest(0, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 5 - p_partkey % 9 ELSE p_partkey % 5 END)::DOUBLE AS qty FROM part")
def merge_stock_add(spark, d):
    t = "timestamp"
    s = analog.stock(spark, d)
    state = s.select("ing_id", "qty", F.lit(None).cast(t).alias("updated_at"), F.lit(None).cast(t).alias("bought_at"), F.lit(False).alias("useup"))
    deltas = s.where(F.col("ing_id") % 2 == 0).select("ing_id", (-(F.col("ing_id") % 9)).cast("double").alias("delta"))
    return merge.add_stock(state, deltas, F.lit("2001-01-01").cast(t)).select("ing_id", "qty")


@query("SELECT o_orderkey AS recipe_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 ELSE 1 + o_orderkey % 3 END::DOUBLE AS perweek FROM orders WHERE o_orderkey % 97 = 0 AND NOT (o_orderkey % 2 = 0 AND o_orderkey % 5 = 0)")
def merge_pins(spark, d):
    p = analog.pins(spark, d)
    return merge.set_pins(p, p.where(F.col("recipe_id") % 2 == 0).withColumn("perweek", (F.col("recipe_id") % 5).cast("double")))


@query("SELECT o_custkey AS key, max(o_orderkey) AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1 GROUP BY 1")
def last_writer_wins(spark, d):
    o = analog.table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), "o_orderdate")
    return merge.last_writer_wins(o, "key", "o_orderdate", "id").select("key", "id")


# ---- data quality -----------------------------------------------------------


@query("SELECT 'E' AS level, 'lineitem' AS file, l_orderkey::VARCHAR AS key, 'refs' AS rule, l_partkey::VARCHAR AS detail FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 100 <> 0)")
def dq_refs(spark, d):
    known = analog.ingredients(spark, d).where(F.col("id") % 100 != 0).select(F.col("id").cast("string").alias("id"))
    return dq.dangling(analog.items(spark, d), F.col("ing_id").cast("string"), known, "lineitem", "refs", "plate_id")


@query("SELECT 'E' AS level, 'lineitem' AS file, l_orderkey || ':' || l_linenumber AS key, 'dup' AS rule, count(*)::VARCHAR AS detail FROM lineitem GROUP BY 3 HAVING count(*) > 1")
def dq_duplicates(spark, d):
    rows = analog.items(spark, d).select(F.concat_ws(":", "plate_id", "line").alias("id"))
    return dq.duplicates(rows, "lineitem", "dup")


@query("SELECT 'E' AS level, 'part' AS file, p_partkey::VARCHAR AS key, 'range' AS rule, 'shelf' AS detail FROM part WHERE p_size > 45")
def dq_ranges(spark, d):
    cells = analog.ingredients(spark, d).select("id", F.col("shelf").cast("string").alias("shelf"), F.col("kcal").cast("string").alias("kcal").alias("price"))
    return dq.numbers(cells.select("id", "shelf"), ["shelf"], "part", "range", "parse", most=45)


@query("""
WITH i AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN 'iron' WHEN p_partkey % 11 = 0 THEN 'protein' END AS gate, p_size / 10.0 AS protein, CASE WHEN p_partkey % 50 = 0 THEN 1.0 ELSE 0.0 END AS iron FROM part)
SELECT id, gate AS nutrient FROM i WHERE gate IS NOT NULL AND NOT EXISTS (SELECT 1 FROM i j WHERE j.id <> i.id AND (j.gate IS NULL OR j.gate <> i.gate) AND CASE i.gate WHEN 'iron' THEN j.iron ELSE j.protein END > 0)""")
def dq_unreachable(spark, d):
    k = F.col("id")
    gate = F.when(k % 50 == 0, F.array(F.lit("fe"))).when(k % 11 == 0, F.array(F.lit("protein"))).otherwise(F.array().cast("array<string>"))
    i = analog.ingredients(spark, d).select("id", "protein", F.when(k % 50 == 0, 1.0).otherwise(0.0).alias("iron"), gate.alias("gated"))
    return dq.unreachable(i)


@query("""
SELECT 'E' AS level, 'part' AS file, p_partkey::VARCHAR AS key, 'DQ8' AS rule, (4 * p_size + 4 * (p_partkey % 40))::DOUBLE::VARCHAR AS detail FROM part
WHERE 4 * p_size + 4 * (p_partkey % 40) > 1.12 * (p_partkey % 200) AND 4 * p_size + 4 * (p_partkey % 40) - p_partkey % 200 > 3 AND p_partkey % 200 > 0""")
def dq_macros(spark, d):
    k = F.col("id")
    macro = (4 * F.col("shelf") + 4 * (k % 40)).cast("double")
    kcal = (k % 200).cast("double")
    return dq.violation(analog.ingredients(spark, d), (kcal > 0) & (macro > 1.12 * kcal) & (macro - kcal > 3), "E", "part", "DQ8", detail=macro)


@query("""
SELECT 'E' AS level, 'part' AS file, p_partkey::VARCHAR AS key, 'DQ40' AS rule, 'missing' AS detail FROM part WHERE p_partkey % 40 = 0
UNION ALL SELECT 'E', 'part', p_partkey::VARCHAR, 'DQ40', 'iron' FROM part WHERE p_partkey % 40 <> 0 AND p_partkey % 30 = 0
UNION ALL SELECT 'E', 'part', 'part', 'DQ39', (SELECT count(*) FROM part) || '/' || (SELECT count(*) FROM part WHERE p_partkey % 40 <> 0)""")
def dq_store(spark, d):
    i = analog.ingredients(spark, d).select("id", "iron", "needform").withColumn("id", F.col("id").cast("string"))
    store = analog.ingredients(spark, d).where(F.col("id") % 40 != 0).withColumn("iron", F.when(F.col("id") % 30 == 0, F.col("iron") + 1).otherwise(F.col("iron")))
    return dq.store_rules(i, store.select(F.col("id").cast("string").alias("id"), "iron", "needform"), ["iron"], ["needform"], "part")


# ---- composition ------------------------------------------------------------


def _linked(spark, d) -> DataFrame:
    k = F.col("id")
    return analog.ingredients(spark, d).select("id", "protein", "iron", F.when(k % 10 == 0, "").otherwise(k.cast("string")).alias("ifct_code"), F.when(k % 8 == 0, 0.0).otherwise((k % 50 + 50).cast("double")).alias("grams"), F.lit(5.0).alias("kcal"), F.lit(1.0).alias("vita"))


_COLUMNS = ["protein", "iron", "kcal", "vita"]


@query("""
SELECT CASE WHEN p_partkey % 10 = 0 OR p_partkey % 8 = 0 THEN 'UNSOURCED' WHEN p_partkey % 4 = 3 THEN 'MISSING CODE' ELSE 'MATCHED' END AS source, count(*) AS n FROM part GROUP BY 1""")
def derive_sources(spark, d):
    return reference_layer.source_counts(reference_layer.derive(_linked(spark, d), analog.composition(spark, d), _COLUMNS))


@query("""
WITH m AS (SELECT p_partkey AS id, p_size / 10.0 AS protein, CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_partkey % 13 END::DOUBLE AS iron, (p_partkey % 50 + 50) / 100.0 AS s,
  CASE WHEN p_partkey % 6 <> 0 THEN p_size / 8.0 ELSE 0 END AS protcnt, (p_partkey % 17) / 1000.0 AS fe, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 1500 ELSE 0 END AS enerc, p_size / 4.0 AS fatce, (p_partkey % 23) / 1e6 AS retol, (p_partkey % 29) / 1e6 AS cartbeq
  FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 8 <> 0 AND p_partkey % 4 <> 3),
l AS (SELECT id, 'protein' AS "column", protein AS old, protcnt * s AS new FROM m UNION ALL SELECT id, 'iron', iron, fe * 1000 * s FROM m
  UNION ALL SELECT id, 'kcal', 5.0, CASE WHEN enerc = 0 AND fatce <> 0 THEN 9 * fatce * s ELSE enerc / 4.184 * s END FROM m UNION ALL SELECT id, 'vita', 1.0, (retol * 1e6 + cartbeq * 1e6 / 12) * s FROM m)
SELECT id, "column", round(old, 6) AS old, round(new, 6) AS new FROM l WHERE abs(old - new) > greatest(0.05, 0.02 * abs(old))""")
def derive_drift(spark, d):
    out = reference_layer.drift(reference_layer.derive(_linked(spark, d), analog.composition(spark, d), _COLUMNS))
    return out.select("id", "column", F.round("old", 6).alias("old"), F.round("new", 6).alias("new"))


@query("SELECT p_partkey::VARCHAR AS code, p_name AS name FROM part WHERE p_partkey % 4 <> 3 AND (p_name ILIKE '%7%' OR p_brand ILIKE '%7%' OR p_type ILIKE '%7%') ORDER BY code LIMIT 25")
def search_like(spark, d):
    return reference_layer.search(analog.composition(spark, d), "7", ["name", "scie", "grup"], "code").select("code", "name")


# ---- parsing ----------------------------------------------------------------


@query("SELECT o_orderkey AS id, '  ' || o_orderpriority || '  x' AS line FROM orders WHERE o_orderkey % 3 = 2")
def csv_comments(spark, d):
    """Comment lines, indented ones too, and blank lines are dropped anywhere."""
    k = F.col("o_orderkey")
    line = F.concat(F.when(k % 3 == 0, "# ").when(k % 3 == 1, "   #").otherwise("  "), F.col("o_orderpriority"), F.lit("  x"))
    lines = analog.table(spark, d, "orders").select(k.alias("id"), line.alias("value"))
    return files.content_lines(lines).select("id", F.col("value").alias("line"))


@query("SELECT o_orderkey AS id, len(list_filter(string_split_regex(o_orderpriority || '  a b ', '\\s+'), lambda x: x <> ''))::BIGINT AS n FROM orders")
def token_lists(spark, d):
    o = analog.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.size(tokens(F.concat("o_orderpriority", F.lit("  a b ")))).cast("long").alias("n"))


@query("SELECT o_orderkey AS id, (o_orderkey % 10)::DOUBLE AS a, 7.0::DOUBLE AS b FROM orders")
def pairs_map(spark, d):
    o = analog.table(spark, d, "orders")
    text = F.concat(F.lit("a:1 junk b:7:9 a:"), (F.col("o_orderkey") % 10).cast("string"))
    return o.select(F.col("o_orderkey").alias("id"), pairs(text).alias("m")).select("id", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


@query("SELECT p_partkey AS id, floor(p_retailprice * 10 + 0.5) / 10 AS price, CASE WHEN p_size <= 3 THEN 'fresh' WHEN p_size <= 14 THEN 'weekly' ELSE 'staple' END AS run FROM part")
def half_up_runs(spark, d):
    return analog.ingredients(spark, d).select("id", half_up(F.col("kcal")).alias("price"), run_of(F.col("shelf")).alias("run"))


# ---- what clients read ------------------------------------------------------


@query("""
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 3 = 0 THEN 1.0 ELSE p_partkey % 3 END::DOUBLE AS "default", CASE WHEN p_partkey % 4 = 0 OR p_size = 0 THEN 30 ELSE p_size END AS shelf, CASE WHEN p_partkey % 3 = 0 THEN 1.0 ELSE p_partkey % 3 END::DOUBLE AS pack,
  CASE WHEN p_partkey % 6 = 0 THEN 8.0 ELSE 0.0 END::DOUBLE AS lead, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'n' END AS note, CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END::BIGINT AS n_makes,
  CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 0 END::BIGINT AS n_gated, p_partkey % 5 = 0 AS pantry, p_partkey % 11 = 0 AS topper, coalesce(CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 'c' || p_partkey END, '') AS ifct_code, p_retailprice AS kcal FROM part""")
def project_ingredients(spark, d):
    out = projections.ingredients(analog.ingredient_table(spark, d), client=True)
    return out.select("id", "default", "shelf", "pack", "lead", "note", F.size("makes").cast("long").alias("n_makes"), F.size("gated").cast("long").alias("n_gated"), "pantry", "topper", "ifct_code", "kcal")


@query("SELECT n_name AS fname, 'k' || n_nationkey AS key, n_regionkey::DOUBLE AS daily, n_nationkey % 2 = 0 AS permeal FROM nation")
def project_targets(spark, d):
    k = F.col("n_nationkey")
    rows = analog.table(spark, d, "nation").select(F.col("n_name").alias("fname"), F.concat(F.lit("k"), k.cast("string")).alias("nkey"), F.col("n_name").alias("name"), F.lit("g").alias("unit"), F.lit("day").alias("cadence"), F.col("n_regionkey").cast("double").alias("daily"), F.lit(0.0).alias("meal"), F.when(k % 2 == 0, True).alias("permeal"), (-k).cast("int").alias("sort"))
    return projections.targets(rows).select("fname", "key", "daily", "permeal")


@query("""
SELECT l_orderkey::VARCHAR AS id, 2::BIGINT AS n_meals, count(*) FILTER (l_linenumber <= 3) AS n_core, count(*) FILTER (l_linenumber > 3) AS n_opt, CASE WHEN l_orderkey % 2 = 0 THEN 'stir' ELSE '' END AS method, CASE WHEN l_orderkey % 3 <> 0 THEN 'neutral' ELSE '' END AS cuisine,
  CASE WHEN l_orderkey % 4 <> 0 THEN l_orderkey % 60 ELSE 0 END::INTEGER AS effort, CASE WHEN l_orderkey % 5 = 0 THEN 1.5 END::DOUBLE AS a, CASE WHEN l_orderkey % 5 = 0 THEN 2 ELSE 0 END::BIGINT AS n_amounts, l_orderkey % 7 = 0 AS user FROM lineitem GROUP BY l_orderkey""".replace("AS user", 'AS "user"'))
def project_recipes(spark, d):
    r = projections.recipes(analog.recipe_table(spark, d))
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return r.select("id", *map(n, ("meals", "core", "opt")), "method", "cuisine", "effort", F.col("amounts")["a"].alias("a"), n("amounts"), "user")


@query("""
SELECT p_partkey AS ing_id, (p_partkey % 5)::DOUBLE AS qty, CASE WHEN p_partkey % 2 = 0 THEN '2024-01-01T00:00:00' WHEN p_partkey % 3 = 0 THEN '2023-01-01T00:00:00' ELSE '' END AS bought, p_partkey % 7 = 0 AS useup FROM part""")
def project_stock(spark, d):
    k = F.col("ing_id")
    s = analog.stock(spark, d).select("ing_id", "qty", F.when(k % 2 == 0, "2024-01-01T00:00:00").otherwise("").alias("bought_at"), F.when(k % 3 == 0, "2023-01-01T00:00:00").alias("updated_at"), F.when(k % 7 == 0, True).alias("useup"))
    return projections.stock(s)


@query("SELECT o_orderkey AS recipe_id, 1.0::DOUBLE + o_orderkey % 3 AS perweek FROM orders WHERE o_orderkey % 97 = 0")
def project_pins(spark, d):
    return projections.pins(analog.pins(spark, d))


@query("""
SELECT (SELECT count(*) FROM part WHERE p_partkey % 5 > 0) AS stocked, (SELECT count(*) FROM orders WHERE o_orderkey % 97 = 0) AS pinned,
  (SELECT count(DISTINCT o_orderdate::DATE) FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate::DATE BETWEEN (SELECT max(o_orderdate)::DATE - 13 FROM orders) AND (SELECT max(o_orderdate)::DATE FROM orders)) AS logged_days""")
def header_counts(spark, d):
    p = analog.plates(spark, d)
    return demand.header_counts(analog.stock(spark, d), analog.pins(spark, d), p, demand.latest(p))


def _ranked_kitchen(spark, d) -> DataFrame:
    s = analog.stock_by_size(spark, d).withColumnRenamed("ing_id", "id").join(analog.ingredients(spark, d).select("id", "name"), "id")
    return availability.kitchen_rank(s, F.col("qty"), F.col("id"))


@query("SELECT p_partkey AS id, p_size::DOUBLE AS qty, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part ORDER BY rank LIMIT 12")
def kitchen_top12(spark, d):
    return availability.kitchen_rows(_ranked_kitchen(spark, d)).select("id", "qty", "rank")


@query("WITH r AS (SELECT p_partkey AS id, p_name, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part) SELECT id, rank FROM r WHERE lower(p_name) LIKE '%t 1%'")
def kitchen_search(spark, d):
    return availability.kitchen_rows(_ranked_kitchen(spark, d), " T 1").select("id", "rank")


# ---- files ------------------------------------------------------------------

_FILE = ["id", "name", "shelf", "pantry", "makes"]


@query("""
WITH l AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS sort FROM part)
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 9 <> 0 THEN p_name || ', x' END AS name, CASE WHEN p_partkey % 9 = 0 OR p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN '5d' ELSE p_size::VARCHAR END AS shelf, sort::INTEGER AS sort FROM l""")
def csv_rows(spark, d):
    """A commented file's rows with their ordinals, short rows and blank cells."""
    lines = files.numbered(files.content_lines(analog.ingredient_lines(spark, d)))
    return files.parse_lines(lines, _FILE, "sort").select("id", "name", "shelf", "sort")


@query("""
WITH l AS (SELECT p_partkey, p_partkey % 9 = 0 AS short, p_name, p_size, row_number() OVER (ORDER BY p_partkey) - 1 AS sort FROM part),
f AS (SELECT p_partkey::VARCHAR AS id, CASE WHEN short THEN NULL ELSE p_name || ', x' END AS name, 1.0::DOUBLE AS default_qty, CASE WHEN short OR p_partkey % 4 < 2 THEN 30 ELSE p_size END::INTEGER AS shelf, NOT short AND p_partkey % 3 = 0 AS pantry, CASE WHEN short THEN 0 ELSE 2 END::BIGINT AS n_makes, 0.0::DOUBLE AS kcal, sort FROM l WHERE p_partkey % 5 <> 1)
SELECT id, name, default_qty, shelf, pantry, n_makes, kcal, sort::INTEGER AS sort FROM f
UNION ALL SELECT p_partkey::VARCHAR, p_name, (p_partkey % 3)::DOUBLE, CASE WHEN p_partkey % 4 <> 0 THEN p_size ELSE 0 END::INTEGER, p_partkey % 5 = 0, CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END, p_retailprice, -p_partkey::INTEGER FROM part WHERE p_partkey % 5 = 1""")
def import_ingredients(spark, d):
    """The file replaces what it has; rows that it lacks stay."""
    lines = files.numbered(files.content_lines(analog.ingredient_lines(spark, d)))
    raw = files.parse_lines(lines, _FILE, "sort").where(F.col("id").cast("long") % 5 != 1)
    state = analog.ingredient_table(spark, d).where(F.col("id").cast("long") % 2 == 1)
    state = state.unionByName(analog.ingredient_table(spark, d).where((F.col("id").cast("long") % 2 == 0) & (F.col("id").cast("long") % 5 == 1)))
    out = merge.import_ingredients(state, raw)
    return out.select("id", "name", "default_qty", "shelf", "pantry", F.coalesce(F.size("makes"), F.lit(0)).cast("long").alias("n_makes"), "kcal", "sort")


@query("""
SELECT n_name AS fname, CASE WHEN n_nationkey % 3 = 0 THEN 'k' || n_nationkey ELSE 'old' END AS nkey, CASE WHEN n_nationkey % 3 <> 0 THEN 1.0 WHEN n_nationkey % 2 = 0 THEN 0.0 ELSE n_nationkey END::DOUBLE AS daily, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey % 2 = 0 ELSE FALSE END AS permeal FROM nation""")
def import_targets(spark, d):
    k = F.col("n_nationkey")
    n = analog.table(spark, d, "nation")
    state = n.select(F.col("n_name").alias("fname"), F.lit("old").alias("nkey"), F.col("n_name").alias("name"), F.lit("g").alias("unit"), F.lit("day").alias("cadence"), F.lit(1.0).alias("daily"), F.lit(0.0).alias("meal"), F.lit(False).alias("permeal"), k.cast("int").alias("sort"))
    raw = n.where(k % 3 == 0).select(F.col("n_name").alias("fname"), F.concat(F.lit("k"), k.cast("string")).alias("key"), F.col("n_name").alias("name"), F.when(k % 2 == 0, "none").otherwise(k.cast("string")).alias("daily"), F.when(k % 2 == 0, "").otherwise("0").alias("permeal"), k.alias("sort"))
    return merge.import_targets(state, raw).select("fname", "nkey", "daily", "permeal")


def _text_sql(x: str, places: int) -> str:
    return f"regexp_replace(printf('%.{places}f', ({x})::DOUBLE), '\\.?0+$', '')" if places else f"printf('%.0f', ({x})::DOUBLE)"


_EXPORT = ["id", "name", "default", "pantry", "kcal", "protein", "carbs", "iron", "calcium", "zinc", "shelf", "pack", "lead", "gated", "grams"]


@query(f"""
SELECT concat_ws(',', p_partkey, p_name, {_text_sql('p_partkey % 3', 4)}, CASE WHEN p_partkey % 5 = 0 THEN '1' ELSE '0' END, {_text_sql('p_retailprice', 0)}, {_text_sql('p_size / 8.0', 1)}, {_text_sql('(p_partkey % 40) / 4.0', 1)}, {_text_sql('(p_partkey % 13) / 8.0', 2)}, {_text_sql('p_partkey % 9 + 0.5', 0)},
  {_text_sql('(p_partkey % 17) / 16.0', 2)}, CASE WHEN p_partkey % 4 <> 0 THEN p_size ELSE 0 END, {_text_sql('p_partkey % 3', 4)}, CASE WHEN p_partkey % 6 = 0 THEN '8' ELSE '' END, CASE WHEN p_partkey % 11 = 0 THEN 'fe zn' ELSE '' END, {_text_sql('p_partkey % 50 + 0.5', 0)}) AS line FROM part
UNION ALL SELECT '# kept' UNION ALL SELECT '{",".join(_EXPORT)}'""")
def export_ingredients(spark, d):
    return files.ingredient_lines(analog.ingredient_table(spark, d), _EXPORT, ["# kept"])


@query("""
WITH r AS (SELECT l_orderkey AS k, string_agg(l_partkey::VARCHAR, ' ' ORDER BY l_linenumber, l_partkey) FILTER (l_linenumber <= 3) AS core, string_agg(l_partkey::VARCHAR, ' ' ORDER BY l_linenumber, l_partkey) FILTER (l_linenumber > 3) AS opt FROM lineitem GROUP BY 1)
SELECT concat(k, ',"Dish ""', k, '"", hot",lunch dinner,', coalesce(core, ''), ',', coalesce(opt, ''), ',', CASE WHEN k % 2 = 0 THEN 'stir' ELSE '' END, ',', CASE WHEN k % 3 <> 0 THEN 'neutral' ELSE '' END, ',', CASE WHEN k % 4 <> 0 THEN (k % 60)::VARCHAR ELSE '' END) AS line FROM r
UNION ALL SELECT 'id,name,meals,core,opt,method,cuisine,effort'""")
def export_recipes(spark, d):
    return files.recipe_lines(analog.recipe_table(spark, d))


@query("""
SELECT 'E' AS level, f AS file, p_partkey::VARCHAR AS key, rule, '2' AS detail FROM part, (VALUES ('ingredients', 'DQ1', 7), ('forms', 'DQ14', 11), ('phytate', 'DQ25', 13), ('retention', 'DQ30', 17), ('recipes', 'DQ32', 19)) v(f, rule, n) WHERE p_partkey % n = 0""")
def dq_widths(spark, d):
    """Rows of a wrong width in each file; those of targets are not reported."""
    k = F.col("p_partkey")

    def rows(n: int) -> DataFrame:
        line = F.when(k % n == 0, F.concat(k.cast("string"), F.lit(",x"))).otherwise(F.concat(k.cast("string"), F.lit(',"a, b",y')))
        return files.ragged(analog.table(spark, d, "part").select(line.alias("value")), 3)

    every = {"ingredients": 7, "forms": 11, "phytate": 13, "retention": 17, "recipes": 19, "targets": 23}
    return dq.union(dq.width_rules({f: rows(n) for f, n in every.items()}))


@query("SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey % 23 <> 0")
def dq_right_width(spark, d):
    k = F.col("p_partkey").cast("string")
    line = F.when(F.col("p_partkey") % 23 == 0, F.concat(k, F.lit(",x"))).otherwise(F.concat(k, F.lit(",p,g")))
    return dq.right_width(files.ragged(analog.table(spark, d, "part").select(line.alias("value")), 3), ["id", "key", "unit"]).select("id")


@query("""
SELECT 'E' AS level, 'part' AS file, p_partkey::VARCHAR AS key, 'DQ40' AS rule, 'missing' AS detail FROM part WHERE p_partkey % 40 = 0
UNION ALL SELECT 'E', 'part', p_partkey::VARCHAR, 'DQ40', 'not in file' FROM part WHERE p_partkey % 40 = 1
UNION ALL SELECT 'E', 'part', p_partkey::VARCHAR, 'DQ40', 'needform' FROM part WHERE p_partkey % 40 > 1 AND p_partkey % 33 = 0
UNION ALL SELECT 'E', 'part', 'part', 'DQ39', (SELECT count(*) FROM part WHERE p_partkey % 40 <> 1) || '/' || (SELECT count(*) FROM part WHERE p_partkey % 40 <> 0) WHERE (SELECT count(*) FROM part WHERE p_partkey % 40 <> 1) <> (SELECT count(*) FROM part WHERE p_partkey % 40 <> 0)""")
def dq_store_both_sides(spark, d):
    i = analog.ingredients(spark, d).select("id", "iron", "needform")
    store = i.where(F.col("id") % 40 != 0).withColumn("needform", F.when(F.col("id") % 33 == 0, "").otherwise(F.col("needform")))
    key = lambda df: df.select(F.col("id").cast("string").alias("id"), "iron", "needform")
    return dq.store_rules(key(i.where(F.col("id") % 40 != 1)), key(store), ["iron"], ["needform"], "part")


@query("""
SELECT 'E' AS level, 'ingredients' AS file, p_partkey::VARCHAR AS key, 'DQ8' AS rule, (4 * p_size + 4 * (p_partkey % 40))::DOUBLE::VARCHAR AS detail FROM part
WHERE 4 * p_size + 4 * (p_partkey % 40) > 1.12 * (p_partkey % 200) AND 4 * p_size + 4 * (p_partkey % 40) - p_partkey % 200 > 3 AND p_partkey % 200 > 0
UNION ALL SELECT 'W', 'ingredients', p_partkey::VARCHAR, 'DQ7', '' FROM part WHERE p_partkey % 6 = 0
UNION ALL SELECT 'E', 'ingredients', p_partkey::VARCHAR, 'DQ6', '' FROM part WHERE p_partkey % 9 = 0
UNION ALL SELECT 'W', 'ingredients', p_partkey::VARCHAR, 'DQ9', greatest(0, p_partkey % 200 - 4 * p_size - 4 * (p_partkey % 40))::DOUBLE::VARCHAR FROM part WHERE p_partkey % 200 > 60 AND 4 * p_size + 4 * (p_partkey % 40) < 0.25 * (p_partkey % 200)
UNION ALL SELECT 'E', 'ingredients', p_partkey::VARCHAR, 'DQ10', 'nobody' FROM part WHERE p_partkey % 25 = 0
UNION ALL SELECT 'W', 'ingredients', p_partkey::VARCHAR, 'DQ11', '' FROM part WHERE p_partkey % 21 = 0 AND p_partkey % 25 <> 0""")
def dq_ingredients(spark, d):
    """All rules on an ingredient file's cells."""
    k = F.col("p_partkey")
    cell = lambda c: c.cast("string")
    raw = analog.table(spark, d, "part").select(
        cell(k).alias("id"), cell(k % 200).alias("kcal"), cell(F.col("p_size")).alias("protein"), cell(k % 40).alias("carbs"), F.when(k % 9 == 0, " \t").otherwise("g").alias("unit"), F.when(k % 6 != 0, "base").alias("role"), F.when(k % 25 == 0, "nobody").otherwise("").alias("makes"), F.when(k % 21 == 0, "1").otherwise("0").alias("keep"), *(F.lit("0").alias(c) for c in FLAGS)
    )
    return dq.union(dq.ingredient_rules(raw, ["kcal", "protein", "carbs"]))


# ---- the fixed day ----------------------------------------------------------

#: The day's plates in servings.
DAY = {
    "breakfast": "egg:3 poha:0.5 onion:1 curd:0.5 lemon:0.5 gchilli:1",
    "lunch": "rice:0.5 dal:1 soya:1 spinach:1 tomato:1 onion:1 lemon:0.5 ghee:0.5",
    "snack": "curd:0.5 flax:0.5",
    "dinner": "atta:0.5 rajma:1 paneer:0.5 methi:1 tomato:1 onion:1 lemon:0.5 pumpkin:1",
}


def _day_items(spark) -> DataFrame:
    rows = spark.createDataFrame(list(DAY.items()), "meal string, items string")
    return rows.select("meal", F.explode(pairs(F.col("items"))).alias("ing_id", "qty"))


_DAY_SQL = "(VALUES " + ", ".join(f"('{m}', '{x.split(':')[0]}', {x.split(':')[1]}::DOUBLE)" for m, t in DAY.items() for x in t.split()) + ") i(meal, id, qty)"
_DAY_NAMES = sorted({x.split(":")[0] for t in DAY.values() for x in t.split()})
_DAY_PARTS = "(VALUES " + ", ".join(f"({n + 1}, '{x}')" for n, x in enumerate(_DAY_NAMES)) + ") m(k, id)"


@query(f"""
WITH t AS (SELECT i.meal, i.qty, p_retailprice / 10 AS kcal, CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_size / 4.0 END AS protein FROM {_DAY_SQL} JOIN {_DAY_PARTS} ON m.id = i.id JOIN part ON p_partkey = m.k),
s AS (SELECT meal, sum((kcal * qty)::DECIMAL(24,6))::DOUBLE AS kcal, sum((protein * qty)::DECIMAL(24,6))::DOUBLE AS protein FROM t GROUP BY 1),
b AS (SELECT * FROM (VALUES ('breakfast', 475.0, 30.0), ('lunch', 625.0, 32.0), ('snack', 100.0, 8.0), ('dinner', 575.0, 30.0)) v(meal, e, p)),
y AS (SELECT sum((kcal * qty)::DECIMAL(24,6))::DOUBLE AS kcal, sum((protein * qty)::DECIMAL(24,6))::DOUBLE AS protein FROM t),
r AS (SELECT meal AS scope, 'kcal' AS name, kcal AS got, e::DOUBLE AS wanted, CASE WHEN kcal > 1.15 * e THEN 'failed' ELSE 'ok' END AS status FROM s JOIN b USING (meal)
  UNION ALL SELECT meal, 'protein', protein, p::DOUBLE, CASE WHEN protein < 0.8 * p THEN 'warned' ELSE 'ok' END FROM s JOIN b USING (meal)
  UNION ALL SELECT 'day', 'kcal', kcal, 1775.0, CASE WHEN kcal > 1.05 * 1775 THEN 'OVER' ELSE 'ok' END FROM y
  UNION ALL SELECT 'day', 'p', protein, 100.0, CASE WHEN protein < 50 THEN 'failed' WHEN protein < 70 THEN 'LOW' WHEN protein > 200 THEN 'over' ELSE 'ok' END FROM y)
SELECT scope, name, round(got, 6) AS got, wanted, round(100 * got / wanted, 6) AS pct, status FROM r""")
def day_report(spark, d):
    """The fixed day's plates, with parts standing for its ingredients."""
    names = spark.createDataFrame([(i + 1, x) for i, x in enumerate(_DAY_NAMES)], "k long, id string")
    k = F.col("p_partkey")
    ing = analog.table(spark, d, "part").join(F.broadcast(names), k == F.col("k"))
    ing = ing.select("id", (F.col("p_retailprice") / 10).alias("kcal"), (F.col("p_size") / 4.0).alias("protein"), F.when(k % 11 == 0, "soak").alias("needform"), F.array(F.lit("p")).alias("gated"))
    targets = spark.createDataFrame([("kcal", 1775.0, False), ("p", 100.0, True)], "nkey string, daily double, permeal boolean")
    out = nutrition.day_report(_day_items(spark), ing, targets)
    return out.select("scope", "name", F.round("got", 6).alias("got"), "wanted", F.round("pct", 6).alias("pct"), "status")


@query("""
WITH i AS (SELECT o_orderdate::DATE AS date, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_quantity::INTEGER AS ing_id, l_quantity::DECIMAL(18,2) AS kcal, (l_partkey % 9)::DOUBLE AS fat FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
u AS (SELECT date, ing_id, sum(kcal) AS kcal, max(fat) AS fat FROM i GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS rank, sum(kcal) OVER (PARTITION BY date) - sum(kcal) OVER (w ROWS UNBOUNDED PRECEDING) AS rest FROM u WINDOW w AS (PARTITION BY date ORDER BY fat DESC, ing_id))
SELECT date, rank::INTEGER AS rank, ing_id AS cut, (rest + kcal)::DOUBLE AS kcal, rest::DOUBLE AS "left" FROM r WHERE rest + kcal > 400""")
def day_trim(spark, d):
    items = analog.items(spark, d).join(analog.plates(spark, d).select(F.col("id").alias("plate_id"), "date"), "plate_id")
    name = F.concat_ws("-", "plate_id", "line", "ing_id", F.col("qty").cast("int"))
    days = items.groupBy("date", name.alias("ing_id")).agg(F.sum(F.col("qty").cast("decimal(18,2)")).alias("kcal"), F.max((F.col("ing_id") % 9).cast("double")).alias("fat"))
    return menu.trim(days, 400.0).select("date", "rank", "cut", F.col("kcal").cast("double").alias("kcal"), F.col("left").cast("double").alias("left"))


@query("SELECT n_name AS fname, slot, round(n_nationkey * share, 6)::DOUBLE AS slot_target FROM nation, (VALUES ('breakfast', 0.3::DOUBLE), ('lunch', 0.3::DOUBLE), ('dinner', 0.3::DOUBLE), ('snack', 0.1::DOUBLE)) v(slot, share)")
def slot_targets(spark, d):
    t = analog.table(spark, d, "nation").select(F.col("n_name").alias("fname"), F.col("n_nationkey").cast("double").alias("daily"))
    return nutrition.slot_targets(t).select("fname", "slot", "slot_target")


@query("SELECT count(*) AS plates, (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey % 97 = 0) AS recipes, count(*) FILTER (o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0) AS kept FROM orders")
def import_local(spark, d):
    """Counts are of what came in; plates lacking date or meal are not kept."""
    k = F.col("id")
    p = analog.plates(spark, d)
    incoming = p.withColumn("date", F.when(k % 4 != 0, F.col("date"))).withColumn("meal", F.when(k % 6 != 0, F.col("meal")).otherwise(""))
    saved = analog.recipe_table(spark, d)
    new = saved.where(F.col("id").cast("long") % 97 == 0)
    state = {"plates": p.limit(0), "plate_items": analog.items(spark, d).select("plate_id", "ing_id", "qty").limit(0), "recipes": saved.drop("amounts", "src")}
    after, counts = plates.import_local(state, incoming, analog.items(spark, d), new, F.lit(1))
    return counts.crossJoin(after["plates"].agg(F.count(F.lit(1)).alias("kept")))


# The other modules of this folder register theirs in the same place.
from granary.plans import changes, rules  # noqa: E402

__all__ = ["QUERIES", "SQL", "changes", "rules"]
