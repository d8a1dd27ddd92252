"""Registered data-quality rules, prose operators and formulas, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import dq, menu, nutrition, plates
from granary.plans.registry import query
from granary.sources import analog


def _violations(rows: list[str]) -> str:
    """SQL of (level, file, key, rule, detail) rows: 'level~file~key~rule~detail~from'."""
    one = "SELECT '{}' AS level, '{}' AS file, ({})::VARCHAR AS key, '{}' AS rule, ({})::VARCHAR AS detail {}"
    return " UNION ALL ".join(one.format(*r.split("~")) for r in rows)


def _strings(*names: str):
    return F.array(*map(F.lit, names)).cast("array<string>")


@query(_violations([
    "E~ingredients~p_partkey~DQ15~'nope'~FROM part WHERE p_partkey % 6 = 2",
    "E~ingredients~p_partkey~DQ16~''~FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 6 NOT IN (0, 2)",
    "W~ingredients~p_partkey~DQ17~''~FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 6 = 3",
    "E~ingredients~p_partkey~DQ18~'zz'~FROM part WHERE p_partkey % 4 = 2",
    "E~forms~'f' || n_nationkey~DQ21~''~FROM nation WHERE n_nationkey % 5 = 4",
    "E~forms~'f' || n_nationkey~DQ22~''~FROM nation WHERE n_nationkey % 4 <> 1 AND n_nationkey % 5 <> 0",
    "E~forms~'f' || n_nationkey~DQ23~'phyt_red'~FROM nation WHERE n_nationkey % 4 IN (2, 3)",
    "E~forms~'f' || n_nationkey~DQ24~'zz'~FROM nation WHERE n_nationkey % 3 = 1",
]))
def dq_forms(spark, d):
    k, n = F.col("p_partkey"), F.col("n_nationkey")
    i = analog.table(spark, d, "part").select(
        k.cast("string").alias("id"), F.when(k % 6 == 0, "f1").when(k % 6 == 2, "nope").when(k % 6 == 3, "f2").otherwise("").alias("needform"), F.when(k % 4 == 0, _strings("fe")).when(k % 4 == 2, _strings("zz")).otherwise(_strings()).alias("gated"), (k % 13).cast("double").alias("iron")
    )
    mechanism = F.element_at(_strings("phytate", "heat", "matrix", "fat", "magic"), (n % 5 + 1).cast("int"))
    red = F.element_at(_strings("50", "", "101", "x"), (n % 4 + 1).cast("int"))
    gates = F.when(n % 3 == 0, _strings("fe")).when(n % 3 == 1, _strings("zz")).otherwise(_strings())
    forms = analog.table(spark, d, "nation").select(F.concat(F.lit("f"), n.cast("string")).alias("id"), mechanism.alias("mechanism"), red.alias("phyt_red"), gates.alias("gates"))
    return dq.union(dq.form_rules(i, forms))


@query(_violations([
    "E~phytate~'q' || p_partkey~DQ26~'q' || p_partkey~FROM part WHERE p_partkey % 10 = 0",
    "E~phytate~CASE WHEN p_partkey % 10 = 0 THEN 'q' ELSE '' END || p_partkey~DQ27~'phytate'~FROM part WHERE p_partkey % 7 = 0",
    "E~phytate~CASE WHEN p_partkey % 10 = 0 THEN 'q' ELSE '' END || p_partkey~DQ28~'phy_fe'~FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 2 = 1 AND p_partkey % 5 <> 0",
    "W~phytate~p_partkey~DQ29~'iron'~FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 4 = 0 AND p_partkey % 5 <> 0",
]))
def dq_phytate(spark, d):
    k = F.col("p_partkey")
    iron = (k % 5).cast("double")
    given = nutrition.molar_ratio(F.col("p_size").cast("double"), iron, nutrition.IRON) + k % 2
    phytate = F.when(k % 7 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    part = analog.table(spark, d, "part")
    rows = part.select(F.concat(F.when(k % 10 == 0, "q").otherwise(""), k.cast("string")).alias("id"), phytate.alias("phytate"), iron.cast("string").alias("iron"), F.lit("").alias("zinc"), given.cast("string").alias("phy_fe"), F.lit(None).cast("string").alias("phy_zn"))
    own = part.select(k.cast("string").alias("id"), (iron + F.when(k % 4 == 0, 10).otherwise(0)).alias("iron"), F.lit(0.0).alias("zinc"))
    return dq.union(dq.phytate_rules(rows, own))


@query(_violations(["E~retention~p_partkey~DQ31~'iron'~FROM part WHERE p_partkey % 4 IN (0, 2)", "E~retention~p_partkey~DQ31~'zinc'~FROM part WHERE p_partkey % 3 = 0"]))
def dq_retention(spark, d):
    k = F.col("p_partkey")
    cell = F.element_at(_strings("101", "", "x", "50"), (k % 4 + 1).cast("int"))
    rows = analog.table(spark, d, "part").select(k.cast("string").alias("class"), cell.alias("iron"), F.when(k % 3 == 0, "-0.5").otherwise(" 100 ").alias("zinc"))
    return dq.union(dq.retention_rules(rows, ["iron", "zinc"]))


@query(_violations(["W~targets~n_name~DQ12~''~FROM nation WHERE n_nationkey % 2 = 1", "E~targets~CASE WHEN n_nationkey % 2 = 0 THEN 'iron' ELSE n_name END~DQ13~''~FROM nation WHERE n_nationkey % 3 <> 0"]))
def dq_targets(spark, d):
    n = F.col("n_nationkey")
    rows = analog.table(spark, d, "nation").select(F.when(n % 2 == 0, "iron").otherwise(F.col("n_name")).alias("fname"), F.when(n % 3 == 0, "day").when(n % 3 == 1, "year").alias("cadence"))
    return dq.union(dq.target_rules(rows))


_EFFORT = "['x', '121', '10', '', '-1'][1 + l_orderkey % 5]"


@query("""
WITH r AS (SELECT l_orderkey, count(*) FILTER (l_linenumber <= 3) AS core FROM lineitem GROUP BY 1),
b AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS line FROM lineitem GROUP BY 1, 2 HAVING min(l_linenumber) <= 3 AND max(l_linenumber) > 3)
""" + _violations([
    "E~recipes~l_orderkey~DQ34~l_partkey~FROM lineitem WHERE l_partkey % 100 = 0",
    "E~recipes~l_orderkey~DQ35~''~FROM r WHERE core = 0",
    "E~recipes~l_orderkey~DQ36~'tea'~FROM r WHERE l_orderkey % 7 = 0",
    f"W~recipes~l_orderkey~DQ37~{_EFFORT}~FROM r WHERE l_orderkey % 5 IN (1, 4)",
    f"E~recipes~l_orderkey~DQ37~{_EFFORT}~FROM r WHERE l_orderkey % 5 = 0",
    "W~recipes~l_orderkey~DQ38~string_agg(l_partkey::VARCHAR, ' ' ORDER BY line, l_partkey)~FROM b GROUP BY l_orderkey",
]))
def dq_recipes(spark, d):
    k = F.col("id")
    ids = lambda c: F.transform(c, lambda x: x.cast("string")).alias(c)
    effort = F.element_at(_strings("x", "121", "10", "", "-1"), (k % 5 + 1).cast("int"))
    rows = analog.recipes(spark, d).select(k.cast("string").alias("id"), F.when(k % 7 == 0, _strings("lunch", "tea")).otherwise(_strings("lunch")).alias("meals"), ids("core"), ids("opt"), effort.alias("effort"))
    known = analog.ingredients(spark, d).where(k % 100 != 0).select(k.cast("string").alias("id"))
    return dq.union(dq.recipe_rules(rows, known))


@query("SELECT 'E' AS level, count(*) FILTER (p_size > 45) AS n FROM part HAVING n > 0 UNION ALL SELECT 'W', count(*) FILTER (p_size < 5) AS n FROM part HAVING n > 0")
def dq_summary(spark, d):
    i = analog.ingredients(spark, d)
    return dq.summary(dq.union([dq.violation(i, F.col("shelf") > 45, "E", "part", "r1"), dq.violation(i, F.col("shelf") < 5, "W", "part", "r2")]))


# ---- formulas ---------------------------------------------------------------


@query("""
WITH x AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, (p_partkey % 9)::DOUBLE AS b, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 100 END::DOUBLE AS r FROM part)
SELECT id, a * b AS grams, round((p.p_retailprice - 4 * a - 4 * b) / 9, 9) AS fat, CASE WHEN a > 15 THEN 'poor' WHEN a >= 5 THEN 'moderate' ELSE 'good' END AS zinc_class,
  round(a * (1 - r / 100), 9) AS after_form, round(a * coalesce(r, 100) / 100 * coalesce(r / 100, 1), 9) AS delivered, a - b AS ffm, round(a * 1.2, 9) AS tdee, round(a * 1.2 - b, 9) AS deficit FROM x JOIN part p ON p_partkey = id""")
def nutrition_numbers(spark, d):
    """Grams, fat, absorption class, form, retention and energy; blank is not 0."""
    k = F.col("id")
    a, b, r = F.col("shelf").cast("double"), (k % 9).cast("double"), F.when(k % 4 != 0, (k % 100).cast("double"))
    energy = nutrition.energy(a, b, a, F.lit(1.2), b)
    return analog.ingredients(spark, d).select(
        "id", nutrition.grams(a, b).alias("grams"), F.round(nutrition.atwater_fat(F.col("kcal"), a, b), 9).alias("fat"), nutrition.zinc_class(a).alias("zinc_class"), F.round(nutrition.after_form(a, r), 9).alias("after_form"),
        F.round(nutrition.delivered(a, r, r / 100), 9).alias("delivered"), energy["ffm"].alias("ffm"), F.round(energy["tdee"], 9).alias("tdee"), F.round(energy["deficit"], 9).alias("deficit"),
    )


@query("""
WITH s AS (SELECT l_orderkey AS id, (ARRAY['breakfast', 'lunch', 'snack', 'dinner', 'tea'])[1 + l_orderkey % 5] AS meal, sum(l_quantity) * 5 AS kcal, sum(l_quantity) / 4 AS protein FROM lineitem GROUP BY 1),
b AS (SELECT * FROM (VALUES ('breakfast', 475.0, 30.0), ('lunch', 625.0, 32.0), ('snack', 100.0, 8.0), ('dinner', 575.0, 30.0)) v(meal, e, p))
SELECT id, meal, kcal > 1.15::DOUBLE * e::DOUBLE AS failed, protein < 0.8::DOUBLE * p::DOUBLE AS warned FROM s JOIN b USING (meal)""")
def slot_budgets(spark, d):
    meals = _strings("breakfast", "lunch", "snack", "dinner", "tea")
    s = analog.items(spark, d).groupBy(F.col("plate_id").alias("id")).agg((F.sum("qty") * 5).alias("kcal"), (F.sum("qty") / 4).alias("protein"))
    return nutrition.slot_check(s.withColumn("meal", F.element_at(meals, (F.col("id") % 5 + 1).cast("int")))).select("id", "meal", "failed", "warned")


# ---- operators from prose ---------------------------------------------------


@query("SELECT l_orderkey AS id, count(DISTINCT l_partkey) FILTER (l_partkey % 3 = 0) AS score FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1")
def menu_affinity(spark, d):
    eaten = analog.ingredients(spark, d).where(F.col("id") % 3 == 0).select(F.col("id").alias("ing_id"))
    return menu.affinity(analog.recipes(spark, d), eaten)


@query("""
WITH m AS (SELECT o_custkey AS recipe_id, o_orderdate::DATE AS date, o_orderpriority AS meal FROM orders WHERE o_orderstatus = 'P'),
l AS (SELECT *, lag(date) OVER (PARTITION BY recipe_id ORDER BY date, meal) AS last FROM m) SELECT recipe_id, date, meal FROM l WHERE date - last < 3""")
def menu_repeats(spark, d):
    o = analog.table(spark, d, "orders").where("o_orderstatus = 'P'")
    return menu.repeats(o.select(F.col("o_custkey").alias("recipe_id"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("meal")))


def _day_items(spark, d) -> DataFrame:
    k = F.col("ing_id")
    p = plates.kept_plates(analog.plates(spark, d)).select(F.col("id").alias("plate_id"), "date", "meal")
    role = F.when(k % 4 == 0, "sour").when(k % 4 == 1, "seed").otherwise("veg")
    name = F.when(k % 10 == 0, "egg").when(k % 10 == 1, "flax").otherwise(k.cast("string"))
    meal = F.when(F.col("meal").startswith("1"), "lunch").otherwise("dinner")
    out = analog.items(spark, d).join(p, "plate_id")
    return out.select("date", meal.alias("meal"), role.alias("role"), "qty", (k % 2 == 0).alias("green"), (k % 3 == 0).alias("probiotic"), (k % 5 == 0).alias("legume"), (k % 13).cast("double").alias("iron"), name.alias("ing_id"))


_DAYS = """
i AS (SELECT o_orderdate::DATE AS date, CASE WHEN o_orderpriority LIKE '1%' THEN 'lunch' ELSE 'dinner' END AS meal, l_partkey AS k, l_quantity AS qty FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P')"""


@query(f"""
WITH {_DAYS}, g AS (SELECT date, meal, sum(k % 13 * qty)::DOUBLE AS iron, bool_or(k % 4 = 0) AS sour FROM i GROUP BY 1, 2) SELECT date, meal, iron, sour FROM g WHERE iron >= 5 AND NOT sour""")
def menu_sour_missing(spark, d):
    return menu.sour_missing(_day_items(spark, d))


@query(f"""
WITH {_DAYS}, g AS (SELECT date, coalesce(sum(qty) FILTER (k % 10 = 0), 0) AS eggs, bool_or(k % 5 = 0) AS legume, bool_or(k % 2 = 0 AND meal = 'lunch') AND bool_or(k % 2 = 0 AND meal = 'dinner') AS green, bool_or(k % 3 = 0) AS probiotic,
  bool_or(k % 10 = 1) AS flax, count(DISTINCT CASE WHEN k % 10 = 0 THEN 'egg' ELSE k::VARCHAR END) FILTER (k % 4 = 1 AND k % 10 <> 1) AS seeds FROM i GROUP BY 1)
SELECT date, concat_ws(' ', CASE WHEN eggs < 3 THEN 'eggs' END, CASE WHEN NOT legume THEN 'legume' END, CASE WHEN NOT green THEN 'green' END, CASE WHEN NOT probiotic THEN 'probiotic' END, CASE WHEN NOT flax OR seeds < 1 THEN 'seeds' END) AS broken FROM g""")
def menu_contract(spark, d):
    return menu.daily_contract(_day_items(spark, d)).select("date", F.array_join("broken", " ").alias("broken"))


@query("SELECT p_partkey AS id, CASE WHEN p_size < 30 AND p_partkey % 6 < 4 THEN 'egg' WHEN p_size < 30 THEN 'whey' END AS \"add\" FROM part")
def menu_protein(spark, d):
    days = analog.ingredients(spark, d).select("id", F.col("shelf").cast("double").alias("protein"), (F.col("id") % 6).alias("eggs"))
    return menu.protein_pass(days, 30.0).select("id", "add")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 OR p_size = 0 THEN 40 ELSE p_size END::INTEGER AS shown_effort FROM part WHERE CASE WHEN p_partkey % 7 = 0 OR p_size = 0 THEN 40 ELSE p_size END <= 40")
def menu_effort(spark, d):
    dishes = analog.ingredients(spark, d).select("id", F.when(F.col("id") % 7 != 0, F.col("shelf")).alias("effort"))
    return menu.within_effort(dishes, 40).select("id", "shown_effort")


@query("""
WITH o AS (SELECT DISTINCT l_orderkey AS slot, l_partkey AS ing_id, l_partkey AS pos, CASE l_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 9 END AS r FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY r, pos) AS rank FROM o) SELECT slot, ing_id, rank::INTEGER AS rank FROM n WHERE rank <= 3""")
def menu_optional(spark, d):
    k = F.col("ing_id")
    role = F.when(k % 4 == 0, "sour").when(k % 4 == 1, "green").when(k % 4 == 2, "seed").otherwise("veg")
    options = analog.items(spark, d).select(F.col("plate_id").alias("slot"), "ing_id").distinct().select("slot", "ing_id", role.alias("role"), k.alias("pos"))
    return menu.optional_cap(options).select("slot", "ing_id", "rank")


@query("""
WITH t AS (SELECT n_name AS nkey, n_regionkey::DOUBLE AS daily, n_nationkey % 2 = 0 AS permeal, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey / 10.0 END::DOUBLE AS total FROM nation WHERE n_regionkey > 0)
SELECT nkey, greatest(0, daily - coalesce(total, 0)) AS gap, permeal AND daily > coalesce(total, 0) AS blocks FROM t""")
def menu_gaps(spark, d):
    n = F.col("n_nationkey")
    nation = analog.table(spark, d, "nation")
    targets = nation.select(F.col("n_name").alias("nkey"), F.col("n_regionkey").cast("double").alias("daily"), (n % 2 == 0).alias("permeal"), n.alias("sort"))
    totals = nation.where(n % 3 != 0).select(F.col("n_name").alias("nkey"), (n / 10.0).alias("total"))
    return menu.gaps(targets, totals).select("nkey", "gap", "blocks")


@query("SELECT r_name || '_f' || n_nationkey AS variant_id, r_regionkey AS region FROM nation JOIN region ON r_regionkey = n_regionkey OR r_regionkey = (n_regionkey + 1) % 5")
def form_variants(spark, d):
    r = analog.table(spark, d, "region").select(F.col("r_name").alias("id"), F.col("r_regionkey").alias("region"))
    names = F.array(F.col("a.id"), F.col("b.id"))
    n = analog.table(spark, d, "nation")
    forms = n.join(r.alias("a"), F.col("a.region") == F.col("n_regionkey")).join(r.alias("b"), F.col("b.region") == (F.col("n_regionkey") + 1) % 5)
    return menu.form_variants(forms.select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("id"), names.alias("applies")), r).select("variant_id", "region")


@query("SELECT p_partkey + 1 AS ing_id, 1.0::DOUBLE AS delta FROM part WHERE p_partkey % 10 = 0")
def prep_done(spark, d):
    i = analog.ingredient_table(spark, d).where("keep")
    return menu.prep_done(i, F.lit("2001-01-01")).select(F.col("ing_id").cast("long").alias("ing_id"), "delta")
