"""Operators on small frames: semantic traps, decisions and rules."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import parsing
from granary.operators import availability, demand, dq, ledger, menu, merge, nutrition, plates, projections, reference_layer
from granary.sources import files, schema

D = dt.date


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).head().x


@pytest.mark.parametrize("text,value", [("", 0.0), (None, 0.0), ("5d", 0.0), ("1_000", 1000.0), (" 2.5 ", 2.5), ("-3", -3.0), ("1e3", 1000.0), ("nan", 0.0), (".5", 0.5)])
def test_num(spark, text, value):
    assert one(spark, parsing.num(F.col("a")), a=text) == value


def test_tokens_and_pairs(spark):
    assert one(spark, parsing.tokens(F.col("a")), a="  x  y ") == ["x", "y"]
    assert one(spark, parsing.tokens(F.col("a")), a="") == []
    assert one(spark, parsing.pairs(F.col("a")), a="a:1 junk a:2 b:3:9") == {"a": 2.0, "b": 3.0}
    assert one(spark, parsing.pairs(F.col("a")), a=None) == {}


def test_rounding_rules(spark):
    assert one(spark, parsing.half_up(F.lit(-2.5), 0), a="") == -2.0
    assert one(spark, parsing.trimmed(F.lit(2.50), 2), a="") == "2.5"
    assert one(spark, parsing.trimmed(F.lit(100.0), 0), a="") == "100"


def test_commented_csv(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('# head\nid,name\na,"x, y"\n   # indented\n\nb,z\n')
    got = [tuple(r) for r in files.read_commented_csv(spark, str(p)).collect()]
    assert got == [("a", "x, y"), ("b", "z")]
    assert files.read_commented_csv(spark, str(tmp_path / "none.csv")).count() == 0
    wide = files.ragged(spark.createDataFrame([('a,"x, y"',), ("b",), ("c,d,e",)], "value string"), 2)
    assert [r.wrong_width for r in wide.collect()] == [False, True, True]


def test_export_and_json(spark):
    df = spark.createDataFrame([("a", 2.50, ["x", "y"], True, {"k": 1.0})], "id string, v double, l array<string>, f boolean, m map<string,double>")
    assert tuple(files.export_text(df, {"v": 2}).head()) == ("a", "2.5", "x y", "1", "k:1.0")
    body = files.to_json(df.select("id", "v"))
    assert tuple(files.read_json_body(body, "json", "id string, v double").head()) == ("a", 2.5)


def test_missing_columns(spark):
    df = schema.with_missing_columns(spark.createDataFrame([("a",)], "recipe_id string"), schema.PINS, {"perweek": 1.0})
    assert df.head().perweek == 1.0 and schema.schema("stock").fieldNames()[0] == "ing_id"


# ---- ledger -----------------------------------------------------------------


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-500, 500), st.booleans()), min_size=1, max_size=60))
def test_floored_stock_is_the_fold(spark, log):
    rows = [(k, i, v / 100, s) for i, (k, v, s) in enumerate(log)]
    df = spark.createDataFrame(rows, "item int, t int, delta double, is_set boolean")
    got = {r.t: r.qty for r in ledger.history(df, "item", ["t"], F.col("delta"), F.col("is_set")).collect()}
    held = {}
    for k, t, v, s in rows:
        held[k] = max(0.0, v if s else held.get(k, 0.0) + v)
        assert abs(got[t] - held[k]) < 1e-9


def test_purchase_clock(spark):
    df = spark.createDataFrame([("a", 1, -1.0), ("a", 2, 2.0), ("b", 3, -1.0)], "item string, ts int, d double")
    assert dict(map(tuple, ledger.purchase_clock(df, "item", ["ts"], "ts", F.col("d")).collect())) == {"a": 2, "b": None}
    assert dict(map(tuple, ledger.purchase_clock(df, "item", ["ts"], "ts", F.col("d"), strict=True).collect())) == {"a": 2, "b": 3}


def test_stream_state(spark, tmp_path):
    from granary.streaming.stock_stream import floored_stock

    random.seed(1)
    rows = [(random.randint(0, 3), i, i, float(random.randint(-5, 5)), False) for i in range(40)]
    df = spark.createDataFrame(rows, "item long, ts long, event_id long, delta double, is_set boolean")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = floored_stock(stream).writeStream.outputMode("update").format("memory").queryName("stock").start()
    q.processAllAvailable()
    q.stop()
    held = {}
    for k, _, _, v, _ in rows:
        held[k] = max(0.0, held.get(k, 0.0) + v)
    assert {r.item: r.qty for r in spark.sql("select * from stock").collect()} == held


# ---- demand and availability ------------------------------------------------


def test_rate_counts_days_of_plates_without_items(spark):
    p = spark.createDataFrame([(1, D(2024, 1, 1), False), (2, D(2024, 1, 2), False), (3, D(2024, 1, 2), True), (4, D(2023, 1, 1), False)], "id int, date date, planned boolean")
    i = spark.createDataFrame([(1, "egg", 4.0), (3, "egg", 9.0), (4, "egg", 50.0)], "plate_id int, ing_id string, qty double")
    got = demand.observed_rate(p, i, demand.latest(p)).collect()
    assert [tuple(r) for r in got] == [("egg", 2.0)]


def buy(spark, pin, rate, menu_rows=(), shelf=0, qty=0.0, pack=0.0):
    ing = spark.createDataFrame([("a", "A", shelf, pack, 1)], "id string, name string, shelf int, pack double, sort int")
    t = lambda rows, c: spark.createDataFrame(rows, f"ing_id string, {c} double")
    return demand.buy_list(ing, t([("a", qty)], "qty"), t([("a", rate)], "rate"), t([("a", pin)], "pin"), t(list(menu_rows), "menu"), 30).collect()


def test_buy_list_driver_and_caps(spark):
    assert buy(spark, 1.0, 1.0)[0].driver == "eaten"
    assert buy(spark, 1.1, 1.0)[0].driver == "pinned"
    assert buy(spark, 1.0, 1.0, [("b", 2.0)]) == []  # a menu of other items stops the demand
    r = buy(spark, 0.0, 1.0, shelf=3)[0]
    assert (r.cap_days, r.capped, r.packs, r.run) == (3, True, 3, "fresh")
    assert buy(spark, 0.0, 1.0)[0].cap_days == 30  # shelf 0 is unknown
    assert buy(spark, 0.0, 0.05 / 30) == []  # need of exactly 0.05


@pytest.fixture(scope="module")
def status(spark):
    r = spark.createDataFrame([("d1", ["a", "b"], []), ("d2", ["a", "x"], []), ("d3", [], []), ("d4", ["a", "x", "x"], []), ("d5", ["x"], [])], "id string, core array<string>, opt array<string>")
    i = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "id string, default double")
    s = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 0.5)], "ing_id string, qty double")
    return availability.core_status(r, i, s).cache()


def test_division(status):
    assert [r.id for r in availability.makeable(status).collect()] == ["d1"]
    assert {r.id: r.missing for r in availability.near_misses(status).collect()} == {"d2": ["x"], "d4": ["x", "x"]}
    assert [r.id for r in availability.ranked_near_misses(availability.near_misses(status)).collect()] == ["d2", "d4"]
    assert [(r.ing_id, r.recipe_id, r["rank"]) for r in availability.unlocks(availability.near_misses(status)).collect()] == [("x", "d2", 1), ("x", "d4", 2)]


# ---- merges and plates ------------------------------------------------------


def test_recipe_merge_guards(spark):
    cols = "id string, name string, effort int, effort_src string, is_user boolean"
    state = spark.createDataFrame([("u", "mine", 5, "", True), ("t", "timed", 7, "user", False), ("s", "seed", 9, "", False)], cols)
    seed = spark.createDataFrame([("u", "x", 1), ("t", "y", 1), ("s", "z", 1), ("n", "w", 1)], "id string, name string, effort int")
    got = {r.id: (r.name, r.effort, r.is_user) for r in merge.merge_recipes(state, seed).collect()}
    assert got == {"u": ("mine", 5, True), "t": ("y", 7, False), "s": ("z", 1, False), "n": ("w", 1, False)}
    saved = merge.save_recipe(state, spark.createDataFrame([("s", "own")], "id string, name string"))
    assert {r.id: r.is_user for r in saved.collect()}["s"]
    assert {r.id for r in merge.delete_recipe(state, "s").collect()} == {"u", "t", "s"}
    new, bad = merge.record_effort(state, spark.createDataFrame([("s", 20), ("t", 601), ("zz", 5)], "id string, effort int"))
    assert {r.id: r.effort for r in new.collect()} == {"u": 5, "t": 7, "s": 20} and [r.id for r in bad.collect()] == ["t"]


def plate_state(spark):
    return {
        "plates": spark.createDataFrame([("p", D(2024, 1, 1), "lunch", True), ("e", D(2024, 1, 2), "lunch", False)], "id string, date date, meal string, planned boolean"),
        "plate_items": spark.createDataFrame([("p", "egg", 3.0), ("e", "egg", 2.0)], "plate_id string, ing_id string, qty double"),
        "stock": spark.createDataFrame([("egg", 1.0, None, None, False)], schema.schema("stock")),
    }


def stock_of(state):
    return {r.ing_id: r.qty for r in state["stock"].collect()}


def test_plates(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    s = plates.cook_slot(plate_state(spark), "p", now)
    assert stock_of(s) == {"egg": 0.0}
    with pytest.raises(ValueError):
        plates.cook_slot(s, "p", now)
    assert stock_of(plates.delete_plates(s, spark.createDataFrame([("p",)], "id string"), now)) == {"egg": 3.0}  # floored, then undone
    s = plate_state(spark)
    new = spark.createDataFrame([("p", D(2024, 1, 1), "lunch", False)], "id string, date date, meal string, planned boolean")
    items = spark.createDataFrame([("p", "egg", None)], "plate_id string, ing_id string, qty double")
    assert stock_of(plates.save_plate(s, new, items, now)) == {"egg": 0.0}
    assert stock_of(plates.save_plate(s, new, items, now, strict=True)) == {"egg": 3.0}
    nested = plates.with_items(s["plates"].unionByName(new.withColumn("id", F.lit("q"))), s["plate_items"].withColumn("line", F.lit(1)))
    assert {r.id: len(r["items"]) for r in nested.collect()} == {"p": 1, "e": 1, "q": 0}
    batch = new.withColumn("id", F.lit("n"))
    assert {r.id for r in plates.save_menu(s["plates"], batch).collect()} == {"e", "n"}
    assert {r.id for r in plates.save_menu(s["plates"], batch.limit(0)).collect()} == {"p", "e"}
    bad = spark.createDataFrame([("x", None, "lunch", False), ("y", D(2024, 1, 1), "", False), ("z", D(2024, 1, 1), "lunch", False)], "id string, date date, meal string, planned boolean")
    assert {r.id for r in plates.import_plates(s["plates"], bad).collect()} == {"p", "e", "z"}


def test_stock_setters(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    s = plate_state(spark)["stock"]
    got = merge.set_stock(s, spark.createDataFrame([("egg", -1.0, None), ("new", 2.0, None)], "ing_id string, qty double, bought_at timestamp"), now)
    assert {r.ing_id: r.qty for r in got.collect()} == {"egg": 0.0, "new": 2.0}
    assert {r.ing_id: r.useup for r in merge.set_useup(s, spark.createDataFrame([("z", True)], "ing_id string, useup boolean")).collect()} == {"egg": False, "z": True}
    pins = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "recipe_id string, perweek double")
    assert [r.recipe_id for r in merge.set_pins(pins, spark.createDataFrame([("a", 0.0)], "recipe_id string, perweek double")).collect()] == ["b"]


# ---- nutrition and composition ----------------------------------------------


def test_gate_by_long_and_short_key(spark):
    i = spark.createDataFrame([("a", 10.0, "soak", ["fe"]), ("b", 10.0, "soak", ["iron"]), ("c", 10.0, "", ["iron"]), ("d", 10.0, None, None)], "id string, iron double, needform string, gated array<string>")
    assert [r.x for r in i.select(nutrition.gated("iron").alias("x")).collect()] == [0.0, 0.0, 10.0, 10.0]


def test_day_checks(spark):
    slots = spark.createDataFrame([("breakfast", 419.0, 26.85), ("lunch", 433.5, 27.55), ("snack", 104.5, 5.35), ("dinner", 490.5, 27.25)], "meal string, kcal double, protein double")
    got = {r.meal: (r.failed, r.warned) for r in nutrition.slot_check(slots).collect()}
    assert got == {"breakfast": (False, False), "lunch": (False, False), "snack": (False, True), "dinner": (False, False)}


def test_blank_is_not_zero(spark):
    df = spark.createDataFrame([(1.0, None)], "p double, r double")
    r = df.select(nutrition.after_form(F.col("p"), F.col("r")).alias("a"), nutrition.delivered(F.col("p"), F.col("r"), F.col("r")).alias("b"), nutrition.molar_ratio(F.col("p"), F.lit(0.0), 55.85).alias("c")).head()
    assert tuple(r) == (None, 1.0, None)
    assert df.select(nutrition.iron_class(F.lit(0.7)).alias("x")).head().x is None


def test_composition(spark):
    i = spark.createDataFrame([("a", "1", 50.0, 9.0), ("b", "", 50.0, 0.0), ("c", "9", 50.0, 0.0), ("o", "2", 10.0, 0.0)], "id string, ifct_code string, grams double, kcal double")
    comp = {c: 0.0 for c, _ in reference_layer.COMPONENTS.values()} | {"enerc": 0.0, "fatce": 0.0, "retol": 0.0, "cartbeq": 0.0}
    rows = [("1", *(comp | {"enerc": 418.4}).values()), ("2", *(comp | {"fatce": 100.0}).values())]
    c = spark.createDataFrame(rows, ["code", *comp])
    got = reference_layer.derive(i, c, ["kcal"])
    assert {r.id: (r.source, r.new_kcal and round(r.new_kcal, 9)) for r in got.collect()} == {"a": ("MATCHED", 50.0), "b": ("UNSOURCED", None), "c": ("MISSING CODE", None), "o": ("MATCHED", 90.0)}
    assert {r.id for r in reference_layer.drift(got).collect()} == {"a", "o"}
    assert {r.id: r.kcal for r in reference_layer.write_back(i, got).collect()}["a"] == pytest.approx(50)


def test_rolling_skips_missing_dates(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 7), 2.0), (D(2024, 1, 8), 4.0)], "date date, v double")
    assert [r.v_7d for r in nutrition.rolling(df, "date", "v").orderBy("date").collect()] == [1.0, 3.0, 6.0]


# ---- data quality -----------------------------------------------------------


def test_ingredient_rules(spark):
    cols = ["id", "unit", "role", "kcal", "protein", "carbs", "makes", "keep", *schema.FLAGS]
    base = dict(id="ok", unit="g", role="veg", kcal="100", protein="5", carbs="15", makes="", keep="", **{f: "0" for f in schema.FLAGS})
    rows = [base, base | {"id": "dup"}, base | {"id": "dup"}, base | {"id": "neg", "kcal": "-1"}, base | {"id": "txt", "kcal": "5d"}, base | {"id": "flag", "green": "2"}, base | {"id": "unit", "unit": ""}, base | {"id": "role", "role": None},
            base | {"id": "imp", "protein": "30", "carbs": "30"}, base | {"id": "low", "protein": "1", "carbs": "1"}, base | {"id": "make", "makes": "nope"}, base | {"id": "keep", "keep": "1"}]
    raw = spark.createDataFrame([[r[c] for c in cols] for r in rows], ", ".join(f"{c} string" for c in cols))
    got = {(r.rule, r.key) for r in dq.union(dq.ingredient_rules(raw, ["kcal", "protein", "carbs"])).collect()}
    assert got == {("DQ2", "dup"), ("DQ3", "neg"), ("DQ4", "txt"), ("DQ5", "flag"), ("DQ6", "unit"), ("DQ7", "role"), ("DQ8", "imp"), ("DQ9", "low"), ("DQ10", "make"), ("DQ11", "keep")}


def test_form_phytate_retention_recipe_rules(spark):
    ing = spark.createDataFrame([("a", "soak", ["fe"], 1.0, 1.0), ("b", "nope", ["zz"], 0.0, 0.0), ("c", "", ["iron"], 5.0, 0.0), ("d", "soak", [], 0.0, 0.0)], "id string, needform string, gated array<string>, iron double, zinc double")
    forms = spark.createDataFrame([("soak", "phytate", "50", ["fe"]), ("cook", "magic", "10", []), ("cut", "heat", "101", ["zz"])], "id string, mechanism string, phyt_red string, gates array<string>")
    got = {(r.rule, r.key) for r in dq.union(dq.form_rules(ing, forms)).collect()}
    assert got == {("DQ15", "b"), ("DQ16", "c"), ("DQ17", "d"), ("DQ18", "b"), ("DQ19", "a"), ("DQ19", "c"), ("DQ21", "cook"), ("DQ22", "cook"), ("DQ22", "cut"), ("DQ23", "cut"), ("DQ24", "cut")}
    phy = spark.createDataFrame([("a", 660.04, 55.85, 65.38, 1.0, 2.0), ("q", 1.0, 1.0, 1.0, None, None)], "id string, phytate double, iron double, zinc double, phy_fe double, phy_zn double")
    assert {(r.rule, r.key, r.detail) for r in dq.union(dq.phytate_rules(phy, ing)).collect()} == {("DQ26", "q", "q"), ("DQ28", "a", "phy_zn"), ("DQ29", "a", "iron"), ("DQ29", "a", "zinc")}
    ret = spark.createDataFrame([("x", "101", ""), ("y", "", "q")], "class string, iron string, zinc string")
    assert {(r.key, r.detail) for r in dq.union(dq.retention_rules(ret, ["iron", "zinc"])).collect()} == {("x", "iron"), ("y", "zinc")}
    rec = spark.createDataFrame([("r1", ["lunch"], ["a"], ["a"], "10"), ("r2", ["tea"], [], ["q"], "121"), ("r3", [], ["a"], [], "x"), ("r3", [], ["a"], [], "")], "id string, meals array<string>, core array<string>, opt array<string>, effort string")
    assert {(r.rule, r.key, r.level) for r in dq.union(dq.recipe_rules(rec, ing)).collect()} == {("DQ38", "r1", "W"), ("DQ35", "r2", "E"), ("DQ36", "r2", "E"), ("DQ34", "r2", "E"), ("DQ37", "r2", "W"), ("DQ37", "r3", "E"), ("DQ33", "r3", "E")}
    t = spark.createDataFrame([("iron", "day"), ("x", "year")], "fname string, cadence string")
    assert {(r.rule, r.key) for r in dq.union(dq.target_rules(t)).collect()} == {("DQ12", "x"), ("DQ13", "x")}


# ---- menu (from prose) ------------------------------------------------------


def test_menu(spark):
    import pandas as pd

    m = spark.createDataFrame([("d", D(2024, 1, 1), "lunch"), ("d", D(2024, 1, 3), "lunch"), ("d", D(2024, 1, 9), "lunch")], "recipe_id string, date date, meal string")
    assert [r.date for r in menu.repeats(m).collect()] == [D(2024, 1, 3)]
    gaps = spark.createDataFrame([(D(2024, 1, 1), "fe", 3.0, 1), (D(2024, 1, 1), "zn", 1.0, 2)], "date date, nkey string, gap double, sort int")
    toppers = pd.DataFrame({"id": ["t1", "t2", "t3"], "fe": [2.0, 1.5, 0.0], "zn": [0.0, 1.0, 1.0]})
    assert [(r.ing_id, r.nkey) for r in menu.repair(gaps, toppers).collect()] == [("t1", "fe"), ("t2", "fe")]
    o = spark.createDataFrame([("s", "a", "seed", 1), ("s", "b", "sour", 2), ("s", "c", "green", 3), ("s", "d", "veg", 4)], "slot string, ing_id string, role string, pos int")
    assert [r.ing_id for r in menu.optional_cap(o).orderBy("rank").collect()] == ["b", "c", "a"]
    t = spark.createDataFrame([("fe", 10.0, True, 2), ("zn", 5.0, False, 1)], "nkey string, daily double, permeal boolean, sort int")
    tot = spark.createDataFrame([("zn", 1.0)], "nkey string, total double")
    assert [(r.nkey, r.gap, r.blocks) for r in menu.gaps(t, tot).collect()] == [("zn", 4.0, False), ("fe", 10.0, True)]
    d = spark.createDataFrame([("x", 0), ("y", 10), ("z", 50)], "id string, effort int")
    assert [r.id for r in menu.within_effort(d, 40).collect()] == ["y", "x"]


# ---- rounding, files and projections ----------------------------------------


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(-4000, 4000).map(lambda i: i / 8), st.integers(-9999, 9999).map(lambda i: i / 1000)), min_size=1, max_size=40), st.sampled_from([0, 1, 2, 4]))
def test_half_even_is_the_exact_rounding(spark, values, places):
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", parsing.half_even(F.col("v"), places).alias("x")).collect()
    assert [(r.v, r.x) for r in got] == [(v, float(round(v, places))) for v in values]


def test_export_rounds_as_the_server_does(spark):
    cells = [(0.25, 1, "0.2"), (0.75, 1, "0.8"), (2.675, 2, "2.67"), (0.5, 0, "0"), (1.5, 0, "2"), (2.5, 0, "2"), (-0.2, 0, "0"), (10.0, 1, "10"), (0.05, 4, "0.05"), (12345678.9, 0, "12345679")]
    for v, places, text in cells:
        assert one(spark, parsing.trimmed(F.lit(v), places), a="") == text
    assert one(spark, parsing.trimmed(F.lit(None).cast("double"), 1), a="") is None


def test_tabs_are_whitespace(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("\t# head\nid,name\n\t \na,1\n\t#mid\nb\nc,3,9\n# end\n")
    got = [tuple(r) for r in files.read_commented_csv(spark, str(p), ordinal="sort").orderBy("sort").collect()]
    assert got == [("a", "1", 0), ("b", None, 1), ("c", "3", 2)]
    assert [r.value for r in files.comment_lines(spark.read.text(str(p))).collect()] == ["\t# head", "\t#mid", "# end"]
    (tmp_path / "none").write_text("# only\n")
    assert files.read_commented_csv(spark, str(tmp_path / "none"), ["id"], "sort").columns == ["id", "sort"]
    assert one(spark, parsing.num(F.col("a")), a="\t2.5\n") == 2.5


def test_exports_keep_order_and_comments(spark):
    rec = spark.createDataFrame([("b", "B", ["lunch"], ["x", "y"], [], None, "", None, False), ("a", 'A "q", z', [], [], ["x"], "m", "thai", 5, True), ("c", "C", [], [], [], "", "", 0, False)], "id string, name string, meals array<string>, core array<string>, opt array<string>, method string, cuisine string, effort int, is_user boolean")
    assert [r.line for r in files.recipe_lines(rec, ["# one", "# two"]).collect()] == ["# one", "# two", "id,name,meals,core,opt,method,cuisine,effort", "b,B,lunch,x y,,,,", "c,C,,,,,,0", 'a,"A ""q"", z",,,x,m,thai,5']
    ing = spark.createDataFrame([("b", 2, 0.25, 2.5), ("a", 1, None, 1.23456), ("c", 1, 1.0, 0.0)], "id string, sort int, protein double, default_qty double")
    assert [r.line for r in files.ingredient_lines(ing, ["id", "default", "protein"]).collect()] == ["id,default,protein", "a,1.2346,", "c,0,1", "b,2.5,0.2"]


def full_ingredient(spark, **cells):
    row = {c: None for c in schema.INGREDIENTS} | {"id": "i", "name": "I", "sort": 1} | cells
    return spark.createDataFrame([tuple(row[c] for c in schema.INGREDIENTS)], schema.schema("ingredients"))


def test_projection_defaults(spark):
    blank = projections.ingredients(full_ingredient(spark, default_qty=0.0, shelf=0, pack=0.0)).head()
    assert (blank.default, blank.shelf, blank.pack, blank.lead, blank.note, blank.gated, blank.pantry, blank.keep) == (0.0, 30, 1.0, 0.0, "", [], False, False)
    assert projections.ingredients(full_ingredient(spark, default_qty=0.0), client=True).head().default == 1.0
    two = full_ingredient(spark, id="z", sort=0).unionByName(full_ingredient(spark, id="b")).unionByName(full_ingredient(spark, id="a"))
    assert [r.id for r in projections.ingredients(two).collect()] == ["z", "a", "b"]
    rec = spark.createDataFrame([("u", "U", "lunch  dinner", None, "", None, None, None, "a:1 junk b:2:3", None, True), ("s", "S", "", "x", "", "", "", 4, None, "src", False)], "id string, name string, meals string, core string, opt string, method string, cuisine string, effort int, amounts string, src string, is_user boolean")
    got = projections.recipes(rec).collect()
    assert [r.id for r in got] == ["s", "u"] and got[1].amounts == {"a": 1.0, "b": 2.0} and got[1].meals == ["lunch", "dinner"] and (got[1].effort, got[1].cuisine, got[0].amounts) == (0, "", {})
    t = spark.createDataFrame([("b", "k", "B", "g", "day", 1.0, 0.0, None, 1), ("a", "k", "A", "g", "day", 1.0, 0.0, True, 1)], "fname string, nkey string, name string, unit string, cadence string, daily double, meal double, permeal boolean, sort int")
    assert [(r.fname, r.permeal) for r in projections.dataset({"ingredients": two, "targets": t, "recipes": rec})["targets"].collect()] == [("a", True), ("b", False)]
    s = spark.createDataFrame([("a", 1.0, "", "u", None), ("b", 1.0, "w", "u", True), ("c", 1.0, None, None, None)], "ing_id string, qty double, bought_at string, updated_at string, useup boolean")
    assert [(r.bought, r.useup) for r in projections.stock(s).orderBy("ing_id").collect()] == [("u", False), ("w", True), ("", False)]


def test_imports(spark):
    state = full_ingredient(spark, id="old", default_qty=9.0).unionByName(full_ingredient(spark, id="a", default_qty=9.0, note="n"))
    raw = spark.createDataFrame([("a", "A", "x", "1", "kg", "5.9", 0), ("a", "A2", "", "", None, "z", 1)], "id string, name string, default string, pantry string, unit string, shelf string, sort int")
    got = {r.id: r for r in merge.import_ingredients(state, raw).collect()}
    assert set(got) == {"old", "a"} and got["old"].default_qty == 9.0
    assert (got["a"].name, got["a"].default_qty, got["a"].pantry, got["a"].shelf, got["a"].note, got["a"].pack, got["a"].sort) == ("A2", 1.0, False, 30, "", 1.0, 1)
    users = spark.createDataFrame([(None, "", [" x ", ""], None, ["y"], "", None, "7.9")], "id string, name string, meals array<string>, core array<string>, opt array<string>, method string, cuisine string, effort string")
    assert tuple(merge.user_recipes(users, F.lit(12)).head()) == ("u12", "Recipe", ["x"], [], ["y"], "Your saved recipe", "", 7)
    p = spark.createDataFrame([("", True), (None, False), ("k", False)], "id string, planned boolean")
    assert [r.id for r in plates.with_id(p, F.lit(5)).collect()] == ["m5", "p5", "k"]


def test_repeated_changes_are_an_error(spark):
    state = spark.createDataFrame([("egg", 1.0)], "id string, qty double")
    twice = spark.createDataFrame([("egg", 2.0), ("egg", 3.0)], "id string, qty double")
    with pytest.raises(Exception, match="more than one change for key egg"):
        merge.merge(state, twice, "id").collect()
    nulls = spark.createDataFrame([(None, 2.0), (None, 3.0)], "id string, qty double")
    assert merge.merge(state, nulls, "id").count() == 3


# ---- scale: ranges ----------------------------------------------------------


def test_kitchen_rank_of_many_rows_and_ties(spark, tmp_path):
    """Above what one sample sees, read from the written result."""
    n = 60_000
    stock = spark.range(n).select(F.col("id"), F.when(F.col("id") % 10 == 0, None).otherwise((F.col("id") * 7919 % 5).cast("double")).alias("qty"))
    availability.kitchen_rank(stock, F.col("qty"), F.col("id")).write.parquet(str(tmp_path / "r"))
    got = spark.read.parquet(str(tmp_path / "r")).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, n + 1))
    assert [r.id for r in got] == [r.id for r in sorted(got, key=lambda r: (r.qty is None, -(r.qty or 0), r.id))]


def test_ledger_of_one_hot_item(spark):
    """One item's events in many chunks, with sets here and there."""
    random.seed(4)
    rows = [("hot" if i % 9 else None, i // 2, i, random.randint(-900, 800) / 100, random.random() < 0.004) for i in range(4000)]
    df = spark.createDataFrame(rows, "item string, t int, e int, delta double, is_set boolean").repartition(5)
    got = {r.e: r.qty for r in ledger.history(df, "item", ["t", "e"], F.col("delta"), F.col("is_set"), chunks=16).collect()}
    held = {}
    for k, _, e, v, s in rows:
        held[k] = max(0.0, v if s else held.get(k, 0.0) + v)
        assert abs(got[e] - held[k]) < 1e-6
    last = {r.item: r.qty for r in ledger.state(df, "item", ["t", "e"], F.col("delta"), F.col("is_set"), chunks=16).collect()}
    assert last == {k: pytest.approx(v) for k, v in held.items()}


def test_trailing_window_is_a_literal_filter(spark):
    p = spark.createDataFrame([(1, D(2024, 1, 1), False)], "id int, date date, planned boolean")
    plan = demand.trailing(p, D(2024, 1, 14), 14)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "2024-01-01" in plan and "2024-01-14" in plan
    assert demand.trailing(p, None, 14).count() == 0 and demand.latest(p.limit(0)) is None


# ---- rules and prose operators without a query ------------------------------


def test_numbers_of_nutrition(spark):
    x = lambda c: spark.range(1).select(c.alias("x")).head().x
    assert x(nutrition.grams(F.lit(0.5), F.lit(80.0))) == 40.0
    assert x(nutrition.atwater_fat(F.lit(100.0), F.lit(5.0), F.lit(10.0))) == pytest.approx(40 / 9)
    assert [x(nutrition.zinc_class(F.lit(v))) for v in (16.0, 15.0, 5.0, 4.9)] == ["poor", "moderate", "moderate", "good"]
    e = nutrition.energy(F.lit(80.0), F.lit(20.0), F.lit(1500.0), F.lit(1.2), F.lit(1700.0))
    assert {k: x(v) for k, v in e.items()} == {"ffm": 60.0, "tdee": 1800.0, "deficit": 100.0}
    t = spark.createDataFrame([("p", 100.0)], "nkey string, daily double")
    assert nutrition.meal_targets(t).head().meal == 30.0
    assert {r.slot: r.slot_target for r in nutrition.slot_targets(t).collect()} == {"breakfast": 30.0, "lunch": 30.0, "dinner": 30.0, "snack": 10.0}


def test_fixed_day_report(spark):
    """Energy and protein of the four slots as in the fixed-day fixture."""
    energy = {"breakfast": (419.0, 26.85), "lunch": (433.5, 27.55), "snack": (104.5, 5.35), "dinner": (490.5, 27.25)}
    ing = spark.createDataFrame([(k, v[0], v[1], "", []) for k, v in energy.items()] + [("til", 0.0, 500.0, "soak", ["protein"])], "id string, kcal double, protein double, needform string, gated array<string>")
    items = spark.createDataFrame([(k, k, 1.0) for k in energy] + [("lunch", "til", 1.0)], "meal string, ing_id string, qty double")
    targets = spark.createDataFrame([("kcal", 1775.0, False), ("p", 200.0, True)], "nkey string, daily double, permeal boolean")
    got = {(r.scope, r.name): (round(r.got, 2), r.status) for r in nutrition.day_report(items, ing, targets).collect()}
    assert {k: v[1] for k, v in got.items() if v[1] != "ok"} == {("snack", "protein"): "warned", ("day", "p"): "failed"}
    assert got["day", "kcal"][0] == 1447.5 and got["day", "p"][0] == 87.0


def test_prose_operators(spark):
    r = spark.createDataFrame([("a", ["x", "x", "y"]), ("b", ["z"])], "id string, core array<string>")
    assert {x.id: x.score for x in menu.affinity(r, spark.createDataFrame([("x",), ("x",)], "ing_id string")).collect()} == {"a": 1, "b": 0}
    cols = "date date, meal string, ing_id string, role string, qty double, green boolean, probiotic boolean, legume boolean, iron double"
    day = [(D(2024, 1, 1), "lunch", "egg", "protein", 3.0, True, True, True, 6.0), (D(2024, 1, 1), "dinner", "flax", "seed", 1.0, True, False, False, 0.0), (D(2024, 1, 1), "dinner", "til", "seed", 1.0, False, False, False, 0.0), (D(2024, 1, 2), "lunch", "egg", "sour", 2.0, True, None, False, 9.0)]
    items = spark.createDataFrame(day, cols)
    assert {x.date.day: x.broken for x in menu.daily_contract(items).collect()} == {1: [], 2: ["eggs", "legume", "green", "probiotic", "seeds"]}
    assert [x.date.day for x in menu.sour_missing(items).collect()] == [1]
    days = spark.createDataFrame([(1, 50.0, 3.0), (2, 50.0, 4.0), (3, 100.0, 0.0)], "date int, protein double, eggs double")
    assert [x["add"] for x in menu.protein_pass(days, 100.0).orderBy("date").collect()] == ["egg", "whey", None]
    cut = spark.createDataFrame([(1, "a", 300.0, 9.0), (1, "b", 300.0, 8.0), (1, "c", 300.0, 1.0), (2, "a", 100.0, 9.0)], "date int, ing_id string, kcal double, fat double")
    assert [(x.date, x.cut, x.kcal, x.left) for x in menu.trim(cut, 500.0).orderBy("date", "rank").collect()] == [(1, "a", 900.0, 600.0), (1, "b", 600.0, 300.0)]
    base = spark.createDataFrame([(1, "rice", "base", 2.0, 100.0, 1.5), (1, "dal", "base", 9.0, 100.0, 1.0), (1, "x", "veg", 0.0, 9.0, 1.0)], "date int, ing_id string, role string, protein double, kcal double, qty double")
    assert [tuple(x) for x in menu.filler_shave(base).collect()] == [(1, "rice", 1.0)]


def test_prep_and_forms(spark):
    ing = spark.createDataFrame([("dal", 8.0, False, ["x"]), ("curd", 0.0, True, []), ("ghee", 0.0, True, [])], "id string, lead double, keep boolean, makes array<string>")
    slots = spark.createDataFrame([(dt.datetime(2024, 1, 2, 7), "dal"), (dt.datetime(2024, 1, 2, 7), "curd")], "slot_ts timestamp, ing_id string")
    stock = spark.createDataFrame([("ghee", 1.0), ("curd", 0.0)], "ing_id string, qty double")
    got = {(r.ing_id, r.start_at, r.why) for r in menu.prep_queue(slots, ing, stock).collect()}
    assert got == {("dal", dt.datetime(2024, 1, 1, 23), "lead"), ("curd", None, "empty")}
    assert [(r.ing_id, r.delta) for r in menu.prep_done(ing.where("id = 'dal'"), F.lit("now")).collect()] == [("x", 1.0)]
    forms = spark.createDataFrame([("soak", ["dal", "nope"])], "id string, applies array<string>")
    assert [r.variant_id for r in menu.form_variants(forms, ing).collect()] == ["dal_soak"]


def test_phytate_numerics_and_summary(spark):
    """Blank cells are no error, nor are minerals that one side lacks compared."""
    ing = spark.createDataFrame([("a", 1.0, 0.0)], "id string, iron double, zinc double")
    phy = spark.createDataFrame([("a", "x", "1", "5", "", "q"), ("a", "", None, "-1", None, "1")], "id string, phytate string, iron string, zinc string, phy_fe string, phy_zn string")
    found = dq.union(dq.phytate_rules(phy, ing))
    assert sorted((r.rule, r.detail) for r in found.collect()) == [("DQ27", "phy_zn"), ("DQ27", "phytate")]
    assert {r.level: r.n for r in dq.summary(found).collect()} == {"E": 2}


def test_drift_report_and_bodies(spark):
    i = spark.createDataFrame([("a", "1", 50.0, 9.0)], "id string, ifct_code string, grams double, kcal double")
    comp = {c: 0.0 for c, _ in reference_layer.COMPONENTS.values()} | {"enerc": 418.4, "fatce": 0.0, "retol": 0.0, "cartbeq": 0.0}
    c = spark.createDataFrame([("1", *comp.values())], ["code", *comp])
    (row,) = reference_layer.drift_report(reference_layer.derive(i, c, ["kcal"])).collect()
    assert row.id == "a" and row.drift[0]["column"] == "kcal" and row.drift[0]["new"] == pytest.approx(50)
    bodies = spark.createDataFrame([('{"id": "a", "v": 2}',), ("{broken",), (None,)], "json string")
    assert [tuple(r) for r in files.read_json_body(bodies, "json", "id string, v double").collect()] == [("a", 2.0), (None, None), (None, None)]
