"""The domain's tables as seen in the driver's star schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.sources.schema import FLAGS, NUTRIENTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingredients(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("role"), F.col("p_size").alias("shelf"), (1.0 + k % 4).alias("pack"), F.lit(10.0).alias("default"), k.alias("sort"),
        (k % 5 == 0).alias("pantry"), F.col("p_retailprice").alias("kcal"), (F.col("p_size") / 10.0).alias("protein"), F.when(k % 7 == 0, 0.0).otherwise((k % 13).cast("double")).alias("iron"),
        F.when(k % 11 == 0, "soak").otherwise("").alias("needform"), F.when(k % 11 == 0, F.array(F.lit("fe"))).otherwise(F.array().cast("array<string>")).alias("gated"),
    )


def stock(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("ing_id"), (k % 5).cast("double").alias("qty"))


def stock_by_size(spark, d) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("ing_id"), F.col("p_size").cast("double").alias("qty"))


def plates(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("meal"), (F.col("o_orderstatus") == "P").alias("planned"), F.col("o_orderdate").alias("created_at"))


def items(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("plate_id"), F.col("l_partkey").alias("ing_id"), F.col("l_quantity").cast("double").alias("qty"), F.col("l_linenumber").alias("line"))


def recipes(spark, d) -> DataFrame:
    row = F.struct("l_linenumber", "l_partkey")
    lists = {n: F.transform(F.sort_array(F.collect_list(F.when(c, row))), lambda x: x["l_partkey"]).alias(n) for n, c in (("core", F.col("l_linenumber") <= 3), ("opt", F.col("l_linenumber") > 3))}
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(*lists.values())


def core_rows(spark, d) -> DataFrame:
    """The recipes' core items, a row each."""
    return table(spark, d, "lineitem").where("l_linenumber <= 3").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("ing_id"))


def pins(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where(k % 97 == 0).select(k.alias("recipe_id"), (1.0 + k % 3).alias("perweek"))


def ledger(spark, d) -> DataFrame:
    """Purchases add, signups set, everything else takes.  A purchase is one, whatever its value."""
    kind, v = F.col("event_type"), F.col("value")
    return table(spark, d, "events").select(F.col("user_id").alias("item"), "ts", "event_id", F.when(kind.isin("purchase", "signup"), v).otherwise(-v).alias("delta"), (kind == "signup").alias("is_set"), (kind == "purchase").alias("bought"))


def composition(spark, d) -> DataFrame:
    """A composition table: suppliers' even codes with components per 100 g."""
    k = F.col("p_partkey")
    null = F.when(k % 6 != 0, 1.0)
    return table(spark, d, "part").where(k % 4 != 3).select(
        k.cast("string").alias("code"), F.col("p_name").alias("name"), F.col("p_brand").alias("scie"), F.col("p_type").alias("grup"),
        F.when(k % 9 != 0, (k % 1500).cast("double")).alias("enerc"), (F.col("p_size") / 4.0).alias("fatce"), (null * F.col("p_size") / 8.0).alias("protcnt"), ((k % 17) / 1000.0).alias("fe"), ((k % 23) / 1e6).alias("retol"), ((k % 29) / 1e6).alias("cartbeq"),
        (k % 31 / 3.0).alias("choavldf"), (k % 7 / 2.0).alias("fibtg"), ((k % 19) / 1000.0).alias("ca"), ((k % 11) / 1000.0).alias("vitc"), ((k % 37) / 1e6).alias("folsum"), (k % 5 / 10.0).alias("f18d3n3"), (k % 3 / 10.0).alias("f22d6n3"), ((k % 41) / 1000.0).alias("zn"), ((k % 43) / 1000.0).alias("mg"), ((k % 47) / 1000.0).alias("k"),
    )


def ingredient_table(spark, d) -> DataFrame:
    """Parts as rows of the whole ingredient table, with falsy and blank cells."""
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    numbers = {"kcal": F.col("p_retailprice"), "protein": F.col("p_size") / 8.0, "carbs": (k % 40) / 4.0, "iron": (k % 13) / 8.0, "calcium": k % 9 + 0.5}
    nutrients = [numbers.get(c, (k % 17) / 16.0).cast("double").alias(c) for c in NUTRIENTS]
    return table(spark, d, "part").select(
        k.cast("string").alias("id"), F.col("p_name").alias("name"), F.lit("serving").alias("unit"), (k % 3).cast("double").alias("default_qty"), F.col("p_type").alias("role"), *((k % n == 0).alias(c) for c, n in zip(FLAGS, (5, 2, 3, 7, 11))), *nutrients,
        F.when(k % 2 == 0, none).otherwise("n").alias("note"), F.when(k % 4 != 0, F.col("p_size")).otherwise(0).alias("shelf"), (k % 3).cast("double").alias("pack"), F.when(k % 5 == 0, "").otherwise("bag").alias("packname"), F.when(k % 6 == 0, 8.0).alias("lead"), F.lit("").alias("prep"),
        F.when(k % 10 == 0, F.array((k + 1).cast("string"))).alias("makes"), (k % 10 == 0).alias("keep"), F.when(k % 11 == 0, "soak").otherwise("").alias("needform"), F.when(k % 11 == 0, F.array(F.lit("fe"), F.lit("zn"))).otherwise(F.array().cast("array<string>")).alias("gated"),
        F.when(k % 8 == 0, none).otherwise(F.concat(F.lit("c"), k.cast("string"))).alias("ifct_code"), (k % 50 + 0.5).cast("double").alias("grams"), none.alias("grams_src"), (-k).cast("int").alias("sort"),
    )


def recipe_table(spark, d) -> DataFrame:
    """Orders as rows of the whole recipe table."""
    k = F.col("id")
    lists = recipes(spark, d)
    ids = lambda c: F.transform(c, lambda x: x.cast("string")).alias(c)
    return lists.select(k.cast("string").alias("id"), F.concat(F.lit('Dish "'), k.cast("string"), F.lit('", hot')).alias("name"), F.array(F.lit("lunch"), F.lit("dinner")).alias("meals"), ids("core"), ids("opt"), F.when(k % 2 == 0, "stir").alias("method"), F.when(k % 3 != 0, "neutral").alias("cuisine"), F.when(k % 4 != 0, (k % 60).cast("int")).alias("effort"), F.when(k % 5 == 0, "a:1.5 b:2 x").alias("amounts"), F.lit("").alias("src"), (k % 7 == 0).alias("is_user"))


def ingredient_lines(spark, d) -> DataFrame:
    """Parts as lines of an ingredient file: ``file``, ``start`` and ``value``.
    Comment and blank lines stand between rows, some rows lack cells."""
    k = F.col("p_partkey")
    row = F.concat_ws(",", k.cast("string"), F.concat(F.lit('"'), F.col("p_name"), F.lit(', x"')), F.when(k % 4 == 0, "").when(k % 4 == 1, "5d").otherwise(F.col("p_size").cast("string")), F.when(k % 3 == 0, " 1 ").otherwise("0"), F.lit("a  b"))
    short = F.when(k % 9 == 0, k.cast("string")).otherwise(row)
    lines = F.explode(F.array(F.concat(F.lit("\t# "), k.cast("string")), F.lit(" \t"), short))
    return table(spark, d, "part").select(F.lit("f").alias("file"), k.alias("start"), lines.alias("value"))
