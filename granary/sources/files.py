"""Comment-aware delimited text, JSON bodies and exports."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.parsing import stripped, trimmed
from granary.sources.schema import NUTRIENTS


def content_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and lines that start, after any whitespace, with ``#``."""
    text = stripped(F.col("value"))
    return lines.where(~text.startswith("#") & (text != ""))


def comment_lines(lines: DataFrame) -> DataFrame:
    return lines.where(stripped(F.col("value")).startswith("#"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as ``value``, with the file and the place of the block they are in."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def numbered(lines: DataFrame, name: str = "sort") -> DataFrame:
    """Adds the row's ordinal in file order, from 0.

    A row's ordinal is its place in its block plus the sizes of the blocks
    before it (one small row each), so no task holds a whole file."""
    at = lines.withColumn("_m", F.monotonically_increasing_id())
    sizes = at.groupBy("file", "start").count()
    before = F.sum("count").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("file").alias("_f"), F.col("start").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("file", "start").orderBy("_m")) - 1
    out = at.withColumn("_n", place).join(sizes, (F.col("file") == F.col("_f")) & (F.col("start") == F.col("_b")))
    return out.withColumn(name, (F.col("_n") + F.col("_before")).cast("int")).drop("_m", "_n", "_f", "_b", "_before")


def read_commented_csv(spark: SparkSession, path: str, columns: list[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """Header-named rows of strings; a missing file is an empty table.

    Lines equal to the header are no rows.  Blank cells and cells that a short
    row lacks are null.  ``ordinal`` names a column for the row's
    number in file order."""
    if not _exists(spark, path):
        more = [T.StructField(ordinal, T.IntegerType())] if ordinal else []
        return spark.createDataFrame([], T.StructType([*(T.StructField(c, T.StringType()) for c in columns or ["id"]), *more]))
    lines = content_lines(read_lines(spark, path))
    header = lines.select("value").head()
    if header is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns or ["id"]) + (f", `{ordinal}` int" if ordinal else ""))
    rows = lines.where(F.col("value") != F.lit(header.value))
    if ordinal:
        rows = numbered(rows, ordinal)
    return parse_lines(rows, next(csv.reader([header.value])), ordinal)


def parse_lines(lines: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """Rows of ``value`` lines by ``from_csv``; every column is a string.

    ``key`` carries a column of the lines along, as the last one."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    row = F.from_csv("value", F.lit(ddl)).alias("row")
    return content_lines(lines).select(row, *([key] if key else [])).select("row.*", *([key] if key else []))


def ragged(lines: DataFrame, width: int) -> DataFrame:
    """Lines kept as arrays, with their width against the header's."""
    cells = F.split("value", ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")
    return content_lines(lines).select("value", cells.alias("cells")).withColumn("width", F.size("cells")).withColumn("wrong_width", F.col("width") != width)


def read_json_body(bodies: DataFrame, column: str, schema: str) -> DataFrame:
    return bodies.select(F.from_json(column, schema).alias("body")).select("body.*")


def to_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))


#: Decimals of the exported ingredient columns; other doubles have up to four.
DECIMALS = {c: v[2] for c, v in NUTRIENTS.items()} | {"grams": 0}


def export_text(df: DataFrame, decimals: dict[str, int] = DECIMALS) -> DataFrame:
    """Columns as export text: doubles by their decimals (four where none is
    given), arrays space-joined, flags as 1 or 0, null as nothing."""

    def text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or name in decimals:
            return F.coalesce(trimmed(c.cast("double"), decimals.get(name, 4)), F.lit(""))
        if kind.startswith("array"):
            return F.coalesce(F.concat_ws(" ", c.cast("array<string>")), F.lit(""))
        if kind == "boolean":
            return F.coalesce(c.cast("int").cast("string"), F.lit(""))
        if kind.startswith("map"):
            return F.coalesce(F.concat_ws(" ", F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))), F.lit(""))
        return F.coalesce(c.cast("string"), F.lit(""))

    return df.select(*(text(c, k).alias(c) for c, k in df.dtypes))


def _quoted(c: Column) -> Column:
    """A cell as the csv writer has it: in quotes only where it must be."""
    return F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


#: Columns of the recipe file; amounts and sources are not in it.
RECIPE_COLUMNS = ["id", "name", "meals", "core", "opt", "method", "cuisine", "effort"]


def recipe_lines(recipes: DataFrame, comments: list[str] = ()) -> DataFrame:
    """``line``: comments, header and recipes, seed rows first, then by id."""
    line = F.concat_ws(",", *(_quoted(F.col(c)) for c in RECIPE_COLUMNS))
    text = export_text(recipes.select(*RECIPE_COLUMNS, F.col("is_user").cast("int").alias("_user"), F.col("id").alias("_id")))
    rows = text.select(F.lit(len(comments) + 1).alias("at"), F.col("_user").cast("int").alias("user"), F.col("_id").alias("id"), line.alias("line"))
    return _with_head(rows, comments, ",".join(RECIPE_COLUMNS)).orderBy("at", "user", "id").select("line")


def ingredient_lines(ingredients: DataFrame, header: list[str], comments: list[str] = ()) -> DataFrame:
    """``line``: comments, header and ingredients by sort and id, unquoted.
    The file's ``default`` is the table's ``default_qty``."""
    columns = [F.col("default_qty" if c == "default" else c).alias(c) for c in header]
    text = export_text(ingredients.select(*columns, F.col("sort").cast("int").alias("_sort"), F.col("id").alias("_id")))
    line = F.concat_ws(",", *(F.col(f"`{c}`") for c in header))
    rows = text.select(F.lit(len(comments) + 1).alias("at"), F.col("_sort").cast("int").alias("user"), F.col("_id").alias("id"), line.alias("line"))
    return _with_head(rows, comments, ",".join(header)).orderBy("at", "user", "id").select("line")


def _with_head(rows: DataFrame, comments: list[str], header: str) -> DataFrame:
    head = [(i, 0, "", c) for i, c in enumerate([*comments, header])]
    return rows.sparkSession.createDataFrame(head, rows.schema).unionByName(rows)
