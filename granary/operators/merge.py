"""Mutations as pure functions from a snapshot and changes to a new snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.parsing import falsy, num, stripped, tokens, truncated
from granary.sources.schema import FLAGS, NUTRIENTS


def merge(state: DataFrame, changes: DataFrame, key: str, update: dict[str, Column] | None = None, insert: dict[str, Column] | None = None, guard: Column | None = None) -> DataFrame:
    """Upsert by key.  Expressions refer to ``t.<column>`` and ``s.<column>``.

    Matched rows take ``update`` (default: the change's columns) where ``guard``
    holds, else stay; unmatched changes take ``insert`` (default: their own
    columns); other rows stay.  Two changes for one key are an error, as for
    SQL's MERGE; changes with a null key match nothing and are inserted.
    """
    cols, kinds = state.columns, dict(state.dtypes)
    own = set(changes.columns)
    update = {c: F.col(f"s.{c}") for c in cols if c in own and c != key} if update is None else update
    insert = {} if insert is None else insert
    t = state.select(F.struct("*").alias("t"), F.col(key).alias("_tk"))
    # Partitioned by the key that the join is partitioned by.
    again = F.count(F.lit(1)).over(Window.partitionBy(key))
    s = changes.withColumn("_again", again).select(F.struct(*changes.columns).alias("s"), F.col(key).alias("_k"), "_again")
    kind = dict(changes.dtypes)[key]
    twice = F.raise_error(F.concat(F.lit("more than one change for key "), F.col("_k").cast("string"))).cast(kind)
    s = s.select("s", F.when(F.col("_k").isNotNull() & (F.col("_again") > 1), twice).otherwise(F.col("_k")).alias("_sk"))
    both = t.join(s, F.col("_tk") == F.col("_sk"), "full_outer")
    matched = F.col("_tk").isNotNull() & F.col("_sk").isNotNull()
    hit = matched if guard is None else matched & F.coalesce(guard, F.lit(False))
    new = F.col("t").isNull()

    def of(c: str) -> Column:
        fresh = insert.get(c, F.col(f"s.{c}") if c in own else F.lit(None))
        return F.when(new, fresh).when(hit, update.get(c, F.col(f"t.{c}"))).otherwise(F.col(f"t.{c}")).cast(kinds[c]).alias(c)

    return both.select(*map(of, cols))


def insert_missing(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Insert, do nothing on conflict."""
    return state.unionByName(changes.join(state.select(key), key, "left_anti").select(*state.columns))


def last_writer_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def delete_where(state: DataFrame, condition: Column) -> DataFrame:
    return state.where(~F.coalesce(condition, F.lit(False)))


def replace_range(state: DataFrame, batch: DataFrame, date: str, replaceable: Column) -> DataFrame:
    """Delete replaceable rows within the batch's dates, then add the batch.
    An empty batch has no dates and changes nothing."""
    span = batch.agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    kept = state.join(F.broadcast(span), replaceable & F.col(date).between(F.col("_lo"), F.col("_hi")), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(*state.columns)


def clear_range(state: DataFrame, date: str, lo, hi, clearable: Column) -> DataFrame:
    return delete_where(state, clearable & F.col(date).between(F.lit(lo), F.lit(hi)))


def merge_recipes(state: DataFrame, seed: DataFrame) -> DataFrame:
    """Seed rows replace seed rows, keep a timed effort, spare user rows."""
    keep = F.col("t.effort_src") == "user"
    update = {c: F.col(f"s.{c}") for c in seed.columns if c not in ("id", "effort", "effort_src", "is_user")}
    update["effort"] = F.when(keep, F.col("t.effort")).otherwise(F.col("s.effort"))
    update["effort_src"] = F.when(keep, F.col("t.effort_src")).otherwise(F.col("s.effort_src") if "effort_src" in seed.columns else F.lit(""))
    return merge(state, seed, "id", update, {"is_user": F.lit(False)}, ~F.coalesce(F.col("t.is_user"), F.lit(False)))


def save_recipe(state: DataFrame, recipe: DataFrame) -> DataFrame:
    return merge(state, recipe.withColumn("is_user", F.lit(True)), "id")


def delete_recipe(state: DataFrame, recipe_id: str) -> DataFrame:
    return delete_where(state, (F.col("id") == recipe_id) & F.col("is_user"))


def record_effort(state: DataFrame, efforts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new state, rejected rows): only 1 to 600 minutes are accepted."""
    good = F.col("effort").between(1, 600)
    rows = efforts.where(good).withColumn("effort_src", F.lit("user"))
    rows = rows.join(state.select("id"), "id", "left_semi")
    return merge(state, rows, "id"), efforts.where(~F.coalesce(good, F.lit(False)))


def set_pins(state: DataFrame, pins: DataFrame) -> DataFrame:
    """Upsert; no more than 0 a week deletes."""
    merged = merge(state, pins, "recipe_id")
    return merged.where("perweek > 0")


def set_useup(state: DataFrame, flags: DataFrame) -> DataFrame:
    return merge(state, flags, "ing_id", {"useup": F.col("s.useup")}, {"qty": F.lit(0.0)})


def set_stock(state: DataFrame, values: DataFrame, now: Column) -> DataFrame:
    """Absolute, floored at 0; the purchase clock moves only if one is given."""
    q = F.greatest(F.lit(0.0), F.col("s.qty"))
    return merge(state, values, "ing_id", {"qty": q, "updated_at": now, "bought_at": F.coalesce("s.bought_at", "t.bought_at")}, {"qty": q, "updated_at": now, "bought_at": F.col("s.bought_at")})


def add_stock(state: DataFrame, deltas: DataFrame, now: Column) -> DataFrame:
    """One change per id, floored at 0; a purchase sets the clock."""
    bought = F.when(F.col("s.delta") > 0, now)
    return merge(state, deltas, "ing_id", {"qty": F.greatest(F.lit(0.0), F.col("t.qty") + F.col("s.delta")), "updated_at": now, "bought_at": F.coalesce(bought, "t.bought_at")}, {"qty": F.greatest(F.lit(0.0), F.col("s.delta")), "updated_at": now, "bought_at": bought})


def seed_stock(state: DataFrame, ingredients: DataFrame, now: Column) -> DataFrame:
    """Pantry items without stock get one pack."""
    pack = F.when(F.coalesce(F.col("pack"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("pack"))
    new = ingredients.where("pantry").select(F.col("id").alias("ing_id"), pack.alias("qty"), now.alias("updated_at"), now.alias("bought_at"), F.lit(False).alias("useup"))
    return insert_missing(state, new, "ing_id")


def ingredient_rows(raw: DataFrame, sort: str = "sort") -> DataFrame:
    """Text cells of the ingredient file as typed rows of the table.

    Numbers are read leniently, with the defaults of the import: serving 1,
    shelf 30, pack 1, everything else 0.  ``sort`` is the row's ordinal."""
    have = set(raw.columns)
    cell = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    text = lambda c: F.coalesce(cell(c), F.lit("")).alias(c)
    number = lambda c, d=0.0: num(cell(c), d)
    return raw.select(
        "id", "name", text("unit"), number("default", 1.0).alias("default_qty"), text("role"), *((truncated(cell(c)) != 0).alias(c) for c in FLAGS), text("note"), *(number(c).alias(c) for c in NUTRIENTS),
        truncated(cell("shelf"), 30.0).alias("shelf"), number("pack", 1.0).alias("pack"), text("packname"), number("lead").alias("lead"), text("prep"), tokens(cell("makes")).alias("makes"), (truncated(cell("keep")) != 0).alias("keep"),
        text("needform"), tokens(cell("gated")).alias("gated"), text("ifct_code"), number("grams").alias("grams"), text("grams_src"), F.col(sort).cast("int").alias("sort"),
    )


def target_rows(raw: DataFrame, sort: str = "sort") -> DataFrame:
    """Text cells of the target file as typed rows: a missing cadence column is
    ``day``, a blank per-meal mark 1."""
    have = set(raw.columns)
    cell = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    cadence = F.col("cadence") if "cadence" in have else F.lit("day")
    return raw.select(
        "fname", F.col("key").alias("nkey"), "name", F.coalesce(cell("unit"), F.lit("")).alias("unit"), cadence.alias("cadence"), num(cell("daily")).alias("daily"), num(cell("meal")).alias("meal"),
        (truncated(cell("permeal"), 1.0) != 0).alias("permeal"), F.col(sort).cast("int").alias("sort"),
    )


def import_ingredients(state: DataFrame, raw: DataFrame, sort: str = "sort") -> DataFrame:
    """Every column of rows in the file is replaced; rows not in it stay (MG1).
    Of rows that repeat an id the last in the file counts."""
    return merge(state, last_writer_wins(ingredient_rows(raw, sort), "id", "sort"), "id")


def import_targets(state: DataFrame, raw: DataFrame, sort: str = "sort") -> DataFrame:
    """As :func:`import_ingredients`, by ``fname`` (MG2)."""
    return merge(state, last_writer_wins(target_rows(raw, sort), "fname", "sort"), "fname")


def user_recipes(saved: DataFrame, now_ms: Column) -> DataFrame:
    """Recipes built by hand as rows of the table: a default id, name and method,
    lists cleaned of blanks, unknown cuisine and effort left empty (MG15)."""
    default_id = F.concat(F.lit("u"), now_ms.cast("string"))
    clean = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), stripped), lambda x: x != "").alias(c)
    return saved.select(
        falsy(F.col("id"), None, zero=False).alias("_id"), falsy(F.col("name"), "Recipe", zero=False).alias("name"), *map(clean, ("meals", "core", "opt")), falsy(F.col("method"), "Your saved recipe", zero=False).alias("method"),
        falsy(F.col("cuisine"), "", zero=False).alias("cuisine"), truncated(F.col("effort").cast("string")).alias("effort"),
    ).select(F.coalesce("_id", default_id).alias("id"), "*").drop("_id")
