"""Quality rules: a table of thresholds compiled into one projection.

Every rule is (measure, least, most) over ratios of a document's length,
symbols, stop words and lines.  ``compiled`` turns the table into one Boolean
column, so Spark evaluates all of it in one pass without user functions and
without a shuffle.

Defined results: a null or empty text has no word and fails the base rule; no
measure divides by zero (a ratio over nothing is 0); repeated rows are judged
each for itself; extra columns are ignored.  Two windows are equal when all three
of their words are; hashes only bring them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import SPACE

#: Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is it that for was on are with as be by this from or an at not have"
    " der die das und ist von mit zu den ein eine nicht auf für sich auch als im dem des"
    " le la les de et un une est que en du des pour dans pas sur par ou"
    " el los las y es por con del se no una para lo al su como"
).split()

#: (measure, least, most); null leaves that side open.
THRESHOLDS = (
    ("mean_word_chars", 2.0, 16.0),
    ("symbols_per_word", None, 0.25),
    ("stop_word_ratio", 0.03, None),
    ("dup_line_ratio", None, 0.5),
)


def _over(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


#: Ratios that rules may name, over the counted columns.
MEASURES = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "mean_word_chars": lambda: _over(F.col("word_chars"), F.col("n_words")),
    "symbols_per_word": lambda: _over(F.col("n_symbols"), F.col("n_words")),
    "stop_word_ratio": lambda: _over(F.col("n_stop_words"), F.col("n_words")),
    "dup_line_ratio": lambda: _over(F.col("n_dup_lines"), F.col("n_lines")),
    "repeat_word_ratio": lambda: _over(F.col("n_repeat_words"), F.col("n_words")),
}


def compiled(thresholds) -> Column:
    """One Boolean column: every rule of the table holds."""
    holds = F.lit(True)
    for measure, least, most in thresholds:
        value = MEASURES[measure]()
        if least is not None:
            holds = holds & (value >= F.lit(float(least)))
        if most is not None:
            holds = holds & (value <= F.lit(float(most)))
    return holds


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at these ascending places."""
    n = F.size(starts)
    step = lambda i: F.least(F.lit(3).cast("long"), F.coalesce(F.try_element_at(starts, (i + 2).cast("int")), F.lit(1 << 60)) - F.element_at(starts, (i + 1).cast("int")))
    return F.when(n > 0, F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), step), F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))


def _repeated_starts(w: Column, bits: Column, hashed: Column) -> Column:
    """Places of 3-word windows that occur twice or more, ascending.

    ``hashed`` is sorted and holds a window's hash above its place of ``bits``
    bits, so equal windows are neighbours; the words settle it.  Where neighbours
    have one hash but other words, the window is looked for among all."""
    shift = lambda f, x: F.call_function(f, x, bits)
    mask = shift("shiftleft", F.lit(1).cast("long")) - 1
    place = lambda x: x.bitwiseAND(mask).cast("int")

    def like(a: Column, b: Column) -> Column:
        return F.coalesce(shift("shiftright", a) == shift("shiftright", b), F.lit(False))

    def same(a: Column, b: Column) -> Column:
        i, j = place(a), place(b)
        return like(a, b) & (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))

    def repeated(x: Column, i: Column) -> Column:
        near = [F.get(hashed, i + 1), F.get(hashed, i - 1)]
        found = F.coalesce(same(x, near[0]), F.lit(False)) | F.coalesce(same(x, near[1]), F.lit(False))
        far = F.exists(hashed, lambda y: (x != y) & same(x, y))
        return F.when(found, True).when(like(x, near[0]) | like(x, near[1]), far).otherwise(False)

    return F.sort_array(F.transform(F.filter(hashed, repeated), lambda x: place(x).cast("long")))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules are made of."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("t")).withColumn("w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    d = d.withColumn("n", F.size("w")).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("lines_n", F.size("lines"))
    w, n = F.col("w"), F.col("n")
    # As many bits as the last place has; the hash takes the rest of a long.
    bits = F.greatest(F.lit(1), F.ceil(F.log2(n.cast("double") + 1))).cast("int")
    hash_ = lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
    key = lambda i: F.call_function("shiftleft", F.call_function("shiftrightunsigned", hash_(i), F.col("bits") + 1), F.col("bits")).bitwiseOR(i.cast("long"))
    d = d.withColumn("bits", bits)
    d = d.withColumn("hashed", F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), key))))
    d = d.withColumn("starts", _repeated_starts(w, F.col("bits"), F.col("hashed")))
    space = F.translate("t", "\x20\x09\x0a\x0b\x0c\x0d", "")
    return d.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(space).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.col("lines_n") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, _covered(F.col("starts"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.col("lines_n").cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def judge_quality(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Counts and verdicts for every document."""
    d = counted(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(thresholds))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT rid, unnest(list_transform(range(len(w) - 2), lambda i: {'i': i, 'a': w[i + 1], 'b': w[i + 2], 'c': w[i + 3]}), recursive := true) FROM w WHERE len(w) >= 3),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM g),
s AS (SELECT rid, least(3, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), 1000000000000) - i) AS more FROM c WHERE k > 1),
r AS (SELECT rid, sum(more) AS n FROM s GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
  length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
  len(l) AS n_lines, len(list_filter(w, lambda x: lower(x) IN (STOPS))) AS n_stop
  FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 2 AND 16 AND n_symbols::DOUBLE / n_words <= 0.25
  AND n_stop::DOUBLE / n_words >= 0.03 AND (n_lines = 0 OR n_dup_lines::DOUBLE / n_lines <= 0.5) AS kept
FROM b
""".replace("STOPS", ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)))
