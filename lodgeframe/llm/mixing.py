"""Mixing sources to target weights.

Tokens are aggregated per source, each source's target is its share of all
tokens, and its repetition rate is target / tokens. A document is then emitted
floor(rate) times, plus one copy when a hash-seeded Bernoulli draw with
probability rate - floor(rate) succeeds. Nothing here needs Python.

Targets: sources share ``total`` tokens by weight; a target stops at
``most_repeats`` times its source's tokens, and the excess is shared again by
weight among the others. With lambda the tokens per unit of weight, a source
gets min(lambda * weight, cap); sorted by cap / weight, lambda follows from
two running sums, so no loop is needed.

The draw depends on (id, text, number, seed), where number counts the rows that
are equal in id, source and text. So rows that share an id, or have none, draw
apart, and each source comes near its target however many rows are alike;
which of several equal rows is taken makes no difference. Equal rows are
numbered within a task first and then by the sums of the tasks before, so a
key with a third of all rows meets in no task.

Edge cases: a null text has size 0 and counts as empty; a null source is a
source of its own and sorts last; a source without words has target 0 and rate
0; a null id draws as the text "null". Reruns agree. An empty table gives an
empty table. Extra columns pass through ``mix`` whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.staging import stage, words

CYCLE = 3
MOST_REPEATS = 3
SEED = 17


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def draw(ident: Column, text_name: Column, number: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id, the text's MD5, the number among equal
    rows and the seed, from 32 bits of an MD5 (both engines of the SQL check
    have it)."""
    key = F.concat_ws("|", F.coalesce(ident.cast("string"), F.lit("null")), text_name, number.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def targets(sizes: DataFrame, weights: Column | None = None,
            most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Per source: source, source_size, target, rate. ``sizes`` holds one row
    per document (source, size). ``weights`` is an expression over ``place``,
    the source's place by code point (from 0, null last)."""
    if weights is None:
        weights = F.col("place") % CYCLE + 1
    # One row per source from here on; windows over them all are short tasks.
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("place", F.row_number().over(named) - 1)
           .withColumn("weight", weights.cast("double"))
           .withColumn("cap", F.col("source_size").cast("double") * most_repeats))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # ``level``: tokens per weight if exactly the sources before are capped. It
    # rises while the next source would be capped too, then falls: the true
    # one is the first at which the source itself stays below its cap.
    per = (per.withColumn("level", (F.sum("source_size").over(everything).cast("double")
                                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(onward))
           .withColumn("level", F.first(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                                               F.col("level")), ignorenulls=True).over(everything))
           .withColumn("target", F.least(F.col("level") * F.col("weight"), F.col("cap"))))
    return per.select("source", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                      .otherwise(0.0).alias("rate"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, text_name, part, ...) with ``number``, from 1,
    among the rows equal in the first three. ``part`` is any split of the rows
    that spreads equal ones."""
    same = ["doc_id", "source", "text_name"]
    within = Window.partitionBy(*same, "part").orderBy("part")
    before = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("n"))
    base = parts.select(*[F.col(c).alias(f"of_{c}") for c in (*same, "part")],
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).filter("base > 0")
    own = rows.withColumn("within", F.row_number().over(within))
    match = F.col("part") == F.col("of_part")
    for c in same:
        match = match & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return (own.join(base, match, "left").withColumn("number", F.col("within") + F.coalesce("base", F.lit(0)))
            .drop("within", "base", "of_part", *[f"of_{c}" for c in same]))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
                       F.md5(text).alias("text_name"), F.spark_partition_id().alias("part"), *more)


def planned(rows: DataFrame, per: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` (with ``number``) with source_size, target and copies: how often
    each is emitted. ``per`` is staged, so it is broadcast where its files are small."""
    whole = F.floor("rate")
    extra = F.when(draw(F.col("doc_id"), F.col("text_name"), F.col("number"), seed) < F.col("rate") - whole, 1).otherwise(0)
    return (rows.join(per.withColumnRenamed("source", "of_source"),
                                F.col("source").eqNullSafe(F.col("of_source")))
            .withColumn("copies", (whole + extra).cast("bigint")))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: int = SEED, **options) -> DataFrame:
    """Per document: id, source, size, source_size, target, copies. The texts
    are read once; sizes are staged, as they are narrow and used again."""
    sizes = stage(_sized(docs, id_col, text_col, source_col), "mixing-sizes")
    per = stage(targets(sizes, **options), "mixing-targets")
    return planned(numbered(sizes), per, seed).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: int = SEED, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` floor(rate) times, and once more
    by its draw. Rows that no other equals draw as in ``mix_plan``; equal ones
    by their number in the table, which needs no shuffle of texts. Only keys
    that several rows share, and the sources, are joined to the texts; both are
    staged, so they are broadcast where their files are small."""
    narrow = stage(_sized(docs, id_col, text_col, source_col), "mixing-sizes")
    per = stage(targets(narrow, **options), "mixing-targets")
    same = ["doc_id", "source", "text_name"]
    shared = stage(narrow.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select(*[F.col(c).alias(f"of_{c}") for c in same], F.lit(True).alias("shared")), "mixing-shared")
    match = F.lit(True)
    for c in same:
        match = match & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    # The document travels as one struct, so no name of its columns can clash.
    rows = (_sized(docs, id_col, text_col, source_col, F.struct("*").alias("row"),
                   F.monotonically_increasing_id().alias("place"))
            .join(shared, match, "left").drop(*[f"of_{c}" for c in same])
            .withColumn("number", F.when(F.col("shared"), F.col("place") + 2).otherwise(F.lit(1).cast("bigint"))))
    rows = planned(rows, per, seed)
    # array_repeat of 0 copies is empty, so explode drops the row.
    return (rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("row.*"))


def digest(plan: DataFrame) -> DataFrame:
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


DIGEST_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS text_name,
         row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS number,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST(place % {CYCLE} + 1 AS DOUBLE) AS weight,
         CAST(source_size AS DOUBLE) * {MOST_REPEATS} AS cap FROM per),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
found AS (
  SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1),
goals AS (
  SELECT source, source_size, least((SELECT level FROM found) * weight, cap) AS target FROM weighed),
rated AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(d.doc_id AS VARCHAR), 'null'), text_name, CAST(number AS VARCHAR), '{SEED}')), 1, 8) AS BIGINT) AS DOUBLE)
           / 4294967296.0 AS u
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
