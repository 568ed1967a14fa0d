"""Operator 2: mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame expressions only.

Every document gets an exponential key -ln(u) / weight, u from a hash of its id and the seed, weight from the quality of its text.
Documents of a source are taken in the order of their keys until the words taken reach the source's target: complete epochs take
every document, the rest of the target is a selection from the front of the order.

The order of a large source is never sorted in one task. Keys fall into fine, ordered buckets; a window over the few rows of bucket
sums finds the bucket in which the budget runs out, and only the documents of that bucket (one bucket for each source) are sorted
and prefix-summed. The number of buckets follows the number of documents, so a bucket stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, read, staged

WEIGHTS = (5, 2, 1)  # for the sources in code point order, repeating; a null source comes last
MAX_EPOCHS = 3
PER_BUCKET = 2000  # documents in a bucket of keys, on average


MARKS = "|*#&%$@!^~=<>{}[]_\\"  # characters that prose hardly has
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def share(text: Column, characters: str) -> Column:
    """The share of some characters in a text; translate without a counterpart leaves them out."""
    n = F.length(text)
    return (n - F.length(F.translate(text, characters, ""))).cast("double") / F.greatest(n, F.lit(1))


def quality_weight(text: Column, size: Column, distinct: Column) -> Column:
    """Between 0.05 and 1.05: high for a text with few marks and capitals whose words aren't the same again and again.

    Different words of prose grow faster than the square root of all, so twice that root is taken as full variety (a text of fewer
    than four words, which can't have it, is measured by its length). A null or empty text has the least weight.
    """
    clean = F.greatest(F.lit(0.0), 1 - 8 * share(text, MARKS)) * F.greatest(F.lit(0.0), 1 - 2 * share(text, CAPITALS))
    variety = F.least(F.lit(1.0), distinct / F.least(size.cast("double"), 2 * F.sqrt(size.cast("double"))))
    return F.lit(0.05) + F.coalesce(F.when(size > 0, clean * variety), F.lit(0.0))


def uniform(doc_id: Column, size: Column, seed: int) -> Column:
    """In (0, 1), from 52 bits of a digest of the id; repeated rows draw the same number."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), size.cast("string")))
    return (F.conv(digest.substr(1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, docs) -> the same with target.

    Words are shared by weight among all sources; a target stops at MAX_EPOCHS times its source's size and the excess is reshared.
    With r = cap / weight, a source is full exactly if r is at most the final level of words per weight, so one window over the
    sources in order of r finds that level. The window has one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("nth", F.row_number().over(order) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("nth") % len(WEIGHTS) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "heavy": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    # The first source in this order that is not full fixes the level; all after it are not full either.
    w = w.withColumn("open", F.col("cap") * F.col("heavy") > F.col("left") * F.col("weight"))
    level = F.first(F.when(F.col("open"), F.col("left") / F.col("heavy")), ignorenulls=True).over(Window.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    w = w.withColumn("level", level)
    full = ~F.col("open") | F.col("level").isNull()
    return w.select("source", "source_size", "docs", F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix(docs: DataFrame, seed: int = 20, per_bucket: int = PER_BUCKET, broadcast_sources: int = 100_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and a struct doc of the columns in carry: one row for each input row.

    size is the number of words (0 for a null or blank text), taken the words that the mix takes from the document: whole epochs of
    it, plus all of it again if it is selected. The document at which the budget of its source runs out is cut there, so a source's
    taken words differ from its target by less than one word. Ties of keys break by doc_id, then size, then the hash of the text; rows
    that agree in all of these are alike. A null source is a source of its own; a source without words has the target 0. Texts of any
    length are read whole. An empty table gives no rows; further columns are read only to be carried.
    """
    doc = F.struct(*carry).alias("doc") if carry else F.lit(None).cast("boolean").alias("doc")
    rows = docs.select("doc_id", "source", "text", doc).withColumn("words", words_of(F.col("text")))
    rows = rows.select("doc_id", "source", "doc", "text", F.size("words").cast("long").alias("size"), F.size(F.array_distinct("words")).alias("distinct"))
    key = -F.log(uniform(F.col("doc_id"), F.col("size"), seed)) / quality_weight(F.col("text"), F.col("size"), F.col("distinct"))
    rows = rows.select("doc_id", "source", "doc", "size", key.alias("key"), F.xxhash64("text").alias("own"))
    rows = staged(rows, "mix")  # texts are read once; what is carried stays in its rows and is never shuffled, but for the few rows that are sorted
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    plan = staged(targets(sizes), "mix-targets")
    n_sources = plan.count()
    plan = plan.withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
        "buckets": F.ceil(F.col("docs") / per_bucket).cast("long"),
    })
    plan = plan.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    send = F.broadcast if n_sources <= broadcast_sources else (lambda df: df)
    p = plan.withColumnRenamed("source", "p_source")
    keyed = rows.join(send(p), rows["source"].eqNullSafe(p["p_source"])).drop("p_source")
    # Rises with the key, so buckets are in the order of the keys, and is spread well for any weight.
    keyed = keyed.withColumn("bucket", F.least(F.col("buckets") - 1, F.floor(F.col("key") / (1 + F.col("key")) * F.col("buckets"))).cast("long"))
    sums = keyed.groupBy("source", "bucket", "budget").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
    cut = sums.where((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("words") <= F.col("budget")))
    cut = cut.groupBy("source").agg(F.min("bucket").alias("cut"), F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("base")))["base"].alias("base"))
    cut = cut.withColumnRenamed("source", "c_source")
    placed = keyed.join(send(cut), keyed["source"].eqNullSafe(cut["c_source"]), "left").drop("c_source")
    whole = F.when(F.col("cut").isNull() | (F.col("bucket") < F.col("cut")), F.col("size")).otherwise(F.lit(0))
    at_cut = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False))
    easy = placed.where(~at_cut).withColumn("part", F.when(F.col("budget") > 0, whole).otherwise(F.lit(0)))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size", "own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("base") + F.sum("size").over(order) - F.col("size")
    hard = placed.where(at_cut).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - before)))
    both = easy.unionByName(hard)
    return both.select("doc_id", "source", "doc", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options: int) -> DataFrame:
    """The documents of which the mix takes words: the columns of docs, then size, source_size, target and taken.

    A column of docs with one of these names gives way to the mix's own.
    """
    own = ("size", "source_size", "target", "taken")
    return mix(docs, carry=tuple(c for c in docs.columns if c not in own), **options).where("taken > 0").select("doc.*", *own)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^ \x09-\x0D]+'), []) AS words FROM documents
), q AS (
  SELECT doc_id, source, len(words)::BIGINT AS size, len(list_distinct(words))::DOUBLE AS different, length(text) AS n,
    length(translate(text, '|*#&%$@!^~=<>{}[]_\', ''))::DOUBLE AS plain, length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))::DOUBLE AS low FROM d
), k AS (
  SELECT *, -ln((('0x' || substr(md5('20|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
    / (0.05::DOUBLE + CASE WHEN size > 0 THEN greatest(0::DOUBLE, 1 - 8 * ((n - plain) / greatest(n, 1))) * greatest(0::DOUBLE, 1 - 2 * ((n - low) / greatest(n, 1)))
      * least(1::DOUBLE, different / least(size::DOUBLE, 2 * sqrt(size::DOUBLE))) ELSE 0 END) AS key FROM q
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM q GROUP BY source
), w AS (
  SELECT *, CASE nth % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), r AS (
  SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, nth) AS rn, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
    coalesce(sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_weights FROM w
), l AS (
  SELECT arg_min((total - caps)::DOUBLE / (weights - full_weights)::DOUBLE, rn) FILTER (WHERE 3 * source_size * (weights - full_weights) > (total - caps) * weight) AS level FROM r
), t AS (
  SELECT w.source, source_size, CASE WHEN level IS NULL OR 3 * source_size <= level * weight THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target FROM w, l
), o AS (
  SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken FROM o
"""
