"""Operator 10: URL filtering by host-suffix and path-prefix rules.

Each URL is expanded into expressions host suffix + leading directories of its path. The expressions meet the rules in an equi-join
on a short hash prefix; the full digest of host suffix + as many path characters as the rule has then confirms the rule, and
precedence picks one rule for each URL. Everything is a DataFrame expression.

The expansion goes as deep as the deepest rule (labels of its host, directories of its path), so no match is lost and long hosts
or paths of a URL cost nothing beyond that. Rules are broadcast only up to `broadcast_rules` rows; above that both sides are
shuffled, the URLs' side salted, since a suffix such as `com` may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: The rules that the query applies: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

SHORT = 8  # hexadecimal digits of a digest in the join key


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])))


def directories(path: Column) -> Column:
    """The path up to its last slash; what a longer rule path is looked up by."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rules: int = 100_000, salts: int = 64) -> DataFrame:
    """Judge every row of pages (page_id, url) by rules (verdict, host, path).

    Returns page_id, host, path, rule, verdict: one row for each input row. A null URL or one without `://` has an empty host
    and path, and the default verdict, as has any URL that no rule fits. A rule fits its host and all subdomains if the path
    starts with the rule's. The longest rule (host and path together) wins, then the longer host, then block before allow.
    Repeated pages are judged row by row; rules with a null or empty host are ignored, a null path counts as empty. URLs may be of any
    length. An empty table gives no rows, and without rules all get the default; further columns of pages, whatever their names, are
    not read.
    """
    rules = rules.where(F.coalesce(F.col("host"), F.lit("")) != "").select(
        F.col("verdict").alias("r_verdict"), ascii_lower(F.col("host")).alias("r_host"), F.coalesce(F.col("path"), F.lit("")).alias("r_path")
    ).distinct()
    deep = rules.agg(F.count("*"), F.max(F.size(F.split("r_host", r"\."))), F.max(F.size(F.split("r_path", "/")) - 1)).first()
    n_rules, labels, dirs = deep[0], deep[1] or 0, deep[2] or 0
    rules = rules.select(
        F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"), (F.col("r_verdict") == "block").alias("b"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")).alias("r_best"),
        F.length("r_path").alias("r_len"),
        F.sha2(F.concat("r_host", "r_path"), 256).alias("r_digest"),
        F.sha2(F.concat("r_host", directories(F.col("r_path"))), 256).substr(1, SHORT).alias("short"),
    )
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts, slashes = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda i: F.array_join(F.slice(parts, -i, i), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(slashes) - 1, F.lit(dirs))), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(slashes, 1, i), "/"), F.lit("/"))))
    urls = urls.withColumns({"suffixes": suffixes, "prefixes": prefixes})
    each = F.flatten(F.transform("suffixes", lambda s: F.transform("prefixes", lambda p: F.struct(s.alias("suffix"), F.sha2(F.concat(s, p), 256).substr(1, SHORT).alias("short")))))
    urls = urls.select("page_id", "host", "path", "suffixes", "prefixes")
    exploded = urls.where("host <> ''").select("host", "path", "suffixes", "prefixes").distinct().select("host", "path", F.inline(each))
    if n_rules <= broadcast_rules:
        met = exploded.join(F.broadcast(rules), "short")
    else:  # a suffix such as `com` may hold most expressions: they are dealt over salts, and each rule goes to all of them
        salted = exploded.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)))
        met = salted.join(rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["short", "salt"])
    confirmed = F.sha2(F.concat("suffix", F.col("path").substr(F.lit(1), F.col("r_len"))), 256) == F.col("r_digest")
    best = met.where(confirmed).groupBy("host", "path").agg(F.max("r_best").alias("best"))
    # URLs without a host fit no rule; they would all meet in one key of the join.
    some = urls.where("host <> ''").join(best, ["host", "path"], "left")
    judged = some.select("page_id", "host", "path", "best").unionByName(urls.where("host = ''").select("page_id", "host", "path", F.lit(None).cast(best.schema["best"].dataType).alias("best")))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "pages"), rule_table(spark, RULES))


SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), m AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) + length(rpath) DESC NULLS LAST) AS rn
  FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE rn = 1
"""
