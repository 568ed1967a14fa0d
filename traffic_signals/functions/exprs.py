"""Column expressions shared by parsers, classification and privacy. No Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import HTTP_METHODS

#: White space as JavaScript's trim() and \s know it, for Java's regular expressions.
SPACE = r"[\s\x0b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"

#: The same characters, each once.
BLANKS = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


#: A text whose ends are printable ASCII: there is nothing to trim, which this tells much faster than trimming by BLANKS.
TIGHT = r"(?s)^[!-~](?:.*[!-~])?\z"


def absent(c: Column) -> Column:
    """null for an empty string."""
    return F.nullif(c, F.lit(""))


def jtrim(c: Column) -> Column:
    """Trim all Unicode white space. Only the ends are looked at; a pattern would try every place of the text."""
    return F.when(c.rlike(TIGHT), c).otherwise(F.btrim(c, F.lit(BLANKS)))


def filled(c: Column) -> Column:
    """Trimmed, with blank as null."""
    return F.when(c.rlike(TIGHT), c).otherwise(_other_than(F.btrim(c, F.lit(BLANKS)), ""))


def dash_null(c: Column) -> Column:
    """Trimmed, with blank and `-` as null."""
    return F.when(c.rlike(TIGHT) & (c != "-"), c).otherwise(_other_than(F.btrim(c, F.lit(BLANKS)), "", "-"))


def _other_than(c: Column, *none: str) -> Column:
    """c, or null for the given values. c is computed once, and as a function of arrays this adds nothing to generated methods."""
    return F.get(F.filter(F.array(c), lambda x: ~x.isin(*none)), F.lit(0))


def http_method(c: Column) -> Column:
    up = F.upper(c)
    return F.when(up.isin(HTTP_METHODS[:-1]), up).otherwise(F.lit("OTHER"))


def leading_int(c: Column) -> Column:
    """The integer that a string starts with, or null."""
    return F.regexp_extract(c, rf"^{SPACE}*([+-]?[0-9]+)", 1).try_cast("bigint")


def form_decode(c: Column) -> Column:
    """Percent-decoding with `+` as a space; a string that can't be decoded stays as it is.

    try_url_decode gives null for broken escapes, and a replacement character for bytes that aren't UTF-8. Most strings have nothing to decode.
    """
    out = F.try_url_decode(c)
    bad = out.isNull() | (out.contains("\ufffd") & ~c.contains("\ufffd") & ~F.lower(c).contains("%ef%bf%bd"))
    return F.when(~c.contains("%") & ~c.contains("+"), c).when(bad, c).otherwise(out)


def query_pairs(search: Column) -> Column:
    """array<struct<key, value, raw>> of the non-empty pairs of a search string, raw key and value undecoded."""
    body = F.regexp_replace(search, r"^\?", "")
    pairs = F.filter(F.split(body, "&"), lambda p: p != "")
    key = lambda p: F.substring_index(p, "=", 1)
    return F.transform(pairs, lambda p: F.struct(key(p).alias("key"), F.substr(p, F.length(key(p)) + 2).alias("value"), p.alias("raw")))


#: A day of the calendar; told by a pattern, without parsing and printing the day.
DAY = (
    r"(?:[0-9]{4}-(?:(?:0[13578]|1[02])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)-(?:0[1-9]|[12][0-9]|30)|02-(?:0[1-9]|1[0-9]|2[0-8]))"
    r"|(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)-02-29)"
)


def strict_iso(c: Column) -> Column:
    """Whether a string is a full ISO date-time of a real calendar day, seconds at most 59, with `Z` or an offset."""
    return F.coalesce(c.rlike(rf"^{DAY}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]+)?(?:Z|[+-](?:[01][0-9]|2[0-3]):[0-5][0-9])\z"), F.lit(False))


def iso_millis(ts: Column) -> Column:
    """A timestamp printed in UTC with milliseconds."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_timestamp(c: Column) -> Column:
    """A timestamp from the ISO forms that log writers use: date, or date-time with or without seconds, fraction and zone."""
    ok = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?\z")
    return F.when(ok, c.try_cast("timestamp"))


def epoch_seconds(c: Column) -> Column:
    """A timestamp from seconds, cut to milliseconds in double arithmetic."""
    return F.timestamp_millis((c.cast("double") * 1000).cast("bigint"))


def mapped(c: Column, groups: dict[str, list[str]], default: str = "other") -> Column:
    """The group that a value belongs to."""
    out = None
    for name, members in groups.items():
        out = F.when(c.isin(members), name) if out is None else out.when(c.isin(members), name)
    return out.otherwise(default)


def last_wins(df: DataFrame) -> DataFrame:
    """df, whose session reads JSON objects with repeated keys as JavaScript does: the last value of a key counts. Spark's own setting
    refuses such objects."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def kept_apart(df: DataFrame, result: Column, columns: list[str] | None = None) -> DataFrame:
    """df, or the given columns of it, with the fields of a struct that is computed once a row: a filter on them is not pushed below what computes it.

    The fields come out of `inline`, which would interpret what stands in it; so the struct is a column of the projection before, which
    is compiled.
    """
    return df.withColumn("__held", result).select(*(columns or ["*"]), F.inline(F.array("__held"))).drop("__held")
