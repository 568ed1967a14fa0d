"""Classification of requests by user agent, referer and landing query; provider buckets and signal families."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import filled, form_decode, jtrim, kept_apart, mapped, query_pairs
from ..functions.rules import QUERY_GUARD, QUERY_KEYS, QUERY_RULES, REFERER_GUARD, REFERER_RULES, USER_AGENT_GUARD, USER_AGENT_RULES, Rule, java_pattern
from ..functions.schema import CLASSIFICATION, INTEGRATION_ORIGINS, PROVIDER_BUCKETS, SIGNAL_FAMILIES


def _result(provider: str, agent_type: str, confidence: float, rule: str, matched_by: str, docs_url: str | None) -> Column:
    values = (("provider", provider), ("agent_type", agent_type), ("confidence", confidence), ("matched_rule", rule), ("matched_by", matched_by), ("docs_url", docs_url))
    return F.struct(*(F.lit(v).cast("double" if k == "confidence" else "string").alias(k) for k, v in values))


def unknown(rule: str) -> Column:
    return _result("other", "other", 0.0, rule, "other", None)


def by_rules(value: Column, rules: list[Rule], matched_by: str, fallback: str, guard: str | None = None) -> Column:
    """The first rule of which a pattern matches. The guard, a superset of all patterns, spares most values the rules."""
    hits = [(reduce(lambda a, b: a | b, (value.rlike(java_pattern(p)) for p in r.patterns)), _result(r.provider, r.agent_type, r.confidence, r.id, matched_by, r.docs_url)) for r in rules]
    out = F.when(value.isNull() | (~value.rlike(guard) if guard else F.lit(False)), unknown(fallback))
    for hit, result in hits:
        out = out.when(hit, result)
    return out.otherwise(unknown(fallback))


def classify_user_agent(user_agent: Column, rules: list[Rule] = USER_AGENT_RULES) -> Column:
    """By a user agent that is trimmed, with blank as null."""
    return by_rules(user_agent, rules, "user_agent", "fallback:unknown-user-agent", USER_AGENT_GUARD if rules is USER_AGENT_RULES else None)


def classify_referer(referer: Column, rules: list[Rule] = REFERER_RULES) -> Column:
    """By a referer that is trimmed, with blank as null."""
    return by_rules(referer, rules, "referer", "fallback:unknown-referer", REFERER_GUARD if rules is REFERER_RULES else None)


def attribution_value(value: Column) -> Column:
    """The letters and digits of the host part of an attribution value, lower-cased."""
    bare = F.regexp_replace(F.lower(jtrim(value)), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(F.regexp_replace(bare, r"^www\.", ""), r"^[^/?#]*", 0)
    return F.coalesce(F.regexp_replace(host, "[^a-z0-9]+", ""), F.lit(""))


def search_of(query_like: Column) -> Column:
    """The part from the first `?` of a query string or URL; a text without one is itself the query."""
    q = filled(query_like)
    return F.when(F.instr(q, "?") > 0, F.regexp_extract(q, r"(?s)\?.*", 0)).otherwise(F.concat(F.lit("?"), q))


def attribution_pairs(search: Column) -> Column:
    """Normalized values of the attribution keys of a search string, in order."""
    own = F.filter(query_pairs(search), lambda p: F.lower(form_decode(p.key)).isin(QUERY_KEYS))
    return F.transform(own, lambda p: attribution_value(form_decode(p.value)))


def known_attribution(query_like: Column, rules: list[Rule] = QUERY_RULES) -> Column:
    """The first normalized attribution value of a query or URL that any rule knows, or null."""
    known = [java_pattern(p) for r in rules for p in r.patterns]
    hit = lambda v: reduce(lambda a, b: a | b, (v.rlike(p) for p in known))
    return F.when(query_like.rlike(QUERY_GUARD), F.get(F.filter(attribution_pairs(search_of(query_like)), hit), F.lit(0)))


def classify_landing_query(attribution: Column, rules: list[Rule] = QUERY_RULES) -> Column:
    """By the attribution value that `known_attribution` has found."""
    return by_rules(attribution, rules, "query", "fallback:unknown-query")


def best_class(*classes: Column) -> Column:
    """The most confident known classification; ties go to the first. Each is read several times, so they should be columns."""
    known = (F.when((c["provider"] != "other") & (c["agent_type"] != "other"), c) for c in classes)
    best = reduce(lambda a, c: F.when(a.isNull() | (c["confidence"] > a["confidence"]), c).otherwise(a), known)
    return F.coalesce(best, unknown("fallback:unknown-request"))


def with_request_class(df: DataFrame, user_agent: str = "user_agent", referer: str = "referer", search: str = "search", name: str = "class", rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """df with the classification of each request, by user agent, then referer, then landing query.

    rules: lists for user_agent, referer and query, such as `read_rules` gives; those of the registry stand in for what is left out.
    What the rules read, what each kind of rules finds and the result are computed once a row, each in a projection of its own.
    """
    own = {"user_agent": USER_AGENT_RULES, "referer": REFERER_RULES, "query": QUERY_RULES} | (rules or {})
    read = df.withColumns({"__agent": filled(F.col(user_agent)), "__referer": filled(F.col(referer)), "__query": known_attribution(F.col(search), own["query"])})
    judged = read.withColumns({"__by_agent": classify_user_agent(F.col("__agent"), own["user_agent"]), "__by_referer": classify_referer(F.col("__referer"), own["referer"]), "__by_query": classify_landing_query(F.col("__query"), own["query"])})
    best = best_class(F.col("__by_agent"), F.col("__by_referer"), F.col("__by_query"))
    return with_class(judged, best, name).drop("__agent", "__referer", "__query", "__by_agent", "__by_referer", "__by_query")


def first_filled(*values: Column) -> Column:
    return F.coalesce(*map(filled, values))


def with_loose_request_class(df: DataFrame, headers: str = "headers", name: str = "class", rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """df with the classification of requests that name their parts in several ways; columns that df lacks are absent.

    The first filled one counts: user_agent, or its header; referer, referrer, or their headers; search, query, url, landing_url.
    """
    have = lambda *names: [F.col(n) for n in names if n in df.columns]
    of = lambda *names: [header(F.col(headers), n) for n in names] if headers in df.columns else []
    none = F.lit(None).cast("string")
    read = df.withColumns({
        "__user_agent": first_filled(none, *have("user_agent"), *of("user-agent")), "__from": first_filled(none, *have("referer", "referrer"), *of("referer", "referrer")),
        "__landing": first_filled(none, *have("search", "query", "url", "landing_url")),
    })
    return with_request_class(read, "__user_agent", "__from", "__landing", name, rules).drop("__user_agent", "__from", "__landing")


def header(headers: Column, *names: str, trim: bool = True) -> Column:
    """The first non-blank header of these names, whatever its case. The lower-case names are the same expression in every look-up, so
    a projection with several look-ups computes them once."""
    names_, found = F.transform(F.map_keys(headers), F.lower), []
    for name in names:
        own = F.get(F.map_values(headers), (F.array_position(names_, name) - 1).cast("int"))
        found.append(filled(own) if trim else F.when(filled(own).isNotNull(), own))
    return F.coalesce(*found)


def with_class(df: DataFrame, result: Column, name: str = "class") -> DataFrame:
    """df with a classification column that is computed once a row: a filter on it is not pushed below the rules."""
    return kept_apart(df, F.struct(result.alias(name)))


def provider_bucket(provider: Column) -> Column:
    return mapped(provider, PROVIDER_BUCKETS)


def signal_family(agent_type: Column) -> Column:
    return mapped(agent_type, SIGNAL_FAMILIES)


def integration_origins(df: DataFrame, kind: str = "kind") -> DataFrame:
    """df with origin_provider and origin_label of an integration kind; unknown and null kinds are `other`. The ten origins are broadcast."""
    rows = F.array(*[F.struct(F.lit(k).alias("o_kind"), F.lit(p).alias("origin_provider"), F.lit(label).alias("origin_label")) for k, p, label in INTEGRATION_ORIGINS])
    origins = df.sparkSession.range(1).select(F.inline(rows))
    out = df.join(F.broadcast(origins), df[kind] == origins["o_kind"], "left").drop("o_kind")
    return out.withColumns({"origin_provider": F.coalesce("origin_provider", F.lit("other")), "origin_label": F.coalesce("origin_label", F.lit("Other"))})
