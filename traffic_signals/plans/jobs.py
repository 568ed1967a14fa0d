"""Whole jobs: raw lines or request records to canonical observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.exprs import iso_millis
from ..functions.schema import CLOUDFRONT_FIELDS, SCHEMA_VERSION
from ..operators.classify import with_request_class
from ..operators.delivery import BATCH_SIZE, assign_batches, canonical_json, envelopes, signature
from ..operators.privacy import IP_HASH, Policy, allow_pairs, apply_privacy, looked_up, sanitize_for_delivery
from ..operators.rollups import pass_counters
from ..operators.validate import valid_observation
from ..sources.cloudfront import decode_envelopes, parse_cloudfront
from ..sources.nginx import parse_nginx
from ..sources.requests import PROFILES, normalize_requests, split_probes, with_url

#: The columns of an observation.
OBSERVATION = [
    "schema_version", "event_kind", "source_provider", "observed_at", "host", "path", "search", "method", "user_agent", "referer", "class", "country", "region", "ip_hash", "integration_kind",
    "integration_name", "request_id",
]

#: The columns of a setup probe.
PROBE = ["schema_version", "event_kind", "source_provider", "observed_at", "probe_id", "probe_token", "host", "path", "search", "method", "user_agent", "referer", "integration_kind", "integration_name", "request_id"]


#: What an observation takes from a parsed line.
SEEN = ["observed_at", "host", "method", "path", "search", "referer", "user_agent"]


def forwardable(df: DataFrame, include_unknown: bool = False) -> DataFrame:
    return df if include_unknown else df.where(F.col("class.provider") != "other")


def _observation(df: DataFrame, source: str, kind: str, name: str) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in ("country", "region", "request_id") if c not in df.columns}
    absent |= {"ip_hash": F.lit(None).cast(IP_HASH)} if "ip_hash" not in df.columns else {}
    fixed = {"schema_version": F.lit(SCHEMA_VERSION), "event_kind": F.lit("request_observation"), "source_provider": F.lit(source), "integration_kind": F.lit(kind), "integration_name": F.lit(name)}
    return df.withColumns(fixed | absent | {"observed_at": iso_millis(F.col("observed_at"))})


def nginx_to_observations(
    lines: DataFrame, format: str = "auto", default_host: str | None = None, query: str = "omit", allow: tuple[str, ...] = (), include_unknown: bool = False, carry: tuple[str, ...] = (),
    counted: Observation | str | None = None,
) -> DataFrame:
    """Log lines (value, ...) to observations; bad lines are left to `split_errors`. query: omit (the default), keep or allowlist, on
    undecoded keys. Referers and referral searches are sanitised here, so nothing else is ever written or sent.

    counted: gets the pass's counters (`pass_counters`) of all lines while they go through; a name for streams, whose listeners see it.
    """
    parsed = with_request_class(parse_nginx(lines, format, default_host, SEEN))
    parsed = parsed if counted is None else parsed.observe(counted, *pass_counters(include_unknown))
    known = forwardable(parsed.where(F.col("error").isNull()), include_unknown)
    search = {"keep": F.col("search"), "omit": F.lit(None).cast("string"), "allowlist": allow_pairs(F.col("search"), F.array(*map(F.lit, allow)).cast("array<string>"), decode=False)}[query]
    out = known.withColumns({"search": search, "host": F.coalesce("host", F.lit("unknown.local"))})
    return _observation(sanitize_for_delivery(out), "nginx_log_forwarder", "nginx_log_forwarder", "nginx-log-forwarder").select(*OBSERVATION, *carry)


def valid_only(observations: DataFrame) -> DataFrame:
    """What the event contract accepts, told from the columns."""
    return observations.where(valid_observation())


def cloudfront_to_observations(
    lines: DataFrame, fields: list[str] = CLOUDFRONT_FIELDS, policy: Policy = Policy(query="omit", ip="disabled"), keys: DataFrame | None = None, site: Column | None = None,
    include_unknown: bool = False, validate: bool = True, carry: tuple[str, ...] = (),
) -> DataFrame:
    """CDN log lines to observations: parse, classify, build, validate, privacy, gate."""
    parsed = parse_cloudfront(lines, fields).where(F.col("error").isNull())
    known = forwardable(with_request_class(parsed), include_unknown)
    built = _observation(known, "cloudfront_aws", "cloudfront_aws_realtime_logs", "cloudfront-aws-realtime-logs")
    built = valid_only(built) if validate else built
    return apply_privacy(built, policy, keys=keys, site=site).select(*OBSERVATION, *carry)


def envelopes_to_observations(envelopes: DataFrame, **options: object) -> DataFrame:
    """Stream envelopes (data: base64 of log lines) to observations."""
    return cloudfront_to_observations(decode_envelopes(envelopes), **options)


def observe_requests(
    records: DataFrame, profile: str, policy: Policy | None = None, keys: DataFrame | None = None, site: Column | None = None, include_unknown: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Request records to observations by the profile of their runtime. A profile's own policy holds where none is given.

    Setup probes are no visits; `observe_probes` has them.
    """
    p = PROFILES[profile]
    parsed = with_url(records, p)
    flat = normalize_requests(split_probes(parsed)[1] if p.probes else parsed, p)
    known = forwardable(with_request_class(flat, search="class_search"), include_unknown)
    built = _observation(known, p.source_provider, p.kind, p.name)
    built = valid_only(built) if p.validated else built
    own = policy or Policy(query="omit" if p.query == "drop" else p.query, ip=p.ip)
    out = apply_privacy(built, own, keys=keys, site=site)
    if p.query == "drop":  # this profile never stores a query
        out = out.withColumn("search", F.lit(None).cast("string"))
    return out.select(*OBSERVATION, *carry)


def observe_probes(records: DataFrame, profile: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """The setup probes among request records, as the columns of PROBE. The WordPress profile has none."""
    p = PROFILES[profile]
    probes = split_probes(with_url(records, p))[0] if p.probes else records.where(F.lit(False)).withColumns({"probe_id": F.lit(""), "probe_token": F.lit("")})
    flat = normalize_requests(probes, p)
    fixed = {"schema_version": F.lit(SCHEMA_VERSION), "event_kind": F.lit("setup_probe"), "source_provider": F.lit(p.source_provider), "integration_kind": F.lit(p.kind), "integration_name": F.lit(p.name)}
    return flat.withColumns(fixed | {"observed_at": iso_millis(F.col("observed_at"))}).select(*PROBE, *carry)


def union_observations(*observed: DataFrame) -> DataFrame:
    """Observations of several sources as one table."""
    return reduce(lambda a, b: a.unionByName(b), (df.select(*OBSERVATION) for df in observed))


def delivery_job(observations: DataFrame, source: str, order: list[str], keys: DataFrame, site: str, sent_at: Column, size: int = BATCH_SIZE) -> DataFrame:
    """Observations to signed envelopes: source, batch_no, events, body, site, timestamp, signature; one row for each batch.

    Sanitises, renders the contract's JSON, cuts each source into batches and signs each body with its site's key (site, ipad, opad);
    a site without a key has no signature. site is a column that is the same for all rows of a source.
    """
    rendered = canonical_json(sanitize_for_delivery(observations)).select(*dict.fromkeys((source, site, *order, "event")))
    batches = envelopes(assign_batches(rendered, source, order, size), source, also=site).withColumn("timestamp", sent_at)
    signed = looked_up(batches, keys.select(F.col("site").alias("k_site"), "ipad", "opad"), site, "k_site")
    return signed.select(source, "batch_no", "events", "body", F.col(site).alias("site"), "timestamp", signature(F.col("timestamp"), F.col("body"), F.col("ipad"), F.col("opad")).alias("signature"))
