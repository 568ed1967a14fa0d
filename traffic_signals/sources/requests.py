"""Collected request records of web runtimes, and their profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.exprs import absent, filled, form_decode, http_method, kept_apart, query_pairs
from ..functions.rules import QUERY_KEYS
from ..functions.schema import REQUEST_SCHEMA
from ..operators.classify import header

# Neutral defaults; a deployment sets its own.
PROBE_PATH = "/__setup-probe"
PROBE_HEADERS = ("x-setup-probe", "x-probe-id", "x-probe-token")


@dataclass(frozen=True)
class Profile:
    source_provider: str
    kind: str
    name: str
    host: str  # hostname (without port), authority, or header
    host_default: str
    trim_headers: bool
    request_id: tuple[str, ...]  # headers, or empty for the record's own
    geo: str  # headers, record, or none
    upper_country: bool
    check_country: bool
    query: str
    ip: str | None
    validated: bool
    safe_query_only: bool = False
    second_referer: bool = True
    probes: bool = True


# What each runtime's collector records.
PROFILES = {
    "vercel": Profile("vercel", "vercel_nextjs_middleware", "vercel-middleware", "hostname", "unknown", True, ("x-vercel-id", "x-request-id"), "headers", True, True, "keep", "disabled", False),
    "node": Profile("node_express", "node_express", "node-middleware", "header", "localhost", True, ("x-request-id",), "none", False, False, "omit", "none", False),
    "cloudflare": Profile("cloudflare", "cloudflare_worker", "cloudflare-worker", "authority", "unknown", False, ("cf-ray",), "record", False, True, "omit", "disabled", True, second_referer=False),
    "netlify": Profile("netlify", "netlify_edge", "netlify-edge", "authority", "unknown", False, (), "record", True, True, "omit", "disabled", True, second_referer=False),
    "fastly": Profile("fastly", "fastly_compute", "fastly-compute", "authority", "unknown", True, (), "record", False, False, "omit", None, False),
    "wordpress": Profile("wordpress", "wordpress_plugin", "wordpress-plugin", "header", "unknown", True, ("",), "none", False, False, "drop", "disabled", False, True, False, False),
}
GEO_HEADERS = ("x-vercel-ip-country", "x-vercel-ip-country-region")


def read_requests(spark: SparkSession, paths: str | list[str], stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).schema(REQUEST_SCHEMA).json(paths)


def _server_url(url: Column) -> Column:
    """The parts of a URL as PHP's server variables have them: nothing is resolved or escaped."""
    a = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    secure = F.startswith(F.lower(url), F.lit("https:"))
    host = absent(F.when(secure, F.regexp_replace(a, r":443\z", "")).otherwise(F.regexp_replace(a, r":80\z", "")))
    p = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    path = F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), F.coalesce(p, F.lit(""))))
    search = F.nullif(absent(F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)), F.lit("?"))
    none = F.lit(None).cast("string")
    return F.struct(none.alias("scheme"), host.alias("host"), none.alias("port"), path.alias("path"), search.alias("search"))


def _first_of(header_value: Column) -> Column:
    return filled(F.substring_index(header_value, ",", 1))


def with_url(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    """df with __url, the parts of each record's URL by the URL standard; null where it is none.

    A profile that knows the host from a header takes request targets, which are resolved against that host. The profile of PHP
    servers takes what they hand over.
    """
    if "__url" in df.columns:
        return df
    url, h = F.col("url"), F.col("headers")
    if profile is not None and profile.host == "header":
        if profile.kind == "wordpress_plugin":
            parts = _server_url(url)
        else:
            scheme, host = F.coalesce(_first_of(header(h, "x-forwarded-proto")), F.lit("http")), F.coalesce(_first_of(header(h, "host")), F.lit(profile.host_default))
            parts = urls.parse_url(urls.resolve(url, scheme, host))
    else:
        parts = urls.parse_url(url)
    return kept_apart(df, F.struct(parts.alias("__url")))


def client_ip(headers: Column, own: Column) -> Column:
    forwarded = header(headers, "x-forwarded-for", "x-real-ip")
    return F.coalesce(filled(F.substring_index(forwarded, ",", 1)), filled(own))


def safe_pairs(search: Column) -> Column:
    """Attribution pairs with a value only, encoded again; what a profile without queries classifies by."""
    own = F.filter(query_pairs(search), lambda p: F.lower(form_decode(p.key)).isin(QUERY_KEYS) & filled(form_decode(p.value)).isNotNull())
    again = F.transform(own, lambda p: F.concat(F.lower(form_decode(p.key)), F.lit("="), F.replace(F.url_encode(filled(form_decode(p.value))), F.lit("+"), F.lit("%20"))))
    return F.when(F.size(own) > 0, F.concat(F.lit("?"), F.array_join(again, "&")))


def normalize_requests(df: DataFrame, profile: Profile) -> DataFrame:
    """Request records as flat observations without a class yet: host, path, search, method, user_agent, referer, request_id,
    country, region, client_ip, observed_at, and class_search (what the class is read from). What is no URL has the profile's default
    host and the path `/`."""
    df, h = with_url(df, profile), F.col("headers")
    parts = F.col("__url")
    if profile.host == "hostname":
        host = F.coalesce(parts["host"], header(h, "host"))
    elif profile.kind == "wordpress_plugin":
        host = F.coalesce(header(h, "host"), parts["host"])
    else:
        host = urls.authority(parts)
    names = ("referer", "referrer") if profile.second_referer else ("referer",)
    rid = filled(F.col("request_id")) if not profile.request_id else header(h, *profile.request_id, trim=profile.trim_headers) if profile.request_id != ("",) else F.lit(None).cast("string")
    country, region = F.lit(None).cast("string"), F.lit(None).cast("string")
    if profile.geo == "headers":
        country, region = (header(h, n) for n in GEO_HEADERS)
    elif profile.geo == "record":
        country, region = F.col("geo.country"), F.col("geo.region")
    if profile.upper_country:
        country, region = F.upper(filled(country)), filled(region)
    elif profile.check_country:
        region = F.when(filled(region).isNotNull(), region)
    if profile.check_country:
        country = F.when(country.rlike(r"^[A-Z]{2}\z"), country)
    search = parts["search"]
    return df.select(
        "observed_at", F.coalesce(host, F.lit(profile.host_default)).alias("host"), F.coalesce(parts["path"], F.lit("/")).alias("path"), search.alias("search"), http_method(F.col("method")).alias("method"),
        header(h, "user-agent", trim=profile.trim_headers).alias("user_agent"), header(h, *names, trim=profile.trim_headers).alias("referer"), rid.alias("request_id"),
        country.alias("country"), region.alias("region"), client_ip(h, F.col("client_ip")).alias("client_ip"), (safe_pairs(search) if profile.safe_query_only else search).alias("class_search"),
        *[c for c in df.columns if c not in (*REQUEST_COLUMNS, "observed_at")],
    )


REQUEST_COLUMNS = ("url", "method", "headers", "client_ip", "request_id", "geo", "__url")


def truthy(c: Column) -> Column:
    """Flags of probe headers: 1, true, yes, on, whatever their case."""
    return F.coalesce(F.lower(filled(c)).isin("1", "true", "yes", "on"), F.lit(False))


def env_flag(c: Column) -> Column:
    """Flags of settings: the same words, in lower case only."""
    return F.coalesce(c.isin("1", "true", "yes", "on"), F.lit(False))


def probe_condition(parts: Column, headers: Column, path: str = PROBE_PATH, names: tuple[str, str, str] = PROBE_HEADERS) -> Column:
    """Whether a request is a setup probe: its path, a truthy header, an id and a token. parts: what `with_url` gives."""
    named = truthy(header(headers, names[0])) & header(headers, names[1]).isNotNull() & header(headers, names[2]).isNotNull()
    return F.coalesce(F.when(parts["path"] == path, named), F.lit(False))


def split_probes(df: DataFrame, path: str = PROBE_PATH, names: tuple[str, str, str] = PROBE_HEADERS) -> tuple[DataFrame, DataFrame]:
    """(probes with probe_id and probe_token, other requests). What is no complete probe goes on as ordinary traffic."""
    parsed = with_url(df)
    is_probe = probe_condition(F.col("__url"), F.col("headers"), path, names)
    probes = parsed.where(is_probe).withColumns({"probe_id": header(F.col("headers"), names[1]), "probe_token": header(F.col("headers"), names[2])})
    return (probes, parsed.where(~is_probe)) if "__url" in df.columns else (probes.drop("__url"), parsed.where(~is_probe).drop("__url"))


def page_route(path: Column) -> Column:
    """Whether a path is a page rather than an API call, a build asset or a static file."""
    skipped = r"^/(?:api|_next/static|_next/image|favicon.ico|robots.txt|sitemap.xml)"
    assets = r"^/.*\.(?:png|jpg|jpeg|gif|svg|ico|webp|css|js|map|txt|xml)\z"
    return path.startswith("/") & ~path.rlike(skipped) & ~path.rlike(assets)


def tracked(df: DataFrame, enabled: str = "enabled") -> DataFrame:
    """The rows of deployments whose setting, a text, switches the collection on."""
    return df.where(env_flag(F.col(enabled)))


__all__ = ["PROFILES", "Profile", "client_ip", "env_flag", "normalize_requests", "page_route", "read_requests", "safe_pairs", "split_probes", "tracked", "with_url"]
