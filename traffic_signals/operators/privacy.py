"""Privacy normalization of observations, in a fixed order: path, query, referer, referral search, IP.

Observations are rows with the flat columns host, path, search, method, user_agent, referer and class (a classification struct).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import absent, filled, form_decode, jtrim, query_pairs
from ..functions.rules import QUERY_KEYS
from .classify import attribution_value

REDACTED_PATH = "/_redacted"
REDACTED_REFERERS = ("referer", "referrer")


@dataclass(frozen=True)
class Policy:
    """path: keep or redact; query: keep, omit or allowlist; ip: None (untouched), omit, none, disabled or hash."""

    path: str = "keep"
    path_replacement: str = REDACTED_PATH
    query: str = "keep"
    allow: tuple[str, ...] = ()
    ip: str | None = None
    ip_algorithm: str = "hmac-sha256"
    truncated_bits: int | None = None


def strip_referer(c: Column) -> Column:
    """Trimmed and cut at the first `?` or `#`; empty becomes null."""
    return absent(F.regexp_extract(jtrim(c), r"(?s)^[^?#]*", 0))


def safe_attribution(search: Column, provider: Column) -> Column:
    """The canonical attribution pair of a chat referral's search string, or null."""
    own = F.filter(query_pairs(search), lambda p: F.lower(form_decode(p.key)).isin(QUERY_KEYS))
    names = F.transform(own, lambda p: attribution_value(form_decode(p.value)))
    site = F.get(F.filter(names, lambda v: v.isin("chatgpt", "chatgptcom", "chatopenaicom")), F.lit(0))
    canonical = F.when(site == "chatopenaicom", "?utm_source=chat.openai.com").when(site.isNotNull(), "?utm_source=chatgpt.com")
    return F.when(provider == "openai_chatgpt_referral", canonical)


def allow_pairs(search: Column, allow: Column, decode: bool = True) -> Column:
    """The raw pairs whose (decoded) key is allowed, or null if none is."""
    key = lambda p: F.substring_index(p, "=", 1)
    pairs = F.split(F.regexp_replace(search, r"^\?", ""), "&")
    kept = F.array_join(F.filter(pairs, lambda p: (p != "") & F.array_contains(allow, form_decode(key(p)) if decode else key(p))), "&")
    return F.when(kept != "", F.concat(F.lit("?"), kept))


def referral_by_query(c: Column) -> Column:
    return (c["agent_type"] == "ai_referral_visit") & (c["matched_by"] == "query")


def omit_query(search: Column, c: Column) -> Column:
    """Nothing, but for a referral that the query itself gave away: its canonical pair."""
    return F.when(referral_by_query(c), safe_attribution(search, c["provider"]))


def sanitize_referral_search(search: Column, c: Column) -> Column:
    """Searches of AI referral visits keep the canonical pair at most; other searches stay."""
    return F.when(c["agent_type"] != "ai_referral_visit", search).otherwise(omit_query(search, c))


def sha256_ip(ip: Column, salt: Column) -> Column:
    return F.sha2(F.concat_ws(":", salt, ip), 256)


def hmac_pads(secret: Column) -> tuple[Column, Column]:
    """Inner and outer pad of a key, to be kept in a table rather than in a plan."""
    raw = F.encode(secret, "UTF-8")
    key = F.rpad(F.when(F.octet_length(raw) > 64, F.unhex(F.sha2(raw, 256))).otherwise(raw), 64, F.lit(b"\x00"))
    digits = F.hex(key)

    def xored(byte: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.lpad(F.hex(F.conv(digits.substr(i * 2 + 1, F.lit(2)), 16, 10).cast("long").bitwiseXOR(F.lit(byte).cast("long"))), 2, "0"))
        return F.unhex(F.array_join(each, ""))

    return xored(0x36), xored(0x5C)


def hmac_sha256(message: Column, ipad: Column, opad: Column) -> Column:
    """Lower-case hexadecimal HMAC-SHA-256 from the pads of the key."""
    inner = F.unhex(F.sha2(F.concat(ipad, F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(opad, inner), 256)


def truncated(digest: Column, bits: Column) -> Column:
    return F.when(bits.isNull(), digest).otherwise(digest.substr(F.lit(1), F.ceil(bits / 4).cast("int")))


def key_table(sites: DataFrame, secret: str = "salt") -> DataFrame:
    """(site, key_id, salt) -> (site, key_id, ipad, opad). Write it once; jobs join the result, so no plan shows a salt."""
    ipad, opad = hmac_pads(F.col(secret))
    return sites.select("site", "key_id", ipad.alias("ipad"), opad.alias("opad"))


IP_HASH = "struct<algorithm:string,value:string,key_id:string,truncated_bits:int,original_ip_retention:string>"


def ip_hash(ip: Column, policy: Policy) -> Column:
    """The ip_hash struct of a policy, from the columns ipad, opad and key_id of a joined key where it hashes."""
    none = F.lit(None).cast("string")

    def made(algorithm: str, value: Column, key_id: Column, bits: int | None, kept: str) -> Column:
        return F.struct(F.lit(algorithm).alias("algorithm"), value.alias("value"), key_id.alias("key_id"), F.lit(bits).cast("int").alias("truncated_bits"), F.lit(kept).alias("original_ip_retention"))

    if policy.ip in ("none", "disabled"):
        return made("none", none, none, None, "not_collected")
    if policy.ip == "hash":
        raw = hmac_sha256(ip, F.col("ipad"), F.col("opad")) if policy.ip_algorithm == "hmac-sha256" else sha256_ip(ip, F.col("salt"))
        value = truncated(raw, F.lit(policy.truncated_bits).cast("int"))
        return F.when(filled(ip).isNotNull(), made(policy.ip_algorithm, value, F.col("key_id"), policy.truncated_bits, "discarded_after_hash"))
    return F.lit(None).cast(IP_HASH)


#: Rows up to which a table of keys or policies is broadcast, and shares over which a row's key is dealt beyond that.
BROADCAST_ROWS, SHARES = 100_000, 32


def looked_up(df: DataFrame, table: DataFrame, key: str, table_key: str, broadcast_rows: int = BROADCAST_ROWS, shares: int = SHARES) -> DataFrame:
    """df left-joined with the row of table whose table_key equals the row's key.

    A table of up to `broadcast_rows`, which are counted, is broadcast. A larger one is joined by key and share: each of its rows stands
    in every share, and rows are dealt over the shares in turn, so that a key that a third of all rows have is spread over `shares` tasks.
    """
    if table.count() <= broadcast_rows:
        return df.join(F.broadcast(table), F.col(key) == F.col(table_key), "left")
    spread = table.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    dealt = df.withColumn("__turn", F.pmod(F.monotonically_increasing_id(), F.lit(shares)).cast("int"))
    return dealt.join(spread, (F.col(key) == F.col(table_key)) & (F.col("__turn") == F.col("__share")), "left").drop("__share", "__turn")


def apply_privacy(df: DataFrame, policy: Policy, ip: str = "client_ip", keys: DataFrame | None = None, site: Column | None = None) -> DataFrame:
    """Observations after the policy, with an ip_hash column; the raw IP column goes.

    To hash, keys holds (site, key_id, ipad, opad) and site names the key of each row; a row without a key has no hash.
    """
    c = F.col("class")
    if policy.ip == "hash":
        df = looked_up(df.withColumn("__site", site), keys.withColumnRenamed("site", "__key_site"), "__site", "__key_site").drop("__site", "__key_site")
    search = F.col("search")
    if policy.query == "omit":
        search = omit_query(search, c)
    elif policy.query == "allowlist":
        search = allow_pairs(search, F.array(*map(F.lit, policy.allow)).cast("array<string>"))
    out = {"search": sanitize_referral_search(search, c), "referer": strip_referer(F.col("referer"))}
    if policy.path == "redact":
        out["path"] = F.lit(policy.path_replacement)
    hashed = ip_hash(F.col(ip) if ip in df.columns else F.lit(None).cast("string"), policy)
    if policy.ip is not None or "ip_hash" not in df.columns:
        out["ip_hash"] = hashed
    return df.withColumns(out).drop(ip, "ipad", "opad", "key_id", "salt")


def sanitize_for_delivery(df: DataFrame) -> DataFrame:
    """What everything sent goes through again; a second time changes nothing."""
    return df.withColumns({"referer": strip_referer(F.col("referer")), "search": sanitize_referral_search(F.col("search"), F.col("class"))})


def allow_headers(headers: Column, allow: list[str]) -> Column:
    """Allowed headers with lower-case names, trimmed and non-blank, referers stripped; of a repeated name the last non-blank wins."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e.key).alias("key"), filled(e.value).alias("value")))
    kept = F.filter(entries, lambda e: e.key.isin([a.lower() for a in allow]) & e.value.isNotNull())
    names = F.array_distinct(F.transform(kept, lambda e: e.key))
    last = lambda n: F.element_at(F.filter(kept, lambda e: e.key == n), -1).value
    clean = lambda n: F.when(n.isin(*REDACTED_REFERERS), F.coalesce(strip_referer(last(n)), F.lit(""))).otherwise(last(n))
    return F.map_from_arrays(names, F.transform(names, clean))


def resolve_policies(df: DataFrame, policies: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """df (host, search, path, class, ...) after the policy of its host.

    policies: (host, query_policy, allow array<string>, path_policy, path_replacement). `keep` wins; then an allow-list, if the policy
    says so or one is set without a policy; else the query is omitted. Hosts without a row get the default. `looked_up` joins them.
    """
    p = policies.select(F.col("host").alias("p_host"), "query_policy", F.coalesce("allow", F.array().cast("array<string>")).alias("allow"), "path_policy", "path_replacement")
    j = looked_up(df, p, "host", "p_host", broadcast_rows)
    listed = (F.col("query_policy") == "allowlist") | (F.col("query_policy").isNull() & (F.size(F.coalesce("allow", F.array().cast("array<string>"))) > 0))
    search = F.when(F.col("query_policy") == "keep", F.col("search")).when(listed, allow_pairs(F.col("search"), F.col("allow"))).otherwise(omit_query(F.col("search"), F.col("class")))
    path = F.when(F.col("path_policy") == "redact", F.coalesce("path_replacement", F.lit(REDACTED_PATH))).otherwise(F.col("path"))
    out = j.withColumns({"search": sanitize_referral_search(search, F.col("class")), "path": path, "referer": strip_referer(F.col("referer"))})
    return out.drop("p_host", "query_policy", "allow", "path_policy", "path_replacement")
