"""Validation of JSON records against the closed, versioned schemas, as ordered lists of issues.

Records are VARIANT values, since a field that is absent and one that is null differ: every object becomes one map of its fields, each
with its JSON type, and the rules look fields up in it. Messages, and the order of the checks, are fixed by the contract.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import kept_apart, last_wins, strict_iso
from ..functions.schema import AGENT_TYPES, CLASSIFIED_PROVIDERS, HTTP_METHODS, INTEGRATION_KINDS, IP_HASH_ALGORITHMS, IP_RETENTIONS, MATCH_KINDS, SCHEMA_VERSION, SOURCE_PROVIDERS

NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"


def fields_of(v: Column) -> Column:
    """map<name, value> of a JSON object, null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


@dataclass(frozen=True)
class Object:
    """A JSON object: its fields as `fields_of` gives them, and those with a known name once more by place, as `placed` gives them, so that
    no rule searches the map."""

    fields: Column
    placed: Column
    names: tuple[str, ...]

    @classmethod
    def of(cls, column: str, names: tuple[str, ...]) -> Object:
        return cls(F.col(column), F.col(f"{column}_placed"), names)


def placed(fields: Column, names: tuple[str, ...]) -> Column:
    """array<struct<v, type, text>> by the places of names: value, JSON type, and the text of a string. An absent field has no value."""
    values = F.transform(F.array(*map(F.lit, names)), lambda n: F.try_element_at(fields, n))
    typed = F.transform(values, lambda v: F.struct(v.alias("v"), F.schema_of_variant(v).alias("type")))
    return F.transform(typed, lambda x: F.struct(x["v"].alias("v"), x["type"].alias("type"), F.when(x["type"] == "STRING", F.try_variant_get(x["v"], "$", "string")).alias("text")))


class Field:
    """One field of a JSON object; absent fields have no type."""

    def __init__(self, object_: Object, name: str):
        own = F.get(object_.placed, F.lit(object_.names.index(name)))
        self.name = name
        self.v, self.type, self.text = own["v"], own["type"], own["text"]
        self.present = self.v.isNotNull()
        self.is_text = F.coalesce(self.type == "STRING", F.lit(False))
        self.is_number = F.coalesce(self.type.rlike(NUMERIC), F.lit(False))
        self.number = F.when(self.is_number, F.try_variant_get(self.v, "$", "double"))  # a text would cost an exception
        self.is_object = F.coalesce(self.type.startswith("OBJECT"), F.lit(False))
        self.is_integer = F.coalesce(self.is_number & (self.number == F.floor(self.number)), F.lit(False))

    def one_of(self, allowed: list[str]) -> Column:
        return F.coalesce(self.is_text & self.text.isin(allowed), F.lit(False))


@dataclass(frozen=True)
class Many:
    """An array of issues; other checks give one issue, or null."""

    issues: Column


Check = Column | Many


def together(checks: list[Check]) -> Column:
    """The issues of all checks in order, with nulls between. It is compiled, unlike what stands in a function of arrays."""
    arrays = []
    for many, some in groupby(checks, lambda x: isinstance(x, Many)):
        arrays += [x.issues for x in some] if many else [F.array(*some)]
    return F.concat(*arrays)


def when(bad: Column, message: str) -> list[Check]:
    return [F.when(bad, F.lit(message))]


def needs_text(f: Field) -> list[Check]:
    return when(~(f.is_text & (f.text != "")), f"{f.name} must be a non-empty string")


def optional_text(f: Field) -> list[Check]:
    return when(f.present & ~f.is_text, f"{f.name} must be a string when present")


def optional_full_text(f: Field) -> list[Check]:
    return when(f.present & ~(f.is_text & (f.text != "")), f"{f.name} must be a non-empty string")


def needs_one_of(f: Field, allowed: list[str], present: Column | None = None) -> list[Check]:
    bad = ~f.one_of(allowed)
    return when(bad if present is None else present & bad, f"{f.name} must be one of {', '.join(allowed)}")


def needs_literal(f: Field, value: str) -> list[Check]:
    return when(~f.one_of([value]), f"{f.name} must be {value}")


def needs_time(f: Field) -> list[Check]:
    return when(~f.is_text, f"{f.name} must be an ISO timestamp") + when(f.is_text & ~strict_iso(f.text), f"{f.name} must be an ISO date-time timestamp")


def needs_version(f: Field) -> list[Check]:
    return when(~f.is_integer, f"{f.name} must be an integer") + when(f.is_number & (f.number < SCHEMA_VERSION), f"{f.name} must be >= {SCHEMA_VERSION}")


def unknown_fields(object_: Object, raw: Column, path: str, label: str, allowed: tuple[str, ...]) -> list[Check]:
    """One message for each field that the object may not have, in its own order, for which the text is read again if there is any.

    Of an object that stands under a repeated key, the text has the first and the fields are the last one's: their names follow then.
    """
    extra = lambda keys: F.filter(keys, lambda k: ~k.isin(*allowed))
    own = extra(F.map_keys(object_.fields))
    written = F.array_intersect(F.coalesce(F.json_object_keys(raw if path == "$" else F.get_json_object(raw, path)), F.array().cast("array<string>")), own)
    ordered = F.concat(written, F.array_except(own, written))
    # An object with more fields than known ones has others; counting them is compiled, unlike a search of the names.
    known = reduce(lambda a, b: a + b, (Field(object_, n).present.cast("int") for n in allowed))
    some = F.coalesce(F.size(object_.fields) > known, F.lit(False))
    message = F.transform(ordered, lambda k: F.concat(F.lit(f"{label}."), k, F.lit(" is not allowed")))
    return [Many(F.when(some, message).otherwise(F.array().cast("array<string>")))]


def nested(top: Object, raw: Column, name: str, rules, optional: bool = False) -> list[Check]:
    """The issues of a closed nested object, whose fields are in the column __<name>, or that it is none."""
    allowed = PARTS[name]
    f, own = Field(top, name), Object.of(f"__{name}", allowed)
    inner = unknown_fields(own, raw, f"$.{name}", name, allowed) + rules(own)
    issues = F.when(f.is_object, together(inner)).otherwise(F.array(F.lit(f"{name} must be an object")))
    return [Many(F.when(f.present, issues).otherwise(F.array().cast("array<string>")) if optional else issues)]


def request_rules(v: Object) -> list[Check]:
    f = {n: Field(v, n) for n in ("host", "path", "search", "method", "userAgent", "referer")}
    s = f["search"]
    return [
        *needs_text(f["host"]), *needs_text(f["path"]), *when(f["path"].is_text & ~f["path"].text.startswith("/"), "request.path must start with /"), *optional_text(s),
        *when(s.is_text & (s.text != "") & ~s.text.startswith("?"), "request.search must be empty or start with ?"), *needs_one_of(f["method"], HTTP_METHODS), *optional_text(f["userAgent"]),
        *optional_text(f["referer"]),
    ]


def classification_rules(v: Object) -> list[Check]:
    confidence, matched = Field(v, "confidence"), Field(v, "matchedBy")
    items = F.try_variant_get(matched.v, "$", "array<variant>")
    known = lambda x: F.coalesce((F.schema_of_variant(x) == "STRING") & F.try_variant_get(x, "$", "string").isin(MATCH_KINDS), F.lit(False))
    each = F.transform(items, lambda x, i: F.when(~known(x), F.concat(F.lit("providerClassification.matchedBy["), i.cast("string"), F.lit("] is invalid"))))
    some = F.coalesce(matched.type.startswith("ARRAY") & (F.size(items) > 0), F.lit(False))
    return [
        *needs_one_of(Field(v, "provider"), CLASSIFIED_PROVIDERS), *needs_one_of(Field(v, "agentType"), AGENT_TYPES),
        *when(~confidence.is_number, "confidence must be a finite number"),
        *when(confidence.is_number & ((confidence.number < 0) | (confidence.number > 1)), "providerClassification.confidence must be between 0 and 1"),
        Many(F.when(some, each).otherwise(F.array(F.lit("providerClassification.matchedBy must be a non-empty array")))),
    ]


def location_rules(v: Object) -> list[Check]:
    c = Field(v, "country")
    return [*optional_text(c), *when(c.is_text & ~c.text.rlike(r"^[A-Z]{2}\z"), "location.country must be an ISO 3166-1 alpha-2 code"), *optional_full_text(Field(v, "region"))]


def ip_hash_rules(v: Object) -> list[Check]:
    bits, kept = Field(v, "truncatedBits"), Field(v, "originalIpRetention")
    return [
        *needs_one_of(Field(v, "algorithm"), IP_HASH_ALGORITHMS), *optional_full_text(Field(v, "value")), *optional_full_text(Field(v, "keyId")),
        *when(bits.present & ~bits.is_integer, "truncatedBits must be an integer"), *when(bits.is_number & (bits.number < 1), "ipHash.truncatedBits must be >= 1"),
        *when(kept.present & ~kept.one_of(IP_RETENTIONS), "ipHash.originalIpRetention is invalid"),
    ]


def integration_rules(v: Object) -> list[Check]:
    kind = Field(v, "kind")
    return [*needs_one_of(kind, INTEGRATION_KINDS, kind.present), *needs_text(Field(v, "name")), *optional_full_text(Field(v, "version")), *optional_full_text(Field(v, "requestId"))]


# The fields of the contract's objects.
PARTS = {
    "request": ("host", "path", "search", "method", "userAgent", "referer"),
    "providerClassification": ("provider", "agentType", "confidence", "matchedBy"),
    "location": ("country", "region"),
    "ipHash": ("algorithm", "value", "keyId", "truncatedBits", "originalIpRetention"),
    "integration": ("kind", "name", "version", "requestId"),
    "probe": ("id", "token"),
}
EVENT = ("schemaVersion", "eventKind", "sourceProvider", "observedAt", "request", "providerClassification", "location", "ipHash", "integration")
PROBE = ("schemaVersion", "eventKind", "sourceProvider", "observedAt", "probe", "request", "integration")
RESPONSE = ("ok", "eventKind", "probeId", "receivedAt")


def _validated(df: DataFrame, column: str, what: str, rules, names: tuple[str, ...]) -> DataFrame:
    """df with issues array<string>. Text after the JSON value, or none, is reported as one that is no object."""
    raw, parts = F.col(column), [n for n in names if n in PARTS]
    held = last_wins(df).withColumn("__v", F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))), "$[0]", "variant"))
    held = held.withColumn("__top", fields_of(F.col("__v")))
    held = held.withColumns({"__top_placed": placed(F.col("__top"), names)} | {f"__{n}": fields_of(F.try_element_at("__top", F.lit(n))) for n in parts})
    held = held.withColumns({f"__{n}_placed": placed(F.col(f"__{n}"), PARTS[n]) for n in parts})
    every = F.when(F.col("__top").isNotNull(), together(rules(Object.of("__top", names), raw))).otherwise(F.array(F.lit(f"{what} must be an object")))
    checked = kept_apart(held, F.struct(every.alias("__every"))).withColumn("issues", F.filter("__every", lambda x: x.isNotNull()))
    return checked.drop("__v", "__every", *(f"__{n}{more}" for n in ("top", *parts) for more in ("", "_placed")))


def validate_events(df: DataFrame, column: str = "event") -> DataFrame:
    """Request observations; open at the top level, closed below."""

    def rules(v: Object, raw: Column) -> list[Check]:
        f = lambda n: Field(v, n)
        return [
            *needs_version(f("schemaVersion")), *needs_literal(f("eventKind"), "request_observation"), *needs_one_of(f("sourceProvider"), SOURCE_PROVIDERS), *needs_time(f("observedAt")),
            *nested(v, raw, "request", request_rules), *nested(v, raw, "providerClassification", classification_rules), *nested(v, raw, "location", location_rules, True),
            *nested(v, raw, "ipHash", ip_hash_rules, True), *nested(v, raw, "integration", integration_rules, True),
        ]

    return _validated(df, column, "event", rules, EVENT)


def validate_probes(df: DataFrame, column: str = "event") -> DataFrame:
    """Setup probes; closed everywhere."""

    def rules(v: Object, raw: Column) -> list[Check]:
        f = lambda n: Field(v, n)
        return [
            *unknown_fields(v, raw, "$", "event", PROBE), *needs_version(f("schemaVersion")), *needs_literal(f("eventKind"), "setup_probe"), *needs_one_of(f("sourceProvider"), SOURCE_PROVIDERS),
            *needs_time(f("observedAt")), *nested(v, raw, "probe", lambda p: [*needs_text(Field(p, "id")), *needs_text(Field(p, "token"))]), *nested(v, raw, "request", request_rules),
            *nested(v, raw, "integration", integration_rules, True),
        ]

    return _validated(df, column, "setup probe event", rules, PROBE)


def validate_probe_responses(df: DataFrame, column: str = "event") -> DataFrame:
    """Answers to setup probes; four fields, closed."""

    def rules(v: Object, raw: Column) -> list[Check]:
        f = lambda n: Field(v, n)
        is_flag = F.coalesce(f("ok").type == "BOOLEAN", F.lit(False))
        return [
            *unknown_fields(v, raw, "$", "response", RESPONSE), *when(~is_flag, "ok must be a boolean"), *needs_literal(f("eventKind"), "setup_probe"), *needs_text(f("probeId")),
            *needs_time(f("receivedAt")),
        ]

    return _validated(df, column, "setup probe response", rules, RESPONSE)


def rejection() -> Column:
    """Why a validated record is rejected; null for an accepted one."""
    return F.when(F.size("issues") > 0, F.array_join("issues", "; "))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with their reason)."""
    return validated.where(F.size("issues") == 0).drop("issues"), validated.where(F.size("issues") > 0).withColumn("reason", rejection())


def valid_observation() -> Column:
    """What `validate_events` asks of an observation, on its typed columns: whether its JSON would have no issue."""
    c = F.col
    absent_or = lambda x, ok: c(x).isNull() | ok
    full = lambda x: c(x).isNotNull() & (c(x) != "")
    rules = [
        c("schema_version") >= SCHEMA_VERSION, c("event_kind") == "request_observation", c("source_provider").isin(SOURCE_PROVIDERS), strict_iso(c("observed_at")), full("host"),
        c("path").startswith("/"), absent_or("search", (c("search") == "") | c("search").startswith("?")), c("method").isin(HTTP_METHODS), c("class.provider").isin(CLASSIFIED_PROVIDERS),
        c("class.agent_type").isin(AGENT_TYPES), c("class.confidence").between(0, 1), c("class.matched_by").isin(MATCH_KINDS), absent_or("country", c("country").rlike(r"^[A-Z]{2}\z")),
        absent_or("region", c("region") != ""), c("integration_kind").isin(INTEGRATION_KINDS), full("integration_name"), absent_or("request_id", c("request_id") != ""),
        c("ip_hash").isNull() | (
            c("ip_hash.algorithm").isin(IP_HASH_ALGORITHMS) & absent_or("ip_hash.value", c("ip_hash.value") != "") & absent_or("ip_hash.key_id", c("ip_hash.key_id") != "")
            & absent_or("ip_hash.truncated_bits", c("ip_hash.truncated_bits") >= 1) & absent_or("ip_hash.original_ip_retention", c("ip_hash.original_ip_retention").isin(IP_RETENTIONS))
        ),
    ]
    return reduce(lambda a, b: a & b, (F.coalesce(r, F.lit(False)) for r in rules))


def judged_events(spark: SparkSession, paths: str | list[str], stream: bool = False) -> DataFrame:
    """Events of files of JSON lines with their source file and issues; blank lines are skipped. For jobs that want accepted and rejected
    ones in one pass, with `rejection`."""
    raw = (spark.readStream if stream else spark.read).text(paths, lineSep="\n").where(F.trim("value") != "")
    return validate_events(raw.select(F.col("value").alias("event"), F.col("_metadata.file_path").alias("source_file")))


def read_events(spark: SparkSession, paths: str | list[str], stream: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted events, rejected ones with their reason) of `judged_events`; each of the two reads and validates the files."""
    return split_valid(judged_events(spark, paths, stream))
