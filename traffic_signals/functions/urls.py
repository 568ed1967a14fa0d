"""URLs as browsers and web runtimes read them (the WHATWG URL standard), as column expressions. No Python UDFs.

`parse_url` covers the special schemes of web requests. Plain URLs, nearly all of them, are cut by one pattern; the rest go through the
whole parser, whose steps are functions of bound values: so each step is computed once, and none of them is in generated code.

Not covered: hosts go through IDNA 2003 as Java knows it, which writes ss for ß and keeps no joiners; credentials are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The special schemes of the standard with their default ports.
PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21"}

#: What needs no work at all: lower-case scheme and host that ends in a letter, another port, a path without dot segments or escapes of dots, safe characters.
PLAIN = r"^(https?)://((?:[a-z0-9-]+\.)*[a-z](?:[a-z0-9-]*[a-z0-9])?)(?::([1-9][0-9]{0,3}))?((?:/(?!(?:\.|%2[eE]){1,2}(?:[/?]|\z))[A-Za-z0-9\-._~!$&'()*+,;=:@%|\[\]]*)*)(\?[A-Za-z0-9\-._~!$&()*+,;=:@%/?|\[\]{}^`]*)?\z"

# What the standard percent-encodes in paths and in searches of special URLs; everything beyond ASCII is, too.
PATH_UNSAFE = r"[^\x21\x24-\x3b\x3d\x40-\x5d\x5f\x61-\x7a\x7c\x7e]"
SEARCH_UNSAFE = r"[^\x21\x24-\x26\x28-\x3b\x3d\x3f-\x7e]"
# Code points that no domain may hold.
FORBIDDEN = r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]"

DOT = r"^(?i:\.|%2e)\z"
DOTS = r"^(?i:\.|%2e){2}\z"

PARTS = "struct<scheme: string, host: string, port: string, path: string, search: string>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def escaped(text: Column, unsafe: str) -> Column:
    """Characters of a class as UTF-8 percent escapes."""
    each = lambda c: F.when(c.rlike(unsafe), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c)
    return F.when(text.rlike(unsafe), F.array_join(F.transform(F.split(text, ""), each), "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, with `.` and `..` segments carried out."""

    def walked(done: Column, segment: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment.rlike(DOTS), up).when(segment.rlike(DOT), done).otherwise(F.concat(done, F.array(segment)))

    def folded(segments: Column) -> Column:
        last = F.element_at(segments, -1)
        kept = F.aggregate(segments, F.array().cast("array<string>"), walked)
        return F.concat(F.lit("/"), F.array_join(F.when(last.rlike(DOT) | last.rlike(DOTS), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))

    return F.when(path.rlike(r"(?i)/(?:\.|%2e){1,2}(?:/|\z)"), let(F.split(F.substr(path, F.lit(2)), "/", -1), folded)).otherwise(path)


def ipv4(host: Column) -> Column:
    """The dotted form of a host that ends in a number; null if it is no address."""

    def number(part: Column) -> Column:
        digits = lambda start, base: F.when(F.length(part) < start, F.lit("0")).otherwise(F.conv(F.substr(part, F.lit(start)), base, 10)).try_cast("decimal(20,0)")
        short = F.length(F.regexp_replace(part, "^(?i:0x)?0*", "")) <= 11  # longer ones are out of range, and might wrap
        value = F.when(part.rlike(r"^0[xX][0-9a-fA-F]*\z"), digits(3, 16)).when(part.rlike(r"^0[0-7]*\z"), digits(1, 8)).when(part.rlike(r"^[1-9][0-9]*\z"), digits(1, 10))
        return F.when(short, value)

    def address(parts: Column) -> Column:
        n = F.size(parts)
        first = F.slice(parts, 1, F.greatest(n - 1, F.lit(0)))
        ok = (n <= 4) & F.forall(parts, lambda x: x.isNotNull()) & F.forall(first, lambda x: x <= 255) & (F.element_at(parts, -1) < F.pow(F.lit(256.0), 5 - n))
        places = F.transform(first, lambda x, i: x.cast("long") * F.pow(F.lit(256.0), 3 - i).cast("long"))
        whole = F.aggregate(places, F.element_at(parts, -1).cast("long"), lambda a, b: a + b)
        octets = lambda v: F.concat_ws(".", *(F.pmod(F.shiftright(v, k), F.lit(256)) for k in (24, 16, 8, 0)))
        return F.when(F.coalesce(ok, F.lit(False)), let(whole, octets))

    return let(F.transform(F.split(F.regexp_replace(host, r"\.\z", ""), r"\.", -1), number), address)


def ipv6(text: Column) -> Column:
    """The shortest form of an IPv6 address without brackets; null if it is none."""
    pair = lambda a, b: F.lower(F.hex(a.cast("long") * 256 + b.cast("long")))
    octet = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    tail = rf"^(.*:){octet}\.{octet}\.{octet}\.{octet}\z"
    part = lambda n: F.regexp_extract(text, tail, n)
    plain = F.when(text.rlike(tail), F.concat(part(1), pair(part(2), part(3)), F.lit(":"), pair(part(4), part(5)))).otherwise(text)
    groups = lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ":", -1))

    def shortest(all_groups: Column) -> Column:
        bare = F.transform(all_groups, lambda g: F.regexp_replace(F.lower(g), "^0{1,3}(?=.)", ""))
        line = F.concat(F.lit(":"), F.array_join(bare, ":"), F.lit(":"))

        def cut(s: Column) -> Column:
            out = F.when(F.lit(False), s)
            for k in range(8, 1, -1):  # the first of the longest stretches of zeros
                run = ":" + "0:" * k
                out = out.when(F.instr(s, run) > 0, F.regexp_replace(F.concat(F.substring_index(s, run, 1), F.lit("::"), F.substr(s, F.instr(s, run) + len(run))), "^:(?!:)|(?<!:):\\z", ""))
            return out.otherwise(F.regexp_replace(s, r"^:|:\z", ""))

        fine = (F.size(all_groups) == 8) & F.forall(all_groups, lambda g: g.rlike(r"^[0-9a-fA-F]{1,4}\z"))
        return F.when(fine, let(line, cut))

    def expanded(s: Column) -> Column:
        halves = F.split(s, "::", -1)
        left, right = groups(F.get(halves, F.lit(0))), groups(F.get(halves, F.lit(1)))
        gap = 8 - F.size(left) - F.size(right)
        filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), right)
        return F.when(F.size(halves) == 1, groups(s)).when((F.size(halves) == 2) & (gap >= 1), filled)

    return let(plain, lambda s: let(expanded(s), shortest))


def host_of(text: Column) -> Column:
    """A host in its standard form; null if it can't be one."""

    def domain(h: Column) -> Column:
        known = F.lower(F.when(h.rlike(r"[^\x00-\x7f]"), F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), h, F.lit(1))).otherwise(h))
        checked = lambda d: F.when((d != "") & ~d.rlike(FORBIDDEN), F.when(d.rlike(r"(?:^|\.)(?:[0-9]+|0[xX][0-9a-fA-F]*)\.?\z"), ipv4(d)).otherwise(d))
        return let(known, checked)

    decoded = F.when(text.contains("%"), F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).otherwise(text)
    six = F.regexp_extract(text, r"^\[([0-9a-fA-F:.]+)\]\z", 1)
    return F.when(text.startswith("["), F.when(six != "", let(ipv6(six), lambda a: F.when(a.isNotNull(), F.concat(F.lit("["), a, F.lit("]")))))).otherwise(let(decoded, domain))


def _whole(url: Column) -> Column:
    """PARTS of an absolute URL by the standard's steps."""
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+\z", ""), r"[\t\n\r]", "")
    scheme_of = lambda u: F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))

    def split(s: Column) -> Column:
        """s: scheme, authority, rest."""
        place = F.regexp_extract(s["authority"], r"(?s)^(?:.*@)?(.*)\z", 1)
        port = F.regexp_extract(place, r":([0-9]*)\z", 1)
        host = F.regexp_replace(place, r":[0-9]*\z", "")
        number = F.when(port != "", port.try_cast("decimal(38,0)"))
        # Back slashes are slashes in a path. What follows the first # is a fragment.
        address = F.regexp_extract(s["rest"], r"(?s)^[^#]*", 0)
        path = F.translate(F.regexp_extract(address, r"(?s)^[^?]*", 0), "\\", "/")
        search = F.regexp_extract(address, r"(?s)^[^?]*(\?.*)\z", 1)
        known = F.struct(
            s["scheme"].alias("scheme"), host_of(host).alias("host"), F.when(number != default_port(s["scheme"]).cast("decimal(38,0)"), number.cast("string")).alias("port"),
            escaped(without_dots(F.when(path == "", F.lit("/")).otherwise(path)), PATH_UNSAFE).alias("path"),
            F.when(F.length(search) > 1, escaped(search, SEARCH_UNSAFE)).alias("search"),
        )
        ok = (port == "") | F.coalesce(number <= 65_535, F.lit(False))
        return let(known, lambda p: F.when(ok & p["host"].isNotNull(), p))

    def parts(u: Column) -> Column:
        after = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*:[/\\]*", "")
        authority = F.regexp_extract(after, r"(?s)^[^/\\?#]*", 0)
        made = F.struct(scheme_of(u).alias("scheme"), authority.alias("authority"), F.substr(after, F.length(authority) + 1).alias("rest"))
        return F.when(scheme_of(u).isin(list(PORTS)), let(made, split))

    return let(clean, parts)


def default_port(scheme: Column) -> Column:
    return reduce(lambda out, p: out.when(scheme == p[0], p[1]), list(PORTS.items())[1:], F.when(scheme == "http", PORTS["http"]))


def parse_url(url: Column) -> Column:
    """PARTS of an absolute URL of a special scheme: lower-case scheme, host in its standard form, port if it isn't the scheme's own, path,
    search with its `?` (null if empty); null for anything else."""
    # The groups by one pass, with blanks between, which a plain URL can't hold. The condition and the groups are the same expressions
    # throughout, so that they are computed once.
    groups = F.split(F.regexp_replace(url, PLAIN, "$1 $2 $3 $4 $5"), " ", 5)
    plain = lambda n: F.get(groups, F.lit(n - 1))
    absent = lambda c: F.when(c != "", c)
    port = F.when(plain(3) != default_port(plain(1)), absent(plain(3)))
    search = F.when(F.length(plain(5)) > 1, plain(5))
    cut = F.struct(plain(1).alias("scheme"), plain(2).alias("host"), port.alias("port"), F.coalesce(absent(plain(4)), F.lit("/")).alias("path"), search.alias("search"))
    return F.when(url.rlike(PLAIN) & groups.isNotNull(), cut).otherwise(_whole(url)).cast(PARTS)


def resolve(target: Column, scheme: Column, host: Column) -> Column:
    """The absolute URL of a request target on a host: its own if it has a scheme, one with the base's scheme after two slashes, else a path of the host."""
    own = F.concat(scheme, F.lit("://"), host)
    return (
        F.when(target.rlike(r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.-]*:"), target).when(target.rlike(r"^[\x00-\x20]*[/\\]{2}"), F.concat(scheme, F.lit(":"), F.regexp_replace(target, r"^[\x00-\x20]+", "")))
        .otherwise(F.concat(own, F.when(~target.rlike(r"^[\x00-\x20]*[/\\?#]"), "/").otherwise(""), F.regexp_replace(target, r"^[\x00-\x20]+", "")))
    )


def authority(parts: Column) -> Column:
    return F.concat(parts["host"], F.coalesce(F.concat(F.lit(":"), parts["port"]), F.lit("")))
