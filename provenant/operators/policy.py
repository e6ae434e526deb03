"""URL policy, host and address rules, and log hygiene as column expressions. The first failing rule decides."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reasons a URL is refused for.
SCOPE, HOST, SCHEME, WRAPPER = "MANIFEST_SCOPE_MISMATCH", "HOST_NOT_ALLOWED", "SCHEME_NOT_HTTPS", "VIEWER_WRAPPER_URL"
OFF_ALLOWLIST = "REDIRECT_OFF_ALLOWLIST"

# Address ranges that are never fetched.
BLOCKED_V4 = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
    "192.88.99.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4", "255.255.255.255/32",
)


# Address ranges of version 6 that are never fetched; an address of version 4 inside one of version 6 is none.
BLOCKED_V6 = ("::/96", "::ffff:0:0/96", "64:ff9b::/96", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "fc00::/7", "fe80::/10", "fec0::/10", "ff00::/8")


def url_parts(url: Column) -> dict[str, Column]:
    """Authority, path and query of an https URL (fragment dropped); empty strings where absent."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)", 1)
    authority = F.regexp_extract(rest, r"^([^/?]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    return {"authority": authority, "path": F.when(path == "", "/").otherwise(path), "query": F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)}


def host_of(authority: Column) -> Column:
    """Lower case, port and trailing dots removed."""
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r":[0-9]*$", ""), r"\.+$", ""))


def ascii_host(host: Column) -> Column:
    """A host in its ASCII form (IDNA of 2003); one without such a form is empty. The JVM's own function makes it."""
    form = F.lower(F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host))
    return F.when(host.rlike(r"[^\x00-\x7f]"), F.coalesce(form, F.lit(""))).otherwise(host)


def ip_literal(host: Column) -> Column:
    """Any spelling of an address: v6, dotted, decimal, octal, hexadecimal, short."""
    part = r"(0[xX][0-9a-fA-F]*|[0-9]+)"
    return host.contains(":") | host.rlike(rf"^{part}(\.{part}){{0,3}}$")


def prefix_allows(path: Column, prefixes: list[str]) -> Column:
    tests = [path.startswith(p) if p.endswith("/") else (path == p) | path.startswith(p + "/") for p in prefixes]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def url_reason(url: Column, allowed_hosts: list[str], prefixes: list[str], max_length: int, listing_urls: list[str] | None = None) -> Column:
    """Null for an admissible URL, else the reason of the first rule that refuses it.

    Give ``listing_urls`` for the listing purpose: then the normalised URL must be one of them; otherwise no query.
    """
    p = url_parts(url)
    host, path, query = ascii_host(host_of(p["authority"])), p["path"], p["query"]
    decoded = F.try_url_decode(F.regexp_replace(path, r"\+", "%2B"))
    port = F.regexp_extract(p["authority"], r":([^:]*)$", 1)
    bad_port = p["authority"].contains(":") & (port != "") & ~F.coalesce(port.rlike("^0*443$"), F.lit(False))
    last = (~normalised_url(url).isin(listing_urls)) if listing_urls is not None else (query != "")
    return (
        F.when(url.isNull() | (url == ""), SCOPE)
        .when(F.length(url) > max_length, SCOPE)
        .when(url.rlike(r"[\x00-\x20\x7f-\x9f\\]"), SCOPE)
        .when(~F.lower(url).startswith("https://"), SCHEME)
        .when(p["authority"].contains("@") | bad_port | (host == "") | ip_literal(host) | ~host.isin(allowed_hosts), HOST)
        .when(path.rlike("^/web/?$") & query.contains("file="), WRAPPER)
        .when(path.rlike(r"[^\x00-\x7f]") | path.rlike("(?i)%(2f|5c|00|25)"), SCOPE)
        .when(decoded.isNotNull() & (decoded.rlike(r"[\x00-\x1f\x7f\\]") | decoded.rlike(r"(^|/)\.\.?(/|$)")), SCOPE)
        .when(path.contains("//"), SCOPE)
        .when(~prefix_allows(path, prefixes), SCOPE)
        .when(last, SCOPE)
    )


def normalised_url(url: Column) -> Column:
    p = url_parts(url)
    return F.concat(F.lit("https://"), host_of(p["authority"]), p["path"], F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""))


def redirect_reason(reason: Column, hop: Column) -> Column:
    """Past the first hop every refusal but that of the scheme is one off the allow-list."""
    return F.when((hop > 0) & reason.isNotNull() & (reason != SCHEME), OFF_ALLOWLIST).otherwise(reason)


def v4_number(address: Column) -> Column:
    parts = F.split(address, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x.try_cast("long"))
    valid = address.rlike(r"\A(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}\z") & F.forall(parts, lambda x: x.try_cast("int") <= 255)
    return F.when(valid, number)


def public_v4(address: Column) -> Column:
    """Whether a dotted address is outside every blocked range; false for anything else."""
    n = v4_number(address)
    blocked = F.lit(False)
    for cidr in BLOCKED_V4:
        net = ipaddress.ip_network(cidr)
        blocked = blocked | n.between(int(net.network_address), int(net.broadcast_address))
    return F.coalesce(n.isNotNull() & ~blocked, F.lit(False))


def is_public(text: str | None) -> bool:
    """Whether an address of either version is globally routable and outside every blocked range."""
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return False
    blocked = BLOCKED_V4 if address.version == 4 else BLOCKED_V6
    return "%" not in text and address.is_global and not any(address in ipaddress.ip_network(n) for n in blocked)


@F.pandas_udf(T.BooleanType())
def public_address(addresses: pd.Series) -> pd.Series:
    return addresses.map(is_public, na_action="ignore").fillna(False).astype(bool)


@F.pandas_udf(T.BooleanType())
def all_public(answers: pd.Series) -> pd.Series:
    return pd.Series([rows is not None and len(rows) > 0 and all(x is not None and is_public(x) for x in rows) for rows in answers], dtype=bool)


def answers_public(answers: Column) -> Column:
    """An answer set, each address once and in order, passes when it has members and all of them pass."""
    return all_public(F.array_distinct(answers))


def neutralised(value: Column, max_length: int, secrets: list[str] | None = None) -> Column:
    """Safe for one log line: secrets redacted, control characters escaped, cut to ``max_length`` with an ellipsis."""
    for secret in secrets or []:
        if secret:
            value = F.replace(value, F.lit(secret), F.lit("[REDACTED]"))
    code = lambda c: F.when(F.ascii(c) < 256, F.concat(F.lit("\\x"), F.lpad(F.lower(F.hex(F.ascii(c))), 2, "0"))).otherwise(F.concat(F.lit("\\u"), F.lower(F.hex(F.ascii(c)))))
    risky = r"[\x00-\x1f\x7f-\x9f\u2028\u2029]"
    escaped = F.array_join(F.transform(F.split(value, ""), lambda c: F.when(c.rlike(risky), code(c)).otherwise(c)), "")
    out = F.when(value.rlike(risky), escaped).otherwise(value)
    return F.when(F.length(out) <= max_length, out).otherwise(F.concat(F.substring(out, 1, max_length - 1), F.lit("…")))


def log_url(url: Column) -> Column:
    """scheme://host/path and nothing else."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    p = url_parts(url)
    host = host_of(F.regexp_replace(p["authority"], "^.*@", ""))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(scheme == "", F.lit("[unparseable-url]")).otherwise(F.concat(scheme, F.lit("://"), host, path))


def safe_headers(headers: Column, max_length: int = 300, secrets: list[str] | None = None) -> Column:
    """Allowed headers only, with lower-case keys in order and values safe for a log. Of keys that differ in case the first stays."""
    allowed = [F.lit(h) for h in LOGGED_HEADERS]
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), neutralised(e["value"], max_length, secrets).alias("value")))
    ordered = F.array_sort(F.filter(pairs, lambda e: F.array_contains(F.array(*allowed), e["key"])))
    return F.map_from_entries(F.filter(ordered, lambda e, i: (i == 0) | (F.get(ordered, i - 1)["key"] != e["key"])))


# The headers that may be logged.
LOGGED_HEADERS = ("content-encoding", "content-length", "content-type", "etag", "last-modified", "location", "retry-after")
