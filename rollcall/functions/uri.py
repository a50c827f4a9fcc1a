"""URIs and host names as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rollcall.constants import BUCKET_SUFFIXES, GATEWAYS, GENERIC_HOSTS, SHARED_HOSTS, \
    TWO_LABEL_SUFFIXES
from rollcall.functions.text import percent_decode, strip


def _any_of(names: Sequence[str]) -> str:
    return "|".join(re.escape(name) for name in names)


def clean_uri(uri: Column) -> Column:
    return strip(F.coalesce(uri, F.lit("")))


def uri_scheme(clean: Column) -> Column:
    """Scheme of an already cleaned URI. Prefixes ignore case, content ids do not."""
    low = F.lower(clean)
    content_id = (F.char_length(clean) > 40) & clean.rlike("^(Qm|bafy|bafk)")
    return (
        F.when(clean == "", "empty")
        .when(low.startswith("https://"), "https")
        .when(low.startswith("http://"), "http")
        .when(low.startswith("ipfs://"), "ipfs")
        .when(low.startswith("data:"), "data")
        .when(low.startswith("ar://"), "arweave")
        .when(low.startswith("/ipfs/") | content_id, "ipfs")
        .otherwise("other")
    )


def gateway_urls(clean: Column, gateways: Sequence[str] = GATEWAYS,
                 unwrap_scheme_path: bool = True) -> Column:
    """
    The URLs a content id is fetched from, in the order they are tried.

    The study leaves the path of an ipfs:// URI alone (unwrap_scheme_path=False); the
    monitor also removes a leading ipfs/ from it.
    """
    has_scheme = F.lower(clean).startswith("ipfs://")
    path = F.when(has_scheme, F.substring(clean, 8, 2147483647)) \
        .otherwise(F.regexp_replace(clean, "^/+", ""))
    unwrapped = F.regexp_replace(path, "^ipfs/", "")
    if not unwrap_scheme_path:
        unwrapped = F.when(has_scheme, path).otherwise(unwrapped)
    content = F.regexp_replace(unwrapped, "^/+", "")
    return F.transform(F.array(*[F.lit(g) for g in gateways]), lambda g: F.concat(g, content))


def data_uri_parts(clean: Column, keep_parameters: bool = False) -> Column:
    """
    Struct(text, content_type) of an inline document; text is NULL when it cannot be decoded.
    """
    comma = F.instr(clean, ",")
    head = F.when(comma > 0, F.substring_index(clean, ",", 1)).otherwise(clean)
    payload = F.when(comma > 0, F.substr(clean, comma + 1)).otherwise(F.lit(""))
    meta = F.substring(head, 6, 2147483647)
    in_base64 = meta.endswith(";base64")
    declared = F.when(in_base64, F.substr(meta, F.lit(1), F.char_length(meta) - 7)).otherwise(meta)
    if not keep_parameters:
        declared = F.substring_index(declared, ";", 1)
    letters = F.regexp_replace(payload, "[^A-Za-z0-9+/]", "")
    decoded = F.make_valid_utf8(F.try_to_binary(letters, F.lit("base64")).cast("string"))
    text = F.when(in_base64, F.when(letters == "", "").otherwise(decoded)) \
        .otherwise(percent_decode(payload))
    kind = F.when(declared == "", "text/plain").otherwise(declared)
    return F.struct(text.alias("text"), kind.alias("content_type"))


def host_of(url: Column) -> Column:
    """
    Lower-case host without user, port and trailing dots; '' if there is none.

    A regex rather than parse_url: hosts in the wild hold underscores, upper case and paths
    with blanks, which the URI class rejects.
    """
    netloc = F.regexp_extract(
        url, r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    after_user = F.regexp_extract(netloc, "^(?:.*@)?(.*)$", 1)
    plain = F.regexp_extract(after_user, "^([^:]*)", 1)
    bracketed = F.regexp_extract(after_user, r"\[([^\]]*)\]", 1)
    host = F.when(after_user.contains("["), bracketed).otherwise(plain)
    return F.coalesce(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def is_bucket_host(host: Column) -> Column:
    """Object storage and CDNs, where the leftmost label is the tenant."""
    low = F.rtrim(F.lower(F.coalesce(host, F.lit(""))), F.lit("."))
    return low.rlike(r"\.s3(?:\.|[.-].*\.)amazonaws\.com\z|\.(?:" + _any_of(BUCKET_SUFFIXES) + r")\z")


def registrable_domain(host: Column) -> Column:
    """Approximate registrable domain: good enough for grouping, no suffix list needed."""
    low = F.btrim(F.lower(F.coalesce(host, F.lit(""))), F.lit("."))
    labels = F.split(low, r"\.")
    last_two = F.substring_index(low, ".", -2)
    third = F.element_at(labels, -3)
    return (
        F.when((low == "") | low.rlike("^[0-9.]+$") | (F.size(labels) <= 2), low)
        .when(is_bucket_host(low), low)
        .when(last_two.rlike("^(?:" + _any_of(TWO_LABEL_SUFFIXES) + r")\z"),
              F.when(third == "", last_two).otherwise(F.concat_ws(".", third, last_two)))
        .otherwise(last_two)
    )


def dot_suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]: turns 'equal to or below' into plain equality."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    return F.transform(F.sequence(F.lit(1), count),
                       lambda i: F.array_join(F.slice(labels, i, count), "."))


def _normal_host(value: Column) -> Column:
    return F.rtrim(strip(F.lower(F.coalesce(value, F.lit("")))), F.lit("."))


def is_or_is_below(value: Column, names: Sequence[str]) -> Column:
    """
    True if the host is one of the names or a subdomain of one.

    One anchored pattern: the host is computed once and the test stays in generated code.
    """
    return _normal_host(value).rlike(r"(?:^|\.)(?:" + _any_of(names) + r")\z")


def is_generic_host(host: Column) -> Column:
    return is_or_is_below(host, GENERIC_HOSTS)


def is_shared_hosting(domain: Column) -> Column:
    return is_or_is_below(domain, SHARED_HOSTS)
