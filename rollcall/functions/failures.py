"""Names for what went wrong. Kept apart from the pass or fail flags on purpose."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollcall.constants import HTTP_CATEGORIES, THROTTLED_CATEGORIES


def http_category(status: Column) -> Column:
    pairs = ", ".join(f"{code}, '{name}'" for code, name in HTTP_CATEGORIES.items())
    named = F.try_element_at(F.expr(f"map({pairs})"), status.cast("int"))
    code = status.cast("string")
    by_class = (
        F.when((status >= 300) & (status < 400), F.concat(F.lit("http_"), code, F.lit("_redirect")))
        .when((status >= 400) & (status < 500),
              F.concat(F.lit("http_"), code, F.lit("_client_error")))
        .when(status >= 500, F.concat(F.lit("http_"), code, F.lit("_server_error")))
        .otherwise(F.concat(F.lit("http_"), code))
    )
    return F.coalesce(named, by_class)


def error_category(error_class: Column, message: Column) -> Column:
    """Category of a transport error from its class name and message."""
    text = F.lower(F.coalesce(message, F.lit("")))
    mentions = lambda *words: F.greatest(*[text.contains(w) for w in words]) \
        if len(words) > 1 else text.contains(words[0])
    resolving = mentions("name or service not known", "getaddrinfo", "nodename nor servname",
                         "name resolution")
    return (
        F.when(error_class == "ConnectTimeout", "timeout_connect")
        .when(error_class == "ReadTimeout", "timeout_read")
        .when(error_class == "PoolTimeout", "timeout_pool")
        .when(error_class.isin("WriteTimeout", "TimeoutException"), "timeout_other")
        .when(error_class == "ConnectError",
              F.when(resolving, "dns_failure")
              .when(mentions("certificate", "ssl", "tls"), "tls_failure")
              .otherwise("connect_failure"))
        .when(F.lower(error_class).contains("ssl") | text.contains("certificate"), "tls_failure")
        .when(error_class == "TooManyRedirects", "too_many_redirects")
        .when(error_class == "RemoteProtocolError", "protocol_error")
        .when(error_class == "UnsupportedProtocol", "unsupported_scheme")
        .when(error_class.isin("UnicodeError", "UnicodeEncodeError", "UnicodeDecodeError",
                               "UnicodeTranslateError"), "bad_hostname")
        .when(error_class.isNotNull(), F.concat(F.lit("transport_"), F.lower(error_class)))
    )


def looks_throttled(live_strict: Column, category: Column, endpoint_details: Column) -> Column:
    """
    Did the result turn on our access rather than on the agent?

    With every endpoint dead, a single 403 or 429 among them is enough.
    """
    refused = F.exists(F.coalesce(endpoint_details, F.array()),
                       lambda e: F.coalesce(e["status"].isin("403", "429"), F.lit(False)))
    named = F.coalesce(category.isin(*THROTTLED_CATEGORIES), F.lit(False))
    return ~live_strict & (named | (F.coalesce(category == "all_endpoints_dead", F.lit(False))
                                    & refused))
