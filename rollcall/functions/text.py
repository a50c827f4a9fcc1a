"""Small text and number expressions shared by the other modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as the fetched documents' reader sees it: Unicode blanks and the four
# separator controls.
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """
    The text without blanks around it.

    Only a text that begins or ends with one is searched: in long texts, as URIs that hold a whole
    document, that costs far more than a look at both ends.
    """
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return F.when(ends.rlike(f"(?U){_BLANK}"), F.regexp_replace(
        text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")).otherwise(text)


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def round_half_up(value: Column, digits: int = 2) -> Column:
    """floor(x * 10^d + 0.5) / 10^d: the same tie rule in every engine."""
    scale = 10 ** digits
    return F.floor(value * F.lit(float(scale)) + F.lit(0.5)) / F.lit(float(scale))


def month(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM")


def iso(timestamp: Column) -> Column:
    """ISO text with a UTC offset, microseconds only when there are any."""
    whole = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(timestamp, "SSSSSS")
    return F.when(
        timestamp.isNotNull(),
        F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
                 F.lit("+00:00")))


def truthy(text: Column) -> Column:
    """The spellings of true that the study's CSV files may hold."""
    return F.coalesce(F.lower(strip(text.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def without_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\u0000"), F.lit(""))


def has_nul(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("\u0000")), F.lit(False))


def percent_decode(text: Column) -> Column:
    """Percent-decoding where '+' is a plus sign and a malformed escape stays as it is."""
    plus_kept = F.replace(text, F.lit("+"), F.lit("%2B"))
    stray_kept = F.regexp_replace(plus_kept, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(stray_kept), text)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)
