"""Words, numbers and addresses in hex-encoded log data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bare_hex(text: Column) -> Column:
    """Lower-case digits without 0x; NULL unless they spell whole bytes."""
    digits = F.regexp_replace(F.lower(F.coalesce(text, F.lit("0x"))), "^0x", "")
    return F.when(~digits.rlike("[^0-9a-f]") & (F.char_length(digits) % 2 == 0), digits)


def quantity(text: Column) -> Column:
    """A 0x-prefixed number below 2^60 as bigint."""
    digits = F.regexp_replace(F.lower(text), "^0x", "")
    return F.when(digits.rlike("^0*[0-9a-f]{1,15}$"),
                  F.conv(F.right(digits, F.lit(15)), 16, 10).cast("bigint"))


def word_at(digits: Column, byte_offset: Column) -> Column:
    """32 bytes from a byte offset, NULL where the data ends too early."""
    word = F.substr(digits, byte_offset.cast("int") * 2 + 1, F.lit(64))
    return F.when(F.char_length(word) == 64, word)


def small_number(word: Column) -> Column:
    """A word as bigint, NULL if it needs more than 60 bits."""
    return F.when(word.startswith("0" * 49), F.conv(F.right(word, F.lit(15)), 16, 10)
                  .cast("bigint"))


def topic_word(topic: Column) -> Column:
    """A topic as 64 lower-case digits; NULL if it is not a number of at most 256 bits."""
    digits = F.regexp_replace(F.lower(topic), "^0x", "")
    return F.when(digits.rlike("^[0-9a-f]{1,64}$"), F.lpad(digits, 64, "0"))


def topic_address(topic: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.right(topic, F.lit(40))))


def decimal_text(word: str) -> Column:
    """
    The 256-bit number in a 64-digit column as decimal text.

    Ids that fit 60 bits, nearly all of them, take one conversion. Larger ones exceed every
    numeric type, so their eight 32-bit limbs are divided by 10^9 nine times over; the
    remainders are the decimal digits from the right.
    """
    small = F.conv(F.right(F.col(word), F.lit(15)), 16, 10)
    wide = F.expr(f"""
        ltrim('0', aggregate(
            sequence(1, 9),
            named_struct(
                'limbs', transform(sequence(0, 7), i ->
                    CAST(conv(substr({word}, 8 * i + 1, 8), 16, 10) AS BIGINT)),
                'digits', ''),
            (acc, step) -> named_struct(
                'limbs', transform(
                    aggregate(acc.limbs,
                        named_struct('rest', 0L, 'quotient', CAST(array() AS ARRAY<BIGINT>)),
                        (a, limb) -> named_struct(
                            'rest', (a.rest * 4294967296L + limb) % 1000000000L,
                            'quotient', concat(a.quotient,
                                array((a.rest * 4294967296L + limb) div 1000000000L)))
                    ).quotient, q -> q),
                'digits', concat(
                    lpad(CAST(aggregate(acc.limbs, 0L,
                        (rest, limb) -> (rest * 4294967296L + limb) % 1000000000L) AS STRING),
                        9, '0'),
                    acc.digits)),
            acc -> acc.digits))
    """)
    return F.when(F.col(word).startswith("0" * 49), small).otherwise(wide)


def utf8_lenient(payload_digits: Column) -> Column:
    """Bytes as text, each bad sequence replaced."""
    return F.make_valid_utf8(F.unhex(payload_digits).cast("string"))


def text_or_hex(payload_digits: Column) -> Column:
    """Printable UTF-8 as text, everything else, the empty value too, as 0x-hex."""
    text = F.unhex(payload_digits).cast("string")
    printable = F.is_valid_utf8(text) & (text != "") & ~text.rlike(r"[\p{C}\p{Z}&&[^ ]]")
    return F.when(printable, text).otherwise(F.concat(F.lit("0x"), payload_digits))
