"""ABI payloads: splitting hex into 32-byte words and reading them.

All of it is built-in column arithmetic, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = 64  # hex characters in 32 bytes
TWO_64 = "18446744073709551616"


def words(payload: Column) -> Column:
    """``0x``-prefixed hex to an array of 64-character words (a short tail is dropped)."""
    return F.regexp_extract_all(F.substring(payload, 3, 2147483647), F.lit(".{64}"), F.lit(0))


def word_at(ws: Column, i: int) -> Column:
    return F.get(ws, F.lit(i))


def _half(hex16: Column) -> Column:
    return F.conv(hex16, 16, 10).cast("decimal(20,0)")


def to_number(word: Column) -> Column:
    """A 32-byte word as decimal(38,0); NULL when malformed or wider than 38 digits.

    One pattern checks the digits and that the upper 128 bits are zero. The two
    64-bit halves below are joined with overflow turning into NULL.
    """
    readable = word.rlike("^0{32}[0-9a-fA-F]{32}$")
    high = F.try_multiply(_half(F.substring(word, 33, 16)), F.lit(TWO_64).cast("decimal(20,0)"))
    return F.when(readable, F.try_add(high, _half(F.substring(word, 49, 16))))


def to_address(word: Column) -> Column:
    """The low 20 bytes of a word."""
    return F.concat(F.lit("0x"), F.substring(word, 25, 40))


def dynamic_bytes(payload: Column, offset: Column) -> Column:
    """A dynamic ``bytes`` field found through its byte offset; NULL when empty."""
    body = F.substring(payload, 3, 2147483647)
    start = (offset * 2).try_cast("int")
    length = (to_number(F.substr(body, start + 1, F.lit(WORD))) * 2).try_cast("int")
    return F.when(
        length > 0, F.concat(F.lit("0x"), F.substr(body, start + 1 + WORD, length))
    )


def int_word(n: Column) -> Column:
    """A non-negative integer as a 32-byte hex word."""
    return F.lpad(F.lower(F.hex(n.cast("bigint"))), WORD, "0")


def address_word(address: Column) -> Column:
    """An address left-padded to a 32-byte word.

    Leading ``0`` and ``x`` characters are all trimmed first; the padding puts
    the zeros back.
    """
    return F.lpad(F.ltrim(address, F.lit("0x")), WORD, "0")


def block_hex(n: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(n.cast("bigint"))))
