"""Binary ↔ text and binary ↔ decimal expressions (FN-10, FN-11, FN-12).

All are built-in Spark expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_64 = "18446744073709551616"


def decode_utf8(b: Column) -> Column:
    """Bytes → text; invalid UTF-8 sequences become U+FFFD; null stays null (FN-11)."""
    return F.make_valid_utf8(b.cast("string"))


def encode_utf8(s: Column) -> Column:
    """Text → UTF-8 bytes (FN-10)."""
    return F.encode(s, "UTF-8")


def be_bytes_to_decimal(b: Column, scale: int = 9, precision: int = 38, mode: str = "strict") -> Column:
    """Big-endian two's-complement bytes of any length → decimal with ``scale`` (FN-12).

    The bytes are brought to 16, sign digits in front added or, beyond 16, dropped if they
    are nothing else. Their signed upper and unsigned lower half give the number exactly, and
    an exponent places the decimal point, so no digit is
    rounded. Empty bytes, and numbers that need more than ``precision`` digits,
    raise in strict mode and give null in permissive mode; null stays null.
    """
    h, size = F.hex(b), F.octet_length(b)
    negative = F.substring(b, 1, 1) >= F.lit(bytes([0x80]))
    fill = F.when(negative, F.lit("F")).otherwise(F.lit("0"))
    kept = F.right(h, F.lit(32))
    only_sign = (F.ltrim(F.substr(h, F.lit(1), 2 * size - 32), fill) == "") & ((F.substring(kept, 1, 1) >= F.lit("8")) == negative)
    wide = F.when((size > 0) & (size <= 16), F.lpad(h, F.lit(32), fill)).when((size > 16) & only_sign, kept)
    # of a negative number the upper half is taken one higher and the lower one 2^64 less, so no
    # step goes beyond the number itself
    two_64, one = F.lit(_TWO_64).cast("decimal(20,0)"), F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("decimal(20,0)") + one
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)") - one * two_64
    value = _placed(F.try_add(F.try_multiply(high, two_64), low), precision, scale)
    if mode == "permissive":
        return value
    message = F.concat(F.lit("bytes are no decimal of the declared precision: '"), h, F.lit("'"))
    return F.coalesce(value, F.when(b.isNotNull(), F.raise_error(message)))


def _placed(unscaled: Column, precision: int, scale: int) -> Column:
    """``unscaled * 10^-scale`` exactly; null where it has more digits."""
    return F.concat(unscaled.cast("string"), F.lit(f"E-{scale}")).try_cast(f"decimal({precision},{scale})")


def unscaled_to_decimal(unscaled: Column, scale: int = 9, precision: int = 38) -> Column:
    """Integer ``unscaled`` → ``unscaled * 10^-scale`` as ``decimal(precision, scale)``,
    exactly; null where it has more digits."""
    return _placed(unscaled, precision, scale)


def long_to_be_bytes(n: Column) -> Column:
    """bigint → minimal big-endian two's-complement bytes (the form a decimal's
    unscaled value takes in a binary column)."""
    h = F.hex(n)  # negative values come as 16 hex digits, sign-extended
    even = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    positive = F.when(F.substring(even, 1, 1).isin(*"89ABCDEF"), F.concat(F.lit("00"), even)).otherwise(even)
    negative = F.regexp_replace(h, "^(FF)+(?=[89A-F])", "")
    return F.unhex(F.when(n < 0, negative).otherwise(positive))
