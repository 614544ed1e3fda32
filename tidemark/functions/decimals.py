"""Variable-scale decimals: ``struct<scale int, value string>``.

``value`` is the base64 text of the unscaled integer as big-endian
two's-complement bytes.  Everything here is a built-in column expression.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 16  # hex digits in 64 bits
_WIDE = "decimal(38,0)"


def encode_scaled_decimal(unscaled: Column, scale: int) -> Column:
    """Pack a bigint of ``10^-scale`` units in as few bytes as hold its sign."""
    digits = F.hex(unscaled.cast("bigint"))
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    positive = F.when(even.rlike("^[89A-F]"), F.concat(F.lit("00"), even)).otherwise(even)
    # All negative bigints show as 16 digits; a leading FF byte is spare while
    # the byte after it still carries the sign.
    negative = F.regexp_replace(digits, "^(?:FF)+(?=[89A-F])", "")
    payload = F.base64(F.unhex(F.when(unscaled < 0, negative).otherwise(positive)))
    return F.when(
        unscaled.isNotNull(),
        F.struct(F.lit(scale).cast("int").alias("scale"), payload.alias("value")),
    )


def decode_scaled_decimal(packed: Column, scale: int = 10) -> Column:
    """The value as ``decimal(38, scale)``; NULL if it does not fit.

    Takes up to 16 bytes.  Digits beyond ``scale`` are rounded half up.
    """
    data = F.try_to_binary(packed["value"], F.lit("base64"))
    digits, size = F.hex(data), F.octet_length(data)
    negative = digits.rlike("^[89A-F]")
    low = _unsigned(F.right(digits, F.lit(_WORD)))
    high = _unsigned(F.left(digits, F.greatest(F.length(digits) - _WORD, F.lit(0))))

    long = F.try_add(
        F.try_multiply(_signed(high, size - 8, negative), F.lit(Decimal(2**64))), low
    )
    unscaled = F.when(size.between(1, 8), _signed(low, size, negative).cast(_WIDE)).when(
        size.between(9, 16), long.try_cast(_WIDE)
    )
    # Exponent text keeps the shift exact for every per-row scale.
    shifted = F.concat(unscaled.cast("string"), F.lit("E"), (-packed["scale"]).cast("string"))
    return shifted.try_cast(f"decimal(38,{scale})")


def _unsigned(hex_digits: Column) -> Column:
    """At most 16 hex digits as a non-negative decimal."""
    return F.conv(hex_digits, 16, 10).cast("decimal(20,0)")


def _signed(unsigned: Column, size: Column, negative: Column) -> Column:
    """The two's-complement reading of ``size`` bytes (1 to 8)."""
    ranges = F.array(*[F.lit(Decimal(256**n)).cast("decimal(20,0)") for n in range(1, 9)])
    return unsigned - F.when(negative, F.get(ranges, size - 1)).otherwise(
        F.lit(0).cast("decimal(20,0)")
    )
