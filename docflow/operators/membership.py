"""A filter of fixed size that knows which keys a table surely does not hold.

A Bloom filter made of Spark's bitmap aggregates: every key sets a few bits, chosen by
hashes; tasks merge bitmaps of 32,768 bits before anything is shuffled, so what is moved
and what is broadcast (at most ``MAX_BITS`` bits, whatever the table's size) depends on
the filter's size alone. A row whose key has a bit that is not set has no match for sure
and need not be shuffled to a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: 16 MB; at 10 bits a key that is some 13 million keys, beyond it more rows pass than need to.
MAX_BITS = 1 << 27
_PAGE, _HASHES, _BITS_PER_KEY = 1 << 15, 4, 10
#: With more of its bits set than this a filter holds back too few rows to pay.
FULLEST = 0.6


def _places(key: Column, bits: int) -> list[Column]:
    """The bits of a key, from 1."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) + 1 for i in range(_HASHES)]


class KeyFilter:
    """``may_hold(column)`` is false only for keys that the table does not hold."""

    def __init__(self, pages: DataFrame, bits: int, share: float):
        self.bits, self.share = bits, share
        self._pages = pages

    def may_hold(self, key: Column) -> Column:
        """A null key is held by no table."""
        held = self._pages.select("bits").scalar()
        found = F.lit(True)
        for place in _places(key, self.bits):
            byte = F.conv(F.hex(F.substring(held, F.floor((place - 1) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, ((place - 1) % 8).cast("int")) == 1)
        return key.isNotNull() & found


def key_filter(keys: DataFrame, key: str, rows: int, *, max_bits: int = MAX_BITS) -> KeyFilter | None:
    """The filter of the column ``key`` of about ``rows`` keys; None if it would be too full."""
    bits = _PAGE
    while bits < rows * _BITS_PER_KEY and bits < max_bits:
        bits *= 2
    place = keys.select(F.explode(F.array(*_places(F.col(f"`{key}`"), bits))).alias("place"))
    pages = place.groupBy(F.bitmap_bucket_number("place").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    held, count = bytearray(bits // 8), 0
    for row in pages.select("page", "bitmap", F.bitmap_count("bitmap").alias("n")).collect():  # bits / 8 bytes at most
        at = (row["page"] - 1) * (_PAGE // 8)
        held[at : at + _PAGE // 8] = row["bitmap"]
        count += row["n"]
    if count > FULLEST * bits:
        return None
    spark = keys.sparkSession
    return KeyFilter(materialize(spark.createDataFrame([(bytes(held),)], "bits binary"), "key-filter"), bits, count / bits)
