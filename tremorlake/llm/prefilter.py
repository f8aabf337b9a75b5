"""Keeps rows that cannot find a partner out of a shuffle join.

The keys of the smaller side are hashed into a bitmap of ``BITS`` bits, whatever their number, which is broadcast: 256 rows of
4 KB. A row whose bit is not set has no partner for certain. The others are joined exactly, so false hits cost
work, never results; with very many keys the bitmap fills up and the join is as large as without it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
_PART = 32_768


def split(rows: DataFrame, key: Column, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have a partner and those that have none, by a long key; ``wanted`` is one column of keys."""
    place = F.pmod(F.xxhash64(F.lit("prefilter"), wanted[wanted.columns[0]]), F.lit(BITS))
    bits = wanted.select(place.alias("p")).groupBy(F.floor(F.col("p") / _PART).alias("__part")).agg(
        F.bitmap_construct_agg(F.col("p") % _PART).alias("__bits"))
    placed = rows.withColumn("__place", F.pmod(F.xxhash64(F.lit("prefilter"), key), F.lit(BITS)))
    met = placed.join(F.broadcast(bits), F.floor(F.col("__place") / _PART) == F.col("__part"), "left")
    byte = "cast(conv(hex(substring(__bits, cast(__place % 32768 div 8 + 1 AS int), 1)), 16, 10) AS int)"
    may = F.expr(f"coalesce(bit_get({byte}, cast(__place % 8 AS int)) = 1, false)")
    return tuple(met.filter(choice).drop("__place", "__part", "__bits") for choice in (may, ~may))
