"""Bitmaps of hashes: which rows of a large side can meet a smaller one, in a fixed number of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One MB of bits, whatever the data. Fuller bitmaps let more rows pass, never fewer than must.
BITS = 1 << 23


class Marks:
    """The marked bits of a column of longs, 64 to a row of at most ``BITS / 64`` rows. Built by partial aggregation,
    broadcast, and tested without leaving the JVM."""

    def __init__(self, df: DataFrame, column: str):
        at = F.pmod(F.col(column), F.lit(BITS))
        x = df.filter(F.col(column).isNotNull()).select(at.alias("at"))
        self.rows = x.groupBy(F.floor(F.col("at") / 64).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("_bits"))

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """The rows whose value is marked."""
        x = df.withColumn("_word", F.floor(F.pmod(F.col(column), F.lit(BITS)) / 64))
        x = x.join(F.broadcast(self.rows), "_word")
        bit = F.getbit(F.col("_bits"), F.pmod(F.col(column), F.lit(64)))
        return x.filter(bit == 1).drop("_word", "_bits")
