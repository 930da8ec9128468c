"""Lookups of a large table in a dimension (M18, J3, J5): no shuffle of the large side while the dimension is small.

The caller counts the dimension's rows, so its size is known and not guessed. Up to ``BROADCAST_BYTES`` it is broadcast. Beyond, both sides are dealt
by (key, salt), so a key that holds a third of all rows is spread over ``SALTS`` tasks; rows whose key is null match
nothing and are dealt by their own hash. Spark's own estimate knows neither the copies nor the length of texts and lists, so there a
merge join is asked for: else it may still broadcast all copies through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
SALTS = 32


def left_lookup(rows: DataFrame, table: DataFrame, key: str, size: int, spread_by: Sequence[str],
                broadcast_bytes: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row a ``key``. Every row of ``rows`` stays, null keys too.

    ``size`` is the table's size in bytes, from a count of its rows; ``spread_by`` names columns of ``rows`` that tell the rows of
    a hot key apart. ``broadcast_bytes`` defaults to the module's limit."""
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if size <= limit:
        return rows.join(F.broadcast(table), key, "left")
    own = F.xxhash64(*spread_by)
    salted = rows.withColumn("_salt", F.when(F.col(key).isNull(), own).otherwise(F.pmod(own, F.lit(SALTS))))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies.hint("merge"), [key, "_salt"], "left").drop("_salt")


def latest_before(states: Column, field: str, cutoff: Column) -> Column:
    """The last element of ``states`` (ascending by ``field``) whose ``field`` lies before ``cutoff``, by binary search.

    Null where there is none, and where the array or the cutoff is null."""
    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_, right = s["lo"] < s["hi"], F.get(states, mid)[field] < cutoff
        return F.struct(F.when(open_ & right, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~right, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(states).alias("hi"))
    halvings = F.ceil(F.log2(F.size(states) + F.lit(1.0))).cast("int")
    before = F.aggregate(F.array_repeat(F.lit(0), halvings), start, halve)["lo"]
    return F.when(cutoff.isNotNull(), F.get(states, before - 1))
