"""As-of ("point-in-time") primitives built from windows over facts stacked with anchors.

An anchor asks: "what did the facts of my entity look like strictly before my
cutoff?". Instead of a range join (anchor x all earlier facts) the facts and
the anchors are stacked into one frame, partitioned by the entity, and ordered
by time with anchors sorting *before* facts of the same time. A frame that
ends one row before the current row then covers exactly the earlier facts;
earlier anchors inside that frame carry nulls and are skipped by the
aggregates. Cost: one shuffle and sort of facts + anchors, O(n log n).

To keep a hot entity from landing in one task, the window partition is
(entity, bucket), a month by default; state from earlier buckets is computed
on a small per-(entity, bucket) table and enters the pass as carry rows
(``_kind`` 2, null time, so they sort first in their partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ANCHOR, FACT, CARRY = 0, 1, 2  # carry rows (state from earlier buckets) have a null time: they sort first


def stack(facts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Union facts (``_kind`` 1) and anchors (``_kind`` 0); missing columns become null."""
    return facts.withColumn("_kind", F.lit(FACT)).unionByName(
        anchors.withColumn("_kind", F.lit(ANCHOR)), allowMissingColumns=True
    )


def strictly_before(partition: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """Frame of all earlier rows of the partition (anchors must sort before same-time facts)."""
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running(partition: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def last_k(arr: Column, k: int) -> Column:
    """The last ``k`` elements of an array (all of it when shorter)."""
    return F.slice(arr, F.greatest(F.size(arr) - F.lit(k - 1), F.lit(1)), k)


def kth_latest(arr: Column, i: int) -> Column:
    """Element ``i`` (1 = most recent) of an ascending history array; null when absent."""
    return F.get(F.reverse(arr), i - 1)


def fact_ordinal(partition: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Running count of facts up to the row; at an anchor: the number of facts before it."""
    return F.sum(F.when(F.col("_kind") == FACT, 1).otherwise(0)).over(running(partition, order))


def last_k_by_ordinal(value: str, partition: Sequence[str], k: int) -> Column:
    """Collect ``value`` of the facts with ordinal in [ord-k+1, ord].

    At a fact row this is the fact and its k-1 predecessors; at an anchor row
    it is the k facts strictly before it. Anchors inside the frame contribute
    nulls, which ``collect_list`` drops. Requires column ``_ord``.
    """
    w = Window.partitionBy(*partition).orderBy("_ord").rangeBetween(-(k - 1), 0)
    return F.collect_list(value).over(w)


def carry_pick(
    table: DataFrame,
    keys: DataFrame,
    partition: Sequence[str],
    order: str,
    picks: dict[str, Column],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """For every row of ``keys``, pick from the latest ``table`` row with a smaller ``order``.

    ``table`` and ``keys`` are small (one row per entity and bucket), so the
    partition by entity alone is cheap even for a hot entity.
    """
    u = stack(table, keys)
    w = strictly_before(partition, [order, "_kind", *tiebreak])
    cols = [F.col(c) for c in keys.columns] + [expr.over(w).alias(name) for name, expr in picks.items()]
    return u.select(*cols, "_kind").where(F.col("_kind") == ANCHOR).drop("_kind")
