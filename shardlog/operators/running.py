"""Running totals over long ordered sequences, without one task per sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], order: list[str], block: Column, **values: Column) -> DataFrame:
    """Adds the sums (named as given) of ``values`` up to and including each row, per keys, in the given order.

    block: a number that never falls along the order, with a bounded number of rows each (say, a sequence number divided by a
    constant). Blocks are summed first, their totals run over, and rows are only ordered within their block; so a key that holds a
    third of all rows is spread over its blocks. The blocks' totals meet the rows by the rows' own partitioning: one shuffle of rows.
    """
    names = list(values)
    d = df.withColumns({"_block": block} | {f"_v_{n}": c.cast("bigint") for n, c in values.items()})
    totals = d.groupBy(*keys, "_block").agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*(F.col(k).alias(f"_k_{k}") for k in [*keys, "_block"]), *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in names))
    within = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = d.withColumns({f"_s_{n}": F.sum(f"_v_{n}").over(within) for n in names})
    on = F.lit(True)
    for k in [*keys, "_block"]:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return inner.join(base, on).select(*df.columns, *((F.col(f"_s_{n}") + F.col(f"_b_{n}")).alias(n) for n in names))
