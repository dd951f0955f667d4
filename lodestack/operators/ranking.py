"""Global ranks without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values at first; their counts are the only rows that one task orders.
RANGES = 100_000
#: Rows of a range at least, and times the mean, above which it is cut into FINER ranges.
LARGE, UNEVEN, FINER = 10_000, 10, 10_000


def ranked(df: DataFrame, key: str) -> DataFrame:
    """df with rank from 1 in the order of an integer key; equal keys in arbitrary order.

    Rows are counted by ranges of equal width between the least and the greatest key; ranges with many
    more rows than others are cut again, of which there can be at most RANGES / UNEVEN in a pass. A row's
    rank is the count before its range and its place within it. Rows of one key stay in one range.
    """
    low, high, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if low is None:
        return df.withColumn("rank", F.lit(0).cast("long"))
    width = max(1, (high - low) // RANGES + 1)
    rows = df.withColumn("_range", F.expr(f"cast({low} as bigint) + (`{key}` - ({low})) div {width} * {width}"))
    large = max(LARGE, UNEVEN * total // RANGES)
    while width > 1:
        heavy = [r[0] for r in rows.groupBy("_range").agg(F.count("*").alias("n")).filter(F.col("n") > large).collect()]
        if not heavy:
            break
        width = max(1, width // FINER + 1) if width > 2 else 1
        named = F.broadcast(df.sparkSession.createDataFrame([(x,) for x in heavy], "_range long").withColumn("_heavy", F.lit(True)))
        inner = F.expr(f"_range + (`{key}` - _range) div {width} * {width}")
        rows = rows.join(named, "_range", "left").withColumn("_range", F.when(F.col("_heavy"), inner).otherwise(F.col("_range"))).drop("_heavy")
    counts = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("_range", before.alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return rows.withColumn("_i", inside).join(base, "_range").withColumn("rank", F.col("_base") + F.col("_i")).drop("_range", "_i", "_base")
