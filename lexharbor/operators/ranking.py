"""Row numbers within keys of which one may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.session import cut

#: Keys with more rows than this are numbered by many tasks.
HOT = 1_000_000


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n", hot: int = HOT) -> DataFrame:
    """`df` with `out` INT: 1, 2, ... within the keys (NULL is a key of its own), in `order`. Rows equal in `order` are numbered in any order.

    Where no key has more than `hot` rows this is one window. Else the rows are divided by ranges of keys and order, numbered within each
    range, and a key's ranges are added up; the result is the same, and no task holds more than its range.
    """
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
    if most <= hot:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    ranged = cut(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))  # written: parts stay as they are
    within = Window.partitionBy("_part", *keys).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_c"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in keys], "_before")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = ranged.withColumn("_n", F.row_number().over(within)).join(offsets, same)
    return joined.select(*df.columns, (F.col("_n") + F.col("_before")).cast("int").alias(out))
