"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexharbor.session import bounded


def null_key(keys: Sequence[str]) -> Column:
    """NULL, but for rows with a NULL in their key a number of their own, so that none of them is taken for a repetition."""
    some = F.lit(False)
    for k in keys:
        some = some | F.col(k).isNull()
    return F.when(some, F.monotonically_increasing_id())


def last_wins(df: DataFrame, keys: Sequence[str], latest: Sequence[str], among: Sequence[str] = ()) -> DataFrame:
    """Of several rows of a key the one with the greatest `latest` columns, then the greatest `among` columns; NULL is least.

    Of rows that are equal in all of these, each further column has its greatest value, so that the result is the same whatever the order of
    the rows. A row with a NULL in its key is no repetition of any other and stays. All columns of `df` come out, in their order; an empty
    table gives an empty table. The aggregation's partial step runs before the shuffle, so a key with very many rows is reduced where its rows
    lie. Each column is picked by itself: columns nobody asks for are neither read nor shuffled.
    """
    order = [*latest, *among]
    picked = [F.max(F.struct(*[F.col(f"`{c}`") for c in order], F.col(f"`{c}`").alias("_value"))).getField("_value").alias(c) for c in df.columns if c not in keys]
    best = df.groupBy(*keys, null_key(keys).alias("_alone")).agg(*picked, F.count(F.lit(1)).alias("_rows"))
    return best.select(*[F.col(f"`{c}`") for c in df.columns])


def newest(df: DataFrame, keys: Sequence[str], latest: Sequence[str], **columns: Column) -> DataFrame:
    """keys and `columns` of the newest row of each key, as `last_wins`, but of rows equally new the one with the greatest columns.

    The columns are computed where the rows lie; what is shuffled are the keys, `latest` and the columns, not what they are computed from."""
    rows = df.select(*keys, *[F.col(c).alias(f"_{c}") for c in latest], null_key(keys).alias("_alone"), *[c.alias(n) for n, c in columns.items()])
    best = rows.groupBy(*keys, "_alone").agg(F.max(F.struct(*[f"_{c}" for c in latest], *columns)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[n].alias(n) for n in columns])


def only_last(df: DataFrame, key: str, order: Sequence[str], most: int = 100_000) -> DataFrame:
    """Of several rows of a key the one greatest in `order`, then in the further columns; NULL is least, and a NULL key is no repetition.

    What is shuffled are the keys, and the rows of those keys that are repeated; others stay where they lie, unless more than `most` keys are
    repeated."""
    others = [*order, *[c for c in df.columns if c != key and c not in order]]
    again = bounded(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col(key).isNotNull()).select(key), None, most)
    best = df.join(again, key, "left_semi").groupBy(key).agg(F.max(F.struct(*others)).alias("_best")).select(key, *[F.col("_best")[c].alias(c) for c in others])
    return df.join(again, key, "left_anti").select(key, *others).unionByName(best).select(*df.columns)
