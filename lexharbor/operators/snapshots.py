"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.session import bounded

#: Snapshot numbers are joined by broadcast up to this many; beyond it the join is left to the planner.
MAX_BROADCAST_SNAPSHOTS = 10_000


def digest(hash_: Column) -> Column:
    """The 64 lower-case hex digits of a SHA-256 however written: case, blanks, separators and a `sha256:` or `0x` prefix do not
    count. A text without 64 hex digits at its end is compared as it stands, trimmed and in lower case; a blank one is NULL."""
    plain = F.lower(F.trim(hash_))
    digits = F.regexp_extract(F.regexp_replace(plain, r"[\s:_-]", ""), r"([0-9a-f]{64})$", 1)
    return F.when(digits != "", digits).otherwise(F.nullif(plain, F.lit("")))


def snapshot_changes(
    rows: DataFrame,
    keys: Sequence[str] = ("corpus_id", "external_id"),
    snapshot: str = "snapshot_no",
    hash_: str = "hash_sha256",
    latest: Sequence[str] = ("loaded_at", "updated_at"),
) -> DataFrame:
    """The keys `added`, `removed` or `changed` between each snapshot and the one before.

    Result: snapshot (as in `rows`), the keys, change STRING; one row per snapshot and key that changed.

    Of several rows of a key in a snapshot the one with the greatest `latest` columns holds, however late it came; rows equal in these
    are decided by the greater digest, so a repeated row counts once. The snapshot before is the next lower number present in `rows`;
    nothing is reported for the lowest. NULL is a digest of its own (NULL to NULL is no change, NULL to a digest is one) and a key
    value of its own. Rows with a NULL snapshot number belong to no snapshot. An empty table gives no rows; further columns are
    not read.

    Plan: one aggregation whose partial step runs before the shuffle, so a key with a great many repeated rows is reduced in its own
    tasks, then one window over the key, which holds at most one row per snapshot. The shuffle of the aggregation is not reused by the
    window, as it would be if hashed by the key alone, because one key's repeated rows would then meet in one task.
    """
    keys = list(keys)
    order = F.struct(*[F.col(c) for c in latest], digest(F.col(hash_)).alias("digest"))
    held = (
        rows.where(F.col(snapshot).isNotNull())
        .groupBy(snapshot, *keys)
        .agg(F.max(order).alias("held"))
        .select(F.col(snapshot).alias("no"), *keys, F.col("held.digest").alias("digest"))
    )
    w = Window.orderBy("no")  # one row per snapshot number
    numbers = rows.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).alias("no")).distinct()
    near = numbers.select("no", F.lag("no").over(w).alias("before"), F.lead("no").over(w).alias("after"))
    near = bounded(near, numbers, MAX_BROADCAST_SNAPSHOTS)
    of_key = Window.partitionBy(*keys).orderBy("no")
    seen = held.join(near, "no").select(
        *keys, "no", "before", "after", "digest",
        F.lag("no").over(of_key).alias("last_no"), F.lag("digest").over(of_key).alias("last_digest"), F.lead("no").over(of_key).alias("next_no"),
    )
    fresh = F.col("before").isNotNull() & ~F.col("last_no").eqNullSafe(F.col("before"))
    other = F.col("last_no").eqNullSafe(F.col("before")) & F.col("before").isNotNull() & ~F.col("digest").eqNullSafe(F.col("last_digest"))
    gone = F.col("after").isNotNull() & ~F.col("next_no").eqNullSafe(F.col("after"))
    event = lambda no, what: F.struct(F.col(no).alias(snapshot), F.lit(what).alias("change"))
    events = F.array(
        F.when(fresh, event("no", "added")), F.when(other, event("no", "changed")), F.when(gone, event("after", "removed"))
    )
    one = seen.select(*keys, F.explode(events).alias("event")).where(F.col("event").isNotNull())
    return one.select(F.col(f"event.{snapshot}").alias(snapshot), *keys, F.col("event.change").alias("change"))
