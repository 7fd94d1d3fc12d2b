"""One ranking from several differently scaled scores: reciprocal rank fusion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.session import cut

#: Fixed value: the usual constant of reciprocal rank fusion.
K = 60
#: Requests with more hits than this are ranked in bins, each by its own task.
HOT = 50_000
#: Bins of a request too large for one task: one for every HOT hits of the largest, from 64 to 1,024.
BINS = (64, 1024)
#: Scores are summed in this many decimals, so that ties stay ties whatever the order of the sum.
DECIMALS = 12
SEARCH_SCORES = {"rrf_score": "desc", "dense_rank": "asc", "fts_rank": "asc"}


def _cost(score: str, way: str) -> Column:
    """The score as a DOUBLE of which less is better; NaN and NULL are NULL."""
    value = F.col(score).cast("double")
    value = F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value)
    return -value if way == "desc" else value


def _ranked(df: DataFrame, request: str, cost: str, rank: str) -> DataFrame:
    w = Window.partitionBy(request).orderBy(F.col(cost).asc_nulls_last())
    return df.withColumn(rank, F.rank().over(w).cast("long"))


def _ranked_in_bins(df: DataFrame, request: str, cost: str, rank: str, item: str, bins: int) -> DataFrame:
    """As `_ranked`, of requests too large for one task.

    Bins are cut at approximate quantiles of each request; a rank is the number of hits in better bins plus the rank within the bin. A
    value that is several quantiles at once, and NULL, is a bin of its own where all tie and nothing is sorted.
    """
    n_bins = bins
    at = [i / n_bins for i in range(1, n_bins)]
    salts = 64
    edges = df.groupBy(request).agg(F.percentile_approx(cost, F.array(*map(F.lit, at)), 30 * n_bins).alias("_edges"))
    edges = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    edges = edges.withColumnRenamed(request, "_request")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(item), F.lit(salts)).cast("int"))
    at_edges = salted.join(edges, F.col(request).eqNullSafe(F.col("_request")) & (salted["_salt"] == edges["_salt"]))
    at_edges = at_edges.drop(edges["_salt"]).drop("_request")
    heavy = F.size(F.filter("_edges", lambda e: e == F.col(cost))) > 1
    below = F.size(F.filter("_edges", lambda e: e < F.col(cost)))
    bins = at_edges.withColumn("_ties", F.col(cost).isNull() | heavy).withColumn(
        "_bin", F.when(F.col(cost).isNull(), 2 * n_bins + 2).otherwise(2 * below + heavy.cast("int"))
    )
    bins = cut(bins.drop("_edges"))  # read three times below
    before = Window.partitionBy(request).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = bins.groupBy(request, "_bin").count()
    offsets = sizes.select(
        F.col(request).alias("_request"), F.col("_bin").alias("_of"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    ).withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = F.col(request).eqNullSafe(F.col("_request")) & (F.col("_bin") == F.col("_of")) & (F.col("_salt") == F.col("_salt_of"))
    placed = bins.join(offsets, same)
    within = Window.partitionBy(request, "_bin").orderBy(cost)
    ties = placed.where("_ties").withColumn(rank, F.col("_offset") + 1)
    rest = placed.where(~F.col("_ties")).withColumn(rank, F.col("_offset") + F.rank().over(within))
    return cut(ties.unionByName(rest).drop("_ties", "_bin", "_of", "_offset", "_request", "_salt", "_salt_of"))


def distinct_hits(hits: DataFrame, request: str, item: str, scores: Mapping[str, str]) -> DataFrame:
    """One row per request and item, with the best of each score among repeated hits."""
    best = [(F.min if way == "asc" else F.max)(F.nanvl(F.col(s).cast("double"), F.lit(None).cast("double"))).alias(s) for s, way in scores.items()]
    return hits.groupBy(request, item).agg(*best)


def fuse(
    hits: DataFrame, request: str = "query_id", item: str = "chunk_id", scores: Mapping[str, str] = SEARCH_SCORES, k: int = K, hot: int = HOT
) -> DataFrame:
    """The hits of each request in one ranking: request, item, rank_<score> BIGINT for each of `scores`, fused DOUBLE, position BIGINT.

    `scores` says of each score whether more ("desc") or less ("asc") is better. Hits are ranked separately by each score, 1 for the best;
    equal scores share the rank; a NULL or NaN score stands behind every score present, all of them at the same rank. fused is the sum of
    1 / (k + rank) over the scores, so that only ranks count and no score's range does; position is the rank by fused, the greatest
    first, shared by equal ones (`first` breaks such ties by the smaller item). Repeated hits of a request count once, with the best of
    each score. A NULL request is a request of its own, a NULL item an item of its own. Other columns are not read, so their names do not matter.

    Requests with more than `hot` hits are ranked in bins, by many tasks, with the same result.
    """
    one = distinct_hits(hits, request, item, scores)
    for i, (s, way) in enumerate(scores.items()):
        one = one.withColumn(f"_cost{i}", _cost(s, way))
    one = one.select(request, item, *[f"_cost{i}" for i in range(len(scores))])
    sizes = one.groupBy(request).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).select(F.col(request).alias("_hot"), "_n")
    is_hot = F.col(request).eqNullSafe(F.col("_hot"))
    most = sizes.agg(F.max("_n")).first()[0]  # NULL if no request is so large
    bins = min(BINS[1], max(BINS[0], -(-(most or 0) // hot)))
    sizes = sizes.select("_hot")
    parts = [one.join(sizes, is_hot, "left_anti"), cut(one.join(sizes, is_hot, "left_semi"))] if most else [one]
    done = []
    for part, rank_by in zip(parts, (_ranked, lambda *a: _ranked_in_bins(*a, item, bins)), strict=False):
        for i, s in enumerate(scores):
            part = rank_by(part, request, f"_cost{i}", f"rank_{s}")
        total = sum((F.lit(1.0) / (F.lit(float(k)) + F.col(f"rank_{s}")) for s in scores), F.lit(0.0))
        part = part.withColumn("fused", F.round(total, DECIMALS)).withColumn("_order", -F.col("fused"))
        part = rank_by(part, request, "_order", "position")
        done.append(part.select(request, item, *[f"rank_{s}" for s in scores], "fused", "position"))
    return done[0] if len(done) == 1 else done[0].unionByName(done[1])


def first(ranking: DataFrame, request: str = "query_id", item: str = "chunk_id") -> DataFrame:
    """The hit that stands first for each request: greatest fused, then smallest item. Reduced before the shuffle."""
    best = ranking.groupBy(request).agg(F.min(F.struct((-F.col("fused")).alias("c"), F.col(item).alias("i"))).alias("b"))
    return best.select(request, F.col("b.i").alias(item))
