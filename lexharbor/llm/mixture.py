"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.llm.tokens import VOCABULARY, token_count
from lexharbor.session import bounded, cut, spread

SEED = 17
REACHABLE = "reachable"
#: Targets are broadcast up to this many; beyond it documents and rates are joined by shuffle.
MOST_TARGETS = 10_000


def source_name(source: Column) -> Column:
    """The name of a source without case and outer blanks; NULL for none."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(source, r"(?U)^\s+|\s+$", ""))), F.lit(""))


def sized(docs: DataFrame, vocabulary: str = VOCABULARY, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc, source and n_tokens of every document, kept in the shared folder so that texts are encoded once."""
    scan = spread(docs.select(doc, text, source))
    return cut(scan.select(doc, source_name(F.col(source)).alias("source"), token_count(docs, text, vocabulary).cast("long").alias("n_tokens")))


def rates(sizes: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, fill: bool = False) -> DataFrame:
    """How often each target's documents are taken: source, target_share, max_repeats, documents, available_tokens, rate.

    rate = target_share x total / available_tokens, at most max_repeats. The total is `total_tokens`; without it, all tokens of `sizes`;
    with REACHABLE, the largest total at which every source that has tokens still reaches its share, the least of max_repeats x
    available_tokens / target_share. Beyond that total the sources that are used up fall short, and the others keep their proportions; with
    `fill` the others are taken more often, in their proportions, until the total is reached or all are used up. A source without tokens has rate 0 and reaches no share. Targets whose names differ in case or blanks only are one: shares add up, the least max_repeats holds. A NULL or
    negative share is 0, a NULL max_repeats 1.
    """
    wanted = (
        targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
        .where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.min(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    )
    there = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("available_tokens"))
    both = wanted.join(there, "source", "left").fillna(0, ["documents", "available_tokens"])
    usable = (F.col("available_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    most = F.when(usable, F.col("max_repeats") * F.col("available_tokens") / F.col("target_share"))
    everything = Window.partitionBy(F.lit(0))  # as many rows as there are targets
    if total_tokens == REACHABLE:
        total = F.min(most).over(everything)
    elif total_tokens is None:
        # of the sources of no target as well: they come along as rows without a share
        both = wanted.join(there, "source", "full").fillna(0, ["documents", "available_tokens"]).withColumn("_all", F.sum("available_tokens").over(everything))
        both, total = both.where(F.col("target_share").isNotNull()), F.col("_all")
    else:
        total = F.lit(float(total_tokens))
    if fill:
        # sources in the order in which they are used up: the first that is not, once those before it are taken whole, sets the level
        by_most = Window.partitionBy(F.lit(0)).orderBy(F.col("_most").asc_nulls_last(), "source")
        both = both.withColumn("_total", total).withColumn("_most", most).withColumn("_share", F.when(usable, F.col("target_share")).otherwise(0.0))
        whole = F.coalesce(F.sum(F.when(usable, F.col("max_repeats") * F.col("available_tokens"))).over(by_most.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        level = (F.col("_total") - whole) / F.nullif(F.sum("_share").over(by_most.rowsBetween(0, Window.unboundedFollowing)), F.lit(0.0))
        both = both.withColumn("_level", level)
        first = F.min(F.when(usable & (F.col("_level") <= F.col("_most")), F.struct("_most", "source", "_level"))).over(everything).getField("_level")
        total = F.coalesce(first, F.max("_most").over(everything))
    rate = F.least(F.round(F.col("target_share") * total / F.col("available_tokens"), 9), F.col("max_repeats").cast("double"))
    both = both.withColumn("rate", F.when(usable, rate).otherwise(F.lit(0.0)))
    return both.select("source", "target_share", "max_repeats", "documents", "available_tokens", "rate")


def draw(*key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11).cast("double") / F.lit(float(1 << 53))


def copies(sizes: DataFrame, plan: DataFrame, targets: DataFrame, seed: int = SEED, doc: str = "doc_id") -> DataFrame:
    """doc, source, n_tokens, copies INT of each document of a target: floor(rate), and one more with the fraction's probability."""
    known = bounded(plan.select("source", "rate"), targets, MOST_TARGETS)
    whole = F.floor("rate")
    one_more = (draw(F.col(doc).cast("string"), seed=seed) < F.col("rate") - whole).cast("int")
    return sizes.join(known, "source").select(doc, "source", "n_tokens", (whole + one_more).cast("int").alias("copies"))


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, seed: int = SEED, vocabulary: str = VOCABULARY, fill: bool = False) -> DataFrame:
    """The mixture: doc_id, source, copy INT (1 for the first use of a document, then 2, ...), n_tokens.

    Documents are taken by the `rates` of their source. Each row of `docs` is a document; documents of no target's source (NULL ones too)
    are not in the mixture. Documents without tokens are taken as the others. The same seed gives the same mixture on any cluster. Empty
    tables give an empty mixture.
    """
    sizes = sized(docs, vocabulary)
    taken = copies(sizes, rates(sizes, targets, total_tokens, fill), targets, seed).where(F.col("copies") > 0)
    return taken.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "n_tokens")


def shares(docs: DataFrame, targets: DataFrame, total_tokens: float | str | None = None, seed: int = SEED, vocabulary: str = VOCABULARY, fill: bool = False) -> DataFrame:
    """What `mix` with the same parameters reaches, one row per target: the columns of `rates`, and mixed_tokens BIGINT, actual_share
    DOUBLE (of all tokens of the mixture; 0 where the mixture is empty), most_uses INT of one document."""
    sizes = sized(docs, vocabulary)
    plan = rates(sizes, targets, total_tokens, fill)
    got = copies(sizes, plan, targets, seed).groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("mixed_tokens"), F.max("copies").alias("most_uses"))
    both = plan.join(got, "source", "left").fillna(0, ["mixed_tokens", "most_uses"])
    everything = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0)))
    return both.withColumn("actual_share", F.when(everything > 0, F.col("mixed_tokens") / everything).otherwise(F.lit(0.0)))
