"""Incremental embedding: new files of chunks are embedded as they arrive, each id once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexharbor.operators.embed import Embedder, embed
from lexharbor.operators.store import pending
from lexharbor.sources.files import done_ids

SEED = -1


def _known(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema("id string, batch long").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def embed_stream(spark: SparkSession, chunks_dir: str, out_dir: str, checkpoint_dir: str, embedder: Embedder, schema: str = "id string, text string, metadata string") -> StreamingQuery:
    """A query that reads JSON lines of `chunks_dir` and writes records to `out_dir`, then ends when all present files are read.

    Each batch has a folder of its own, which it replaces when it is run again after a failure. The ids written so far are kept in a table
    beside `out_dir`, begun with those of records that were there before; a batch reads these ids, not the records. Repeated ids of one batch
    count once.
    """
    ids_dir = out_dir.rstrip("/") + "_ids"

    def batch(df: DataFrame, number: int) -> None:
        known = _known(spark, ids_dir)
        if known is None:
            done_ids(spark, out_dir).write.mode("overwrite").parquet(f"{ids_dir}/batch={SEED}")
            known = _known(spark, ids_dir)
        fresh = pending(df.dropDuplicates(["id"]), known.where(F.col("batch") != number))
        own = f"{out_dir.rstrip('/')}/batch={number}"
        embed(fresh, embedder).write.mode("overwrite").json(own)
        spark.read.schema("id string").json(own).write.mode("overwrite").parquet(f"{ids_dir}/batch={number}")

    stream = spark.readStream.schema(schema).json(chunks_dir)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
