"""Queries of the general problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexharbor.operators.snapshots import snapshot_changes
from lexharbor.session import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys added, removed or changed between consecutive snapshots of rag_document_snapshot."""
    return snapshot_changes(table(spark, sf_dir, "rag_document_snapshot"))


QUERIES = {"p5_found": p5_found}

SQL = {
    "p5_found": """
WITH spelled AS (
  SELECT snapshot_no, corpus_id, external_id, loaded_at, updated_at,
         lower(trim(hash_sha256)) AS plain,
         regexp_extract(regexp_replace(lower(trim(hash_sha256)), '[\\s:_-]', '', 'g'), '([0-9a-f]{64})$', 1) AS digits
  FROM rag_document_snapshot WHERE snapshot_no IS NOT NULL),
ranked AS (
  SELECT snapshot_no, corpus_id, external_id,
         CASE WHEN digits <> '' THEN digits ELSE nullif(plain, '') END AS digest, loaded_at, updated_at
  FROM spelled),
held AS (
  SELECT snapshot_no, corpus_id, external_id, digest FROM (
    SELECT *, row_number() OVER (PARTITION BY snapshot_no, corpus_id, external_id
      ORDER BY loaded_at DESC NULLS LAST, updated_at DESC NULLS LAST, digest DESC NULLS LAST) AS n FROM ranked) WHERE n = 1),
near AS (
  SELECT snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS before
  FROM (SELECT DISTINCT snapshot_no FROM held))
SELECT n.snapshot_no AS snapshot_no, coalesce(a.corpus_id, b.corpus_id) AS corpus_id,
       coalesce(a.external_id, b.external_id) AS external_id,
       CASE WHEN b.snapshot_no IS NULL THEN 'added' WHEN a.snapshot_no IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM near n
JOIN (SELECT s.corpus_id, s.external_id, t.snapshot_no
      FROM (SELECT DISTINCT corpus_id, external_id FROM held) s CROSS JOIN near t WHERE t.before IS NOT NULL) k
  ON k.snapshot_no = n.snapshot_no
LEFT JOIN held a ON a.snapshot_no = n.snapshot_no AND a.corpus_id IS NOT DISTINCT FROM k.corpus_id
  AND a.external_id IS NOT DISTINCT FROM k.external_id
LEFT JOIN held b ON b.snapshot_no = n.before AND b.corpus_id IS NOT DISTINCT FROM k.corpus_id
  AND b.external_id IS NOT DISTINCT FROM k.external_id
WHERE (a.snapshot_no IS NULL) <> (b.snapshot_no IS NULL)
   OR (a.snapshot_no IS NOT NULL AND b.snapshot_no IS NOT NULL AND a.digest IS DISTINCT FROM b.digest)
""",
}
