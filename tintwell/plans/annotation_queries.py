"""Queries over the event log read as annotations: users stand for items, an error takes back the event before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.operators import annotation
from tintwell.plans.registry import query, table

_KIND = "CASE event_type WHEN 'view' THEN 'role' WHEN 'click' THEN 'eligibility' WHEN 'purchase' THEN 'occurrence_relation' WHEN 'error' THEN 'revoke' ELSE 'adjudication' END"
_EVENTS = f"SELECT event_id, user_id AS item_id, event_id % 3 AS annotator_id, {_KIND} AS kind, CAST(value AS VARCHAR) AS value, ts AS created_at, CASE WHEN event_type = 'error' THEN event_id - 1 END AS supersedes_event_id FROM events"
_LIVE = f"SELECT * FROM ({_EVENTS}) e WHERE kind <> 'revoke' AND NOT EXISTS (SELECT 1 FROM ({_EVENTS}) r WHERE r.kind = 'revoke' AND r.supersedes_event_id = e.event_id)"


def _frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = F.col("event_type")
    kind = F.when(c == "view", "role").when(c == "click", "eligibility").when(c == "purchase", "occurrence_relation").when(c == "error", "revoke").otherwise("adjudication")
    log = table(spark, d, "events").select("event_id", F.col("user_id").alias("item_id"), (F.col("event_id") % 3).cast("string").alias("annotator_id"), kind.alias("kind"), F.col("value").cast("string").alias("value"), F.col("ts").alias("created_at"), F.when(c == "error", F.col("event_id") - 1).alias("supersedes_event_id"))
    k = F.col("item_id")
    items = log.select("item_id").distinct().select("item_id", (k % 4).alias("set_id"), (k % 2 == 0).alias("blind"), (k % 5 == 0).alias("occurrence"))
    return log, items


@query(f"""
WITH l AS ({_LIVE}), s AS (SELECT item_id, count(DISTINCT annotator_id) FILTER (kind = 'role') AS r, count(DISTINCT annotator_id) FILTER (kind = 'eligibility') AS e, count(*) FILTER (kind = 'occurrence_relation') AS o, count(*) AS n FROM l GROUP BY 1)
SELECT i.item_id, i.item_id % 4 AS set_id, CASE WHEN CASE WHEN i.item_id % 5 = 0 THEN coalesce(o, 0) > 0 ELSE coalesce(r, 0) >= CASE WHEN i.item_id % 2 = 0 THEN 2 ELSE 1 END AND coalesce(e, 0) >= CASE WHEN i.item_id % 2 = 0 THEN 2 ELSE 1 END END THEN 'completed' WHEN coalesce(n, 0) > 0 THEN 'in_progress' ELSE 'pending' END AS status
FROM (SELECT DISTINCT user_id AS item_id FROM events) i LEFT JOIN s ON i.item_id = s.item_id""")
def annotation_item_status(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-8: which items have what they need."""
    log, items = _frames(spark, d)
    return annotation.item_status(items, log)


@query(f"""
SELECT item_id, kind, CASE WHEN item_id % 2 = 0 AND kind IN ('role', 'eligibility') THEN annotator_id::VARCHAR ELSE '' END AS scope, arg_max(event_id, (created_at, event_id)) AS event_id FROM ({_LIVE}) GROUP BY 1, 2, 3""")
def annotation_latest_live(spark: SparkSession, d: str) -> DataFrame:
    """W-2, W-3: the last live event of each item and kind, by annotator for blind labels."""
    log, items = _frames(spark, d)
    return annotation.latest_live(log, items).select("item_id", "kind", "scope", "event_id")


@query("""
WITH s AS (SELECT DISTINCT doc_id // 7 AS g, CASE WHEN doc_id % 10 < 6 THEN 'train' WHEN doc_id % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM documents)
SELECT a.split AS left_split, b.split AS right_split, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.split < b.split GROUP BY 1, 2""")
def leaking_split_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A-23: blocks of ids that two splits share."""
    k = F.col("doc_id") % 10
    docs = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 7).alias("group_id"), F.when(k < 6, "train").when(k < 8, "validation").otherwise("test").alias("split"))
    return annotation.leaking_split_pairs(docs)
