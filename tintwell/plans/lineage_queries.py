"""Lineage, grouping, event and control queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.operators import checks, duplicates, evaluation, relational
from tintwell.plans.registry import query, table


@query("""
SELECT r.r_name, n.n_name, count(*) AS link_count, count(DISTINCT o.o_orderkey) AS ref_count, count(DISTINCT c.c_custkey) AS record_count,
       round(sum(l.l_extendedprice), 2) AS total_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2""")
def lineage_chain(spark: SparkSession, d: str) -> DataFrame:
    """J-2: links to references to records to two dimensions."""
    links = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    refs = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    records = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    chain = links.join(refs, "l_orderkey").join(records, "o_custkey").join(nations, "n_nationkey")
    # Distinct references and records are counted on rows that are already one a reference.
    by_ref = chain.groupBy("r_name", "n_name", "o_custkey", "l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("p"))
    by_record = by_ref.groupBy("r_name", "n_name", "o_custkey").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.count(F.lit(1)).alias("refs"))
    return by_record.groupBy("r_name", "n_name").agg(F.sum("n").alias("link_count"), F.sum("refs").alias("ref_count"), F.count(F.lit(1)).alias("record_count"), F.round(F.sum("p"), 2).alias("total_price"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def lineage_orphans_anti(spark: SparkSession, d: str) -> DataFrame:
    """J-6: records without a large reference."""
    large = table(spark, d, "orders").where("o_totalprice > 300000")
    return relational.orphans(table(spark, d, "customer"), large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("SELECT count(*) AS row_count, count(DISTINCT c_custkey) AS record_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 200000 WHERE o_orderkey IS NULL")
def lineage_orphans_outer_null(spark: SparkSession, d: str) -> DataFrame:
    """J-5: the same as an outer join whose right side stayed empty, counting join rows."""
    some = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
    left = table(spark, d, "customer").join(some, F.col("c_custkey") == F.col("o_custkey"), "left").where("o_orderkey IS NULL")
    return left.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("c_custkey").alias("record_count"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def semi_join_keys(spark: SparkSession, d: str) -> DataFrame:
    """P-3, J-8: products that a large link names."""
    keys = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return relational.having_keys(table(spark, d, "part"), keys, "p_partkey").select("p_partkey", "p_name")


@query("SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def left_optional_dims(spark: SparkSession, d: str) -> DataFrame:
    """J-3: contents with labels where there are any."""
    both = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return both.select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"))


@query("""
WITH a AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN upper(url) ELSE url END AS path FROM pages WHERE page_id % 7 <> 0),
     b AS (SELECT page_id AS ref_id, url AS path FROM pages WHERE page_id % 5 <> 0),
     f AS (SELECT lower(path) AS folded, min(ref_id) AS ref_id FROM b GROUP BY 1 HAVING count(*) = 1)
SELECT a.page_id, coalesce(e.ref_id, f.ref_id) AS matched_id, CASE WHEN e.ref_id IS NOT NULL THEN 'downloader_exact_path' WHEN f.ref_id IS NOT NULL THEN 'downloader_casefold_path' ELSE 'unmatched' END AS match_method,
       CASE WHEN e.ref_id IS NOT NULL THEN 1.0 WHEN f.ref_id IS NOT NULL THEN 0.99 END::DOUBLE AS match_confidence
FROM a LEFT JOIN (SELECT path, min(ref_id) AS ref_id FROM b GROUP BY 1) e ON a.path = e.path LEFT JOIN f ON lower(a.path) = f.folded""")
def exact_then_folded_match(spark: SparkSession, d: str) -> DataFrame:
    """J-14: files against references by path, then by folded path; the two sides differ in case and in what is missing."""
    pages = table(spark, d, "pages").select("page_id", "url")
    files = pages.where("page_id % 7 <> 0").select("page_id", F.when(F.col("page_id") % 3 == 0, F.upper("url")).otherwise(F.col("url")).alias("path"))
    refs = pages.where("page_id % 5 <> 0").select(F.col("url").alias("ref_path"), F.col("page_id").alias("ref_id"))
    return relational.exact_then_folded(files, refs, "path", "ref_path", "ref_id").drop("path")


@query("""
WITH b AS (SELECT page_id, url, sha256(html) AS digest, page_id % 11 AS class FROM pages WHERE page_id % 3 <> 0),
     a AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'moved/' || url ELSE url END AS url, sha256(html) AS digest FROM pages),
     p AS (SELECT url, arg_max(class, page_id) AS class FROM b GROUP BY 1), h AS (SELECT digest, arg_min(class, page_id) AS class FROM b GROUP BY 1)
SELECT a.page_id, coalesce(p.class, h.class) AS class, CASE WHEN p.url IS NOT NULL THEN 'path' WHEN h.digest IS NOT NULL THEN 'digest' ELSE 'none' END AS match_method
FROM a LEFT JOIN p ON a.url = p.url LEFT JOIN h ON a.digest = h.digest""")
def path_then_digest_match(spark: SparkSession, d: str) -> DataFrame:
    """J-15: files that were moved find their earlier metadata by content."""
    pages = table(spark, d, "pages").select("page_id", "url", F.sha2("html", 256).alias("digest"))
    earlier = pages.where("page_id % 3 <> 0").withColumn("class", F.col("page_id") % 11)
    now = pages.withColumn("url", F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("moved/"), "url")).otherwise(F.col("url")))
    return relational.path_then_digest(now, earlier, "url", "digest", "page_id", "class").select("page_id", "class", "match_method")


@query("""
WITH c AS (SELECT sha256(text) AS image_id, min(doc_id) AS first_id, count(*) AS occurrences, count(DISTINCT source) AS folders, max(n_chars) AS n_chars,
                  max(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS english, max(CASE WHEN n_chars >= 5000 THEN 1 ELSE 0 END) AS long FROM documents GROUP BY 1)
SELECT image_id, first_id, occurrences, folders, concat_ws(',', CASE WHEN occurrences > 1 THEN 'repeated' END, CASE WHEN folders > 1 THEN 'shared' END, CASE WHEN english = 1 THEN 'english' END, CASE WHEN long = 1 THEN 'long' END) AS tags FROM c""")
def content_candidates(spark: SparkSession, d: str) -> DataFrame:
    """A-4, P-12: one row a content with flags over its occurrences, and the tags they make."""
    docs = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("image_id"), "doc_id", "source", "lang", "n_chars")
    c = docs.groupBy("image_id").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("occurrences"), F.count_distinct("source").alias("folders"), F.max(F.col("lang") == "en").alias("english"), F.max(F.col("n_chars") >= 5000).alias("long"))
    tags = F.array_compact(F.array(F.when(F.col("occurrences") > 1, "repeated"), F.when(F.col("folders") > 1, "shared"), F.when(F.col("english"), "english"), F.when(F.col("long"), "long")))
    return c.select("image_id", "first_id", "occurrences", "folders", F.array_join(tags, ",").alias("tags"))


@query("""
WITH a AS (SELECT source, count(*) AS file_count FROM documents GROUP BY 1),
     b AS (SELECT 'src' || (doc_id % 25) AS source, count(*) AS record_count FROM labels WHERE toxic = 1 GROUP BY 1)
SELECT coalesce(a.source, b.source) AS source, coalesce(file_count, 0) AS file_count, coalesce(record_count, 0) AS record_count,
       CASE WHEN coalesce(record_count, 0) > 1 THEN 'multi_source_record' WHEN record_count = 1 THEN 'single_source_record' ELSE 'orphan_physical_folder' END AS status FROM a FULL JOIN b ON a.source = b.source""")
def folder_rollup_status(spark: SparkSession, d: str) -> DataFrame:
    """A-11: folders of either side with their counts and status."""
    records = table(spark, d, "labels").where("toxic = 1").select(F.concat(F.lit("src"), (F.col("doc_id") % 25).cast("string")).alias("source"))
    return relational.rollup_status(table(spark, d, "documents").select("source"), records, "source")


@query("SELECT p_name, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS names, count(*) AS row_count FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def alias_groups(spark: SparkSession, d: str) -> DataFrame:
    """A-12: names with more than one brand."""
    return relational.alias_groups(table(spark, d, "part"), "p_name", "p_brand").withColumn("names", F.array_join("names", ","))


@query("""
WITH h AS (SELECT sha256(text) AS sha, doc_id FROM documents), g AS (SELECT sha, min(doc_id) AS anchor, count(*) AS group_size, row_number() OVER (ORDER BY sha) AS group_number FROM h GROUP BY 1 HAVING count(*) > 1)
SELECT group_number, sha, doc_id, group_size, anchor, doc_id = anchor AS is_anchor FROM h JOIN g USING (sha)""")
def exact_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    """A-13: members of contents with several occurrences, groups numbered in digest order."""
    docs = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "doc_id")
    return duplicates.exact_groups(docs, "sha", "doc_id")


@query("WITH h AS (SELECT sha256(text) AS sha, doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS anchor FROM documents) SELECT anchor AS left_id, doc_id AS right_id FROM h WHERE doc_id <> anchor")
def exact_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A-13: the anchor of each group with its other members."""
    docs = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "doc_id")
    return duplicates.star_pairs(duplicates.exact_groups(docs, "sha", "doc_id"), "doc_id")


@query("SELECT count(*) AS repeated_keys, CAST(sum(n) AS BIGINT) AS row_count FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1)")
def dup_cache_keys_having(spark: SparkSession, d: str) -> DataFrame:
    """A-6: keys that were paid for more than once."""
    keys = table(spark, d, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.agg(F.count(F.lit(1)).alias("repeated_keys"), F.sum("n").alias("row_count"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-3."""
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase' AND value > 50) AS large_purchases, count(*) FILTER (event_type IN ('view', 'click')) AS seen, max(event_id) AS last_id FROM events")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-1, A-5, A-7, A-29: several counters in one pass."""
    c = F.col
    return table(spark, d, "events").agg(F.count(F.lit(1)).alias("total"), F.count_if(c("event_type") == "error").alias("errors"), F.count_if((c("event_type") == "purchase") & (c("value") > 50)).alias("large_purchases"), F.count_if(c("event_type").isin("view", "click")).alias("seen"), F.max("event_id").alias("last_id"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-2, A-31."""
    return table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days"))


@query("""
WITH t AS (SELECT unnest([CASE WHEN p_size <= 10 THEN 'small' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END, CASE WHEN p_type LIKE '%STEEL' THEN 'steel' END, p_brand]) AS tag FROM part)
SELECT tag, count(*) AS row_count FROM t WHERE tag IS NOT NULL GROUP BY 1""")
def tag_explode_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-8, A-9: how many products have each derived tag."""
    c = F.col
    tags = F.array_compact(F.array(F.when(c("p_size") <= 10, "small"), F.when(c("p_retailprice") > 1000, "dear"), F.when(c("p_type").endswith("STEEL"), "steel"), c("p_brand")))
    return relational.tag_counts(table(spark, d, "part").select(tags.alias("tags")), "tags")


@query("SELECT k AS key, CAST(sum(CAST(json_extract_string(props, '$.' || k) AS DOUBLE)) AS DOUBLE) AS total, count(*) AS row_count FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1")
def json_key_sum(spark: SparkSession, d: str) -> DataFrame:
    """A-10: totals by key of a JSON column."""
    return relational.json_key_sums(table(spark, d, "events"), "props")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_event_per_key(spark: SparkSession, d: str) -> DataFrame:
    """W-2."""
    return relational.latest(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


_REVOKED = "SELECT CAST(event_id - 1 AS BIGINT) FROM events WHERE event_type = 'error'"


@query(f"SELECT user_id, event_id, event_type, value FROM events WHERE event_type <> 'error' AND event_id NOT IN ({_REVOKED}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_not_revoked(spark: SparkSession, d: str) -> DataFrame:
    """W-2, J-6: an error event takes back the event before it; the latest live one of each user."""
    events = table(spark, d, "events")
    revoked = events.where("event_type = 'error'").select((F.col("event_id") - 1).alias("revokes_event_id"))
    live = relational.without_revoked(events.where("event_type <> 'error'"), revoked)
    return relational.latest(live, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, CAST(ts AS DATE)::VARCHAR AS day, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1, 2")
def latest_per_annotator(spark: SparkSession, d: str) -> DataFrame:
    """W-3: the last value of each user and day, in one aggregation."""
    days = table(spark, d, "events").withColumn("day", F.to_date("ts").cast("string"))
    return relational.latest_value(days, ["user_id", "day"], "value", ["ts", "event_id"], "last_value")


@query("""
WITH want AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
     have AS (SELECT user_id, event_type, event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT w.user_id, w.event_type, h.event_id, h.event_id IS NOT NULL AS cache_hit FROM want w LEFT JOIN have h ON w.user_id = h.user_id AND w.event_type = h.event_type""")
def cache_lookup_latest(spark: SparkSession, d: str) -> DataFrame:
    """W-5, J-9: for each key wanted in the second half, the latest good result of the first."""
    events, cut = table(spark, d, "events"), F.lit("2024-01-16").cast("timestamp")
    want = events.where(F.col("ts") >= cut).select("user_id", "event_type").distinct()
    have = relational.latest(events.where((F.col("ts") < cut) & (F.col("event_type") != "error")), ["user_id", "event_type"], ["ts", "event_id"])
    return want.join(have.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "left").withColumn("cache_hit", F.col("event_id").isNotNull())


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END DESC, o_orderkey DESC) = 1""")
def groupwise_max_scope(spark: SparkSession, d: str) -> DataFrame:
    """J-10, P-7: the reference of the preferred scope of each record."""
    c = F.col("o_orderpriority")
    rank = F.when(c == "1-URGENT", 3).when(c == "2-HIGH", 2).when(c == "3-MEDIUM", 1).otherwise(0)
    return relational.latest(table(spark, d, "orders").withColumn("rank", rank), ["o_custkey"], ["rank", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)::INT AS attempt FROM events WHERE event_type IN ('error', 'purchase')")
def attempt_numbering(spark: SparkSession, d: str) -> DataFrame:
    """W-7."""
    some = table(spark, d, "events").where(F.col("event_type").isin("error", "purchase"))
    return relational.attempt_numbers(some, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_id", "attempt")


@query("""
WITH c AS (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'assistant') AS a FROM conversations GROUP BY 1)
SELECT d.conv_id, coalesce(n, 0) + 1 AS expected, coalesce(a, 0) AS available_children FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN c ON d.conv_id = c.conv_id""")
def parent_completeness(spark: SparkSession, d: str) -> DataFrame:
    """J-23: expected and available children of each parent."""
    turns = table(spark, d, "conversations")
    return relational.completeness(turns.select("conv_id").distinct(), turns, "conv_id", F.col("role") == "assistant")


@query("""
SELECT conv_id, count(*) AS turn_count, md5(string_agg(turn || ':' || role, ',' ORDER BY turn)) AS roles_md5, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1""")
def nested_export(spark: SparkSession, d: str) -> DataFrame:
    """SNK-9, A-25: parents with their children in order, and a digest of the nested form."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    full = relational.nested(turns.select("conv_id").distinct(), turns, "conv_id", "turns", ["turn"])
    roles = F.array_join(F.transform("turns", lambda t: F.concat_ws(":", t["turn"].cast("string"), t["role"])), ",")
    return full.select("conv_id", F.size("turns").cast("bigint").alias("turn_count"), F.md5(roles.cast("binary")).alias("roles_md5"), F.aggregate("turns", F.lit(0).cast("bigint"), lambda a, t: a + t["n"]).alias("n_chars"))


@query("""
WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey, CASE WHEN new.o_orderkey IS NULL OR old.o_orderstatus = 'F' THEN old.o_orderstatus ELSE new.o_orderstatus END AS o_orderstatus,
       CASE WHEN new.o_orderkey IS NULL OR old.o_orderstatus = 'F' THEN old.o_totalprice ELSE new.o_totalprice END AS o_totalprice
FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    """DML-3: new rows replace old ones unless those have succeeded."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.where("o_orderkey % 2 = 0").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2})
    return relational.upsert_keeping(orders.where("o_orderkey % 3 <> 0"), new, ["o_orderkey"], F.col("o_orderstatus") == "F")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'N' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0")
def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    """DML-1."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return relational.insert_if_absent(orders.where("o_orderkey % 3 <> 0"), orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"], ["o_orderstatus"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'R' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0")
def insert_or_replace(spark: SparkSession, d: str) -> DataFrame:
    """DML-2."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return relational.replace_by_key(orders.where("o_orderkey % 3 <> 0"), orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("R")), ["o_orderkey"])


def _judged(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    size = F.when(F.col("n_chars") < 1000, "short").when(F.col("n_chars") < 4000, "medium").otherwise("long")
    return docs.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.col("lang").alias("truth"), F.when(size == "short", "en").when(size == "medium", F.col("lang")).otherwise("fr").alias("predicted"), (F.col("quality") == 1).alias("good"), (F.col("n_chars") >= 1000).alias("called_good"))


_JUDGED = """SELECT d.doc_id, d.lang AS truth, CASE WHEN n_chars < 1000 THEN 'en' WHEN n_chars < 4000 THEN d.lang ELSE 'fr' END AS predicted, quality = 1 AS good, n_chars >= 1000 AS called_good
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


@query(f"SELECT truth, predicted, count(*) AS n FROM ({_JUDGED}) GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    """A-20, J-22."""
    return evaluation.confusion(_judged(spark, d), "truth", "predicted")


@query(f"""
WITH j AS ({_JUDGED}), c AS (SELECT truth AS class FROM j UNION SELECT predicted FROM j),
 m AS (SELECT class, (SELECT count(*) FROM j WHERE truth = class) AS support, (SELECT count(*) FROM j WHERE j.predicted = class) AS predicted, (SELECT count(*) FROM j WHERE truth = class AND j.predicted = class) AS hits FROM c),
 p AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END::DOUBLE AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0.0 END::DOUBLE AS recall FROM m)
SELECT class, support, predicted, hits, round(precision, 9) AS precision, round(recall, 9) AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 9) AS f1 FROM p""")
def role_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A-20: precision, recall and F1 by class."""
    found = evaluation.class_metrics(evaluation.confusion(_judged(spark, d), "truth", "predicted"))
    return found.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(f"""
WITH c AS (SELECT count(*) FILTER (good AND called_good) AS tp, count(*) FILTER (NOT good AND called_good) AS fp, count(*) FILTER (good AND NOT called_good) AS fn FROM ({_JUDGED}))
SELECT tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9)::DOUBLE AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9)::DOUBLE AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9)::DOUBLE AS f1 FROM c""")
def binary_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A-21."""
    found = evaluation.binary_metrics(_judged(spark, d), F.col("good"), F.col("called_good"))
    return found.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(f"SELECT count(*) > 0 AS has_rows, count(*) FILTER (truth IS NULL) = 0 AS no_null_truth, count(DISTINCT doc_id) = count(*) AS unique_items, avg(CASE WHEN good THEN 1.0 ELSE 0.0 END) >= 0.9 AS mostly_good, count(*) > 0 AND count(*) FILTER (truth IS NULL) = 0 AND count(DISTINCT doc_id) = count(*) AND avg(CASE WHEN good THEN 1.0 ELSE 0.0 END) >= 0.9 AS passed FROM ({_JUDGED})")
def gate_vector(spark: SparkSession, d: str) -> DataFrame:
    """A-24."""
    c = F.col
    return evaluation.gates(_judged(spark, d), has_rows=F.count(F.lit(1)) > 0, no_null_truth=F.count_if(c("truth").isNull()) == 0, unique_items=F.count_distinct("doc_id") == F.count(F.lit(1)), mostly_good=F.avg(c("good").cast("double")) >= 0.9)


@query("""
SELECT 'unique_order' AS rule, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'unique_line', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
UNION ALL SELECT 'line_has_order', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
UNION ALL SELECT 'label_has_document', (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id))
UNION ALL SELECT 'discount_range', (SELECT count(*) FROM lineitem WHERE NOT (l_discount BETWEEN 0 AND 0.05))
UNION ALL SELECT 'urgent_is_dear', (SELECT count(*) FROM orders WHERE NOT (o_orderpriority <> '1-URGENT' OR o_totalprice > 1000))""")
def integrity_checks(spark: SparkSession, d: str) -> DataFrame:
    """Section 1.5: primary keys, foreign keys and value rules as one report."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    return checks.report(
        checks.unique(orders, "unique_order", "o_orderkey"),
        checks.unique(lines, "unique_line", "l_orderkey", "l_linenumber"),
        checks.foreign_key(lines, orders, "line_has_order", "l_orderkey", "o_orderkey"),
        checks.foreign_key(table(spark, d, "labels"), table(spark, d, "documents"), "label_has_document", "doc_id", "doc_id"),
        checks.holds(lines, "discount_range", F.col("l_discount").between(0, 0.05)),
        checks.holds(orders, "urgent_is_dear", (F.col("o_orderpriority") != "1-URGENT") | (F.col("o_totalprice") > 1000)),
    )


@query("""
WITH a AS (SELECT page_id AS k, md5(html) AS h FROM pages WHERE page_id % 10 <> 0), b AS (SELECT page_id AS k, CASE WHEN page_id % 6 = 0 THEN md5('x' || html) ELSE md5(html) END AS h FROM pages WHERE page_id % 11 <> 0)
SELECT coalesce(a.k, b.k) AS page_id, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'modified' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.h <> b.h""")
def inventory_changes(spark: SparkSession, d: str) -> DataFrame:
    """U-B: what changed between two inventories."""
    pages = table(spark, d, "pages")
    before = pages.where("page_id % 10 <> 0").select("page_id", F.md5(F.col("html").cast("binary")).alias("sha256"))
    after = pages.where("page_id % 11 <> 0").select("page_id", F.md5(F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("x"), "html")).otherwise(F.col("html")).cast("binary")).alias("sha256"))
    return checks.changed_paths(before, after, "page_id")


@query("""
WITH u AS (SELECT event_id, event_type = 'view' AS cached, event_type = 'error' AS failed FROM events)
SELECT count(*) AS units, count(*) FILTER (cached) AS cache_hits, count(*) FILTER (NOT cached) AS calls, CAST(ceil(count(*) FILTER (NOT cached) * 1.2) AS BIGINT) AS suggested_cap, 2 * count(*) FILTER (NOT cached) AS worst_case, count(*) FILTER (NOT cached AND failed) AS retries FROM u""")
def call_planning(spark: SparkSession, d: str) -> DataFrame:
    """A-28."""
    kind = F.col("event_type")
    return evaluation.call_plan(table(spark, d, "events"), kind == "view", kind == "error")
