"""Sources and sinks as queries: each writes files from the given tables, reads them back and gives what came of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.functions import geometry, ids, text
from tintwell.operators import checks, entities, relational
from tintwell.operators.ranking import numbered
from tintwell.operators.scratch import folder
from tintwell.plans.registry import query, table
from tintwell.sources import readers, writers


def _catalogue(spark: SparkSession, d: str) -> str:
    """nation as one CSV file with a byte order mark, quotes, commas and line breaks in its values."""
    path, rows = folder(spark, "catalogue"), table(spark, d, "nation")
    note = F.concat(F.lit('a "b", '), F.col("n_name"), F.lit("\nnext"))
    lists = F.to_json(F.array(*(F.concat(F.lit(f"https://h/{k}/"), F.col("n_nationkey").cast("string"), F.lit(".jpg")) for k in range(2))))
    one = rows.repartition(1).sortWithinPartitions("n_nationkey")
    one.select(F.col("n_nationkey").alias("﻿asset_id"), F.col("n_name").alias("brand_name"), note.alias("sku_name"), lists.alias("pic_list"), F.lit("[]").alias("show_pic")).write.csv(path, header=True, escape='"', quoteAll=True)
    return path


NATION_COLUMNS = ("asset_id", "brand_name", "sku_name", "pic_list", "show_pic")


@query("SELECT n_nationkey::VARCHAR AS asset_id, n_name AS brand_name, 'a \"b\", ' || n_name || chr(10) || 'next' AS sku_name, row_number() OVER (ORDER BY n_nationkey) + 1 AS row_number FROM nation")
def catalog_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1, SRC-3: a catalogue with a byte order mark and quoted line breaks; records are numbered from 2."""
    return readers.catalog(spark, _catalogue(spark, d), NATION_COLUMNS).select("asset_id", "brand_name", "sku_name", F.col("row_number").cast("bigint").alias("row_number"))


@query("SELECT n_nationkey::VARCHAR AS asset_id, n_name AS brand_name FROM nation ORDER BY n_nationkey LIMIT 10")
def catalog_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-2: no more than a number of records; the limit is the feature."""
    return readers.catalog(spark, _catalogue(spark, d), NATION_COLUMNS, max_rows=10).select("asset_id", "brand_name")


@query("""
SELECT dense_rank() OVER (ORDER BY n_nationkey) + 1 AS row_number, 'pic_list' AS field_name, k + 1 AS position, 'https://h/' || k || '/' || n_nationkey || '.jpg' AS url
FROM nation, (VALUES (0), (1)) t(k)""")
def catalog_image_refs(spark: SparkSession, d: str) -> DataFrame:
    """The URLs of a catalogue's list fields, each with its place."""
    refs = readers.image_refs(readers.catalog(spark, _catalogue(spark, d), NATION_COLUMNS))
    return refs.select(F.col("row_number").cast("bigint").alias("row_number"), "field_name", F.col("position").cast("int").alias("position"), "url")


@query("""
SELECT page_id, CASE page_id % 6 WHEN 0 THEN [url, 'second'] WHEN 1 THEN [url] WHEN 2 THEN [url, 'b'] WHEN 3 THEN [url] WHEN 4 THEN [] END::VARCHAR[] AS urls FROM pages""")
def url_lists(spark: SparkSession, d: str) -> DataFrame:
    """ST-11: lists in JSON and as Python literals, objects with url or src, lone texts, none, and what is no list."""
    u, k = F.col("url"), F.col("page_id") % 6
    raw = F.when(k == 0, F.to_json(F.array(u, F.lit(" second ")))).when(k == 1, F.concat(F.lit("['"), u, F.lit("', None]"))).when(k == 2, F.concat(F.lit('[{"url":"'), u, F.lit('"},{"url":"","src":"b"}]')))
    raw = raw.when(k == 3, F.concat(F.lit('"'), u, F.lit('"'))).when(k == 4, F.lit("None")).otherwise(F.lit("oops("))
    return table(spark, d, "pages").select("page_id", text.image_urls(raw).alias("urls"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SRC-9, SRC-10, SNK-12: canonical JSON lines read back under a schema."""
    rows, path = table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), folder(spark, "lines")
    writers.json_lines(rows, path, ["conv_id", "turn"])
    return readers.jsonl(spark, path, rows.schema)


_LINE = """'{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}'"""


@query(f"""
WITH h AS (SELECT sha256({_LINE}) AS s FROM orders)
SELECT count(*) AS row_count, sha256(concat_ws('|', {', '.join(f"sum(('0x' || substr(s, {8 * k + 1}, 8))::UBIGINT)::VARCHAR" for k in range(8))})) AS digest FROM h""")
def json_lines_digest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-4 to SNK-6: number and digest of the canonical lines that were written."""
    return writers.json_lines(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), folder(spark, "lines"), ["o_orderkey"])


@query("SELECT DISTINCT 'brand/' || (page_id % 50) || '/x.jpg' AS relative_path, 'i' || (page_id % 50) AS image_id, sha256('c' || (page_id % 50)) AS sha256 FROM pages")
def legacy_metadata_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-8: metadata by normalised path; repeated equal rows count once."""
    k, path = (F.col("page_id") % 50).cast("string"), folder(spark, "metadata")
    raw = F.concat(F.when(F.col("page_id") % 2 == 0, "/brand\\").otherwise("brand/"), k, F.lit("/x.jpg"))
    writers.csv(table(spark, d, "pages").select(raw.alias("relative_path"), F.concat(F.lit("i"), k).alias("image_id"), F.sha2(F.concat(F.lit("c"), k), 256).alias("sha256")), path, ["relative_path", "image_id", "sha256"], ["image_id"])
    return readers.legacy_metadata(spark, path)


@query("""
SELECT sha256('c' || (page_id % 97)) AS sha256, bool_or(page_id % 3 = 0) AS decode_success, bool_or(page_id % 5 = 0) AS has_alpha, bool_or(page_id % 2 = 0) AS is_long,
       max(CASE WHEN page_id % 2 = 0 THEN 5000 ELSE 800 END) AS width, max(700) AS height FROM pages GROUP BY 1""")
def legacy_feature_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-11: a content has a flag if any of its files has it."""
    p, path = F.col("page_id"), folder(spark, "features")
    width = F.when(p % 2 == 0, 5000).otherwise(800)
    rows = table(spark, d, "pages").select(F.sha2(F.concat(F.lit("c"), (p % 97).cast("string")), 256).alias("sha256"), (p % 3 == 0).alias("decode_success"), (p % 5 == 0).alias("has_alpha"), width.alias("width"), F.lit(700).alias("height"))
    rows.write.json(path)
    return readers.legacy_features(spark, path)


@query("SELECT row_number() OVER (ORDER BY s_suppkey)::INT AS sequence, sha256(s_name) AS image_id, 'run-1' AS source_quick_run_id, 'nation ' || s_nationkey AS selection_reason FROM supplier")
def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-12, SRC-13: a manifest that keeps all rules, in its sequence."""
    path, digest = folder(spark, "manifest"), F.sha2("s_name", 256)
    rows = numbered(table(spark, d, "supplier"), ["s_suppkey"], "sequence")
    rows.select(F.lit("v1").alias("schema_version"), F.lit("m1").alias("manifest_version"), F.col("sequence").cast("int").alias("sequence"), digest.alias("image_id"), digest.alias("sha256"), F.lit("run-1").alias("source_quick_run_id"), F.concat(F.lit("nation "), F.col("s_nationkey")).alias("selection_reason")).write.json(path)
    return readers.similarity_manifest(spark, path, "v1").select("sequence", "image_id", "source_quick_run_id", "selection_reason")


@query("""
WITH p AS (SELECT CASE WHEN page_id % 7 = 0 THEN 'exact' ELSE 'near' END AS kind, 'c' || lpad((page_id % 40)::VARCHAR, 2, '0') AS a, 'c' || lpad((page_id % 23)::VARCHAR, 2, '0') AS b FROM pages)
SELECT least(a, b) AS left_id, greatest(a, b) AS right_id, abs(substr(a, 2)::INT - substr(b, 2)::INT) % 9 AS phash_distance, 3 AS dhash_distance FROM p WHERE kind <> 'exact' AND a <> b GROUP BY 1, 2, 3""")
def duplicate_pair_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14: pairs with their ends in order, each once; exact and self pairs are left out."""
    p, path = F.col("page_id"), folder(spark, "pairs")
    name = lambda m: F.concat(F.lit("c"), F.lpad((p % m).cast("string"), 2, "0"))
    empty = F.lit("")
    table(spark, d, "pages").select(F.when(p % 7 == 0, "exact").otherwise("near").alias("pair_type"), empty.alias("group_id"), empty.alias("path_a"), empty.alias("path_b"), name(40).alias("sha256_a"), name(23).alias("sha256_b"), empty.alias("phash_a"), empty.alias("phash_b"), (F.abs(p % 40 - p % 23) % 9).alias("phash_distance"), empty.alias("dhash_a"), empty.alias("dhash_b"), F.lit(3).alias("dhash_distance")).write.csv(path, header=True)
    return readers.duplicate_pairs(spark, path)


@query("SELECT n_nationkey, octet_length(encode(n_name)) + 1 AS size_bytes, sha256(n_name || chr(10)) AS sha256, 'UNKNOWN' AS format FROM nation")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4 to SRC-7, SRC-15, SNK-13: files below a folder with size, digest and format by their first bytes."""
    path = folder(spark, "files")
    table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    found = readers.files(spark, path, ("txt",))
    return found.select(F.regexp_extract("relative_path", r"n_nationkey=(\d+)/", 1).cast("int").alias("n_nationkey"), "size_bytes", "sha256", "format")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'replaced' ELSE o_orderstatus END AS status, 'r' || (o_orderkey % 3) AS run_id FROM orders")
def runs_appended_and_replaced(spark: SparkSession, d: str) -> DataFrame:
    """SNK-1 to SNK-3, DML-5: runs are added to a table one by one, then one of them is replaced."""
    path = folder(spark, "runs")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.concat(F.lit("r"), F.col("o_orderkey") % 3).alias("run_id"))
    for run in ("r0", "r1", "r2"):
        writers.append(rows.where(F.col("run_id") == run), path)
    writers.replace_run(rows.where("run_id = 'r1'").withColumn("status", F.lit("replaced")), path)
    return spark.read.parquet(path).select("o_orderkey", "status", "run_id")


@query("""
SELECT a.s_suppkey AS left_id, b.s_suppkey AS right_id, a.s_name AS left_s_name, a.s_nationkey AS left_s_nationkey, b.s_name AS right_s_name, b.s_nationkey AS right_s_nationkey
FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1""")
def pairs_widened(spark: SparkSession, d: str) -> DataFrame:
    """SNK-8, J-11, P-16: pairs with the named columns of both ends."""
    suppliers = table(spark, d, "supplier")
    pairs = suppliers.select(F.col("s_suppkey").alias("left_id"), (F.col("s_suppkey") + 1).alias("right_id"))
    return writers.similarity_export(pairs, suppliers, "s_suppkey", ["s_name", "s_nationkey"])


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_name || ', \"' || s_nationkey || '\"' AS label FROM supplier")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-7, SNK-10, SNK-11, SNK-16: the named columns as CSV, others left out."""
    path = folder(spark, "csv")
    rows = table(spark, d, "supplier").withColumn("label", F.concat("s_name", F.lit(', "'), F.col("s_nationkey"), F.lit('"')))
    writers.csv(rows, path, ["s_suppkey", "s_name", "label"], ["s_suppkey"])
    return spark.read.csv(path, header=True)


@query(r"""
WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '\' || p_brand || '\' || p_name || '\a.jpg' WHEN 1 THEN '/' || p_brand || '/' || p_name || '/a/b.jpg/' WHEN 2 THEN p_brand || '/b.jpg' ELSE 'b.jpg' END AS path FROM part),
     n AS (SELECT p_partkey, path, regexp_replace(replace(path, '\', '/'), '^/+|/+$', '', 'g') AS clean FROM p)
SELECT p_partkey, clean AS relative_path, CASE WHEN len(string_split(clean, '/')) >= 3 THEN string_split(clean, '/')[1] END AS brand, CASE WHEN len(string_split(clean, '/')) >= 3 THEN string_split(clean, '/')[2] END AS product,
       substr(sha256(path), 1, 16) || '-' || substr(sha1(path), 1, 10) AS image_id, 'repo://' || clean AS uri, '/srv/x/' || clean AS resolved FROM n""")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """ST-13, ST-16, ST-17, ST-21: normal form, brand and product, path-dependent id and addresses of paths."""
    k, slash = F.col("p_partkey") % 4, F.lit("/")
    back = F.lit("\\")
    raw = F.when(k == 0, F.concat(back, F.col("p_brand"), back, F.col("p_name"), back, F.lit("a.jpg"))).when(k == 1, F.concat(slash, F.col("p_brand"), slash, F.col("p_name"), F.lit("/a/b.jpg/"))).when(k == 2, F.concat(F.col("p_brand"), F.lit("/b.jpg"))).otherwise("b.jpg")
    rows = table(spark, d, "part").select("p_partkey", raw.alias("path"))
    clean = text.relative_path(F.col("path"))
    uri = text.repo_uri(F.concat(F.lit("/srv/x/"), clean), "/srv/x")
    return rows.select("p_partkey", clean.alias("relative_path"), text.path_brand(F.col("path")).alias("brand"), text.path_product(F.col("path")).alias("product"), ids.path_image_id(F.sha2(F.col("path"), 256), F.col("path")).alias("image_id"), uri.alias("uri"), text.resolve_uri(uri, "/srv/x").alias("resolved"))


@query(r"""
WITH n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ' ' || p_name || '?:  x. ' WHEN 1 THEN 'CON.' || p_name WHEN 2 THEN ' .. ' WHEN 3 THEN repeat(p_name || '|', 30) ELSE p_name END AS raw FROM part),
     t AS (SELECT p_partkey, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS original FROM n),
     c AS (SELECT p_partkey, original, regexp_replace(regexp_replace(regexp_replace(original, '[<>:"/\\|?*\x00-\x1F]', '_', 'g'), '\s+', ' ', 'g'), '[ .]+$', '') AS clean FROM t),
     f AS (SELECT p_partkey, original, CASE WHEN clean = '' THEN 'unnamed' ELSE clean END AS clean FROM c),
     r AS (SELECT p_partkey, original, CASE WHEN regexp_matches(string_split(clean, '.')[1], '(?i)^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$') THEN '_' || clean ELSE clean END AS clean FROM f)
SELECT p_partkey, CASE WHEN length(clean) > 120 THEN rtrim(substr(clean, 1, 109), ' ') || '_' || substr(sha1(original), 1, 10) ELSE clean END AS name FROM r""")
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    """ST-10: names for path components: reserved and empty ones, signs that are not allowed, and long ones."""
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    raw = F.when(k == 0, F.concat(F.lit(" "), name, F.lit("?:  x. "))).when(k == 1, F.concat(F.lit("CON."), name)).when(k == 2, " .. ").when(k == 3, F.repeat(F.concat(name, F.lit("|")), F.lit(30))).otherwise(name)
    return table(spark, d, "part").select("p_partkey", text.safe_component(raw, "unnamed").alias("name"))


@query("SELECT p_partkey, p_partkey % 3 <> 0 AND p_size <= 40 AS valid FROM part")
def polygons_valid(spark: SparkSession, d: str) -> DataFrame:
    """M-15: at least three points, all within the image."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    two = F.array(point(F.lit(0), F.lit(0)), point(F.col("p_size"), F.lit(1)))
    shape = F.when(F.col("p_partkey") % 3 == 0, two).otherwise(F.concat(two, F.array(point(F.lit(40), F.lit(40)))))
    return table(spark, d, "part").select("p_partkey", geometry.polygon_is_valid(shape, F.lit(40), F.lit(40)).alias("valid"))


@query("SELECT column_name FROM (VALUES ('o_custkey'), ('o_totalprice')) t(column_name)")
def columns_forbidden(spark: SparkSession, d: str) -> DataFrame:
    """P-15: columns of a table that must not be there."""
    found = checks.forbidden_columns(table(spark, d, "orders"), {"O_CUSTKEY", "o_totalprice", "price"})
    return spark.range(1).select(F.explode(F.array_sort(F.array(*map(F.lit, sorted(found))))).alias("column_name"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem), o AS (SELECT o_orderkey FROM orders)
SELECT o_orderkey, coalesce((SELECT list('code ' || l_partkey ORDER BY l_linenumber, 'code ' || l_partkey) FROM l WHERE l_orderkey = o_orderkey AND l_linenumber % 2 = 1 AND l_linenumber <= 4), []) AS linked_texts FROM o""")
def linked_texts(spark: SparkSession, d: str) -> DataFrame:
    """J-19: the codes among the texts that a region links to, in order of their ids."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("text_id"), F.when(F.col("l_linenumber") % 2 == 1, "shade_code").otherwise("other").alias("text_type"), F.concat(F.lit("code "), F.col("l_partkey")).alias("normalized_text"))
    regions = table(spark, d, "orders").select(F.col("o_orderkey").alias("image_id"), F.lit(1).alias("region_id"), F.array(*(F.lit(k) for k in (3, 1, 2, 4, 1))).alias("linked_ids"))
    return entities.linked_codes(regions, lines).select(F.col("image_id").alias("o_orderkey"), "linked_texts")


@query("""
WITH a AS (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'padded_preview' ELSE 'tile' END AS asset_type, l_orderkey * 10 + l_linenumber AS asset_id, l_partkey % 5 AS created_at FROM lineitem)
SELECT l_orderkey, asset_id FROM (SELECT l_orderkey, asset_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY asset_type = 'padded_preview' DESC, created_at DESC, asset_id DESC) AS p FROM a) WHERE p = 1""")
def assets_preferred(spark: SparkSession, d: str) -> DataFrame:
    """A-19: of each image a padded preview before others, then the latest."""
    n = F.col("l_linenumber")
    assets = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image_id"), F.lit("image").alias("scope"), F.lit(0).alias("tile_index"), F.when(n % 3 == 0, "padded_preview").otherwise("tile").alias("asset_type"), (F.col("l_partkey") % 5).alias("created_at"), (F.col("l_orderkey") * 10 + n).alias("asset_id"))
    return entities.preferred_assets(assets).select(F.col("image_id").alias("l_orderkey"), "asset_id")


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey % 7 / 10.0 AS confidence, l_linenumber % 4 AS s, CASE WHEN l_partkey % 5 = 0 THEN 'failed' WHEN l_partkey % 5 = 1 THEN 'skipped' WHEN l_partkey % 5 = 2 THEN 'cache_hit' ELSE 'succeeded' END AS status FROM lineitem),
     g AS (SELECT l_orderkey, arg_max('role ' || l_linenumber, s * 1000000 + confidence * 100000 + l_linenumber) FILTER (WHERE status IN ('succeeded', 'cache_hit')) AS role, arg_max(s, s * 1000000 + confidence * 100000 + l_linenumber) FILTER (WHERE status IN ('succeeded', 'cache_hit')) AS scope,
                  count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped, list_sort(list_distinct(list('risk ' || (l_partkey % 3)))) AS risks FROM (SELECT a.*, l.l_partkey FROM a JOIN lineitem l USING (l_orderkey, l_linenumber)) a GROUP BY 1)
SELECT l_orderkey, role, CASE WHEN role IS NULL AND skipped > 0 AND failed = 0 THEN 'skipped' WHEN role IS NULL THEN 'failed' WHEN failed > 0 OR scope = 0 THEN 'partial' ELSE 'success' END AS status, risks FROM g""")
def roles_of_images(spark: SparkSession, d: str) -> DataFrame:
    """A-18: an image's role from the preferred scope and the most confident unit, and the outcome of its units."""
    n, p = F.col("l_linenumber"), F.col("l_partkey")
    scope = F.when(n % 4 == 3, "merged_content_summary").when(n % 4 == 2, "image").when(n % 4 == 1, "global_thumbnail").otherwise("tile")
    status = F.when(p % 5 == 0, "failed").when(p % 5 == 1, "skipped").when(p % 5 == 2, "cache_hit").otherwise("succeeded")
    units = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image_id"), n.alias("unit_id"), scope.alias("scope"), status.alias("status"), F.concat(F.lit("role "), n).alias("role"), (p % 7 / 10).alias("confidence"), F.array(F.concat(F.lit("risk "), p % 3)).alias("risks"))
    return entities.image_roles(units).select(F.col("image_id").alias("l_orderkey"), "role", "status", "risks")


@query("""
SELECT p_partkey, list_filter([CASE WHEN p_size % 7 = 0 THEN 'invalid_linked_text_item_ids' END,
       CASE p_partkey % 4 WHEN 0 THEN 'no_linked_shade_code' WHEN 1 THEN 'shade_code_unparseable' WHEN 2 THEN 'shade_code_ambiguous' END,
       CASE WHEN p_partkey % 4 = 3 AND p_size % 3 = 0 THEN 'direct_linked_shade_code_conflict' END, CASE WHEN p_size % 11 = 0 THEN 'color_problem' END,
       CASE WHEN p_size % 2 = 0 THEN 'extraction_status_failed' END, CASE WHEN p_size % 5 = 0 THEN 'unexpected_source_semantics' END, CASE WHEN p_partkey % 5 = 0 THEN 'region_type_not_formal' END,
       CASE WHEN p_partkey % 6 = 0 THEN 'color_confidence_not_accepted' END, CASE WHEN p_partkey % 7 = 0 THEN 'missing_association_confidence' END], lambda x: x IS NOT NULL) AS reasons FROM part""")
def reasons_of_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """P-11: every reason, in order, why an observation is left out."""
    k, s = F.col("p_partkey"), F.col("p_size")
    codes = lambda *c: F.array(*map(F.lit, c)).cast("array<string>")
    tokens = F.when(k % 4 == 1, codes()).when(k % 4 == 2, codes("A1", "A2")).when(k % 4 == 3, codes("A1"))
    direct = F.when(s % 3 == 0, codes("B9")).otherwise(codes())
    kind = lambda hit, good, bad: F.when(hit, bad).otherwise(good)
    reasons = entities.exclusion_reasons(s % 7 == 0, tokens, direct, F.when(s % 11 == 0, "color_problem"), kind(s % 2 == 0, "succeeded", "failed"), kind(s % 5 == 0, "image_observed_color_candidate", "other"), kind(k % 5 == 0, "swatch", "lip"), kind(k % 6 == 0, "high", "low"), F.when(k % 7 != 0, 0.9))
    return table(spark, d, "part").select("p_partkey", reasons.alias("reasons"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND source IN (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 2)")
def rows_narrowed(spark: SparkSession, d: str) -> DataFrame:
    """P-9: predicates that are there only if they are asked for."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    top = [r.source for r in docs.groupBy("source").count().orderBy(F.desc("count"), "source").limit(2).collect()]
    return relational.narrowed(docs, lang="en", source=top, doc_id=None)


@query("""
SELECT 'folder' AS selector, page_id FROM pages WHERE starts_with(url, 'http://therwh.example.org/') UNION ALL SELECT 'key', page_id FROM pages WHERE page_id = 7
UNION ALL SELECT 'list', page_id FROM pages WHERE page_id IN (SELECT o_orderkey FROM orders) UNION ALL (SELECT 'first', page_id FROM pages ORDER BY lower(url), url, page_id LIMIT 5)""")
def rows_selected(spark: SparkSession, d: str) -> DataFrame:
    """P-10: each of the selectors of which exactly one is to be given."""
    pages = table(spark, d, "pages").select("page_id", "url")
    listed = table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"))
    by = {"folder": {"folder": "http://therwh.example.org"}, "key": {"one": 7}, "list": {"listed": listed}, "first": {"limit": 5}}
    parts = [relational.selected(pages, "page_id", "url", **how).select(F.lit(name).alias("selector"), "page_id") for name, how in by.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
