"""Sinks: run-scoped tables, canonical JSON lines, CSV exports and manifests of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition: str | None = "run_id") -> None:
    """Add rows to a table, in folders by run where it has one (SNK-1 to SNK-3)."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition and partition in df.columns else writer).parquet(path)


def once(df: DataFrame, path: str) -> None:
    """Write a table that must not be there yet."""
    df.write.mode("errorifexists").parquet(path)


def replace_run(df: DataFrame, path: str) -> None:
    """Replace the partitions of the runs in df and no others (DML-5)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def json_lines(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Write canonical JSON lines in key order and give one row of their number and digest (SNK-4 to SNK-6).

    Fields are in name order with nulls written out. Files are written in ranges of the keys, so no task has the whole
    table. The digest is that of the sums, over all lines, of the eight parts of their SHA-256: two tables have the same one
    if they hold the same lines equally often, however they are split into files.
    """
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.select(line.alias("value")).write.mode("errorifexists").text(path)
    words = [F.conv(F.substring(F.sha2(line, 256), 8 * k + 1, 8), 16, 10).cast("decimal(38,0)") for k in range(8)]
    sums = F.concat_ws("|", *(F.coalesce(F.sum(w), F.lit(0)).cast("string") for w in words))
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sha2(sums, 256).alias("digest"))


def csv(df: DataFrame, path: str, columns: list[str], keys: list[str]) -> None:
    """CSV of the named columns in key order; nested ones as JSON (SNK-7, SNK-10 to SNK-12, SNK-16)."""
    flat = [F.to_json(c).alias(c) if df.schema[c].dataType.typeName() in ("array", "struct", "map") else F.col(c) for c in columns]
    df.select(*flat).repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("errorifexists").csv(path, header=True)


def similarity_export(pairs: DataFrame, profiles: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Pairs widened by the named profile columns of both ends (SNK-8, J-11, P-16)."""
    side = lambda s: profiles.select(F.col(key).alias(f"{s}_id"), *(F.col(c).alias(f"{s}_{c}") for c in columns))
    return pairs.join(side("left"), "left_id").join(side("right"), "right_id")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, size_bytes, sha256) of every file below a folder (SNK-13)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return df.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
