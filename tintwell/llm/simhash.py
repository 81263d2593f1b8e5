"""SimHash near-duplicates: pigeonhole blocks propose pairs of fingerprints, the Hamming distance decides."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintwell.operators.graph import components
from tintwell.operators.scratch import bounded_batches, staged

#: Blocks of the 64 bits; pairs at a distance of at most 2 agree in at least two of the four.
BLOCKS, SEED = 4, 42


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of word shingles as a signed 64-bit number; 0 for a text without words or a null text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and ASCII white space alone
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_digest
    total, ones = 0, np.zeros(64, np.int64)
    hashes = b"".join([digest(s, SEED) for s in shingles])
    view = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, len(view), 8192):
        block = np.unpackbits(view[at : at + 8192], axis=1)
        ones += np.add.reduce(block, axis=0, dtype=np.int32)
        total += len(block)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp long) of every row, from whole texts, where the rows lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return bounded_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def links(fps: DataFrame, within: int = 2, bucket: int = 64) -> DataFrame:
    """Edges (u, v) that join all fingerprints of the distinct column fp that are within the distance.

    Two fingerprints at a distance of at most 2 agree in two of four 16-bit blocks, so a join on each pair of blocks
    proposes every such pair; bit_count verifies it. A bucket of more than ``bucket`` fingerprints is not joined with
    itself. Its members are dealt to the 65 words within one bit of each: two fingerprints are within 2 bits exactly if
    they share such a word, and a word has at most 65 of them. That is exact for any size of bucket, and linear.
    """
    if within != 2:
        raise ValueError("the blocks are laid out for a distance of 2")
    part = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF) for k in range(BLOCKS)]
    keys = F.array(*(F.struct(F.lit(n).alias("c"), F.shiftleft(part[i], 16).bitwiseOR(part[j]).alias("k")) for n, (i, j) in enumerate(combinations(range(BLOCKS), 2))))
    dealt = fps.select("fp", F.inline(keys))
    sizes = staged(dealt.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    few = dealt.join(sizes.where(f"n <= {bucket}").select("c", "k"), ["c", "k"])
    pairs = few.select("c", "k", F.col("fp").alias("u")).join(few.select("c", "k", F.col("fp").alias("v")), ["c", "k"]).where("u > v and bit_count(u ^ v) <= 2").select("u", "v")
    many = dealt.join(sizes.where(f"n > {bucket}").select("c", "k"), ["c", "k"]).select("fp").distinct()
    near = F.array(F.lit(0).cast("bigint"), *(F.expr(f"shiftleft(1L, {b})") for b in range(64)))
    words = many.select("fp", F.explode(near).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("word"))
    hubs = words.groupBy("word").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = words.join(hubs.select("word", "v"), "word").where("fp <> v and bit_count(fp ^ v) <= 2").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, runs: int = 64) -> DataFrame:
    """(id, fingerprint, component_id, fp) of every row.

    Only A-Z are lower-cased, words are parted by ASCII white space. Null and empty texts have fingerprint zero and are
    linked like any other. component_id is the smallest id that can be reached over links of at most 2 bits. Rows with a
    null id have their fingerprint's component; repeated rows are each returned. Other columns are not read.
    """
    rows = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    dealt = rows.withColumn("_run", F.pmod(F.xxhash64(F.lit("run"), F.col(id_col)), F.lit(runs)).cast("int"))
    # A fingerprint may stand for a third of all rows: its smallest id is found run by run, and brought back the same way.
    low = dealt.groupBy("fp", "_run").agg(F.min(id_col).alias("least"))
    each = staged(low.groupBy("fp").agg(F.min("least").alias("least")), "distinct-fingerprints")
    roots = components(links(each.select("fp")))
    # Only linked fingerprints have anything to be told; all others keep their own smallest id.
    linked = each.join(roots.withColumnRenamed("node", "fp"), "fp")
    best = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    salt = F.pmod(F.xxhash64(F.lit("salt"), F.col("fp")), F.lit(16)).cast("int")
    salted = best.select("*", F.explode(F.array(*map(F.lit, range(16)))).alias("s"))
    named = linked.withColumn("s", salt).join(salted, ["root", "s"]).select("fp", "root", "component_id")
    final = staged(each.join(named, "fp", "left").select("fp", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")), "components")
    spread = low.select("fp", "_run").join(final, "fp")
    return dealt.join(spread, ["fp", "_run"]).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")
