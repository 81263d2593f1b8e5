"""Exact duplicate detection by a tree-merge of sorted digest runs, with DataFrame functions only.

Rows are dealt by id over runs, a power of two of them. A run is sorted by digest and holds each digest once, with the
smallest id that has it. Runs then meet in binomial rounds: in each round every run is exchanged with its neighbour, the
two are merged in the order of their digests, and half as many runs are left, until one is, dealt by digest over all
tasks. Every merge verifies that digests are of equal texts by length and a second checksum, keeps the smallest id, adds
up the rows and notes the runs that they came from. So no merge has more than two rows of a text, be it a third of all.
Groups of several rows travel back under the runs they came from; a row that meets none is alone. Most rows are, and stay
where they lie: a bitmap of the groups' checksums, broadcast, says which rows may meet one, and these alone are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintwell.operators.scratch import staged

SPACES = r"[\x20\x09-\x0D]+"
KEY = ["_digest", "_bytes", "_check"]
WORD = 64  # runs to a number of the note, and checksums to a number of the bitmap


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _with_key(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    norm = normalised(F.col(text_col)).cast("binary")
    return docs.select(
        F.struct("*").alias("_row"),  # as one column, so that no name of docs meets one of these
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(norm, 256)).alias("_digest"),
        F.octet_length(norm).alias("_bytes"),
        F.xxhash64(norm).alias("_check"),
        F.pmod(F.xxhash64(F.lit("run"), F.col(id_col)), F.lit(runs)).cast("int").alias("_run"),
    )


def merged_runs(keyed: DataFrame, runs: int) -> DataFrame:
    """(key, least, n, and the note) of every digest: least holds the smallest id and how many rows have it.

    The struct in least makes Spark merge in sorted order; a null id is behind every other one.
    """
    note = [f"_from{k}" for k in range(-(-runs // WORD))]
    ids = keyed.groupBy(*KEY, "_run", "_id").agg(F.min(F.struct(F.isnull("_id").alias("none"), F.col("_id").alias("id"))).alias("own"), F.count(F.lit(1)).alias("n"))
    level = ids.groupBy(*KEY, "_run").agg(F.min(F.struct("own.none", "own.id", F.col("n").alias("times"))).alias("least"), F.sum("n").alias("n"))
    bit = F.expr(f"shiftleft(1L, _run % {WORD})")
    level = level.select("*", *(F.when(F.floor(F.col("_run") / WORD) == k, bit).otherwise(F.lit(0).cast("bigint")).alias(c) for k, c in enumerate(note)))
    while runs > 1:
        runs = -(-runs // 2)
        level = level.withColumn("_run", F.shiftright("_run", 1))
        level = level.groupBy(*KEY, "_run").agg(F.min("least").alias("least"), F.sum("n").alias("n"), *(F.bit_or(c).alias(c) for c in note))
    return level.select(*KEY, "least", "n", F.array(*note).alias("note"))


def _looked_up(keyed: DataFrame, groups: DataFrame, bits: int) -> DataFrame:
    """keyed with _may: false only if no group has the row's checksum. The bitmap has ``bits`` bits, whatever groups there are."""
    word, bit = F.shiftrightunsigned("_check", 6) % (bits // WORD), F.col("_check").bitwiseAND(WORD - 1).cast("int")
    bitmap = groups.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits"))
    held = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1
    met = keyed.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left")
    return met.withColumn("_may", F.coalesce(held, F.lit(False))).drop("_word", "_bits")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 256, bits: int = 1 << 24) -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256 added.

    Texts are equal when they are identical after each run of ASCII white space has become one space; a null text counts
    as empty. Equality is the SHA-256 digest, verified by byte length and an independent 64-bit checksum, which are part
    of every merge key. The row with the smallest id of a group is kept. Of repeated rows with one id and one text,
    exactly one is kept. A null id ranks behind every other id; a group of null ids only has keep_id null and one kept
    row. Columns of docs named like an added column are replaced. An empty table gives an empty result. ``bits``, the size
    of the bitmap, says how many rows are dealt out needlessly; it changes no result.
    """
    if runs < 1 or runs & (runs - 1):
        raise ValueError("runs must be a power of two")
    if bits < WORD or bits & (bits - 1):
        raise ValueError(f"bits must be a power of two from {WORD} on")
    out = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in out and c not in (id_col, text_col)))
    keyed = _with_key(docs, id_col, text_col, runs)
    came_from = F.expr(f"filter(sequence(0, {runs - 1}), r -> (shiftrightunsigned(element_at(note, int(r div {WORD}) + 1), r % {WORD}) & 1) = 1)")
    groups = merged_runs(keyed, runs).where("n > 1").select(*KEY, F.col("least.id").alias("keep_id"), F.col("least.times").alias("times"), F.col("n").alias("group_size"), F.explode(came_from).alias("_run"))
    groups = staged(groups.withColumn("_found", F.lit(True)), "digest-groups")
    looked = _looked_up(keyed, groups, bits)
    joined = looked.where("_may").drop("_may").join(groups, [*KEY, "_run"], "left")
    first = F.col("_found").isNull() | F.col("_id").eqNullSafe(F.col("keep_id"))
    tie = F.coalesce(first & (F.col("times") > 1), F.lit(False))
    if groups.where("times > 1").isEmpty():
        done = joined.withColumn("kept", first)
    else:  # rows that share the id that stays, too
        place = F.row_number().over(Window.partitionBy(*KEY).orderBy("_id"))
        done = joined.where(~tie).withColumn("kept", first).unionByName(joined.where(tie).withColumn("kept", place == 1))
    alone = looked.where(~F.col("_may")).drop("_may").withColumn("kept", F.lit(True))
    done = done.unionByName(alone, allowMissingColumns=True)
    return done.select(
        *(F.col("_row")[c].alias(c) for c in docs.columns),
        F.when(F.col("_found").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        "kept",
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )
