"""Exact dedup: tree merge of digest runs, in DataFrame operations only.

Texts are equal when identical after replacing each run of white space by one
space. Every row becomes a digest (SHA-256 of the normalised text, verified by
its length and a second, unrelated hash, which travel with it as part of the
key). The rows are dealt into ``RUNS`` runs by their id; each round merges
``FAN`` runs into one: equal digests of neighbouring runs meet, and the
smallest identifier and the count survive. A group of copies of any size so
reaches a merge as at most one entry a run and round, combined map-side before
it moves. The runs are groups, not sorted files, and merge ``FAN`` at a time, not in
pairs: the README names this departure. The winners then go back down the same tree to the rows, so no join
key holds more than one run's share of a group.

Edge cases: null text counts as empty. Of rows that repeat the same id and
text one stays. Rows without id lose against rows with one; if no row of a
group has an id, one of them stays with a null ``keep_id``. An empty table gives an
empty result. Extra columns are ignored by ``groups`` and kept by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import stored

RUNS, FAN = 256, 16
KEY = ["digest", "length", "check"]


def normalised(text: Column) -> Column:
    """Each run of white space as one space; single spaces are left as they are."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row a document: id, digest key, a row number of its own, run."""
    whole = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("whole"))
    keyed = whole.select("doc_id", F.unhex(F.sha2("whole", 256)).alias("digest"), F.length("whole").alias("length"), F.xxhash64("whole").alias("check"))
    seq = F.monotonically_increasing_id()
    rows = keyed.withColumn("seq", seq)
    return stored(rows.withColumn("run0", F.pmod(F.xxhash64("doc_id", "seq"), F.lit(RUNS)).cast("int")), "digests")


def merged(rows: DataFrame) -> DataFrame:
    """rows with run0 -> rows with ``best`` (the entry that stays) and ``group_size``."""
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "seq")
    level = rows.groupBy("run0", *KEY).agg(F.min(entry).alias("best"), F.count("*").alias("size"))
    tree, width, k = [], RUNS, 0
    while width > 1:
        tree.append(level)
        width, k = -(-width // FAN), k + 1
        level = (
            level.withColumn(f"run{k}", F.shiftright(F.col(f"run{k - 1}"), FAN.bit_length() - 1))
            .groupBy(f"run{k}", *KEY)
            .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        )
        level = stored(level, f"digest-run{k}")
    for down in reversed(range(k)):  # hand the winners back to the runs they came from
        runs = tree[down].select(f"run{down}", *KEY).withColumn(f"run{down + 1}", F.shiftright(F.col(f"run{down}"), FAN.bit_length() - 1))
        level = runs.join(level, [f"run{down + 1}", *KEY]).select(f"run{down}", *KEY, "best", "size")
    return rows.join(level, ["run0", *KEY])


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    return merged(digests(docs, id_col, text_col)).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("seq") == F.col("best.seq")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha"))
    rows = docs.withColumn("_sha", F.sha2(normalised(F.col(text_col)), 256))
    same = rows[id_col].eqNullSafe(F.col("_keep")) & (rows["_sha"] == kept["_sha"])
    rows = rows.join(kept, same, "inner").drop(kept["_sha"]).drop("_keep")
    # rows that repeat both id and text: dropDuplicates leaves one
    return rows.dropDuplicates([id_col, "_sha"]).drop("_sha")
