"""Exact duplicates by a tree merge of sorted digest runs; DataFrame functions only.

Every document gives a digest of its normalised text. Leaves of a tree hold one run each: the distinct digests of a shard in sorted
order with their smallest identifier and row count. Rounds of the tree merge ``FAN_IN`` neighbouring runs at once: their rows
are exchanged by (run above, digest), put in order of the digest and folded by one pass over the sorted rows, so what leaves a round is
again a sorted run. The smallest identifier is kept as (is null, identifier), an ordered pair, which Spark folds over sorted rows and
never in a hash table; memory does not depend on the number of digests. The last run's rows still lie spread over all partitions. Verdicts
go down the same tree by merge joins with the runs below, so a digest that a third of all rows share meets at most ``FAN_IN`` rows per
key on the way up and one leaf's share on the way down: no key is ever gathered. The tree grows a level whenever a leaf would hold more
than ``LEAF_ROWS`` rows.

A digest counts as equal only if SHA-256, an independent 64-bit hash and the byte length agree; all three
travel in the run key and are compared at every level.

Nulls count as empty text; empty texts equal each other. Repeated rows of one id form one group with that id and
are all kept. A null id sorts after every other id and stays only if the whole group has null ids. An empty table gives an empty result. A
text of any length is one row and is hashed as a whole. Other columns may have any names: ``exact_groups`` carries none of them along, and
``dedup`` joins on names of its own (``__id``, ``__sha``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.plans.staging import stage

NAME = "op2_exact_dedup"
FAN_IN = 16
LEVELS = 2
#: Rows of a leaf from which on the tree gets another level.
LEAF_ROWS = 4_000_000
KEY = ["_sha", "_check", "_bytes"]

SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def tree_levels(rows: int) -> int:
    """Levels of the tree: at least LEVELS, and as many as bring a leaf down to LEAF_ROWS."""
    levels = LEVELS
    while rows > LEAF_ROWS * FAN_IN**levels:
        levels += 1
    return levels


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id and run key."""
    text = normalised(F.col(text_column))
    return docs.select(F.col(id_column).alias("_id"), text.alias("_text")).select(
        "_id",
        F.unhex(F.sha2("_text", 256)).alias("_sha"),
        F.xxhash64("_text").alias("_check"),
        F.octet_length("_text").cast("long").alias("_bytes"),
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """One merge of sorted runs with the same number: smallest id (nulls last) and row count of every verified key, in sorted order."""
    return runs.groupBy("_run", *KEY).agg(F.min("_keep").alias("_keep"), F.sum("_rows").alias("_rows"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_sha``, ``keep_id``, ``group_size``.

    The digest table (about 60 bytes a document) is staged, so texts are read and hashed once. A row's leaf depends on its id alone, so
    reruns of a task agree.
    """
    staged = stage(digests(docs, id_column, text_column), "digests")
    levels = tree_levels(staged.count())  # from the files' footers
    leaf_rows = staged.withColumn("_run", F.pmod(F.xxhash64("_id"), F.lit(FAN_IN**levels)).cast("int"))
    own = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"))
    level = merge_runs(leaf_rows.withColumns({"_keep": own, "_rows": F.lit(1).cast("long")}))
    runs = [level]
    for _ in range(levels):
        level = merge_runs(level.withColumn("_run", F.floor(F.col("_run") / FAN_IN).cast("int")))
        runs.append(level)
    verdict = runs.pop()
    while runs:
        # the run above must know an id that is no larger and a group that is no smaller; both also keep the run below as it was
        # merged on the way up, so its exchange is read again and not made again
        below = runs.pop().withColumnsRenamed({"_keep": "_own", "_rows": "_own_rows"}).withColumn("_up", F.floor(F.col("_run") / FAN_IN).cast("int"))
        down = verdict.withColumnRenamed("_run", "_up")
        known = down.join(below, ["_up", *KEY]).where((F.col("_keep") <= F.col("_own")) & (F.col("_rows") >= F.col("_own_rows")))
        verdict = known.select("_run", *KEY, "_keep", "_rows")
    return leaf_rows.join(verdict, ["_run", *KEY]).select(
        "_id", "_sha", F.col("_keep.id").alias("keep_id"), F.col("_rows").alias("group_size")
    )


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = [F.col(c) for c in docs.columns]
    gone = exact_groups(docs, id_column, text_column).where(~F.col("_id").eqNullSafe(F.col("keep_id")))
    gone = gone.select(F.col("_id").alias("__id"), F.col("_sha").alias("__sha")).distinct()
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.unhex(F.sha2(normalised(F.col(text_column)), 256)) == F.col("__sha"))
    return docs.join(gone, same, "left_anti").select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
