"""Documents drawn to resemble a target corpus, by importance weights of hashed word features.

A document's words are normalised (lower case, one space between) and scanned once; running CRCs are stored, and the CRC of every run
of one to ``LONGEST`` words, which names its bucket, comes from two of them (``prefix_crc``). One pass counts the buckets of
the corpus and of the target, all rows and whole texts; the driver gets two numbers per bucket. A bucket's gain is the log-ratio of
its share in the target to its share in the corpus, a document's weight the mean gain of its features. A second pass adds Gumbel
noise from a hash of the id, and the highest scores among the documents with enough words are drawn, which is a
draw without replacement in proportion to the weights.

Scores are whole numbers between a few ten thousands, so the cut comes from a table of rows per score, and ranks within a score are
counted by one task per score. Equal rows are ranked together, so an id that a third of all rows repeat is one row there.

Null and empty texts have no words, no features and weight 0; they are never drawn while ``least_words`` is above 0. Very long texts
are scanned in segments that end at words. A null id counts as an empty one in the hash and ranks before others of its
score; repeated rows keep a rank each, in any order. Empty corpus: empty result; empty target: all its counts are 0. Columns other than
id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from floodmark.llm import prefix_crc
from floodmark.llm.textscan import blocks, runs, utf8
from floodmark.plans.staging import stage

NAME = "op12_importance_resampling"
SQL = None
SEED, PERCENT, LEAST_WORDS = 7, 25, 20
BUCKETS, LONGEST = 10_000, 2
#: Text bytes scanned at once; equal rows that one step of a rank spells out.
SEGMENT_BYTES, SPELLED = 4 << 20, 1 << 16

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def segments(column: pa.Array, lead: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, offsets and row numbers of the texts of a column, and how many leading words were given before.

    A text over ``SEGMENT_BYTES`` comes in several segments cut behind words; each repeats up to ``lead`` words of the one before.
    """
    data, offsets = utf8(column)
    n = len(offsets) - 1
    if n != 1 or len(data) <= SEGMENT_BYTES:
        yield data, offsets, np.arange(n), 0
        return
    begin = at = known = 0
    while at < len(data):
        stop = min(at + SEGMENT_BYTES, len(data))
        while stop < len(data) and _WORD[data[stop]]:
            gap = np.flatnonzero(~_WORD[data[stop : stop + SEGMENT_BYTES]])
            stop = stop + int(gap[0]) if len(gap) else min(stop + SEGMENT_BYTES, len(data))
        part = data[begin:stop]
        yield part, np.array([0, len(part)]), np.zeros(1, np.int64), known
        starts, _ = runs(_WORD[part], np.array([0, len(part)]))
        known = min(lead, len(starts))
        begin = begin + int(starts[-known]) if known else stop
        at = stop


def features(data: np.ndarray, offsets: np.ndarray, known: int, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and texts of the runs of 1, 2, ... ``longest`` words; the first ``known`` words have been counted as ends of runs."""
    word = _WORD[data]
    starts, ends = runs(word, offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    keep = word.copy()
    keep[1:] |= word[:-1]
    place = np.cumsum(keep) - keep
    normal = np.where(word, _LOWER[data], np.uint8(0x20))[keep]
    prefixes = prefix_crc.running(normal)
    starts, ends = place[starts], place[ends - 1] + 1
    for n in range(1, longest + 1):
        first, last = np.arange(max(len(starts) - n + 1, 0)), np.arange(n - 1, len(starts))
        inside = (rows[first] == rows[last]) & (last >= known)
        crc = prefix_crc.of_stretches(prefixes, starts[first[inside]], ends[last[inside]])
        yield crc.astype(np.int64) % buckets, rows[last[inside]]


def bucket_counts(docs: DataFrame, text_column: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features per bucket over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in blocks(batches, 0, SEGMENT_BYTES):
            for data, offsets, _, known in segments(part.column(0), longest - 1):
                for found, _ in features(data, offsets, known, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    parts = docs.select(F.col(text_column).alias("_text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of a bucket's smoothed shares, rounded down."""
    t, s, n = target.astype(float), corpus.astype(float), float(len(corpus))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text", longest: int = LONGEST
) -> DataFrame:
    """``_id``, ``n_words``, ``n_features`` and ``weight`` (mean gain, rounded down) of every row."""
    narrow = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, 1, SEGMENT_BYTES):
            n = part.num_rows
            sums = np.zeros((3, n), np.int64)  # words, features, gains
            for data, offsets, at, known in segments(part.column(1), longest - 1):
                for k, (found, rows) in enumerate(features(data, offsets, known, longest, len(gain))):
                    counts = np.bincount(rows, minlength=len(at))
                    sums[0, at] += counts if k == 0 else 0
                    sums[1, at] += counts
                    sums[2, at] += np.bincount(rows, gain[found], len(at)).astype(np.int64)
            weight = sums[2] // np.maximum(sums[1], 1)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (sums[0], sums[1], weight))], ["_id", "n_words", "n_features", "weight"])

    kind = narrow.schema["_id"].dataType.simpleString()
    return narrow.mapInArrow(weigh, f"_id {kind}, n_words long, n_features long, weight long")


def noise(row_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
    seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
) -> DataFrame:
    """One row per document: ``_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` (null where not drawn).

    The scored rows (some 40 bytes a document) are staged.
    """
    gain = gains(bucket_counts(docs, text_column, buckets, longest), bucket_counts(target, target_column, buckets, longest))
    scored = weights(docs, gain, id_column, text_column, longest)
    scored = stage(scored.withColumn("score", F.col("weight") + noise(F.col("_id"), seed)), "scored")
    return ranked(scored, percent, least_words)


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` (a repeatable table) with the ranks of the highest scores among the rows with enough words."""
    spark, columns = scored.sparkSession, scored.columns
    enough = F.col("n_words") >= least_words
    many = scored.where(enough).groupBy("score").agg(F.count("*").alias("n")).collect()  # bounded by the range of scores
    wanted = percent * sum(r["n"] for r in many) // 100
    before, above = {}, 0
    for r in sorted(many, key=lambda r: -r["score"]):
        if above >= wanted:
            break
        before[r["score"]] = above
        above += r["n"]
    none = F.lit(None).cast("long").alias("rank")
    if not before:
        return scored.select(*columns, none)
    least = F.lit(min(before))
    rest = scored.where(~enough | (F.col("score") < least)).select(*columns, none)
    same = scored.where(enough & (F.col("score") >= least)).groupBy(*columns).agg(F.count("*").alias("_rows"))
    firsts = F.broadcast(spark.createDataFrame(list(before.items()), "_score long, _above long"))
    earlier = Window.partitionBy("score").orderBy(*[F.col(c).asc_nulls_first() for c in columns if c != "score"])
    start = F.col("_above") + F.coalesce(F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = same.join(firsts, F.col("score") == F.col("_score")).withColumn("_start", start)
    # equal rows are spelled out in steps of bounded size
    steps = placed.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_rows") - 1) / SPELLED))))
    last = F.least(F.col("_rows"), (F.col("_step") + 1) * SPELLED) - 1
    drawn = steps.withColumn("_k", F.explode(F.sequence(F.col("_step") * SPELLED, last)))
    rank = F.col("_start") + F.col("_k") + 1
    return rest.unionByName(drawn.select(*columns, F.when(rank <= wanted, rank).alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with all their columns."""
    drawn = draw(docs, target, id_column, **options).where("rank is not null").select(F.col("_id").alias("__id")).distinct()
    return docs.join(drawn, F.col(id_column).eqNullSafe(F.col("__id")), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return draw(docs, target).select(F.col("_id").alias("doc_id"), "n_features", "weight", "score", "rank")
