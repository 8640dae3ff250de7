"""Host-level quality rules with a shrunken failure rate; DataFrame functions only.

Document rules come first: counts over the whole text, one hard rule (``base_failed``) and soft rules on symbols,
repeated lines, repeated words and word length. Failures are then counted per host (source). A host's rate
is shrunk towards the corpus by a beta prior fitted to all hosts by moments, so that a host with three
rows is not judged by them alone. The verdict of a host goes back to its documents: in a bad host a document goes
if it breaks a soft rule; elsewhere only the hard rule removes. A document that breaks no rule always stays.

Per-host counts are pre-aggregated on the map side and the verdict is joined with salts (or broadcast below the
session's threshold), so one host may own a third of all rows. Null texts have no words and fail; null hosts
form one host of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.plans.sizing import skew_join
from floodmark.plans.staging import stage

NAME = "op6_quality_rules"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Soft rules: percent of symbols to word characters, percent of repeated lines' share of words, word length bounds.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINES_PER_100_WORDS = 10
SOFT_REPEAT_PERCENT = 15
MIN_WORD_LENGTH, MAX_WORD_LENGTH = 2, 14
#: A host is bad when the shrunken rate of its failing documents exceeds this.
MAX_HOST_RATE = 0.5
#: Stands for null among host names.
NO_HOST = "\x00"
#: Prior rows when the hosts do not differ beyond chance.
MAX_STRENGTH = 1e6
SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, h) AS c FROM (
    SELECT doc_id, unnest(range(1, len(words) - 6)) AS p,
           unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS h
    FROM w WHERE len(words) >= 8)
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM win WHERE c > 1) GROUP BY doc_id
), lin AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(lin.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lin USING (doc_id)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 10 * n_words OR 100 * n_repeat_words > 15 * n_words
         OR word_chars < 2 * n_words OR word_chars > 14 * n_words AS soft_failed
  FROM c
), h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS k FROM f GROUP BY source),
m AS (SELECT sum(k) / sum(n)::DOUBLE AS mean, count(*) AS hosts, sum(n)::DOUBLE AS total, sum(n::DOUBLE * n) AS squares FROM h),
v AS (
  SELECT mean, (sum(n * power(k / n::DOUBLE - mean, 2)) - (hosts - 1) * mean * (1 - mean)) / nullif(total - squares / total, 0)
         AS between_hosts
  FROM h, m GROUP BY mean, hosts, total, squares
), s AS (
  SELECT mean, CASE WHEN between_hosts > 0
         THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 0), 1000000) ELSE 1000000 END AS strength FROM v
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (soft_failed AND (k + strength * mean) / (n + strength) > 0.5) AS kept
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source, s
"""


def _ordered(hashes: Column) -> Column:
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))


def _repeated_starts(ordered: str) -> Column:
    """Sorted starts of the windows whose hash occurs at least twice in the text."""

    def twin(x: Column, i: Column) -> Column:
        same = F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
        return F.when(same | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)), x["p"])

    return F.sort_array(F.array_compact(F.transform(ordered, twin)))


def counts(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and the counts; a long text stays one row, handled in n log n steps."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(text, SPACE), lambda x: x != "")
    step = docs.select(*keep, text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    n = F.size("_words")
    starts = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))
    step = step.withColumn("_hashes", F.when(n >= WINDOW, hashes))
    # most texts repeat nothing, which a hash set tells; only the others are sorted
    twice = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    # projections of their own: a lambda would evaluate an inlined sort once per element
    step = step.withColumn("_ordered", F.when(twice, _ordered(F.col("_hashes"))))
    step = step.withColumn("_starts", _repeated_starts("_ordered"))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return step.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rules() -> dict[str, Column]:
    """The hard rule and the soft rules over the counts."""
    c = {name: F.col(name) for name in COUNTS}
    hard = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    soft = (
        (100 * c["n_symbols"] > MAX_SYMBOL_PERCENT * c["word_chars"])
        | (100 * c["n_dup_lines"] > MAX_DUP_LINES_PER_100_WORDS * c["n_words"])
        | (100 * c["n_repeat_words"] > SOFT_REPEAT_PERCENT * c["n_words"])
        | (c["word_chars"] < MIN_WORD_LENGTH * c["n_words"])
        | (c["word_chars"] > MAX_WORD_LENGTH * c["n_words"])
    )
    return {"base_failed": hard, "_soft": soft}


def host_rates(judged: DataFrame) -> DataFrame:
    """One row per host: ``_host`` and its posterior mean failure rate ``_rate``.

    The prior's mean is the corpus rate, its strength comes from the spread between hosts (method of moments); without
    any spread beyond chance the prior outweighs the hosts.
    """
    failed = F.col("base_failed") | F.col("_soft")
    host = F.coalesce("_host", F.lit(NO_HOST)).alias("_host")
    hosts = stage(judged.groupBy(host).agg(F.count("*").alias("_n"), F.count_if(failed).alias("_k")), "hosts")
    n, k = F.col("_n").cast("double"), F.col("_k").cast("double")
    mean = hosts.agg(F.sum(k) / F.sum(n)).first()[0] or 0.0  # single totals, whatever the number of hosts
    spread = F.sum(n * (k / n - mean) * (k / n - mean))
    total, squares, between, size = hosts.agg(F.sum(n), F.sum(n * n), spread, F.count("*")).first()
    binomial = mean * (1 - mean)
    scale = total - squares / total if total else 0.0
    variance = (between - (size - 1) * binomial) / scale if scale else 0.0
    strength = min(max(binomial / variance - 1, 0.0), MAX_STRENGTH) if variance > 0 else MAX_STRENGTH
    return hosts.select("_host", ((k + strength * mean) / (n + strength)).alias("_rate"))


def judge(docs: DataFrame, keep: list[str], host_column: str = "source", text_column: str = "text") -> DataFrame:
    """Columns ``keep``, the counts, ``base_failed`` and ``kept`` for every row of ``docs``."""
    host = F.col(host_column).alias("_host")
    judged = counts(docs.select(*keep, host, F.col(text_column).alias("_input")), [*keep, "_host"], "_input")
    judged = stage(judged.withColumns(rules()), "quality")
    rates = host_rates(judged)
    left = judged.withColumn("_host", F.coalesce("_host", F.lit(NO_HOST)))
    verdict = skew_join(left, rates, ["_host"])
    kept = ~F.col("base_failed") & ~(F.col("_soft") & (F.col("_rate") > MAX_HOST_RATE))
    return verdict.select(*keep, *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Rows are told apart by id and text."""
    names = [F.col(c) for c in docs.columns]
    told = docs.select(
        F.col(id_column).alias("__id"), F.xxhash64(text_column).alias("__text"), F.col(host_column).alias("__host"), F.col(text_column).alias("__in")
    )
    gone = judge(told, ["__id", "__text"], "__host", "__in").where("not kept").select("__id", "__text").distinct()
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(text_column) == F.col("__text"))
    return docs.join(gone, same, "left_anti").select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
