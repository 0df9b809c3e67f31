"""Host-level quality rules.

Base rules judge a document: too few words, or too many words inside repeated
three-word windows.  Their failures are summed by host (the ``source`` of the
documents).  A host's failure rate is shrunk towards the rate of all hosts by a
beta prior whose strength is estimated from the hosts themselves (method of
moments, without the binomial scatter), so a small host is not judged by a few
documents.  A host is rejected when even the lower credible bound of its shrunk
rate is above ``max_rate``; the verdict is joined back to its documents, which
then go with it.

Everything is DataFrame functions.  The repeated windows are found inside the
row: hashes of the windows are sorted together with their positions, so a text
of n words costs n log n, and no word ever leaves its row.  (Windows are
compared by their 64-bit hash.)  Host sums are partial sums before the shuffle,
and only rejected hosts are joined back.

Defined results: a null or empty text has no words and fails the base rules; a
null host is a host of its own; repeated rows count each time; an empty table
gives an empty table; input columns with the names of results do not clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fresh, read, words, written

BROADCAST_HOSTS = 100_000
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Characters that count as symbols, and the blanks between words.
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class HostParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_rate: float = 0.5
    z: float = 1.645


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once (as the variable of a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the array."""
    n = F.size(ws)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def same(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
        # Without an equal pair there is nothing to sort.
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, same))
    return F.when(n < 3, F.lit(0)).otherwise(let(windows, covered)).cast("long")


def stats(text: Column) -> Column:
    """Struct of the base counts of a text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda l: F.char_length(F.translate(l, BLANKS, "")) > 0)
    return F.struct(
        let(words(t), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"),
                                          repeated_words(ws).alias("n_repeat_words"))).alias("w"),
        F.char_length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"))


def fails(n_words: Column, n_repeat: Column, p: HostParams) -> tuple[Column, Column]:
    return n_words < p.min_words, n_repeat * 100 > n_words * p.max_repeat_percent


def host_rates(judged: DataFrame, p: HostParams = HostParams()) -> DataFrame:
    """Per host of ``judged`` (host, short, repetitive, failed): documents,
    failures by rule, shrunk rate, its lower bound and the verdict."""
    def count(c: str) -> Column:
        return F.sum(F.col(c).cast("long"))
    hosts = written(judged.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), count("short").alias("short"),
                                               count("repetitive").alias("repetitive"),
                                               count("failed").alias("failed")), "hosts")
    rate = F.col("failed") / F.col("docs")
    sums = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("docs").alias("docs"), F.sum("failed").alias("failed"),
                     F.sum(F.col("docs") * rate * rate).alias("squares")).first()
    if not sums.docs:
        m, strength = 0.0, 1.0
    else:
        m = sums.failed / sums.docs
        scatter = sums.squares / sums.docs - m * m
        between = max(scatter - sums.hosts * m * (1 - m) / sums.docs, 0.0)
        strength = min(max(m * (1 - m) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    a = F.col("failed") + F.lit(m * strength)
    n = F.col("docs") + F.lit(strength)
    shrunk = a / n
    low = shrunk - F.lit(p.z) * F.sqrt(shrunk * (F.lit(1.0) - shrunk) / (n + 1))
    return hosts.withColumn("rate", shrunk).withColumn("low", low).withColumn("rejected", low > F.lit(p.max_rate))


def _without_hosts(rows: DataFrame, host: str, rates: DataFrame, name: str) -> DataFrame:
    """``rows`` with the column ``name``: whether their host is rejected."""
    bad = written(rates.where("rejected").select(F.col("host").alias("bad_host"), F.lit(True).alias("bad")), "bad-hosts")
    if bad.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    return (rows.join(bad, rows[host].eqNullSafe(bad["bad_host"]), "left")
            .select(*[rows[f"`{c}`"] for c in rows.columns], F.coalesce(bad["bad"], F.lit(False)).alias(name)))


def apply_rules(docs: DataFrame, p: HostParams = HostParams()) -> DataFrame:
    """Rows of ``docs`` that pass the base rules and whose host is not rejected (all columns)."""
    s, short, rep, failed, bad = fresh(docs, "stats", "short", "repetitive", "failed", "host_rejected")
    w = F.col(s)["w"]
    is_short, is_rep = fails(w["n_words"], w["n_repeat_words"], p)
    judged = written(docs.withColumn(s, stats(F.col("text"))).withColumn(short, is_short).withColumn(rep, is_rep).drop(s),
                     "judged-docs")
    judged = judged.withColumn(failed, F.col(short) | F.col(rep))
    rates = host_rates(judged.select(F.col("source").alias("host"), F.col(short).alias("short"),
                                     F.col(rep).alias("repetitive"), F.col(failed).alias("failed")), p)
    return (_without_hosts(judged, "source", rates, bad)
            .where(~F.col(failed) & ~F.col(bad)).select(*[F.col(f"`{c}`") for c in docs.columns]))


def judge(docs: DataFrame, p: HostParams = HostParams()) -> DataFrame:
    """Counts and verdicts per document."""
    counted = docs.select("doc_id", "source", stats(F.col("text")).alias("s"))
    is_short, is_rep = fails(F.col("n_words"), F.col("n_repeat_words"), p)
    judged = written(counted.select("doc_id", "source", "s.w.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines",
                                    "s.w.n_repeat_words")
                     .withColumn("short", is_short).withColumn("repetitive", is_rep)
                     .withColumn("base_failed", F.col("short") | F.col("repetitive")), "judged")
    rates = host_rates(judged.select(F.col("source").alias("host"), "short", "repetitive",
                                     F.col("base_failed").alias("failed")), p)
    return (_without_hosts(judged, "source", rates, "host_rejected")
            .select("doc_id", *STATS, "base_failed", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
split AS (
  SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs),
spread AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
windows AS (
  SELECT k, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM spread
  WINDOW o AS (PARTITION BY k ORDER BY i)),
twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM windows WHERE g IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY k),
counted AS (
  SELECT docs.doc_id, docs.source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM docs JOIN split USING (k) LEFT JOIN covered USING (k)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
hosts AS (
  SELECT source AS host, count(*)::DOUBLE AS docs, sum(base_failed::INT)::DOUBLE AS failed FROM judged GROUP BY source),
moments AS (
  SELECT sum(failed) / sum(docs) AS m, sum(docs * (failed / docs) * (failed / docs)) / sum(docs) AS sq,
         count(*) / sum(docs) AS h FROM hosts),
prior AS (
  SELECT m, CASE WHEN sq - m * m - h * m * (1 - m) > 0
            THEN least(greatest(m * (1 - m) / (sq - m * m - h * m * (1 - m)) - 1, 1.0), 1e6) ELSE 1e6 END AS s FROM moments),
shrunk AS (SELECT host, (failed + m * s) / (docs + s) AS rate, docs + s AS n FROM hosts, prior),
verdict AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + 1)) > 0.5 AS rejected FROM shrunk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdict ON source IS NOT DISTINCT FROM host
"""
