"""Quality rules with host-level verdicts (DataFrame functions only).

Every document is measured by plain column expressions. Rule failures are summed
per domain, the domains' failure rates are shrunk towards the corpus with an
empirical beta prior (its two parameters come from the mean and variance of the
domains' rates), and the shrunk rates give each domain a verdict, which is joined
back to its documents. A document is kept if it passes the rules itself and its
domain is not rejected.

The per-domain sums are partial aggregates, one row per domain and task, however
many rows a domain has. The join back has one row per domain on its small side,
so Spark broadcasts it when its measured size allows and else splits a hot
domain's documents (skew join).

Defined cases: a null or empty text has no words (it fails the minimum); a null
domain is a domain of its own; repeated rows are judged each; an empty table gives
no rows; an input column with the name of the result column is replaced, all
others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import require, stored

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row (also inside lambdas)."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur at least twice in ``words``.

    Windows are compared by a 64-bit hash. Only a text with a repeated hash sorts
    its (hash, position) pairs; equal neighbours are repeats.
    """

    def of_hashes(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_pairs(p: Column) -> Column:
            hit = F.filter(
                p,
                lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)),
            )
            spread = F.flatten(F.transform(hit, lambda x: F.array(*[x["i"] + j for j in range(size)])))
            return F.size(F.array_distinct(spread))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, of_pairs))

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
        return F.when(F.size(w) <= size, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(words, of_words)


def measures(text: Column) -> dict[str, Column]:
    """The measures of a text, as long columns."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    out = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(words),
    }
    return {k: v.cast("long") for k, v in out.items()}


def base_rules(n_words: Column, n_repeat_words: Column, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """True if a measured document fails."""
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


def host_verdicts(
    measured: DataFrame, domain_col: str, failed_col: str, *, max_rate: float = 0.9, max_prior_weight: float = 1e6
) -> DataFrame:
    """(domain, n_docs, n_failed, shrunk_rate, host_ok): one row per domain.

    The prior is beta(a, b) with the mean m of all documents and the weight
    a + b = m (1 - m) / v - 1, v being the variance of the domains' rates beyond
    what chance gives domains of their sizes. Domains that differ by no more than
    chance get the weight ``max_prior_weight``: all shrink to the mean. The prior never
    weighs less than two documents.
    """
    hosts = measured.groupBy(domain_col).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed_col).cast("long")).alias("n_failed")
    )
    hosts = stored(hosts, "hosts")
    n, k = F.col("n_docs"), F.col("n_failed")
    total = hosts.agg(
        F.sum(n).alias("docs"), F.sum(k).alias("failed"), F.sum(k * k / n).alias("k2n"), F.count(F.lit(1)).alias("hosts"),
        F.sum(n * n).alias("n2"),
    )
    m = F.col("failed") / F.col("docs")
    between = F.col("k2n") - m * F.col("failed")  # sum of n (rate - m)^2
    chance = m * (1 - m) * (F.col("hosts") - 1)
    v = (between - chance) / (F.col("docs") - F.col("n2") / F.col("docs"))
    weight = F.when((F.col("hosts") > 1) & (v > 0), F.least(F.lit(max_prior_weight), F.greatest(F.lit(2.0), m * (1 - m) / v - 1)))
    mean, prior = total.select(m, F.coalesce(weight, F.lit(max_prior_weight))).first()  # two numbers
    rate = (k + F.lit(prior) * F.lit(mean)) / (n + F.lit(prior))
    return hosts.select(domain_col, "n_docs", "n_failed", rate.alias("shrunk_rate"), (rate <= max_rate).alias("host_ok"))


def apply_quality_rules(
    docs: DataFrame,
    *,
    text_col: str = "text",
    domain_col: str = "source",
    result_col: str = "rules",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_host_rate: float = 0.9,
) -> DataFrame:
    """``docs`` plus the struct ``result_col``: the measures, base_failed, shrunk_rate and kept.

    The measures are computed twice, for the domain sums and for the result, so
    that no text is shuffled or written.
    """
    require(docs, text_col, domain_col)
    docs = docs.select(*[c for c in docs.columns if c != result_col])
    mark = "_rule_"
    while any(c.startswith(mark) for c in docs.columns):
        mark = "_" + mark
    measured = docs.withColumns({mark + k: c for k, c in measures(F.col(text_col)).items()})
    failed = base_rules(F.col(mark + "n_words"), F.col(mark + "n_repeat_words"), min_words, max_repeat_percent)
    measured = measured.withColumn(mark + "base_failed", failed)
    judged = _judged(measured, domain_col, mark, max_host_rate)
    fields = [*MEASURES, "base_failed", "shrunk_rate", "kept"]
    return judged.select(*docs.columns, F.struct(*[F.col(mark + k).alias(k) for k in fields]).alias(result_col))


def _judged(measured: DataFrame, domain_col: str, mark: str, max_host_rate: float) -> DataFrame:
    """``measured`` plus the host's verdict and the document's."""
    failed = mark + "base_failed"
    hosts = host_verdicts(measured.select(domain_col, failed), domain_col, failed, max_rate=max_host_rate)
    hosts = hosts.select(F.col(domain_col).alias(mark + "domain"), F.col("shrunk_rate").alias(mark + "shrunk_rate"), F.col("host_ok").alias(mark + "ok"))
    joined = measured.join(hosts, measured[domain_col].eqNullSafe(hosts[mark + "domain"]), "left")
    return joined.withColumn(mark + "kept", ~F.col(failed) & F.coalesce(F.col(mark + "ok"), F.lit(True)))


def op9_quality(docs: DataFrame) -> DataFrame:
    """The registered query. Its rows are narrow, so the measures are written once and read twice."""
    base = docs.select("doc_id", "source", *[c.alias(k) for k, c in measures(F.col("text")).items()])
    base = base.withColumn("base_failed", base_rules(F.col("n_words"), F.col("n_repeat_words")))
    return _judged(stored(base, "op9"), "source", "", 0.9).select("doc_id", *MEASURES, "base_failed", "kept", "source")


ORACLE_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, k, w[k] || chr(10) || w[k + 1] || chr(10) || w[k + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS k FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c >= 2),
r AS (SELECT doc_id, count(DISTINCT k + j) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d) d
  LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END)::DOUBLE AS k FROM b GROUP BY source),
t AS (SELECT sum(n) AS docs, sum(k) AS failed, sum(k * k / n) AS k2n, count(*) AS hosts, sum(n * n) AS n2, sum(k) / sum(n) AS m FROM h),
v AS (SELECT *, (k2n - m * failed - m * (1 - m) * (hosts - 1)) / nullif(docs - n2 / docs, 0) AS v FROM t),
p AS (SELECT m, CASE WHEN hosts > 1 AND v > 0 THEN least(1e6, greatest(2, m * (1 - m) / v - 1)) ELSE 1e6 END AS w FROM v),
s AS (SELECT source, (k + w * m) / (n + w) AS shrunk_rate FROM h, p)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND shrunk_rate <= 0.9 AS kept, b.source
FROM b JOIN s ON b.source IS NOT DISTINCT FROM s.source
"""
