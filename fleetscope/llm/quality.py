"""Host-level quality rules by DataFrame functions.

Every document is measured (words, symbols, repeated lines, repeated windows of words) and judged by its own rules. The
failures of each rule are counted by host; for each rule a host's failure rate is shrunk towards the rate of all hosts by an
empirical beta prior, whose two parameters come from the mean and variance of the hosts' rates (method of moments). A host
fails by a rule if its shrunk rate is higher than HOST_FACTOR times that of all hosts and than HOST_LEAST, or than HOST_RATE
in any case; its verdict is joined back to its documents. The host of a document is its ``source``.

The measures of a document are made row by row; only they, not the texts, are written and shuffled. The counts by host
are combined before they are shuffled, the prior is one row, and the join of the verdicts is a plain equi-join, whose hot
hosts Spark can split.

Defined results: a null or empty text has no words, so that it fails; a null host is a host of its own; hosts that are equal
in all bytes are one; with no host, or no variance between hosts beyond what chance explains, the prior is as strong as
``STRONGEST``; repeated rows are each judged and counted; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written

#: Words of a repeated window.
WINDOW = 8
#: A document with fewer words fails.
LEAST_WORDS = 20
#: A document fails if more than this share of its words, in percent, lies in repeated windows.
REPEATED = 30
#: A host fails if its shrunk failure rate by a rule is higher than this, whatever the others' is,
HOST_RATE = 0.5
#: or than this, and than so many times the rate of all hosts.
HOST_LEAST, HOST_FACTOR = 0.1, 3.0
#: Most documents that the prior may count for.
STRONGEST = 10_000.0

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def _repeated_words(df: DataFrame, words: str, out: str, window: int) -> DataFrame:
    """Adds ``out``: the words in windows that occur twice or more in the array ``words``, the first included.

    Each window is named by the hash of its words' hashes. Only documents with fewer distinct names than windows go on:
    their names are sorted with their positions, and a position is repeated if a neighbour has the same name.
    """
    hashes, names, order, places = (f"__{out}_{x}" for x in ("hashes", "names", "order", "places"))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(names, F.when(F.size(hashes) >= window, F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(F.slice(hashes, i, window)))).otherwise(none))
    df = df.withColumn(order, F.when(F.size(F.array_distinct(names)) < F.size(names), F.array_sort(F.transform(
        names, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda a, b: F.coalesce(F.get(order, a)["h"] == F.get(order, b)["h"], F.lit(False))
    repeated = F.filter(order, lambda x, i: same(i, i - 1) | same(i, i + 1))
    df = df.withColumn(places, F.array_sort(F.transform(repeated, lambda x: x["i"])))
    covered = F.aggregate(F.transform(places, lambda p, i: F.least(F.lit(window), F.coalesce(
        F.get(places, i + 1) - p, F.lit(window)))), F.lit(0), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop(hashes, names, order, places)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            window: int = WINDOW) -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    df = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("words", F.filter(F.split("text", _SPACE), lambda w: w != ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = _repeated_words(df, "words", "n_repeat_words", window)
    symbols = F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))
    return df.select(
        F.col("id").alias(id_col), F.col("host"), F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", _SPACE, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")


def own_rules(least_words: int = LEAST_WORDS, repeated: int = REPEATED) -> dict[str, Column]:
    """By which rules a measured document fails by itself."""
    return {"short": F.col("n_words") < least_words,
            "repeated": 100 * F.col("n_repeat_words") > repeated * F.col("n_words")}


def _prior(total, rule: str) -> tuple[float, float, float]:
    """The rate of all hosts and the two parameters of the beta prior of a rule, from the sums over hosts."""
    # mean and variance of the rates, each host weighted by its documents; what chance alone adds is taken off
    mean = total[f"{rule}_f"] / total.n
    between = total[f"{rule}_squares"] / total.n - mean * mean - mean * (1 - mean) * total.hosts / total.n
    strength = min(max(mean * (1 - mean) / between - 1, 1e-3), STRONGEST) if between > 0 else STRONGEST
    return mean, mean * strength, (1 - mean) * strength


def host_verdicts(judged: DataFrame, host_rate: float = HOST_RATE, rules: tuple[str, ...] = ("base_failed",),
                  least: float = HOST_LEAST, factor: float = HOST_FACTOR) -> DataFrame:
    """(host, host_docs, host_failures, host_failure_rate, host_failed and <rule>_rate of each rule) from rows with ``host`` and
    a boolean for each of ``rules``; failures of several rules are counted apart, host_failure_rate is the highest rate."""
    counts = [F.sum(F.col(r).cast("long")).alias(f"{r}_f") for r in rules]
    hosts = written(judged.groupBy("host").agg(F.count("*").alias("host_docs"), *counts), "quality-hosts")
    squares = [F.sum(F.col(f"{r}_f") * F.col(f"{r}_f") / F.col("host_docs")).alias(f"{r}_squares") for r in rules]
    total = hosts.agg(F.sum("host_docs").alias("n"), F.count("*").alias("hosts"),
                      *[F.sum(f"{r}_f").alias(f"{r}_f") for r in rules], *squares).first()
    rates, failed = [], F.lit(False)
    for r in rules:
        mean, a, b = _prior(total, r) if total.n else (0.0, 0.0, 0.0)
        rate = (F.col(f"{r}_f") + F.lit(a)) / (F.col("host_docs") + F.lit(a + b))
        rates.append(rate.alias(f"{r}_rate"))
        failed = failed | (rate > min(host_rate, max(least, factor * mean)))
    worst = rates[0] if len(rates) == 1 else F.greatest(*rates)
    failures = sum((F.col(f"{r}_f") for r in rules[1:]), F.col(f"{rules[0]}_f"))
    return hosts.select("host", "host_docs", failures.alias("host_failures"), worst.alias("host_failure_rate"),
                        failed.alias("host_failed"), *rates)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          host_rate: float = HOST_RATE) -> DataFrame:
    """The measures, base_failed, the host's shrunk failure rates and kept of every row of ``docs``."""
    rules = own_rules()
    base = rules["short"] | rules["repeated"]
    judged = written(measure(docs, id_col, text_col, host_col).withColumns({**rules, "base_failed": base}), "quality")
    # the verdicts are written, so that both sides of the join are plain scans
    verdicts = written(host_verdicts(judged, host_rate, tuple(rules)).withColumnRenamed("host", "of_host"), "quality-verdicts")
    found = judged.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")), "left").drop("of_host")
    return found.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents),
windows AS (SELECT rid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS w
            FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d) x),
repeated AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) x WHERE n > 1),
covered AS (
  SELECT rid, cast(sum(least(8, coalesce(after - i, 8))) AS bigint) AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM repeated) x GROUP BY rid),
measured AS (
  SELECT d.rid, doc_id, source, cast(len(words) AS bigint) AS n_words,
         cast(length(array_to_string(words, '')) AS bigint) AS word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
         cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeated FROM measured),
hosts AS (
  SELECT source, unnest(['short', 'repeated']) AS rule, count(*)::double AS n,
         unnest([count(*) FILTER (WHERE short), count(*) FILTER (WHERE repeated)])::double AS f
  FROM judged GROUP BY source),
total AS (SELECT rule, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS second, count(*) / sum(n) AS inverse FROM hosts GROUP BY rule),
spread AS (SELECT rule, mean, second - mean * mean - mean * (1 - mean) * inverse AS between_hosts FROM total),
prior AS (
  SELECT rule, mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1e-3), 10000.0)
                          ELSE 10000.0 END AS strength FROM spread),
verdicts AS (
  SELECT source, bool_or((f + mean * strength) / (n + strength) > least(0.5, greatest(0.1, 3.0 * mean))) AS host_failed
  FROM hosts JOIN prior USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
       NOT short AND NOT repeated AND NOT host_failed AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""
