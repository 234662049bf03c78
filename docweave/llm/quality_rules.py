"""Host-level quality rules (operator 5), with DataFrame functions only.

Every document gets its rule figures inside its own row, without a shuffle.  Hosts are then judged as a whole:
rule failures are summed by host (map-side first, so a host with a third of all rows costs one row a task), the
failure rates are shrunk with a beta prior fitted to the hosts' rates by their moments, and a host is bad when
even the lower end of its shrunken rate, two posterior deviations below the mean, is above ``bad_rate``.  The
verdict goes back to the host's documents by a join whose host side has one row a host: broadcast when the
hosts are counted and few enough, else dealt out over salts, so that no host's documents meet in one task.

Defined results: a null text counts as empty and fails (under ten words); a null host is the host "";
repeated rows are rows of their own; an empty table gives an empty table; only the three named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table

BLANK = " \t\n\x0b\f\r"
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 10, 30
BAD_RATE = 0.5
#: Hosts whose verdicts may be broadcast (about 50 bytes each); beyond, the join is salted.
BROADCAST_HOSTS, SALTS = 1 << 18, 32
#: Bounds of the prior's weight in documents; the second holds when the hosts' rates do not differ.
PRIOR_WEIGHT = (2.0, 200.0)


def host_of(source: Column) -> Column:
    """The host of a URL in lower case; any other value is its own host."""
    s = F.coalesce(source.cast("string"), F.lit(""))
    return F.when(s.contains("://"), F.lower(F.regexp_extract(s, r"://(?:[^/?#@]*@)?([^/?#:]*)", 1))).otherwise(s)


def rule_figures(docs: DataFrame, key: str = "doc_id", column: str = "text", source: str = "source") -> DataFrame:
    """(key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of every row."""
    k = REPEAT_WINDOW
    d = docs.select(F.col(key), host_of(F.col(source)).alias("host"), F.coalesce(F.col(column), F.lit("")).alias("t"))
    d = d.withColumns({"trimmed": F.btrim("t", F.lit(BLANK)), "all_lines": F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")})
    d = d.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", r"[ \t-\r]+")))
    d = d.select(
        key,
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("all_lines") - F.size(F.array_distinct("all_lines"))).cast("long").alias("n_dup_lines"),
        F.size("all_lines").cast("long").alias("n_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    at = lambda i, j: F.get(F.col("h"), i + j)
    d = d.withColumn("wins", F.when(F.size("h") >= k, F.transform(F.sequence(F.lit(0), F.greatest(F.size("h") - k, F.lit(0))), lambda i: F.xxhash64(*[at(i, j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))).drop("h")
    # Only texts with a repeated window pay for sorting their windows with positions.
    d = d.withColumn("s", F.when(F.size(F.array_distinct("wins")) < F.size("wins"), F.array_sort(F.transform("wins", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("wins")
    same = lambda i, j: F.get(F.col("s"), i).getField("x") == F.get(F.col("s"), j).getField("x")
    hits = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: F.coalesce(same(i, i + 1), F.lit(False)) | (i > 0) & F.coalesce(same(i, F.greatest(i - 1, F.lit(0))), F.lit(False)))
    d = d.withColumn("p", F.when(F.col("s").isNotNull(), F.array_sort(F.transform(hits, lambda i: F.get(F.col("s"), i).getField("i"))))).drop("s")
    covered = F.aggregate(
        "p",
        F.struct(F.lit(-k).alias("last"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc.getField("n") + F.least(F.lit(k), x - acc.getField("last"))).alias("n")),
        lambda acc: acc.getField("n"),
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def with_failures(figures: DataFrame) -> DataFrame:
    """Adds base_failed and any_failed."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    return figures.withColumns({"base_failed": base, "any_failed": base | symbols | lines})


def host_verdicts(judged: DataFrame, bad_rate: float = BAD_RATE) -> DataFrame:
    """(host, host_docs, host_rate, host_ok) from rows with host and any_failed."""
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("any_failed").cast("long")).alias("bad"))
    rate = F.col("bad") / F.col("host_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    low, high = PRIOR_WEIGHT
    spread = F.col("m") * (1 - F.col("m"))
    weight = F.when(F.col("v") > 0, F.least(F.lit(high), F.greatest(F.lit(low), spread / F.col("v") - 1))).otherwise(F.lit(high))
    prior = moments.select((F.col("m") * weight).alias("a"), ((1 - F.col("m")) * weight).alias("b"))
    n = F.col("a") + F.col("b") + F.col("host_docs")
    mean = (F.col("a") + F.col("bad")) / n
    # The prior is a single row, so this join only adds two constants to each host.
    return hosts.join(F.broadcast(prior)).select("host", "host_docs", mean.alias("host_rate"), (mean - 2 * F.sqrt(mean * (1 - mean) / (n + 1)) <= bad_rate).alias("host_ok"))


def quality_rules(docs: DataFrame, key: str = "doc_id", column: str = "text", source: str = "source", bad_rate: float = BAD_RATE) -> DataFrame:
    """Rule figures, base_failed, the host's figures, and kept, of every row of ``docs``."""
    judged = durable(with_failures(rule_figures(docs, key, column, source)))
    verdicts = durable(host_verdicts(judged, bad_rate))
    if verdicts.count() <= BROADCAST_HOSTS:
        out = judged.join(F.broadcast(verdicts), "host")
    else:  # a host's documents meet its verdict in several tasks
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        out = judged.withColumn("salt", F.pmod(F.xxhash64(key, "n_words", "word_chars"), F.lit(SALTS)).cast("int")).join(verdicts.withColumn("salt", salts), ["host", "salt"])
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"), "host_docs", F.round("host_rate", 6).alias("host_rate"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, r, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT r, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM c, range(0, 5) AS x(k) WHERE n > 1 GROUP BY r),
f AS (SELECT w.doc_id, w.r, w.host, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             len(ls) AS n_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p USING (r)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
a AS (SELECT *, base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS any_failed FROM j),
h AS (SELECT host, count(*) AS host_docs, CAST(sum(CAST(any_failed AS INT)) AS DOUBLE) AS bad FROM a GROUP BY host),
m AS (SELECT avg(bad / host_docs) AS m, var_pop(bad / host_docs) AS v FROM h),
q AS (SELECT m, CASE WHEN v > 0 THEN least(200.0, greatest(2.0, m * (1 - m) / v - 1)) ELSE 200.0 END AS w FROM m),
v AS (SELECT host, host_docs, (m * w + bad) / (w + host_docs) AS mu, w + host_docs AS n FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND mu - 2 * sqrt(mu * (1 - mu) / (n + 1)) <= 0.5 AS kept, host_docs, round(mu, 6) AS host_rate
FROM a JOIN v USING (host)
"""
