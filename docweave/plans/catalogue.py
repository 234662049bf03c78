"""Queries over the sample tables, by name, and the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import checks, scalars
from ..functions import text as t
from ..operators import compare, corpus, grid, jobs, layout, merge, references, scoring
from ..sources import readers, writers
from ..workers import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CJK = "論文の構造化を行うための手法について述べる。" * 12


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(c) -> F.Column:
    return F.sha2(c if not isinstance(c, str) else F.col(c), 256)


# --- text -------------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, CAST(length(regexp_replace(text, '[\s\x0B]', '', 'g')) AS INT) AS chars, CAST(greatest(length(text) - length(replace(text, chr(12), '')), 1) AS INT) AS pages,
length(regexp_replace(text, '[\s\x0B]', '', 'g')) // greatest(length(text) - length(replace(text, chr(12), '')), 1) >= 50 AS has_layer FROM documents""")
def text_profile(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.count_chars("text").alias("chars"), t.count_pages("text").alias("pages"), t.has_text_layer(t.count_chars("text"), t.count_pages("text")).alias("has_layer"))


@query(rf"""WITH d AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - doc_id, left('{CJK}', CAST(20 + doc_id % 200 AS INT)) || text FROM documents WHERE doc_id % 10 = 0),
n AS (SELECT doc_id, length(regexp_replace(text, '[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]', '', 'g')) AS ja, length(regexp_replace(text, '[^\p{{Latin}}]', '', 'g')) AS la FROM d)
SELECT doc_id, CAST(ja AS INT) AS japanese, CAST(la AS INT) AS latin, CASE WHEN ja + la >= 100 AND ja / (ja + la) >= 0.1 THEN 'ja' ELSE 'en' END AS language, ja + la >= 100 AS detected FROM n""")
def lang_detect(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    mixed = d.where("doc_id % 10 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.concat(F.left(F.lit(CJK), (20 + F.col("doc_id") % 200).cast("int")), F.col("text")).alias("text"))
    found = t.detect_language("text")
    return d.union(mixed).select("doc_id", t.japanese_letters("text").alias("japanese"), t.latin_letters("text").alias("latin"), found.getField("language").alias("language"), found.getField("detected").alias("detected"))


@query(r"""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN replace(text, ' ', chr(12288)) WHEN turn % 3 = 1 THEN replace(text, ' ', '  ') ELSE chr(160) || text || ' ' || chr(13) || chr(10) END AS t FROM conversations)
SELECT conv_id, turn, sha256(trim(regexp_replace(t, '[\s\x{3000}\x{00A0}]+', ' ', 'g'))) AS h FROM c""")
def collapse_space(spark, sf):
    c = table(spark, sf, "conversations")
    text = F.when(F.col("turn") % 3 == 0, F.replace("text", F.lit(" "), F.lit("　"))).when(F.col("turn") % 3 == 1, F.replace("text", F.lit(" "), F.lit("  "))).otherwise(F.concat(F.lit("\xa0"), "text", F.lit(" \r\n")))
    return c.select("conv_id", "turn", sha(t.collapse_space(text)).alias("h"))


@query(r"""WITH c AS (SELECT doc_id, chr(9) || replace(replace(text, chr(10), ' ' || chr(13) || chr(10)), '. ', '.' || chr(9) || chr(13)) || '  ' AS t FROM documents)
SELECT doc_id, sha256(regexp_replace(regexp_replace(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS h FROM c""")
def normalize_text(spark, sf):
    text = F.concat(F.lit("\t"), F.replace(F.replace("text", F.lit("\n"), F.lit(" \r\n")), F.lit(". "), F.lit(".\t\r")), F.lit("  "))
    return table(spark, sf, "documents").select("doc_id", sha(t.normalize_text(text)).alias("h"))


@query(r"""WITH f AS (SELECT doc_id, regexp_replace(lower(text || ' ﬁn ﬂow'), '[^\p{L}\p{Nd}]', '', 'g') AS f FROM documents),
g AS (SELECT doc_id, replace(replace(f, 'ﬁ', 'fi'), 'ﬂ', 'fl') AS f FROM f) SELECT doc_id, CAST(length(f) AS INT) AS n, sha256(f) AS h FROM g""")
def fold_text(spark, sf):
    f = t.fold(F.concat("text", F.lit(" ﬁn ﬂow")))
    return table(spark, sf, "documents").select("doc_id", F.length(f).alias("n"), sha(f).alias("h"))


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+') AS w FROM documents)
SELECT doc_id, CAST(len(w) + 3 AS INT) AS n, sha256(array_to_string(list_concat(w, ['注意', '意機', '機構']), ',')) AS h FROM w""")
def tokenize_words(spark, sf):
    w = t.tokenize(F.concat("text", F.lit(" 注意機構")))
    return table(spark, sf, "documents").select("doc_id", F.size(w).alias("n"), sha(F.array_join(w, ",")).alias("h"))


@query("""SELECT doc_id, sha256(regexp_replace(replace(text, ' ', '-' || chr(10)), '-\n', '', 'g')) AS h FROM documents""")
def dehyphenated(spark, sf):
    return table(spark, sf, "documents").select("doc_id", sha(t.dehyphenate(F.replace("text", F.lit(" "), F.lit("-\n")))).alias("h"))


@query(r"""WITH h AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 3 THEN 'A. ' ELSE (page_id % 12 + 1) || repeat('.' || page_id % 7, CAST(page_id % 6 AS INT)) || ' ' END || regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h FROM pages),
n AS (SELECT *, rtrim(trim(regexp_extract(h, '^(?:\d{1,2}|[A-Z]|[IVX]+)(?:\.\d{1,2})*\.?(?:\s|$)')), '.') AS n FROM h),
l AS (SELECT *, CASE WHEN n = '' THEN page_id % 9 - 1 ELSE length(n) - length(replace(n, '.', '')) + 1 END AS l FROM n)
SELECT page_id, CAST(l AS BIGINT) AS level, CAST(greatest(1, least(4, l)) AS BIGINT) AS clamped FROM l""")
def heading_levels(spark, sf):
    i = F.col("page_id")
    number = F.when(i % 4 == 0, "").when(i % 4 == 3, "A. ").otherwise(F.concat((i % 12 + 1).cast("string"), F.repeat(F.concat(F.lit("."), (i % 7).cast("string")), (i % 6).cast("int")), F.lit(" ")))
    p = table(spark, sf, "pages").select("page_id", t.heading_level(F.concat(number, F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)), i % 9 - 1).cast("long").alias("level"))
    return p.withColumn("clamped", t.clamp_level("level").cast("long"))


@query(r"""WITH r AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'https://doi.org/' WHEN 1 THEN 'DOI: ' WHEN 2 THEN ' http://dx.doi.org/doi:' WHEN 3 THEN 'arXiv:' ELSE '' END
 || '10.' || (1000 + p_partkey) || CASE WHEN p_partkey % 5 = 4 THEN ' ' ELSE '/' END || p_name || p_brand AS raw FROM part),
b AS (SELECT p_partkey, regexp_replace(lower(trim(regexp_replace(raw, '\s+', ' ', 'g'))), '^(?:(?:https?://(?:dx\.)?doi\.org/|doi\.org/|doi:)\s*)+', '') AS b FROM r)
SELECT p_partkey, CASE WHEN regexp_matches(b, '^10\.\d{4,9}/\S+$') THEN b END AS doi, NOT regexp_matches(b, '^10\.\d{4,9}/\S+$') AS malformed FROM b""")
def doi_normalize(spark, sf):
    k = F.col("p_partkey")
    prefix = F.when(k % 6 == 0, "https://doi.org/").when(k % 6 == 1, "DOI: ").when(k % 6 == 2, " http://dx.doi.org/doi:").when(k % 6 == 3, "arXiv:").otherwise("")
    raw = F.concat(prefix, F.lit("10."), (k + 1000).cast("string"), F.when(k % 5 == 4, " ").otherwise("/"), "p_name", "p_brand")
    return table(spark, sf, "part").select("p_partkey", t.doi(raw).alias("doi"), t.doi_malformed(raw).alias("malformed"))


@query("""SELECT o_orderkey, CASE WHEN y = 0 THEN 0 WHEN y BETWEEN 1500 AND 2001 THEN y ELSE 0 END AS year, y <> 0 AND NOT y BETWEEN 1500 AND 2001 AS dropped
FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 WHEN o_orderkey % 9 = 1 THEN 1499 ELSE year(o_orderdate) END AS INT) AS y FROM orders)""")
def year_clamp(spark, sf):
    k = F.col("o_orderkey")
    y = F.when(k % 9 == 0, 0).when(k % 9 == 1, 1499).otherwise(F.year("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", scalars.year(y, 2000).alias("year"), scalars.year_out_of_range(y, 2000).alias("dropped"))


@query("""WITH r AS (SELECT p_partkey, trim(p_name || CASE p_partkey % 4 WHEN 0 THEN ' .' WHEN 1 THEN '...' WHEN 2 THEN '.' ELSE '  ' END) AS s FROM part)
SELECT p_partkey, CASE WHEN s LIKE '%.' AND s NOT LIKE '%..' THEN trim(left(s, length(s) - 1)) ELSE s END AS title FROM r""")
def ref_title(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", t.reference_title(F.concat("p_name", F.when(k % 4 == 0, " .").when(k % 4 == 1, "...").when(k % 4 == 2, ".").otherwise("  "))).alias("title"))


@query(r"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '[' || doc_id % 50 || '] a' || chr(10) || text || chr(10) || '  [' || doc_id || '] b' || chr(10) || '[99999] c [77]' ELSE text END AS t FROM documents)
SELECT doc_id, CAST(coalesce(list_max(list_filter(list_transform(regexp_extract_all(t, '(?m)^\s*\[(\d+)\]', 1), lambda x: TRY_CAST(x AS INT)), lambda x: x < 10000)), 0) AS INT) AS n FROM d""")
def count_references(spark, sf):
    i = F.col("doc_id").cast("string")
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), (F.col("doc_id") % 50).cast("string"), F.lit("] a\n"), "text", F.lit("\n  ["), i, F.lit("] b\n[99999] c [77]"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", t.count_references(text).alias("n"))


@query(r"""SELECT page_id, left(trim(regexp_replace(regexp_replace(regexp_replace(url, '^[^:]*://', ''), '^[^/]*/', ''), '[^A-Za-z0-9.-]+', '_', 'g'), '_'), 100) || '.json' AS name,
'work/' || page_id || '/pages/page-' || lpad(CAST(page_id % 200 AS VARCHAR), 4, '0') || '.png' AS key, 'work/' || page_id || '/pages/' AS dir, CAST(page_id % 200 AS INT) AS page FROM pages""")
def object_names(spark, sf):
    i = F.col("page_id").cast("string")
    key = writers.page_image_key(i, (F.col("page_id") % 200).cast("int"))
    return table(spark, sf, "pages").select("page_id", t.record_name("url").alias("name"), key.alias("key"), t.directory_of(key).alias("dir"), t.page_number(key).alias("page"))


@query(r"""WITH c AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '```json' || chr(10) || '{"k": ' || p_size || '}' || chr(10) || '```' WHEN 1 THEN 'Here: {"k": ' || p_size || '} done' WHEN 2 THEN '[1, ' || p_size || ']' ELSE p_name END AS t FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL WHEN 2 THEN t ELSE regexp_extract(t, '\{.*\}') END AS payload FROM c""")
def json_payloads(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(k % 4 == 0, F.concat(F.lit('```json\n{"k": '), size, F.lit("}\n```"))).when(k % 4 == 1, F.concat(F.lit('Here: {"k": '), size, F.lit("} done"))).when(k % 4 == 2, F.concat(F.lit("[1, "), size, F.lit("]"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", t.extract_json(text).alias("payload"))


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN CAST(1000 + p_partkey % 9000 AS VARCHAR) || '.' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') END AS id, CASE WHEN p_partkey % 3 = 1 THEN 'v' || p_size WHEN p_partkey % 3 = 0 THEN '' END AS version FROM part""")
def paper_ids(spark, sf):
    k = F.col("p_partkey")
    num = F.concat((1000 + k % 9000).cast("string"), F.lit("."), F.lpad((k % 100000).cast("string"), 5, "0"))
    p = t.paper_id(F.when(k % 3 == 0, num).when(k % 3 == 1, F.concat(F.lit(" arXiv:"), num, F.lit("v"), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit("cs/"), num)))
    return table(spark, sf, "part").select("p_partkey", p.getField("id").alias("id"), p.getField("version").alias("version"))


@query(r"""SELECT n_nationkey, '| ' || n_name || ' | x\|y |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_regionkey || ' |  |' || chr(10) AS md FROM nation""")
def table_markdown(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", t.markdown(F.array(F.array("n_name", F.lit("x|y"))), F.array(F.array(F.col("n_regionkey").cast("string")))).alias("md"))


# --- scoring ----------------------------------------------------------------------------------------------


@query(r"""WITH f AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{Nd}]', '', 'g') AS n FROM benchmark), d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{Nd}]', '', 'g') AS h FROM documents)
SELECT item_id AS value_id, doc_id AS text_id FROM f JOIN d ON contains(h, n) WHERE n <> ''""")
def contamination_contains(spark, sf):
    return scoring.substring_matches(table(spark, sf, "benchmark").select(F.col("item_id").alias("value_id"), F.col("text").alias("value")), table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text"))


_PAIRS = r"list_distinct(list_transform(range(1, len(w)), lambda i: least(w[i], w[i + 1]) || ' ' || greatest(w[i], w[i + 1])))"


@query(rf"""WITH b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}]+') AS w FROM benchmark), d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}]+') AS w FROM documents),
bp AS (SELECT item_id, unnest({_PAIRS}) AS p FROM b), dp AS (SELECT doc_id, unnest({_PAIRS}) AS p FROM d), n AS (SELECT item_id, count(*) AS n FROM bp GROUP BY 1),
h AS (SELECT item_id, doc_id, count(*) AS hits FROM bp JOIN dp USING (p) GROUP BY ALL)
SELECT item_id AS value_id, doc_id AS text_id, hits, CAST(n AS INT) AS pairs, round(hits / n, 4) AS score FROM h JOIN n USING (item_id) WHERE round(hits / n, 4) >= 0.3""")
def pair_coverage(spark, sf):
    out = scoring.pair_coverage(table(spark, sf, "benchmark").select(F.col("item_id").alias("value_id"), F.col("text").alias("value")), table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text"))
    return out.where("score >= 0.3")


_SCORED = rf"""WITH v AS (SELECT doc_id, text AS v FROM documents UNION ALL SELECT item_id, text FROM benchmark),
d AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[\p{{L}}\p{{Nd}}]')),
j AS (SELECT v.doc_id, v, regexp_replace(lower(v), '[^\p{{L}}\p{{Nd}}]', '', 'g') AS fv, regexp_replace(lower(text), '[^\p{{L}}\p{{Nd}}]', '', 'g') AS ft, regexp_extract_all(lower(v), '[\p{{L}}\p{{Nd}}]+') AS w, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}]+') AS dw FROM v JOIN d USING (doc_id)),
p AS (SELECT doc_id, v, fv, ft, w, dw, {_PAIRS} AS p, list_distinct(list_transform(range(1, len(dw)), lambda i: least(dw[i], dw[i + 1]) || ' ' || greatest(dw[i], dw[i + 1]))) AS dp FROM j),
s AS (SELECT doc_id, v, CASE WHEN fv <> '' AND contains(ft, fv) THEN 1.0 WHEN len(w) = 0 THEN NULL WHEN len(w) = 1 THEN CAST(list_contains(dw, w[1]) AS DOUBLE) ELSE len(list_intersect(p, dp)) / len(p) END AS score FROM p)
"""


def _scored(spark, sf):
    """Each document's text and the benchmark item of its number, scored against the document."""
    d, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    v = d.select(F.col("doc_id").alias("job"), F.col("text").alias("value")).union(items.select("item_id", "text"))
    return scoring.score_values(v.withColumn("short", F.lit(True)), d.select(F.col("doc_id").alias("job"), "text"))


@query(_SCORED + "SELECT doc_id AS job, v AS value, round(score, 4) AS score FROM s WHERE score < 0.5")
def hallucination_flags(spark, sf):
    return _scored(spark, sf).where(scoring.is_hallucination(F.col("score"), F.col("short"))).select("job", "value", F.round("score", 4).alias("score"))


@query(_SCORED + "SELECT doc_id AS job, CAST(count(*) AS BIGINT) AS items, round(avg(score), 4) AS confidence, bool_or(score < 0.5) OR coalesce(round(avg(score), 4) < 0.7, false) AS needs_review FROM s WHERE score IS NOT NULL GROUP BY doc_id")
def review_flag(spark, sf):
    s = _scored(spark, sf).where("score IS NOT NULL").groupBy("job").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg("score"), 4).alias("confidence"), F.bool_or(F.col("score") < scoring.HALLUCINATION_BELOW).alias("bad"))
    return s.select("job", "items", "confidence", (F.col("bad") | F.coalesce(F.col("confidence") < scoring.REVIEW_BELOW, F.lit(False))).alias("needs_review"))


@query("""WITH a AS (SELECT source, lang, avg(quality) AS q, avg(CAST(toxic AS DOUBLE)) AS x FROM labels JOIN documents USING (doc_id) GROUP BY source, lang)
SELECT source, round(avg(q), 4) AS quality, round(avg(x), 4) AS toxic, round((avg(q) + avg(x)) / 2, 4) AS combined, CAST(count(*) AS BIGINT) AS items FROM a GROUP BY source""")
def field_confidence(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang"), "doc_id")
    a = d.groupBy("source", "lang").agg(F.avg("quality").alias("q"), F.avg("toxic").alias("x"))
    return a.groupBy("source").agg(F.round(F.avg("q"), 4).alias("quality"), F.round(F.avg("x"), 4).alias("toxic"), F.round((F.avg("q") + F.avg("x")) / 2, 4).alias("combined"), F.count(F.lit(1)).alias("items"))


# --- jobs and events --------------------------------------------------------------------------------------


@query("SELECT sha256(text) AS sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def dedupe_by_hash(spark, sf):
    return table(spark, sf, "documents").select(sha("text").alias("sha256"), "doc_id").groupBy("sha256").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query("SELECT user_id, event_type, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1 ORDER BY ts DESC, event_id DESC LIMIT 20")
def latest_status_topk(spark, sf):
    last = jobs.latest(table(spark, sf, "events"), "user_id", [F.desc("ts"), F.desc("event_id")])
    return last.select("user_id", "event_type", "ts", "event_id").orderBy(F.desc("ts"), F.desc("event_id")).limit(20)


_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' WHEN 'view' THEN 'PROCESSING' ELSE 'REVIEW_PENDING' END"
#: Every event sets and asks for its user's job; jobs only set, or only asked for, are added under numbers of their own.
_SNAPSHOT = f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events),
j AS (SELECT unnest([2 * user_id, -1 - 2 * user_id]) AS job, {_STATUS} AS status, 'f' || event_id AS filename, ts AS at FROM e WHERE k = 1),
q AS (SELECT unnest([2 * user_id, 2 * user_id + 1]) AS job, 'g' || event_id AS filename, ts FROM events),
r AS (SELECT job, arg_min(filename, ts) AS filename, min(ts) AS at FROM q GROUP BY job)
"""


def _snapshot(spark, sf):
    e, user = table(spark, sf, "events"), F.col("user_id")
    at, other = F.col("ts"), F.lit(None).cast("string")
    last = jobs.latest(e, "user_id", [F.desc("ts"), F.desc("event_id")])
    now = last.select(F.explode(F.array(2 * user, -1 - 2 * user)).alias("job"), F.expr(_STATUS).alias("status"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("filename"), at.alias("created_at"), at.alias("updated_at"), other.alias("error_reason"))
    asked = e.select(F.explode(F.array(2 * user, 2 * user + 1)).alias("job"), F.concat(F.lit("g"), F.col("event_id").cast("string")).alias("filename"), at.alias("at"))
    return now, asked


@query(_SNAPSHOT + """SELECT coalesce(j.job, r.job) AS job, CASE WHEN t THEN 'PROCESSING' ELSE status END AS status, CASE WHEN t THEN r.filename ELSE j.filename END AS filename, CASE WHEN t THEN r.at ELSE j.at END AS updated_at
FROM j FULL JOIN r ON j.job = r.job, LATERAL (SELECT r.job IS NOT NULL AND (status IS NULL OR status = 'FAILED') AS t)""")
def job_upsert(spark, sf):
    return jobs.register(*_snapshot(spark, sf))[0].select("job", "status", "filename", "updated_at")


@query(_SNAPSHOT + "SELECT j.job, status, j.filename, CASE status WHEN 'PROCESSING' THEN 'IN_PROGRESS' ELSE 'ALREADY_PROCESSED' END AS code FROM j JOIN r ON j.job = r.job WHERE status <> 'FAILED'")
def job_conflicts(spark, sf):
    return jobs.register(*_snapshot(spark, sf))[1].select("job", "status", "filename", F.col("decision.code").alias("code"))


#: Changes of status by the job's number; every fourth is a failure without the call for failures, every fourth no status.
_CHANGES = _SNAPSHOT.rstrip() + """,
c AS (SELECT job, r.at AS since, CASE ((job % 8) + 8) % 8 WHEN 1 THEN 'COMPLETED' WHEN 2 THEN 'REVIEW_PENDING' WHEN 3 THEN 'FAILED' WHEN 4 THEN 'COMPLETED' WHEN 6 THEN 'PROCESSING' ELSE 'NONSENSE' END AS status FROM r)
"""


def _changed(spark, sf):
    now, asked = _snapshot(spark, sf)
    k = F.pmod("job", F.lit(8))
    changes = asked.groupBy("job").agg(F.min("at").alias("at")).select("job", F.when(k.isin(1, 4), "COMPLETED").when(k == 2, "REVIEW_PENDING").when(k == 3, "FAILED").when(k == 6, "PROCESSING").otherwise("NONSENSE").alias("status"), "at")
    return jobs.update_status(now, changes)


@query(_CHANGES + """SELECT j.job, CASE WHEN c.status IN ('COMPLETED', 'REVIEW_PENDING', 'PROCESSING') THEN c.status ELSE j.status END AS status, CASE WHEN c.status IN ('COMPLETED', 'REVIEW_PENDING', 'PROCESSING') THEN c.since ELSE j.at END AS updated_at FROM j LEFT JOIN c ON c.job = j.job""")
def job_status_updates(spark, sf):
    return _changed(spark, sf)[0].select("job", "status", "updated_at")


@query(_CHANGES + """SELECT job, 'invalid_status' AS problem FROM c WHERE status IN ('FAILED', 'NONSENSE') UNION ALL SELECT job, 'not_found' FROM c WHERE status NOT IN ('FAILED', 'NONSENSE') AND job NOT IN (SELECT job FROM j)""")
def job_updates_refused(spark, sf):
    return _changed(spark, sf)[1]


@query("""SELECT doc_id, CASE WHEN n_chars * 30000 > 500000000 THEN 'TOO_LARGE' WHEN doc_id % 7 = 0 THEN 'NOT_PDF' WHEN doc_id % 13 = 0 THEN 'HASH_MISMATCH' WHEN doc_id % 11 = 0 THEN 'ENCRYPTED' WHEN n_chars // 40 < 1 THEN 'DAMAGED' WHEN n_chars // 40 > 200 THEN 'TOO_MANY_PAGES' END AS reason FROM documents""")
def validation_chain(spark, sf):
    i = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", checks.rejection(F.col("n_chars") * 30000, i % 7 != 0, F.when(i % 13 == 0, "a").otherwise("b"), F.lit("b"), i % 11 == 0, F.floor(F.col("n_chars") / 40)).alias("reason"))


@query(f"""SELECT status, CASE status WHEN 'PROCESSING' THEN 'SKIPPED' WHEN 'FAILED' THEN 'ERROR' ELSE 'SKIPPED' END AS decision, CASE status WHEN 'PROCESSING' THEN 'IN_PROGRESS' WHEN 'FAILED' THEN NULL ELSE 'ALREADY_PROCESSED' END AS code, count(*) AS n, bool_and(status = 'FAILED') AS again FROM (SELECT {_STATUS} AS status FROM events) GROUP BY status""")
def decision_case(spark, sf):
    e = table(spark, sf, "events").select(F.expr(_STATUS).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    d = checks.conflict_decision("status")
    return e.select("status", F.coalesce(d.getField("decision"), F.lit("ERROR")).alias("decision"), d.getField("code").alias("code"), "n", checks.reprocessable("status").alias("again"))


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events),
s AS (SELECT *, CASE WHEN i >= 100 THEN 'skipped' WHEN event_type = 'error' THEN 'unavailable' WHEN event_type = 'view' THEN 'skipped' ELSE 'verified' END AS st FROM e),
w AS (SELECT *, sum(CAST(st = 'unavailable' AS INT)) OVER (PARTITION BY user_id, st = 'skipped' ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run FROM s),
c AS (SELECT user_id, min(i) AS cut FROM w WHERE st <> 'skipped' AND run = 3 GROUP BY user_id)
SELECT event_id, CASE WHEN i > cut AND i < 100 THEN 'unavailable' ELSE st END AS status FROM w LEFT JOIN c USING (user_id)""")
def circuit_breaker(spark, sf):
    e = table(spark, sf, "events").withColumn("i", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1)
    st = F.when(F.col("event_type") == "error", "unavailable").when(F.col("event_type") == "view", "skipped").otherwise("verified")
    return references.circuit_breaker(e.withColumn("status", st), key="user_id").select("event_id", "status")


@query("SELECT user_id, m AS page, event_id FROM (SELECT *, minute(ts) AS m, row_number() OVER (PARTITION BY user_id, minute(ts) ORDER BY event_id) AS k FROM events WHERE minute(ts) >= 1) WHERE k = 1")
def dedupe_first_arrival(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.minute("ts").cast("long").alias("page"), "event_id")
    return merge.first_arrivals(e, "user_id", "page", "event_id")


@query("""WITH e AS (SELECT user_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS ts, CAST(floor(value * 1000) AS BIGINT) AS d FROM events)
SELECT user_id, max(ts) AS extracted_at, coalesce((epoch_us(max(ts)) - min(epoch_us(ts) - d * 1000)) // 1000, 0) AS duration_ms FROM e GROUP BY user_id""")
def route_timing(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("extracted_at"), F.floor(F.col("value") * 1000).alias("duration_ms"))
    return merge.route_timing(e, "user_id")


@query("""SELECT l_orderkey, arg_min(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, CASE WHEN l_returnflag <> 'N' THEN (l_linenumber, l_partkey, l_suppkey) END) AS model, sum(l_quantity) AS input_tokens, sum(CAST(l_partkey AS DOUBLE)) AS output_tokens FROM lineitem GROUP BY l_orderkey""")
def route_cost(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("page"), F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("model"), F.col("l_quantity").alias("input_tokens"), F.col("l_partkey").cast("double").alias("output_tokens"))
    return merge.route_cost(l, "l_orderkey")


@query("""SELECT event_id, json_extract_string(raw, '$.Error') AS error, coalesce(json_extract_string(raw, '$.cause'), '') AS cause FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '{"Error": "E' || event_id || '", "cause": "' || event_type || '"}' WHEN 2 THEN '[1]' ELSE '{"Error": ' || event_id || '}' END AS raw FROM events) WHERE event_id % 4 = 1""")
def catch_parse(spark, sf):
    i = F.col("event_id")
    n = i.cast("string")
    raw = F.when(i % 4 == 0, F.col("props")).when(i % 4 == 1, F.concat(F.lit('{"Error": "E'), n, F.lit('", "cause": "'), "event_type", F.lit('"}'))).when(i % 4 == 2, "[1]").otherwise(F.concat(F.lit('{"Error": '), n, F.lit("}")))
    return table(spark, sf, "events").withColumn("c", scalars.parse_catch(raw)).where("c IS NOT NULL").select("event_id", "c.error", "c.cause")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '000Z' AS wire, epoch_us(ts) // 1000 AS ms, CAST(floor(least(500 * pow(2, event_id % 8), 20000)) AS BIGINT) AS cap, CASE WHEN event_id % 3 = 0 THEN 0.0 WHEN event_id % 3 = 1 THEN 1.0 / (event_id % 50 + 1) ELSE 0.0 END AS wait, CASE WHEN event_id % 4 = 0 THEN 150 ELSE CAST(event_id % 4 * 50 AS INT) END AS dpi FROM events""")
def wire_values(spark, sf):
    i = F.col("event_id")
    limit = F.when(i % 3 == 0, "x").when(i % 3 == 1, (i % 50 + 1).cast("string")).otherwise("0")
    dpi = F.when(i % 4 == 0, "none").otherwise((i % 4 * 50).cast("string"))
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", scalars.wire_time(ts).alias("wire"), F.unix_millis(ts).alias("ms"), F.floor(scalars.backoff_cap(i % 8 + 1)).alias("cap"), scalars.rate_interval(F.lit("1"), limit).alias("wait"), scalars.setting_or_default(dpi).alias("dpi"))


@query("""SELECT event_type, CASE WHEN event_type = 'error' THEN 'damaged' ELSE 'other' END AS k, count(*) AS n, CAST(sum(CAST(event_id % 3 = 0 AS INT)) AS BIGINT) AS repeated FROM events GROUP BY ALL""")
def classified_errors(spark, sf):
    e = table(spark, sf, "events")
    kind = checks.pdf_error(F.when(F.col("event_type") == "error", "Syntax Error: file is DAMAGED").otherwise("fine"))
    feat = checks.features_problem(t.split_features(F.when(F.col("event_id") % 3 == 0, "TABLES, TABLES").otherwise(" TABLES ,,LAYOUT")))
    return e.groupBy("event_type", F.when(kind == "DAMAGED", "damaged").otherwise("other").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.coalesce(feat, F.lit("")) == "repeated").cast("long")).alias("repeated"))


# --- conversations as pages -------------------------------------------------------------------------------

_TURNS = """WITH c AS (SELECT conv_id, turn, text, CASE WHEN role = 'user' THEN text ELSE '' END AS heading, CASE WHEN turn % 5 = 4 THEN false END AS cont FROM conversations),
s AS (SELECT *, CAST(heading <> '' OR coalesce(cont, true) = false OR row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS INT) AS st FROM c),
i AS (SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS island FROM s)
"""


@query(_TURNS + """SELECT conv_id, CAST(island AS BIGINT) AS island, arg_min(heading, turn) AS heading, CAST(count(*) AS BIGINT) AS parts, sha256(list_reduce(list(trim(text) ORDER BY turn), lambda a, b: CASE WHEN ascii(right(a, 1)) < 128 AND ascii(left(b, 1)) < 128 THEN a || ' ' || b ELSE a || b END)) AS h FROM i GROUP BY conv_id, island""")
def turn_islands(spark, sf):
    turns = table(spark, sf, "conversations")
    c = turns.select("conv_id", F.col("turn").alias("page"), F.lit(0).alias("idx"), F.when(F.col("role") == "user", F.col("text")).otherwise("").alias("heading"), F.when(F.col("turn") % 5 == 4, F.lit(False)).alias("cont"), "text")
    p = merge.section_islands(c, "conv_id").groupBy("conv_id", "island").agg(F.array_sort(F.collect_list(F.struct("page", "heading", "text"))).alias("p"))
    return p.select("conv_id", "island", F.col("p")[0].heading.alias("heading"), F.size("p").cast("long").alias("parts"), sha(t.join_fragments(F.transform("p", lambda x: t.trim_space(x.getField("text"))))).alias("h"))


@query("""WITH s AS (SELECT conv_id, turn, CAST(NOT (turn % 3 = 1) OR row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS INT) AS st FROM conversations)
SELECT conv_id, turn, CAST(sum(st) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM s""")
def reference_islands(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("page"), F.lit(0).alias("idx"), F.when(F.col("turn") % 3 == 1, F.lit(True)).when(F.col("turn") % 3 == 2, F.lit(False)).alias("cont"))
    return merge.reference_islands(c, "conv_id").select("conv_id", F.col("page").alias("turn"), "island")


@query("""SELECT conv_id, coalesce(arg_min(trim(text), turn) FILTER (WHERE role = 'assistant'), '') AS title, coalesce(arg_min(trim(text), turn) FILTER (WHERE role = 'user' AND turn > 0), '') AS abstract, arg_min([role], turn) FILTER (WHERE turn > 1) AS keywords FROM conversations GROUP BY conv_id""")
def first_nonempty_meta(spark, sf):
    c = table(spark, sf, "conversations")
    pages = c.select("conv_id", F.col("turn").alias("page"), F.when(F.col("role") == "assistant", F.col("text")).otherwise(" ").alias("title"), F.when((F.col("role") == "user") & (F.col("turn") > 0), F.col("text")).alias("abstract"), F.array().cast("array<string>").alias("authors"), F.when(F.col("turn") > 1, F.array("role")).otherwise(F.array().cast("array<string>")).alias("keywords"))
    return merge.merged_metadata(pages, "conv_id").select("conv_id", "title", "abstract", "keywords")


@query("""WITH c AS (SELECT conv_id, turn + 1 AS page FROM conversations WHERE turn % 3 <> 1), l AS (SELECT conv_id, max(page) AS last FROM c GROUP BY conv_id)
SELECT conv_id AS job, CAST(g AS BIGINT) AS page FROM l, range(1, last + 1) AS r(g) WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.conv_id = l.conv_id AND c.page = g)""")
def missing_turns(spark, sf):
    c = table(spark, sf, "conversations").where("turn % 3 <> 1").select(F.col("conv_id").alias("job"), (F.col("turn") + 1).cast("int").alias("page"))
    return merge.missing_pages(c).withColumn("page", F.col("page").cast("long"))


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'Figure ' ELSE '' END || text AS text FROM conversations)
SELECT conv_id, turn, CASE WHEN lead(text) OVER w LIKE 'Figure%' THEN trim(lead(text) OVER w) WHEN lag(text) OVER w LIKE 'Figure%' THEN trim(lag(text) OVER w) ELSE '' END AS caption, 'figure-' || row_number() OVER w AS id FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def caption_lead_lag(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("job"), F.lit(1).alias("page"), F.col("turn").alias("n"), F.concat(F.when(F.col("turn") % 3 == 0, "Figure ").otherwise(""), "text").alias("text"))
    return layout.sequence_ids(c.withColumn("caption", layout.caption_near(["figure", "fig."])), "figure", "n").select(F.col("job").alias("conv_id"), F.col("n").alias("turn"), "caption", "id")


@query("""WITH o AS (SELECT conv_id, max(turn) AS last, count(*) AS size FROM conversations GROUP BY conv_id), s AS (SELECT conv_id, 0 AS idx, 0 AS a, 1 AS b FROM o UNION ALL SELECT conv_id, 1, 1, last FROM o UNION ALL SELECT conv_id, 2, -1, -1 FROM o UNION ALL SELECT conv_id, 3, 0, size FROM o),
x AS (SELECT s.*, size, NOT (a = -1 AND b = -1) AND (a < 0 OR b >= size OR a > b) AS bad FROM s JOIN o USING (conv_id))
SELECT x.conv_id AS job, idx, bad AS bad_range, sha256(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn), '')) AS h, CAST(count(text) AS INT) AS n FROM x LEFT JOIN conversations c ON c.conv_id = x.conv_id AND turn BETWEEN a AND b AND NOT bad AND a >= 0 AND role <> 'system' GROUP BY ALL""")
def range_assemble(spark, sf):
    from .finalize import layout_documents

    c = table(spark, sf, "conversations")
    e = c.select(F.col("conv_id").alias("job"), F.col("turn").cast("int").alias("n"), (F.col("turn") + 1).cast("int").alias("page"), F.when(F.col("role") == "system", "LAYOUT_TITLE").otherwise("LAYOUT_TEXT").alias("type"), F.lit(None).cast("string").alias("table_id"), "text")
    o = e.groupBy("job").agg(F.max("n").alias("last"), F.count(F.lit(1)).cast("int").alias("size"))
    spec = F.array(*[F.struct(F.lit(i).alias("idx"), a.alias("from_ord"), b.alias("to_ord")) for i, a, b in ((0, F.lit(0), F.lit(1)), (1, F.lit(1), F.col("last")), (2, F.lit(-1), F.lit(-1)), (3, F.lit(0), F.col("size")))])
    outline = o.select("job", F.explode(spec).alias("s")).select("job", "s.*", F.lit(1).alias("level"), F.lit("h").alias("heading"))
    return layout_documents(e, outline).select("job", "idx", "bad_range", sha("text").alias("h"), F.size("pages").alias("n"))


@query("""SELECT conv_id, list_sort(list_distinct(list(role || '!'))) AS sorted, CAST(len(list_distinct(list(role))) AS INT) AS n FROM conversations GROUP BY conv_id""")
def warnings_union(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    own = F.transform("r", lambda x: F.concat(x.getField("role"), F.lit("!")))
    return c.select("conv_id", scalars.sorted_distinct(F.concat(own, own)).alias("sorted"), F.size(scalars.distinct_in_order(own)).alias("n"))


# --- layout and tables ------------------------------------------------------------------------------------

_BOXES = """WITH b AS (SELECT p_partkey // 20 AS page, p_partkey % 20 AS ord, CASE WHEN (p_partkey // 20) % 3 = 0 THEN 0.1 WHEN p_partkey % 9 = 0 THEN 0.1 WHEN p_size % 2 = 0 THEN 0.08 ELSE 0.52 END AS x0, p_size / 64 AS y0,
 CASE WHEN (p_partkey // 20) % 3 = 0 THEN 0.9 WHEN p_partkey % 9 = 0 THEN 0.9 WHEN p_size % 2 = 0 THEN 0.46 ELSE 0.9 END AS x1 FROM part),
g AS (SELECT *, max(x1) OVER (PARTITION BY page ORDER BY x0, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rt FROM b WHERE x1 - x0 <= 0.55),
s AS (SELECT page, arg_min(rt + (x0 - rt) / 2, (-(x0 - rt), x0, ord)) AS split FROM g WHERE x0 - rt > 0.02 AND rt + (x0 - rt) / 2 BETWEEN 0.3 AND 0.7 GROUP BY page),
c AS (SELECT b.*, split, CASE WHEN split IS NULL THEN 0 WHEN x1 <= split THEN 1 WHEN x0 >= split THEN 2 ELSE 0 END AS col FROM b LEFT JOIN s USING (page))
"""


def _boxes(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    whole = (F.floor(k / 20) % 3 == 0) | (k % 9 == 0)
    x0 = F.when(whole, 0.1).when(size % 2 == 0, 0.08).otherwise(0.52)
    x1 = F.when(whole, 0.9).when(size % 2 == 0, 0.46).otherwise(0.9)
    return table(spark, sf, "part").select(F.lit("j").alias("job"), F.floor(k / 20).alias("page"), (k % 20).alias("ord"), F.array(x0, size / 64, x1, size / 64 + 0.01).alias("bbox"))


@query(_BOXES + "SELECT page, round(split, 6) AS split FROM s")
def two_column_split(spark, sf):
    return layout.column_splits(_boxes(spark, sf)).select("page", F.round("split", 6).alias("split"))


@query(_BOXES + """, d AS (SELECT *, CASE WHEN split IS NULL THEN 0 ELSE 2 * coalesce(sum(CAST(col = 0 AS INT)) OVER (PARTITION BY page ORDER BY y0, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + CAST(col = 0 AS INT) END AS band FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY band, CASE WHEN split IS NULL THEN 0 ELSE col END, CASE WHEN split IS NULL THEN 0 ELSE y0 END, CASE WHEN split IS NULL THEN 0 ELSE x0 END, ord) - 1 AS rank, row_number() OVER (PARTITION BY page ORDER BY ord) - 1 AS place FROM d)
SELECT page, ord, CAST(col AS INT) AS col, CAST(rank AS INT) AS rank, bool_or(rank <> place) OVER (PARTITION BY page) AS reordered FROM r""")
def reading_order(spark, sf):
    return layout.reading_order(_boxes(spark, sf)).select("page", "ord", "col", "rank", "reordered")


_OVERLAPS = """WITH e AS (SELECT p_partkey % 50 AS page, p_partkey AS n, p_size / 100 AS x0, p_size / 200 AS y0 FROM part), t AS (SELECT p_partkey % 50 AS page, p_partkey AS o, p_size / 90 AS x0, p_size / 150 AS y0 FROM part),
a AS (SELECT page, n, o, round(greatest(least(e.x0 + 0.2, t.x0 + 0.2) - greatest(e.x0, t.x0), 0) * greatest(least(e.y0 + 0.2, t.y0 + 0.2) - greatest(e.y0, t.y0), 0), 9) AS area FROM e JOIN t USING (page))
"""


def _overlap_sides(parts):
    p, size = parts, F.col("p_size")
    box = lambda x, y: F.array(x, y, x + 0.2, y + 0.2)
    e = p.select(F.lit("j").alias("job"), (F.col("p_partkey") % 50).alias("page"), F.col("p_partkey").cast("int").alias("n"), F.lit("LAYOUT_TABLE").alias("type"), box(size / 100, size / 200).alias("bbox"))
    x = p.select(F.lit("j").alias("job"), (F.col("p_partkey") % 50).alias("page"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("table_id"), F.col("p_partkey").cast("int").alias("table_ord"), box(size / 90, size / 150).alias("bbox"))
    return e, x


@query(_OVERLAPS + "SELECT CAST(n AS INT) AS n, 't' || arg_max(o, (area, -o)) AS table_id, round(max(area), 6) AS area FROM a WHERE area > 0 GROUP BY n")
def overlap_match(spark, sf):
    return layout.best_overlaps(*_overlap_sides(table(spark, sf, "part"))).select("n", "table_id", F.round("area", 6).alias("area"))


@query(_OVERLAPS.replace("WITH e", "WITH RECURSIVE e").rstrip() + """,
el AS (SELECT page, n, row_number() OVER (PARTITION BY page ORDER BY n) AS k FROM (SELECT DISTINCT page, n FROM a WHERE area > 0)),
walk AS (SELECT page, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS o, CAST([] AS BIGINT[]) AS used FROM (SELECT DISTINCT page FROM el)
  UNION ALL SELECT page, k, n, o, CASE WHEN o IS NULL THEN used ELSE list_append(used, o) END FROM (
    SELECT w.page, el.k, el.n, a.o, w.used, row_number() OVER (PARTITION BY w.page ORDER BY a.area DESC NULLS LAST, a.o) AS r FROM walk w JOIN el ON el.page = w.page AND el.k = w.k + 1
    LEFT JOIN a ON a.page = el.page AND a.n = el.n AND a.area > 0 AND NOT list_contains(w.used, a.o)) WHERE r = 1)
SELECT CAST(n AS INT) AS n, 't' || o AS table_id FROM walk WHERE o IS NOT NULL""")
def overlap_exclusive(spark, sf):
    return layout.exclusive_overlaps(*_overlap_sides(table(spark, sf, "part"))).select("n", "table_id")


_CELLS = """WITH l AS (SELECT l_orderkey AS o, l_linenumber AS r, l_suppkey % 4 + 1 AS c, max(l_returnflag || l_partkey) AS text, bool_or(l_linenumber <= 2 AND l_linestatus = 'F') AS h FROM lineitem GROUP BY 1, 2, 3),
s AS (SELECT o, max(r) AS rows, max(c) AS cols FROM l GROUP BY o), a AS (SELECT s.*, r, c FROM s, range(1, rows + 1) AS x(r), range(1, cols + 1) AS y(c)),
g AS (SELECT a.*, text, h, bool_or(coalesce(h, false)) OVER (PARTITION BY a.o, a.r) AS rh FROM a LEFT JOIN l ON l.o = a.o AND l.r = a.r AND l.c = a.c),
b AS (SELECT *, min(CASE WHEN NOT rh THEN r END) OVER (PARTITION BY o) AS fb FROM g), d AS (SELECT *, rh AND (fb IS NULL OR r < fb) AS head, last_value(text IGNORE NULLS) OVER (PARTITION BY o, r ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lt FROM b)
"""


@query(_CELLS + "SELECT CAST(o AS VARCHAR) AS table_id, CAST(r AS INT) AS r, CAST(c AS INT) AS c, CASE WHEN text IS NOT NULL THEN text WHEN head AND coalesce(lt, '') <> '' THEN lt ELSE '' END AS text, text IS NULL AND head AND coalesce(lt, '') <> '' AS inferred, head AS is_header FROM d")
def grid_restore(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("row"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("col")).agg(F.max(F.concat("l_returnflag", F.col("l_partkey").cast("string"))).alias("text"), F.bool_or((F.col("l_linenumber") <= 2) & (F.col("l_linestatus") == "F")).alias("header"))
    cells = grid.sparse_cells(l.withColumn("job", F.lit("j")), "job", "l_orderkey", "row", "col", "text", "header")
    return grid.full_grid(cells).select("table_id", "r", "c", "text", "inferred", "is_header")


@query(_CELLS + "SELECT CAST(o AS VARCHAR) AS table_id, CAST(max(CASE WHEN head THEN r ELSE 0 END) AS INT) AS header_rows, CAST(sum(CAST(text IS NULL AND head AND coalesce(lt, '') <> '' AS INT)) AS BIGINT) AS inferred, CAST(sum(CAST(text IS NULL AND NOT (head AND coalesce(lt, '') <> '') AS INT)) AS BIGINT) AS missing FROM d GROUP BY o")
def header_fill(spark, sf):
    l = table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("row"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("col")).agg(F.max(F.concat("l_returnflag", F.col("l_partkey").cast("string"))).alias("text"), F.bool_or((F.col("l_linenumber") <= 2) & (F.col("l_linestatus") == "F")).alias("header"))
    r = grid.restored_tables(grid.sparse_cells(l.withColumn("job", F.lit("j")), "job", "l_orderkey", "row", "col", "text", "header"))
    return r.select("table_id", F.size("header").alias("header_rows"), "inferred", "missing")


# --- comparison, references, corpus -----------------------------------------------------------------------


@query("""WITH c AS (SELECT c_nationkey AS k, min(c_name) AS name, count(*) AS n, round(max(c_acctbal), 2) AS b FROM customer WHERE c_nationkey % 7 <> 0 GROUP BY 1), s AS (SELECT s_nationkey AS k, min(s_name) AS name, count(*) AS n, round(max(s_acctbal), 2) AS b FROM supplier WHERE s_nationkey % 5 <> 0 GROUP BY 1)
SELECT coalesce(c.k, s.k) AS nation, c.n AS customers, s.n AS suppliers, CASE WHEN c.k IS NOT NULL AND s.k IS NOT NULL THEN lower(c.name) = lower(replace(s.name, 'Supplier', 'CUSTOMER')) END AS same_name, CASE WHEN c.k IS NOT NULL AND s.k IS NOT NULL THEN c.n = s.n END AS same_count FROM c FULL JOIN s ON c.k = s.k""")
def compare_routes(spark, sf):
    c = table(spark, sf, "customer").where("c_nationkey % 7 <> 0").groupBy(F.col("c_nationkey").alias("nation")).agg(F.min("c_name").alias("a"), F.count(F.lit(1)).alias("customers"))
    s = table(spark, sf, "supplier").where("s_nationkey % 5 <> 0").groupBy(F.col("s_nationkey").alias("nation")).agg(F.min("s_name").alias("b"), F.count(F.lit(1)).alias("suppliers"))
    j = c.join(s, "nation", "full_outer")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return j.select("nation", "customers", "suppliers", F.when(both, scalars.value_pair("a", F.replace("b", F.lit("Supplier"), F.lit("CUSTOMER"))).getField("equal")).alias("same_name"), F.when(both, scalars.count_pair("customers", "suppliers").getField("equal")).alias("same_count"))


@query("""WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'skipped' ELSE 'succeeded' END AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'succeeded' END AS b, o_orderkey % 5 = 0 AS ra, o_orderkey % 7 = 0 AS rb FROM orders),
x AS (SELECT *, a = 'succeeded' OR b = 'succeeded' AS k, ((a = 'succeeded' OR b = 'succeeded') AND (a = 'failed' OR b = 'failed')) OR (a = 'succeeded' AND ra) OR (b = 'succeeded' AND rb) AS rv FROM r)
SELECT o_orderkey, CASE WHEN NOT k THEN 'FAILED' WHEN rv THEN 'REVIEW_PENDING' ELSE 'COMPLETED' END AS status, k AND rv AS needs_review FROM x""")
def status_decision(spark, sf):
    k = F.col("o_orderkey")
    a = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "skipped").otherwise("succeeded")
    d = compare.decision(a, F.when(k % 3 == 0, "failed").otherwise("succeeded"), k % 5 == 0, k % 7 == 0)
    return table(spark, sf, "orders").select("o_orderkey", d.getField("status").alias("status"), d.getField("needs_review").alias("needs_review"))


@query(rf"""WITH w AS (SELECT '10.1000/' || p_partkey AS doi, p_name AS title FROM part WHERE p_partkey % 3 <> 0), r AS (SELECT p_partkey AS i, '10.1000/' || p_partkey AS doi, CASE WHEN p_partkey % 5 = 0 THEN 'other work' ELSE p_name || ' ' || p_brand END AS title FROM part),
j AS (SELECT i, w.title AS mt, regexp_extract_all(lower(w.title), '[\p{{L}}\p{{Nd}}]+') AS w, regexp_extract_all(lower(r.title), '[\p{{L}}\p{{Nd}}]+') AS dw FROM r LEFT JOIN w USING (doi)),
s AS (SELECT i, mt, len(list_intersect({_PAIRS}, list_distinct(list_transform(range(1, len(dw)), lambda i: least(dw[i], dw[i + 1]) || ' ' || greatest(dw[i], dw[i + 1]))))) / len({_PAIRS}) AS sc FROM j)
SELECT i, CASE WHEN mt IS NULL THEN 'notFound' WHEN sc < 0.7 THEN 'mismatch' ELSE 'verified' END AS status, CASE WHEN mt IS NOT NULL THEN sc END AS similarity FROM s""")
def doi_lookup(spark, sf):
    p = table(spark, sf, "part")
    works = p.where("p_partkey % 3 <> 0").select(F.concat(F.lit("10.1000/"), F.col("p_partkey").cast("string")).alias("doi"), F.col("p_name").alias("title"))
    refs = p.select(F.lit("j").alias("job"), F.col("p_partkey").alias("i"), F.concat(F.lit("10.1000/"), F.col("p_partkey").cast("string")).alias("doi"), F.when(F.col("p_partkey") % 5 == 0, "other work").otherwise(F.concat_ws(" ", "p_name", "p_brand")).alias("title"), F.lit("").alias("raw"))
    return references.lookup_doi(refs, works).select("i", "status", "similarity")


_BROKEN = r"regexp_replace(text, '[-\x{AD}\x{2010}][ \t]*\r?\n[ \t]*', '', 'g')"


@query(rf"""WITH d AS (SELECT '10.1/' || doc_id AS doi, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}]+') AS w FROM documents),
dt AS (SELECT doi, unnest(list_distinct(w)) AS tok FROM d), n AS (SELECT tok, count(*) AS n FROM dt GROUP BY tok),
q AS (SELECT CAST(item_id AS INT) AS i, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nd}}]+') AS w, regexp_extract_all(lower({_BROKEN}), '[\p{{L}}\p{{Nd}}]+') AS v FROM benchmark WHERE coalesce(text, '') <> ''),
qt AS (SELECT i, unnest(list_distinct(w)) AS tok FROM q),
c AS (SELECT i, doi, round(sum(1 / n), 12) AS weight FROM qt JOIN n USING (tok) JOIN dt USING (tok) GROUP BY i, doi),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY weight DESC, doi) AS k FROM c) WHERE k <= 3),
s AS (SELECT b.i, b.k, b.doi, d.text AS title, d.w, list_distinct(list_concat(q.w, q.v)) AS words, list_distinct(list_concat({_PAIRS.replace("w[", "q.w[").replace("len(w)", "len(q.w)")}, {_PAIRS.replace("w[", "q.v[").replace("len(w)", "len(q.v)")})) AS pairs FROM b JOIN d USING (doi) JOIN q USING (i)),
x AS (SELECT i, k, doi, title, CASE WHEN len(w) = 1 THEN CAST(list_contains(words, w[1]) AS DOUBLE) WHEN len(w) > 1 THEN len(list_intersect({_PAIRS}, pairs)) / len({_PAIRS}) END AS score FROM s WHERE len(words) > 0),
f AS (SELECT i, arg_min((score, doi, title), k) FILTER (WHERE score >= 0.7) AS first, arg_max((score, doi, title), (score, -k)) AS most FROM x WHERE score IS NOT NULL GROUP BY i),
o AS (SELECT CAST(item_id AS INT) AS i, coalesce(text, '') = '' AS empty, first, coalesce(first, most) AS m FROM benchmark LEFT JOIN f ON f.i = item_id)
SELECT 'j' AS job, i, CAST(NULL AS VARCHAR) AS doi, CASE WHEN i >= 100 OR empty THEN 'skipped' WHEN first IS NOT NULL THEN 'verified' ELSE 'notFound' END AS status,
CASE WHEN i < 100 THEN m[1] END AS similarity, CASE WHEN i < 100 THEN m[2] END AS matched_doi, CASE WHEN i < 100 THEN m[3] END AS matched_title FROM o""")
def title_match(spark, sf):
    works = table(spark, sf, "documents").select(F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"), F.col("text").alias("title"))
    refs = table(spark, sf, "benchmark").select(F.lit("j").alias("job"), F.col("item_id").cast("int").alias("i"), F.lit(None).cast("string").alias("doi"), F.col("text").alias("title"), F.lit("").alias("raw"))
    return references.check_references(refs, works)


@query("""SELECT page_id, pages, published FROM (SELECT page_id, CAST(length(html) // 1000 AS INT) AS pages, TIMESTAMP '2020-01-01' + to_days(CAST(page_id % 1000 AS INT)) AS published FROM pages) WHERE pages BETWEEN 2 AND 9 AND page_id % 7 <> 0 ORDER BY published DESC, CAST(page_id AS VARCHAR) LIMIT 50""")
def corpus_select(spark, sf):
    p = table(spark, sf, "pages").select(F.col("page_id"), F.col("page_id").cast("string").alias("arxiv_id"), F.floor(F.length("html") / 1000).cast("int").alias("pages"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(page_id % 1000 as int))").alias("published"))
    return corpus.select_papers(p, p.where("page_id % 7 = 0"), 2, 9, 50).select("page_id", "pages", "published")


@query("""SELECT CASE WHEN url LIKE '%example.org%' THEN 'cc' WHEN url LIKE '%example.net%' THEN 'arxiv' ELSE 'unknown' END AS license_kind, count(*) AS n, count_if(page_id % 3 = 0) AS with_source FROM pages GROUP BY 1""")
def licence_classes(spark, sf):
    p = table(spark, sf, "pages")
    url = F.when(F.col("url").contains("example.org"), "http://CreativeCommons.org/by").when(F.col("url").contains("example.net"), "").otherwise("http://other")
    return p.groupBy(checks.licence_kind(url).alias("license_kind")).agg(F.count(F.lit(1)).alias("n"), F.count_if(checks.has_source(F.when(F.col("page_id") % 3 == 0, "application/GZIP").otherwise("text/html"))).alias("with_source"))


@query("""WITH f AS (SELECT page_id % 400 AS id, max(page_id) AS pages FROM pages GROUP BY 1), m AS (SELECT page_id AS id, row_number() OVER (ORDER BY CAST(page_id AS VARCHAR)) - 1 AS ord, CAST(0 AS BIGINT) AS pages FROM pages WHERE page_id % 5 = 0),
n AS (SELECT f.id, row_number() OVER (ORDER BY CAST(f.id AS VARCHAR)) AS k, f.pages FROM f LEFT JOIN m USING (id) WHERE m.id IS NULL)
SELECT CAST(m.id AS VARCHAR) AS arxiv_id, CAST(m.ord AS INT) AS ord, coalesce(f.pages, m.pages) AS pages FROM m LEFT JOIN f USING (id) UNION ALL SELECT CAST(id AS VARCHAR), CAST((SELECT max(ord) FROM m) + k AS INT), pages FROM n""")
def manifest_upsert(spark, sf):
    p = table(spark, sf, "pages")
    m = p.where("page_id % 5 = 0").select(F.col("page_id").cast("string").alias("arxiv_id"), F.lit(0).cast("long").alias("pages"))
    m = m.join(corpus.with_positions(m, "arxiv_id"), "arxiv_id").select("arxiv_id", "ord", "pages")
    fresh = p.groupBy((F.col("page_id") % 400).cast("string").alias("arxiv_id")).agg(F.max("page_id").alias("pages"))
    return corpus.upsert(m, fresh)


@query("""SELECT 'c' || c_custkey AS job, CAST(0 AS INT) AS chunk, CAST(25 AS BIGINT) AS expected, CAST(25 - c_custkey % 3 AS BIGINT) AS written FROM customer WHERE c_custkey % 3 > 0""")
def chunk_check(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("job"), (25 - F.col("c_custkey") % 3).cast("int").alias("n"))
    pages = c.select("job", F.explode(F.sequence(F.lit(1), "n")).alias("page"))
    return writers.chunk_problems(pages, c.select("job", F.lit(25).alias("page_count")))


@query("""WITH r AS (SELECT l_orderkey AS job, l_linenumber AS seq, CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE 't' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) END AS tok, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS s, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT job, CASE WHEN tok <> '' THEN 'token_on_last' ELSE 'token_missing' END AS problem, count(*) AS n FROM r WHERE (s < n) <> (tok <> '') GROUP BY ALL""")
def paging_chain(spark, sf):
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    r = table(spark, sf, "lineitem").withColumn("s", F.row_number().over(w)).select(F.col("l_orderkey").alias("job"), F.col("s").alias("seq"), F.when(F.col("l_suppkey") % 6 == 0, "").otherwise(F.concat(F.lit("t"), F.col("s").cast("string"))).alias("next_token"))
    return readers.paged(r).groupBy("job", "problem").agg(F.count(F.lit(1)).alias("n"))


# --- streams (each run handles all that is there, then stops) -----------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _event_stream(spark, sf):
    return spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events*.parquet").parquet(sf)


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def stream_ingest(spark, sf):
    from ..streaming.flows import run_once

    out = _folder(spark, "ingest")
    run_once(_event_stream(spark, sf).writeStream.format("parquet").option("path", f"{out}/rows"), f"{out}/state")
    return spark.read.parquet(f"{out}/rows").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
