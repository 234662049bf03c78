"""Queries over requests, answers, files and manifests: what comes in, what goes out, and what does not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, scalars, strict
from ..functions import text as t
from ..operators import corpus, jobs, merge
from ..sources import readers, writers
from ..streaming import flows
from .catalogue import _folder, query, sha, table

ANSWER = "title STRING NOT NULL, year INT NOT NULL, doi STRING, sections ARRAY<STRUCT<level: INT NOT NULL, heading: STRING NOT NULL>> NOT NULL"
_RAW = """CASE event_type WHEN 'view' THEN '{"title": "t' || user_id || '", "year": ' || event_id || ', "doi": null, "sections": [{"level": 1, "heading": "h"}]}' WHEN 'click' THEN '{"title": ' || event_id || ', "year": "' || user_id || '", "doi": "10.1/x", "extra": ' || props || ', "sections": []}'
WHEN 'signup' THEN '{"year": ' || value || ', "doi": 1, "sections": [{"level": "1"}, {"heading": null, "level": ' || user_id || ', "odd": ' || props || '}, 3]}' WHEN 'purchase' THEN '{"title": null, "year": null, "sections": ' || props || '}' ELSE props || '}' END"""


@query(f"""WITH d AS (SELECT event_id, {_RAW} AS raw FROM events), v AS (SELECT event_id, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM d),
f AS (SELECT event_id, j, name, kind, CASE WHEN json_type(j, '$.' || name) = 'DOUBLE' AND TRY_CAST(json_extract_string(j, '$.' || name) AS DOUBLE) % 1 = 0 THEN 'BIGINT' ELSE json_type(j, '$.' || name) END AS type FROM v, (VALUES ('title', 's'), ('year', 'i'), ('doi', 'n'), ('sections', 'a')) AS x(name, kind) WHERE j IS NOT NULL),
e AS (SELECT event_id, i, json_extract(j, '$.sections[' || i || ']') AS e FROM (SELECT event_id, j, unnest(range(CAST(json_array_length(j, '$.sections') AS BIGINT))) AS i FROM v WHERE json_type(j, '$.sections') = 'ARRAY')),
g AS (SELECT event_id, '$.sections[' || i || '].' || name AS path, kind, json_type(e, '$.' || name) AS type FROM e, (VALUES ('level', 'i'), ('heading', 's')) AS x(name, kind) WHERE json_type(e) = 'OBJECT'),
k AS (SELECT event_id, '$.' || name AS path, kind, type FROM f UNION ALL SELECT * FROM g)
SELECT event_id, '$' AS path, 'invalid' AS problem FROM v WHERE j IS NULL
UNION ALL SELECT event_id, path, CASE WHEN type IS NULL THEN 'missing' WHEN type = 'NULL' THEN 'null' ELSE 'mistyped' END FROM k WHERE type IS NULL OR (type = 'NULL' AND kind <> 'n') OR (type <> 'NULL' AND NOT (kind IN ('s', 'n') AND type = 'VARCHAR' OR kind = 'i' AND type IN ('BIGINT', 'UBIGINT') OR kind = 'a' AND type = 'ARRAY'))
UNION ALL SELECT event_id, '$.' || k, 'unknown' FROM (SELECT event_id, unnest(json_keys(j)) AS k FROM v WHERE j IS NOT NULL) WHERE k NOT IN ('title', 'year', 'doi', 'sections')
UNION ALL SELECT event_id, '$.sections[' || i || ']', 'mistyped' FROM e WHERE json_type(e) <> 'OBJECT'
UNION ALL SELECT event_id, '$.sections[' || i || '].' || k, 'unknown' FROM (SELECT event_id, i, unnest(json_keys(e)) AS k FROM e WHERE json_type(e) = 'OBJECT') WHERE k NOT IN ('level', 'heading')""")
def answer_problems(spark, sf):
    """Answers held against their schema: the path of every field that is missing, unknown, null or of another type."""
    e = table(spark, sf, "events").select("event_id", F.expr(_RAW).alias("raw"))
    return e.select("event_id", F.explode(strict.schema_problems("raw", ANSWER)).alias("p")).select("event_id", "p.*")


_START = {
    "bucket": "CASE WHEN value < 20 THEN '' ELSE 'b' || user_id END",
    "key": "CASE WHEN event_type = 'error' THEN '' ELSE props END",
    "features": "CASE event_type WHEN 'view' THEN 'TABLES, LAYOUT' WHEN 'click' THEN ' , ' WHEN 'signup' THEN 'TABLES,TABLES' WHEN 'purchase' THEN 'TABLES,' || user_id ELSE 'LAYOUT' END",
    "topic": "CASE WHEN value < 60 THEN 'topic' END",
    "role": "CASE WHEN value < 90 THEN 'role' END",
}


@query(rf"""WITH e AS (SELECT event_id, {', '.join(f'{v} AS {k}' for k, v in _START.items())} FROM events), l AS (SELECT *, list_filter(list_transform(string_split(features, ','), lambda x: trim(x)), lambda x: x <> '') AS f FROM e),
p AS (SELECT *, CASE WHEN len(f) < 1 THEN 'empty' WHEN len(list_filter(f, lambda x: x NOT IN ('LAYOUT', 'TABLES', 'FORMS', 'SIGNATURES', 'QUERIES'))) > 0 THEN 'unknown' WHEN len(list_distinct(f)) < len(f) THEN 'repeated' END AS fp FROM l)
SELECT event_id, fp AS setting_problem, CASE WHEN bucket = '' OR key = '' THEN 'location missing' WHEN fp IS NOT NULL THEN 'features ' || fp WHEN (topic IS NULL) <> (role IS NULL) THEN 'notification incomplete' END AS problem FROM p""")
def start_requests(spark, sf):
    """Requests to start an analysis, with what is wrong with each."""
    d = table(spark, sf, "events").select("event_id", *[F.expr(v).alias(k) for k, v in _START.items()])
    return d.select("event_id", checks.features_setting_problem("features").alias("setting_problem"), checks.start_problem("bucket", "key", t.split_features("features"), "topic", "role").alias("problem"))


@query("""WITH p AS (SELECT CAST(page_id AS VARCHAR) AS id, page_id, html, url, CAST(length(html) // 1000 AS INT) AS pages, TIMESTAMP '2020-01-01' + to_days(CAST(page_id % 1000 AS INT)) AS published FROM pages),
m AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS ord, page_id FROM p WHERE url LIKE '%example.net%'),
n AS (SELECT *, row_number() OVER (ORDER BY id) AS k FROM p WHERE url NOT LIKE '%example.net%' AND pages BETWEEN 2 AND 9)
SELECT id AS arxiv_id, CAST(ord AS INT) AS ord, CAST(NULL AS INT) AS pages, CAST(NULL AS VARCHAR) AS license_kind, CAST(NULL AS VARCHAR) AS sha256 FROM m
UNION ALL SELECT id, CAST((SELECT coalesce(max(ord), -1) FROM m) + k AS INT), pages, CASE WHEN url LIKE '%example.org%' THEN 'cc' ELSE 'unknown' END, sha256(html) FROM n""")
def corpus_run(spark, sf):
    """One run of the corpus: pages as found papers, those of one host known before; the rest selected by length, enriched
    and appended in order of their ids."""
    p = table(spark, sf, "pages").withColumn("arxiv_id", F.col("page_id").cast("string"))
    known = p.where(F.col("url").contains("example.net")).select("arxiv_id")
    none = lambda kind: F.lit(None).cast(kind)
    m = known.join(corpus.with_positions(known, "arxiv_id"), "arxiv_id").select("arxiv_id", "ord", none("int").alias("pages"), none("string").alias("license_kind"), none("string").alias("sha256"))
    entries = p.select("arxiv_id", F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(page_id % 1000 as int))").alias("published"))
    licence = F.when(F.col("url").contains("example.org"), "http://CreativeCommons.org/by").otherwise("http://other")
    details = p.select("arxiv_id", F.floor(F.length("html") / 1000).cast("int").alias("pages"), F.col("html").alias("text"), licence.alias("license"), F.lit("text/html").alias("content_type"), F.col("html").cast("binary").alias("content"))
    return corpus.run(entries, details, m, 2, 9).select("arxiv_id", "ord", "pages", "license_kind", "sha256")


@query("SELECT CAST(page_id AS VARCHAR) AS arxiv_id, url FROM pages ORDER BY length(html) DESC, CAST(page_id AS VARCHAR) LIMIT 40")
def corpus_search(spark, sf):
    """The newest entries, where length stands for time."""
    p = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("arxiv_id"), F.length("html").alias("published"), "url")
    return corpus.search(p, 40).select("arxiv_id", "url")


@query("SELECT page_id, CASE WHEN trim(url) <> '' THEN trim(url) END AS license FROM pages")
def licence_records(spark, sf):
    """Licences in metadata records, with a namespace and characters that XML escapes."""
    xml = F.concat(F.lit('<r xmlns="x:y"><m><license a="1"> '), F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(" </license></m></r>"))
    return table(spark, sf, "pages").select("page_id", readers.licence_of(xml).alias("license"))


@query("""WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS job, max(turn) + 2 AS n FROM conversations GROUP BY conv_id) SELECT job, CAST(g AS INT) AS page, role FROM (SELECT job, unnest(range(1, n + 1)) AS g FROM c) LEFT JOIN conversations t ON CAST(t.conv_id AS VARCHAR) = job AND t.turn + 1 = g""")
def gap_filled_pages(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("job"), (F.col("turn") + 1).cast("int").alias("page"), "role")
    return merge.gap_filled(c, c.groupBy("job").agg((F.max("page") + 1).alias("page_count"))).select("job", "page", "role")


@query("SELECT CAST(d.doc_id AS VARCHAR) AS job, CASE WHEN d.n_chars >= 500 THEN coalesce(i.text, '') ELSE '' END AS text, d.n_chars >= 500 AS has_text_layer FROM documents d LEFT JOIN benchmark i ON i.item_id = d.doc_id")
def layer_texts(spark, sf):
    """Text layers of jobs that have one; '' where none is there or it is not to be read."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("job"), (F.col("n_chars") >= 500).alias("has_text_layer"))
    return readers.text_layers(d, table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("job"), "text"))


@query("SELECT CAST(user_id AS VARCHAR) AS job, event_type AS code, to_json(struct_pack(job := CAST(user_id AS VARCHAR), ocr_job := 'o' || event_id, message := props)) AS cause FROM events WHERE event_type = 'error'")
def failure_reports(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'error'")
    return writers.failures(e.select(F.col("user_id").cast("string").alias("job"), F.col("event_type").alias("code"), F.concat(F.lit("o"), F.col("event_id").cast("string")).alias("ocr_job"), F.col("props").alias("message")))


@query("""WITH n AS (SELECT CAST(user_id AS VARCHAR) AS job, 'o' || (event_id // 7) AS ocr_job, event_type AS status, make_timestamp(epoch_us(ts) // 1000 * 1000) AS since FROM events WHERE value >= 3), c AS (SELECT CAST(user_id AS VARCHAR) AS job, arg_max('o' || (event_id // 7), event_id) AS ocr_job, 'k' || user_id AS task_token FROM events GROUP BY user_id)
SELECT n.job, n.ocr_job, status, since, task_token FROM n JOIN c ON c.job = n.job AND c.ocr_job = n.ocr_job""")
def notices_of_current_jobs(spark, sf):
    """Completion messages as they come, those without an id and of superseded runs left out."""
    e = table(spark, sf, "events")
    run = F.concat(F.lit("o"), F.floor(F.col("event_id") / 7).cast("string"))
    value = F.to_json(F.struct(F.when(F.col("value") >= 3, run).otherwise("").alias("JobId"), F.col("event_type").alias("Status"), F.col("user_id").cast("string").alias("JobTag"), F.unix_millis(F.col("ts").cast("timestamp")).alias("Timestamp")))
    waiting = e.groupBy(F.col("user_id").cast("string").alias("job")).agg(F.max_by(run, "event_id").alias("current_ocr_job")).withColumn("task_token", F.concat(F.lit("k"), "job"))
    return readers.current_notices(readers.notices(e.select(value.alias("value"))), waiting).select("job", "ocr_job", "status", F.col("at").cast("timestamp_ntz").alias("since"), "task_token")


@query("SELECT doc_id, sha256('Numbered layout elements of a paper of ' || (n_chars // 2000 + 1) || ' pages; tables are in markdown.' || chr(10) || chr(10) || text) AS h FROM documents")
def structure_prompts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", sha(t.structure_prompt((F.floor(F.col("n_chars") / 2000) + 1).cast("int"), "text")).alias("h"))


@query("""WITH r AS (SELECT 'run-' || event_id AS name, props AS input, ts AS started FROM events ORDER BY ts DESC, 'run-' || event_id LIMIT 20) SELECT 'part' AS asked, name, input FROM r WHERE contains(input, '1') UNION ALL SELECT 'last', name, input FROM (SELECT * FROM r ORDER BY started DESC, name LIMIT 5)""")
def recent_executions(spark, sf):
    """The last five runs, and those of the last twenty whose input holds a text."""
    r = table(spark, sf, "events").select(F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("name"), F.col("props").alias("input"), F.col("ts").alias("started"))
    row = lambda asked, d: d.select(F.lit(asked).alias("asked"), "name", "input")
    return row("part", jobs.executions(r, "1")).union(row("last", jobs.executions(r)))


@query("""SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS value FROM events UNION ALL SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN -1 ELSE value END FROM events""")
def written_back(spark, sf):
    """Tables written whole, then one partition overwritten, and read back: as JSON, and as Parquet."""
    e = table(spark, sf, "events").select("event_id", "value", "event_type")
    out = _folder(spark, "written")
    for write, path, kind, value in ((writers.overwrite_json, f"{out}/json", "error", 0.0), (writers.overwrite_parquet, f"{out}/parquet", "view", -1.0)):
        write(e, path, "event_type")
        write(e.where(F.col("event_type") == kind).withColumn("value", F.lit(value)), path, "event_type")
    cols = ("event_id", "event_type", "value")
    return spark.read.schema("event_id long, value double, event_type string").json(f"{out}/json").select(*cols).union(spark.read.parquet(f"{out}/parquet").select(*cols))


@query("""SELECT path FROM (SELECT CASE WHEN event_type = 'view' THEN 'uploads/' WHEN event_type = 'click' THEN 'outputs/work/' ELSE 'work/' END || event_id || '/x' AS path, ts FROM events) WHERE (path LIKE 'work/%' OR path LIKE '%/work/%') AND ts < TIMESTAMP '2024-02-14' - INTERVAL 30 DAY""")
def expired_work(spark, sf):
    folder = F.when(F.col("event_type") == "view", "uploads/").when(F.col("event_type") == "click", "outputs/work/").otherwise("work/")
    files = table(spark, sf, "events").select(F.concat(folder, F.col("event_id").cast("string"), F.lit("/x")).alias("path"), F.col("ts").cast("timestamp").alias("modificationTime"))
    return writers.expired(files, "2024-02-14").select("path")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'rejects' ELSE 'ready' END AS sink FROM events WHERE event_type <> 'view'")
def fanned_out(spark, sf):
    """Rows of a stream sent to the folder of their decision; a decision without a folder goes nowhere."""
    out = _folder(spark, "fan")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf)
    decided = stream.select("event_id", F.when(F.col("event_type") == "error", "REJECTED").when(F.col("event_type") == "view", "IGNORED").otherwise("PROCEED").alias("decision"))
    sinks = {"REJECTED": f"{out}/rejects", "PROCEED": f"{out}/ready"}
    flows.run_once(decided.writeStream.foreachBatch(flows.fan_out(sinks)), f"{out}/state")
    read = lambda name: spark.read.parquet(f"{out}/{name}/batch=*").select("event_id", F.lit(name).alias("sink"))
    return read("rejects").union(read("ready"))


@query("""WITH f AS (SELECT user_id, event_id % 300 AS n, event_id, CASE WHEN event_type = 'error' THEN 'page.png' WHEN value < 50 THEN 'page-' || (event_id % 300) || '.png' ELSE 'page-' || lpad(CAST(event_id % 300 AS VARCHAR), 4, '0') || '.png' END AS name FROM events)
SELECT user_id, string_agg(name, ',' ORDER BY name = 'page.png', CASE WHEN name <> 'page.png' THEN n END, name) AS names FROM f GROUP BY user_id""")
def pages_in_order(spark, sf):
    """File names of pages, padded or not, by page."""
    n = F.col("event_id") % 300
    name = F.when(F.col("event_type") == "error", "page.png").when(F.col("value") < 50, F.concat(F.lit("page-"), n.cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("page-"), F.lpad(n.cast("string"), 4, "0"), F.lit(".png")))
    return table(spark, sf, "events").groupBy("user_id").agg(F.collect_list(name).alias("names")).select("user_id", F.array_join(t.in_page_order("names"), ",").alias("names"))


@query("SELECT user_id, round(coalesce(avg(value) FILTER (WHERE event_type = 'error' AND value >= 60), 0), 6) AS mean FROM events GROUP BY user_id")
def mean_or_zero(spark, sf):
    values = F.collect_list(F.when((F.col("event_type") == "error") & (F.col("value") >= 60), F.col("value")))
    return table(spark, sf, "events").groupBy("user_id").agg(values.alias("v")).select("user_id", F.round(scalars.mean_or_zero("v"), 6).alias("mean"))


# --- single rules, on values made of the events' columns --------------------------------------------------------

_RULES = {
    "status": "CASE event_type WHEN 'view' THEN 'SUCCEEDED' WHEN 'click' THEN 'PARTIAL_SUCCESS' ELSE upper(event_type) END",
    "lang": "CASE WHEN value < 50 THEN 'ja' ELSE event_type END",
    "kind": "CASE event_type WHEN 'error' THEN 'ThrottlingException' WHEN 'view' THEN 'NoSuchKey' WHEN 'click' THEN 'InvalidJSON' WHEN 'signup' THEN CASE WHEN value < 60 THEN 'ModelTimeout' ELSE 'ModelBroken' END ELSE props END",
    "bucket": "CASE WHEN value < 20 THEN '' ELSE 'b' || user_id END",
    "key": "CASE event_type WHEN 'view' THEN 'uploads/' || user_id || '/original.pdf' WHEN 'click' THEN 'x/uploads/' || user_id || '/original.pdf' WHEN 'error' THEN 'uploads/' || user_id || '/sub/original.pdf' WHEN 'signup' THEN '' ELSE 'work/' || user_id || '/original.pdf' END",
    "env": "CASE event_type WHEN 'view' THEN ' dev ' WHEN 'click' THEN 'prd' ELSE event_type END",
    "region": "CASE WHEN value < 30 THEN '  ' ELSE props END",
    "tab": "CASE WHEN value <= 100 THEN 't' END",
    "model": "CASE WHEN value < 10 THEN '' ELSE 'm' END",
    "messages": "CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'a|' || props || ';b' WHEN 'error' THEN user_id || '|;b' ELSE props END",
    "http": "CAST(user_id * 3 AS INT)",
    "block": "CASE event_type WHEN 'view' THEN 'LAYOUT_TEXT' WHEN 'click' THEN 'LINE' WHEN 'error' THEN 'LAYOUT_LIST' ELSE 'LAYOUT_TITLE' END",
    "table_id": "CASE WHEN value < 50 THEN '' WHEN value >= 90 THEN 't' END",
    "detail": "CASE WHEN value < 50 THEN '' ELSE props END",
    "version": "CASE WHEN value < 50 THEN 'v' || user_id END",
    "n": "CAST(floor(value) AS INT)",
    "lo": "CASE WHEN event_type = 'view' THEN 0 ELSE 20 END",
    "hi": "CASE WHEN event_type = 'click' THEN 0 ELSE 60 END",
}


def _inputs(spellings: dict[str, str]) -> str:
    return f"WITH e AS (SELECT event_id, user_id, event_type, value, props, ts, {', '.join(f'{v} AS {k}' for k, v in spellings.items())} FROM events)"


def _given(spark, sf, spellings: dict[str, str]) -> DataFrame:
    return table(spark, sf, "events").select("*", *[F.expr(v).alias(k) for k, v in spellings.items()])


@query(_inputs(_RULES) + r""" SELECT event_id, status IN ('SUCCEEDED', 'PARTIAL_SUCCESS') AS succeeded, lang = 'ja' AS ja,
CASE WHEN kind IN ('ThrottlingException', 'ServiceUnavailable', 'InternalServerError', 'ModelNotReady', 'ModelTimeout', 'ProvisionedThroughputExceeded', 'LimitExceeded') THEN 'transient' WHEN kind IN ('NoSuchKey', 'NotFound', 'TaskTimedOut', 'TaskDoesNotExist', 'InvalidToken') THEN 'gone' WHEN kind IN ('InvalidJSON', 'OutputTruncated') THEN 'undecodable' ELSE 'permanent' END AS kind,
bucket <> '' AND key <> '' AS located, array_to_string(list_filter([CASE WHEN trim(env) NOT IN ('dev', 'stg', 'prd') THEN 'unknown environment' END, CASE WHEN trim(region) = '' THEN 'region missing' END, CASE WHEN trim(bucket) = '' THEN 'bucket missing' END, CASE WHEN trim(coalesce(tab, '')) = '' THEN 'table missing' END], lambda x: x IS NOT NULL), ',') AS settings,
CASE WHEN model = '' THEN 'model id missing' WHEN messages = '' THEN 'no messages' WHEN list_contains(flatten(list_transform(string_split(messages, ';'), lambda x: string_split(x, '|'))), '') THEN 'empty part' END AS request,
http // 100 = 2 AS ok, block IN ('LAYOUT_TEXT', 'LAYOUT_LIST', 'LINE') AND coalesce(table_id, '') = '' AS body, concat_ws(': ', event_type, nullif(detail, '')) AS reason, regexp_replace(block, '^LAYOUT_', '') AS tag, printf('page-%04d.png', user_id * 37) AS file, user_id || coalesce(version, '') AS versioned,
(lo <= 0 OR n >= lo) AND (hi <= 0 OR n <= hi) AS known, nullif(regexp_extract(key, '(?:^|/)uploads/([^/]+)/original\.pdf$', 1), '') AS job, 'refs[' || event_id || '].' || event_type AS path FROM e""")
def rule_matrix(spark, sf):
    """Predicates and labels on values made of the events' columns."""
    messages = F.when(F.col("messages") == "", F.array().cast("array<array<string>>")).otherwise(F.transform(F.split("messages", ";"), lambda x: F.split(x, r"\|")))
    return _given(spark, sf, _RULES).select(
        "event_id", checks.succeeded("status").alias("succeeded"), checks.skip_layout_route("lang").alias("ja"), checks.error_class("kind").alias("kind"), checks.valid_location("bucket", "key").alias("located"),
        F.array_join(checks.settings_problems("env", "region", "bucket", "tab"), ",").alias("settings"), checks.request_problem("model", messages).alias("request"), checks.http_ok("http").alias("ok"), checks.is_body("block", "table_id").alias("body"),
        t.reason("event_type", "detail").alias("reason"), t.layout_tag("block").alias("tag"), t.page_file_name((F.col("user_id") * 37).cast("int")).alias("file"), t.versioned_id(F.col("user_id").cast("string"), "version").alias("versioned"),
        checks.in_range("n", "lo", "hi").alias("known"), checks.job_id_of("key").alias("job"), F.concat(scalars.item_path("refs", F.col("event_id"), ""), "event_type").alias("path"),
    )


_VALUES = {
    "list": "CASE event_type WHEN 'view' THEN NULL ELSE value END",
    "notice": "'{\"JobId\": \"' || CASE WHEN value < 30 THEN '' ELSE 'J' || event_id END || '\", \"Status\": \"' || event_type || '\"}'",
    "sources": "CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'aws:sns' WHEN 'error' THEN 'aws:sns,aws:sns' WHEN 'signup' THEN 'aws:sns,aws:s3' ELSE props END",
    "text1": "CASE WHEN event_type IN ('view', 'click') THEN props ELSE '' END",
    "text2": "CASE WHEN value < 50 THEN 'y' || user_id END",
    "tool1": "CASE WHEN event_type = 'click' THEN props END",
    "tool2": "CASE WHEN value > 90 THEN 'z' || user_id ELSE '' END",
    "stop": "CASE WHEN value < 15 THEN 'max_tokens' ELSE 'end' END",
    "tool": "CASE event_type WHEN 'view' THEN props WHEN 'click' THEN '{\"k\"' || user_id ELSE '' END",
    "said": "CASE event_type WHEN 'error' THEN 'so ' || props || ' it is' ELSE 'nothing' END",
    "info": "'Title: ' || event_type || chr(10) || CASE event_type WHEN 'error' THEN 'Page: 3' WHEN 'click' THEN 'Pages: many' ELSE 'Pages: ' || user_id END || chr(10) || 'Encrypted: ' || CASE WHEN value < 40 THEN 'yes (print:no)' ELSE 'no' END",
    "body": "CASE event_type WHEN 'view' THEN '%PDF-1.7' || props WHEN 'click' THEN props || '%PDF-1.4' WHEN 'signup' THEN repeat('x', 1100) || '%PDF-1.4' ELSE props END",
    "doi": "CASE WHEN value < 50 THEN ' 10.1/' || user_id || ' ' ELSE '  ' END",
}


@query(_inputs(_VALUES) + r""", p AS (SELECT *, coalesce(nullif(tool, ''), nullif(regexp_extract(said, '\{.*\}'), '')) AS payload, concat(text1, text2) AS texts, coalesce(nullif(tool1, ''), nullif(tool2, '')) AS tools, regexp_extract(info, 'Pages: (.*)', 1) AS pages FROM e),
a AS (SELECT *, CASE WHEN stop = 'max_tokens' THEN 'truncated' WHEN payload IS NULL THEN 'no json' WHEN NOT json_valid(payload) THEN 'invalid json' END AS answer FROM p)
SELECT event_id, round(value / 3, 4) AS r4, round(value / 3, 6) AS r6, round(CAST(user_id % 100 AS DOUBLE) / 100, 6) AS confidence, CAST(greatest(user_id - 20, 1) AS INT) AS page, round(CASE WHEN list IS NULL THEN value / 2 ELSE (value / 2 + list) / 2 END, 4) AS mean, CAST(floor(value) AS BIGINT) AS elapsed, epoch_us(ts) // 1000 AS ms,
CAST(CASE WHEN list IS NULL THEN 0 ELSE 1 END AS INT) AS filled, CASE WHEN list >= 50 THEN list END AS there, nullif(json_extract_string(notice, '$.JobId'), '') AS notice, len(list_filter(string_split(sources, ','), lambda x: x <> 'aws:sns')) = 0 AS records, texts AS text, tools AS tool, CASE WHEN texts = '' AND tools IS NULL THEN 'empty' END AS problem,
answer, CASE WHEN answer IS NULL THEN CAST(json_extract(payload, '$.k') AS INT) END AS got, TRY_CAST(nullif(pages, '') AS INT) AS pdf_pages, value < 40 AS locked, CASE WHEN pages = '' THEN 'DAMAGED' WHEN TRY_CAST(pages AS INT) IS NULL THEN 'MALFORMED' END AS pdf_problem,
contains(left(body, 1024), '%PDF-') AS mark, starts_with(body, '%PDF-') AS head, nullif(trim(doi), '') AS doi FROM a""")
def value_matrix(spark, sf):
    """Numbers, times, notices and answers made of the events' columns."""
    v, i = F.col("value"), F.col("user_id")
    one = F.when(F.col("list").isNotNull(), F.array("list"))
    start = F.col("ts").cast("timestamp")
    records = F.transform(F.filter(F.split("sources", ","), lambda x: x != ""), lambda x: F.struct(x.alias("EventSource")))
    part = lambda a, b: F.struct(F.col(a).alias("text"), F.col(b).alias("tool_input"))
    response = scalars.model_response(F.array(part("text1", "tool1"), part("text2", "tool2")))
    answer, info, body = F.col("answer"), F.col("pdf"), F.col("body").cast("binary")
    ref = scalars.clean_reference(F.struct(F.lit(" r ").alias("raw"), F.lit("").alias("title"), F.lit(None).cast("array<string>").alias("authors"), F.lit(None).cast("int").alias("year"), F.lit("").alias("venue"), F.col("doi")))
    return _given(spark, sf, _VALUES).withColumns({"answer": scalars.decode_answer("stop", "tool", "said", "k INT"), "pdf": checks.pdf_info("info")}).select(
        "event_id", scalars.round4(v / 3).alias("r4"), scalars.round6(v / 3).alias("r6"), scalars.confidence(i % 100).alias("confidence"), scalars.page_or_first((i - 20).cast("int")).alias("page"), scalars.mean_of(v / 2, F.col("list")).alias("mean"),
        scalars.elapsed_ms(start, start + F.make_dt_interval(secs=F.floor(v) / 1000)).alias("elapsed"), F.unix_millis(scalars.epoch_ms(F.unix_millis(start))).alias("ms"), F.size(scalars.or_empty(one, "array<double>")).alias("filled"), F.get(scalars.null_if_empty(F.filter(one, lambda x: x >= 50)), F.lit(0)).alias("there"),
        scalars.completion_notice("notice").getField("JobId").alias("notice"), scalars.is_notice_event(records).alias("records"), response.getField("text").alias("text"), response.getField("tool_input").alias("tool"), response.getField("problem").alias("problem"),
        answer.getField("problem").alias("answer"), answer.getField("value").getField("k").alias("got"), info.getField("pages").alias("pdf_pages"), info.getField("encrypted").alias("locked"), info.getField("problem").alias("pdf_problem"), checks.looks_like_pdf(body).alias("mark"), checks.starts_like_pdf(body).alias("head"), ref.getField("doi").alias("doi"),
    )
