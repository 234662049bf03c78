"""Cases of the single functions: each row is an input and what must come out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docweave.functions import checks, scalars
from docweave.functions import text as t
from docweave.operators import scoring
from docweave.plans import records


def column(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


CASES = [
    (t.fold, ["rain-\nfall", "“c” — d", "–—!", "ﬁsh ﬂag", "ΛΟΓΟΣ"], ["rainfall", "cd", "", "fishflag", "λογοσ"]),
    (t.tokenize, ["Warm Harbour-Lights 9B", "天気予報", "川", "", "天気 a川"], [["warm", "harbour", "lights", "9b"], ["天気", "気予", "予報"], ["川"], [], ["天気", "a", "川"]]),
    (t.collapse_space, ["  a \n b ", "漢字\nかな", "a\r\nb", "a　b", "漢\nb"], ["a b", "漢字かな", "a b", "a b", "漢 b"]),
    (t.normalize_text, ["a \r\nb\rc  ", "  a  b \n  c"], ["a\nb\nc", "a  b\n  c"]),
    (t.reference_title, ["A title.", "A title .", "And so on...", ".", "none"], ["A title", "A title", "And so on...", "", "none"]),
    (t.doi, ["HTTPS://DOI.ORG/10.1000/ABC", "DOI: HTTPS://DOI.ORG/10.1000/XYZ123", " ", "arXiv:2309.17453", "10.1000", "https://doi.org/", "10.1000/xyz 123"], ["10.1000/abc", "10.1000/xyz123", None, None, None, None, None]),
    (t.doi_malformed, [" ", "arXiv:2309.17453", "10.1000/a", None], [False, True, False, False]),
    (lambda c: t.detect_language(c), ["あ" * 20 + "a" * 180, "あ" * 19 + "a" * 181, "あ" * 99], [("ja", True), ("en", True), ("en", False)]),
    (t.japanese_letters, ["論文 PDF の構造化", "ーー。"], [6, 0]),
    (t.latin_letters, ["論文 PDF の構造化", "12"], [3, 0]),
    (t.count_references, ["[1] a\n [12] b\nx [99]\n[10000] c", "none"], [12, 0]),
    (t.dehyphenate, ["rain-\nfall", "snow­\n drift"], ["rainfall", "snowdrift"]),
    (t.extract_json, ['```json\n{"a": 1}\n```', 'x {"a": [1]} y', "no", "[1,2] z"], ['{"a": 1}', '{"a": [1]}', None, "[1,2]"]),
    (t.record_name, ["https://api.x.org/works/10.1?a=b c", "x"], ["works_10.1_a_b_c.json", "x.json"]),
    (t.paper_id, ["arXiv:2309.17453v2", " 2309.1745 ", "cs/0101"], [("2309.17453", "v2"), ("2309.1745", ""), None]),
    (t.split_features, ["TABLES, ,FORMS"], [["TABLES", "FORMS"]]),
    (t.layout_tag, ["LAYOUT_TEXT", "LINE"], ["TEXT", "LINE"]),
    (t.page_number, ["p/page-0012.png", "x-007.png", "x"], [12, 7, None]),
    (checks.job_id_of, ["s3://b/uploads/abc/original.pdf", "uploads//original.pdf", "uploads/a/b/original.pdf", "uploads/a/other.pdf"], ["abc", None, None, None]),
    (checks.licence_kind, ["http://CreativeCommons.org/x", "", None, "http://arxiv.org/l", "http://z"], ["cc", "arxiv", "arxiv", "arxiv", "unknown"]),
    (checks.has_source, ["application/x-eprint-tar", "application/GZIP", "application/pdf", None], [True, True, False, False]),
    (checks.pdf_error, ["Command Line Error: Incorrect password", "May not be a PDF file", "x"], ["ENCRYPTED", "DAMAGED", None]),
    (checks.pdf_info, ["Title: x\nPages:  12\nEncrypted: no\n", "Pages: 3\nEncrypted: yes (print:no)", "Title: a", "Pages: x"], [(12, False, None), (3, True, None), (None, False, "DAMAGED"), (None, False, "MALFORMED")]),
    (scalars.parse_catch, ['{"Error":"E","Cause":"c"}', '{"error":"E"}', '["a"]', "null", '{"Error":""}', '{"Error":1}', "garbage"], [("E", "c"), ("E", ""), None, None, None, None, None]),
    (scalars.setting_or_default, ["200", " 72 ", "0", "-1", "x", None], [200, 72, 150, 150, 150, 150]),
    (checks.conflict_decision, ["PROCESSING", "COMPLETED", "REVIEW_PENDING", "FAILED"], [("SKIPPED", "IN_PROGRESS"), ("SKIPPED", "ALREADY_PROCESSED"), ("SKIPPED", "ALREADY_PROCESSED"), None]),
    (checks.error_class, ["ThrottlingException", "NoSuchKey", "InvalidJSON", "Other"], ["transient", "gone", "undecodable", "permanent"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(spark, case):
    fn, values, want = CASES[case]
    got = [tuple(x) if hasattr(x, "asDict") else x for x in column(spark, fn, values)]
    assert got == want


def test_heading_levels(spark):
    cases = [("5.2 Tide Tables", 1, 2), ("7. Harbours", 3, 1), ("4.1.6. Ropes", 1, 3), ("B.3 Charts", 1, 2), ("C Further Maps", 2, 1), ("III.2 Crew", 1, 2), ("VI. Storms", 2, 1), ("1987 Winter Log", 2, 2), ("2D Drawings", 2, 2), ("8.Anchors", 2, 2), ("Harbours", 0, 1), ("Older Charts", 9, 4), ("6.5.4.3.2 Deep Water", 1, 4)]
    df = spark.createDataFrame(cases, "h string, l int, want int")
    assert [r.y for r in df.select(t.clamp_level(t.heading_level("h", "l")).alias("y")).collect()] == [c[2] for c in cases]


def test_years(spark):
    values = [2017, 1500, 2027, 0, 1499, 2028, 20017, -2017]
    assert column(spark, lambda c: scalars.year(c, 2026), values, "int") == [2017, 1500, 2027, 0, 0, 0, 0, 0]
    assert column(spark, lambda c: scalars.year_out_of_range(c, 2026), values, "int") == [False] * 4 + [True] * 4


def test_fragments(spark):
    assert column(spark, t.join_fragments, [["a", "b"], ["漢", "b"], ["", "x", ""], []], "array<string>") == ["a b", "漢b", "x", ""]


def test_equality(spark):
    df = spark.createDataFrame([("A  b", "a B"), ("ΟΔΟΣ", "οδος"), ("a-b", "ab")], "a string, b string")
    assert [r.y for r in df.select(t.equal_text("a", "b").alias("y")).collect()] == [True, True, False]
    lists = spark.createDataFrame([(["A", "b"], ["a", "B"]), (["a", "b"], ["b", "a"]), ([], None)], "a array<string>, b array<string>")
    assert [r.y for r in lists.select(t.equal_list("a", "b").alias("y")).collect()] == [True, False, True]


def test_coverage(spark):
    layer = "A quiet harbour light guides fishing boats home. Storm warning flags are raised."
    cases = [("quiet harbour light guides fishing boats home", 1.0), ("warning storm", 1.0), ("flags", 1.0), ("desert", 0.0), ("—", None)]
    df = spark.createDataFrame([("j", v) for v, _ in cases], "job string, value string").withColumn("short", F.lit(False))
    got = {r.value: r.score for r in scoring.score_values(df, spark.createDataFrame([("j", layer)], "job string, text string")).collect()}
    assert got == dict(cases)


def test_boxes(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.5, 0.5], [0.25, 0.25, 1.0, 1.0]), ([0.0, 0.0, 0.1, 0.1], [0.2, 0.2, 0.3, 0.3]), (None, [0.0] * 4)], "a array<double>, b array<double>")
    assert [r.y for r in df.select(scalars.overlap_area("a", "b").alias("y")).collect()] == [0.0625, 0.0, 0.0]
    row = spark.createDataFrame([(0.1, 0.2, 0.3, 0.4, None)], "l double, t double, w double, h double, n double").select(scalars.bbox("l", "t", "w", "h").alias("b"), scalars.bbox("l", "t", "w", "n").alias("n")).first()
    assert row.b == [0.1, 0.2, 0.4, 0.6] and row.n is None


def test_rejections_in_order(spark):
    df = spark.createDataFrame([(600_000_000, False, "a", "b", True, 0), (1, False, "a", "b", True, 0), (1, True, "a", "b", True, 0), (1, True, "b", "b", True, 0), (1, True, "b", "b", False, 0), (1, True, "b", "b", False, 201), (1, True, "b", "b", False, 200)], "size long, pdf boolean, sha string, want string, enc boolean, pages int")
    got = [r.y for r in df.select(checks.rejection("size", "pdf", "sha", "want", "enc", "pages").alias("y")).collect()]
    assert got == ["TOO_LARGE", "NOT_PDF", "HASH_MISMATCH", "ENCRYPTED", "DAMAGED", "TOO_MANY_PAGES", None]


def test_misc(spark):
    one = spark.range(1)
    row = one.select(
        scalars.wire_time(F.lit(dt.datetime(2026, 1, 2, 3, 4, 5, 678901))).alias("w"), scalars.mean_of(F.lit(1.0), F.lit(None), F.lit(0.5)).alias("m"), scalars.mean_of(F.lit(None)).alias("e"), scalars.backoff_cap(F.lit(3)).alias("b"), scalars.backoff_cap(F.lit(20)).alias("c"),
        checks.features_problem(F.array(F.lit("TABLES"), F.lit("TABLES"))).alias("f"), checks.settings_problems(F.lit("x"), F.lit(" "), F.lit("b"), F.lit("t")).alias("s"), t.markdown(F.array(F.array(F.lit("a|b"))), F.array(F.array(F.lit("1"), F.lit("2")))).alias("md"),
        scalars.decode_answer(F.lit("max_tokens"), F.lit('{"a":1}'), F.lit(""), "a int").alias("d"), scalars.decode_answer(F.lit("end"), F.lit(""), F.lit('x {"a":1} y'), "a int").alias("d2"), scalars.completion_notice(F.lit('{"JobId":""}')).alias("n"),
    ).first()
    assert row.w == "2026-01-02T03:04:05.678901000Z" and row.m == 0.75 and row.e is None and row.b == 2000 and row.c == 20000 and row.f == "repeated" and row.s == ["unknown environment", "region missing"]
    assert row.md == "| a\\|b |  |\n| --- | --- |\n| 1 | 2 |\n" and row.d.problem == "truncated" and row.d2.value.a == 1 and row.n is None


def test_values_are_made_once(spark, tmp_path):
    """Answers, notices and file facts are read once a row, and texts that can be no JSON are not parsed."""
    events = spark.createDataFrame([(1, 2, "view", 1.0, "p")], "event_id long, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds(F.lit(0))).write.parquet(f"{tmp_path}/events.parquet")
    plan = records.value_matrix(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 and plan.count("regexp_extract_all") == 2

    given = ["{\"k\": 1", "{\"k\": 1}", "{\"k\": 1} x", " [1] ", "[1", "so {\"k\": 2} it", "\"a", "\"a\"", "-1", "-", "+1", "1e", "nothing", "null", "nul", "true", "falsey", "", " ", "\ufeff1", "{'k': 1}", "\n{\"k\":\n3}\n", "\xa0{\"k\": 4}", "```json\n{\"k\": 5}\n```", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string").select("i", "x", t.is_json("x").alias("quick"), F.try_parse_json("x").isNotNull().alias("whole"), t.extract_json("x").alias("cut"), scalars.decode_answer(F.lit("end"), "x", F.lit(""), "k INT").alias("a")).collect()
    assert [r.x for r in rows if r.quick != r.whole] == []
    cut = {r.x: r.cut for r in rows}
    assert cut["so {\"k\": 2} it"] == "{\"k\": 2}" and cut["{\"k\": 1} x"] == "{\"k\": 1}" and cut["-1"] == "-1" and cut["nothing"] is None and cut["[1"] is None and cut["\xa0{\"k\": 4}"] == "{\"k\": 4}" and cut["```json\n{\"k\": 5}\n```"] == "{\"k\": 5}" and cut[None] is None
    said = {r.x: (r.a.problem, r.a.value and r.a.value.k) for r in rows}
    assert said["{\"k\": 1"] == said["{'k': 1}"] == ("invalid json", None) and said["{\"k\": 1}"] == said["{\"k\": 1} x"] == (None, 1) and said[""] == said[None] == ("no json", None)


def test_file_facts_by_last_line(spark):
    cases = {
        "Pages: 3\nEncrypted: no": (3, False, None), "\xa0Pages\t:\u3000 7 \r\nEncrypted:Yes": (7, True, None), "Pages: 1\nPages: 2": (2, False, None), "Pages: many": (None, False, "MALFORMED"), "Pages:": (None, False, "MALFORMED"),
        "Pages: x1": (None, False, "MALFORMED"), "Pages: 99999999999": (None, False, "MALFORMED"), "Page: 3": (None, False, "DAMAGED"), "a Pages: 3": (None, False, "DAMAGED"), "Pages\n: 3": (None, False, "DAMAGED"), "\n\n  Pages: 4": (4, False, None), "Pages: 5\rEncrypted: yes": (None, False, "MALFORMED"),
        "Encrypted: NO\nx:Pages: 3": (None, False, "DAMAGED"), "Pages: 1:2": (None, False, "MALFORMED"), "Encrypted: \nPages: +6": (6, True, None), "": (None, False, "DAMAGED"), None: (None, False, "MALFORMED"),
    }
    rows = spark.createDataFrame([(x,) for x in cases], "x string").select("x", checks.pdf_info("x").alias("p")).collect()
    assert {r.x: tuple(r.p) for r in rows} == cases
