"""Predicates, validation and case logic, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, once, trim_space

MAX_BYTES, MAX_PAGES, MAGIC, MAGIC_WITHIN = 500_000_000, 200, "%PDF-", 1024
FEATURES = ("TABLES", "FORMS", "QUERIES", "SIGNATURES", "LAYOUT")
BODY_TYPES = ("LAYOUT_TEXT", "LAYOUT_LIST", "LINE")


def too_large(size) -> Column:
    return F.when(_col(size) > MAX_BYTES, "TOO_LARGE")


def page_problem(pages) -> Column:
    return F.when(F.coalesce(_col(pages), F.lit(0)) < 1, "DAMAGED").when(_col(pages) > MAX_PAGES, "TOO_MANY_PAGES")


def looks_like_pdf(content) -> Column:
    """The file mark anywhere in the first kilobyte."""
    return F.locate(MAGIC, F.decode(F.substring(_col(content), 1, MAGIC_WITHIN), "ISO-8859-1")) > 0


def starts_like_pdf(content) -> Column:
    return F.decode(F.substring(_col(content), 1, len(MAGIC)), "ISO-8859-1") == MAGIC


def rejection(size, is_pdf, sha, expected_sha, encrypted, pages) -> Column:
    """The first reason against a file, cheapest check first; NULL if there is none."""
    return F.coalesce(
        too_large(size),
        F.when(~F.coalesce(_col(is_pdf), F.lit(False)), "NOT_PDF"),
        F.when(_col(sha) != _col(expected_sha), "HASH_MISMATCH"),
        F.when(_col(encrypted), "ENCRYPTED"),
        page_problem(pages),
    )


def conflict_decision(status) -> Column:
    """(decision, code) for an upload whose job exists already; NULL where that is an error."""
    s = _col(status)
    skipped = lambda code: F.struct(F.lit("SKIPPED").alias("decision"), F.lit(code).alias("code"))
    return F.when(s == "PROCESSING", skipped("IN_PROGRESS")).when(s.isin("COMPLETED", "REVIEW_PENDING"), skipped("ALREADY_PROCESSED"))


def in_range(n, lo, hi) -> Column:
    n, lo, hi = _col(n), _col(lo), _col(hi)
    return ((lo <= 0) | (n >= lo)) & ((hi <= 0) | (n <= hi))


def valid_status(status) -> Column:
    return F.coalesce(_col(status).isin("PROCESSING", "COMPLETED", "REVIEW_PENDING", "FAILED"), F.lit(False))


def reprocessable(status) -> Column:
    return F.coalesce(_col(status) == "FAILED", F.lit(False))


def valid_environment(name) -> Column:
    return F.coalesce(_col(name).isin("dev", "stg", "prd"), F.lit(False))


def features_problem(features) -> Column:
    f = _col(features)
    known = F.array(*map(F.lit, FEATURES))
    return F.when(F.size(f) < 1, "empty").when(F.size(F.array_except(f, known)) > 0, "unknown").when(F.size(F.array_distinct(f)) < F.size(f), "repeated")


def features_setting_problem(spec) -> Column:
    """The same for a setting "A, B": a text without any feature is an error too."""
    from .text import split_features

    return features_problem(split_features(F.coalesce(_col(spec), F.lit(""))))


def start_problem(bucket, key, features, topic, role) -> Column:
    """Why a request to start an analysis is malformed: its location, its features, or a notification topic without
    the role that may publish to it, or the other way round."""
    told = lambda c: F.coalesce(_col(c), F.lit("")) != ""
    return F.when(~valid_location(bucket, key), "location missing").when(features_problem(features).isNotNull(), F.concat(F.lit("features "), features_problem(features))).when(told(topic) != told(role), "notification incomplete")


def succeeded(status) -> Column:
    return F.coalesce(_col(status).isin("SUCCEEDED", "PARTIAL_SUCCESS"), F.lit(False))


def is_body(block_type, table_id) -> Column:
    return _col(block_type).isin(*BODY_TYPES) & (F.coalesce(_col(table_id), F.lit("")) == "")


def skip_layout_route(language) -> Column:
    return F.coalesce(_col(language) == "ja", F.lit(False))


def error_class(kind) -> Column:
    """transient, gone, undecodable or permanent."""
    k = _col(kind)
    return (
        F.when(k.isin("ThrottlingException", "ServiceUnavailable", "InternalServerError", "ModelNotReady", "ModelTimeout", "ProvisionedThroughputExceeded", "LimitExceeded"), "transient")
        .when(k.isin("NoSuchKey", "NotFound", "TaskTimedOut", "TaskDoesNotExist", "InvalidToken"), "gone")
        .when(k.isin("InvalidJSON", "OutputTruncated"), "undecodable")
        .otherwise("permanent")
    )


def pdf_error(stderr) -> Column:
    low = F.lower(_col(stderr))
    has = lambda *xs: F.coalesce(low.rlike("|".join(xs)), F.lit(False))
    return F.when(has("incorrect password", "encrypted"), "ENCRYPTED").when(has("may not be a pdf", "couldn't read", "damaged"), "DAMAGED")


def pdf_info(text) -> Column:
    """(pages, encrypted, problem) of "key: value" lines."""
    blank = r"[\s&&[^\n]]*"
    found = lambda key: F.regexp_extract_all(_col(text), F.lit(rf"(?Udm)^{blank}{key}{blank}:{blank}(\S.*\S|\S|){blank}$"), F.lit(1))

    def of(x: Column) -> Column:
        last = lambda key: F.try_element_at(x.getField(key), F.lit(-1))
        pages = F.when(last("Pages").rlike("[0-9]"), last("Pages").try_cast("int"))  # a cast that fails is dear
        locked = F.coalesce(~F.lower(last("Encrypted")).startswith("no"), F.lit(False))
        return F.struct(pages.alias("pages"), locked.alias("encrypted"), F.when(F.size(x.getField("Pages")) == 0, "DAMAGED").when(pages.isNull(), "MALFORMED").alias("problem"))

    return once(F.struct(*[found(k).alias(k) for k in ("Pages", "Encrypted")]), of)


def licence_kind(url) -> Column:
    u = F.lower(F.coalesce(_col(url), F.lit("")))
    return F.when(u.contains("creativecommons"), "cc").when((u == "") | u.contains("arxiv"), "arxiv").otherwise("unknown")


def has_source(content_type) -> Column:
    return F.coalesce(F.lower(_col(content_type)).rlike("x-eprint|gzip|tar"), F.lit(False))


def valid_location(bucket, key) -> Column:
    return (F.coalesce(_col(bucket), F.lit("")) != "") & (F.coalesce(_col(key), F.lit("")) != "")


def settings_problems(env, region, bucket, table) -> Column:
    """All that is wrong with some settings, not only the first."""
    blank = lambda c: trim_space(F.coalesce(_col(c), F.lit(""))) == ""
    checks = [
        F.when(~valid_environment(trim_space(_col(env))), "unknown environment"),
        F.when(blank(region), "region missing"),
        F.when(blank(bucket), "bucket missing"),
        F.when(blank(table), "table missing"),
    ]
    return F.array_compact(F.array(*checks))


def request_problem(model_id, messages) -> Column:
    """Why a model request is malformed; messages are arrays of parts."""
    m = _col(messages)
    return (
        F.when(F.coalesce(_col(model_id), F.lit("")) == "", "model id missing")
        .when(F.coalesce(F.size(m), F.lit(0)) < 1, "no messages")
        .when(F.exists(m, lambda parts: (F.size(parts) < 1) | F.exists(parts, lambda p: F.coalesce(p, F.lit("")) == "")), "empty part")
    )


def job_id_of(key) -> Column:
    """The job of an upload key; NULL for any other key."""
    form = r"(?:^|/)uploads/([^/]+)/original\.pdf$"
    return F.nullif(F.regexp_extract(_col(key), form, 1), F.lit(""))


def http_ok(status) -> Column:
    return F.floor(_col(status) / 100) == 2
