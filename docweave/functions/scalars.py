"""Numbers, times, arrays and JSON, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, collapse_space, equal_list, equal_text, extract_json, is_json, once, trim_space

MIN_YEAR = 1500
DEFAULT_DPI = 150


def round4(x) -> Column:
    return F.round(_col(x), 4)


def round6(x) -> Column:
    return F.round(_col(x), 6)


def bbox(left, top, width, height) -> Column:
    """[x0, y0, x1, y1] of a box; right and lower edge are added in single precision. NULL if any part is."""
    f = lambda c: _col(c).cast("float")
    edges = [f(left), f(top), f(left) + f(width), f(top) + f(height)]
    return F.when(f(left).isNotNull() & f(top).isNotNull() & f(width).isNotNull() & f(height).isNotNull(), F.array(*[round6(e.cast("double")) for e in edges]))


def box_left(b) -> Column:
    return F.when(F.size(_col(b)) == 4, F.get(_col(b), F.lit(0))).otherwise(F.lit(0.0))


def box_top(b) -> Column:
    return F.when(F.size(_col(b)) == 4, F.get(_col(b), F.lit(1))).otherwise(F.lit(0.0))


def overlap_area(a, b) -> Column:
    """Area that two boxes share; 0 when they are apart or no boxes."""
    a, b = _col(a), _col(b)
    at = lambda x, i: F.get(x, F.lit(i))
    side = lambda i: F.least(at(a, i + 2), at(b, i + 2)) - F.greatest(at(a, i), at(b, i))
    ok = (F.size(a) == 4) & (F.size(b) == 4) & (side(0) > 0) & (side(1) > 0)
    return F.when(ok, side(0) * side(1)).otherwise(F.lit(0.0))


def confidence(percent) -> Column:
    return round6(F.coalesce(_col(percent), F.lit(0)).cast("double") / 100)


def page_or_first(page) -> Column:
    return F.when(_col(page) > 0, _col(page)).otherwise(F.lit(1))


def mean_of(*signals) -> Column:
    """Mean of the signals there are, to four places; NULL if there is none."""
    there = F.array_compact(F.array(*[_col(s).cast("double") for s in signals]))
    return F.when(F.size(there) > 0, round4(F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there)))


def mean_or_zero(values) -> Column:
    """Mean of an array, 0 for an empty one."""
    a = _col(values)
    return F.when(F.coalesce(F.size(a), F.lit(0)) > 0, F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)).otherwise(F.lit(0.0))


def backoff_cap(attempt, base_ms: int = 500, cap_ms: int = 20_000) -> Column:
    """Upper bound of the wait before a retry: doubling, capped; the jitter is drawn below it."""
    return F.least(F.lit(base_ms) * F.pow(F.lit(2.0), _col(attempt) - 1), F.lit(float(cap_ms)))


def rate_interval(interval_s, limit) -> Column:
    """Seconds between requests from a rate header; 0 where it makes no sense."""
    i, n = _col(interval_s).try_cast("double"), _col(limit).try_cast("double")
    return F.when((i > 0) & (n > 0), F.try_divide(i, n)).otherwise(F.lit(0.0))


def setting_or_default(value, default: int = DEFAULT_DPI) -> Column:
    """A positive whole number, else the default."""
    n = trim_space(_col(value)).try_cast("int")
    return F.when(n > 0, n).otherwise(F.lit(default))


def year(y, as_of_year: int) -> Column:
    """A plausible year, else 0 for unset."""
    return F.when(_col(y).between(MIN_YEAR, as_of_year + 1), _col(y)).otherwise(F.lit(0))


def year_out_of_range(y, as_of_year: int) -> Column:
    return F.coalesce((_col(y) != 0) & ~_col(y).between(MIN_YEAR, as_of_year + 1), F.lit(False))


def wire_time(ts) -> Column:
    """UTC text of fixed width, so that text order is time order."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'000Z'")


def parse_wire_time(text) -> Column:
    return F.try_to_timestamp(F.regexp_replace(_col(text), r"(\.\d{6})\d*Z$", "$1Z"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))


def epoch_ms(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def elapsed_ms(start, end) -> Column:
    return F.unix_millis(_col(end)) - F.unix_millis(_col(start))


def sorted_distinct(a) -> Column:
    return F.array_sort(F.array_distinct(_col(a)))


def distinct_in_order(a) -> Column:
    return F.array_distinct(_col(a))


def or_empty(a, kind: str = "array<string>") -> Column:
    return F.coalesce(_col(a), F.array().cast(kind))


def null_if_empty(a) -> Column:
    return F.when(F.size(_col(a)) > 0, _col(a))


def value_pair(a, b) -> Column:
    return F.struct(_col(a).alias("textract"), _col(b).alias("bedrock"), equal_text(a, b).alias("equal"))


def list_pair(a, b) -> Column:
    return F.struct(or_empty(a).alias("textract"), or_empty(b).alias("bedrock"), equal_list(a, b).alias("equal"))


def count_pair(a, b) -> Column:
    return F.struct(_col(a).alias("textract"), _col(b).alias("bedrock"), (_col(a) == _col(b)).alias("equal"))


def item_path(prefix: str, i, field: str) -> Column:
    return F.format_string(f"{prefix}[%d].{field}", _col(i))


def parse_catch(raw) -> Column:
    """(error, cause) of a failure payload: an object with a non-empty string under "error", in any case."""
    fields = F.from_json(_col(raw), "map<string,variant>")
    entries = F.filter(F.map_entries(fields), lambda e: F.schema_of_variant(e.getField("value")) == "STRING")
    of = lambda key: F.element_at(F.transform(F.filter(entries, lambda e: F.lower(e.getField("key")) == key), lambda e: F.variant_get(e.getField("value"), "$", "string")), -1)
    pick = lambda key: F.when(F.size(F.filter(entries, lambda e: F.lower(e.getField("key")) == key)) > 0, of(key)).otherwise(F.lit(""))
    return F.when(F.coalesce(pick("error"), F.lit("")) != "", F.struct(pick("error").alias("error"), pick("cause").alias("cause")))


def decode_answer(stop_reason, tool_input, text, ddl: str) -> Column:
    """(value, problem) of a model's answer: a truncated one is a problem first, then its tool input, then text."""
    def of(payload: Column) -> Column:
        problem = F.when(_col(stop_reason) == "max_tokens", "truncated").when(payload.isNull(), "no json").when(~is_json(payload), "invalid json")
        return once(problem, lambda p: F.struct(F.when(p.isNull(), F.from_json(payload, ddl)).alias("value"), p.alias("problem")))

    return once(F.coalesce(F.nullif(_col(tool_input), F.lit("")), extract_json(text)), of)


def completion_notice(raw) -> Column:
    """A completion message; NULL without a job id."""
    notice = F.from_json(_col(raw), "JobId STRING, Status STRING, API STRING, JobTag STRING, Timestamp BIGINT")
    return once(notice, lambda n: F.when(F.coalesce(n.getField("JobId"), F.lit("")) != "", n))


def is_notice_event(records) -> Column:
    """Whether an event's records all come from the notification service, and there is one."""
    r = _col(records)
    return F.coalesce((F.size(r) > 0) & F.forall(r, lambda x: F.coalesce(x.getField("EventSource") == "aws:sns", F.lit(False))), F.lit(False))


def model_response(parts) -> Column:
    """(text, tool_input, problem) of content parts (text, tool_input): texts in a row, the first tool input."""
    texts = F.transform(_col(parts), lambda p: p.getField("text"))
    tools = F.filter(F.transform(_col(parts), lambda p: p.getField("tool_input")), lambda x: F.coalesce(x, F.lit("")) != "")
    text, tool = F.array_join(texts, ""), F.get(tools, F.lit(0))
    return F.struct(text.alias("text"), tool.alias("tool_input"), F.when((text == "") & tool.isNull(), "empty").alias("problem"))


def clean_reference(r) -> Column:
    """A page's reference with trimmed fields; a blank DOI is NULL."""
    r = _col(r)
    f = r.getField
    return F.struct(trim_space(f("raw")).alias("raw"), trim_space(f("title")).alias("title"), f("authors").alias("authors"), F.coalesce(f("year"), F.lit(0)).alias("year"), trim_space(f("venue")).alias("venue"), F.nullif(trim_space(f("doi")), F.lit("")).alias("doi"))


def collapsed_author(a: Column) -> Column:
    return F.struct(*[F.coalesce(collapse_space(a.getField(k)), F.lit("")).alias(k) for k in ("name", "affiliation", "email")])
