"""Personal data in texts by candidate gradient boosting (operator 1), with DataFrame functions only.

Four base kinds follow fixed formats and checks and always stay.  High-recall generators then propose further
spans on the text with the base spans masked out; boosted trees score each proposal by its format and the
words around it; thresholds calibrated on held-out proposals select those that become spans too.  Proposals of
an earlier generator win over overlapping ones of a later generator.  The trees are fitted when first needed,
from sentences built by rule with a fixed seed (``EXAMPLES`` of them), whose features come from the very
expressions that score documents.

All patterns are anchored at the start of a run or possessive, so that long runs of one character class cost
linear time and no regular-expression recursion.  Offsets come from running totals over matches and gaps, and
pieces are cut from chunks of ``CHUNK`` characters, so the work grows with a text's length and its number of spans,
not with their product.  Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; repeated rows give repeated rows; an empty table gives an
empty table; other columns are not read (``redact`` passes them on).
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import fit_trees, predict, score_column, threshold_for
from .common import table

LOCAL = "A-Za-z0-9._%+-"
#: Kind: pattern of a base span. A match may start inside a run only where the match before it ended (\G).
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a base kind to be searched at all.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
#: Generators of further spans, in order of precedence.
PROPOSED = {
    "obscured_email": rf"(?i)(?<![{LOCAL}])[{LOCAL}]++ ?(?:\(at\)|\[at\]|\bat\b) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\bdot\b) ?[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+",
    "number": r"(?<![0-9])[0-9](?:[ ().-]{0,3}+[0-9]){6,}+",
}
PROPOSED_NEEDS = {"obscured_email": r"(?i)\bat\b", "secret": "[0-9]", "number": "[0-9]"}
MASK = "\x01"
CONTEXT, CHUNK = 24, 1024
BLOCK = 256
#: Proposals that are none are taken to be ``ODDS`` times as common in texts as in the examples.
EXAMPLES, PRECISION, ODDS, SEED = 3000, 0.95, 10, 11


def running(values: str, step, zero: int = 0) -> Column:
    """Inclusive running values of an integer array column, in blocks: no step copies more than one block.

    Here and below an array that a lambda looks into is a column that its projection names twice: the optimiser
    would move one that is named once into the lambda, where it is worked out for every element.
    """
    append = lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x))
    over = lambda a: F.slice(F.aggregate(a, F.array(F.lit(zero)), append), 2, BLOCK + 1)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: F.slice(F.col(values), b * BLOCK + 1, BLOCK))
    offsets = F.aggregate(F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), step)), F.array(F.lit(zero)), append)
    parts = F.zip_with(blocks, offsets, lambda x, o: F.transform(F.coalesce(over(x), F.array().cast("array<int>")), lambda y: step(y, o)))
    return F.when(F.size(values) > 0, F.flatten(parts)).otherwise(F.array().cast("array<int>"))


def chunks(text: Column, needed: Column) -> Column:
    """The text in chunks of CHUNK characters, where it is needed."""
    return F.when(needed, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))


def piece(cut: Column, start: Column, length: Column) -> Column:
    """A part of a text in chunks, by code points."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((start + length) / CHUNK).cast("int")
    return F.substring(F.array_join(F.slice(cut, first + 1, last - first + 1), ""), start % CHUNK + 1, length)


def _found(df: DataFrame, text: str, kind: str, pattern: str, needs: str) -> DataFrame:
    """Adds ``m_kind``: all matches in order, as structs of text, start and end; and ``g_kind``: the gaps."""
    m, g, d = f"m_{kind}", f"g_{kind}", f"d_{kind}"
    there = F.col(text).rlike(needs)
    df = df.withColumn(m, F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(F.array(F.col(text))))
    # A match begins behind the gaps and matches before it.
    sizes = F.zip_with(F.transform(g, F.length), F.concat(F.array(F.lit(0)), F.transform(m, F.length)), lambda a, b: a + b)
    df = df.withColumn(d, F.when(F.size(m) > 0, sizes).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(d, running(d, lambda x, y: x + y))
    placed = F.zip_with(F.col(m), F.slice(d, 1, F.size(m)), lambda x, at: F.struct(x.alias("x"), at.alias("start"), (at + F.length(x)).alias("end")))
    return df.withColumn(m, placed).drop(d)


def luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its check digit."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    folded = lambda i: F.when((n - i) % 2 == 0, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + folded(i)) % 10 == 0


def _passes(kind: str, x: Column) -> Column:
    digits = F.regexp_replace(x, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(x, r"\."), lambda p: (F.length(part(p)) < 3) | (F.length(part(p)) == 3) & (part(p) <= "255"))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _masked(df: DataFrame, text: str, kind: str, passing: Column) -> DataFrame:
    """Replaces the passing matches by as many MASK characters in ``text``; needs m_kind and g_kind of that text, and
    for each match whether it passes."""
    m, g = F.col(f"m_{kind}"), F.col(f"g_{kind}")
    said = F.zip_with(m, passing, lambda b, ok: F.when(ok, F.repeat(F.lit(MASK), F.length(b.getField("x")))).otherwise(b.getField("x")))
    glued = F.array_join(F.zip_with(g, said, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return df.withColumn(text, F.when(F.exists(passing, lambda ok: ok), glued).otherwise(F.col(text)))


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds ``s_kind`` for each base kind: (start, end) of the matches that pass its check."""
    passing = lambda kind: F.filter(F.col(f"m_{kind}"), lambda s: _passes(kind, s.getField("x")))
    for kind, pattern in BASE.items():
        df = _found(df, text, kind, pattern, NEEDS[kind]).drop(f"g_{kind}")
        good = passing(kind)
        df = df.withColumn(f"s_{kind}", F.transform(good, lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end")))).drop(f"m_{kind}")
    return df


def _laid_out(df: DataFrame, text: str, spans: Column) -> DataFrame:
    """Adds ``_spans`` in order, each with ``at``, the furthest end before it, ``_cut`` (the text in chunks) and
    ``_last``, the furthest end of all."""
    df = df.withColumn("_spans", F.array_sort(spans))
    df = df.withColumns({"_cut": chunks(F.col(text), F.size("_spans") > 0), "_reach": F.transform("_spans", lambda s: s.getField("end"))})
    df = df.withColumn("_reach", running("_reach", lambda x, y: F.greatest(x, y)))
    before = F.zip_with("_spans", F.slice(F.concat(F.array(F.lit(0)), "_reach"), 1, F.size("_spans")), lambda s, at: F.struct(s.alias("s"), at.alias("at")))
    return df.withColumns({"_spans": before, "_last": F.element_at(F.concat(F.array(F.lit(0)), "_reach"), -1)}).drop("_reach")


def _replaced(text: str, said) -> Column:
    """The text with what ``said(span, furthest end before)`` gives in place of each span; spans may overlap."""

    def part(x: Column) -> Column:
        s, at = x.getField("s"), x.getField("at")
        return F.concat(piece(F.col("_cut"), at, F.greatest(s.getField("start") - at, F.lit(0))), said(s, at))

    tail = F.substring(F.col(text), F.col("_last") + 1, F.length(text))
    return F.when((F.size("_spans") > 0) & (F.size("_cut") > 0), F.concat(F.array_join(F.transform("_spans", part), ""), tail)).otherwise(F.col(text))


def _mask_base(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: the text with every character of a base span masked. Spans of different kinds may overlap."""
    df = _laid_out(df, text, F.concat(*[F.col(f"s_{k}") for k in BASE]))
    mask = lambda s, at: F.repeat(F.lit(MASK), F.greatest(s.getField("end") - F.greatest(s.getField("start"), at), F.lit(0)))
    return df.withColumn(out, _replaced(text, mask)).drop("_spans", "_cut", "_last")


def candidate_features(x: Column, before: Column, after: Column) -> list[Column]:
    """Numbers that describe a proposal's format and context."""
    n = lambda p, c=x: F.regexp_count(c, F.lit(p)).cast("double")
    has = lambda p, c: c.rlike(p).cast("double")
    digits = F.regexp_replace(x, "[^0-9]", "")
    return [
        F.length(x).cast("double"),
        n("[0-9]"),
        n("[A-Za-z]"),
        n("[A-Z]"),
        has("^[0-9a-fA-F]+$", x),
        n("[ ().-]"),
        n("[0-9]+"),
        F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False)).cast("double"),
        n("[0-9][A-Za-z]|[A-Za-z][0-9]"),
        n(r"\."),
        has(r"(?i)token|secret|api|key|passw|pwd|auth|bearer|credential", before),
        has(r"(?i)tel|phone|call|fax|mobile|whats", before),
        has(r"(?i)card|account|iban|ssn|social|passport|tax|insurance", before),
        has(r"(?i)mail|contact|write|reach", before),
        has(r"[=:][ \"']*$", before),
        has(r"^[\"']", after),
        has(r"(?i)page|isbn|version|year|order|total|price|figure|[$€£]\s*$", before),
        has(r"(?i)\(at\)|\[at\]", x),
        has(r"(?i)\(dot\)|\[dot\]|\bdot\b", x),
    ]


#: Words that stand before personal data, and before numbers and names that are none.
TELLING = {"secret": [' token = "', ' api_key="', " secret: ", " Authorization: Bearer ", " password=", ' key: "'], "number": [" phone ", " tel: ", " call ", " SSN ", " card ", " account ", " fax: ", " mobile ", " passport "], "obscured_email": [" mail ", " contact ", " reach me: ", " write to "]}
OTHER = {"secret": [" see ", " page ", " figure ", " version ", " order "], "number": [" page ", " total ", " ISBN ", " order ", " year ", " in ", " price $"], "obscured_email": [" was ", " the ", " of ", " page "]}


def _examples() -> list[tuple[str, str, str, str, int]]:
    """(kind, span, before, after, label) of sentences built by rule. Some forms are of both labels, and one in
    four stands behind a word that tells nothing, one in ten behind one that misleads: scores spread, and the
    thresholds decide."""
    rnd = random.Random(SEED)
    dig = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es"]) for _ in range(rnd.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    b64 = lambda n: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n)) + dig(1)
    at_dot = lambda: rnd.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), (" (at) ", ".")])
    forms = {
        ("secret", 1): [lambda: hexa(rnd.choice([20, 24, 32, 40, 64])), lambda: b64(rnd.choice([20, 24, 32, 40, 64])), lambda: dig(rnd.choice([16, 20]))],
        ("secret", 0): [lambda: "-".join(word() for _ in range(5)) + "-" + dig(2), lambda: "/".join(["a", word(), word(), word(), dig(4)]), lambda: word() * 4 + dig(1), lambda: "=" * 20 + dig(1), lambda: "_".join([word(), word(), word(), "v" + dig(1)]), lambda: dig(rnd.choice([16, 20])), lambda: hexa(32)],
        ("number", 1): [lambda: f"{dig(3)}-{dig(2)}-{dig(4)}", lambda: f"{dig(3)}) {dig(3)}-{dig(4)}", lambda: f"{dig(3)}-{dig(3)}-{dig(4)}", lambda: f"{dig(3)}.{dig(3)}.{dig(4)}", lambda: " ".join(dig(4) for _ in range(4)), lambda: dig(10)],
        ("number", 0): [lambda: dig(16), lambda: f"{dig(4)}-{dig(4)}", lambda: f"20{dig(2)}-{dig(2)}-{dig(2)}", lambda: f"{dig(3)}.{dig(3)}.{dig(3)}", lambda: dig(7), lambda: f"1.{dig(1)}.{dig(1)}.{dig(1)}.{dig(3)}", lambda: " ".join(dig(2) for _ in range(6)), lambda: dig(10)],
        ("obscured_email", 1): [lambda: (lambda a, d: word() + "." + word() + a + word() + d + rnd.choice(["com", "org", "net"]))(*at_dot())],
        ("obscured_email", 0): [lambda: f"{word()} at {word()}.{word().capitalize()}", lambda: f"{word()} at {word()}. {word().capitalize()}", lambda: f"{word()} at {word()} dot {word()}"],
    }
    out = []
    for _ in range(EXAMPLES):
        kind, label = rnd.choice(list(PROPOSED)), int(rnd.random() < 0.5)
        x, luck = rnd.choice(forms[kind, label])(), rnd.random()
        lead = text(3) + (" " if luck < 0.25 else rnd.choice((TELLING, OTHER)[(luck < 0.35) == bool(label)][kind]))
        tail = ('"' if lead.endswith('"') else "") + " " + text(2)
        out.append((kind, x, lead[-CONTEXT:], tail[:CONTEXT], label))
    return out


_models: dict[str, tuple] = {}


def model(spark: SparkSession) -> dict[str, tuple]:
    """Kind: (trees, logit threshold). Two thirds of the examples fit the trees, the rest calibrate."""
    if not _models:
        rows = _examples()
        df = spark.createDataFrame(rows, "kind string, x string, before string, after string, label int").coalesce(1)
        got = df.select("kind", "label", F.array(*candidate_features(F.col("x"), F.col("before"), F.col("after"))).alias("f")).collect()
        for kind in PROPOSED:
            x = np.array([r["f"] for r in got if r["kind"] == kind])
            y = np.array([r["label"] for r in got if r["kind"] == kind], float)
            third = len(y) // 3
            trees = fit_trees(x[third:], y[third:], rounds=20, depth=3)
            cut = threshold_for(predict(trees, x[:third]), y[:third], PRECISION, ODDS)
            cut = min(max(cut, 1e-6), 1 - 1e-6)
            _models[kind] = (trees, math.log(cut / (1 - cut)))
    return _models


def _featured(kind: str, cut: str) -> Column:
    """Features of each match of a generator on the masked text, whose chunks are in ``cut``."""

    def one(c: Column) -> Column:
        start = c.getField("start")
        lead = F.least(F.lit(CONTEXT), start)
        before, after = piece(F.col(cut), start - lead, lead), piece(F.col(cut), c.getField("end"), F.lit(CONTEXT))
        return F.struct(F.array(*candidate_features(c.getField("x"), before, after)).alias("f"))

    return F.transform(f"m_{kind}", one)


def all_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds ``s_kind`` for base and proposed kinds. ``text`` must be a column that is not null."""
    df = _mask_base(base_spans(df, text), text, "masked")
    fitted = model(df.sparkSession)
    for kind, pattern in PROPOSED.items():
        df = _found(df, "masked", kind, pattern, PROPOSED_NEEDS[kind])
        trees, cut = fitted[kind]
        df = df.withColumn("_cut", chunks(F.col("masked"), F.size(f"m_{kind}") > 0)).withColumn("_f", _featured(kind, "_cut"))
        df = df.withColumn("_ok", F.transform("_f", lambda c: score_column(trees, c.getField("f")) >= cut))
        spans = F.zip_with(F.col(f"m_{kind}"), F.col("_ok"), lambda s, ok: F.when(ok, F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"))))
        df = df.withColumn(f"s_{kind}", F.array_compact(spans))
        df = _masked(df, "masked", kind, F.col("_ok")).drop(f"m_{kind}", f"g_{kind}", "_cut", "_f", "_ok")
    return df.drop("masked")


def _listed(kinds) -> Column:
    def of(kind: str) -> Column:
        return F.transform(f"s_{kind}", lambda s: F.concat(F.lit(f"{kind}:"), s.getField("start").cast("string"), F.lit(":"), s.getField("end").cast("string")))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def pii_spans(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, counts of base spans, base_sha256, spans) of every row."""
    df = all_spans(docs.select(F.col(key).alias("k"), F.coalesce(F.col(column), F.lit("")).alias("t")), "t")
    counts = [F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in BASE]
    return df.select(F.col("k").alias(key), *counts, F.sha2(_listed(BASE), 256).alias("base_sha256"), _listed([*BASE, *PROPOSED]).alias("spans"))


def redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with every span of ``column`` replaced by its kind in brackets; overlapping spans become one,
    named after the first. Null texts stay null; ``n_chars``, where present, follows a text that changed."""
    df = all_spans(docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(column), F.lit("")).alias("t")), "t")
    named_as = lambda k: F.transform(f"s_{k}", lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"), F.lit(k.upper()).alias("kind")))
    named = F.concat(*map(named_as, [*BASE, *PROPOSED]))
    df = _laid_out(df.select("row", "t", named.alias("named")), "t", F.col("named"))
    said = lambda s, at: F.when(s.getField("start") < at, F.lit("")).otherwise(F.concat(F.lit("["), s.getField("kind"), F.lit("]")))
    text = F.when(F.size("_spans") > 0, _replaced("t", said)).otherwise(F.col("row").getField(column))
    fresh = {column: text}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(F.size("_spans") > 0, F.length(text).cast("long")).otherwise(F.col("row").getField("n_chars"))
    return df.select(*[fresh[c].alias(c) if c in fresh else F.col("row").getField(c).alias(c) for c in docs.columns])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))
