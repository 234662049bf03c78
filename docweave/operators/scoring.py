"""How much of a value's wording occurs in a document's text.

The text is tokenised as it is and with words broken at line ends made whole; pairs of neighbouring tokens are
taken within each variant, never across.  Values are scored by the share of their own pairs that occur.  For
one document a row's arrays are compared in place; for many values of many documents the pairs are exploded
and counted with a left semi join, which shuffles pairs and never a document's text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..workers import written

HALLUCINATION_BELOW, REVIEW_BELOW, TITLE_FROM = 0.5, 0.7, 0.7
#: Characters of the values that one automaton looks for.
NEEDLE_CHARS = 1 << 20


def vocabulary(text) -> tuple[Column, Column]:
    """(tokens, pairs) of a text: both variants, distinct."""
    plain, whole = t.tokenize(text), t.tokenize(t.dehyphenate(text))
    return F.array_union(plain, whole), F.array_union(t.token_pairs(plain), t.token_pairs(whole))


def with_vocabulary(df: DataFrame, column: str, tokens: str, pairs: str) -> DataFrame:
    """Adds a text's tokens and pairs step by step, so that each text is tokenised once a variant."""
    broken = F.col(column).rlike(t.BROKEN_WORD)
    df = df.withColumns({"_plain": t.tokenize(column), "_whole": F.when(broken, t.tokenize(t.dehyphenate(column)))})
    both = lambda f: F.when(F.col("_whole").isNull(), F.array_distinct(f("_plain"))).otherwise(F.array_union(f("_plain"), f("_whole")))
    return df.withColumns({tokens: both(F.col), pairs: both(t.token_pairs)}).drop("_plain", "_whole")


def coverage(value, tokens, pairs) -> Column:
    """Share of a value's distinct pairs that occur; one token counts by itself; NULL without tokens."""
    return tokens_coverage(t.tokenize(value), tokens, pairs)


def tokens_coverage(own, tokens, pairs) -> Column:
    """The same for a value's tokens."""
    mine = F.array_distinct(t.token_pairs(own))
    return (
        F.when(F.size(own) == 0, F.lit(None).cast("double"))
        .when(F.size(own) == 1, F.array_contains(tokens, F.get(own, F.lit(0))).cast("double"))
        .otherwise(F.size(F.array_intersect(mine, pairs)) / F.greatest(F.size(mine), F.lit(1)))
    )


def contains(folded_text, folded_value) -> Column:
    return (folded_value != "") & F.contains(folded_text, folded_value)


def is_hallucination(score, short) -> Column:
    return F.coalesce(short & (score < HALLUCINATION_BELOW), F.lit(False))


def score_values(values: DataFrame, layers: DataFrame) -> DataFrame:
    """Adds ``score`` to rows (job, value, short, ...) from the text layer (job, text) of their document.

    Short values that stand in the text as they are score 1.  Only for the others the vocabulary of their document's layer is
    made, once a document, and joined; rows of documents without a layer keep a NULL score.
    """
    layers = layers.select("job", "text", F.md5("text").alias("_layer")).where(F.col("text").rlike(r"[\p{L}\p{Nd}]"))
    found = values.withColumn("_needle", t.fold("value")).join(layers.select("job", "_layer", t.fold("text").alias("_folded")), "job", "left")
    there = F.coalesce(F.col("short") & contains(F.col("_folded"), F.col("_needle")), F.lit(False))
    found = found.withColumn("_there", F.when(F.col("_folded").isNotNull(), there)).drop("_folded", "_needle")
    asked = layers.join(found.where("NOT _there").select("job"), "job", "left_semi").dropDuplicates(["job", "_layer"])
    known = with_vocabulary(asked, "text", "_tokens", "_pairs").drop("text")
    found = found.withColumn("_own", F.when(~F.col("_there"), t.tokenize("value")))
    covered = tokens_coverage(F.col("_own"), F.col("_tokens"), F.col("_pairs"))
    score = F.when(F.col("_there"), 1.0).when(~F.col("_there"), covered)
    return found.join(known, ["job", "_layer"], "left").withColumn("score", score).select("job", *[c for c in values.columns if c != "job"], "score")


def tokenized_values(values: Column) -> Column:
    """array of values (value, short, ...) with their tokens, distinct pairs and folded text."""
    own = F.transform(values, lambda v: F.struct(v.alias("v"), t.tokenize(v.getField("value")).alias("tokens"), t.fold(v.getField("value")).alias("folded")))
    return F.transform(own, lambda x: F.struct(x.getField("v").alias("v"), x.getField("tokens").alias("tokens"), F.array_distinct(t.token_pairs(x.getField("tokens"))).alias("pairs"), x.getField("folded").alias("folded")))


def scored_values(tokenized: Column, folded_text: Column, tokens: Column, pairs: Column) -> Column:
    """The values with ``score``, as :func:`score_values` gives it, from the vocabulary beside them in the row."""

    def one(x: Column) -> Column:
        n = F.size(x.getField("tokens"))
        share = F.size(F.array_intersect(x.getField("pairs"), pairs)) / F.greatest(F.size(x.getField("pairs")), F.lit(1))
        covered = F.when(n == 1, F.array_contains(tokens, F.get(x.getField("tokens"), F.lit(0))).cast("double")).when(n > 1, share)
        score = F.when(x.getField("v").getField("short") & contains(folded_text, x.getField("folded")), 1.0).otherwise(covered)
        return F.struct(*[x.getField("v").getField(f).alias(f) for f in ("field", "ord", "path", "value", "short", "grp")], score.alias("score"))

    return F.transform(tokenized, one)


def pair_coverage(values: DataFrame, texts: DataFrame) -> DataFrame:
    """(value_id, text_id, hits, pairs, score) for rows (value_id, value) and (text_id, text) with a pair in common.

    Pairs are exploded and met by an equi-join with counts added up before and after the shuffle.
    """
    own = values.withColumn("w", t.tokenize("value")).select("value_id", F.array_distinct(t.token_pairs("w")).alias("p"))
    sized = own.select("value_id", F.size("p").alias("pairs"))
    mine = own.select("value_id", F.explode_outer("p").alias("pair"))
    # Outer, as else Spark asks beforehand whether a text has pairs, and makes them for that again and again.
    theirs = with_vocabulary(texts, "text", "_tokens", "_pairs").select("text_id", F.explode_outer("_pairs").alias("pair"))
    hits = theirs.join(mine, "pair").groupBy("value_id", "text_id").agg(F.count(F.lit(1)).alias("hits"))
    return hits.join(sized, "value_id").withColumn("score", F.round(F.col("hits") / F.col("pairs"), 4))


def _needle_blocks(folded: DataFrame, limit: int) -> list[DataFrame]:
    """The needles dealt by hash to so many blocks that one holds ``limit`` characters or a single needle."""
    n = max(1, -(-2 * (folded.agg(F.sum(F.length("needle"))).first()[0] or 0) // limit))
    while True:
        dealt = folded.withColumn("block", F.pmod(F.xxhash64("needle", "value_id"), F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.sum(F.length("needle")).alias("size"), F.count(F.lit(1)).alias("rows"))
        if sizes.where((F.col("size") > limit) & (F.col("rows") > 1)).isEmpty() or n > 1 << 20:
            return [dealt.where(F.col("block") == b).drop("block") for b in range(n)]
        n *= 2


def substring_matches(needles: DataFrame, texts: DataFrame, limit: int = NEEDLE_CHARS) -> DataFrame:
    """(value_id, text_id) where the folded text holds the folded value.

    The needles, a stated query set, become automata of at most ``limit`` characters each; every text runs once
    through each automaton, in Arrow batches, and finds all values it holds in time linear in its length.
    """
    folded = written(needles.select("value_id", t.fold("value").alias("needle")).where("needle <> ''").distinct())
    hay = texts.select("text_id", t.fold("text").alias("hay"))
    kinds = f"value_id {dict(needles.dtypes)['value_id']}, text_id {dict(texts.dtypes)['text_id']}"
    out = None
    for block in _needle_blocks(folded, limit):
        by_needle: dict[str, list] = {}
        for r in block.collect():  # bounded by ``limit``
            by_needle.setdefault(r["needle"], []).append(r["value_id"])
        found = hay.mapInArrow(_holding(by_needle), kinds) if by_needle else None
        out = found if out is None else out if found is None else out.unionByName(found)
    return out if out is not None else hay.sparkSession.createDataFrame([], kinds)


def _holding(by_needle: dict[str, list]):
    values = pa.array([v for ids in by_needle.values() for v in ids])  # in the needles' own type

    def run(batches):
        import ahocorasick

        automaton, at = ahocorasick.Automaton(), 0
        for needle, ids in by_needle.items():
            automaton.add_word(needle, range(at, at + len(ids)))
            at += len(ids)
        automaton.make_automaton()
        for batch in batches:
            rows, found = [], []
            for i, hay in enumerate(batch.column(1).to_pylist()):
                here = {v for _, ids in automaton.iter(hay) for v in ids} if hay else ()
                found += here
                rows += [i] * len(here)
            yield pa.RecordBatch.from_arrays([values.take(pa.array(found, pa.int64())), batch.column(0).take(pa.array(rows, pa.int64()))], names=["value_id", "text_id"])

    return run
