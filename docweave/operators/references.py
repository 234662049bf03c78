"""References checked against a table of registered works.

A DOI is looked up by an equi-join; without one the title, else the raw text, finds candidates that share
tokens, of which the best three by the sum of 1 / works with the token are compared in order.  The works table stands for the external
service; jobs or DOIs that it could not answer are listed as unavailable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..workers import written
from . import scoring

MAX_LOOKUPS, BREAKER, CANDIDATES = 100, 3, 3
#: Tokens that more works than this carry are joined salted, where a reference has none that are rare enough.
COMMON_TOKEN = 10_000
SALT = 32
MATCHED = ("similarity", "matched_doi", "matched_title")


def title_score(work_title, ref_title, ref_raw):
    """Share of a registered title's pairs in the extracted title and raw text; NULL if either is empty."""
    extracted = F.concat_ws("\n", F.coalesce(ref_title, F.lit("")), F.coalesce(ref_raw, F.lit("")))
    tokens, pairs = scoring.vocabulary(extracted)
    return F.when(F.size(tokens) > 0, scoring.coverage(work_title, tokens, pairs))


def lookup_doi(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Status of references (job, i, title, raw, doi) with a DOI."""
    first = F.min(F.struct(F.col("doi").alias("matched_doi"), F.col("title").alias("matched_title"))).alias("w")
    known = works.groupBy(F.lower("doi").alias("key")).agg(first).select(F.col("key").alias("doi"), "w.*")
    got = refs.where("doi IS NOT NULL").join(known, "doi", "left").withColumn("similarity", F.when(F.col("matched_doi").isNotNull(), title_score(F.col("matched_title"), F.col("title"), F.col("raw"))))
    status = F.when(F.col("matched_doi").isNull(), "notFound").when(F.col("similarity") < scoring.TITLE_FROM, "mismatch").otherwise("verified")
    return got.select("job", "i", "doi", status.alias("status"), "similarity", "matched_doi", "matched_title")


def best_candidates(mine: DataFrame, works: DataFrame, common: int = COMMON_TOKEN) -> DataFrame:
    """(job, i, doi, rank): the best works for the tokens (job, i, token) of each reference.

    Three works carry a reference's rarest token that three have, so the third best weighs at least as much as that token.
    The reference's most common tokens that together weigh less can bring no work among the best by themselves: works
    are met by the other tokens only, those out of reach of the third best are left, and the rest is added to the few
    that stay.  Tokens that more works than ``common`` carry are joined salted.
    """
    key, tiny = ["job", "i"], 1e-11  # weights are rounded to twelve places
    mine = written(mine)
    tokens = works.select("doi", F.explode(F.array_distinct(t.tokenize("title"))).alias("token")).join(mine.select("token").distinct(), "token", "left_semi")
    tokens = written(tokens.groupBy("doi", "token").agg(F.count(F.lit(1)).alias("m")))
    sizes = tokens.groupBy("token").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("works"), (F.max("m") / F.sum("m")).alias("most"))
    one = W.partitionBy(*key)
    least = F.max(F.when(F.col("works") >= CANDIDATES, 1 / F.col("n"))).over(one)
    so_far = F.sum("most").over(one.orderBy("most", "token").rowsBetween(W.unboundedPreceding, 0))
    known = mine.join(sizes, "token").withColumn("idle", F.coalesce(so_far + tiny < least, F.lit(False)))
    known = written(known.withColumn("reach", F.coalesce(F.sum(F.when(F.col("idle"), F.col("most"))).over(one), F.lit(0.0))))
    asking = known.where("NOT idle")
    rare = asking.where(F.col("works") <= common).join(tokens, "token")
    hot = asking.where(F.col("works") > common).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).join(tokens.withColumn("salt", F.pmod(F.hash("doi"), F.lit(SALT))), ["token", "salt"])
    # Rounded, so that sums of the same weights tie in whatever order they were added.
    weight = F.sum(F.col("m") / F.col("n"))
    met = rare.select(*key, "doi", "m", "n", "reach").unionByName(hot.select(*key, "doi", "m", "n", "reach")).groupBy(*key, "doi").agg(weight.alias("weight"), F.first("reach").alias("reach"))
    met = met.withColumn("place", F.row_number().over(one.orderBy(F.desc("weight"), "doi"))).withColumn("floor", F.min(F.when(F.col("place") == CANDIDATES, F.col("weight"))).over(one))
    kept = written(met.where(F.col("floor").isNull() | (F.col("weight") + F.col("reach") + tiny >= F.col("floor"))).select(*key, "doi", "weight"))
    more = kept.select(*key, "doi").join(tokens, "doi").join(known.where("idle").select(*key, "token", "n"), [*key, "token"]).groupBy(*key, "doi").agg(weight.alias("more"))
    whole = kept.join(more, [*key, "doi"], "left").select(*key, "doi", F.round(F.col("weight") + F.coalesce("more", F.lit(0.0)), 12).alias("weight"))
    return whole.withColumn("rank", F.row_number().over(one.orderBy(F.desc("weight"), "doi"))).where(F.col("rank") <= CANDIDATES)


def search_titles(refs: DataFrame, works: DataFrame, common: int = COMMON_TOKEN) -> DataFrame:
    """Status of references without a DOI: the first of the best candidates that is similar enough, else the most similar.

    A reference meets its candidates as one array, so that its text is tokenised once for all of them.
    """
    asked = refs.where("doi IS NULL").withColumn("query", t.first_non_empty("title", "raw"))
    best = best_candidates(asked.where("query <> ''").select("job", "i", F.explode(F.array_distinct(t.tokenize("query"))).alias("token")), works, common)
    titled = best.join(works.select("doi", "title"), "doi").groupBy("job", "i").agg(F.collect_list(F.struct("rank", F.col("doi").alias("matched_doi"), F.col("title").alias("matched_title"))).alias("_found"))
    own = F.transform("_found", lambda x: F.struct(x.alias("x"), t.tokenize(x.getField("matched_title")).alias("own")))
    d = asked.join(titled, ["job", "i"], "left").withColumns({"_text": F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("raw", F.lit(""))), "_found": own})
    d = scoring.with_vocabulary(d, "_text", "_tokens", "_pairs")
    score = lambda x: F.when(F.size("_tokens") > 0, scoring.tokens_coverage(x.getField("own"), F.col("_tokens"), F.col("_pairs")))
    d = d.withColumn("_scored", F.filter(F.transform("_found", lambda x: F.struct(score(x).alias("score"), (-x.getField("x").getField("rank")).alias("place"), x.getField("x").getField("matched_doi").alias("matched_doi"), x.getField("x").getField("matched_title").alias("matched_title"))), lambda x: x.getField("score").isNotNull()))
    by_place = lambda x: F.struct(x.getField("place").alias("place"), x.getField("score").alias("score"), x.getField("matched_doi").alias("matched_doi"), x.getField("matched_title").alias("matched_title"))
    d = d.withColumns({"first": F.array_max(F.transform(F.filter("_scored", lambda x: x.getField("score") >= scoring.TITLE_FROM), by_place)), "most": F.array_max("_scored")})
    hit = lambda c: F.coalesce(F.col(f"first.{c}"), F.when(F.col("first").isNull(), F.col(f"most.{c}"))).alias({"score": "similarity"}.get(c, c))
    status = F.when(F.col("query") == "", "skipped").when(F.col("first").isNotNull(), "verified").otherwise("notFound")
    return d.select("job", "i", F.lit(None).cast("string").alias("doi"), status.alias("status"), hit("score"), hit("matched_doi"), hit("matched_title"))


def circuit_breaker(checks: DataFrame, key: str = "job", order: str = "i", limit: int = MAX_LOOKUPS, breaker: int = BREAKER) -> DataFrame:
    """Statuses after the breaker: once ``breaker`` rows in a row are unavailable (skipped ones do not count),
    every later row below ``limit`` is unavailable; rows from ``limit`` on are skipped. Rows whose status changes
    were never looked up, so they lose what was matched."""
    c = checks.withColumn("_was", F.col("status")).withColumn("status", F.when(F.col(order) >= limit, "skipped").otherwise(F.col("status")))
    down = (F.col("status") == "unavailable").cast("int")
    run = F.sum(down).over(W.partitionBy(key, F.col("status") == "skipped").orderBy(order).rowsBetween(1 - breaker, 0))
    c = c.withColumn("_at", F.when((F.col("status") != "skipped") & (run == breaker), F.col(order)))
    c = c.withColumn("_cut", F.min("_at").over(W.partitionBy(key)))
    c = c.withColumn("status", F.when((F.col(order) > F.col("_cut")) & (F.col(order) < limit), "unavailable").otherwise(F.col("status")))
    same = F.col("status") == F.col("_was")
    return c.withColumns({m: F.when(same, F.col(m)) for m in MATCHED if m in c.columns}).drop("_at", "_cut", "_was")


def check_references(refs: DataFrame, works: DataFrame | None, unavailable: DataFrame | None = None) -> DataFrame:
    """Every reference's status. unavailable: (doi) that the service did not answer; no works: all skipped."""
    if works is None:
        return refs.select("job", "i", "doi", F.lit("skipped").alias("status"), F.lit(None).cast("double").alias("similarity"), F.lit(None).cast("string").alias("matched_doi"), F.lit(None).cast("string").alias("matched_title"))
    found = lookup_doi(refs, works).unionByName(search_titles(refs, works))
    if unavailable is not None:
        found = found.join(unavailable.select("doi", F.lit(True).alias("_down")).dropDuplicates(["doi"]), "doi", "left")
        gone = F.coalesce("_down", F.lit(False))
        found = found.withColumns({"status": F.when(gone, "unavailable").otherwise(F.col("status")), **{c: F.when(~gone, F.col(c)) for c in MATCHED}}).drop("_down")
    return circuit_breaker(found)


def summarize(checks: DataFrame, *more) -> DataFrame:
    """Counts of each status, and the share of verified among those that could be compared; ``more`` aggregates."""
    n = lambda x: F.count_if(F.col("status") == x)
    out = checks.groupBy("job").agg(n("verified").alias("verified"), n("mismatch").alias("mismatch"), n("notFound").alias("not_found"), n("unavailable").alias("unavailable"), n("skipped").alias("skipped"), *more)
    return out.withColumn("crossref", F.round(F.try_divide(F.col("verified"), F.col("verified") + F.col("mismatch")), 4))
