"""Repair of the turn structure of conversations (operator 11), with Spark SQL functions only.

A conversation is sound when its roles' initials are ``(s?(ua)+)?``: perhaps a system turn, then pairs of a user's
and an assistant's turn, or nothing at all.  One exchange deals rows out by conversation.  Windows over it flag
each row's fault and count gaps and wrong neighbours; the sorted turns are collected, and one ``aggregate`` folds
them.  It carries the cheapest (cost, audit) of the four states that a sound beginning can be in - nothing yet,
after s, after u, after a - and each turn moves all four by ``least`` over structs, which decides by cost and
then by the audit's bytes.  Two audits of one state and cost never start one another, as their letters fix their
cost, so the smaller stays the smaller whatever follows.  The audit alone fixes the repaired turns.

Defined results: a null role, text, turn or id reads as one space in the key of the damage, and a null role or text
is one space after it; the null id is a conversation of its own; rows of one turn come by role, then text, and
rows that are the same in all of these are repeats of each other; a role that starts with none of s, u and a can only be
rewritten or deleted; a conversation without rows has zeros, an empty audit and no turns; an empty table gives an
empty table; only the four named columns are read.

Skew: a conversation's turns meet in one row because its audit and the hash of its repaired text are values of one
row.  Rows that are lost travel without their text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

BLANK, STOPS = " \t\n\x0b\f\r", ".!?"
#: The cost of a state that no edits reach.
NEVER = 1 << 40
SYSTEM, USER, ASSISTANT = "s", "u", "a"


@dataclass(frozen=True)
class Costs:
    """What an edit costs; ``truncated`` is added for each truncated row that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def damaged(rows: DataFrame, classes: int = 20) -> DataFrame:
    """(conv_id, turn, copy, lost, role, text) after the damage that the hash of ``conv_id:turn`` chooses.

    0 loses the row (it stays as a mark that its conversation exists), 1 empties the text, 2 removes its sentence
    ends, 3 repeats the row, 4 makes it the user's; the other classes leave it.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % classes
    d = rows.select("conv_id", "turn", kind.alias("kind"), text_of("role").alias("role"), text_of("text").alias("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select(
        "conv_id",
        "turn",
        F.explode(copies).alias("copy"),
        (F.col("kind") == 0).alias("lost"),
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
    )


def as_rows(rows: DataFrame) -> DataFrame:
    """Undamaged rows in the columns of :func:`damaged`."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", "turn", F.lit(0).alias("copy"), F.lit(False).alias("lost"), text_of("role"), text_of("text"))


def flagged(rows: DataFrame) -> DataFrame:
    """Adds place, fault ('blank', 'duplicate', 'truncated' or null), illegal and new_turn, by windows."""
    d = rows.repartition(F.col("conv_id")).withColumn("initial", F.substring("role", 1, 1))
    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    along = W.partitionBy("conv_id", "lost").orderBy(*order)
    alike = W.partitionBy("conv_id", "lost", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    d = d.withColumns({"place": F.row_number().over(along), "before": F.lag("initial").over(along), "turn_before": F.lag("turn").over(along), "nth": F.row_number().over(alike)})
    fault = F.when(end == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.right(end, F.lit(1)).isin(*STOPS), "truncated")
    legal = F.concat("before", "initial").isin(SYSTEM + USER, USER + ASSISTANT, ASSISTANT + USER)
    return d.select("conv_id", "turn", "lost", "role", "text", "place", "initial", fault.alias("fault"), (F.col("before").isNotNull() & ~legal).alias("illegal"), (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _edit(state: Column, letter: str, cost: Column | int) -> Column:
    cost = cost if isinstance(cost, Column) else F.lit(cost).cast("long")
    return F.struct((state.getField("cost") + cost).alias("cost"), F.concat(state.getField("audit"), F.lit(letter)).alias("audit"))


def _with_inserts(four: Column, costs: Costs) -> Column:
    """The states once turns may have been inserted: a user's turn leads to u, one of an assistant after it to a."""
    start, s, u, a = (four.getField(x) for x in ("n", "s", "u", "a"))
    return _let(
        F.least(u, *[_edit(x, "I", costs.insert) for x in (start, s, a)]),
        lambda u2: F.struct(start.alias("n"), s.alias("s"), u2.alias("u"), F.least(a, _edit(u2, "I", costs.insert)).alias("a")),
    )


def _moved(four: Column, row: Column, costs: Costs) -> Column:
    """The states after one more turn is kept, given another role or deleted."""
    start, s, u, a = (four.getField(x) for x in ("n", "s", "u", "a"))
    stays = F.when(row.getField("must_go"), F.lit(NEVER)).when(row.getField("cut_off"), F.lit(costs.truncated)).otherwise(F.lit(0)).cast("long")
    drop = lambda x: _edit(x, "D", costs.delete)
    keep = lambda x, initial: _edit(x, "K", F.when(row.getField("initial") == initial, stays).otherwise(F.lit(NEVER)))
    rerole = lambda x: _edit(x, "R", stays + costs.rerole)
    return _let(
        F.least(start, s, a),
        lambda any_u: F.struct(
            drop(start).alias("n"),
            F.least(drop(s), keep(start, SYSTEM)).alias("s"),
            F.least(drop(u), keep(any_u, USER), rerole(any_u)).alias("u"),
            F.least(drop(a), keep(u, ASSISTANT), rerole(u)).alias("a"),
        ),
    )


def cheapest_edits(turns: Column, costs: Costs = Costs()) -> Column:
    """struct(cost, audit) for sorted turns, each struct(initial, must_go, cut_off, ...)."""
    state = lambda cost: F.struct(F.lit(cost).cast("long").alias("cost"), F.lit("").alias("audit"))
    first = F.struct(state(0).alias("n"), *[state(NEVER).alias(x) for x in ("s", "u", "a")])
    step = lambda four, row: _let(_moved(four, row, costs), lambda x: _with_inserts(x, costs))
    return F.aggregate(turns, _with_inserts(first, costs), step, lambda four: F.least(four.getField("n"), four.getField("a")))


def repaired_turns(turns: Column, audit: Column) -> Column:
    """array<struct<role, text>> of the turns once the audit's edits are made."""
    own = F.regexp_extract_all(audit, F.lit("I*[KRD]"), F.lit(0))
    new = F.struct(F.lit("I").alias("edit"), F.lit("").alias("role"), F.lit("").alias("text"))
    inserted = lambda letters: F.array_repeat(new, F.length(letters))

    def made(letters: Column, row: Column) -> Column:
        last = F.right(letters, F.lit(1))
        stays = F.array(F.struct(last.alias("edit"), row.getField("role").alias("role"), row.getField("text").alias("text")))
        return F.concat(inserted(F.rtrim(letters, F.lit("KRD"))), F.filter(stays, lambda x: x.getField("edit") != "D"))

    def named(left: Column) -> Column:
        led = F.when(F.substring(F.get(left, F.lit(0)).getField("role"), 1, 1).eqNullSafe(F.lit(SYSTEM)) & (F.get(left, F.lit(0)).getField("edit") == "K"), 1).otherwise(0)
        role = lambda x, i: F.when(x.getField("edit") == "K", x.getField("role")).when((i - led) % 2 == 0, "user").otherwise("assistant")
        return F.transform(left, lambda x, i: F.struct(role(x, i).alias("role"), x.getField("text").alias("text")))

    left = F.concat(F.flatten(F.zip_with(own, turns, made)), inserted(F.regexp_extract(audit, "I*$", 0)))
    return _let(left, named)


def repaired_conversations(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns) of each conversation of ``rows``, which
    are rows of :func:`damaged` or :func:`as_rows`; turns are the repaired ones."""
    there = ~F.col("lost")
    turn = F.struct("place", "role", "text", "initial", F.col("fault").isin("blank", "duplicate").eqNullSafe(True).alias("must_go"), F.col("fault").eqNullSafe("truncated").alias("cut_off"))
    count = lambda c: F.count_if(there & F.coalesce(c, F.lit(False)))
    span = F.max(F.when(there, F.col("turn"))) - F.min(F.when(there, F.col("turn"))) + 1 - count(F.col("new_turn"))
    d = flagged(rows).groupBy("conv_id").agg(
        F.coalesce(span.cast("long"), F.lit(0).cast("long")).alias("gaps"),
        *[count(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"),
        F.array_sort(F.collect_list(F.when(there, turn))).alias("rows"),
    )
    d = d.withColumn("best", cheapest_edits(F.col("rows"), costs))
    return d.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), repaired_turns(F.col("rows"), F.col("best.audit")).alias("turns"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = repaired_conversations(damaged(table(spark, sf_dir, "conversations")))
    lines = F.transform("turns", lambda x: F.concat(x.getField("role"), F.lit(":"), x.getField("text")))
    return d.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


ORACLE_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), CAST(b AS BIGINT))) AS tab),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM src, crc),
dmg AS (SELECT conv_id, turn, copy, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM hit, (VALUES (0), (1)) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
num AS (SELECT *, row_number() OVER w AS place, left(role, 1) AS ini, lag(left(role, 1)) OVER w AS was,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
        FROM dmg WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
flt AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM num),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (was IS NOT NULL AND was || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM flt GROUP BY conv_id),
moves AS (SELECT * FROM (VALUES ('D', 0, 0, '', 2), ('D', 1, 1, '', 2), ('D', 2, 2, '', 2), ('D', 3, 3, '', 2), ('K', 0, 1, 's', 0), ('K', 0, 2, 'u', 0), ('K', 1, 2, 'u', 0), ('K', 3, 2, 'u', 0), ('K', 2, 3, 'a', 0),
                                 ('R', 0, 2, 'user', 1), ('R', 1, 2, 'user', 1), ('R', 3, 2, 'user', 1), ('R', 2, 3, 'assistant', 1)) AS m(edit, held, goes, needs, price)),
fills AS (SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'),
                                (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')) AS f(held, goes, price, letters, lines)),
walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS place, goes AS state, CAST(price AS BIGINT) AS cost, letters AS audit, lines AS done FROM (SELECT DISTINCT conv_id FROM flt), fills WHERE held = 0
         UNION ALL
         SELECT conv_id, place, state, cost, audit, done FROM (
           SELECT w.conv_id, f.place, i.goes AS state, w.cost + m.price + i.price + CASE WHEN m.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost, w.audit || m.edit || i.letters AS audit,
                  w.done || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || m.needs || ':' || f.text END || i.lines AS done,
                  row_number() OVER (PARTITION BY w.conv_id, i.goes ORDER BY w.cost + m.price + i.price + CASE WHEN m.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END, w.audit || m.edit || i.letters) AS r
           FROM walk w JOIN flt f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1
           JOIN moves m ON m.held = w.state AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (m.edit <> 'K' OR f.ini = m.needs)
           JOIN fills i ON i.held = m.goes) WHERE r = 1),
best AS (SELECT * FROM (SELECT w.conv_id, w.cost, w.audit, w.done, row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost, w.audit) AS r
                        FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND w.place = s.rows WHERE w.state IN (0, 3)) WHERE r = 1)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal,
       coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(b.done[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""
