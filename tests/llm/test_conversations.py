import hashlib
import itertools
import random
import re
import zlib

import pytest

from docweave.llm import conversations as c

DDL = "conv_id long, turn long, role string, text string"
LAWFUL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out, ids = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return ids, out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(turns, costs):
    """Every way to edit the turns, with at most two new turns at a place."""
    new = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    choices = []
    for (role, text), fault in zip(turns, faults(turns)):
        extra = costs.truncated if fault == "truncated" else 0
        one = [(costs.delete, "D", [])]
        if fault not in ("blank", "duplicate"):
            one += [(extra, "K", [(role, text)])] + [(extra + costs.rerole, "R", [(r, text)]) for r in ("user", "assistant")]
        choices.append([(p + costs.insert * len(i), "I" * len(i) + e, [(r, "") for r in i] + t) for p, e, t in one for i in new])
    choices.append([(costs.insert * len(i), "I" * len(i), [(r, "") for r in i]) for i in new])
    for way in itertools.product(*choices):
        made = [t for w in way for t in w[2]]
        if LAWFUL.fullmatch("".join(r[:1] or "?" for r, _ in made)):
            yield sum(w[0] for w in way), "".join(w[1] for w in way), made


def walked(turns, costs):
    """The same by a plain walk over the turns, for longer conversations."""
    goes = lambda state, i: {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, i))
    names = {"u": "user", "a": "assistant"}

    def filled(best):
        for _ in range(2):
            for state, (cost, audit, made) in list(best.items()):
                for i in "ua":
                    if to := goes(state, i):
                        best[to] = min(best.get(to, (10**9, "", [])), (cost + costs.insert, audit + "I", [*made, (names[i], "")]))
        return best

    best = filled({"0": (0, "", [])})
    for (role, text), fault in zip(turns, faults(turns)):
        extra, then = costs.truncated if fault == "truncated" else 0, {}
        for state, (cost, audit, made) in best.items():
            ways = [(state, cost + costs.delete, "D", made)]
            if fault not in ("blank", "duplicate"):
                ways += [(goes(state, role[:1]), cost + extra, "K", [*made, (role, text)])] + [(goes(state, i), cost + extra + costs.rerole, "R", [*made, (names[i], text)]) for i in "ua"]
            for to, price, letter, out in ways:
                if to:
                    then[to] = min(then.get(to, (10**9, "", [])), (price, audit + letter, out))
        best = filled(then)
    return min(best[x] for x in ("0", "a") if x in best)


def random_turns(rng, n):
    return [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["One.", "Two!", "three", " ", "", "Four? ", "no end ,", "Five."]) + rng.choice(["", "", "6."])) for _ in range(n)]


@pytest.mark.parametrize("costs", [c.Costs(), c.Costs(rerole=3, delete=9, insert=1, truncated=1)])
def test_cheapest_of_all_repairs(spark, costs):
    rng = random.Random(4)
    convs = {k: random_turns(rng, k % 4) for k in range(24)}
    rows = [(k, i, r, t) for k, turns in convs.items() for i, (r, t) in enumerate(turns)]
    got = {r.conv_id: r for r in c.repaired_conversations(c.as_rows(spark.createDataFrame(rows, DDL)), costs).collect()}
    for k, turns in convs.items():
        if not turns:
            continue
        cost, audit, made = min(all_repairs(turns, costs))
        assert (got[k].cost, got[k].audit) == (cost, audit), turns
        assert [(t.role, t.text) for t in got[k].turns] == made
        assert walked(turns, costs) == (cost, audit, made)


def test_inserted_turns_are_used_when_they_are_cheap(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (2, 0, "assistant", "A.")]
    got = {r.conv_id: r for r in c.repaired_conversations(c.as_rows(spark.createDataFrame(rows, DDL)), c.Costs(rerole=7, delete=9, insert=1)).collect()}
    assert got[1].audit == "KIKI" and [t.role for t in got[1].turns] == ["user", "assistant", "user", "assistant"]
    assert got[2].audit == "IK" and got[2].turns[0].asDict() == {"role": "user", "text": ""}


def test_query_against_plain_python(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, i + (i > 4), r, t) for k in range(60) for i, (r, t) in enumerate(random_turns(rng, rng.randrange(9)))]
    rows += [(60, i, r, t) for i, (r, t) in enumerate(random_turns(rng, 700))]  # a long conversation
    rows += [(None, 3, "user", "Hi."), (None, None, None, None), (61, None, "user", "a."), (61, None, "assistant", "b."), (61, 5, "assistant", "c. " * 40000), (62, 4, "user", "x."), (62, 4, "user", "x."), (62, 4, "assistant", "x.")]
    rows += [next((k, 0, "user", "gone.") for k in range(1000, 9999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL + ", copy int, place string").selectExpr("*", "1 AS fault", "'q' AS kind")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in c.op11_conversation_repair(spark, str(tmp_path)).collect()}
    ids, left = damaged(rows)
    assert set(got) == ids
    for k in ids:
        mine = sorted((r for r in left if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[2:] for r in mine]
        f, at = faults(turns), [r[1] for r in mine if r[1] is not None]
        cost, audit, made = walked(turns, c.Costs())
        want = (max(at) - min(at) + 1 - len(set(at)) if at else 0, *[f.count(x) for x in ("blank", "duplicate", "truncated")], sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns)), cost, audit)
        want += (hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),)
        assert tuple(got[k])[1:] == want, (k, mine)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/conversations.parquet")
    assert c.op11_conversation_repair(spark, str(tmp_path)).collect() == []
