"""Stores, timers and calls, batch by batch, against plain Python."""

import datetime as dt
import random

import pandas as pd
import pytest

from docweave.streaming import flows, stores, timers

T0 = dt.datetime(2026, 1, 1)
CHANGES = "job string, at timestamp, seq long, kind string, value string, reason string"


def plain(rows):
    """Jobs and refusals after all changes in order."""
    jobs, refused = {}, []
    for job, at, seq, kind, value, reason in sorted(rows, key=lambda r: (r[1], r[2])):
        was = jobs.get(job)
        problem = None
        if kind == "register":
            problem = None if was is None or was[0] == "FAILED" else "IN_PROGRESS" if was[0] == "PROCESSING" else "ALREADY_PROCESSED"
            after = ("PROCESSING" if reason is None else "FAILED", value, at, at, reason)
        elif kind == "status":
            problem = "invalid_status" if value not in ("PROCESSING", "COMPLETED", "REVIEW_PENDING") else "not_found" if was is None else None
            after = was and (value, was[1], was[2], at, None)
        elif kind == "fail":
            problem = "reason_missing" if not value else "not_found" if was is None else None
            after = was and ("FAILED", was[1], was[2], at, value)
        else:
            problem = "unknown_change"
        if problem:
            refused.append((job, seq, problem))
        else:
            jobs[job] = after
    return jobs, refused


def changes(seed, n=300):
    rng = random.Random(seed)
    values = {"register": ["f1", "f2", None], "status": ["COMPLETED", "REVIEW_PENDING", "PROCESSING", "FAILED", "?", None], "fail": ["broken", "", None], "other": ["x"]}
    out = []
    for seq in range(n):
        kind = rng.choice(["register", "register", "status", "status", "fail", "other"])
        out.append((f"j{rng.randrange(25)}", T0 + dt.timedelta(seconds=seq // 3), seq, kind, rng.choice(values[kind]), rng.choice([None, None, "bad"]) if kind == "register" else None))
    return out


def test_batches_and_reruns(spark, tmp_path):
    rows = changes(1)
    root, refused = str(tmp_path / "jobs"), str(tmp_path / "refused")
    write = stores.job_writer(root, refused, buckets=8)
    frames = [spark.createDataFrame(rows[i : i + 100], CHANGES) for i in (0, 100, 200)]
    write(frames[0], 0)
    write(frames[1], 1)
    (tmp_path / "jobs" / "batch=1" / "_SUCCESS").unlink()  # the batch was cut short: what it wrote does not count
    assert {r.job: tuple(r)[1:] for r in stores.read_jobs(spark, root).collect()} == plain(rows[:100])[0]
    write(frames[1], 1)
    write(frames[2], 2)
    write(frames[2], 2)  # and again
    want, gone = plain(rows)
    assert {r.job: tuple(r)[1:] for r in stores.read_jobs(spark, root).collect()} == want
    assert sorted((r.job, r.seq, r.problem) for r in stores.read_refused(spark, refused).collect()) == sorted(gone)
    assert all(len(v) <= 2 for v in stores.versions(spark, root).values())


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "jobs")
    write = stores.job_writer(root, str(tmp_path / "refused"), buckets=16)
    write(spark.createDataFrame([(f"j{i}", T0, i, "register", "f", None) for i in range(100)], CHANGES), 0)
    write(spark.createDataFrame([("j7", T0, 200, "status", "COMPLETED", None)], CHANGES), 1)
    assert len(list((tmp_path / "jobs" / "batch=0").glob("bucket=*"))) == 16
    assert len(list((tmp_path / "jobs" / "batch=1").glob("bucket=*"))) == 1
    got = {r.job: r.status for r in stores.read_jobs(spark, root).collect()}
    assert len(got) == 100 and got["j7"] == "COMPLETED" and got["j8"] == "PROCESSING"
    write(spark.createDataFrame([], CHANGES), 2)
    assert stores.read_jobs(spark, root).count() == 100


def test_first_seen_holds_no_stream_state(spark, tmp_path):
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    write = stores.first_seen_writer(ledger, out, buckets=4)
    batches = [[("a", 1), ("a", 2), ("b", 3), (None, 4)], [("b", 5), ("c", 6), (None, 7)], [("a", 8), ("d", 9)]]
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, "sha256 string, seq long"), i)
        write(spark.createDataFrame(rows, "sha256 string, seq long"), i)
    got = {(r.sha256, r.seq) for r in spark.read.parquet(f"{out}/batch=*").collect()}
    assert got == {("a", 1), ("b", 3), (None, 4), ("c", 6), (None, 7), ("d", 9)}


def test_dead_letters_are_kept_and_come_back(spark, tmp_path):
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    write = stores.routed_writer(good, dead, keep_days=2)
    rows = [(1, "uploads/a", T0, None), (2, "x", T0, "NOT_PDF"), (3, None, T0 + dt.timedelta(days=5), "no key")]
    df = spark.createDataFrame(rows, "id long, path string, at timestamp, problem string")
    write(df, 0)
    write(df, 0)
    assert [r.id for r in spark.read.parquet(f"{good}/batch=*").collect()] == [1]
    back = {r.id: (r.path, r.cause) for r in stores.redriven(stores.read_letters(spark, dead), "id long, path string").collect()}
    assert back == {2: ("x", "NOT_PDF"), 3: (None, "no key")}
    assert [r.cause for r in stores.read_letters(spark, dead, T0 + dt.timedelta(days=3)).collect()] == ["no key"]


def walked(rows, timeout):
    state, out = {}, []
    for job, at, _, to in sorted(rows, key=lambda r: (r[1], r[2])):
        now, due = state.get(job, ("", None))
        if due and at > due:
            out.append((job, due, now, "FAILED", True, "timeout"))
            now, due = "FAILED", None
        ok = to in timers.NEXT[now]
        out.append((job, at, now, to, ok, "asked"))
        if ok:
            now, due = to, at + timeout if to == "PROCESSING" else None
        state[job] = now, due
    return out + [(j, due, now, "FAILED", True, "timeout") for j, (now, due) in state.items() if due]


@pytest.mark.parametrize("cuts", [(0, 40), (0, 7, 23, 40)])
def test_timers_do_not_hang_on_batches(spark, tmp_path, cuts):
    rng = random.Random(2)
    rows = [(f"j{rng.randrange(4)}", T0 + dt.timedelta(minutes=11 * i), i, rng.choice(["PROCESSING", "PROCESSING", "COMPLETED", "REVIEW_PENDING", "FAILED"])) for i in range(40)]
    schema = "job string, at timestamp, seq long, status string"
    for a, b in [*zip(cuts, cuts[1:]), (None, None)]:
        part = rows[a:b] if b else [("", T0 + dt.timedelta(days=9), 0, "")]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = timers.job_states(stream, 3_600_000, forget_ms=10 * 86_400_000)
        flows.run_once(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.job]
    assert sorted(got) == sorted(walked(rows, dt.timedelta(hours=1)))
    assert any(r[5] == "timeout" for r in got)


def test_state_is_kept_by_bucket(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"j{rng.randrange(90)}", T0 + dt.timedelta(minutes=3 * i), i, rng.choice(["PROCESSING", "PROCESSING", "COMPLETED", "FAILED"])) for i in range(300)]
    schema = "job string, at timestamp, seq long, status string"
    kept = []
    for part in (rows[:150], rows[150:], [("", T0 + dt.timedelta(days=9), 0, "")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = timers.job_states(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 3_600_000, buckets=2)
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        kept += [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.job]
    assert sorted(got) == sorted(walked(rows, dt.timedelta(hours=1)))
    assert max(kept) <= 2 * 3  # a bucket's states and its timer, which is kept twice, and nothing by job


def test_calls_are_tried_again_by_class(spark):
    def call(rows, attempt):
        kinds = {0: None, 1: "transient", 2: "undecodable", 3: "permanent"}
        bad = (rows["kind"] > 0) & (rows["fails"] >= attempt)
        return rows.assign(error=[kinds[k] if b else None for k, b in zip(rows["kind"], bad)], asked=attempt)[["id", "asked", "error"]]

    rows = [(i, i % 4, i % 7) for i in range(84)]
    got = flows.called(spark.createDataFrame(rows, "id int, kind int, fails int"), call, "id int, asked int", {"transient": (5, 1, 2), "undecodable": (2, 0, 0)}, batch=10).collect()
    assert len(got) == 84
    for r in got:
        _, kind, fails = rows[r.id]
        most = {0: 1, 1: 5, 2: 2, 3: 1}[kind]
        need = 1 if kind == 0 else min(fails + 1, most)
        assert (r.attempts, r.outcome) == (need, "succeeded" if kind == 0 or fails < most else "failed")
        assert (r.error is None) == (r.outcome == "succeeded")


def test_page_answers_carry_the_page_asked_for(spark):
    def call(rows, attempt):
        return pd.DataFrame({"job": "?", "page": 99, "text": rows["page"].astype(str), "error": None}, index=rows.index)

    got = flows.page_answers(spark.createDataFrame([("a", 1), ("a", 2), ("b", 7)], "job string, page int"), call, "job string, page int, text string").collect()
    assert sorted((r.job, r.page, r.text) for r in got) == [("a", 1, "1"), ("a", 2, "2"), ("b", 7, "7")]


def test_answers_in_time_late_and_never(spark, tmp_path):
    m = lambda x: T0 + dt.timedelta(minutes=x)
    asks = [("r1", m(0)), ("r2", m(1)), ("r3", m(2)), ("r4", m(3))]
    says = [("r1", m(3), None), ("r2", m(4), "E"), ("r3", m(30), None), ("r9", m(5), None)]
    for i, (q, a) in enumerate([(asks, says), ([("x", m(9999))], [("y", m(9999), None)])]):
        spark.createDataFrame([(t, "j", at) for t, at in q], "token string, job string, asked_at timestamp").write.mode("append").parquet(str(tmp_path / "q"))
        spark.createDataFrame(a, "token string, done_at timestamp, error string").write.mode("append").parquet(str(tmp_path / "a"))
        q_s = spark.readStream.schema("token string, job string, asked_at timestamp").parquet(str(tmp_path / "q"))
        a_s = spark.readStream.schema("token string, done_at timestamp, error string").parquet(str(tmp_path / "a"))
        flows.run_once(timers.answered(q_s, a_s, "10 minutes").writeStream.foreachBatch(timers.acknowledged(str(tmp_path / "out"), str(tmp_path / "late"))), str(tmp_path / "state"))
    got = {r.token: r.outcome for r in spark.read.parquet(str(tmp_path / "out") + "/batch=*").collect()}
    assert got == {"r1": "resumed", "r2": "failed", "r3": "timed_out", "r4": "timed_out"}
    assert {r.token for r in spark.read.parquet(str(tmp_path / "late") + "/batch=*").collect()} == {"r3", "r9"}


@pytest.mark.parametrize("cuts", [(0, 60), (0, 13, 14, 40, 60)])
def test_answers_wait_on_disk(spark, tmp_path, cuts):
    rng = random.Random(5)
    m = lambda x: T0 + dt.timedelta(minutes=x)
    rows = [(rng.random() < 0.5, rng.choice(["a", "b", "c", "d", None]), "j", m(i), rng.choice([None, "E"])) for i in range(60)]
    asks = [(t, at) for said, t, _, at, _ in rows if not said]
    says = [(t, at, e) for said, t, _, at, e in rows if said]
    met = [(t, q, at, e) for t, q in asks for s, at, e in says if t is not None and t == s and q <= at <= q + dt.timedelta(minutes=7)]
    want = [(t, q, at, e, "failed" if e else "resumed") for t, q, at, e in met]
    want += [(t, q, None, None, "timed_out") for t, q in asks if q not in {x[1] for x in met}]
    gone = [(t, at, e) for t, at, e in says if at not in {x[2] for x in met}]
    write = stores.answer_writer(str(tmp_path / "calls"), str(tmp_path / "out"), str(tmp_path / "late"), "7 minutes")
    parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])] + [[(False, "x", "j", m(9999), None), (True, "y", "j", m(9999), None)]]
    for i, part in enumerate(parts):
        for _ in range(2):  # a batch that runs again changes nothing
            write(spark.createDataFrame(part, stores.CALLS), i)
    key = lambda x: [str(v) for v in x]
    got = [(r.token, r.asked_at, r.done_at, r.error, r.outcome) for r in spark.read.parquet(str(tmp_path / "out") + "/batch=*").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sorted((tuple(r)[:3] for r in spark.read.parquet(str(tmp_path / "late") + "/batch=*").collect()), key=key) == sorted(gone, key=key)
    assert spark.read.schema(stores.CALLS).parquet(f"{tmp_path}/calls/waiting/batch={len(parts) - 1}").count() == 2
