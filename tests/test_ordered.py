"""Ordered operators against plain loops, with small groups and with one hot key cut into chunks."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import dedup, ledger, requestlog, runs
from gleanframe.operators.ordered import OrderedRows, running_count, running_last, running_max, running_sum

WHOLE, CHUNKED = 1, 20  # chunks


@pytest.fixture(params=[WHOLE, CHUNKED], ids=["plain", "chunked"])
def max_rows(request):
    return request.param


def grouped(rows, key):
    groups = defaultdict(list)
    for row in sorted(rows):
        groups[row[key]].append(row)
    return groups


# --- the primitive -------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    draw = random.Random(7)
    rows = [(i, None if i % 50 == 0 else "hot" if draw.random() < 0.6 else f"k{i % 5}", draw.randint(-9, 9)) for i in range(900)]
    return rows, spark.createDataFrame(rows, "seq long, key string, v int").repartition(5).persist()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_values(numbers, max_rows, descending, exclusive):
    rows, df = numbers
    odd = F.when(F.col("v") % 2 == 1, F.col("v"))  # negative remainders are no hit
    got = (
        OrderedRows.of(df, ["key"], ["seq"], descending=descending, chunks=max_rows)
        .running(exclusive=exclusive, n=running_count(), total=running_sum(F.col("v")))
        .running(exclusive=exclusive, top=running_max(F.col("total")), odd=running_last(odd))
        .previous(before=F.col("total"))
        .df.collect()
    )
    got = {row.seq: (row.n, row.total, row.top, row.odd, row.before) for row in got}
    want = {}
    for members in _by_key(rows).values():
        ordered = sorted(members, reverse=descending)
        n = total = 0
        top = odd_value = before = None
        for seq, _, v in ordered:
            inner = (n + 1, total + v)
            value = (n, total) if exclusive else inner
            inner_top = value[1] if top is None else max(top, value[1])
            inner_odd = v if v > 0 and v % 2 == 1 else odd_value
            want[seq] = (*value, top if exclusive else inner_top, odd_value if exclusive else inner_odd, before)
            n, total = inner
            top, odd_value, before = inner_top, inner_odd, value[1]
    assert got == want


def _by_key(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    return groups


def test_hot_key_is_cut(numbers):
    _, df = numbers
    rows = OrderedRows.of(df, ["key"], ["seq"], chunks=CHUNKED)._df
    per_chunk = rows.filter("key = 'hot'").groupBy("_chunk").count().collect()
    assert len(per_chunk) > 3 and max(row["count"] for row in per_chunk) < 300


def test_no_window_spans_a_whole_key(numbers):
    _, df = numbers
    scanned = OrderedRows.of(df, ["key"], ["seq"], chunks=CHUNKED).running(n=running_count()).df
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    local = [line for line in plan.splitlines() if "Window [count" in line]
    assert local and all("_chunk" in line for line in local)


# --- runs ----------------------------------------------------------------------------


def run_rows(seed):
    draw = random.Random(seed)
    rows = []
    for seq in range(700):
        run = "big" if draw.random() < 0.7 else draw.choice("ab")
        draw_id = draw.random()
        rows.append((run, seq, None if draw_id < 0.03 else "" if draw_id < 0.04 else f"p{draw.randint(0, 60)}"))
    return rows


def loop_runs(rows, known, threshold, batch):
    """One crawl after another, row by row."""
    streaks, examined, batches = {}, set(), {}
    for members in grouped(rows, 0).values():
        seen, streak, n_new, stopped = set(known), 0, 0, False
        for _, seq, pid in members:
            is_known = bool(pid) and pid in seen
            streak = streak + 1 if is_known else 0
            streaks[seq] = (is_known, streak)
            if pid:
                seen.add(pid)
            if stopped:
                continue
            examined.add(seq)
            stopped = streak >= threshold
            if not is_known:
                batches[seq] = n_new // batch + 1
                n_new += 1
    return streaks, examined, batches


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_against_loop(spark, max_rows, seed):
    rows = run_rows(seed)
    known = [f"p{i}" for i in range(0, 60, 2)]
    items = spark.createDataFrame(rows, "run_id string, seq long, property_id string")
    known_df = spark.createDataFrame([(k,) for k in known], "property_id string")
    marked = dedup.mark_known(items, known_df, ["seq"])
    streaks, examined, batches = loop_runs(rows, known, 5, 7)
    got = runs.known_streak(marked, ["seq"], chunks=max_rows).collect()
    assert {r.seq: (r.is_known, r.streak) for r in got} == streaks
    cut = runs.early_stop(marked, ["seq"], threshold=5, chunks=max_rows)
    assert {r.seq for r in cut.select("seq").collect()} == examined
    batched = runs.export_batches(cut.filter("not is_known"), ["seq"], 7, chunks=max_rows)
    assert {r.seq: r.batch_no for r in batched.collect()} == batches
    whole = runs.scan_runs(marked, ["seq"], threshold=5, batch_rows=7, chunks=max_rows).collect()
    assert {r.seq: (r.is_known, r.streak) for r in whole} == streaks
    assert {r.seq for r in whole if r.examined} == examined
    assert {r.seq: r.batch_no for r in whole if r.batch_no is not None} == batches
    last = {run: max(seq for r, seq, _ in rows if r == run and seq in examined) for run in {r for r, *_ in rows}}
    assert {r.seq for r in whole if r.stops} == {seq for seq in last.values() if streaks[seq][1] >= 5}


def test_early_stop_cases(spark):
    def cut(flags, mode="daily"):
        rows = [("r", i, None if f == "-" else f"{f}{i}", f == "k") for i, f in enumerate(flags)]
        df = spark.createDataFrame(rows, "run_id string, seq long, property_id string, is_known boolean")
        return runs.early_stop(df, ["seq"], mode=F.lit(mode)).count()

    assert cut("n" * 34 + "k" * 40) == 58
    assert cut("k" * 23 + "n" + "k" * 40) == 48
    assert cut("k" * 23 + "-" + "k" * 10) == 34
    assert cut("k" * 60, "resume") == 60


def test_batches_and_last_exported(spark):
    rows = [("r", i, f"p{i}" if i != 119 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "run_id string, seq long, property_id string")
    batched = runs.export_batches(df, ["seq"])
    sizes = {r.batch_no: r["count"] for r in batched.groupBy("batch_no").count().collect()}
    assert sizes == {1: 50, 2: 50, 3: 20}
    assert runs.last_exported(batched, ["seq"]).first().last_exported_id == "p99"


def test_run_modes(spark):
    rows = [
        ("s", 1, True, True, False, 0),
        ("s", 2, False, False, True, 0),
        ("s", 3, False, False, True, 3),
        ("s", 4, True, False, False, 0),
        ("s", 5, True, True, False, 1),
    ]
    df = spark.createDataFrame(
        rows, "site string, started int, stream_exhausted boolean, pages_exhausted boolean, early_stop boolean, errors long"
    )
    got = [(r.outcome, r.mode, r.next_mode) for r in runs.run_modes(df).orderBy("started").collect()]
    assert got == [
        ("COMPLETED", "resume", "daily"),
        ("EARLY_STOP", "daily", "daily"),
        ("EARLY_STOP", "daily", "resume"),
        ("INTERRUPTED", "resume", "resume"),
        ("COMPLETED", "resume", "resume"),
    ]


# --- request log -----------------------------------------------------------------------

ERRORS = {"timeout": "timeout after 120.0s", "404": "HTTP 404 for u", "503": "HTTP 503 for u", None: None}


@pytest.fixture(scope="module")
def log(spark):
    draw = random.Random(11)
    rows, t = [], 0.0
    for seq in range(800):
        t += draw.choice([0.0, 0.2, 1.0, 7.0])
        host = 1 if draw.random() < 0.7 else draw.randint(2, 4)
        kind = draw.choice(["timeout", "404", "503", None, None, None])
        if (seq // 60) % 3 == 0 and draw.random() < 0.7:
            kind = "503"
        rows.append((host, t, seq, f"u{draw.randint(0, 25) if host > 1 else 0}", draw.choice(["crawl", "crawl", "retry"]), ERRORS[kind],
                     "success" if kind is None else "rate_limited" if kind == "503" else "error"))
    schema = "host int, t double, seq long, url string, phase string, error string, outcome string"
    df = spark.createDataFrame(rows, schema).withColumn("failed", F.col("error").isNotNull())
    return rows, df.repartition(3).persist()


@pytest.mark.parametrize("rate,burst", [(1.0, 1), (0.3, 4), (2.0, 2)])
def test_politeness_against_bucket(log, max_rows, rate, burst):
    rows, df = log
    want = {}
    for members in grouped(rows, 0).values():
        tokens, at = float(burst), None
        for _, t, seq, *_ in members:
            start = t if at is None else max(t, at)
            if at is not None:
                tokens = min(burst, tokens + (start - at) * rate)
            wait = max(0.0, (1 - tokens) / rate)
            at = start + wait
            tokens = min(burst, tokens + wait * rate) - 1
            want[seq] = (at, tokens)
    got = requestlog.politeness_schedule(df, rate, burst, chunks=max_rows).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.granted == pytest.approx(want[row.seq][0], abs=1e-6)
        assert row.waited == pytest.approx(row.granted - row.t)
        assert row.tokens_left == pytest.approx(want[row.seq][1], abs=1e-6)


def test_politeness_cases(spark):
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate([0.0, 0.0, 0.0, 5.0])], "host int, t double, seq int")
    grants = lambda burst: [r.granted for r in requestlog.politeness_schedule(df, 1.0, burst).orderBy("seq").collect()]
    assert grants(1) == [0, 1, 2, 5]
    assert grants(2) == [0, 0, 1, 5]


def loop_circuit(rows, threshold, recovery):
    states, outages = {}, []
    for host, members in grouped(rows, 0).items():
        in_row, last, opened, n = 0, None, None, 0
        for _, t, seq, _, _, error, _ in members:
            state = "CLOSED" if in_row < threshold else "HALF_OPEN" if t - last >= recovery else "OPEN"
            states[seq] = (in_row, state)
            if error is None:
                if opened is not None:
                    outages.append((host, opened, t, n))
                in_row, opened, n = 0, None, 0
            else:
                in_row, last, n = in_row + 1, t, n + 1
                if in_row == threshold:
                    opened = t
        if opened is not None:
            outages.append((host, opened, None, n))
    return states, outages


@pytest.mark.parametrize("threshold,recovery", [(1, 1.0), (3, 5.0)])
def test_circuit_against_loop(log, max_rows, threshold, recovery):
    rows, df = log
    states, outages = loop_circuit(rows, threshold, recovery)
    got = requestlog.circuit_state(df, threshold, recovery, chunks=max_rows).collect()
    assert {r.seq: (r.failures_in_row, r.state) for r in got} == states
    spans = requestlog.outage_intervals(df, threshold, recovery, chunks=max_rows).collect()
    key = lambda span: tuple(-1.0 if value is None else value for value in span)
    assert sorted([tuple(r) for r in spans], key=key) == sorted(outages, key=key)


def test_delay_multiplier_against_loop(log, max_rows, monkeypatch):
    rows, df = log
    monkeypatch.setattr(requestlog, "FOLD_ROWS", 16)  # several levels of slices
    want = {}
    for host, members in grouped(rows, 0).items():
        m = 1.0
        for *_, outcome in members:
            m = min(20.0, m * 2) if outcome == "rate_limited" else max(1.0, m * 0.9) if outcome == "success" else m
        want[host] = (len(members), pytest.approx(m, rel=1e-9))
    got = requestlog.delay_multiplier(df, chunks=max_rows).collect()
    assert {r.host: (r.requests, r.multiplier) for r in got} == want


def test_delay_multiplier_cases(spark):
    def final(outcomes):
        rows = [(1, float(i), i, o) for i, o in enumerate(outcomes)]
        return requestlog.delay_multiplier(spark.createDataFrame(rows, "host int, t double, seq int, outcome string")).first().multiplier

    assert final(["rate_limited"] * 5) == 20
    assert final(["rate_limited"] * 5 + ["success"]) == pytest.approx(18)
    assert final(["success"]) == 1
    assert final(["rate_limited"] * 3000 + ["success"] * 3000 + ["rate_limited"]) == pytest.approx(2)


def loop_ledger(rows):
    permanent = lambda error: "404" in error
    entries = {}
    for _, t, seq, url, phase, error, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if phase == "crawl":
            if error and not permanent(error):
                attempts = entries[url][1] + 1 if url in entries else 1
                entries[url] = (error, attempts, t)
        elif url in entries:
            if error is None or permanent(error):
                del entries[url]
            else:
                entries[url] = (entries[url][0], entries[url][1] + 1, entries[url][2])
    return entries


def test_ledger_against_loop(log):
    rows, df = log
    got = ledger.failure_ledger(df, order=["t", "seq"]).collect()
    assert {r.url: (r.error, r.attempts, r.t) for r in got} == loop_ledger(rows)


def test_ledger_sorts_and_writes_nothing_down(log):
    _, df = log
    plan = ledger.failure_ledger(df, order=["t", "seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Window" not in plan and "Sort" not in plan


def test_ledger_in_stretches(spark, log):
    rows, df = log
    stamped = df.withColumn("ts", F.timestamp_seconds("t"))
    stored = spark.createDataFrame([], "url string, error string, attempts int, ts timestamp")
    for low in range(0, 800, 270):
        part = stamped.filter(F.col("seq").between(low, low + 269))
        stored = ledger.merge_ledger(stored, ledger.ledger_changes(part))
    got = {r.url: (r.error, r.attempts, r.ts.timestamp()) for r in stored.collect()}
    want = {url: (e, n, pytest.approx(t, abs=1e-4)) for url, (e, n, t) in loop_ledger(rows).items()}
    assert got == want


def test_ledger_cases(spark):
    def after(*steps):
        rows = [("u", phase, error, float(i), i) for i, (phase, error) in enumerate(steps)]
        df = spark.createDataFrame(rows, "url string, phase string, error string, ts double, seq int")
        row = ledger.failure_ledger(df).first()
        return row and (row.error, row.attempts)

    lost, other, gone = ("crawl", "timeout 1"), ("crawl", "timeout 2"), ("retry", "HTTP 404 for u")
    assert after(lost, other) == ("timeout 2", 2)
    assert after(lost, ("crawl", None)) == ("timeout 1", 1)
    assert after(lost, ("retry", "HTTP 503")) == ("timeout 1", 2)
    assert after(lost, ("retry", None)) is None
    assert after(lost, gone) is None
    assert after(lost, gone, other) == ("timeout 2", 1)
    assert after(("retry", "HTTP 503"), lost) == ("timeout 1", 1)
    assert after(("crawl", "HTTP 404 for u")) is None


def test_pending_and_summary(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 6)], "url string, attempts int")
    assert {r.url for r in ledger.pending(df, 5).collect()} == {"a", "b"}
    assert tuple(ledger.failure_summary(df, 5).first()) == (3, 2)


def test_timeouts(spark):
    df = spark.createDataFrame([(121.0, None), (5.0, "x"), (120.0, None)], "duration_secs double, error string")
    got = [(r.error, r.timed_out) for r in ledger.with_timeouts(df, 120).collect()]
    assert got == [("timeout after 120.0s", True), ("x", False), (None, False)]


def test_retry_schedule(spark):
    rows = [(1, 1, 429, "7"), (1, 2, 503, None), (1, 3, 500, "9"), (1, 4, 500, None), (1, 5, 500, None), (2, 1, 200, None)]
    df = spark.createDataFrame(rows, "request_id int, attempt int, status int, retry_after string")
    got = [(r.delay_after, r.not_before) for r in requestlog.retry_schedule(df).orderBy("request_id", "attempt").collect()]
    assert got == [(7, 0), (10, 7), (4, 17), (0, 21), (0, 21), (0, 0)]
    backed = requestlog.retry_schedule(df, default_retry_after=None).filter("attempt = 2").first()
    assert backed.delay_after == 2
    exhausted = requestlog.exhausted_requests(df).collect()
    assert [(r.request_id, r.attempts, r.last_status) for r in exhausted] == [(1, 5, 500)]


def test_begin_run(spark):
    schema = "site string, started int, stream_exhausted boolean, pages_exhausted boolean, early_stop boolean, errors long"
    history = spark.createDataFrame([("s", 1, True, True, False, 0)], schema)
    rows = runs.run_modes(runs.begin_run(history, "s", F.lit(2))).orderBy("started").collect()
    assert [(r.started, r.outcome, r.mode, r.next_mode) for r in rows] == [
        (1, "COMPLETED", "resume", "daily"),
        (2, "INTERRUPTED", "daily", "resume"),
    ]
