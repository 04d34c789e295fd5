"""Streams give what batches give, and replays and restarts change nothing."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import ledger, requestlog
from gleanframe.schemas import PAGES, REQUEST_LOG
from gleanframe.session import STATE_STORE
from gleanframe.sources import readers, sinks
from gleanframe.streaming import control, crawl


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def pages(spark, *rows):
    html = '<meta name="crm-id" content="%s"><h1 class="font-extrabold">t%d</h1>'
    return spark.createDataFrame([(n, f"http://s/{n}", html % (pid, n)) for n, pid in rows], PAGES)


def exported(out):
    return lambda spark: sorted(r.property_id for r in readers.read_exported_csv(spark, f"{out}/csv").collect())


def test_crawl_stream(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / name) for name in ("pages", "out", "ckpt"))
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "csv", out), out)
    counters = crawl.ProgressCounters()
    spark.streams.addListener(counters)
    run = lambda checkpoint: crawl.start_export(
        crawl.stream_listings(readers.stream_pages(spark, src, files_per_batch=1)), exporter, checkpoint
    ).awaitTermination(120)
    try:
        put(pages(spark, (1, "a"), (2, "b"), (3, "a")), src)
        put(pages(spark, (4, "b"), (5, "c")), src)
        assert run(ckpt)
        assert exported(out)(spark) == ["a", "b", "c"]
        # goes on where it stopped
        put(pages(spark, (6, "c"), (7, "d")), src)
        assert run(ckpt)
        assert exported(out)(spark) == ["a", "b", "c", "d"]
        # progress lost: every batch is run again, with the same result
        assert run(str(tmp_path / "ckpt2"))
        assert exported(out)(spark) == ["a", "b", "c", "d"]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert counters.totals["scraped"] >= 7
    finally:
        spark.streams.removeListener(counters)


def test_distinct_listings(spark, tmp_path):
    src = str(tmp_path / "pages")
    put(pages(spark, (1, "a"), (2, "a")), src)
    put(pages(spark, (3, "a"), (4, "b")), src)
    listings = crawl.distinct_listings(crawl.stream_listings(readers.stream_pages(spark, src, 1)))
    query = (
        listings.writeStream.format("memory").queryName("distinct_listings")
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert sorted(r.property_id for r in spark.table("distinct_listings").collect()) == ["a", "b"]


def request_rows(seed, n=240):
    draw = random.Random(seed)
    rows, t = [], 0.0
    for seq in range(n):
        t += draw.choice([0.1, 1.0, 8.0])
        error = draw.choice([None, None, "HTTP 503", "timeout", "HTTP 404"])
        rows.append((seq, t, draw.randint(1, 3), f"u{draw.randint(0, 9)}", draw.choice(["crawl", "retry"]), error))
    return rows


def request_log(spark, rows):
    df = spark.createDataFrame(rows, "seq long, t double, host long, url string, phase string, error string")
    full = df.select(
        "seq", F.timestamp_seconds("t").alias("ts"), F.col("host").cast("string").alias("host"), "url", "phase",
        F.lit(None).cast("int").alias("status"), "error", F.lit(1.0).alias("duration_secs"), F.lit(0).alias("worker_id"),
    )
    return full.select(*REQUEST_LOG.names)


def test_ledger_stream_equals_batch(spark, tmp_path):
    rows = request_rows(3)
    src = str(tmp_path / "log")
    for low in range(0, 240, 80):
        put(request_log(spark, rows[low : low + 80]), src)
    table = sinks.LedgerFeed(spark, str(tmp_path / "ledger"))
    stream = spark.readStream.schema(REQUEST_LOG).option("maxFilesPerTrigger", 1).parquet(src)
    for checkpoint in ("ckpt", "ckpt2"):  # the second time all batches are replayed
        assert crawl.start_ledger(stream, table, str(tmp_path / checkpoint)).awaitTermination(120)
        want = {(r.url, r.error, r.attempts) for r in ledger.failure_ledger(request_log(spark, rows)).collect()}
        assert want and {(r.url, r.error, r.attempts) for r in table.read().collect()} == want


def stream_to_memory(spark, df, name, ckpt):
    query = df.writeStream.format("memory").queryName(name).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    assert query.awaitTermination(180)
    return spark.table(name).collect()


def test_early_stop_stream(spark, tmp_path):
    draw = random.Random(5)
    rows = [(crawl_id, seq, f"p{seq}", draw.random() < 0.75) for crawl_id in (1, 2, 3) for seq in range(60)]
    src = str(tmp_path / "marked")
    schema = "crawl_id long, seq long, property_id string, is_known boolean"
    for low in range(0, 60, 20):
        put(spark.createDataFrame([r for r in rows if low <= r[1] < low + 20], schema).orderBy(F.rand(1)), src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = stream_to_memory(spark, control.stop_early(stream, 8), "stopped", str(tmp_path / "ckpt"))
    want = set()
    for crawl_id in (1, 2, 3):
        streak = 0
        for _, seq, _, known in (r for r in rows if r[0] == crawl_id):
            streak = streak + 1 if known else 0
            want.add((crawl_id, seq, streak))
            if streak >= 8:
                break
    assert {(r.crawl_id, r.seq, r.streak) for r in got} == want


def test_admission_stream(spark, tmp_path):
    rows = [(host, seq, t, "success" if e is None else "rate_limited" if "503" in e else "error") for seq, t, host, _, _, e in request_rows(9)]
    src = str(tmp_path / "log")
    schema = "host long, seq long, t double, outcome string"
    for low in range(0, 240, 60):
        put(spark.createDataFrame([r for r in rows if low <= r[1] < low + 60], schema), src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = stream_to_memory(spark, control.admit_requests(stream, 2, 5.0), "admitted", str(tmp_path / "ckpt"))
    state = defaultdict(lambda: [0, 0.0, 1.0])
    want = {}
    for host, seq, t, outcome in sorted(rows, key=lambda r: r[1]):
        s = state[host]
        name = "CLOSED" if s[0] < 2 else "HALF_OPEN" if t - s[1] >= 5.0 else "OPEN"
        if name != "OPEN":
            if outcome == "success":
                s[0], s[2] = 0, max(1.0, s[2] * 0.9)
            else:
                s[0], s[1] = s[0] + 1, t
                s[2] = min(20.0, s[2] * 2) if outcome == "rate_limited" else s[2]
        want[seq] = (name, name != "OPEN", round(s[2], 9))
    assert {r.seq: (r.state, r.admitted, round(r.multiplier, 9)) for r in got} == want
    assert any(not admitted for _, admitted, _ in want.values())
    # where nothing was refused, the batch operator says the same
    batch = spark.createDataFrame(rows, schema).withColumn("failed", F.col("outcome") != "success")
    closed = {r.seq for r in requestlog.circuit_state(batch, 2, 5.0).collect() if r.state == "CLOSED"}
    assert closed


def test_a_batch_writes_only_its_urls(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / name) for name in ("log", "ledger", "ckpt"))
    table = sinks.LedgerFeed(spark, out)
    run = lambda: crawl.start_ledger(spark.readStream.schema(REQUEST_LOG).parquet(src), table, ckpt).awaitTermination(120)
    lost, again, gone = (1, 1.0, 1, "a", "crawl", "timeout"), (2, 2.0, 1, "a", "retry", "HTTP 503"), (5, 5.0, 1, "a", "retry", None)
    put(request_log(spark, [lost, (3, 1.5, 1, "b", "crawl", "timeout"), (4, 1.6, 1, "c", "crawl", None)]), src)
    assert run()
    put(request_log(spark, [again]), src)
    assert run()
    parts = spark.read.parquet(out).groupBy("batch").agg(F.sort_array(F.collect_set("url")).alias("urls")).orderBy("batch").collect()
    assert [r.urls for r in parts] == [["a", "b"], ["a"]]
    assert {(r.url, r.error, r.attempts, r.ts.timestamp()) for r in table.read().collect()} == {("a", "timeout", 2, 1.0), ("b", "timeout", 1, 1.5)}
    put(request_log(spark, [gone]), src)
    assert run()
    assert {r.url for r in table.read().collect()} == {"b"}


def test_daily_stop_inside_the_page_stream(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / name) for name in ("pages", "out", "ckpt"))
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "csv", out), out)
    known = spark.createDataFrame([(f"k{n}",) for n in range(100)], "property_id string")
    run = lambda: crawl.start_export(
        crawl.daily_listings(crawl.stream_listings(readers.stream_pages(spark, src, 1)), known, 1), exporter, ckpt
    ).awaitTermination(120)
    ids = [f"k{n}" for n in range(20)] + ["n1", "n2", "n1"] + [f"k{n}" for n in range(10)]
    put(pages(spark, *list(enumerate(ids))), src)
    assert run()
    # 11 known rows in a row so far, the repeated id among them; the 24th ends the crawl
    more = [f"k{n}" for n in range(12)] + ["n2", "late", "n3"]
    put(pages(spark, *[(100 + n, i) for n, i in enumerate(more)]), src)
    assert run()
    put(pages(spark, (200, "n4")), src)
    assert run()
    assert exported(out)(spark) == ["n1", "n2"]


def test_ids_leave_the_state(spark, tmp_path):
    src = str(tmp_path / "listings")
    schema = "page_id long, property_id string, seen_at timestamp"
    sizes = []
    for hour in range(0, 40, 4):
        rows = [(hour * 10 + n, f"p{hour}-{n // 2}", None) for n in range(8)] + [(hour * 10 + 9, None, None)]
        df = spark.createDataFrame(rows, schema).withColumn("seen_at", F.timestamp_seconds(F.lit(hour * 3600) + F.col("page_id") % 10))
        put(df, src)
        stream = spark.readStream.schema(schema).parquet(src)
        known = spark.createDataFrame([("p8-1",)], "property_id string")
        distinct = crawl.distinct_listings(stream, known, seen_at="seen_at", within="6 hours")
        query = distinct.writeStream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt"))
        query = query.format("parquet").trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted(r.property_id or "" for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted([""] * 10 + [f"p{h}-{n}" for h in range(0, 40, 4) for n in range(4) if (h, n) != (8, 1)])
    # of ten batches with five rows each, three are remembered
    assert max(sizes) <= 15


@pytest.fixture
def default_store(spark):
    """Spark's own state store, as in a session that ``build_session`` did not make."""
    before = spark.conf.get(STATE_STORE)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, default)
    yield default
    spark.conf.set(STATE_STORE, before)


def test_the_daily_stop_works_in_any_session(spark, tmp_path, default_store):
    src, out, ckpt = (str(tmp_path / name) for name in ("pages", "out", "ckpt"))
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "csv", out), out)
    known = spark.createDataFrame([("k",)], "property_id string")
    for part in ([(1, "a"), (2, "k"), (3, "b")], [(4, "k"), (5, "a"), (6, "c")]):
        put(pages(spark, *part), src)
        daily = crawl.daily_listings(crawl.stream_listings(readers.stream_pages(spark, src)), known, 1, threshold=2)
        assert crawl.start_export(daily, exporter, ckpt).awaitTermination(120)
    assert exported(out)(spark) == ["a", "b"]
    assert spark.conf.get(STATE_STORE) == default_store  # the session keeps its own settings


def test_the_ledger_stream_works_in_any_session(spark, tmp_path, default_store):
    rows = request_rows(3)[:60]
    put(request_log(spark, rows), str(tmp_path / "log"))
    table = sinks.LedgerFeed(spark, str(tmp_path / "ledger"))
    stream = spark.readStream.schema(REQUEST_LOG).parquet(str(tmp_path / "log"))
    assert crawl.start_ledger(stream, table, str(tmp_path / "ckpt")).awaitTermination(120)
    want = {(r.url, r.error, r.attempts) for r in ledger.failure_ledger(request_log(spark, rows)).collect()}
    assert want and {(r.url, r.error, r.attempts) for r in table.read().collect()} == want
    assert spark.conf.get(STATE_STORE) == default_store
