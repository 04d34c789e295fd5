"""Dedup, state, merge, metrics, readers, sinks and whole jobs."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from gleanframe.operators import dedup, metrics
from gleanframe.operators.upsert import upsert_merge
from gleanframe.plans import jobs
from gleanframe.schemas import EXPORT_COLUMNS, FAILURE_LEDGER
from gleanframe.sources import readers, sinks


def ids(df):
    return sorted((r.property_id for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def records(spark):
    rows = [("a", 1), (None, 2), ("b", 3), ("a", 4), ("", 5), (None, 6)]
    return spark.createDataFrame(rows, "property_id string, seq int")


def known(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "property_id string")


def test_new_and_known(spark, records):
    assert ids(dedup.new_records(records, known(spark, "a"))) == ["", None, None, "b"]
    assert ids(dedup.known_records(records, known(spark, "a", "z"))) == ["a", "a"]
    assert ids(dedup.new_ids(records.filter("property_id <> ''"), known(spark, "a"))) == ["b"]


def test_keep_first_treats_missing_ids_as_one(records):
    kept = {(r.property_id, r.seq) for r in dedup.dedup_keep_first(records, "property_id", ["seq"]).collect()}
    assert kept == {("a", 1), (None, 2), ("b", 3), ("", 5)}
    assert tuple(dedup.duplicate_report(records, "property_id").first()) == (2, 6, 4)


def test_first_in_run(spark, records):
    runs = records.withColumn("run_id", F.lit(1))
    got = {(r.property_id, r.seq) for r in dedup.run_new_records(runs, known(spark, "b"), ["seq"]).collect()}
    assert got == {("a", 1), (None, 2), ("", 5), (None, 6)}


def test_state(spark):
    schema = "key string, value_json string, updated_at int"
    state = spark.createDataFrame([("exported:1", "true", 1), ("other:3", "1", 1)], schema)
    changes = spark.createDataFrame([("exported:1", "false", 2), ("exported:2", "true", 2), ("exported:2", "null", 3)], schema)
    after = dedup.state_upsert(state, changes)
    assert {(r.key, r.value_json) for r in after.collect()} == {("exported:1", "false"), ("exported:2", "null"), ("other:3", "1")}
    assert {r.key for r in dedup.state_prefix(after, "exported:").collect()} == {"exported:1", "exported:2"}
    tied = spark.createDataFrame([("exported:1", "\"b\"", 1, 7), ("exported:1", "\"a\"", 1, 9), ("other:3", "9", 0, 1)], schema + ", seq int")
    for order, want in ((None, "\"b\""), ("seq", "\"a\"")):
        settled = dedup.state_upsert(state, tied, sequence=order)
        assert settled.columns == state.columns
        assert {(r.key, r.value_json) for r in settled.collect()} == {("exported:1", want), ("other:3", "1")}
    gone = spark.createDataFrame([("exported:1",), ("none",)], "key string")
    assert {r.key for r in dedup.state_delete(after, gone).collect()} == {"exported:2", "other:3"}
    assert {r.key for r in dedup.state_lookup(after, gone).collect()} == {"exported:1"}


def test_upsert(spark):
    columns = ["property_id", "title", "floor", "price"]
    table = spark.createDataFrame([("1", "old", "f1", 1.0, 100), ("2", "two", "f2", 2.0, 100)], "property_id string, title string, floor string, price double, scraped_at int")
    batch = spark.createDataFrame(
        [("1", "first", None, None, 1), ("1", None, None, None, 2), ("3", "new", None, None, 3)],
        "property_id string, title string, floor string, price double, seq int",
    )
    got = sorted(tuple(r) for r in upsert_merge(table, batch, ["seq"], F.lit(200), columns).collect())
    assert got == [("1", None, "f1", 1.0, 100), ("2", "two", "f2", 2.0, 100), ("3", "new", None, None, 200)]
    with pytest.raises(ValueError):
        upsert_merge(table, batch.withColumn("property_id", F.lit(None).cast("string")), ["seq"], F.lit(1), columns)


def test_metrics(spark):
    rows = [("counter", "a", {"w": "1"}, 1.0, 1), ("counter", "a", {"w": "1"}, 2.0, 2), ("gauge", "g", None, 5.0, 3), ("gauge", "g", None, 4.0, 1)]
    df = spark.createDataFrame(rows, "kind string, name string, labels map<string,string>, value double, seq int")
    got = {(r.kind, r.key, r.value) for r in metrics.snapshot(df, ["seq"]).collect()}
    assert got == {("counter", "a{w=1}", 3.0), ("gauge", "g", 5.0)}


def test_worker_stats(spark):
    rows = [(1, None, 2.0), (1, "timeout", 9.0), (1, "HTTP 404", 1.0), (2, None, 3.0)]
    df = spark.createDataFrame(rows, "worker_id int, error string, duration_secs double")
    assert sorted(tuple(r) for r in metrics.worker_stats(df).collect()) == [(1, 1, 2, 1, 2.0), (2, 1, 0, 0, 3.0)]


# --- readers ---------------------------------------------------------------------------


def test_ledger_file(spark, tmp_path):
    entry = {"error": "e", "attempts": 1, "timestamp": "2024-01-02T03:04:05.5+00:00"}
    path = tmp_path / "failed.json"
    path.write_text(json.dumps([{"url": "u", **entry}, {"url": "v", **entry}, {"url": "u", **entry, "attempts": 3}], indent=2))
    got = readers.read_failure_ledger(spark, str(path))
    assert {(r.url, r.attempts) for r in got.collect()} == {("u", 3), ("v", 1)}
    assert got.select(F.unix_millis("ts").alias("t")).first().t == 1704164645500
    for bad in ("[{", json.dumps([{"url": "u"}, {"error": "no url"}]), "[]", ""):
        path.write_text(bad)
        assert readers.read_failure_ledger(spark, str(path)).count() == 0
    assert readers.read_failure_ledger(spark, str(tmp_path / "none.json")).count() == 0


def test_checkpoint_file(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(json.dumps({"exported:1": True, "last": "C-1", "n": {"a": [1]}}))
    got = {r.key: json.loads(r.value_json) for r in readers.read_checkpoint(spark, str(path)).collect()}
    assert got == {"exported:1": True, "last": "C-1", "n": {"a": [1]}}
    path.write_text("{broken")
    assert readers.read_checkpoint(spark, str(path)).count() == 0
    assert readers.read_checkpoint(spark, str(tmp_path / "none")).count() == 0


def test_log_lines(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"ts": "t", "level": "INFO", "msg": "m", "worker": 3}\nnot json\n')
    rows = readers.read_log_lines(spark, str(path)).collect()
    assert rows[0].level == "INFO" and rows[0].extra == {"worker": "3"} and rows[0].exc is None
    assert len(rows) == 2 and rows[1].msg is None


# --- sinks -----------------------------------------------------------------------------


def listings(spark, *rows):
    data = [{"property_id": p, "url": f"u{i}", "title": t, "price": 1.5, "_order": i} for i, (p, t) in enumerate(rows)]
    return spark.createDataFrame(data, "property_id string, url string, title string, price double, _order int")


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = listings(spark, ("1", 'a "quoted",\nline'), ("2", None))
    sinks.write_csv(rows, path)
    sinks.write_csv(listings(spark, ("3", "é")), path)
    lines = [line for part in sorted((tmp_path / "csv").glob("*.csv")) for line in part.read_text().splitlines()]
    header = ",".join(f'"{name}"' for name in EXPORT_COLUMNS)
    assert lines.count(header) == len(list((tmp_path / "csv").glob("*.csv")))
    assert any(line.startswith('"2","u1","","1.5","",') for line in lines)
    got = {r.property_id: (r.title, r.price, r.images) for r in readers.read_exported_csv(spark, path).collect()}
    assert got == {"1": ('a "quoted",\nline', 1.5, None), "2": (None, 1.5, None), "3": ("é", 1.5, None)}


def test_json_lines(spark, tmp_path):
    sinks.write_json_lines(listings(spark, ("1", "é")), str(tmp_path / "json"))
    (line,) = [line for part in (tmp_path / "json").glob("*.json") for line in part.read_text().splitlines()]
    assert '"é"' in line and json.loads(line) == {name: None for name in EXPORT_COLUMNS} | {"property_id": "1", "url": "u0", "title": "é", "price": 1.5}


def test_snapshot_versions(spark, tmp_path):
    table = sinks.ledger_table(spark, str(tmp_path / "ledger"))
    row = lambda n: spark.createDataFrame([("u", "e", n, None)], FAILURE_LEDGER)
    assert table.read().count() == 0
    table.replace(row(1), "b1")
    table.replace(row(2), "b2")
    assert table.read().first().attempts == 2 and table.read(before_tag="b2").first().attempts == 1
    table.clear()
    assert table.read().count() == 0


def test_ledger_json(spark, tmp_path):
    path = str(tmp_path / "ledger")
    stamp = datetime.datetime(2024, 1, 2, 3, 4, 5, 500000, tzinfo=datetime.timezone.utc)
    rows = spark.createDataFrame([("u", "é", 2, stamp), ("v", "e", 1, stamp)], FAILURE_LEDGER).coalesce(1)
    sinks.write_ledger_json(rows, path)
    line, _ = [line for part in (tmp_path / "ledger").glob("*.json") for line in part.read_text().splitlines()]
    assert json.loads(line) == {"url": "u", "error": "é", "attempts": 2, "timestamp": "2024-01-02T03:04:05.500000+00:00"}
    read = readers.read_failure_ledger(spark, path, lines=True).collect()
    assert {(r.url, r.ts.timestamp()) for r in read} == {("u", stamp.timestamp()), ("v", stamp.timestamp())}


def test_export_contract(spark, tmp_path):
    out = str(tmp_path)
    fail = {"on": True}

    def broken(rows, tag):
        if fail["on"]:
            raise RuntimeError("down")
        sinks.write_json_lines(rows, f"{out}/late/batch={tag}", "overwrite")

    exporter = sinks.Exporter(spark, {**sinks.build_sinks(spark, "csv, json, table", out), "broken": broken}, out)
    batch = listings(spark, ("1", "a"), ("2", "b"), ("2", "c"))
    assert exporter.export(batch, "0001") == {"csv": 3, "json": 3, "table": 3, "broken": None}
    # the same batch again leaves everything as it was
    assert exporter.export(batch, "0001") == {"csv": 3, "json": 3, "table": 3, "broken": None}
    fail["on"] = False
    assert exporter.export(listings(spark, ("1", "x"), ("3", "d")), "0002") == {"csv": 1, "json": 1, "table": 1, "broken": 2}
    assert readers.read_exported_csv(spark, f"{out}/csv").count() == 4
    table = sinks.ListingTable(spark, f"{out}/table").read()
    assert {(r.property_id, r.title) for r in table.collect()} == {("1", "a"), ("2", "c"), ("3", "d")}
    assert exporter.export(batch.limit(0), "0003") == {"csv": 0, "json": 0, "table": 0, "broken": 0}
    only = sinks.Exporter(spark, {"broken": broken}, f"{out}/only")
    fail["on"] = True
    with pytest.raises(RuntimeError):
        only.export(batch, "0001")
    assert only.known("broken").count() == 0


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    table = sinks.ListingTable(spark, str(tmp_path), buckets=8)
    rows = listings(spark, *[(f"p{n}", "a") for n in range(40)])
    table(rows, "1")
    before = {r.f for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()}
    table(listings(spark, ("p3", "b"), (None, "x"), ("", "y")), "2")
    after = {r.f for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(after - before) == 1 and len(before & after) >= 5
    assert {(r.property_id, r.title) for r in table.read().collect()} == {(f"p{n}", "b" if n == 3 else "a") for n in range(40)}
    assert sorted(r.title for r in table.set_aside().collect()) == ["x", "y"]
    # the same batch again, then one with nothing but rows without id
    table(listings(spark, ("p3", "b"), (None, "x"), ("", "y")), "2")
    table(listings(spark, (None, "z")), "3")
    assert table.read().count() == 40 and sorted(r.title for r in table.set_aside().collect()) == ["x", "y", "z"]


def test_corrupt_lines_of_an_export(spark, tmp_path):
    sinks.write_json_lines(listings(spark, ("1", "a")), str(tmp_path / "json"))
    (tmp_path / "json" / "more.json").write_text('{"property_id": "2", "price": 3}\n{"property_id": \n')
    got = {(r.property_id, r.price, r.bad) for r in readers.read_exported_json(spark, str(tmp_path / "json"), corrupt="bad").collect()}
    assert got == {("1", 1.5, None), ("2", 3.0, None), (None, None, '{"property_id": ')}
    assert readers.read_exported_json(spark, str(tmp_path / "none")).count() == 0


def test_a_run_that_dies_makes_the_next_one_resume(spark, tmp_path):
    out = str(tmp_path)

    def broken(rows, tag):
        raise RuntimeError("down")

    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([page(n, f"p{n}") for n in range(3)], schema)
    good = sinks.Exporter(spark, sinks.build_sinks(spark, "json", out), out)
    run = lambda exporter, run_id, at: jobs.crawl_run(pages, exporter, exporter.known(next(iter(exporter.sinks))), run_id, runs_path=f"{out}/runs", started=at, ended=at + 2)
    assert run(good, "r1", 1.0)["next_mode"] == "daily"
    with pytest.raises(RuntimeError):
        run(sinks.Exporter(spark, {"broken": broken}, f"{out}/broken"), "r2", 2.0)
    assert run(good, "r3", 3.0)["mode"] == "resume"
    rows = {r.run_id: r for r in jobs.read_runs(spark, f"{out}/runs").collect()}
    assert [(rows[k].outcome, rows[k].elapsed_secs) for k in ("r1", "r2", "r3")] == [("COMPLETED", 2.0), ("INTERRUPTED", None), ("COMPLETED", 2.0)]
    assert (rows["r1"].stream_exhausted, rows["r1"].pages_exhausted, rows["r1"].early_stop, rows["r1"].errors) == (True, True, False, 0)


def test_sink_names(spark, tmp_path):
    assert list(sinks.build_sinks(spark, ["CSV", "json"], str(tmp_path))) == ["csv", "json"]
    for names in ("csv,nope", "", []):
        with pytest.raises(ValueError):
            sinks.build_sinks(spark, names, str(tmp_path))


# --- jobs ------------------------------------------------------------------------------


def page(n, pid):
    mark = f'<meta name="crm-id" content="{pid}">' if pid else ""
    return (n, f"http://s/{n}?utm_id=1", f'{mark}<h1 class="font-extrabold">t{n}</h1>')


def test_crawl_runs(spark, tmp_path):
    out = str(tmp_path)
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "json", out), out)
    schema = "page_id long, url string, html string"
    first = spark.createDataFrame([page(n, f"p{n}") for n in range(30)] + [page(30, "p1"), page(31, None)], schema)
    report = jobs.crawl_run(first, exporter, exporter.known("json"), "r1")
    assert (report["outcome"], report["next_mode"], report["scraped"], report["skipped"]) == ("COMPLETED", "daily", 32, 1)
    assert report["exported"] == {"json": 31}
    again = spark.createDataFrame([page(n, f"q{n}") for n in range(4)] + [page(n, f"p{n - 4}") for n in range(4, 34)], schema)
    daily = jobs.crawl_run(again, exporter, exporter.known("json"), "r2", mode="daily")
    assert (daily["outcome"], daily["scraped"], daily["skipped"], daily["exported"]) == ("EARLY_STOP", 28, 24, {"json": 4})
    resumed = jobs.crawl_run(again, exporter, exporter.known("json"), "r3", pages_exhausted=False)
    assert (resumed["outcome"], resumed["next_mode"], resumed["exported"]) == ("INTERRUPTED", "resume", {"json": 0})


def test_known_urls_are_not_read(spark):
    pages = spark.createDataFrame([page(1, "a"), page(2, "b")], "page_id long, url string, html string")
    known = spark.createDataFrame([("http://s/1",)], "url string")
    kept = jobs.clean_listings(jobs.unseen_pages(pages, known))
    assert [r.property_id for r in kept.collect()] == ["b"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Join")  # the join runs first


def test_retry_run(spark, tmp_path):
    out = str(tmp_path)
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "json", out), out)
    exporter.export(listings(spark, ("old", "x")), "0000")
    ledger = sinks.ledger_table(spark, f"{out}/ledger")
    entries = [("u1", "timeout", 1), ("u2", "timeout", 5), ("u3", "timeout", 1), ("u4", "timeout", 6), ("u5", "timeout", 1), ("u6", "timeout", 2)]
    ledger.replace(spark.createDataFrame([(*e, None) for e in entries], FAILURE_LEDGER), "crawl")
    results = spark.createDataFrame(
        [("u1", "new", None), ("u2", None, "HTTP 503"), ("u3", None, "HTTP 404"), ("u4", "late", None), ("u5", "old", None)],
        "url string, property_id string, error string",
    )
    for _ in range(2):  # a second try of the same run changes nothing
        report = jobs.retry_run(ledger, results, exporter, "retry1").first().asDict()
        assert report == {"retried": 5, "skipped": 1, "succeeded": 2, "exported": 1, "failed_retryable": 1, "failed_permanent": 1, "remaining": 1}
        assert {(r.url, r.attempts) for r in ledger.read().collect()} == {("u2", 6), ("u4", 6), ("u6", 2)}
    assert sorted(r.property_id for r in exporter.known("json").collect()) == ["new", "old"]


def test_dedup_export(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_csv(listings(spark, ("00123", "a"), ("123", "b"), (None, "c"), (None, "d"), ("123", "e")).coalesce(1), source)
    assert tuple(jobs.dedup_export(spark, source, target).first()) == (2, 5, 3)
    got = {(r.property_id, r.title) for r in readers.read_exported_csv(spark, target).collect()}
    assert got == {("00123", "a"), ("123", "b"), (None, "c")}
