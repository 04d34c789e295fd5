"""Cases at the edges of runs, streams, walks and retries."""

from gleanframe.operators import links, quality, requestlog, runs
from gleanframe.plans import jobs
from gleanframe.sources import sinks


def test_stop_on_the_last_row_is_a_hit(spark):
    rows = [("r", i, True) for i in range(24)]
    marked = spark.createDataFrame(rows, "run_id string, seq int, is_known boolean")
    examined = runs.early_stop(marked, ["seq"], hit_name="stops").collect()
    assert len(examined) == 24 and [r.seq for r in examined if r.stops] == [23]


def test_a_success_after_the_limit_is_not_exhausted(spark):
    rows = [(1, n, 200 if n == 6 else 500) for n in range(1, 7)] + [(2, n, 500) for n in range(1, 8)]
    attempts = spark.createDataFrame(rows, "request_id int, attempt int, status int")
    assert [(r.request_id, r.attempts) for r in requestlog.exhausted_requests(attempts).collect()] == [(2, 7)]


def test_repeated_pages_and_unfetched_starts(spark):
    nexts = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c"), ("b", "c"), ("c", None)], "url string, next_url string")
    starts = spark.createDataFrame([(1, "a"), (1, "a"), (2, "lost")], "crawl_id int, url string")
    walk = links.page_walk(starts, nexts)
    assert sorted((r.crawl_id, r.page_no, r.url) for r in walk.collect()) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c")]
    summary = links.walk_summary(walk, nexts, starts=starts).collect()
    assert sorted((r.crawl_id, r.pages, r.pages_exhausted) for r in summary) == [(1, 3, True), (2, 0, False)]


def test_drift_keeps_multiplicities(spark):
    now = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    before = spark.createDataFrame([(1, "a"), (3, "c"), (3, "c")], "id int, v string")
    got = sorted((r.id, r.v, r.side) for r in quality.extraction_drift(now, before).collect())
    assert got == [(1, "a", "now"), (2, None, "now"), (3, "c", "before"), (3, "c", "before")]


def test_runs_table_gives_the_next_mode(spark, tmp_path):
    out, runs_path = str(tmp_path), f"{tmp_path}/runs"
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "json", out), out)

    def pages(ids):
        mark = '<meta name="crm-id" content="{}"><h1 class="font-extrabold">t</h1>'
        return spark.createDataFrame([(n, f"http://s/{i}", mark.format(i)) for n, i in enumerate(ids)], "page_id long, url string, html string")

    first = jobs.crawl_run(pages([f"p{n}" for n in range(24)]), exporter, exporter.known("json"), "r1", runs_path=runs_path, started=1.0, ended=5.5)
    assert (first["mode"], first["outcome"], first["last_exported_id"], first["elapsed_secs"]) == ("resume", "COMPLETED", "p23", 4.5)
    # all known, and the 24th is the last row: still an early stop
    again = jobs.crawl_run(pages([f"p{n}" for n in range(24)]), exporter, exporter.known("json"), "r2", pages_exhausted=False, runs_path=runs_path, started=2.0)
    assert (again["mode"], again["outcome"], again["next_mode"]) == ("daily", "EARLY_STOP", "daily")
    assert sorted(r.run_id for r in jobs.read_runs(spark, runs_path).collect()) == ["r1", "r2"]


def test_idless_listings_pass_a_stream(spark):
    from gleanframe.streaming.crawl import distinct_listings

    rows = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "")], "page_id int, property_id string")
    assert sorted(r.property_id or "" for r in distinct_listings(rows).collect()) == ["", "", "", "a"]
