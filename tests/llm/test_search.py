"""Url filters, importance resampling and ranked search on small made cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gleanframe.llm import linktrust as lt
from gleanframe.llm import ranking, resample
from gleanframe.llm.search_queries import RULES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def verdicts(spark, rows, rules=RULES, schema="page_id long, url string, html string", **options):
    return lt.filter_urls(spark.createDataFrame(rows, schema), rules, **options)


def test_rules_hosts_and_paths(spark):
    urls = {
        1: ("http://A.example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        4: ("x://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
        5: ("x://b.com:80/fr/", "b.com:80", "/fr/", None, "allow"),
        6: ("x://b.com/fr", "b.com", "/fr", None, "block"),
        7: ("x://b.com?/fr/", "b.com", "", None, "block"),
        8: ("x://b.com/de/a", "b.com", "/de/a", "com/de/", "block"),
        9: ("no scheme/org/", "", "", None, "allow"),
        10: (None, "", "", None, "allow"),
        11: ("://org/a\nb", "org", "/a\nb", "org/", "allow"),
        12: ("", "", "", None, "allow"),
    }
    got = verdicts(spark, [(i, u[0], None) for i, u in urls.items()])
    assert {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in got.collect()} == {
        i: u[1:] for i, u in urls.items()
    }


def link(*hosts):
    return " ".join(f"<a class=x HREF = 'https://{h}/p'>t</a>" for h in hosts)


def brute_ranks(edges, seeds, rounds):
    out = {}
    for kind, pairs in (("trust", edges), ("distrust", {(b, a) for a, b in edges})):
        degree = Counter(a for a, _ in pairs)
        seed = {h: s[kind] for h, s in seeds.items() if s[kind]}
        ranks = dict(seed)
        for _ in range(rounds):
            new = Counter({h: 15 * r // 100 for h, r in seed.items()})
            for a, b in pairs:
                if a in ranks:
                    new[b] += 85 * (ranks[a] // degree[a]) // 100
            ranks = new
        out[kind] = ranks
    return out


def test_propagation_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lt, "GROUP", 3)
    hosts = [f"h{k}.net" for k in range(30)]
    edges = {(hosts[a], hosts[b]) for a in range(30) for b in range(30) if a != b and (a * 7 + b * 3) % 11 == 0}
    edges |= {(hosts[0], h) for h in hosts[1:]} | {(h, hosts[1]) for h in hosts[2:]}
    seeds = {hosts[0]: {"trust": 90, "distrust": 10}, hosts[5]: {"trust": 0, "distrust": 10**8}, hosts[9]: {"trust": 10**8, "distrust": 0}}
    links = spark.createDataFrame(sorted(edges), "a string, b string")
    rows = spark.createDataFrame([(h, s["trust"], s["distrust"]) for h, s in seeds.items()], "host string, trust long, distrust long")
    want = brute_ranks(edges, seeds, 7)
    got = {r["host"]: (r["trust"], r["distrust"]) for r in lt.propagate(links, rows, rounds=7).collect()}
    assert got == {h: (want["trust"].get(h, 0), want["distrust"].get(h, 0)) for h in want["trust"] | want["distrust"]}


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rules = [lt.UrlRule("good.net", "/", "allow"), lt.UrlRule("bad.net", "/", "block")]
    rows = [
        (1, "http://good.net/", link("friend.net", "good.net")),
        (2, "http://friend.net/", link("third.net")),
        (3, "http://third.net/", ""),
        (4, "http://bad.net/", link("victim.net")),
        (5, "http://victim.net/", None),
        (6, "http://farm.net/", link("BAD.net", "friend.net")),
        (7, "http://feeder.net/", "<a href=//farm.net>x</a>"),
        (8, "http://alone.net/", "<a href='/local'>x</a> <a href='mailto:a@b'>x</a>"),
        (9, "http://blog.farm.net/", ""),
        (9, "http://blog.farm.net/", ""),
        (None, "http://feeder.net/", None),
    ]
    got = Counter((r["page_id"], r["verdict"]) for r in verdicts(spark, rows, rules).collect())
    allowed, blocked = {1, 2, 3, 5, 8}, {4, 6, 7, None}
    assert got == Counter({(i, "allow"): 1 for i in allowed}) + Counter({(i, "block"): 1 for i in blocked}) + Counter({(9, "block"): 2})


def test_url_filters_edges(spark, monkeypatch):
    schema = "page_id long, url string, html string, host string, verdict int, ruled int, part int"
    empty = verdicts(spark, [], schema=schema)
    assert empty.count() == 0 and empty.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    monkeypatch.setattr(lt, "HEAVY", 3)
    rows = [(k, f"http://{'hub' if k % 2 else f'x{k}'}.net/", link(*[f"y{j}.net" for j in range(40)]), "clash", 1, 2, 3) for k in range(30)]
    rows.append((99, "http://bad.net/", link("hub.net"), None, None, None, None))
    rows.append((98, "http://hub.net/", link("bad.net") * 500, None, None, None, None))
    got = {r["page_id"]: r["verdict"] for r in verdicts(spark, rows, [lt.UrlRule("bad.net", "/", "block")], schema).collect()}
    assert got == {k: "block" if k % 2 or k >= 98 else "allow" for k in [*range(30), 98, 99]}
    with pytest.raises(ValueError):
        verdicts(spark, rows, [lt.UrlRule("a", "/", "allow"), lt.UrlRule("a", "/", "block")], schema)


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(docs, target, percent=5, min_words=20):
    s, t = Counter(f for _, x in docs for f in features(x)), Counter(f for x in target for f in features(x))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000) / ((s[b] + 1.0) * (T + 10000))))
    rows = []
    for i, x in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, features(x)))
        rows.append((i, len(features(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((-r[3], r[0] is None, r[0] or 0, k) for k, r in enumerate(rows) if len(words(docs[k][1])) >= min_words)
    rank = {k: n for n, (*_, k) in enumerate(long[: percent * len(long) // 100], 1)}
    return Counter((*r, rank.get(k)) for k, r in enumerate(rows))


def corpus(n, seed=1):
    draw = np.random.default_rng(seed)
    names = [f"W{k}é" if k % 9 == 0 else f"w{k}" for k in range(60)]
    return [(int(k), " ".join(draw.choice(names, size=draw.integers(0, 60)))) for k in range(n)]


def test_resample_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resample, "LAST_KEYS", 5)
    monkeypatch.setattr(resample, "PART_KEYS", 16)
    monkeypatch.setattr(resample, "SLICE", 7)
    docs = corpus(300) + [(7, corpus(300)[7][1])] * 40 + [(None, " ".join(["w1"] * 30)), (900, None), (901, ""), (902, "-- ..\n")]
    docs += [(903, "ß" * 70_000 + " w2" * 20_000)]
    df = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in docs], "doc_id long, text string, k1 int, rank int, side int")
    target = [x for _, x in corpus(20, seed=5)] + [None]
    got = resample.resample(df.repartition(5), spark.createDataFrame([(x,) for x in target], "text string"), percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(docs, target, percent=30)


def test_resample_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert resample.resample(docs, target).count() == 0
    few = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r["n_features"], r["weight"], r["rank"]) for r in resample.resample(few, target).collect()][0][::2] == (3, None)


def test_cutoff_is_exact_for_every_rank_and_any_ties(spark, monkeypatch):
    monkeypatch.setattr(resample, "LAST_KEYS", 2)
    monkeypatch.setattr(resample, "PART_KEYS", 9)
    draw = np.random.default_rng(3)
    rows = [(int(draw.integers(0, 6)), False, f"id{draw.integers(0, 12)}") for _ in range(120)]
    keys = spark.createDataFrame(rows, "k1 long, k2 boolean, k3 string").repartition(6).cache()
    for wanted in (1, 2, 59, 60, 119, 120):
        assert resample.cutoff(keys, wanted) == sorted(rows)[wanted - 1]
    assert resample.cutoff(keys, 0) is None and resample.cutoff(keys, 121) is None


def brute_rank(docs, items, top=20):
    terms = [(i, words(x)) for i, x in docs]
    n, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    wanted = {}
    for i, x in items:
        wanted.setdefault(i, Counter()).update(words(x))
    out = Counter()
    for item, q in wanted.items():
        rows = []
        for i, w in terms:
            tf, score = Counter(w), 0
            for t in q.keys() & tf.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += q[t] * weight * (10**9 * tf[t] // (1000 * tf[t] + 12 * (75 + 25 * len(w) * n // total)))
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out.update((item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(rows)[:top], 1))
    return out


@pytest.mark.parametrize("at_once", [200_000, 10])
def test_ranking_against_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(ranking, "BLOCK", 50)
    docs = corpus(230, seed=9) + [(3, corpus(230, seed=9)[3][1])] * 30 + [(None, "w1 w2 W3"), (500, None), (501, ""), (502, "..")]
    docs += [(600, " ".join(f"u{k}" for k in range(150))), (601, "w5 " * 30_000)]
    items = [(1, "w1 w2 w2 W9é"), (2, None), (3, ""), (4, " ".join(f"u{k} w{k}" for k in range(120))), (5, "nowhere"), (1, "w5"), (None, "w7 w8")]
    df = spark.createDataFrame([(i, x, 0, "x") for i, x in docs], "doc_id long, text string, item int, score string").repartition(3)
    got = ranking.rank_documents(df, spark.createDataFrame(items, "item_id long, text string"), query_terms_at_once=at_once)
    assert Counter(map(tuple, got.collect())) == brute_rank(docs, items)


def test_ranking_empty_tables(spark):
    docs, items = "doc_id string, text string", "item_id string, text string"
    some = spark.createDataFrame([("a", "x y")], docs)
    one = spark.createDataFrame([("q", "y")], items)
    assert ranking.rank_documents(spark.createDataFrame([], docs), one).count() == 0
    assert ranking.rank_documents(some, spark.createDataFrame([], items)).count() == 0
    assert [r[:3] for r in ranking.rank_documents(some, one).collect()] == [("q", 1, "a")]


def test_masks_end_the_search_early():
    import pyarrow as pa

    draw = np.random.default_rng(4)
    rows = [sorted(set(draw.integers(0, 40, size=8).tolist())) for _ in range(4_000)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(len(rows))), "n": [10] * len(rows), "at": rows, "tf": [[1] * len(r) for r in rows]},
        schema=pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]),
    )
    weight = np.arange(100, 140)
    query = (np.arange(12), np.ones(12, np.int64))
    best, scored = ranking._search(ranking._blocks([batch]), [query], weight, 4_000, 40_000, 20)
    assert len(best[0]) == 20 and scored < 400
