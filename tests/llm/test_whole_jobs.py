"""Cases in which an operator once did less than the whole job."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanframe.llm import jaccard, licenses, lines, packing, pii
from gleanframe.llm.base import stored

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted."
APACHE = "Licensed under the Apache License, Version 2.0."
CC = "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0."


def test_bundle_of_licences_keeps_all_labels(spark):
    bundle = "\n".join([MIT, BSD, APACHE, CC, "GNU Lesser General Public License", "All rights reserved"])
    common = [(i, "This work is licensed under a license, version 1, see the Apache notice, cc all.") for i in range(1, 30)]
    docs = spark.createDataFrame([(0, bundle), *common], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(docs).collect()}
    assert got[0] == "apache,bsd,cc-by,cc-by-nc,cc-by-sa,gpl,lgpl,mit,reserved"
    assert {got[i] for i, _ in common} == {""}


def test_near_copies_with_repeated_ids_leave_one_row_of_each_component(spark):
    near = " ".join(f"w{k}" for k in range(60))
    close, unique, lost = near + " more", " ".join(f"u{k}" for k in range(60)), " ".join(f"n{k}" for k in range(60))
    rows = [(1, near), (2, close), (2, unique), (3, unique + " x"), (4, "equal words of one row twice over"), (4, "equal words of one row twice over")]
    rows += [(None, lost), (None, lost + " more"), (None, lost), (None, close), (5, ""), (5, ""), (None, None), (6, "few")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
    losts = [kept.pop((None, text), 0) for text in (lost, lost + " more")]
    assert sum(losts) == 1
    assert kept == {(1, near): 1, (2, unique): 1, (4, rows[4][1]): 1, (5, ""): 2, (None, None): 1, (6, "few"): 1}


def test_program_covers_every_length_by_itself():
    draw = random.Random(3)
    lengths = [min(2047, 1 + int(draw.expovariate(1 / 500))) for _ in range(20_000)]
    histogram = dict(Counter(lengths))
    covered = Counter()
    configs = packing.solve(histogram, 2048)
    for copies, config in configs:
        assert sum(n * c for n, c in config.items()) <= 2048
        for n, c in config.items():
            covered[n] += int(copies) * c
    assert len(histogram) > 1000 and covered == histogram
    assert sum(copies for copies, _ in configs) <= 1.002 * sum(lengths) / 2048 + 1


def near_copies(n, words=60, seed=5):
    """Edits of edits: each copy links to some others, but few link to any one."""
    draw = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    texts = [base]
    for k in range(1, n):
        copy = list(texts[draw.randrange(max(0, k - 8), k)])
        copy[draw.randrange(words)] = f"e{k}"
        texts.append(copy)
    return [(k, " ".join(t)) for k, t in enumerate(texts)]


def test_candidates_grow_with_a_group_of_near_copies_and_not_with_its_square(spark, monkeypatch):
    made = Counter()

    def counted(df, name):
        out = stored(df, name)
        made[name] += out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    rows = {}
    for n in (150, 600):
        made.clear()
        docs = near_copies(n)
        got = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
        sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in docs]
        want = list(range(n))
        for i in range(n):
            for j in range(i):
                if want[i] != want[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = sorted((want[i], want[j]))
                    want = [a if w == b else w for w in want]
        assert [r["component_id"] for r in sorted(got)] == want
        rows[n] = made["leader-pairs"] + made["tree-pairs"]
    assert rows[600] < 8 * rows[150] and rows[600] < 600 * 30


def test_jaccard_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 1, 2, 3, 4), (2, "a b c d e f", 1, 2, 3, 4), (3, None, 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, i int, rep int, label int, mark int")
    assert sorted(map(tuple, jaccard.jaccard_components(docs).collect())) == [(1, 2, 1), (2, 2, 1), (3, 0, 3)]


def test_program_in_fractions_and_its_bound():
    draw = random.Random(9)
    for size in (1, 40, 5_000):
        histogram = dict(Counter(min(2047, 1 + int(draw.expovariate(1 / 400))) for _ in range(size)))
        uses, bound = packing.cover(histogram, 2048, whole=False)
        covered = Counter()
        for key, x in uses.items():
            assert sum(n * c for n, c in key) <= 2048
            for n, c in key:
                covered[n] += x * c
        assert all(abs(covered[n] - c) < 1e-6 for n, c in histogram.items())
        assert bound <= sum(uses.values()) + 1e-6
        whole = sum(copies for copies, _ in packing.solve(histogram, 2048))
        assert bound - 1e-6 <= whole <= 1.02 * bound + 2
        if size == 5_000:
            assert sum(uses.values()) <= 1.002 * bound


def line_batches(spark, n=4):
    draw = random.Random(2)
    batches = [[(draw.randrange(40), 0, 100 * k + j) for j in range(60)] for k in range(n)]
    return batches, [spark.createDataFrame(b, "h1 long, h2 int, doc_id long") for b in batches]


def test_each_line_has_one_entry_in_the_runs(spark):
    batches, frames = line_batches(spark)
    runs, fanout = lines.LineRuns(spark, 2), 2
    try:
        for k, frame in enumerate(frames):
            runs.add(frame)
            entries = [r["h1"] for names in runs.levels for name in names for r in spark.table(name).collect()]
            assert sorted(entries) == sorted({h for b in batches[: k + 1] for h, _, _ in b})
            assert all(len(names) < fanout for names in runs.levels)
        count, last = Counter(h for b in batches for h, _, _ in b), {h: d for b in batches for h, _, d in sorted(b, key=lambda r: r[2])}
        got = {r["h1"]: r["last"] for r in runs.frequent(6).collect()}
        assert got == {h: last[h] for h in count if count[h] >= 6}
        assert len(runs.levels) > 1 and runs.updates
    finally:
        runs.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_counts_are_wrong_without_the_anti_join(spark, monkeypatch):
    """The runs decide: entries that do not keep out known lines change the result."""
    _, frames = line_batches(spark, 2)
    join = type(frames[0]).join
    for kind in ("left_anti", "left_semi"):
        right, wrong = lines.LineRuns(spark), lines.LineRuns(spark)
        for frame in frames:
            right.add(frame)
            with monkeypatch.context() as patch:
                patch.setattr(type(frame), "join", lambda a, b, on, how="inner": a if how == kind else join(a, b, on, how))
                wrong.add(frame)
        rows = [Counter(map(tuple, runs.frequent(2).collect())) for runs in (right, wrong)]
        assert rows[0] != rows[1]
        right.close(), wrong.close()


def test_runs_outlive_a_call(spark, tmp_path):
    line = "this line is long enough to be counted as one of many"
    docs = lambda ids: spark.createDataFrame([(i, f"{line}\nown {i}") for i in ids], "doc_id long, text string")
    runs = lines.LineRuns(spark, folder=str(tmp_path / "runs"))
    first = lines.drop_repeated_lines(docs(range(3)), runs=runs).collect()
    assert all(len(r["kept"]) == 2 for r in first)
    runs.close()
    again = lines.LineRuns(spark, folder=str(tmp_path / "runs"))
    kept = {r["row"]["doc_id"]: len(r["kept"]) for r in lines.drop_repeated_lines(docs(range(3, 6)), runs=again).collect()}
    assert kept == {3: 1, 4: 1, 5: 2}
    again.close()


def test_a_failed_batch_leaves_no_table(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x" * 50)], "doc_id long, text string")

    def broken(self, min_documents):
        raise RuntimeError("down")

    monkeypatch.setattr(lines.LineRuns, "frequent", broken)
    with pytest.raises(RuntimeError):
        lines.drop_repeated_lines(docs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_licence_words_without_end_take_time_in_proportion(spark):
    import time

    seconds = []
    for n in (20_000, 60_000):
        docs = spark.createDataFrame([(1, "license " * n), (2, "general public license " * (n // 3)), (3, "mit license " * n)], "doc_id long, text string")
        scan = licenses.license_scan(docs.coalesce(1))
        scan.collect()
        start = time.perf_counter()
        got = {r["doc_id"]: r["labels"] for r in scan.collect()}
        seconds.append(time.perf_counter() - start)
        assert got == {1: "", 2: "gpl", 3: ""}
    assert seconds[1] < 9 * max(seconds[0], 0.5)


def test_whole_licence_texts_and_parts_of_them(spark):
    whole = [t for t in licenses.TEMPLATES]
    cut = [t for t in whole if len(t.text.split()) > 30]
    rows = [(k, f"intro words. {t.text.upper()} and so on") for k, t in enumerate(whole)]
    rows += [(100 + k, " ".join(t.text.split()[: int(0.8 * len(t.text.split()))])) for k, t in enumerate(cut)]
    got = {r["doc_id"]: (set(r["labels"].split(",")), r["score"]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(t.label in got[k][0] and got[k][1] == 1 for k, t in enumerate(whole))
    assert all(t.label in got[100 + k][0] for k, t in enumerate(cut))


def test_tagger_adds_secrets_and_spelled_out_addresses(spark):
    """Held-out precision and recall of what no rule finds."""
    draw = random.Random(6)
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    pad = lambda: " ".join("".join(draw.choice(["th", "on", "er", "ê", "ung", "ado"]) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(8, 60)))

    def text():
        spot = draw.choice([
            f"password={hexes(18)}", f'token = "{hexes(40)}"', "AKIA" + "".join(draw.choice("ABCDEFGHIJ234567") for _ in range(16)),
            f"{hexes(6)}.{draw.randrange(99)}@mail{draw.randrange(9)}.example.com", f"version {draw.randrange(9)}.{draw.randrange(9)}", f"in {draw.randrange(1900, 2030)}",
        ])
        return f"{pad()} {spot} {pad()}"

    docs = spark.createDataFrame([(k, text()) for k in range(1500)], "doc_id long, text string")
    weights = pii.fit(docs)
    tests = []
    for _ in range(300):
        plain = text()
        tests.append((plain, pii.training_spans(plain)))
        if any(kind == 0 for _, kind, _ in tests[-1][1]):
            tests.append(pii.spelled_out(*tests[-1]))
    hits = found = wanted = 0
    for (t, marked), (own, spans) in zip(tests, pii.find_spans(weights, [t for t, _ in tests]), strict=True):
        added, missing = set(spans) - set(own), set(marked) - set(own)
        hits, found, wanted = hits + len(added & missing), found + len(added), wanted + len(missing)
    assert hits >= 0.9 * found > 0 and hits >= 0.9 * wanted


def test_spans_longer_than_a_window_are_whole():
    weights = pii.train([], [])
    weights["out"][:], weights["bias"][:] = 0, 0

    def emissions(weights, x, keep=False):
        scores = np.zeros((x.shape[1], x.shape[0], pii.N_TAGS))
        digit = (x.T == pii.CLASSES[ord("1")])
        first = digit & ~np.vstack([np.zeros((1, x.shape[0]), bool), digit[:-1]])
        scores[..., 0] = np.where(digit, -9, 9)
        scores[..., 9], scores[..., 10] = np.where(first, 9, -9), np.where(digit & ~first, 9, -9)
        return scores, None, None, None

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "emissions", emissions)
        text = "a" * 50 + "1" * 700 + "b" * 80 + "2" * 20
        (_, spans), = pii.find_spans(weights, [text])
    assert [(s, e) for s, kind, e in spans] == [(50, 750), (830, 850)] and {kind for _, kind, _ in spans} == {4}


@pytest.mark.parametrize("n", range(5))
def test_stages_take_empty_tables_and_columns_of_any_name(spark, n, tmp_path):
    _, stage = corpus_pipeline.STAGES[n]
    names = "kept_text string, row_key int, row int, lines int, kept int, i int, rep int, mark long, h int, word_map map<string,int>"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {names}"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    extra = ("x", 1, 2, 3, 4, 5, 6, 7, 8, {"a": 1})
    none = stage(spark, spark.createDataFrame([], schema), str(tmp_path))
    assert none.count() == 0
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "en", "s", 5, *extra), (1, words, "en", "s", 5, *extra), (2, None, None, None, None, *extra), (None, "", None, "s", 0, *extra)]
    got = stage(spark, spark.createDataFrame(rows, schema), str(tmp_path))
    if n < 4:
        assert none.columns == got.columns == [f.split()[0] for f in schema.split(", ")]
        kept = Counter((r["doc_id"], r["text"], r["kept_text"], r["row_key"]) for r in got.collect())
        copies = 1 if n == 2 else 2
        assert kept == {(1, words, "x", 1): copies, (2, None, "x", 1): 1, (None, "", "x", 1): 1}
    else:
        assert sorted((r["doc_id"] or 0) for r in got.collect() if r["piece"] == 0) == [0, 1, 1, 2]


def test_texts_that_share_many_tokens_are_a_pair_once(spark, monkeypatch):
    draw = random.Random(9)
    texts = []
    for k in range(40):  # alike, but too little to link; each pair shares tokens that others do not
        words = [f"w{i}" for i in range(300)]
        for i in draw.sample(range(300), 4):
            words[i] = f"x{k}-{i}"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = stored(jaccard.describe(docs, "doc_id", "text", 80), "rows")
    met = jaccard.meetings(rows, rows.select("rid", F.col("rid").alias("rep")))
    known = rows.select(F.col("rid").alias("rep"), "n", "bits", F.col("rid").alias("label"))
    members = jaccard.mixed(met, known)
    distinct = jaccard.tree_pairs(members, 80).count()
    monkeypatch.setattr(type(docs), "distinct", lambda df: df)
    assert members.select("token").dropDuplicates().count() > 20 and distinct > 100
    assert jaccard.tree_pairs(members, 80).count() <= 1.1 * distinct


def test_masking_holds_a_bounded_number_of_texts(monkeypatch):
    held = []
    monkeypatch.setattr(pii, "find_spans", lambda weights, texts: held.append(len(texts)) or [([], [(2, 3, 4)] if t else []) for t in texts])
    texts = ["a +1 b", None, ""] * 1500
    got = pii.masked({}, pa.array(texts).slice(3)).to_pylist()
    assert got == ["a [PHONE] b" if t else t for t in texts[3:]]
    assert max(held) <= pii.ROWS and sum(held) == len(got)
    assert pii.masked({}, pa.array([], pa.string())).to_pylist() == []
