"""Nulls, empty and long texts, repeats, empty tables, clashing columns; hot groups and bucket borders."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gleanframe.llm import bpe, corpus_queries, fingerprint, jaccard, licenses, lines, packing, pii, quality, suffixes, toxicity
from gleanframe.llm.components import components

SCHEMA = "h long, doc_id long, text string, n int, part int, length long, row string, id long, label int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark, rows):
    return spark.createDataFrame([(7, i, t, 1, 2, 3, "x", 9, 0) for i, t in rows], SCHEMA)


LONG = "the long text of many words and no end " * 4000
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one two"), (5, "one two"), (None, "lost id"), (6, "one two")]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_quality(odd, none):
    got = quality.quality_rules(odd).collect()
    assert len(got) == len(ROWS) and not any(r["kept"] for r in got)
    assert {(r["n_words"], r["base_failed"]) for r in got if r["doc_id"] in (1, 2, 3)} == {(0, True)}
    assert quality.quality_rules(none).count() == 0


def test_bpe(odd, none):
    got = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in got) == Counter((i, t or "") for i, t in ROWS)
    assert [r["ids"] for r in got if r["doc_id"] == 1] == [""]
    assert bpe.digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("every", [5, 40, 1024])
def test_bpe_against_definition(every, monkeypatch):
    monkeypatch.setattr(bpe, "SETTLE_EVERY", every)
    coder = bpe.Transducer(bpe.load_ranks(RANKS))
    draw = random.Random(5)
    for alphabet in ("ab", "aeinrst ", "0123456789", "-=", "éüあ"):
        for size in (1, 9, 60, 400):
            text = "".join(draw.choice(alphabet) for _ in range(size)).encode()
            want = [coder.vocabulary[text]] if text in coder.vocabulary else coder.merge(text)
            assert coder.encode(text) == want
            assert coder.encode_many([text, b"a", text[:30], text[3:20]])[:2] == [want, coder.encode(b"a")]


def test_bpe_pieces_side_by_side_and_forgetting(monkeypatch):
    import regex
    import tiktoken

    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(8)
    texts = ["".join(draw.choice(["ab", "Ce", "don't", " ", "\n", " x", "é", "12", "!", "\t", "\u00a0", "a" * 70]) for _ in range(draw.randrange(30))) for _ in range(400)]
    texts += ["", " ", "\n", "a ", " a", "\na", "a\n", "x\t", "\tx y", "word\u00a0 a"]
    for limit in (10, 400_000):
        monkeypatch.setattr(bpe, "MAX_PIECES", limit)
        monkeypatch.setattr(bpe, "MAX_ARCS", 10 * limit)
        pieces = bpe.Pieces(bpe.Transducer(ranks), regex.compile(public_tokenizers.PATTERN).findall)
        decoder = bpe.Decoder(pieces.transducer.bytes_of)
        for at in range(0, len(texts), 50):
            for text, packets in zip(texts[at : at + 50], pieces.of(texts[at : at + 50]), strict=True):
                assert " ".join(ids for ids, _ in packets) == " ".join(map(str, library.encode_ordinary(text)))
                assert decoder.text(b"".join(data for _, data in packets)) == text
        assert len(pieces) <= limit and len(pieces.older) <= limit


def test_decoder_holds_unfinished_characters():
    decoder = bpe.Decoder({0: b"\xf0\x9f", 1: b"\x98\x80x", 2: b"\xe3"})
    assert [decoder.push("0"), decoder.push("1"), decoder.push("2"), decoder.end()] == ["", "\U0001f600x", "", "�"]


def test_lines(spark, none):
    key = "a line that is longer than forty characters, surely"
    docs = table(spark, [(i, f"  {key.upper()}\nshort\n{key}") for i in range(1, 6)] + [(None, key), (9, None), (5, key)])
    got = [(r["row"]["doc_id"], r["lines"], r["kept"]) for r in lines.drop_repeated_lines(docs, batches=3).collect()]
    assert sorted(k for i, _, k in got if i in (1, 2, 3, 4)) == [["short"]] * 4
    assert sorted(len(k) for i, _, k in got if i == 5) == [1, 3]
    assert [k for i, _, k in got if i is None] == [[key]]
    assert [k for i, _, k in got if i == 9] == [[""]]
    assert lines.drop_repeated_lines(none).count() == 0


def test_fingerprints(odd, none):
    got = fingerprint.fingerprints(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in ROWS)
    assert {tuple(r["sketch"]) for r in got if r["doc_id"] in (1, 2, 3)} == {()}
    assert len({tuple(r["sketch"]) for r in got if r["doc_id"] in (5, 6)}) == 1
    assert [r["edited"] for r in got if r["doc_id"] == 3] == [" \n" + "th"]
    assert fingerprint.fingerprints(none).count() == 0


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    parts = [(1, " ".join(words[:2000])), (1, " ".join(words[1000:])), (2, " ".join(words[:2000]))]
    df = spark.createDataFrame(parts, "k int, text string").select("k", fingerprint.sketch(F.col("text")).alias("s"))
    merged = fingerprint.merge_groups(df, ["k"], "s").withColumnRenamed("s", "m")
    whole = spark.createDataFrame([(1, " ".join(words))], "k int, text string")
    wanted = whole.select(fingerprint.sketch(F.col("text")).alias("s")).first()["s"]
    assert merged.where("k = 1").first()["m"] == wanted
    pair = merged.alias("x").join(merged.alias("y"), F.expr("x.k = 1 AND y.k = 2"))
    x, y = F.col("x.m"), F.col("y.m")
    n, inside, alike = pair.select(fingerprint.distinct_shingles(x), fingerprint.containment(y, x), fingerprint.resemblance(x, y)).first()
    assert abs(n / 2996 - 1) < 0.3 and inside > 0.75 and abs(alike - 2 / 3) < 0.15


def test_licenses(spark, odd, none):
    assert {r["labels"] for r in licenses.license_scan(odd).collect()} == {""}
    assert licenses.license_scan(none).count() == 0
    docs = table(
        spark,
        [
            (1, "x. This work is licensed under the GNU General Public License, version 3."),
            (2, "Licensed under CC BY-NC 4.0."),
            (3, "mit mit mit und mit der Apache und license"),
            (4, "Released under the MIT License. Licensed under the Apache License, Version 2.0"),
            (5, "All rights reserved. " * 3),
        ],
    )
    got = {r["doc_id"]: (r["labels"], r["base_labels"], r["n_base"]) for r in licenses.license_scan(docs).collect()}
    assert got == {1: ("gpl", "gpl", 1), 2: ("cc-by,cc-by-nc", "cc-by", 1), 3: ("", "", 0), 4: ("apache,mit", "", 0), 5: ("reserved", "reserved", 3)}


def test_toxicity(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    scores = odd.select(toxicity.fit(odd, empty).score(F.col("text")).alias("s")).collect()
    assert len(scores) == len(ROWS) and all(0 <= r["s"] < 0.5 for r in scores)
    assert none.select(toxicity.fit(none, empty).score(F.col("text"))).count() == 0


def test_toxicity_learns_from_positives_and_unlabelled():
    draw = np.random.default_rng(1)
    def text(toxic):
        body = [f"w{k}" for k in draw.integers(0, 400, 60)]
        return " ".join(body + [f"bad{k}" for k in draw.integers(0, 6, 3)] * toxic)
    positive = [toxicity.features(text(1)) for _ in range(150)]
    unlabelled = [toxicity.features(text(k % 10 == 0)) for k in range(600)]
    weights = toxicity.train(positive, unlabelled, 0.1, 0)
    score = lambda x: weights[x].sum() + weights[-1]
    assert np.mean([score(toxicity.features(text(1))) > 0 for _ in range(100)]) > 0.95
    assert np.mean([score(toxicity.features(text(0))) > 0 for _ in range(100)]) < 0.05


def test_packing(odd, none):
    got = packing.pack(odd, *corpus_queries.TOKENIZER).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(i for i, _ in ROWS)
    assert {r["length"] for r in got if r["doc_id"] in (1, 2)} == {1}
    places = Counter((r["sequence_id"], r["offset"]) for r in got)
    assert max(places.values()) == 1
    assert packing.pack(none, *corpus_queries.TOKENIZER).count() == 0


def test_plan_places_every_length():
    draw = random.Random(2)
    histogram = {n: draw.randint(1, 300) for n in draw.sample(range(1, 200), 120)} | {200: 40}
    configs = packing.plan(histogram, 200, rounds=200)
    placed = Counter()
    for copies, config in configs:
        assert sum(n * c for n, c in config.items()) <= 200
        for n, c in config.items():
            placed[n] += copies * c
    assert placed == histogram
    plain = sum(copies for copies, _ in packing.best_fit(dict(histogram), 200))
    assert sum(copies for copies, _ in configs) <= 1.01 * plain + 2


def test_pii(odd, none):
    weights = pii.fit(odd)
    got = pii.find_pii(odd, weights).collect()
    assert len(got) == len(ROWS) and {r["spans"] for r in got} == {""}
    assert pii.find_pii(none, pii.fit(none)).count() == 0


def test_tagger_learns_and_windows_reconcile(spark):
    draw = random.Random(4)
    def text():
        kind = draw.randrange(3)
        spot = (f"a{draw.randrange(99)}@mail{draw.randrange(9)}.example.com", f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}", f"v{draw.randrange(99)}")[kind]
        pad = lambda: " ".join(draw.choice(["ein", "of", "the", "casa"]) for _ in range(draw.randrange(5, 40)))
        return f"{pad()} {spot} {pad()}"
    sample = [text() for _ in range(300)]
    cut = [(t[s : s + pii.WINDOW], pii.tags_of(s, pii.rule_spans(t))) for t in sample for s in pii.windows(t)]
    weights = pii.train([w for w, _ in cut], [t for _, t in cut], epochs=24)
    hits = wanted = 0
    for t in (text() for _ in range(100)):
        starts = pii.windows(t)
        if not starts:
            continue
        found = pii.decode(weights, np.array([pii.encode(t[s : s + pii.WINDOW]) for s in starts]))
        spans = pii.reconcile([(m, (s + a, k, s + b)) for s, row in zip(starts, found, strict=True) for m, (a, k, b) in row])
        hits += len(set(spans) & set(pii.rule_spans(t)))
        wanted += len(pii.rule_spans(t))
    assert hits >= 0.8 * wanted > 0
    docs = table(spark, [(1, "mail bo@x.example.com now"), (2, None), (3, "")])
    masked = {r["doc_id"]: r["t"] for r in docs.select("doc_id", pii.redact(F.col("text"), weights).alias("t")).collect()}
    assert masked == {1: "mail [EMAIL] now", 2: None, 3: ""}


def test_crf_gradient():
    draw = np.random.default_rng(0)
    weights = pii.initial(draw)
    x, y = draw.integers(0, pii.N_CLASSES, (2, 20)), draw.integers(0, pii.N_TAGS, (2, 20))
    def loss():
        e = pii.emissions(weights, x)[0]
        a, gold = e[0], e[0][[0, 1], y[:, 0]]
        for t in range(1, 20):
            a = e[t] + pii._logsum(a[:, :, None] + weights["move"], 1)
            gold = gold + e[t][[0, 1], y[:, t]] + weights["move"][y[:, t - 1], y[:, t]]
        return (pii._logsum(a, 1) - gold).mean()
    grads = pii.gradient(weights, x, y)
    for name, w in weights.items():
        at = tuple(draw.integers(0, n) for n in w.shape)
        kept = w[at]
        w[at] = kept + 1e-5
        up = loss()
        w[at] = kept - 1e-5
        down = loss()
        w[at] = kept
        assert abs(grads[name][at] - (up - down) / 2e-5) < 1e-6


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (7, 7)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 55: 50, 60: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows():
    """A passage in all texts, a large group of near copies, and texts on both sides of the threshold."""
    draw = random.Random(11)
    words = lambda n: [f"x{draw.randrange(9999)}" for _ in range(n)]
    passage, base = words(60), words(200)
    rows = []
    for k in range(60):
        copy = list(base)
        for _ in range(k % 5):
            copy[draw.randrange(200)] = f"y{draw.randrange(9999)}"
        rows.append((k, " ".join(copy)))
    rows += [(100 + k, " ".join(words(80) + passage)) for k in range(60)]
    for k in range(20):
        one = words(draw.randrange(6, 60))
        rows += [(200 + 2 * k, " ".join(one)), (201 + 2 * k, " ".join(one[: len(one) - k % 4]).upper())]
    return rows


def test_jaccard_blocks_and_thresholds(spark, monkeypatch):
    rows = near_rows()
    sets = {i: frozenset(zip(*[t.lower().split()[j:] for j in range(5)])) or frozenset([tuple(t.split())]) for i, t in rows}
    want = {i: i for i in sets}
    def root(i):
        while want[i] != i:
            i = want[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                want[max(a, b)] = min(a, b)
    for block in (10, 4000):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(table(spark, rows), block=block).collect()}
        assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_odd_rows(odd, none):
    got = jaccard.jaccard_components(odd).collect()
    assert Counter((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in got) == Counter(
        [(1, False, 1), (2, False, 2), (3, False, 3), (4, True, 4), (5, True, 5), (5, True, 5), (6, True, 5), (None, True, None)]
    )
    assert jaccard.jaccard_components(none).count() == 0


def test_dual_traversal_loses_no_link():
    draw = np.random.default_rng(3)
    base = draw.integers(-(2**62), 2**62, 300)
    sets = [np.unique(np.concatenate([draw.permutation(base)[: 300 - k], draw.integers(-(2**62), 2**62, k)])) for k in draw.integers(0, 90, 70)]
    bits = np.array([jaccard.bitmap(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.SignatureTree(sizes, bits, np.arange(len(sets)))
    x, y = jaccard.dual_traversal(tree, tree, 80)
    left = {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 180 * both >= 80 * (sizes[i] + sizes[j]):
                assert (i, j) in left
    one = jaccard.SignatureTree(sizes, bits, np.zeros(len(sets), np.int64))
    assert len(jaccard.dual_traversal(one, one, 80)[0]) == 0


@pytest.mark.parametrize("segment", [600, 1 << 21])
def test_suffixes_hot_strings_across_buckets(spark, monkeypatch, segment):
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    draw = random.Random(8)
    letters = lambda n: "".join(draw.choice("abcdefgh é") for _ in range(n))
    hot, other = letters(450), letters(700)
    rows = [(k, letters(draw.randrange(50, 500)) + hot[: draw.randrange(380, 450)] + letters(30)) for k in range(60)]
    rows += [(100, other), (101, letters(9) + other[100:650]), (102, "ab" * 600), (103, "b" + "ab" * 250), (104, None), (105, letters(450))]
    rows += [(106, "same " * 100), (106, "same " * 100), (None, other[:420])]
    got = Counter((r["doc_id"], r["n_bytes"], tuple((s["a"], s["b"]) for s in r["spans"])) for r in suffixes.remove_repeats(table(spark, rows)).collect())
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s : s + 400] for _, b in data for s in range(len(b) - 399))
    want = Counter()
    for i, b in data:
        spans = []
        for s in range(len(b) - 399):
            if count[b[s : s + 400]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + 400
                else:
                    spans.append([s, s + 400])
        want[i, len(b), tuple(map(tuple, spans))] += 1
    assert got == want


def test_suffixes_empty(none):
    assert suffixes.remove_repeats(none).count() == 0
