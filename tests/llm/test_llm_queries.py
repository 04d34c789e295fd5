"""Every query of the subpackage against its SQL or a brute-force version on the smallest tables."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from gleanframe.llm import catalog, packing, pii

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


def rows_of(spark, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    return {row["doc_id"]: row for row in df.collect()}


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_against_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    result = db.execute(catalog.CHECKS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(result.fetchall())


def test_all_operators_and_the_pipeline():
    names = sorted(catalog.QUERIES)
    assert [n for n in range(1, 14) if sum(name.startswith(f"op{n}_") for name in names) != 1] == []
    assert "pipeline" in names


def test_op1_brute_force(spark, texts):
    got = rows_of(spark, "op1_suffix_array_dedup")
    data = {i: t.encode() for i, t in texts.items()}
    count = Counter(b[s : s + 400] for b in data.values() for s in range(len(b) - 399))
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - 399):
            if count[b[s : s + 400]] > 1:
                gone[s : s + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        assert tuple(got[i]) == (i, len(b), sum(gone), runs, sha(kept))


def test_op2_junk_goes_and_prose_stays(spark, db):
    got = rows_of(spark, "op2_quality_rules")
    labels = db.execute("SELECT doc_id, quality FROM labels JOIN documents USING (doc_id)").fetchall()
    prose = [i for i, quality in labels if quality == 1 and not got[i]["base_failed"]]
    junk = [i for i, quality in labels if quality == 0]
    assert all(got[i]["kept"] for i in prose)
    assert not any(got[i]["kept"] for i in junk)


def test_op4_folds_and_scores(spark, texts):
    got = rows_of(spark, "op4_toxicity")
    assert set(got) == set(texts)
    for i, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no larger tables")
def test_op4_held_out_ranking(spark):
    folder = "/root/testdata/sf0.1"
    scores = {r["doc_id"]: r for r in catalog.QUERIES["op4_toxicity"](spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    held = [(scores[i]["score"], toxic) for i, toxic in labels if i in scores and scores[i]["held_out"]]
    s, t = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    wins = (s[t == 1][:, None] > s[t == 0][None, :]).mean()
    assert wins > 0.97


def test_op5_places_and_ids(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = catalog.QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    pieces = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(pieces) == len(rows)
    want = 0
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            r = pieces[i, piece]
            assert (r["start"], r["length"], r["ids_crc32"]) == (a, b - a, zlib.crc32(ids[a:b].tobytes()))
            want += 1
    assert want == len(rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    lengths = Counter(r["length"] for r in rows)
    plain = sum(copies for copies, _ in packing.best_fit(dict(lengths), 2048))
    assert len(sequences) <= max(plain, -(-sum(n * c for n, c in lengths.items()) // 2048) + 1)


def shingles(text):
    w = WORD.findall(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_op6_brute_force(spark, texts):
    got = rows_of(spark, "op6_fingerprints")
    ids = list(texts)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        text, after = texts[i], texts[j]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), sha(edited))
        assert abs(row["near_edited"] - likeness(shingles(text), shingles(edited))) < 0.17
        assert abs(row["near_next"] - likeness(shingles(text), shingles(after))) < 0.17


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and (not 14 <= len(digits) <= 19 or not pii.luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_op8_base_spans(spark, texts):
    for i, row in rows_of(spark, "op8_pii").items():
        base = brute_spans(texts[i])
        counts = [sum(kind == k for _, kind, _ in base) for k in range(4)]
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == counts
        assert row["base_sha256"] == sha(pii.span_text(base))
        assert set(filter(None, pii.span_text(base).split(","))) <= set(row["spans"].split(","))


def test_op9_base_places(spark, texts):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    for i, row in rows_of(spark, "op9_license_scans").items():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[i])
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        found = [(at, label) for at in range(len(w)) for p, label in phrases.items() if tuple(w[at : at + len(p)]) == p]
        places = [at for at, _ in found]
        labels = sorted({label for _, label in found})
        want = (len(w), len(found), min(places, default=None), max(places, default=None), ",".join(labels))
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == want
        assert set(labels) <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_op10_against_the_library(spark, texts):
    import tiktoken

    from gleanframe.llm.bpe import load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, row in rows_of(spark, "op10_byte_bpe").items():
        ids = library.encode_ordinary(texts[i])
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert row["decoded_sha256"] == sha(texts[i])


def test_pipeline_stage_by_stage(spark, db):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in catalog.QUERIES["op4_toxicity"](spark, SF_DIR).collect()}
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF_DIR)
    kept = {r["doc_id"]: r for r in clean.collect()}
    assert set(kept) == {i for i, toxic in scores.items() if not toxic}
    assert clean.columns == docs.columns

    lines = {r["doc_id"]: r["text"] for r in stages["line_dedup"](spark, clean, SF_DIR).collect()}
    keys = {i: [line.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)}) for line in r["text"].split("\n")] for i, r in kept.items()}
    holders = {}
    for i, own in keys.items():
        for key in own:
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    for i, own in keys.items():
        stay = [
            line
            for line, key in zip(kept[i]["text"].split("\n"), own, strict=True)
            if len(key) < 40 or len(holders[key]) < 5 or i == max(holders[key])
        ]
        assert lines[i] == "\n".join(stay)

    # one document of each component of texts alike by four fifths stays, the one with the smallest id
    columns = docs.schema
    after_lines = spark.createDataFrame([(i, lines[i], "en", "s", len(lines[i])) for i in lines], columns)
    sets = {i: shingles(re.sub("[A-Z]", lambda m: m[0].lower(), t)) for i, t in lines.items()}
    label = {i: i for i in sets}
    ordered = sorted(sets)
    for j in ordered:
        for i in ordered[: ordered.index(j)]:
            if label[i] != label[j] and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    unique = stages["ngram_jaccard"](spark, after_lines, SF_DIR)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(i for i in sets if label[i] == i)

    # every span that rules or tagger find is masked, all else stays
    weights = pii.fit(unique)
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["pii"](spark, unique, SF_DIR).collect()}
    for i, (_, spans) in zip(before, pii.find_spans(weights, list(before.values())), strict=True):
        parts, at = [], 0
        for start, kind, end in spans:
            if start >= at:
                parts += [before[i][at:start], f"[{pii.KINDS[kind].upper()}]"]
            at = max(at, end)
        want = "".join([*parts, before[i][at:]])
        assert masked[i] == (want, len(want))
        assert not pii.rule_spans(want)

    # all ids of every text are placed once
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    after = spark.createDataFrame([(i, t, "en", "s", n) for i, (t, n) in masked.items()], columns)
    placed = Counter()
    for r in stages["packing"](spark, after, SF_DIR).collect():
        placed[r["doc_id"]] += r["length"]
    assert placed == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, (t, _) in masked.items()}

    total = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in total.select("doc_id").distinct().collect()} == set(masked)
