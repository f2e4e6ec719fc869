"""Phrase collocations, mixing and importance resampling: brute force on the
smallest tables, and the edges (nulls, empty and long texts, repeated rows,
clashing names, empty tables)."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from portolan.llm import bpe, importance, line_dedup, mixing, ngram_join, phrases, quality_gam, queries, rules
from tests.conftest import SMALL
from tests.test_oracle import _canon

pq = pytest.importorskip("pyarrow.parquet")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def table_rows(name, *columns):
    return [tuple(r.values()) for r in pq.read_table(f"{SMALL}/{name}.parquet", columns=list(columns)).to_pylist()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_mixing"])
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    res = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(columns, res.fetchall())


# -- phrases ---------------------------------------------------------------------
def brute_phrases(rows, least=10, inside=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, seen in f.items():
        cand = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            if any(100 * b >= inside * a and p in (q[:2], q[1:]) for q, b in cand.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((10**6 * a * a // (seen[p[:k]] * seen[p[k:]]), k, seen[p[:k]], seen[p[k:]])
                                        for k in range(1, len(p)))
            rows_.append((score, a, " ".join(p), left, right))
        rows_.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(rows_[:top], 1)]
    return sorted(out)


TEXTS = [("en", "New York City, new york city. NEW YORK city\nnew\tyork  city; in York city"),
         ("en", None), (None, "a b a b a b"), ("en", ""), ("de", "x\x0by z y z y z y z"), ("en", "É é x . . , !"),
         (None, "A b c d\r\na b c d"), ("en", "new york")]


@pytest.mark.parametrize("capacity, burst", [(phrases.CAPACITY, phrases.BURST), (6, 2), (1, 1)])
def test_phrases_by_spilling_and_bursting_tries(spark, capacity, burst):
    df = spark.createDataFrame([(i, t, lang, "s", i) for i, (lang, t) in enumerate(TEXTS)], DOC) \
        .withColumnRenamed("n_chars", "n").withColumnRenamed("source", "words")
    for least, inside, top in ((1, 50, 2000), (2, 100, 3), (3, 50, 2000)):
        got = phrases.collocations(df, least=least, inside=inside, top=top, capacity=capacity, burst=burst)
        assert sorted(tuple(r) for r in got.collect()) == brute_phrases(TEXTS, least, inside, top)


def test_phrases_across_blocks_and_renumbered_words(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 7)
    texts = [b"aa bb cc aa bb cc dd, aa bb\ncc aa bb", b"", b"cc" * 40 + b" aa bb", b"aa"]
    want = Counter()
    for t in texts:
        for piece in re.split(rb"[,\n]", t):
            w = piece.split()
            for k in (1, 2, 3):
                want.update(b" ".join(w[i:i + k]).decode() for i in range(len(w) - k + 1))
    every = phrases.PairFilter(np.full(1, -1, dtype=np.int64).view(np.uint64))  # lets every pair through
    for most in (1 << 20, 3):
        got = Counter()
        for pairs in (None, every):
            trie = phrases.Trie(pairs, capacity=5, burst=1, most_words=most)
            for batch in [*trie.add("en", texts), *trie.spill(0)]:
                run = batch.to_pylist()
                assert [r["phrase"] for r in run] == sorted(r["phrase"] for r in run)  # a sorted run
                for r in run:
                    if r["words"]:
                        got[r["phrase"]] += r["n"]
        assert got == want


def test_pair_filter_denies_no_pair_it_holds(spark):
    rows = [(f"l{i % 3}", 2, f"a{i} b{i % 7}", 1) for i in range(5000)]
    held = phrases.PairFilter(phrases.pair_filter(spark.createDataFrame(rows, phrases.COUNT_SCHEMA), 1 << 17))
    assert all((lang, *phrase.encode().split()) in held for lang, _, phrase, _ in rows)
    others = sum(("l0", f"x{i}".encode(), b"b") in held for i in range(5000))
    assert others < 300  # about (2 * 5000 / 2^17)^2 of them, well under this


def test_scores_past_64_bits(spark):
    big = 3_000_000_000
    counts = spark.createDataFrame([("en", 1, "a", 2 * big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)],
                                   phrases.COUNT_SCHEMA)
    row = phrases.scored_cuts(counts).first()
    assert row.score == 10**6 * (big - 1) ** 2 // (2 * big * big) == 499999


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], DOC)).collect() == []


# -- mixing ----------------------------------------------------------------------
def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        left = sum(w[s] for s in names if s not in full)
        more = {s for s in names if s not in full and w[s] * rest > most * sizes[s] * left}
        if not more:
            return {s: float(most * sizes[s]) if s in full else w[s] * rest / left for s in names}
        full |= more


def check_mix(rows, got):
    size = Counter()
    for _, source, text in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets({s: size[s] for s in {r[1] for r in rows}})
    assert len(got) == len(rows)
    for source in want:
        own = [r for r in got if r.source == source]
        assert {(r.source_size, r.target) for r in own} == {(size[source], want[source])}
        assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= max(r.size for r in own)


def test_mix_meets_targets(spark):
    rows = table_rows("documents", "doc_id", "source", "text")
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = mixing.mix(df).collect()
    check_mix(rows, first)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(tuple(r) for r in first) == sorted(tuple(r) for r in again)


def test_mix_caps_small_sources_and_takes_any_row(spark):
    text = {"a": "one", "b": "w " * 400, "c": "x y\tz", None: "v " * 30, "": "u", "d": None}
    rows = [(i, s, text[s]) for s in text for i in range(3)] + [(None, "b", "w w"), (7, "b", "same")] + [(7, "b", "same")] * 300
    df = spark.createDataFrame([(i, t, "en", s, 1) for i, s, t in rows], DOC) \
        .withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "copies")
    got = mixing.mix(df).collect()
    check_mix(rows, got)
    assert sum(r.source is None for r in got) == 3
    assert {r.taken for r in got if r.source == "a"} == {3}  # stopped at three times its size


def test_mixture_repeats_documents(spark):
    df = spark.createDataFrame([(i, "w " * (i + 1), "en", "ab"[i % 2], i) for i in range(40)], DOC)
    mixed = mixing.mix(df)
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    out = mixing.mixture(df, mixed)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == +Counter(copies)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOC)).collect() == []
    blank = spark.createDataFrame([(1, " \n", "en", "a", 0), (2, None, "en", None, 0)], DOC)
    assert {(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


# -- importance ------------------------------------------------------------------
def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_importance(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, text in docs:
        n, own = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:5 * len(able) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


def in_order(rows):
    return sorted(rows, key=repr)


def test_op13_against_brute_force(spark):
    got = E.queries()["op13_importance"](spark, SMALL)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_importance(table_rows("documents", "doc_id", "text"), [r[0] for r in table_rows("benchmark", "text")])
    assert in_order(tuple(r) for r in got.collect()) == in_order(want)


def test_importance_takes_any_row(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(i, f"The quick brown fox no {i} " * 5) for i in range(200)]
    rows += [(None, "void " * 25), (None, None), (300, ""), (301, "é" * 9 + " ÀB c"), (302, long)] + [(303, "same " * 30)] * 150
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOC) \
        .withColumnRenamed("lang", "id").withColumnRenamed("source", "raw").withColumnRenamed("n_chars", "rank").repartition(3)
    target = spark.createDataFrame([("same quick fox",), (None,)], "text string")
    out = importance.resample(df, target)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()]
    assert in_order(got) == in_order(brute_importance(rows, ["same quick fox", None]))
    drawn = importance.drawn_documents(df, out)
    assert drawn.columns == df.columns
    ids = {g[0] for g in got if g[4] is not None}
    assert {r.doc_id for r in drawn.collect()} == ids


def test_runs_across_blocks(monkeypatch):
    text = "Ab1-cd  ef é_gh ij kl " * 7
    whole = Counter(h for _, hs in importance.run_hashes(text.encode()) for h in hs)
    for block in (1, 5, 16):
        monkeypatch.setattr(importance, "BLOCK", block)
        assert Counter(h for _, hs in importance.run_hashes(text.encode()) for h in hs) == whole


def test_importance_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOC)
    assert importance.resample(empty, empty).collect() == []


# -- earlier operators: faults that stay mended --------------------------------------
def twins(n):
    """Two different texts of 2**n characters that every odd base hashes alike modulo 2**64."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_texts_that_powers_of_a_base_take_for_equal_stay_apart(spark):
    a, b = twins(11)
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}\nplain words here"), (4, f"{a}\n{a}")],
                                 "doc_id long, text string")
    classes = ngram_join.classes(docs.filter("doc_id < 3"), width=3, threshold=ngram_join.Threshold(9, 10)).collect()
    assert sorted(r.component_id for r in classes) == [1, 2]
    assert {r.doc_id: r.n_dup_lines for r in rules.report(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 1}
    raw = f"{a}\n{b}\n{a}".encode()
    lines = line_dedup.Lines(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])).hashes()
    assert lines[0] == lines[2] != lines[1]


def test_two_vocabularies_in_one_session(spark):
    docs = spark.createDataFrame([(1, "abab")], "doc_id long, text string")
    single = {bytes([i]): i for i in range(256)}
    for ranks, ids in (({**single, b"ab": 256}, [256, 256]), ({**single, b"ba": 256}, [97, 256, 98])):
        encoded = bpe.encode(docs, ranks, r"(?s).+")
        assert encoded.first().ids == ids
        assert bytes(bpe.decode(encoded, ranks).first().decoded) == b"abab"


def test_columns_named_like_private_ones(spark):
    docs = spark.createDataFrame([(1, "some words here", "x", "y")], "doc_id long, text string, _text string, _TEXT_ string")
    ranks = {bytes([i]): i for i in range(256)}
    assert bpe.encode(docs.drop("_TEXT_"), ranks, r"(?s).+").first()._text == "x"
    model = quality_gam.train(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert quality_gam.score(docs.drop("_TEXT_"), model).first()._text == "x"
