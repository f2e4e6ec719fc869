"""Edge cases and brute-force comparisons of the operators for training data."""

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from portolan.llm import (
    bpe,
    decontaminate,
    html_extract,
    line_dedup,
    linkage,
    ngram_join,
    pii_crf,
    quality_gam,
    rules,
    sharding,
    url_filter,
)
from portolan.llm.graph import components
from portolan.llm.textstats import Stats
from portolan.llm.words import words_of

SCHEMA = "doc_id long, text string, node string, line string, keys string, score double, n long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(3000))
TEXTS = [None, "", " \n\t ", "one", "one two", "Alpha beta gamma delta", "alpha BETA gamma  delta", LONG, LONG,
         LONG + " tail", "mail a.b@example.com or +1 (974) 555-3436, host 10.1.2.3\nmail\nmail",
         "é" * 50 + " ünïcode \U0001f642 text", "x" * 5000]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, "clash", "clash", "clash", 1.0, 7) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "alpha beta gamma delta", None, None, None, None, None), (None, None, "a", "b", "c", 0.0, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, width):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in words(text)]
    return frozenset(tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, min(len(w), 1))))


def brute_components(rows, width, num, den):
    """component of each row position, by all pairs."""
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    return root


def test_ngram_join_matches_brute_force(spark, messy, nothing):
    got = ngram_join.classes(messy).collect()
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    root = brute_components(rows, 3, 9, 10)
    least = {r: min((i for (i, _), q in zip(rows, root, strict=True) if q == r and i is not None), default=None)
             for r in set(root)}
    expected = sorted((str(i), len(shingle_set(t, 3)), str(least[r])) for (i, t), r in zip(rows, root, strict=True))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == expected
    assert ngram_join.classes(nothing).count() == 0


@pytest.mark.parametrize("width,num,den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join_finds_near_copies(spark, width, num, den):
    rng, rows = random.Random(1), []
    for g in range(30):
        base = [f"t{rng.randrange(400)}" for _ in range(rng.choice([12, 40, 200]))]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 30)):
                own[rng.randrange(len(own))] = f"u{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(own)))
    got = {r.doc_id: r.component_id for r in ngram_join.classes(
        spark.createDataFrame(rows, "doc_id long, text string"), width=width,
        threshold=ngram_join.Threshold(num, den)).collect()}
    root = brute_components(rows, width, num, den)
    assert got == {i: min(j for j, r in enumerate(root) if r == root[i]) for i in range(len(rows))}


def _keys(sets, threshold):
    """The bucket keys of every set of hashes."""
    bands, sizes = ngram_join.Bands(threshold), np.array([len(x) for x in sets])
    band, below = bands.of(sizes)
    blocks, starts = np.asarray(bands.blocks), np.asarray(bands.low)
    hashes, doc = np.concatenate([np.sort(x) for x in sets]), np.repeat(np.arange(len(sets)), sizes)
    less, out = np.maximum(band - 1, 0), [set() for _ in sets]
    for found in (ngram_join.block_keys(hashes, doc, band, blocks[band], bands.own_diff(sizes)),
                  ngram_join.block_keys(hashes, doc, less, np.where(below, blocks[less], 0),
                                        bands.own_diff(sizes, starts[less + 1] - 1))):
        for key, k in zip(*found, strict=True):
            out[k].add(int(key))
    return out


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5)])
def test_blocks_of_sets(num, den):
    """Linked sets share a bucket, at the least similarity too; unlike sets are
    not brought together by blocks without a shingle."""
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64)
    for n in [*range(1, 70), *range(70, 1200, 23)]:
        for both in {-(-n * num // den), n - n // 20, n}:
            a = draw(n)
            most = both * den // num - n  # elements of the other set that are not in this one
            b = np.concatenate([a[:both], draw(rng.integers(0, max(most, 0), endpoint=True))])
            if both * den >= num * (n + len(b) - both) and (n != both or len(b) != both):
                x, y = _keys([a, b], ngram_join.Threshold(num, den))
                assert x & y, (n, both, len(b))
    apart = _keys([draw(n) for n in range(100, 300)], ngram_join.Threshold(num, den))
    shared = sum(1 for i, x in enumerate(apart) for y in apart[:i] if x & y)
    assert shared <= 2


def test_worker_memory_of_the_encoder():
    """What a worker keeps and lets wait stays in bounds (of some 40 MB)."""
    assert bpe.REMEMBERED + bpe.WAITING <= 320_000


def test_tasks_leave_no_words_in_the_worker(spark):
    """A worker that has encoded texts remembers none of them afterwards."""
    ranks = {bytes([b]): b for b in range(256)}
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(50)], "doc_id long, text string").coalesce(1)
    assert bpe.encode(docs, ranks, r"\S+|\s+").count() == 50

    def left(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(len(e.codes) for e in bpe._ENCODERS.values())]})

    assert [r.n for r in spark.range(1).coalesce(1).mapInArrow(left, "n long").collect()] == [0]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_quality_model_learns_and_scores_every_row(spark, messy, nothing):
    rng = random.Random(2)
    good = [" ".join("".join(rng.choice("aeioulnr") for _ in range(rng.randint(2, 8))) for _ in range(80)) for _ in range(150)]
    bad = [t.replace(" ", "%%% ") for t in good]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    model = quality_gam.train(docs, labels, F.col("doc_id") % 5 == 0)
    scored = {r.doc_id: r.score for r in quality_gam.score(docs, model).collect()}
    held = [i for i in scored if i % 5 == 0]
    assert np.mean([(scored[i] >= 0.3) == (i < 150) for i in held]) > 0.97
    out = quality_gam.score(messy, model)
    assert out.count() == messy.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    empty = quality_gam.train(nothing, labels.limit(0))
    assert {r.score for r in quality_gam.score(messy, empty).collect()} == {0.5}


def test_bpe_equals_the_library_and_round_trips(spark, messy, nothing):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.decode(bpe.encode(messy.select("doc_id", "text", F.col("text").alias("kept"), "n"), ranks,
                                public_tokenizers.PATTERN), ranks).collect()
    for r in got:
        assert r.ids == library.encode_ordinary(r.kept or "") and bytes(r.decoded) == (r.kept or "").encode()
    assert bpe.encode(nothing, ranks, public_tokenizers.PATTERN).count() == 0
    merger, rng = bpe.Merger(ranks), random.Random(3)
    for alphabet in ("ab", "aé \n", "0a!"):
        raw = "".join(rng.choice(alphabet) for _ in range(400)).encode()
        assert merger.one(raw).tolist() == merger.many([raw])[0].tolist()


def test_rules_match_brute_force_and_any_order(spark, messy, nothing):
    for r in rules.report(messy.select("doc_id", "text", "n")).collect():
        text = next((x.text for x in messy.where(F.col("doc_id").eqNullSafe(F.lit(r.doc_id))).collect()), None)
        if r.doc_id is None:
            continue
        w = words(text)
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 500 else None
        assert covered is None or r.n_repeat_words == len(covered)
    assert rules.report(nothing).count() == 0
    raw = "\n".join(["a b c " * 30, LONG[:2000], "% " * 60]).encode()
    data, offsets = np.frombuffer(raw, dtype=np.uint8), np.array([0, 180, 2000, len(raw)])
    one = rules.survivors(data, offsets, rules.RULES)
    assert (one == rules.survivors(data, offsets, rules.RULES[::-1])).all()
    whole = Stats(data, offsets)
    assert (one == ~np.any([x.rejects(whole) for x in rules.RULES], axis=0)).all()


def minimax(sizes, shards):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def test_sharding_is_minimax_and_gapless(spark, messy, nothing):
    rng = random.Random(4)
    rows = [(i, "y" * rng.choice([1, 10, 500])) for i in range(400)] + [(1000 + i, "z" * 300 + str(i)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, 8).collect()
    texts = dict(rows)
    size, placed, order = {}, {}, {}
    for r in got:
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id]) + 8
        size[texts[r.doc_id]] = size.get(texts[r.doc_id], 0) + r.size
        assert placed.setdefault(texts[r.doc_id], r.shard) == r.shard
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    bound = sum(size.values()) // (sharding.HEAVY * 8)
    line = sorted(size, key=lambda t: (size[t] <= bound, -size[t] if size[t] > bound else 0, hashes[t]))
    loads = [sum(v for t, v in size.items() if placed[t] == s) for s in range(8)]
    assert max(loads) == minimax([size[t] for t in line], 8)
    mixed = sharding.shard(messy, 4).collect()
    assert len(mixed) == messy.count() and {r.shard for r in mixed} <= set(range(4))
    assert sharding.shard(nothing, 4).count() == 0


def test_slots_of_a_row_that_is_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    hot = F.col("id") % 3 == 0
    docs = spark.range(2000).select(F.when(hot, -1).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(hot, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = sharding.shard(docs, 5).collect()
    assert len(got) == 2000 and len({r.shard for r in got if r.doc_id == -1}) == 1
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())


def test_page_text(spark):
    pages = ["<html><head><title>t</title><script>var a='<p>x</p>';</script></head><body><nav><a href=x>Home</a></nav>"
             "<article><h1>Title</h1><p>One &amp;  two.<p><b>Three\nfour<br>five</article><div class='ad'>Buy.</div>"
             "<footer>&copy; 2020</footer></body></html>", None, "", "<p", "<article><p>unclosed &lt;tag&gt; text here"]
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(pages)], "page_id long, html string, text string")
    got = [r.text for r in html_extract.main_text(df, ["page_id"]).orderBy("page_id").collect()]
    assert got[0] == "Title One & two. Three four five" and got[1:3] == ["", ""]
    assert got[4] == "unclosed <tag> text here"
    assert html_extract.main_text(df.limit(0), ["page_id"]).count() == 0


def test_page_text_keeps_all_of_an_article():
    """Formulas, stand-in text and paragraphs under layout names stay; noise beside and in the article goes."""
    page = ("<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><div class='top'><p>First paragraph of all.</p>"
            "</div><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be so. <noscript>Plain."
            "</noscript> <object>Object.</object> <canvas>Canvas.</canvas></p><div id='more'><p>The story goes on here."
            "</p></div><div class='ad'>Buy now.</div></article><div class='bottom'>Imprint.</div><footer>f</footer></body></html>")
    assert html_extract.extract([page], html_extract.trained()) == [
        "Title First paragraph of all. Let x=1 be so. Plain. Object. Canvas. The story goes on here."]


def test_page_marginals_match_enumeration():
    page = html_extract.parse("<article><h1>a</h1><div><p>b b b.</p><ul><li>c</ul></div></article><footer>d</footer>")
    x, tie, depth = html_extract.block_features(page, html_extract.run_texts(page))
    rng = np.random.default_rng(0)
    weights, pair = rng.normal(size=x.shape[1]), rng.normal(size=(html_extract.TIES, 2, 2))
    forest = html_extract.Forest([np.array(page.parent)], [x], [tie], [depth])
    n, total, mass = len(page.parent), 0.0, np.zeros(len(page.parent))
    for state in range(2 ** n):
        y = [(state >> k) & 1 for k in range(n)]
        p = np.exp(sum(float(x[k] @ weights) * y[k] for k in range(n))
                   + sum(pair[tie[k], y[page.parent[k]], y[k]] for k in range(1, n)))
        total, mass = total + p, mass + p * np.array(y)
    assert np.allclose(forest.marginals(weights, pair)[0], mass / total)


def test_line_dedup_matches_brute_force(spark, messy, nothing):
    rng, lines = random.Random(5), []
    for _ in range(40):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([4, 60, 300])))
        lines += [base, base, base[:-1] + "#", base[:len(base) // 2]]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(6)) + "\n\nend") for i in range(60)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first, sets = {}, {}
    for i, t in rows:
        for k, x in enumerate(t.split("\n")):
            if words(x):
                first.setdefault(x, (i, k))
                sets[x] = {x[a:a + 10] for a in range(max(1, len(x) - 9))}
    root = {x: x for x in first}
    for x in first:
        for y in first:
            if x < y and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]):
                a, b = root[x], root[y]
                root = {k: b if v == a else v for k, v in root.items()}
    owner = {r: min(first[x] for x in first if root[x] == r) for r in set(root.values())}
    wrong = 0
    for i, t in rows:
        kept = [x for k, x in enumerate(t.split("\n")) if not words(x) or owner[root[x]] == (i, k)]
        wrong += got[i].text != "\n".join(kept)
    assert wrong <= 1  # banding finds all but a few in a thousand links
    out = line_dedup.dedup_lines(messy)
    assert out.count() == messy.count() and set(messy.columns) <= set(out.columns)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_small_buckets_leave_after_the_first_round(spark, monkeypatch):
    """All pairs of a small bucket meet in the first round; only larger buckets go on."""
    members = spark.createDataFrame([(1, n) for n in range(5)] + [(2, n) for n in range(100, 200)], "key long, node long")
    seen, near, other = [], linkage.near_pairs, linkage.other_pairs

    def watched(found):
        def run(rows, *rest):
            seen.append(rows.count())
            return found(rows, *rest)
        return run

    monkeypatch.setattr(linkage, "near_pairs", watched(near))
    monkeypatch.setattr(linkage, "other_pairs", watched(other))
    linked = linkage.linked_components(members, members.select("node"), F.lit(True), lambda p: p, few_keys=True)
    assert {r.node: r.root for r in linked.collect()} == {n: 0 if n < 5 else 100 for n in [*range(5), *range(100, 200)]}
    assert seen == [105, 100, 100]


def test_buckets_that_stars_compare_wholly_leave_at_once(spark, monkeypatch):
    """The pairs with the least and greatest member are all pairs of two or three."""
    sizes = {1: 2, 2: 3, 3: 4, 4: 70}
    members = spark.createDataFrame([(k, 100 * k + n) for k, c in sizes.items() for n in range(c)], "key long, node long")
    seen, near, other = [], linkage.near_pairs, linkage.other_pairs

    def watched(found):
        def run(rows, *rest):
            seen.append({r.key for r in rows.select("key").distinct().collect()})
            return found(rows, *rest)
        return run

    monkeypatch.setattr(linkage, "near_pairs", watched(near))
    monkeypatch.setattr(linkage, "other_pairs", watched(other))
    asked = []
    linked = linkage.linked_components(members, members.select("node"), F.lit(True), lambda p: (
        asked.extend(map(tuple, p.collect())), p.where("a < 300 or a % 100 < 2"))[1], few_keys=True)
    assert {r.node: r.root for r in linked.collect()} == {100 * k + n: 100 * k for k, c in sizes.items() for n in range(c)}
    assert seen == [{3, 4}, {4}, {4}]
    assert {p for p in asked if p[0] < 300} == {(100, 101), (200, 201), (200, 202), (201, 202)}


def test_shared_members_match_brute_force(spark, monkeypatch):
    """Common keys, keys of one node, repeated rows and nodes without keys; with parts
    that are looked through in many pieces, too."""
    rng = random.Random(8)
    rows = [(n, [rng.choice([7, rng.randrange(-400, 400), rng.randrange(2 ** 62)]) for _ in range(rng.randrange(6))])
            for n in range(1500)]
    rows += rows[:50] * 3 + [(-1, [2 ** 62 + 1] * 4)]
    nodes = {}
    for n, keys in rows:
        for k in keys:
            nodes.setdefault(k, set()).add(n)
    want = sorted((k, n) for k, x in nodes.items() if len(x) > 1 for n in x)
    buckets = spark.createDataFrame([(keys, n) for n, keys in rows], "keys array<long>, node long")
    for pairs in (0, 5000, 40 * linkage.PART):
        assert sorted(map(tuple, linkage.shared_members(buckets, "node", pairs).collect())) == want
    monkeypatch.setattr(linkage, "PART", 16)
    batches = [pa.RecordBatch.from_arrays([pa.array([k for _, k in rows[i:i + 9]], pa.list_(pa.int64())),
                                           pa.array([n for n, _ in rows[i:i + 9]])], names=["keys", "node"])
               for i in range(0, len(rows), 9)]
    dealt = pa.Table.from_batches(list(linkage._dealt(3)(iter(batches)))).sort_by("part")
    found = pa.Table.from_batches(list(linkage._shared(iter(dealt.to_batches(max_chunksize=5))))).to_pydict()
    assert sorted(set(zip(found["key"], found["node"], strict=True))) == want


def test_rules_by_marginal_cost(spark, messy, nothing):
    # rule 1 is dear by itself and cheap behind rule 0; rule 2 rejects nothing that rule 0 leaves
    costs = {(before, k): {0: 1.0, 1: 9.0, 2: 1.5}[k] for before in (-1, 0, 1, 2) for k in range(3)} | {(0, 1): 0.1}
    assert rules.greedy(costs, {"101": 6.0, "100": 8.0, "010": 2.0, "000": 4.0}, 3) == [0, 1, 2]
    assert rules.greedy(costs, {"001": 6.0, "100": 8.0, "010": 2.0}, 3) == [0, 1, 2]
    assert rules.greedy({k: 1.0 for k in costs}, {"001": 6.0, "100": 8.0, "010": 2.0}, 3) == [0, 2, 1]
    for part in (messy, messy.limit(1), nothing):
        assert sorted(r.name for r in rules.order_rules(part)) == sorted(r.name for r in rules.RULES)
    kept = [r.doc_id for r in rules.report(messy).collect() if r.kept]
    left = rules.filter_rows(messy)
    assert left.columns == messy.columns and sorted(r.doc_id for r in left.collect()) == sorted(kept) and kept
    assert rules.filter_rows(nothing).count() == 0


def test_personal_data(spark, messy, nothing):
    got = {r.doc_id: r.spans for r in pii_crf.find(messy).collect()}
    assert [s.kind for s in got[10]] == ["email", "phone", "ip"] and all(s.base for s in got[10])
    assert got[0] == [] and got[1] == []
    assert pii_crf.find(nothing).count() == 0
    patterns = {0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]"}
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("1234567890..+-() @a%é") for _ in range(rng.randint(0, 40)))
        expected = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split("."))
                        or kind == 2 and 12 <= len(digits) <= 19 and pii_crf.luhn(digits)
                        or kind == 3 and 9 <= len(digits) <= 15):
                    expected.append((m.start(), kind, m.end()))
        assert pii_crf.base_spans(text) == sorted(expected)


def test_crf_decodes_held_out_sentences():
    table = pii_crf.labelled_sentences()
    model = pii_crf.Crf().fit(table[300:])
    right = total = 0
    for sentence, labels in table[:300]:
        opened = np.array([pii_crf.is_open(w) for w in sentence])
        for a, b in zip(*pii_crf.runs_of(opened), strict=True):
            scores = np.array([[model.emission(sentence, k) for k in range(a, b)]])
            path = [pii_crf.LABELS[k] for k in model.viterbi(scores)[0]]
            right += path == labels[a:b]
            total += 1
    assert right / total > 0.95


def test_viterbi_matches_enumeration():
    rng = np.random.default_rng(3)
    model, n = pii_crf.Crf(), len(pii_crf.LABELS)
    allowed = model.moves > -1e8
    model.moves = np.where(allowed, rng.normal(size=model.moves.shape), -1e9)
    for size in (1, 2, 4):
        scores = rng.normal(size=(5, size, n))
        for run, path in zip(scores, model.viterbi(scores), strict=True):
            def total(labels, run=run):
                return sum(model.moves[a, b] + run[k, b] for k, (a, b) in enumerate(zip((n, *labels), labels, strict=False)))
            assert tuple(path) == max(itertools.product(range(n), repeat=size), key=total)


#: Texts of forms that the training table does not hold; [kind:...] marks what is to be found.
UNSEEN = ("dial [phone:555 123 4567] now", "[phone:(0171) 123-4567] is the number", "tel. [phone:089/1234567]",
          "phone [phone:0044 20 7946 0958] please", "fax: [phone:030-1234567].", "host [ip:2001:db8::1] is down",
          "server [ip:fe80::1a2b:3c4d:5e6f], rack 7", "ip [ip:2001:0db8:0000:0000:0000:ff00:0042:8329] seen",
          "write [email:root@localhost] or [email:ann@mail]", "card [card:4111.1111.1111.1111] was used",
          "it began 2023-04-05 12:30:45 sharp", "12 345 678 901 people", "some 12 345 678 901 people live there",
          "at 2023-04-05T12:30:45Z it ended", "on 05.04.2023 12:30 we met", "from 2023/04/05 01:02:03 on",
          "1 234 567 rows", "sum 123 456 789 in all", "time 12:30:45.", "follow @home", "pages 100-120, 130-150",
          "version 10.2.300 is out", "ratio 3:2:1 holds", "isbn 978-3-16-148410-1", "in 1999 2000 and 2001",
          "id 550e8400-e29b-41d4-a716-446655440000", "chapter 12:30 of 1611", "1 2 3 4 5 6 7 8 9 10 11 12")


def test_pii_on_unseen_forms(spark):
    marked, texts = [], []
    for given in UNSEEN:
        spans, text = set(), ""
        for part in re.split(r"(\[(?:phone|ip|email|card):[^\]]*\])", given):
            if part.startswith("["):
                kind, _, part = part[1:-1].partition(":")
                spans.add((kind, len(text), len(text) + len(part)))
            text += part
        marked.append(spans)
        texts.append(text)
    got = pii_crf.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in got}
    right = sum(len(found[k] & spans) for k, spans in enumerate(marked))
    assert right >= 0.9 * sum(map(len, marked))           # recall
    assert right >= 0.9 * sum(map(len, found.values()))   # precision


def test_pii_is_linear_in_a_word():
    word = "1" + "!" * 1_000_000 + "a"
    began = time.perf_counter()
    assert pii_crf.core(word) == (0, len(word)) and pii_crf.core(word[:-1]) == (0, 1)
    assert len(pii_crf.features(word)) >= 4 and time.perf_counter() - began < 5
    base = [(0, 2, 20), (5, 3, 12), (30, 1, 40)]
    assert pii_crf._covered(base) == ([0, 30], [20, 40])


def test_url_filter_matches_brute_force(spark):
    urls = ["https://Www.Example.com/en/a?x#y", "http://example.com/en/", "http://a.b.net/es/1", "x", None, "", "a://b.com",
            "a://b.com/", "http://net/fr", "http://q.net/fr/x/y", "http://notexample.com/en/z", "ftp://EXAMPLE.COM/EN/1",
            "http://x.org/" + "d/" * 2000, "http://a.net/es/?u=http://com/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")

    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "key string")

    allow, block = ("com/", "www.example.com/en/"), ("example.com/en/", "net/es/", "net/fr/")
    expected = {}
    for i, u in enumerate(urls):
        _, found, rest = (u or "").partition("://")
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest if found else "").groups()
        host = host.lower()
        fits = [k for k in allow + block if ("." + host).endswith("." + k.split("/")[0])
                and path.startswith(k[k.index("/"):])]
        best = max(fits, key=len, default=None)
        expected[i] = (host, path, best, "block" if best in block else "allow")
    got = url_filter.judge(pages, keys(*allow, None, "com/"), keys(*block))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == expected
    assert url_filter.judge(pages.limit(0), keys(*allow), keys(*block)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, keys(), keys()).collect()} == {"allow"}


def test_cascade_is_exact_for_long_lists(spark):
    universe = spark.range(20000).select(F.concat(F.lit("h"), "id", F.lit("/")).alias("key"))
    listed = universe.where("pmod(xxhash64(key), 3) = 0")
    found = url_filter.cascade(listed, universe)
    assert len(found.levels) > 1
    wrong = universe.where(found.holds(F.col("key")) != (F.pmod(F.xxhash64("key"), F.lit(3)) == 0))
    assert wrong.count() == 0


def test_decontamination(spark, messy, nothing):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(20)) + ". " + " ".join(
        rng.choice(vocabulary) for _ in range(5)) + ".") for i in range(60)] + [(None, None), (99, "")]
    clean = [" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(clean)]
    for k in range(20):
        noisy = items[k][1].upper().replace(" ", "%%% \n") if k % 2 else items[k][1]
        docs.append((100 + k, clean[k] + " " + noisy + " " + clean[k + 1]))
        docs.append((200 + k, clean[k] + " " + items[k][1][:25]))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, tests).collect()}
    assert got == {(100 + k, k) for k in range(20)}
    assert decontaminate.leaks(messy, tests).count() == 0 and decontaminate.leaks(nothing, tests).count() == 0
    assert decontaminate.leaks(docs, tests.limit(0)).count() == 0


def test_decontamination_in_parts_equals_one_index(spark, monkeypatch):
    """Scores, the threshold and the passages are those over all items, however many indexes hold them."""
    rng = random.Random(9)
    vocabulary = [f"v{int(rng.expovariate(0.02))}" for _ in range(2000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 40))) + ". "
              + " ".join(rng.choice(vocabulary) for _ in range(3)) + ".") for i in range(80)]
    items += [items[0], (None, items[1][1])]
    docs = []
    for k in range(160):  # from whole items down to about half of one
        held = items[k % 80][1].split()
        held = [w for w in held if rng.random() < 1 - k / 320]
        docs.append((k, " ".join(rng.choice(vocabulary) for _ in range(90)) + " " + " ".join(held)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, decontaminate.leaks(docs, tests).collect()))
    assert len(one) > 40
    monkeypatch.setattr(decontaminate, "INDEX_TERMS", 500)
    assert sorted(map(str, decontaminate.leaks(docs, tests).collect())) == one


def test_a_long_item_leaves_passages_of_short_ones_alone(spark):
    """Words of a short item scattered over a document are no leak, however long other items are; ids are of any type."""
    rng = random.Random(10)
    short = " ".join(f"s{k}" for k in range(24)) + ". " + " ".join(f"a{k}" for k in range(6)) + "."
    long = " ".join(f"l{rng.randrange(900)}" for _ in range(700)) + ". " + " ".join(f"e{k}" for k in range(9)) + "."
    held = short.split()
    parts = [held[:8], held[8:16], held[16:24], held[24:]]
    scattered = " ".join(" ".join(p + [f"x{rng.randrange(500)}" for _ in range(150)]) for p in parts)
    filler = " ".join(f"x{rng.randrange(500)}" for _ in range(900))
    docs = spark.createDataFrame([("whole", f"{filler} {short} {filler}"), ("scattered", scattered),
                                  ("long", f"{filler} {long} {filler}")], "doc_id string, text string")
    tests = spark.createDataFrame([("short", short), ("long", long)], "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, tests).collect()}
    assert got == {("whole", "short"), ("long", "long")}
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, tests.where("item_id = 'short'")).collect()} == {
        ("whole", "short")}


def test_wand_retrieves_all_above_threshold():
    rng = random.Random(8)
    index = decontaminate.build([(i, " ".join(f"v{int(rng.expovariate(0.05))}" for _ in range(12))) for i in range(80)])
    for _ in range(200):
        terms = sorted(rng.sample(range(len(index.vocabulary)), 12))
        scores = np.zeros(len(index.ids))
        for t in terms:
            at = slice(index.start[t], index.start[t + 1])
            scores[index.item[at]] += index.weight[at]
        for threshold in (0.1, 0.3):
            assert {i for i, _ in decontaminate.wand(index, terms, threshold)} == set(
                np.flatnonzero(scores >= threshold - 1e-9).tolist())


def test_index_grows_with_its_postings(monkeypatch):
    """No array of the index has a place for each pair of term and block."""
    rng = random.Random(10)
    index = decontaminate.build([(i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(10))) for i in range(2000)])
    assert max(np.size(x) for x in vars(index).values() if isinstance(x, np.ndarray)) <= len(index.item) + 1
    blocks = np.zeros((len(index.vocabulary), index.blocks))
    term = np.repeat(np.arange(len(index.vocabulary)), np.diff(index.start))
    np.maximum.at(blocks, (term, index.item // decontaminate.BLOCK), index.weight)
    assert (index.top == blocks.max(axis=1)).all()
    texts = [rng.sample(range(len(index.vocabulary)), 30) for _ in range(100)]
    texts += [term[index.item == rng.randrange(2000)][:rng.randint(4, 10)].tolist() for _ in range(100)]
    ends = np.cumsum([0, *map(len, texts)])
    expected = [p for p, own in enumerate(texts) if (blocks[sorted(set(own))].sum(axis=0) >= decontaminate.SCORE).any()]
    for cells in (1 << 20, 1):
        monkeypatch.setattr(decontaminate, "CELLS", cells)
        found = decontaminate.candidates(index, index.vocabulary[np.concatenate(texts)], ends[:-1], ends[1:])
        assert found.tolist() == expected and 50 < len(expected) < 150


def test_decontamination_in_any_script(spark):
    """Separators of all scripts, and items within text that has no blanks."""
    rng = random.Random(11)
    latin = " ".join(f"wört{rng.randrange(10 ** 4)}" for _ in range(12)) + ". " + "ΤΈΛΟΣ alpha naïve beta."
    han = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(24))
    thai = "".join(chr(rng.randrange(0xE01, 0xE2F)) for _ in range(24))
    tests = spark.createDataFrame([(0, latin), (1, han), (2, thai)], "item_id long, text string")
    kana = "".join(chr(rng.randrange(0x3041, 0x3090)) for _ in range(40))
    docs = [latin.replace(" ", "\u00a0"), latin.replace(" ", "\u2014"), latin.replace(" ", "\u201d \u201c"),
            latin.replace(" ", "\u3001"), kana + han + kana, kana + "\u3002".join(han) + kana, "x" + thai + kana, kana,
            latin.lower()]
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, tests).collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 2), (8, 0)}


def test_words_are_those_of_the_pattern():
    texts = [t or "" for t in TEXTS]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = words_of(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    flat = b"".join(raw)
    for k, text in enumerate(texts):
        own = range(found.first[k], found.first[k + 1])
        assert [flat[found.start[i]:found.end[i]].decode() for i in own] == words(text)
    assert hashlib.sha256(flat).hexdigest()


def test_line_dedup_order_of_ties(spark):
    """Null ids first, then the least id; a repeated id by text hash; a repeated row counts once."""
    line, near = "the same line stands in all of these documents", "the same line stands in all of these documents!"
    other = "nothing of this is to be found in any other text"
    rows = [(3, line), (None, near), (3, line), (1, f"{line}\n{near}\n{other}"), (1, f"{other}\n{line}")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.text for r in got if r.doc_id is None] == [near]
    assert [(r.text, r.n_lines, r.n_kept) for r in got if r.doc_id == 3] == [("", 1, 0)] * 2
    assert sorted(r.n_kept for r in got if r.doc_id == 1) == [0, 1]
    assert [r.text for r in got if r.n_kept and r.doc_id == 1] == [other]


def test_line_dedup_of_one_repeated_character(spark):
    """Ten equal characters have the one shingle that longer runs of them have."""
    rows = [(1, "-" * 10 + "\nabcdefghij"), (2, "-" * 12), (3, "-" * 9), (4, "abcdefghij\n" + "-" * 10)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "", 3: "-" * 9, 4: ""}


def test_url_filter_bounds_every_level(spark, monkeypatch):
    """A level that had to encode more keys than the bound is not built; the lists are joined."""
    monkeypatch.setattr(url_filter, "MOST_LISTED", 120)
    counts = []
    monkeypatch.setattr(url_filter, "_build", lambda keys, n, level, own=url_filter._build: (
        counts.append(n), own(keys, n, level))[1])
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit("/x")).alias("url"))
    listed = pages.where("page_id % 60 = 0").select(F.concat(F.lit("h"), "page_id", F.lit("/")).alias("key"))
    got = url_filter.judge(pages, listed.limit(0), listed).collect()
    assert counts and max(counts) <= 120
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 6000, 60)) and len(got) == 6000
    assert all((r.rule is None) == (r.verdict == "allow") for r in got)


def test_features_see_whole_words():
    """An @, digits and shape classes far behind a word's head count like near ones."""
    head = "a" * 300
    assert "@=TrueTrueTrue" in pii_crf.features(f"{head}@host.example")
    assert "k=@" in pii_crf.features(f"{head}@1") and "d=7" in pii_crf.features(f"{head}1234567")
    assert "luhn=True" in pii_crf.features("4" + "." * 220 + "11111111111111" + "." * 10 + "1")
    long = "a1" * 20
    shapes = {pii_crf.shape(long + t) for t in ("", "-", "-a", "-1", "12345")}
    assert len(shapes) == 5 and len(pii_crf.shape("a1-" * 10000)) < 80
    assert pii_crf.shape("+1 (555) 123".replace(" ", "")) == "+01(03)03"
