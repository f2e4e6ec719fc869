"""Every registered opN_ query and the pipeline over the smallest tables,
against their SQL or brute force, and the scale rules of the native modules."""

import hashlib
import itertools
import math
import os
import re
import zlib
from html import unescape

import pytest

import __spark_entry__ as E
from portolan.llm import ngram_join, pii_crf, queries
from tests.conftest import SMALL
from tests.llm.test_operators import brute_components, minimax, shingle_set, words
from tests.test_oracle import _canon

pq = pytest.importorskip("pyarrow.parquet")


def rows(name, *columns):
    return [tuple(r.values()) for r in pq.read_table(f"{SMALL}/{name}.parquet", columns=list(columns)).to_pylist()]


@pytest.fixture(scope="module")
def docs():
    return rows("documents", "doc_id", "text")


@pytest.fixture(scope="module")
def run(spark):
    done = {}

    def result(name):
        if name not in done:
            done[name] = E.queries()[name](spark, SMALL).collect()
        return done[name]
    return result


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def tokens(text):
    import public_tokenizers
    import tiktoken
    ranks, pattern = queries.vocabulary()
    assert pattern == public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text or "")


def brute_lines(docs):
    """{id: (text, lines with a word, kept ones)} by all pairs of lines."""
    first, sets = {}, {}
    for i, t in sorted(docs):
        for k, x in enumerate((t or "").split("\n")):
            if words(x):
                first.setdefault(x, (i, k))
                sets[x] = {x[a:a + 10] for a in range(max(1, len(x) - 9))}
    root, order = {x: x for x in first}, sorted(first, key=lambda x: len(sets[x]))
    for p, x in enumerate(order):
        for y in order[p + 1:]:
            if 5 * len(sets[x]) < 4 * len(sets[y]):
                break
            both = len(sets[x] & sets[y])
            if 5 * both >= 4 * (len(sets[x]) + len(sets[y]) - both) and root[x] != root[y]:
                a, b = root[x], root[y]
                root = {k: b if v == a else v for k, v in root.items()}
    owner = {}
    for x in sorted(first, key=first.get):
        owner.setdefault(root[x], first[x])
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        worded = [k for k, x in enumerate(lines) if words(x)]
        gone = {k for k in worded if owner[root[lines[k]]] != (i, k)}
        out[i] = (None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone),
                  len(worded), len(worded) - len(gone))
    return out


def brute_leaks(docs, items):
    """(id, item) by BM25 of every passage and item, and the shares of shingles."""
    def terms(t):
        return re.findall(r"[^\W_]+", t.lower())

    def grams(w, n=3):
        n = min(n, len(w))
        return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()

    parts = []
    for i, t in items:
        t = re.sub(r"\s+", " ", t or "").strip()
        end = max([m.end() for m in re.finditer(r"[.!?](?=\s)", t)], default=len(t))
        q, a = terms(t[:end]), terms(t[end:])
        parts.append((i, q or a, a if q else q))
    n, mean = len(parts), sum(len(q + a) for _, q, a in parts) / len(parts)
    df = {}
    for _, q, a in parts:
        for w in set(q + a):
            df[w] = df.get(w, 0) + 1
    weights = []
    for _, q, a in parts:
        size, own = len(q + a), {}
        for w in set(q + a):
            tf = (q + a).count(w)
            own[w] = math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))
        weights.append({w: v / sum(own.values()) for w, v in own.items()})
    windows = [max(128, 2 ** (math.ceil(math.log2(len(q + a))) + 1)) for _, q, a in parts]
    out = set()
    for (i, t), window in itertools.product(docs, sorted(set(windows))):
        own = terms(t or "")
        for at in range(0, max(len(own) - window // 2, 1), window // 2):
            held = own[at:at + window]
            have, seen = set(held), set().union(*(grams(held, k) if len(held) >= k else set() for k in (1, 2, 3)))
            for (item, q, a), weight, size in zip(parts, weights, windows, strict=True):
                if size == window and sum(v for w, v in weight.items() if w in have) >= 0.6 - 1e-9 and len(
                        grams(q) & seen) >= 0.6 * len(grams(q)) and len(grams(a) & seen) >= 0.5 * len(grams(a)):
                    out.add((i, item))
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    found, expected = E.queries()[name](spark, SMALL), con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert _canon(found.columns, [tuple(r) for r in found.collect()]) == _canon(columns, expected.fetchall())


def test_every_query_is_registered_and_tested():
    other = os.path.join(os.path.dirname(__file__), "test_new_operators.py")
    source = open(__file__).read() + open(other).read().replace('E.queries()["', 'run("').replace('"](spark', '")(spark')
    names = {n for n in E.queries() if re.match(r"op\d+_", n)} | {"pipeline"}
    assert len(names) == 14
    assert all(n in queries.ORACLE or f'run("{n}")' in source for n in names)


def test_op1_and_all_links(spark, docs, run):
    root = brute_components(docs, 3, 9, 10)
    least = {r: min(i for (i, _), q in zip(docs, root, strict=True) if q == r) for r in root}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in run("op1_ngram_join")} == {
        (i, len(shingle_set(t, 3)), least[r]) for (i, t), r in zip(docs, root, strict=True)}
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3 + " ".join(f"n{k}" for k in range(60))
    few = [(k, f"{base} {x}") for k, x in enumerate(("", "1", "2", "3 4", "5 6 7 8 9 10 11 12 13", "1"))] + [(9, "other")]
    got = {tuple(sorted(r)) for r in ngram_join.similar_pairs(spark.createDataFrame(few, "doc_id long, text string")).collect()}
    sets = {i: shingle_set(t, 3) for i, t in few if i != 5}  # 5 is a copy of 1
    assert got == {(a, b) for a in sets for b in sets if a < b
                   and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])} and len(got) >= 3


def test_op2_op3_op6_op8(docs, run):
    scored = run("op2_quality")
    assert sorted(r.doc_id for r in scored) == sorted(i for i, _ in docs)
    assert all(r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
               for r in scored)
    truth = dict(rows("labels", "doc_id", "quality"))
    held = [r for r in scored if r.held_out and truth.get(r.doc_id) is not None]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.8 * len(held)
    texts = dict(docs)
    for r in run("op3_bpe"):
        ids = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == sha((texts[r.doc_id] or "").encode())
    pages = dict(rows("pages", "page_id", "html"))
    found = run("op6_html")
    assert sorted(r.page_id for r in found) == sorted(pages) and all(r.n_chars == len(r.text) for r in found)
    for r in found:  # these pages hold their text in one article, with inline <b> only
        article = re.search(r"<article>(.*)</article>", pages[r.page_id] or "", re.S)
        inner = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article[1])) if article else ""
        assert r.text == " ".join(unescape(inner).split())
    for r in run("op8_pii"):
        base = [(pii_crf.KINDS[k], a, b) for a, k, b in pii_crf.base_spans(texts[r.doc_id] or "")]
        assert [r[f"n_{k}"] for k in pii_crf.KINDS] == [sum(x[0] == k for x in base) for k in pii_crf.KINDS]
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode())


def test_op5(docs, run):
    texts, got = dict(docs), run("op5_sharding")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in got)
    loads, size = {}, {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        size[texts[r.doc_id]] = size.get(texts[r.doc_id], 0) + r.size
    assert set(loads) <= set(range(24)) and max(loads.values()) <= minimax(list(size.values()), 24) * 2
    for s in loads:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_op7(docs, run):
    expected = brute_lines(docs)
    got = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in run("op7_line_dedup")}
    assert set(got) == set(expected) and sum(got[i] != expected[i] for i in got) <= 1  # see test_operators


def test_op10(docs, run):
    expected = brute_leaks(docs, rows("benchmark", "item_id", "text"))
    assert {(r.doc_id, r.item_id) for r in run("op10_decontamination")} == expected and expected


def test_pipeline(docs, run):
    good = {r.doc_id for r in run("op2_quality") if r.predicted}
    cut = brute_lines([(i, t) for i, t in docs if i in good])
    left = sorted((i, t) for i, (t, n, kept) in cut.items() if kept or not n)
    root, seen, one = brute_components(left, 5, 4, 5), set(), []
    for (i, t), r in zip(left, root, strict=True):  # by id, so the first of a class stays
        if not (words(t) and r in seen):
            one.append((i, t))
        seen.add(r)
    leaks = {i for i, _ in brute_leaks(one, rows("benchmark", "item_id", "text"))}
    expected = {i: tokens(t) for i, t in one if i not in leaks}
    got = {r.doc_id: list(r.ids) for r in run("pipeline")}
    assert 0 < len(expected) < len(docs) and got == expected


def test_native_modules_keep_to_dataframe_operations():
    root = os.path.join(os.path.dirname(E.__file__), "portolan", "llm")
    for name in ("sharding.py", "url_filter.py"):  # op5 and op9
        source = open(os.path.join(root, name)).read()
        for banned in (r"\budf\(", r"pandas", r"mapInArrow", r"applyInArrow", r"\.rdd\b", r"crossJoin", r"localCheckpoint",
                       r"\.toPandas\(", r"\.toArrow\(", r"sparkContext", r"tempfile", r"\bopen\("):
            assert not re.search(banned, source), f"{banned} in {name}"
