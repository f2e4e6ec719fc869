"""The stages of the pipeline on rows with null and repeated ids."""

import random

import pytest

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed, size=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 5)}" for _ in range(size))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{k}", None if t is None else len(t))
                                  for k, (i, t) in enumerate(rows)], SCHEMA)


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("many", [2, 30])
def test_near_copies_by_row(spark, many):
    a, b, c, d, e = map(text, range(5))
    near = a + " tail"
    rows = [(5, a), (None, near), (5, near)]                # one class: the smallest id, then the least hash
    rows += [(7, b)] * many                                 # one row repeated
    rows += [(5, c), (9, c)]                                # another text of id 5
    rows += [(None, d), (None, d + " tail")]                # no id at all
    rows += [(None, e)]
    rows += [(1, ""), (2, ""), (2, ""), (None, None), (None, None), (3, None)]  # without a word: by id and text
    got = left(P.drop_near_copies(spark, table(spark, rows), ""))
    first, nameless = ([x for x in got if x[1] in (t, t + " tail")] for t in (a, d))
    assert [i for i, _ in first] == [5] and [i for i, _ in nameless] == [None]
    assert [x for x in got if x not in first + nameless] == sorted(
        [(7, b), (5, c), (None, e), (1, ""), (2, ""), (None, None), (3, None)], key=str)
    assert left(P.drop_near_copies(spark, table(spark, rows[::-1]), "")) == got


def test_leaks_by_row(spark, tmp_path):
    item, a, b = text(10, 30), text(11), text(12)
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = f"{a} {item} {b}"
    rows = [(None, leak), (None, a), (1, leak), (1, b), (2, leak), (2, leak), (3, None), (None, None), (4, b)]
    got = left(P.drop_leaks(spark, table(spark, rows), str(tmp_path)))
    assert got == sorted([(None, a), (1, b), (3, None), (None, None), (4, b)], key=str)
