"""Quality rules as a short-circuit cascade.

A rule looks at the statistics of a text and rejects or passes it.  A text
that one rule rejects needs no other, so the order decides the work: on a
sample the rules' costs and verdicts are measured, and the cascade takes, again
and again, the rule with the most rejections per second among the rows still
alive.  Rules share statistics, so a rule's cost is its marginal one: what it
takes once the rules before it have run.  The verdict does not depend on the
order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.textstats import Stats
from portolan.llm.words import text_chunks

#: Rows, about, whose statistics set the order of the rules (not the verdicts).
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Stats], np.ndarray]


#: Rules in whole numbers, so that SQL states them exactly.
FEW_WORDS = Rule("few_words", lambda s: s.n_words < 50)
REPETITION = Rule("repetition", lambda s: 100 * s.n_repeat_words > 50 * s.n_words)
SYMBOLS = Rule("symbols", lambda s: 100 * s.n_symbols > 40 * s.n_words)
UPPER_CASE = Rule("upper_case", lambda s: 100 * s.n_upper > 50 * s.word_chars)
SHOUTING = Rule("shouting", lambda s: 100 * s.n_marks > 50 * s.n_words)
DUP_LINES = Rule("dup_lines", lambda s: 100 * s.n_dup_lines > 60 * s.n_lines)
STUTTERS = Rule("stutters", lambda s: 100 * s.n_stutters > 30 * s.n_words)
WORD_LENGTH = Rule("word_length", lambda s: (s.word_chars < 2 * s.n_words) | (s.word_chars > 15 * s.n_words))
RULES = (FEW_WORDS, REPETITION, SYMBOLS, UPPER_CASE, SHOUTING, DUP_LINES, STUTTERS, WORD_LENGTH)


_COSTS = pa.schema([("after", pa.int64()), ("rule", pa.int64()), ("verdicts", pa.string()), ("amount", pa.float64())])


def _copy(stats: Stats) -> Stats:
    out = Stats(stats.data, stats.offsets)
    out.__dict__.update(stats.__dict__)
    return out


def _measurer(rules: tuple[Rule, ...], known: tuple[str, ...]):
    """mapInArrow over texts: seconds of each rule (``rule``, by number) behind
    each other rule (``after``; -1: behind none), and rows by ``verdicts``, a
    character per rule."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                start = Stats(data, offsets)
                for name in known:
                    getattr(start, name)
                rows, rejected = [], []
                for before in range(-1, len(rules)):
                    state = _copy(start)
                    if before >= 0:
                        rules[before].rejects(state)
                    for k, rule in enumerate(rules):
                        stats, began = _copy(state), time.perf_counter()
                        out = rule.rejects(stats)
                        rows.append({"after": before, "rule": k, "amount": time.perf_counter() - began})
                        if before < 0:
                            rejected.append(out)
                for pattern, n in zip(*np.unique(np.array(rejected, dtype=np.uint8).T, axis=0, return_counts=True),
                                      strict=True):
                    rows.append({"verdicts": "".join(map(str, pattern)), "amount": float(n)})
                yield pa.RecordBatch.from_pylist(rows, schema=_COSTS)
    return run


def greedy(costs: dict[tuple[int, int], float], verdicts: dict[str, float], rules: int) -> list[int]:
    """Rule numbers by rejections per second among the rows still alive.
    ``costs[after, rule]`` are seconds behind one other rule (-1: none); behind
    several a rule is as cheap as behind the best of them.  Rules without a
    rejection come last, cheapest first."""
    order: list[int] = []
    while len(order) < rules:
        ranks = {}
        for k in set(range(rules)) - set(order):
            cost = max(min(costs[before, k] for before in (-1, *order)), 1e-9)
            ranks[k] = -sum(n for v, n in verdicts.items() if v[k] == "1") / cost, cost
        best = min(ranks, key=ranks.get)
        order.append(best)
        verdicts = {v: n for v, n in verdicts.items() if v[best] == "0"}
    return order


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS, known: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """The rules in the order of the cascade, from a random sample of about
    ``sample_rows`` rows, measured where the rows are.  ``known`` names the
    statistics that are there before the first rule runs, at no cost to it."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select(F.col(f"`{text_col}`").cast("string").alias("_text")).sample(share, seed=4)
    seen = sample.mapInArrow(
        _measurer(rules, known), "after long, rule long, verdicts string, amount double").groupBy(
            "after", "rule", "verdicts").agg(F.sum("amount").alias("amount")).collect()
    if not seen:
        return rules
    costs = {(r["after"], r["rule"]): r["amount"] for r in seen if r["verdicts"] is None}
    verdicts = {r["verdicts"]: r["amount"] for r in seen if r["verdicts"] is not None}
    return tuple(rules[k] for k in greedy(costs, verdicts, len(rules)))


def survivors(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...],
              whole: Stats | None = None) -> np.ndarray:
    """Rows that no rule rejects; each rule sees the rows still alive.

    ``whole`` holds statistics of all rows that were computed before; rules use
    them until so many rows are out that a smaller chunk pays.
    """
    alive = np.arange(len(offsets) - 1)
    stats = whole or Stats(data, offsets)
    for rule in rules:
        if not len(alive):
            break
        left = ~rule.rejects(stats)
        if left.all():
            continue
        alive = alive[left]
        size = np.diff(stats.offsets)
        pieces = np.repeat(left, size)
        ends = np.zeros(int(left.sum()) + 1, dtype=np.int64)
        np.cumsum(size[left], out=ends[1:])
        stats = _subset(stats, left, pieces, ends)
    out = np.zeros(len(offsets) - 1, dtype=bool)
    out[alive] = True
    return out


def _subset(stats: Stats, left: np.ndarray, pieces: np.ndarray, ends: np.ndarray) -> Stats:
    """Statistics of the rows left: per-row ones known so far are carried over."""
    out = Stats(stats.data[pieces], ends)
    for name, value in vars(stats).items():
        if name.startswith("n_") or name == "word_chars":
            out.__dict__[name] = value[left]
    return out


def filter_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass every rule, in their own columns.  Each
    statistic is computed only for the rows that come to a rule that needs it.

    Null and empty texts have no words and fail the least number of words;
    repeated rows are judged alike; an empty table stays empty.
    """
    rules = order_rules(docs, rules, text_col)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for i, j, data, offsets in text_chunks(batch.column(at)):
                yield batch.slice(i, j - i).filter(pa.array(survivors(data, offsets, rules)))
    return docs.mapInArrow(run, docs.schema)


#: Statistics that the report shows of every row.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
REPORT_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                 "base_failed boolean, kept boolean")


def _reporter(rules: tuple[Rule, ...]):
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                s = Stats(data, offsets)
                failed = FEW_WORDS.rejects(s) | REPETITION.rejects(s)
                shown = [getattr(s, name) for name in SHOWN]
                kept = survivors(data, offsets, rules, s) & ~failed
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(v.astype(np.int64)) for v in shown],
                     pa.array(failed), pa.array(kept)],
                    names=["id", *SHOWN, "base_failed", "kept"])
    return run


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: id, base statistics, ``base_failed`` and the cascade's ``kept``.

    Null and empty texts have no words: all counts 0, base_failed, not kept.
    Repeated rows get a row each; other columns are not read.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(_reporter(order_rules(docs, rules, text_col, known=SHOWN)), f"id {id_type}, {REPORT_SCHEMA}") \
        .withColumnRenamed("id", id_col)
