"""Quality classifier: an additive model with pairwise interactions.

Each feature is cut into quantile bins.  Cyclic boosting visits the features
in turn, fits one shallow tree to the current gradient over the feature's bins
and adds its steps to the feature's lookup table; then the pairs whose grids
explain most of what is left get tables of their own in the same way.  A text's
score is the logistic function of the sum of its bins' table entries, so
scoring is a handful of vectorised lookups and additions.

Training takes a bounded sample of labelled rows (`TRAIN_ROWS`, chosen by the
hash of the id, so it is the same on every run); scoring covers every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.store import unused
from portolan.llm.textstats import FEATURES, Stats
from portolan.llm.words import text_chunks

#: At most this many labelled rows are gathered for training (a matrix of a
#: few MB on the driver).
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, LEAVES = 48, 12, 3
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, RIDGE, LEAST = 120, 40, 8, 0.15, 2.0, 8


@dataclass
class Gam:
    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        if self.pairs:
            coarse = {k: np.searchsorted(self.pair_cuts[k], x[:, k], side="right")
                      for p in self.pairs for k in p[:2]}
            for a, b, table in self.pairs:
                total += table[coarse[a], coarse[b]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher")) if len(x) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, int]:
    """(gain, position) of the best split of successive bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, cl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(c)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    gain = np.where((cl >= LEAST) & (c.sum() - cl >= LEAST), gain, 0.0)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Step per bin of a tree with up to LEAVES leaves, grown best first."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = max(((*_best_cut(g[a:b], h[a:b], c[a:b]), a, b) for a, b in leaves), key=lambda x: x[0])
        if best[0] <= 1e-9:
            break
        _, at, a, b = best
        leaves.remove((a, b))
        leaves += [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """(step per cell, gain) of a depth-two tree over a grid: one split of one
    side, then one split of the other side in each half."""
    best: tuple[float, np.ndarray] = (0.0, np.zeros_like(g))
    for flip in (False, True):
        gg, hh, cc = (m.T if flip else m for m in (g, h, c))
        for at in range(1, gg.shape[0]):
            step, total = np.zeros_like(gg), -float(_gain(g.sum(), h.sum()))
            for rows in (slice(0, at), slice(at, None)):
                gs, hs, cs = gg[rows].sum(0), hh[rows].sum(0), cc[rows].sum(0)
                gain, cut = _best_cut(gs, hs, cs)
                total += gain + float(_gain(gs.sum(), hs.sum()))
                for cols in ((slice(0, cut), slice(cut, None)) if gain > 0 else (slice(None),)):
                    step[rows, cols] = gs[cols].sum() / (hs[cols].sum() + RIDGE)
            if total > best[0]:
                best = (total, step.T if flip else step)
    return best[1], best[0]


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on a feature matrix and 0/1 labels.  Without rows the model scores
    0.5 everywhere; with one class only, the smoothed share of that class."""
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    cuts = [_quantile_cuts(x[:, k], BINS) for k in range(x.shape[1])]
    gam = Gam(float(np.log(rate / (1 - rate))), cuts, [np.zeros(len(c) + 1) for c in cuts])
    if len(np.unique(y)) < 2:
        return gam
    bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)]
    total = np.full(len(y), gam.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = slopes()
            n = len(gam.tables[k])
            step = RATE * _shallow_tree(np.bincount(b, g, n), np.bincount(b, h, n), np.bincount(b, minlength=n))
            gam.tables[k] += step
            total += step[b]

    gam.pair_cuts = [_quantile_cuts(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(gam.pair_cuts)]

    def grid(a: int, b: int) -> tuple[np.ndarray, ...]:
        shape = (len(gam.pair_cuts[a]) + 1, len(gam.pair_cuts[b]) + 1)
        cell, size = coarse[a] * shape[1] + coarse[b], shape[0] * shape[1]
        g, h = slopes()
        return tuple(m.reshape(shape) for m in (
            np.bincount(cell, g, size), np.bincount(cell, h, size), np.bincount(cell, minlength=size)))

    ranked = sorted(((_pair_tree(*grid(a, b))[1], a, b)
                     for a in range(len(cuts)) for b in range(a + 1, len(cuts))), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 1e-6]
    gam.pairs = [(a, b, np.zeros((len(gam.pair_cuts[a]) + 1, len(gam.pair_cuts[b]) + 1))) for a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in gam.pairs:
            step = RATE * _pair_tree(*grid(a, b))[0]
            table += step
            total += step[coarse[a], coarse[b]]
    return gam


def _featurizer(batches):
    """mapInArrow: (label, text) -> (label, features)."""
    for batch in batches:
        for i, j, data, offsets in text_chunks(batch.column(1)):
            x = Stats(data, offsets).features()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.FixedSizeListArray.from_arrays(
                    pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["label", "features"])


def _scorer(model: Gam):
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                piece = batch.slice(i, j - i)
                score = model.score(Stats(data, offsets).features())
                yield pa.RecordBatch.from_arrays(
                    piece.columns[:-1] + [pa.array(score)], names=[*batch.schema.names[:-1], "score"])
    return run


def train(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Gam:
    """Fit on at most ``rows`` labelled documents, taken in the order of the
    hash of their ids.

    Rows with a null id or label are not used; an id with several labels counts
    with the smallest, a repeated document row as often as it stands there
    (within the bound).  ``held_out`` is a condition over ``id_col``; rows that
    meet it never reach training.
    """
    use = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isin(0, 1))
    if held_out is not None:
        use = use.where(~held_out)
    picked = (use.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.min(f"`{label_col}`").cast("int").alias("label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    # at most `rows` pairs of an id and a label: bounded by the parameter
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    sample = (texts.join(F.broadcast(picked), "_id").select("label", "_text")
              .mapInArrow(_featurizer, "label int, features array<double>")
              .orderBy(F.xxhash64("features"), "features", "label").limit(2 * rows).toPandas())
    x = np.array(sample["features"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, sample["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Gam, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``score`` (0 to 1); one row per input row.

    Null and empty texts get the score of a text without words."""
    keep = [c for c in docs.columns if c not in (text_col, "score")]
    text = unused("_text", keep)
    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text))
    schema = out.drop(text).withColumn("score", F.lit(0.0).cast("double")).schema
    return out.mapInArrow(_scorer(model), schema)
