"""Non-negative positive-unlabelled learning of linear text classifiers in numpy.

The risk of a classifier is estimated without any negative example, from positives,
unlabelled rows and the class prior p:

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

The part in ``max`` estimates the risk on negatives.  Where a batch drives it below
zero the classifier has begun to overfit, and that batch's step goes back up that part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import text as T

#: Maps bytes and row bounds to sparse features: each row's number of entries, columns, values.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Sparse:
    """Rows of features, one after the other."""

    counts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    def take(self, rows: np.ndarray) -> Sparse:
        ends = np.cumsum(self.counts)
        sizes = self.counts[rows]
        at = np.arange(sizes.sum()) + np.repeat(ends[rows] - np.cumsum(sizes), sizes)
        return Sparse(sizes, self.columns[at], self.values[at])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(self)), self.counts)
        return np.bincount(row, self.values * weights[self.columns], len(self))

    def only(self, kept: np.ndarray) -> Sparse:
        """The entries of the columns for which ``kept`` is true."""
        keep = kept[self.columns]
        row = np.repeat(np.arange(len(self)), self.counts)
        return Sparse(np.bincount(row[keep], minlength=len(self)), self.columns[keep], self.values[keep])

    def back(self, outer: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, self.values * np.repeat(outer, self.counts), width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def risk_and_gradient(pos: Sparse, unl: Sparse, weights: np.ndarray, prior: float,
                      non_negative: bool = True) -> tuple[float, float, np.ndarray]:
    """Positive part and negative part of the risk under logistic loss, and the step's gradient."""
    zp, zu = pos.dot(weights), unl.dot(weights)
    positive = prior * np.logaddexp(0, -zp).mean()
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    down = (unl.back(sigmoid(zu) / len(zu), len(weights))
            - pos.back(prior * sigmoid(zp) / len(zp), len(weights)))
    if non_negative and negative < 0:
        return positive, negative, -down
    return positive, negative, down + pos.back(-prior * sigmoid(-zp) / len(zp), len(weights))


def train(pos: Sparse, unl: Sparse, width: int, prior: float, epochs: int = 12,
          batch: int = 500, rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> np.ndarray:
    """Weights after Adam on the non-negative risk; the average over the last half of the steps."""
    rng = np.random.default_rng(seed)
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    mean, kept, step = np.zeros(width), 0, 0
    per_epoch = max(1, -(-len(unl) // batch), -(-len(pos) // batch))
    steps = max(200, epochs * per_epoch)
    orders = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def draw(which: int, data: Sparse) -> Sparse:
        size = min(len(data), batch)
        if len(orders[which]) < size:
            orders[which] = np.concatenate([orders[which], rng.permutation(len(data))])
        rows, orders[which] = orders[which][:size], orders[which][size:]
        return data.take(rows)

    while step < steps:
        step += 1
        gradient = risk_and_gradient(draw(0, pos), draw(1, unl), w, prior)[2] + decay * w
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient ** 2
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        if 2 * step > steps:
            mean, kept = mean + w, kept + 1
    return mean / kept


#: No smaller share of positives is estimated.
LEAST_PRIOR = 0.01


def estimate_prior(pos: np.ndarray, unl: np.ndarray, least: float = LEAST_PRIOR, most: float = 0.99,
                   confidence: float = 0.1) -> float:
    """Share of positives among unlabelled rows, from scores of rows not trained on.

    Above any threshold, unlabelled rows hold at least the prior times the positives'
    share there.  The threshold with the smallest upper confidence bound gives the estimate.
    """
    at = np.unique(pos)
    p = 1 - np.searchsorted(np.sort(pos), at, "left") / len(pos)
    u = 1 - np.searchsorted(np.sort(unl), at, "left") / len(unl)
    slack = (np.sqrt(np.log(4 / confidence) / (2 * len(unl)))
             + np.sqrt(np.log(4 / confidence) / (2 * len(pos))))
    best = np.argmin((u + slack) / p)
    return float(np.clip(u[best] / p[best], least, most))


def telling(pos: Sparse, unl: Sparse, width: int, always: int, most: int) -> np.ndarray:
    """Columns whose frequency differs most between positives and unlabelled rows.

    At most ``most`` columns, each at least three standard errors apart and seen in five
    rows; and all columns from ``always`` on.
    """
    n, m = len(pos), len(unl)
    a = np.bincount(pos.columns, minlength=width)
    b = np.bincount(unl.columns, minlength=width)
    share = (a + b) / (n + m)
    z = np.abs(a / n - b / m) / np.sqrt(np.maximum(1e-12, share * (1 - share)) * (1 / n + 1 / m))
    z[(a + b < 5) | (z < 3)] = 0
    kept = np.zeros(width, bool)
    kept[np.argsort(-z, kind="stable")[:most]] = True
    kept[z == 0] = False
    kept[always:] = True
    return kept


@dataclass
class Classifiers:
    """Linear classifiers over the same columns; the score is their mean probability."""

    columns: np.ndarray
    weights: np.ndarray  # a row for each column, a column for each classifier
    prior: float
    width: int
    nothing_learnt: bool = False

    def table(self) -> np.ndarray:
        """Place of each column in ``weights``; the row of zeros after the last for others."""
        places = np.full(self.width, len(self.columns), np.int32)
        places[self.columns] = np.arange(len(self.columns))
        return places

    def score(self, rows: Sparse, table: np.ndarray | None = None) -> np.ndarray:
        if self.nothing_learnt:
            return np.full(len(rows), self.prior)
        place = (self.table() if table is None else table)[rows.columns]
        weights = np.vstack([self.weights, np.zeros(self.weights.shape[1])])
        near = Sparse(rows.counts, place, rows.values)
        return np.mean([sigmoid(near.dot(w)) for w in weights.T], axis=0)


def fit(pos: Sparse, unl: Sparse, width: int, always: int, members: int = 3,
        prior: float | None = None, most: int = 1000) -> Classifiers:
    """Train ``members`` classifiers on bootstrap samples, after estimating the prior if not given.

    Without positives or without unlabelled rows there is nothing to learn from: there
    are no weights, and every score is the prior, the least that is ever estimated if not given.
    """
    if not len(pos) or not len(unl):
        return Classifiers(np.zeros(0, np.int64), np.zeros((0, 1)), LEAST_PRIOR if prior is None else prior, width, True)
    if prior is None:
        # Each half is scored by a classifier of positives against unlabelled rows of the other.
        seen: tuple[list, list] = ([], [])
        for own in (0, 1):
            a, b = pos.take(np.arange(own, len(pos), 2)), unl.take(np.arange(own, len(unl), 2))
            c, d = (pos.take(np.arange(1 - own, len(pos), 2)), unl.take(np.arange(1 - own, len(unl), 2)))
            if min(len(a), len(b), len(c), len(d)):
                kept = telling(a, b, width, always, most)
                w = train(a.only(kept), b.only(kept), width, 0.5, epochs=6, seed=9)
                seen[0].append(c.only(kept).dot(w))
                seen[1].append(d.only(kept).dot(w))
        prior = estimate_prior(*map(np.concatenate, seen)) if seen[0] else 0.5
    kept = telling(pos, unl, width, always, most)
    columns = np.flatnonzero(kept)
    places = np.cumsum(kept) - 1
    pos, unl = (Sparse(x.counts, places[x.columns], x.values) for x in (pos.only(kept), unl.only(kept)))
    weights = []
    for seed in range(members):
        rng = np.random.default_rng(seed + 1)
        p, u = (np.sort(rng.integers(0, len(x), len(x))) for x in (pos, unl))
        weights.append(train(pos.take(p), unl.take(u), len(columns), prior, epochs=30, seed=seed))
    return Classifiers(columns, np.stack(weights, axis=1), prior, width)


def _features(column: pa.Array, features: Features) -> Iterator[Sparse]:
    data, bounds = T.utf8(column)
    for lo, hi in T.groups(bounds):
        yield Sparse(*features(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]))


def gather(docs: DataFrame, features: Features, id_col: str, text_col: str,
           label_col: str | None = None) -> tuple[list, Sparse]:
    """Features of a bounded number of rows on the driver, in the order of id and text."""

    def run(batches):
        for batch in batches:
            columns, values = [], []
            for part in _features(batch.column(3), features):
                cuts = np.cumsum(part.counts)[:-1]
                columns += [x.tobytes() for x in np.split(part.columns.astype(np.int32), cuts)]
                values += [x.tobytes() for x in np.split(part.values.astype(np.float32), cuts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(columns, pa.binary()),
                                              pa.array(values, pa.binary())],
                                             names=["id", "h", "label", "columns", "values"])

    T.prepare_workers(docs.sparkSession)
    chosen = docs.select(F.col(id_col).cast("string").alias("id"),
                         F.xxhash64(F.col(text_col)).alias("h"),
                         (F.col(label_col) if label_col else F.lit(None)).cast("string").alias("label"),
                         F.col(text_col).alias("text"))
    rows = sorted(chosen.mapInArrow(run, "id string, h long, label string, columns binary, values binary").collect(),
                  key=lambda r: (r["id"] or "", r["h"], r["label"] or ""))
    columns = [np.frombuffer(r["columns"], np.int32) for r in rows]
    values = [np.frombuffer(r["values"], np.float32) for r in rows]
    none = [np.zeros(0, np.int32)]
    return rows, Sparse(np.array([len(c) for c in columns], np.int64),
                        np.concatenate(none + columns), np.concatenate([np.zeros(0, np.float32)] + values))


def learn(docs: DataFrame, positives: DataFrame, features: Features, width: int, always: int,
          unlabelled: DataFrame | None = None, max_positives: int = 3000, max_unlabelled: int = 6000,
          prior: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> Classifiers:
    """Classifiers from the rows of ``docs`` whose id is in ``positives``, and unlabelled rows.

    ``unlabelled`` is ``docs`` if not given.  Of either kind at most ``max_positives`` and
    ``max_unlabelled`` rows are taken, those with the smallest hashes of their ids; only
    their features reach the driver.
    """
    def smallest(rows: DataFrame, n: int) -> DataFrame:
        key = F.col(id_col).cast("string")
        return (rows.where(F.col(id_col).isNotNull()).select(id_col).distinct()
                .orderBy(F.xxhash64(key), key).limit(n))

    def texts(ids: DataFrame) -> DataFrame:
        # A bounded number of ids, so they can go to all tasks.
        return docs.select(id_col, text_col).join(F.broadcast(ids), id_col, "left_semi")

    pos = gather(texts(smallest(positives, max_positives)), features, id_col, text_col)[1]
    others = docs if unlabelled is None else unlabelled
    unl = gather(texts(smallest(others, max_unlabelled)), features, id_col, text_col)[1]
    return fit(pos, unl, width, always, prior=prior)


def score(docs: DataFrame, model: Classifiers, features: Features, text_col: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` without its text, and the probability of the positive class for each row."""
    others = [c for c in docs.columns if c != text_col and c != name]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, table = shipped.value, shipped.value.table()
        for batch in batches:
            parts = [model.score(x, table) for x in _features(batch.column(len(others)), features)]
            scores = np.concatenate([np.zeros(0), *parts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)],
                                             names=[*others, name])

    T.prepare_workers(docs.sparkSession)
    kept = docs.select(*others, text_col)
    schema = kept.drop(text_col).schema.add(name, "double")
    return kept.mapInArrow(run, schema)
