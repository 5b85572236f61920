"""Language of a text: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte n-grams, each hashed to a row of a
table; a softmax layer on that mean names the language.  Both are trained by stochastic
gradient descent.  A temperature fitted on rows kept back calibrates the probabilities.

The softmax tells learnt languages apart and says nothing of others, so rejection looks at the subwords
themselves: the mean log frequency, over the languages learnt, of a text's subwords.  Its threshold is
calibrated on rows kept back, which should pass, and on each language left out in turn, which should not.
A text that mixes learnt languages is as familiar as one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import pu
from starflow.llm import text as T

BITS = 15
SIZES = (2, 3, 4)
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ROWS = np.uint64((1 << BITS) - 1)


def subwords(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table row and text row of each byte n-gram of words, the space before and after included."""
    kept = T.lower(np.where(_LETTER[data], data, 32).astype(np.uint8))
    kept = np.concatenate([kept, np.full(max(SIZES), 32, np.uint8)])
    flat = kept.astype(np.uint64)
    n = len(data)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    last = np.repeat(bounds[1:], np.diff(bounds))
    places, rows = [], []
    letter = kept != 32
    for size in SIZES:
        gram = np.zeros(n, np.uint64)
        for k in range(size):
            gram = gram << np.uint64(8) | flat[k:k + n]
        # Spaces only at either end, so a gram does not span words.
        whole = np.arange(n) + size <= last
        whole &= letter[1:n + 1] if size > 2 else letter[:n] | letter[1:n + 1]
        if size > 3:
            whole &= letter[2:n + 2]
        places.append((T.mix(gram + np.uint64(size << 56)) & _ROWS)[whole].astype(np.int32))
        rows.append(row[whole])
    return np.concatenate(places), np.concatenate(rows)


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's table rows with their shares, as sparse rows."""
    place, row = subwords(data, bounds)
    rows = len(bounds) - 1
    pairs, repeats = np.unique(row.astype(np.int64) << BITS | place, return_counts=True)
    row, place = pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32)
    total = np.bincount(row, repeats, rows)
    return np.bincount(row, minlength=rows), place, (repeats / total[row]).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # embeddings times softmax weights: a row for each table row
    bias: np.ndarray
    temperature: float
    familiar: np.ndarray  # log frequency of each table row in the texts learnt from
    threshold: float  # what a long text must reach on average
    slack: float  # what one subword may miss; of n it is this over the root of n

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability, and whether the text is strange; -1 and 0 where no language was learnt."""
        rows = len(bounds) - 1
        if not self.languages:
            return np.full(rows, -1), np.zeros(rows), np.ones(rows, bool)
        means, strange = np.zeros((rows, len(self.languages))), np.zeros(rows, bool)
        for lo, hi in T.groups(bounds, 1 << 18):
            place, row = subwords(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
            total = np.maximum(1, np.bincount(row, minlength=hi - lo))
            for k in range(len(self.languages)):
                means[lo:hi, k] = np.bincount(row, self.scores[place, k], hi - lo) / total
            known = np.bincount(row, self.familiar[place], hi - lo) / total
            strange[lo:hi] = known + self.slack / np.sqrt(total) < self.threshold
        p = self.probabilities(means)
        best = p.argmax(axis=1)
        return best, p[np.arange(rows), best], strange


def frequencies(rows: pu.Sparse) -> np.ndarray:
    """Log frequency of each table row, every text counting as much."""
    # What an unseen subword gets: half a subword of all texts, at some thousand in each.
    unseen = 0.5 ** 11
    mass = np.bincount(rows.columns, rows.values, 1 << BITS)
    return np.log((mass + unseen) / (len(rows) + unseen * (1 << BITS)))


def familiarity(rows: pu.Sparse, familiar: np.ndarray, slack: float) -> np.ndarray:
    """Mean log frequency of each text's subwords, raised by what so few of them may miss."""
    row = np.repeat(np.arange(len(rows)), rows.counts)
    least = np.full(len(rows), 1.0)
    # The rarest subword of a text nearly always occurs once, which tells how many there are.
    np.minimum.at(least, row, rows.values)
    return np.bincount(row, rows.values * familiar[rows.columns], len(rows)) + slack * np.sqrt(least)


def rejection(rows: pu.Sparse, labels: np.ndarray, back: np.ndarray, ahead: np.ndarray,
              caught: float = 0.9) -> tuple[np.ndarray, float, float]:
    """Frequencies, threshold and slack.

    The threshold lies below the strangest row kept back, by a quarter of the way to what ``caught`` of the
    rows of a language left out stay below, for the language that is hardest to tell.  Where these overlap it
    lets all rows kept back pass; with one language the way is that from their median down to the strangest.
    """
    learnt = rows.take(ahead)
    familiar = frequencies(learnt)
    share = np.bincount(learnt.columns, learnt.values, 1 << BITS)
    mean = (share * familiar).sum() / max(share.sum(), 1e-9)
    slack = 2 * float(np.sqrt((share * (familiar - mean) ** 2).sum() / max(share.sum(), 1e-9)))
    kept = rows.take(back)
    kept = familiarity(kept, familiar, slack)[kept.counts > 0]
    if not len(kept):
        return familiar, -np.inf, slack
    low = float(kept.min())
    left = []
    names = np.unique(labels)
    for name in names if len(names) > 1 else ():
        of, others = rows.take(ahead[labels[ahead] == name]), ahead[labels[ahead] != name]
        strange = familiarity(of, frequencies(rows.take(others)), slack)[of.counts > 0]
        if len(strange) and len(others):
            left.append(float(np.quantile(strange, caught)))
    if left:
        return familiar, min(low, low + (max(left) - low) / 4), slack
    return familiar, low - (float(np.median(kept)) - low) / 4, slack


def train(rows: pu.Sparse, labels: np.ndarray, languages: list[str], width: int = 16,
          epochs: int = 8, batch: int = 64, rate: float = 4.0, keep_back: int = 5, seed: int = 0) -> Model:
    """Embeddings and softmax by SGD; one row in ``keep_back`` calibrates instead."""
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, np.zeros(1 << BITS), 0.0, 0.0)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BITS, width))
    weights, bias = np.zeros((width, len(languages))), np.zeros(len(languages))
    order = rng.permutation(len(rows))
    back = order[::keep_back] if len(order) >= 10 * keep_back else order
    ahead = np.setdiff1d(order, back) if len(back) < len(order) else order

    def mean(x: pu.Sparse) -> np.ndarray:
        of = np.repeat(np.arange(len(x)), x.counts)
        return np.stack([np.bincount(of, x.values * table[x.columns, d], len(x)) for d in range(width)], 1)

    steps, step = epochs * -(-len(ahead) // batch), 0
    for _ in range(epochs):
        rng.shuffle(ahead)
        for lo in range(0, len(ahead), batch):
            chosen = ahead[lo:lo + batch]
            x, y = rows.take(chosen), labels[chosen]
            m = mean(x)
            z = m @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            now = rate * (1 - step / steps)
            outer = p @ weights.T
            used, inverse = np.unique(x.columns, return_inverse=True)
            of = np.repeat(np.arange(len(x)), x.counts)
            change = np.stack([np.bincount(inverse, x.values * outer[of, d], len(used))
                               for d in range(width)], 1)
            weights -= now * (m.T @ p)
            bias -= now * p.sum(axis=0)
            table[used] -= 25 * now * change
            step += 1

    held = rows.take(back)
    z, y = mean(held) @ weights + bias, labels[back]

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(y)), y]).mean())

    temperature = float(min(np.geomspace(0.05, 20, 81), key=loss)) if len(y) else 1.0
    return Model(languages, (table @ weights).astype(np.float32), bias, temperature, *rejection(rows, labels, back, ahead))


def learn_languages(docs: DataFrame, max_rows: int = 4000, max_languages: int = 500,
                    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the languages named in ``lang_col``, from about ``max_rows`` rows at most.

    Each language gets an equal part of ``max_rows`` (ten rows at least); its rows are
    drawn by a hash of id and text.  All languages beyond the ``max_languages`` most frequent are learnt as
    one, ``und``, so that their texts are neither lost nor taken for another language.
    Rows without a language, an id or a text are not learnt from.  Without any row the model
    knows no language and calls every text ``und``.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
    every = (docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).cast("string").alias("lang")).count())
    counts = every.orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return train(pu.Sparse(*(np.zeros(0, np.int64),) * 3), np.zeros(0, np.int64), [])
    each = max(10, max_rows // len(counts))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, each / r["count"])) for r in counts],
                                               "lang string, share double")
    rest = (every.agg(F.sum("count").alias("n")).first()["n"] or 0) - sum(r["count"] for r in counts)
    # A row for each of a bounded number of languages.
    drawn = (known.join(F.broadcast(shares), "lang", "left")
             .withColumn("lang", F.when(F.col("share").isNull(), UNKNOWN).otherwise(F.col("lang")))
             .withColumn("share", F.coalesce("share", F.lit(min(1.0, each / rest) if rest else 1.0)))
             .where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)))
    rows, sparse = pu.gather(drawn, features, "id", "text", "lang")
    languages = sorted({r["label"] for r in rows})
    place = {name: k for k, name in enumerate(languages)}
    return train(sparse, np.array([place[r["label"]] for r in rows], np.int64), languages)


def _predictions(model: Model, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    best, p, strange = model.predict(*T.utf8(column))
    lettered = np.array([x is not None and any(map(str.isalpha, x)) for x in column.to_pylist()], bool)
    known = lettered & (best >= 0)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
    p = np.where(known, p, 0.0)
    return names, p, ~known | strange


def identify_languages(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred``, ``score`` and ``rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, and one that is in no learnt
    language is rejected too, whatever it is most like.  Every row is kept.  Columns of those three names are replaced.
    """
    added = ("lang_pred", "score", "rejected")
    others = [c for c in docs.columns if c not in (text_col, *added)]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, p, rejected = _predictions(shipped.value, batch.column(len(others)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(p), pa.array(rejected)],
                names=[*others, *added])

    T.prepare_workers(docs.sparkSession)
    kept = docs.select(*others, text_col)
    schema = (kept.drop(text_col).schema.add("lang_pred", "string").add("score", "double")
              .add("rejected", "boolean"))
    return kept.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is not rejected."""
    at = docs.columns.index(text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            rejected = _predictions(shipped.value, batch.column(at))[2]
            yield batch.filter(pa.array(~rejected))

    T.prepare_workers(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
