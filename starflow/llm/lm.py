"""An n-gram language model whose counts sit in a log-frequency Bloom filter.

A count c is kept as its level, 1 + floor(log(c) / log(base)).  The filter holds an n-gram
once for each level up to its own, so its level is found by asking for one level after the
other until one is missing.  The answer is never too low, and too high only if the filter
errs.  The filter is cut into shards by a hash of the n-gram; each task counts its n-grams
by shard, so neither the counts nor the filter are ever built in one place.

Exact counts of single words, for the base score, are kept as sorted hashes by the same shards.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm import text as T
from starflow.session import stage

_START = np.uint64(0x2545F4914F6CDD1D)
_END = np.uint64(0x6A09E667F3BCC909)
_PROBES = 4


@dataclass
class Model:
    """The shards, stored; and what a score needs besides them."""

    shards: DataFrame  # shard, filter, vocabulary, counts
    n_shards: int
    stored_bytes: int
    train_tokens: int  # words and ends
    distinct: int
    order: int
    base: float
    smoothing: float

    def count_of_level(self) -> np.ndarray:
        """Mean count that each level stands for; no level, no count."""
        level = np.arange(256)
        low = np.minimum(np.ceil(self.base ** (level - 1.0) - 1e-9), 2.0 ** 60)
        high = np.maximum(low, np.ceil(np.minimum(self.base ** level, 2.0 ** 60) - 1e-9) - 1)
        return np.where(level == 0, 0.0, (low + high) / 2)


def grams(data: np.ndarray, bounds: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at each token of each row, for n up to ``order``.

    A row is a start, its words and an end; its tokens' rows are returned too.  Where an
    n-gram would begin before the start, its hash is 0.
    """
    words, n = T.words(data, bounds)
    rows = len(bounds) - 1
    last = np.cumsum(n + 2)
    first = last - (n + 2)
    tokens = np.zeros(int(last[-1]) if rows else 0, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[first] = inner[last - 1] = False
    tokens[inner], tokens[first], tokens[last - 1] = words, _START, _END
    row = np.repeat(np.arange(rows), n + 2)
    place = np.arange(len(tokens)) - first[row]
    made = [tokens]
    for k in range(1, order):
        longer = np.zeros_like(tokens)
        longer[k:] = T.mix(made[-1][k - 1:-1] + T.mix(tokens[k:] + np.uint64(k)))
        longer[place < k] = 0
        made.append(longer)
    return made, row


def _shard(h: np.ndarray, n_shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)


def _runs(h: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often (or with what weight) each occurs."""
    if weight is None:
        return np.unique(h, return_counts=True)
    order = np.argsort(h, kind="stable")
    h, weight = h[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(weight, first) if len(h) else weight


class _Counter:
    """Counts of hashes within a task; merged whenever as many wait as are held."""

    def __init__(self) -> None:
        self.h, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, h: np.ndarray) -> None:
        self.waiting.append(h)
        self.size += len(h)
        if self.size > max(1 << 20, len(self.h)):
            self.merge()

    def merge(self) -> None:
        h, n = _runs(np.concatenate([*self.waiting, np.zeros(0, np.uint64)]))
        self.h, self.n = _runs(np.concatenate([self.h, h]), np.concatenate([self.n, n]))
        self.waiting, self.size = [], 0

    def __len__(self) -> int:
        return len(self.h) + self.size

    def by_shard(self, kind: int, n_shards: int):
        """Rows of shard, kind, hashes seen once, other hashes, and their counts."""
        self.merge()
        cuts = np.searchsorted(_shard(self.h, n_shards), np.arange(n_shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            h, n = self.h[cuts[s]:cuts[s + 1]], self.n[cuts[s]:cuts[s + 1]]
            once = n == 1
            yield int(s), kind, h[once].tobytes(), h[~once].tobytes(), n[~once].astype(np.int64).tobytes()


#: A task passes its counts on when it holds so many; the reducers add them up.
_HELD = 6_000_000
_PART = "shard int, kind int, once binary, more binary, counts binary"


def _partial_counts(docs: DataFrame, text: Column, order: int, n_shards: int) -> DataFrame:
    """Counts of single tokens (kind 0) and of all n-grams (kind 1) of each task, by shard."""
    def run(batches):
        def rows():
            for kind, counter in enumerate(counters):
                made = list(counter.by_shard(kind, n_shards))
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*made), (pa.int32(), pa.int32(), *[pa.binary()] * 3))],
                        names=["shard", "kind", "once", "more", "counts"])

        counters = [_Counter(), _Counter()]
        for batch in batches:
            data, bounds = T.utf8(batch.column(0))
            for lo, hi in T.groups(bounds):
                made, _ = grams(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo], order)
                counters[0].add(made[0])
                for longer in made[1:]:
                    counters[1].add(longer[longer != 0])
                if sum(map(len, counters)) > _HELD:
                    yield from rows()
                    counters = [_Counter(), _Counter()]
        yield from rows()

    return docs.select(text.alias("text")).mapInArrow(run, _PART)


def _salt(level: int) -> np.uint64:
    return np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))


def _words_of(h: np.ndarray, level: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's word and the bits in it that stand for a hash at a level."""
    x = T.mix(h + _salt(level))
    word = ((x >> np.uint64(32)) * np.uint64(n_words) >> np.uint64(32)).astype(np.int64)
    bits = np.zeros(len(h), np.uint64)
    for k in range(_PROBES):
        bits |= np.uint64(1) << (x >> np.uint64(6 * k) & np.uint64(63))
    return word, bits


def _levels(n: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(n) / math.log(base) + 1e-9).astype(np.int64)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """In as few bytes as hold the largest."""
    return counts.astype(np.min_scalar_type(counts.max(initial=0)))


def _wide(counts: bytes, n: int) -> np.ndarray:
    return np.frombuffer(counts, f"u{len(counts) // n}") if n else np.zeros(0, np.uint8)


def _build_shard(bits_per_entry: int, base: float):
    def build(key, rows):
        kinds = np.array(rows.column("kind"))
        held = []
        for kind in (0, 1):
            h, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i in np.flatnonzero(kinds == kind):
                once = np.frombuffer(rows.column("once")[i].as_py(), np.uint64)
                h += [once, np.frombuffer(rows.column("more")[i].as_py(), np.uint64)]
                n += [np.ones(len(once), np.int64), np.frombuffer(rows.column("counts")[i].as_py(), np.int64)]
            held.append(_runs(np.concatenate(h), np.concatenate(n)))
        levels = [_levels(n, base) for _, n in held]
        entries = int(sum(x.sum() for x in levels))
        table = np.zeros(max(1, -(-entries * bits_per_entry // 64)), np.uint64)
        for (h, _), level in zip(held, levels):
            for k in range(1, int(level.max(initial=0)) + 1):
                word, bits = _words_of(h[level >= k], k, len(table))
                np.bitwise_or.at(table, word, bits)
        vocabulary, counts = held[0]
        real = vocabulary != _START
        out = [key[0].as_py(), table.tobytes(), vocabulary[real].tobytes(), _narrow(counts[real]).tobytes(),
               int(counts[real].sum()), int(real.sum())]
        return pa.table({name: pa.array([value], kind) for name, value, kind in zip(
            ("shard", "filter", "vocabulary", "counts", "tokens", "distinct"), out,
            (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))})

    return build


def train(docs: DataFrame, order: int = 2, base: float = 1.5, bits_per_entry: int = 12,
          smoothing: float = 200.0, shard_bytes: int = 4 << 20, text_col: str = "text") -> Model:
    """A model of the texts of ``docs``, its filter stored in shards.

    ``shard_bytes`` is the text behind each shard, so their number grows with the input and
    none outgrows a task.  A null text counts as an empty one, which is an end alone; copies count
    as often as they occur.
    """
    T.prepare_workers(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_shards = max(8, -(-size // shard_bytes))
    parts = _partial_counts(docs, text, order, n_shards)
    shards = stage(parts.groupBy("shard").applyInArrow(
        _build_shard(bits_per_entry, base),
        "shard int, filter binary, vocabulary binary, counts binary, tokens long, distinct long"), "lm-shards")
    total = shards.agg(F.sum("tokens"), F.sum("distinct"), F.sum(
        F.octet_length("filter") + F.octet_length("vocabulary") + F.octet_length("counts"))).first()
    return Model(shards, n_shards, total[2] or 0, total[0] or 0, total[1] or 0, order, base, smoothing)


class _Block:
    """Some shards in memory; it knows nothing of n-grams that belong to others."""

    def __init__(self, n_shards: int, rows: list) -> None:
        self.n_shards = n_shards
        self.first, self.size = np.zeros(n_shards, np.int64), np.zeros(n_shards, np.int64)
        at, filters = 0, []
        for r in rows:
            filters.append(np.frombuffer(r["filter"], np.uint64))
            self.first[r["shard"]], self.size[r["shard"]] = at, len(filters[-1])
            at += len(filters[-1])
        self.filter = np.concatenate([np.zeros(0, np.uint64), *filters])
        # Shards are ranges of hashes, so their vocabularies in turn are sorted.
        self.vocabulary = np.concatenate([np.zeros(0, np.uint64),
                                          *(np.frombuffer(r["vocabulary"], np.uint64) for r in rows)])
        self.counts = np.concatenate([np.zeros(0, np.uint8),
                                      *(_wide(r["counts"], len(r["vocabulary"]) // 8) for r in rows)])

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Level of each hash, by asking for level after level."""
        found = np.zeros(len(h), np.uint8)
        shard = _shard(h, self.n_shards)
        active = np.flatnonzero((self.size[shard] > 0) & (h != 0))
        level = 1
        while len(active) and level < 256:
            at = shard[active]
            x = T.mix(h[active] + _salt(level))
            word = ((x >> np.uint64(32)) * self.size[at].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            held = self.filter[self.first[at] + word]
            there = np.ones(len(active), bool)
            for k in range(_PROBES):
                there &= (held >> (x >> np.uint64(6 * k) & np.uint64(63)) & np.uint64(1)) == 1
            active = active[there]
            found[active] = level
            level += 1
        return found

    def exact(self, h: np.ndarray) -> np.ndarray:
        """Exact count of each word in these shards, else 0."""
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int64)
        distinct, inverse = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.vocabulary, distinct), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == distinct, self.counts[at].astype(np.int64), 0)[inverse]


def _log_probability(model: Model, decode: np.ndarray, levels: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """log10 of each token's smoothed probability after those before it; 0 for a start.

    Counts of n-grams are interpolated with the model of one order less, which weighs as
    much as ``smoothing`` occurrences of the context.
    """
    counts = [decode[x] for x in levels]
    p = (counts[0] + 1) / (model.train_tokens + model.distinct + 1)
    for k in range(1, len(counts)):
        context = np.concatenate([[0.0], counts[k - 1][:-1]])
        share = np.where(context > 0, np.minimum(1.0, counts[k] / np.maximum(context, 1e-9)), 0.0)
        trust = np.where(place >= k, context / (context + model.smoothing), 0.0)
        p = trust * share + (1 - trust) * p
    return np.where(place == 0, 0.0, np.log10(np.minimum(1.0, p)))


def _blocks(model: Model, max_bytes: int) -> list[list[int]]:
    """Shards in groups of ``max_bytes`` at most (or of one)."""
    sizes = model.shards.select("shard", (F.octet_length("filter") + F.octet_length("vocabulary")
                                          + F.octet_length("counts")).alias("size")).orderBy("shard").collect()
    out: list[list[int]] = []
    room = -1
    for r in sizes:
        if r["size"] > room:
            out.append([])
            room = max_bytes
        out[-1].append(r["shard"])
        room -= r["size"]
    return out or [[]]


def score(docs: DataFrame, model: Model, text_col: str = "text", max_broadcast: int = 256 << 20) -> DataFrame:
    """``docs`` without its text, with ``n_tokens, n_known, train_tokens, base_score, score``.

    The shards are sent to the workers if they are no more than ``max_broadcast`` bytes;
    otherwise in blocks of that size one after the other, each pass storing what it found for every
    token.  Null texts score as empty ones, which have an end alone; every row is kept, and
    columns of the new names are replaced.  A model of no text gives every token
    probability 1 / 1, its count of tokens being 0.
    """
    spark = docs.sparkSession
    T.prepare_workers(spark)
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    others = [c for c in docs.columns if c != text_col and c not in added]
    rows = docs.select(*others, text_col)
    schema = rows.drop(text_col).schema
    for name in added:
        schema = schema.add(name, "double" if name.endswith("score") else "long")
    blocks = _blocks(model, max_broadcast)
    order, width = model.order, len(others)
    facts = Model(None, model.n_shards, model.stored_bytes, model.train_tokens, model.distinct, order,
                  model.base, model.smoothing)

    def sent(shards: list[int]):
        # A block is a run of shards, in their order.
        held = (model.shards.where(F.col("shard").between(min(shards, default=0), max(shards, default=-1)))
                .select("shard", "filter", "vocabulary", "counts").toLocalIterator())
        return spark.sparkContext.broadcast(_Block(model.n_shards, sorted(held, key=lambda r: r["shard"])))

    def known(block: _Block, made: list[np.ndarray], row: np.ndarray, n: int):
        """Levels of all n-grams, and each row's words in the block and sum of log10(count + 1)."""
        counted = made[0] != _START
        exact = block.exact(made[0][counted])
        return ([block.levels(h) for h in made], np.bincount(row[counted], exact > 0, n).astype(np.int64),
                np.bincount(row[counted], np.log10(exact + 1.0), n))

    def finish(levels: list[np.ndarray], row: np.ndarray, n: int):
        first = np.searchsorted(row, np.arange(n))
        place = np.arange(len(row)) - first[row]
        p = _log_probability(facts, facts.count_of_level(), levels, place)
        return np.bincount(row, minlength=n) - 1, np.bincount(row, p, n)

    def emit(columns, tokens, n_known, logs, scores):
        denominator = math.log10(facts.train_tokens + facts.distinct + 1)
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)),
             pa.array(np.full(len(tokens), facts.train_tokens, np.int64)),
             pa.array(logs - tokens * denominator), pa.array(scores)], names=[*others, *added])

    def slices(batch):
        data, bounds = T.utf8(batch.column(width))
        for lo, hi in T.groups(bounds):
            yield lo, hi, *grams(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo], order)

    if len(blocks) == 1:
        shipped = sent(blocks[0])

        def run(batches):
            for batch in batches:
                for lo, hi, made, row in slices(batch):
                    levels, n_known, logs = known(shipped.value, made, row, hi - lo)
                    tokens, scores = finish(levels, row, hi - lo)
                    yield emit(batch.slice(lo, hi - lo).columns[:width], tokens, n_known, logs, scores)

        return rows.mapInArrow(run, schema)

    found = rows.withColumns({"_levels": F.lit(None).cast("binary"), "_known": F.lit(0).cast("bigint"),
                              "_logs": F.lit(0.0)})
    for k, shards in enumerate(blocks):
        def add(batches, shipped=sent(shards)):
            for batch in batches:
                for lo, hi, made, row in slices(batch):
                    part = batch.slice(lo, hi - lo)
                    levels, n_known, logs = known(shipped.value, made, row, hi - lo)
                    cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                    before = part.column(width + 1).to_pylist()
                    after = []
                    for i in range(hi - lo):
                        own = np.concatenate([x[cuts[i]:cuts[i + 1]] for x in levels])
                        if before[i] is not None:
                            own = np.maximum(own, np.frombuffer(before[i], np.uint8))
                        after.append(own.tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:width + 1], pa.array(after, pa.binary()),
                         pa.array(np.array(part.column(width + 2)) + n_known),
                         pa.array(np.array(part.column(width + 3)) + logs)], names=part.schema.names)

        found = stage(found.mapInArrow(add, found.schema), f"lm-levels-{k}")

    def total(batches):
        for batch in batches:
            parts = [np.frombuffer(x, np.uint8).reshape(order, -1) for x in batch.column(width + 1).to_pylist()]
            row = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
            levels = [np.concatenate([np.zeros(0, np.uint8), *(p[k] for p in parts)]) for k in range(order)]
            tokens, scores = finish(levels, row, len(parts))
            yield emit(batch.columns[:width], tokens, np.array(batch.column(width + 2)),
                       np.array(batch.column(width + 3)), scores)

    return found.mapInArrow(total, schema)
