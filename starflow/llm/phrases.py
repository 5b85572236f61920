"""Phrases whose words occur together more often than apart, by dynamic itemset counting.

The texts are dealt into shards, which are scanned one after the other in cycles.  Phrases of
all lengths are counted in the same scans: single words from the first scan on, and a longer
phrase from the scan after both its subphrases, the one without its last and the one without
its first word, have reached the threshold.  Each phrase is counted for one full cycle, wherever
it starts, so its count is exact; the work ends when the last phrase's cycle does.

While they are counted, phrases are known by a 64-bit hash of language, length and text (of 10**9
different phrases two share one with a chance of 3 per cent); the texts of those that stay are
looked up in a last scan.  What a scan must count follows from when each subphrase reached the
threshold.  Tasks look that up in a table of slots by hash, of bounded size: two phrases in one slot
only make a scan count some phrases that it need not, and a shard that is counted for a phrase twice
enters its total once.

Counts travel as arrays of hashes and numbers, cut into parts by hash, and so are the totals stored: a row
for each part, with all of its phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.llm import text as T
from starflow.session import scratch, scratch_path, stage
from starflow.sources.tables import remove

#: The table of slots has at most so many (two bytes each); it is what is broadcast.
MOST_SLOTS = 1 << 24
#: Distinct phrases a task holds before it sends their counts on.
MOST_HELD = 1 << 19
_BLOCK_BITS = 16
_NEVER = 255

_HARD = np.zeros(256, bool)
_HARD[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _HARD.copy()
_BREAK[[0x20, 0x09]] = True

#: Bytes of text behind one part of the totals, of which a task holds one at a time.
PART_BYTES = 6 << 20
_SEEN = "part int, n int, until int, h binary, c binary"
_COLUMNS = {"h": np.uint64, "c": np.int64, "shards": np.int64, "until": np.int16, "since": np.int16, "n": np.int8}
_TOTALS = "part int, newest int, started long, " + ", ".join(f"{c} binary" for c in _COLUMNS)
_FREQUENT = "h long, n int, c long, since int"
_TEXTS = "h long, lang string, phrase string"


@dataclass
class Slots:
    """The first and last scan from which phrases in a slot let longer ones be counted."""

    low: np.ndarray
    high: np.ndarray

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = h & np.uint64(len(self.low) - 1)
        return self.low[slot], self.high[slot]


class Words:
    """The words of some texts, in lower case, one space after each, and which share a piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, seed: np.ndarray) -> None:
        # Each text ends in a line end, so no word runs on into the next text.
        data = T.lower(data)
        inside = ~_BREAK[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        hard = np.cumsum(_HARD[data], dtype=np.int64)
        self.row = np.searchsorted(bounds, starts, "right") - 1
        # The line end after each text separates pieces of different texts too.
        self.joined = hard[starts[1:] - 1] == hard[ends[:-1] - 1]
        keep = inside
        keep[ends] = True
        self.data = data[keep]
        size = ends - starts
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self.data[self.end] = 32
        up, self.down = T._power_tables(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up[:len(self.data)], out=self.sums[1:])
        self.seed = seed[self.row]

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        """Of the phrases of ``n`` words that start at the words ``at``, with their language."""
        s, e = self.start[at], self.end[at + n - 1]
        return T.mix((self.sums[e] - self.sums[s]) * self.down[s] + self.seed[at])

    def texts(self, at: np.ndarray, n: int) -> pa.Array:
        s = self.start[at]
        size = self.end[at + n - 1] - s
        bounds = np.concatenate([[0], np.cumsum(size)])
        flat = self.data[np.repeat(s - bounds[:-1], size) + np.arange(bounds[-1])]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat))


def to_count(words: Words, scan: int, cycle: int, slots: Slots | None,
             longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, first words, hashes and last needed scan of the phrases that a scan counts."""
    n_words = len(words.start)
    at = np.arange(n_words)
    h = words.hashes(at, 1)
    if scan < cycle:
        yield 1, at, h, np.full(n_words, cycle - 1, np.int32)
    if slots is None or not n_words:
        return
    low, high = slots.look_up(h)
    for n in range(2, longest + 1):
        if n_words < n:
            return
        # low[i] and high[i] tell of the phrase of n - 1 words at i.
        from_low = np.maximum(low[:-1], low[1:])
        from_high = np.maximum(high[:-1], high[1:])
        fits = (from_low <= scan) & words.joined[n - 2:]
        at = np.flatnonzero(fits)
        h = words.hashes(at, n)
        last = from_high[at].astype(np.int32) + (cycle - 1)
        needed = last >= scan
        yield n, at[needed], h[needed], last[needed]
        if n < longest:
            low, high = np.full(len(fits), _NEVER, np.uint8), np.zeros(len(fits), np.uint8)
            low[at], high[at] = slots.look_up(h)


class _Tally:
    """Counts of hashes within a task; they are merged when as many wait as are held."""

    def __init__(self) -> None:
        self.h, self.c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, h: np.ndarray) -> None:
        self.waiting.append(h)
        self.size += len(h)
        if self.size > max(MOST_HELD, len(self.h)):
            self.merge()

    def merge(self) -> None:
        h, c = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.uint64)]), return_counts=True)
        self.waiting, self.size = [], 0
        if len(self.h):
            h, c = np.concatenate([self.h, h]), np.concatenate([self.c, c])
            order = np.argsort(h, kind="stable")
            h, c = h[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            h, c = h[first], np.add.reduceat(c, first)
        self.h, self.c = h, c

    def rows(self, n: int, until: int, parts: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
        self.merge()
        cuts = np.searchsorted(_part(self.h, parts), np.arange(parts + 1))
        for part in np.flatnonzero(np.diff(cuts)):
            cut = slice(cuts[part], cuts[part + 1])
            yield int(part), n, until, self.h[cut].tobytes(), self.c[cut].astype(np.int64).tobytes()


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, pa.Array]]:
    """The words of groups of texts, their languages as places in a list, and the list."""
    none, line_end = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        seeds = np.array([hash_of(v) for v in langs.dictionary.to_pylist()] or [0], np.uint64)
        code = langs.indices.to_numpy(zero_copy_only=False)
        data, bounds = T.utf8(pc.binary_join_element_wise(batch.column(1).cast(pa.large_string()), none, line_end))
        for a, b in T.groups(bounds):
            words = Words(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], seeds[code[a:b]])
            yield words, code[a:b][words.row], langs.dictionary


def _total(seed: np.ndarray) -> np.ndarray:
    """The hash under which all words of a language are counted, as a phrase of length 0."""
    return T.mix(seed ^ np.uint64(0x5851F42D4C957F2D))


def _scan(scan: int, cycle: int, longest: int, parts: int, slots):
    """A task's counts of what the scan must count; with length 0, of all words of a language."""
    schema = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("until", pa.int32()), ("h", pa.binary()), ("c", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(*slots.value) if slots is not None else None
        tallies: dict[tuple[int, int], _Tally] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (n, until), tally in tallies.items():
                rows = list(zip(*tally.rows(n, until, parts)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)
            tallies.clear()

        def add(n: int, until: int, h: np.ndarray) -> None:
            tallies.setdefault((n, until), _Tally()).add(h)

        for words, _, _ in _texts_of(batches):
            if scan < cycle:
                add(0, cycle - 1, _total(words.seed))
            for n, _, h, until in to_count(words, scan, cycle, table, longest):
                kinds = np.unique(until)
                for k in kinds:
                    add(n, int(k), h if len(kinds) == 1 else h[until == k])
            if sum(len(t.h) + t.size for t in tallies.values()) > 4 * MOST_HELD:
                yield from sent()
        yield from sent()

    return run


def _find_texts(longest: int, slots):
    """A task's phrases that are in the slots, with language and text; few of them more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(*slots.value)
        # The last hash sent from each place.
        sent = np.zeros(1 << 20, np.uint64)

        def fresh(h: np.ndarray) -> np.ndarray:
            """Where hashes stand that are sent now, one for each."""
            place = h & np.uint64(len(sent) - 1)
            new = np.flatnonzero(sent[place] != h)
            _, first = np.unique(h[new], return_index=True)
            new = new[first]
            sent[place[new]] = h[new]
            return new

        def rows(h, langs, texts):
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), langs.cast(pa.string()), texts.cast(pa.string())], ["h", "lang", "phrase"])

        for words, code, langs in _texts_of(batches):
            used = np.flatnonzero(np.bincount(code, minlength=len(langs)))
            total = _total(np.array([hash_of(v) for v in langs.take(pa.array(used)).to_pylist()], np.uint64))
            new = fresh(total)
            if len(new):
                yield rows(total[new], langs.take(pa.array(used[new])), pa.array([""] * len(new)))
            at = np.arange(len(words.start))
            for n in range(1, longest + 1):
                h = words.hashes(at, n)
                hit = table.look_up(h)[0] != _NEVER
                at, h = at[hit], h[hit]
                new = fresh(h)
                if len(new):
                    yield rows(h[new], langs.take(pa.array(code[at[new]])), words.texts(at[new], n))
                # A longer phrase stays only if both its parts do.
                there = np.zeros(len(words.start) + 1, bool)
                there[at] = True
                at = at[there[at + 1]]
                if n < longest and len(at):
                    at = at[words.joined[np.minimum(at + n - 1, len(words.joined) - 1)] & (at + n < len(words.start))]

    return run


def hash_of(lang: str) -> int:
    data = np.frombuffer(lang.encode(), np.uint8)
    return int(T.hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0])


def merge_counts(totals: dict[str, np.ndarray], seen: list[tuple[int, int, np.ndarray, np.ndarray]], scan: int, cycle: int,
                 threshold: int) -> dict[str, np.ndarray]:
    """Totals of a part, by ascending hash, after a scan; a shard that is counted for a phrase already adds nothing."""
    bit = np.int64(1 << scan % cycle)
    totals = {name: totals[name].copy() for name in _COLUMNS}
    if seen:
        sizes = [len(h) for _, _, h, _ in seen]
        h = np.concatenate([h for _, _, h, _ in seen])
        order = np.argsort(h, kind="stable")  # of sorted runs, which it merges
        h = h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h = h[first]
        c = np.add.reduceat(np.concatenate([c for _, _, _, c in seen])[order], first)
        until = np.maximum.reduceat(np.repeat(np.array([u for _, u, _, _ in seen], np.int16), sizes)[order], first)
        n = np.repeat(np.array([n for n, _, _, _ in seen], np.int8), sizes)[order][first]
        place = np.searchsorted(totals["h"], h)
        known = np.zeros(len(h), bool)
        inside = place < len(totals["h"])
        known[inside] = totals["h"][place[inside]] == h[inside]
        at = place[known]
        fresh = totals["shards"][at] & bit == 0
        totals["c"][at] += np.where(fresh, c[known], 0)
        totals["shards"][at] |= bit
        totals["until"][at] = np.maximum(totals["until"][at], until[known])
        new = {"h": h, "c": c, "shards": np.full(len(h), bit), "until": until, "since": np.zeros(len(h), np.int16), "n": n}
        totals = {name: np.insert(totals[name], place[~known], new[name][~known]) for name in _COLUMNS}
    reached = (totals["since"] == 0) & (totals["c"] >= threshold)
    totals["since"][reached] = scan + 1
    # What is neither frequent nor still counted is done with.
    keep = (totals["c"] >= threshold) | (totals["until"] > scan)
    return {name: values[keep].astype(_COLUMNS[name]) for name, values in totals.items()}


def _merged(totals: DataFrame | None, seen: DataFrame, scan: int, cycle: int, threshold: int, longest: int) -> DataFrame:
    """The totals after a scan: for each part its phrases, how many let longer ones be counted, and since when."""
    none = F.lit(None)
    rows = seen.select("part", F.col("n").alias("length"), F.col("until").alias("last"), *(
        F.col(c) if c in ("h", "c") else none.cast("binary").alias(c) for c in _COLUMNS))
    if totals is not None:
        rows = rows.unionByName(totals.select("part", none.cast("int").alias("length"), none.cast("int").alias("last"), *_COLUMNS))

    def merge(key: tuple, part: pa.Table) -> pa.Table:
        old = {name: np.zeros(0, kind) for name, kind in _COLUMNS.items()}
        counted = []
        # Views of what Arrow holds, no copies.
        for length, last, *values in zip(*(part[c].combine_chunks() for c in ("length", "last", *_COLUMNS))):
            arrays = {name: v.as_buffer() for name, v in zip(_COLUMNS, values) if v.is_valid}
            if length.is_valid:
                counted.append((length.as_py(), last.as_py(), np.frombuffer(arrays["h"], np.uint64), np.frombuffer(arrays["c"], np.int64)))
            else:
                old = {name: np.frombuffer(arrays[name], kind) for name, kind in _COLUMNS.items()}
        new = merge_counts(old, counted, scan, cycle, threshold)
        shorter = (new["since"] > 0) & (new["n"] >= 1) & (new["n"] < longest)
        return pa.table({
            "part": pa.array([key[0].as_py()], pa.int32()), "newest": pa.array([int(new["since"][shorter].max(initial=0))], pa.int32()),
            "started": pa.array([int(shorter.sum())], pa.int64()), **{c: pa.array([new[c].tobytes()], pa.binary()) for c in _COLUMNS}})

    return rows.groupBy("part").applyInArrow(merge, _TOTALS)


def _frequent(totals: DataFrame, threshold: int) -> DataFrame:
    """A row for each phrase that has reached the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                of = {name: np.frombuffer(row[name], kind) for name, kind in _COLUMNS.items()}
                some = np.flatnonzero(of["c"] >= threshold)
                for i in range(0, len(some), 1 << 16):
                    at = some[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(of["h"][at].view(np.int64)), pa.array(of["n"][at].astype(np.int32)), pa.array(of["c"][at]),
                        pa.array(of["since"][at].astype(np.int32))], ["h", "n", "c", "since"])

    return totals.select(*_COLUMNS).mapInArrow(run, _FREQUENT)


def _slots(frequent: DataFrame, count: int, most: int) -> Slots:
    """The table of slots, built in blocks; the driver sees two bytes a slot."""
    size = min(most, 1 << max(_BLOCK_BITS, (8 * count - 1).bit_length()))
    slot = F.col("h").bitwiseAND(F.lit(size - 1))
    cells = (frequent.select(slot.alias("slot"), F.shiftright(slot, _BLOCK_BITS).cast("int").alias("block"), "since")
             .groupBy("block", "slot").agg(F.min("since").alias("low"), F.max("since").alias("high")))

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = np.full(1 << _BLOCK_BITS, _NEVER, np.uint8), np.zeros(1 << _BLOCK_BITS, np.uint8)
        place = rows["slot"].to_numpy() & ((1 << _BLOCK_BITS) - 1)
        low[place], high[place] = rows["low"].to_numpy(), rows["high"].to_numpy()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "low": pa.array([low.tobytes()]),
                         "high": pa.array([high.tobytes()])})

    blocks = cells.groupBy("block").applyInArrow(block, "block int, low binary, high binary")
    low, high = np.full(size, _NEVER, np.uint8), np.zeros(size, np.uint8)
    for row in blocks.collect():
        at = row["block"] << _BLOCK_BITS
        low[at:at + (1 << _BLOCK_BITS)] = np.frombuffer(row["low"], np.uint8)
        high[at:at + (1 << _BLOCK_BITS)] = np.frombuffer(row["high"], np.uint8)
    return Slots(low, high)


def count_phrases(docs: DataFrame, threshold: int = 100, longest: int = 5, shards: int = 4,
                  most_slots: int = MOST_SLOTS, text: str = "text", lang: str = "lang") -> DataFrame:
    """Exact counts of all phrases of up to ``longest`` words that occur ``threshold`` times in a language.

    Returns the stored table ``lang, n, phrase, c``; ``n`` is the number of words, and the row with
    ``n`` 0 holds the number of all words of the language.  Letters A-Z count as lower case; a phrase
    does not reach over ``.,;:!?`` or a line end; its words are joined by one space.  A language that
    is null is ``und``; null and empty texts have no words, and a table without words gives no rows.
    Rows that are repeated count as often as they occur, and other columns are not looked at.  A text is
    read whole by one task.  ``shards`` scans make a cycle (62 at most).
    """
    if not 1 <= shards <= 62 or (longest + 1) * shards >= _NEVER:
        raise ValueError("shards must be 1 to 62, and so few that the scans can be numbered in a byte")
    spark = docs.sparkSession
    T.prepare_workers(spark)
    out = scratch_path(spark, "phrase-counts")
    with scratch(spark):
        folder = scratch_path(spark, "phrase-shards")
        dealt = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                            F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
        dealt.write.partitionBy("shard").parquet(folder)
        source = spark.read.schema("lang string, text string, shard int").parquet(folder)
        size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(8, size // PART_BYTES)
        totals, slots, scan, last, path = None, None, 0, shards - 1, ""
        while scan <= last:
            sent = spark.sparkContext.broadcast((slots.low, slots.high)) if slots is not None else None
            seen = (source.where(F.col("shard") == scan % shards).select("lang", "text")
                    .mapInArrow(_scan(scan, shards, longest, parts, sent), _SEEN))
            before, path = path, scratch_path(spark, "phrase-totals")
            _merged(totals, seen, scan, shards, threshold, longest).write.parquet(path)
            totals = spark.read.schema(_TOTALS).parquet(path)
            if before:
                # The totals before are in these; the texts are what all of them came from.
                remove(spark, before)
            if sent is not None:
                sent.unpersist()
            # A phrase that has just reached the threshold lets longer ones start their cycle.
            facts = totals.agg(F.max("newest").alias("newest"), F.sum("started").alias("started")).first()
            if facts["newest"] == scan + 1:
                shorter = _frequent(totals, threshold).where(F.col("n").between(1, longest - 1))
                slots = _slots(shorter, facts["started"], most_slots)
            last = max(shards - 1, facts["newest"] + shards - 1 if facts["newest"] else 0)
            scan += 1
        frequent = stage(_frequent(totals, threshold), "phrase-frequent")
        wanted = _slots(frequent.where("n > 0"), frequent.count() + 1, most_slots)
        found = spark.sparkContext.broadcast((wanted.low, wanted.high))
        texts = (source.select("lang", "text").mapInArrow(_find_texts(longest, found), _TEXTS)
                 .groupBy("h").agg(F.min(F.struct("lang", "phrase")).alias("of")))
        (frequent.select("h", "n", "c").join(texts, "h")
         .select("of.lang", "n", "of.phrase", "c").write.parquet(out))
        for old in (folder, path):
            remove(spark, old)
    return spark.read.schema("lang string, n int, phrase string, c long").parquet(out)


def collocations(docs: DataFrame, threshold: int = 100, longest: int = 5, top: int = 2000, shards: int = 4,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language by how much their words attract each other.

    A phrase of 2 to ``longest`` words that occurs ``a >= threshold`` times is cut after its first
    ``k`` words into parts with counts ``l`` and ``r``, and scores ``floor(1000 * a * n / (l * r))`` at the
    cut where that is least (the first such cut), ``n`` being the number of words of the language.
    Phrases inside a longer one that occurs as often are left out.  Equal scores go by descending ``a``,
    then by the phrase's bytes.  Odd rows are treated as ``count_phrases`` says.
    """
    counts = count_phrases(docs, threshold, longest, shards, text=text, lang=lang)
    # Wide enough for products of counts up to 10**15.
    exact = "decimal(15,0)"
    size = counts.where("n = 0").select("lang", F.col("c").alias("words"))
    phrases = counts.where("n >= 2").select("lang", "n", "phrase", F.col("c").alias("a"))
    parts = counts.where("n >= 1").select("lang", "phrase", "c")
    words = F.split("phrase", " ")
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
            .withColumns({"first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
                          "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("n") - F.col("k")), " ")}))
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
            .join(size, "lang"))
    score = F.expr(f"(cast(a as {exact}) * cast(words as {exact}) * 1000bd) div (cast(l as {exact}) * cast(r as {exact}))")
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r", "words", "a")).alias("best"))
    # One longer by a word is enough: what lies between two phrases that occur as often does so too.
    inner = F.array(F.array_join(F.slice(words, F.lit(1), F.col("n") - 1), " "),
                    F.array_join(F.slice(words, F.lit(2), F.col("n") - 1), " "))
    within = phrases.where("n >= 3").select("lang", F.explode(inner).alias("phrase"), "a")
    kept = (best.select("lang", "phrase", F.col("best.a").alias("a"), F.col("best.l").alias("l"),
                        F.col("best.r").alias("r"), F.col("best.words").alias("n"), F.col("best.score").alias("score"))
            .join(within, ["lang", "phrase", "a"], "left_anti"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in parts of a language, so that no task ranks all phrases of one.
    part = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    whole = part.where(F.col("rank") <= top).drop("_part", "rank")
    ranked = whole.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
