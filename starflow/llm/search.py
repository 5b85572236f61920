"""The best documents for each of many stored queries, searched the other way round.

The items' terms are the index: it is bounded, goes to every task, and the documents are streamed
through it.  Each document's counts of indexed terms find the items that hold those terms, and
each task keeps a heap of the best documents of each item, of bounded size.  The heaps are merged at
the end.  Texts are read once: the counts of indexed terms are stored, the statistics of
the whole collection come from them, then the scores.

Items whose index would pass the bound are dealt into blocks, and the stored texts' counts are made
for one block after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm import text as T
from starflow.session import scratch, scratch_path, stage

#: Bytes of item text behind one broadcast index.
MOST_BYTES = 64 << 20
#: Sums that a task holds at a time, items by documents.
MOST_SUMS = 1 << 22

# A term is a run of other bytes than these.
_BREAK = np.zeros(256, bool)
_BREAK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and row of each term."""
    inside = ~_BREAK[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(opens)
    return T.lower(data), starts, np.flatnonzero(closes) + 1, np.searchsorted(bounds, starts, "right") - 1


class Index:
    """The distinct terms of a block of items, and for each the items that hold it."""

    def __init__(self, texts: list[str | None], item: np.ndarray, ids: np.ndarray) -> None:
        """Text ``i`` belongs to the item whose id is ``ids[item[i]]``."""
        self.ids = ids
        data, bounds = T.utf8(pa.array(texts, pa.large_string()))
        data, starts, ends, row = terms(data, bounds)
        # The table of terms is by hash; the terms themselves tell whether a found one is the same.
        h = T.hashes(data, starts, ends)
        self.h, first, place = np.unique(h, return_index=True, return_inverse=True)
        words = [data[starts[i]:ends[i]].tobytes() for i in first]
        if any(words[p] != data[s:e].tobytes() for p, s, e in zip(place, starts, ends)):
            raise ValueError("two terms of the items share a hash")
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        held = np.unique(place.astype(np.int64) * len(ids) + item[row])
        self.term_of, self.items = held // len(ids), held % len(ids)
        self.first = np.searchsorted(self.term_of, np.arange(len(self.h) + 1))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the spans are indexed terms, and which terms these are."""
        if not len(self.h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = T.hashes(data, starts, ends)
        place = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        found = np.flatnonzero((self.h[place] == h) & (self.sizes[place] == ends - starts))
        place = place[found]
        size = self.sizes[place]
        bounds = np.concatenate([[0], np.cumsum(size)])
        step = np.arange(bounds[-1])
        same = (data[np.repeat(starts[found] - bounds[:-1], size) + step]
                == self.bytes[np.repeat(self.at[place] - bounds[:-1], size) + step])
        whole = np.logical_and.reduceat(same, bounds[:-1]) if len(found) else np.zeros(0, bool)
        return found[whole], place[whole]


def _counts(index):
    """A row for each document: its terms with repeats, its indexed terms, and how often it has each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch in batches:
            data, bounds = T.utf8(batch.column(1))
            for a, b in T.groups(bounds):
                low, starts, ends, row = terms(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                n = np.bincount(row, minlength=b - a)
                found, place = ix.find(low, starts, ends)
                key, tf = np.unique(row[found] * max(1, len(ix.h)) + place, return_counts=True)
                cuts = np.searchsorted(key // max(1, len(ix.h)), np.arange(b - a + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int64)))
                         for v in (key % max(1, len(ix.h)), tf)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), *lists], ["id", "n", "terms", "tf"])

    return run


class Heaps:
    """For each item the best documents so far: highest score first, then lowest id."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.item = np.zeros(0, np.int64)
        self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.zeros(items, np.int64)  # a full heap takes no lower score

    def push(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = (score > 0) & (score >= self.least[item])
        item = np.concatenate([self.item, item[good]])
        doc = np.concatenate([self.id, doc[good]])
        score = np.concatenate([self.score, score[good]])
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        begins = np.searchsorted(item, np.arange(len(self.least) + 1))
        keep = np.arange(len(item)) - begins[item] < self.top
        full = np.flatnonzero(np.diff(begins) >= self.top)
        self.least[full] = score[begins[full] + self.top - 1]
        self.item, self.id, self.score = item[keep], doc[keep], score[keep]


def _score(index, w: np.ndarray, documents: int, total: int, top: int):
    """A task's heaps over its documents' counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        items = len(ix.ids)
        heaps = Heaps(items, top)
        rows = max(1, MOST_SUMS // items)
        postings = np.diff(ix.first)
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            size = np.diff(lists.offsets.to_numpy())
            term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            # n * documents passes 64 bits only where a text has over 10**17 / documents terms.
            m = 10 + 90 * n * documents // max(1, total)
            row = np.repeat(np.arange(len(doc)), size)
            part = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            begins = np.concatenate([[0], np.cumsum(size)])
            work = np.concatenate([[0], np.cumsum(postings[term])])[begins]
            a = 0
            while a < len(doc):
                b = int(np.searchsorted(work, work[a] + MOST_SUMS, "right")) - 1
                b = min(max(b, a + 1), a + rows, len(doc))
                cut = slice(begins[a], begins[b])
                each = postings[term[cut]]
                ends = np.cumsum(each)
                at = np.repeat(ix.first[term[cut]] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)
                cell = np.repeat(row[cut] - a, each) * items + ix.items[at]
                sums = np.zeros((b - a) * items, np.int64)
                np.add.at(sums, cell, np.repeat(part[cut], each))
                found = np.flatnonzero(sums)
                heaps.push(found % items, doc[a + found // items], sums[found])
                a = b
        yield pa.RecordBatch.from_arrays(
            [pa.array(ix.ids[heaps.item]), pa.array(heaps.id), pa.array(heaps.score)], ["item", "doc", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text: str = "text",
           item_col: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """The ``top`` documents with a score above 0 for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, in which only A-Z are
    lower-cased.  Scores are whole numbers, from rounded weights and term counts over document lengths;
    see ``weights`` below.  Equal scores go by ascending id.

    Null and empty texts have no terms; such documents count for nothing and such items find nothing.
    Rows without an id have no name to be returned by: a document like that counts in the statistics only, an
    item is left out.  Rows that share an item's id are one item with the terms of all.  Repeated documents
    are documents each, ranked one after the other.  Empty tables give no rows; other columns are not
    looked at.  Ids are whole numbers.  An index holds the items of at most ``most_bytes`` of text, or one
    item's; the rest take another pass over the texts.
    """
    spark = docs.sparkSession
    T.prepare_workers(spark)
    out = scratch_path(spark, "search")
    with scratch(spark):
        named = stage(items.where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull())
                      .select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")),
                      "search-items")
        stored = named.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
        blocks = -(-int(stored) // max(1, most_bytes // 2))
        results = [_block(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")),
                          named.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k) if blocks > 1 else named, top)
                   for k in range(blocks)]
        results = [r for r in results if r is not None]
        rows = results[0] if results else None
        for more in results[1:]:
            rows = rows.unionByName(more)
        if rows is None:
            return spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
        rows.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score").write.parquet(out)
    return spark.read.schema(f"{item_col} long, rank int, {id_col} long, score long").parquet(out)


def weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    """1000 times the logarithm of how rare a term is, rounded down."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))).astype(np.int64)


def _block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    held = items.collect()  # bounded by most_bytes
    ids = sorted({r["item"] for r in held})
    if not ids:
        return None
    place = {v: i for i, v in enumerate(ids)}
    index = Index([r["text"] for r in held], np.array([place[r["item"]] for r in held], np.int64), np.array(ids, np.int64))
    sent = spark.sparkContext.broadcast(index)
    counts = stage(docs.mapInArrow(_counts(sent), "id long, n long, terms array<long>, tf array<long>"), "search-counts")
    facts = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
    documents, total = facts["documents"], facts["total"] or 0
    frequency = np.zeros(len(index.h), np.int64)
    # One row for each indexed term.
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[r["term"]] = r["count"]
    heaps = (counts.where(F.col("id").isNotNull() & (F.size("terms") > 0))
             .mapInArrow(_score(sent, weights(frequency, documents), documents, total, top),
                         "item long, doc long, score long"))
    # Merged in two steps, as there are as many heaps as tasks.
    best = [F.desc("score"), F.asc("doc")]
    part = heaps.withColumn("_part", F.pmod(F.xxhash64("doc"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_part").orderBy(*best)))
    merged = part.where(F.col("rank") <= top).drop("_part", "rank")
    merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best)))
    return merged.where(F.col("rank") <= top).select("item", "rank", "doc", "score")
