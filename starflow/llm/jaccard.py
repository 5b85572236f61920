"""Links between texts whose sets of word shingles overlap enough, by a grouped prefix join.

Shingles are ordered from rare to common.  If two sets overlap enough, they share a shingle
among the first few of each, so only those prefixes are compared.

1. Texts with the same set are one class; classes with the same prefix and size one group.
   What only one text has is no reason to compare it, and is left out of what follows.
2. Groups that share a prefix shingle form a family.  A task ties the groups it sees for a
   shingle to one of them and passes only that one on, so a common shingle costs no more
   than a row for each task.
3. A family's groups are filtered by size: into bands, of which only neighbours can link, and
   bands into blocks of bounded size.
4. Block pairs are expanded to their members, whose whole sets are compared; what a pair of
   blocks sends back are edges of a spanning forest of its links.

No pair of one family goes uncompared unless its members are known to be connected already.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import text as T
from starflow.llm.components import components
from starflow.session import stage

#: Most bytes of the table that goes to all tasks and orders the shingles.  Beyond it shingles share
#: cells: the order gets coarser and families larger, the result stays.
TABLE_BYTES = 256 << 20

#: Text behind each bucket of shingles, for about a million of them.
BUCKET_BYTES = 6_000_000

#: Most members and shingles of a block.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2000, 1_000_000


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def shingle_sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each text, by rows in turn.

    A text of fewer words than ``size`` has one shingle of all of them, or none without words.
    """
    data, bounds = T.utf8(column)
    for lo, hi in T.groups(bounds):
        words, counts = T.words(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
        chained = words
        for k in range(1, size):
            chained = T.mix(chained[:-1] + T.mix(words[k:] + np.uint64(k)))
        at = 0
        for k, n in enumerate(counts.tolist()):
            if n >= size:
                yield lo + k, _distinct(chained[at:at + n - size + 1])
            elif n:
                one = words[at:at + 1]
                for j in range(1, n):
                    one = T.mix(one + T.mix(words[at + j:at + j + 1] + np.uint64(j)))
                yield lo + k, T.mix(one + np.uint64(n << 32))
            else:
                yield lo + k, words[:0]
            at += n


def prefix_size(n: int, percent: int) -> int:
    """How many of its first shingles a set of ``n`` must be compared by."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _bucket(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted hashes are sorted by bucket."""
    return ((h >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


_LOW = np.uint64(0xFFFFFFFF)


def _signature(h: np.ndarray) -> tuple[int, int]:
    a, b = T.mix(h).sum(dtype=np.uint64), T.mix(h ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _order_tables(texts: DataFrame, size: int, n_buckets: int, held: int = 3_000_000) -> DataFrame:
    """For each bucket of shingles a table of how many texts have those that more than one has.

    Within a bucket of about a million a shingle goes by 32 bits of its hash.  A task sends each
    shingle once with its count, so a common one is a row for each task.
    """
    def run(batches):
        def flush():
            h = np.sort(np.concatenate([np.zeros(0, np.uint64), *waiting]))
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            h = h[first]
            cuts = np.searchsorted(_bucket(h, n_buckets), np.arange(n_buckets + 1))
            low, once = (h & _LOW).astype(np.uint32), n == 1
            made = [(k, low[a:b][once[a:b]].tobytes(), low[a:b][~once[a:b]].tobytes(),
                     n[a:b][~once[a:b]].astype(np.uint32).tobytes())
                    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if a < b]
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), (pa.int32(), *[pa.binary()] * 3))],
                    names=["bucket", "once", "more", "counts"])

        waiting, n = [], 0
        for batch in batches:
            for _, s in shingle_sets(batch.column(0), size):
                waiting.append(s)
                n += len(s)
            if n > held:
                yield from flush()
                waiting, n = [], 0
        yield from flush()

    def join(key, rows):
        def gathered(name):
            return [np.frombuffer(x, np.uint32) for x in rows.column(name).to_pylist()]

        once = np.concatenate(gathered("once"))
        low = np.concatenate([once, *gathered("more")])
        n = np.concatenate([np.ones(len(once), np.int64), *gathered("counts")])
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        low, n = low[first], np.add.reduceat(n, first)
        low, n = low[n > 1], n[n > 1]
        table = np.zeros(max(1, min(4 * len(low), TABLE_BYTES // n_buckets)), np.uint8)
        np.maximum.at(table, _cell(low.astype(np.uint64), np.uint64(len(table))),
                      np.minimum(255, np.round(8 * np.log2(n))).astype(np.uint8))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([table.tobytes()])})

    return (texts.mapInArrow(run, "bucket int, once binary, more binary, counts binary")
            .groupBy("bucket").applyInArrow(join, "bucket int, cells binary"))


def _cell(low: np.ndarray, cells) -> np.ndarray:
    return (low * cells >> np.uint64(32)).astype(np.int64)


class _Order:
    """How common a shingle is: 0 if no other text has it, else a logarithm of how many have it."""

    def __init__(self, n_buckets: int, rows) -> None:
        self.n_buckets = n_buckets
        self.first, self.cells = np.zeros(n_buckets, np.int64), np.ones(n_buckets, np.uint64)
        tables, at = [np.zeros(1, np.uint8)], 1  # buckets without a row share the first cell
        for r in rows:
            self.first[r["bucket"]], self.cells[r["bucket"]] = at, len(r["cells"])
            tables.append(np.frombuffer(r["cells"], np.uint8))
            at += len(r["cells"])
        self.table = np.concatenate(tables)

    def levels(self, h: np.ndarray) -> np.ndarray:
        bucket = _bucket(h, self.n_buckets)
        return self.table[self.first[bucket] + _cell(h & _LOW, self.cells[bucket])]


def _group_key(n: int, prefix: np.ndarray) -> int:
    key = T.mix(T.mix(prefix).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    return int(key.view(np.int64)[0])


_PROFILE = "doc_id long, n int, sig_a long, sig_b long, grp long, prefix binary"


def _profiles(docs: DataFrame, ranks, size: int, percent: int) -> DataFrame:
    """Each row's set size and signature, the key of its group, and what of its prefix others may share."""
    def run(batches):
        for batch in batches:
            rows = []
            for _, s in shingle_sets(batch.column(1), size):
                # The rarest shingles; those equally common are in the order of their hashes.
                levels = ranks.value.levels(s)
                chosen = np.argsort(levels, kind="stable")[:prefix_size(len(s), percent)]
                prefix = s[chosen]
                rows.append((len(s), *_signature(s), _group_key(len(s), prefix), prefix[levels[chosen] > 0].tobytes()))
            n, a, b, g, p = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), *(pa.array(x, pa.int64()) for x in (a, b, g)),
                 pa.array(p, pa.binary())], names=["doc_id", "n", "sig_a", "sig_b", "grp", "prefix"])

    return docs.mapInArrow(run, _PROFILE)


def _stars(token: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first group of each token, and edges from it to the token's other groups."""
    order = np.lexsort((group, token))
    token, group = token[order], group[order]
    first = np.concatenate([[True], token[1:] != token[:-1]]) if len(token) else np.zeros(0, bool)
    hub = group[np.maximum.accumulate(np.where(first, np.arange(len(token)), 0))]
    other = hub != group
    edges = np.unique(np.stack([hub[other], group[other]], 1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return token[first], group[first], edges[:, 0], edges[:, 1]


def _group_edges(profiles: DataFrame, n_buckets: int, held: int = 3_000_000) -> DataFrame:
    """Edges that connect all groups sharing a prefix shingle, not always directly."""
    def run(batches):
        def flush():
            t, g, a, b = _stars(np.concatenate([np.zeros(0, np.uint64), *tokens]),
                                np.concatenate([np.zeros(0, np.int64), *groups]))
            cuts = np.searchsorted(_bucket(t, n_buckets), np.arange(n_buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            yield batch_of(some.tolist(), [t[cuts[k]:cuts[k + 1]].tobytes() for k in some],
                           [g[cuts[k]:cuts[k + 1]].tobytes() for k in some])
            for at in range(0, len(a), 100_000):
                # Finished edges, dealt out like the others but with no tokens.
                yield batch_of([int(a[at]) % n_buckets], [b""],
                               [np.stack([a[at:at + 100_000], b[at:at + 100_000]], 1).tobytes()])

        tokens, groups, waiting = [], [], 0
        for batch in batches:
            for g, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens.append(np.frombuffer(p, np.uint64))
                groups.append(np.full(len(tokens[-1]), g, np.int64))
                waiting += len(tokens[-1])
            if waiting > held:
                yield from flush()
                tokens, groups, waiting = [], [], 0
        yield from flush()

    def batch_of(bucket, tokens, groups):
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(tokens, pa.binary()),
                                           pa.array(groups, pa.binary())], names=["bucket", "tokens", "groups"])

    def join(key, rows):
        tokens, groups, edges = [], [], [np.zeros((0, 2), np.int64)]
        for t, g in zip(rows.column("tokens").to_pylist(), rows.column("groups").to_pylist()):
            if t:
                tokens.append(np.frombuffer(t, np.uint64))
                groups.append(np.frombuffer(g, np.int64))
            else:
                edges.append(np.frombuffer(g, np.int64).reshape(-1, 2))
        _, _, a, b = _stars(np.concatenate([np.zeros(0, np.uint64), *tokens]),
                            np.concatenate([np.zeros(0, np.int64), *groups]))
        edges = np.unique(np.concatenate([*edges, np.stack([a, b], 1)]), axis=0)
        return pa.table({"a": pa.array(edges[:, 0]), "b": pa.array(edges[:, 1])})

    return (profiles.select("grp", "prefix").mapInArrow(run, "bucket int, tokens binary, groups binary")
            .groupBy("bucket").applyInArrow(join, "a long, b long"))


def _overlaps(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Shared shingles of the sets at ``rows`` with all sets."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    often = np.bincount(token)
    out = np.zeros((len(rows), m), np.int32)
    place = np.full(m, -1)
    place[rows] = np.arange(len(rows))
    # Common shingles as products of dense matrices, a few hundred at a time.
    dense = often >= 64
    column = np.cumsum(dense) - 1
    kept = dense[token]
    t, o = column[token[kept]], owner[kept]
    order = np.argsort(t, kind="stable")
    t, o = t[order], o[order]
    for first in range(0, int(dense.sum()), 1024):
        lo, hi = np.searchsorted(t, [first, first + 1024])
        matrix = np.zeros((m, 1024), np.float32)
        matrix[o[lo:hi], t[lo:hi] - first] = 1
        out += (matrix[rows] @ matrix.T).astype(np.int32)
    # Rare ones pair by pair, grouped by how many sets have them.
    for count in np.unique(often[(often > 1) & ~dense]):
        kept = often[token] == count
        order = np.argsort(token[kept], kind="stable")
        o = owner[kept][order].reshape(-1, count)
        for block in np.array_split(o, max(1, o.size * count // 4_000_000)):
            a, b = np.repeat(block, count, axis=1).ravel(), np.tile(block, (1, count)).ravel()
            wanted = place[a] >= 0
            np.add.at(out, (place[a[wanted]], b[wanted]), 1)
    return out


def linked(ids: np.ndarray, sets: list[np.ndarray], known: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that, with what is known, connect all linked members.

    ``known`` is a component of each; pairs within the largest one are not compared.
    """
    labels, label, size = np.unique(known, return_inverse=True, return_counts=True)
    if len(labels) < 2:
        return []
    rows = np.flatnonzero(label != np.argmax(size))
    sizes = np.array([len(s) for s in sets])
    shared = _overlaps(sets, rows)
    union = sizes[rows][:, None] + sizes[None, :] - shared
    close = 100 * shared.astype(np.int64) >= percent * union
    parent = np.arange(len(labels))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for k, i in enumerate(rows):
        others, first = np.unique(label[np.flatnonzero(close[k])], return_index=True)
        at = np.flatnonzero(close[k])[first]
        for other, j in zip(others, at):
            a, b = root(label[i]), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((int(ids[i]), int(ids[j])))
    return edges


def _verify(cells: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges between the members of each cell that link; members are compared within their family."""
    def run(key, rows):
        family = np.array(rows.column("family"))
        ids, known = np.array(rows.column("rep")), np.array(rows.column("known"))
        signature = rows.column("sig_a").to_pylist()
        sets = {i: s for i, s in shingle_sets(rows.column("text"), size)}
        # A row of the same id with another text is no member.
        right = np.array([_signature(sets[i])[0] == signature[i] for i in range(len(ids))], bool)
        order = np.flatnonzero(right)[np.argsort(family[right], kind="stable")]
        edges = []
        cuts = np.flatnonzero(np.concatenate([[True], family[order][1:] != family[order][:-1], [True]])) \
            if len(order) else np.zeros(1, int)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = order[lo:hi]
            edges += linked(ids[own], [sets[i] for i in own], known[own], percent)
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("cell").applyInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row.

    Two texts link when their sets of ``size``-word shingles share at least ``percent``
    per cent of their union; words are lower-cased (A-Z) runs without ASCII white space.
    A component's id is the smallest id in it.  Empty and null texts link with nothing
    and have their own id.  Rows that repeat an id and text are returned as often.  A row without an id has the
    component of the texts that equal its own, or none.  Ids are whole numbers.
    """
    spark = docs.sparkSession
    T.prepare_workers(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = rows.select("text")
    n_buckets = max(8, (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES)
    tables = stage(_order_tables(texts, size, n_buckets), "jaccard-order")
    ranks = spark.sparkContext.broadcast(_Order(n_buckets, tables.toLocalIterator()))
    profiles = stage(_profiles(rows, ranks, size, percent), "jaccard-profiles")

    shared = profiles.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    families = components(_group_edges(profiles, max(8, shared // (4 << 20))), "jaccard-families")
    families = stage(families.select(F.col("node").alias("grp"), F.col("component").alias("family")),
                     "jaccard-families")
    same_set = ["n", "sig_a", "sig_b"]
    classes = (profiles.where("n > 0 and doc_id is not null").groupBy(*same_set, "grp")
               .agg(F.min("doc_id").alias("rep")))
    classes = stage(classes.join(families, "grp", "left")
                    .withColumn("family", F.coalesce("family", "grp")).drop("grp"), "jaccard-classes")

    # Filter by size: blocks of neighbouring bands.  A family that fits one block is one cell.
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("int")

    def blocks(number, shingles):
        return F.greatest(F.ceil(number / BLOCK_MEMBERS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")

    of_band = classes.groupBy("family", band.alias("band")).agg(F.count("*").alias("members"),
                                                               F.sum("n").alias("shingles"))
    sizes = stage(of_band.groupBy("family")
                  .agg(F.sum("members").alias("members"), F.sum("shingles").alias("shingles"),
                       F.map_from_entries(F.collect_list(F.struct("band", blocks(F.col("members"), F.col("shingles")))))
                       .alias("bands"))
                  .where("members > 1"), "jaccard-sizes")
    members = (classes.join(sizes, "family")
               .withColumn("small", blocks(F.col("members"), F.col("shingles")) == 1)
               .withColumn("band", band)
               .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("bands")[F.col("band")]).cast("int")))
    members = stage(members, "jaccard-members")
    n_cells = max(8, (members.where("small").agg(F.sum("n")).first()[0] or 0) // BLOCK_SHINGLES)
    # A cell is the hash of what names it; cells that share one are compared family by family.
    alone = F.when(F.col("small"), F.pmod(F.xxhash64("family"), F.lit(n_cells))).otherwise(
        F.xxhash64("family", "band", "block"))
    # Sorted and merged at every size: the texts are what is large here, and members grow with them.
    with_text = members.hint("merge").join(rows.select(F.col("doc_id").alias("rep"), "text"), "rep")
    columns = ["cell", "family", "rep", "sig_a", "known", "text"]
    first = with_text.withColumns({"cell": alone, "known": F.col("rep")}).select(*columns)
    edges = stage(_verify(first, size, percent), "jaccard-links")
    links = stage(components(edges, "jaccard-links"), "jaccard-components")

    large = members.where(~F.col("small"))
    if not large.isEmpty():
        # Blocks of one family against each other, where it is not connected yet.
        now = stage(large.join(links.select(F.col("node").alias("rep"), F.col("component").alias("known")), "rep", "left")
                    .withColumn("known", F.coalesce("known", "rep")), "jaccard-known")
        apart = (now.groupBy("family").agg(F.min("known").alias("low"), F.max("known").alias("high"))
                 .where("low < high").select("family"))
        me = F.struct("band", "block")

        def against(other_band):
            others = F.sequence(F.lit(0), F.col("bands")[other_band] - 1)
            return F.when(F.col("bands")[other_band].isNull(), F.array().cast("array<struct<band:int,block:int>>")).otherwise(
                F.transform(others, lambda k: F.struct(other_band.alias("band"), k.alias("block"))))

        pairs = F.concat(against(F.col("band") - 1), against(F.col("band")), against(F.col("band") + 1))
        crossed = (now.join(stage(apart, "jaccard-apart"), "family", "left_semi")
                   .withColumn("with", F.explode(pairs)).where(F.col("with") != me)
                   .withColumn("cell", F.xxhash64("family", F.least(me, F.col("with")), F.greatest(me, F.col("with")))))
        second = (crossed.hint("merge").join(rows.select(F.col("doc_id").alias("rep"), "text"), "rep").select(*columns))
        more = _verify(second, size, percent).unionByName(
            links.select(F.col("node").alias("a"), F.col("component").alias("b")))
        links = stage(components(stage(more, "jaccard-more"), "jaccard-more"), "jaccard-components")

    named = classes.join(links.withColumnRenamed("node", "rep"), "rep", "left").select(
        *same_set, F.coalesce("component", "rep").alias("component"))
    named = stage(named, "jaccard-named")
    return (profiles.join(named, same_set, "left")
            .select("doc_id", F.col("n").cast("bigint").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that have the smallest id of their component.

    Of rows that repeat id and text one stays.  Rows that share an id but not their text are documents of
    their own, each judged by its text.  Rows without an id stay as they are.
    """
    named = docs.where(F.col(id_col).isNotNull())
    texts = named.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    if texts.groupBy("id").agg((F.min("h") != F.max("h")).alias("several")).where("several").isEmpty():
        kept = stage(jaccard_components(docs, size, percent, id_col, text_col)
                     .where("doc_id = component_id").select("doc_id").distinct(), "jaccard-kept")
        one = named.join(kept, named[id_col] == kept["doc_id"], "left_semi").dropDuplicates([id_col])
        return one.unionByName(docs.where(F.col(id_col).isNull()))
    # An id does not name a text here, so rows get numbers, stored before they are used.
    number = "_row"
    while number in docs.columns:
        number = f"_{number}"
    rows = stage(named.withColumn(number, F.monotonically_increasing_id()), "jaccard-rows")
    ids = rows.select(F.col(number).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    found = jaccard_components(rows.select(number, text_col), size, percent, number, text_col)
    first = (found.join(ids, F.col("doc_id") == F.col("row")).groupBy("component_id")
             .agg(F.min(F.struct("id", "row", "h")).alias("first")).select("first.*"))
    kept = stage(first.groupBy("id", "h").agg(F.min("row").alias("row")).select("row"), "jaccard-kept")
    one = rows.join(kept, rows[number] == kept["row"], "left_semi").drop(number)
    return one.unionByName(docs.where(F.col(id_col).isNull()))
