"""Documents packed into training sequences of a fixed number of tokens.

Each partition is packed best-fit decreasing, and dual-feasible functions bound from below
the number of sequences any packing of it needs.  A partition that meets its bound is
done.  The others give up their sequences that are not full, exchange those documents,
and pack them again.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from starflow.llm import text as T
from starflow.session import stage

# Marks that may be cut off a word's end: an apostrophe begins endings like 's, and the
# others begin and end the tokenizer's own tokens.
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_MARK[list(b"'<|>")] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


# First bytes of characters after which no accent combines with the ASCII letter before.
_NO_ACCENT = np.zeros(256, bool)
_NO_ACCENT[:0xC0] = True
_NO_ACCENT[0xC2:0xC6] = True

# Words that the tokenizer takes as one, with nothing to compose or cut.
_SIMPLE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_characters() -> dict[int, int]:
    """The visible character by which byte-level tokenizers write each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b if b in plain else 256 + others.index(b) for b in range(256)}


class WordTokenizer:
    """Token ids of texts, by a tokenizer that never joins text across white space.

    A text's ids are those of its words one after the other, so each distinct word is
    given to the tokenizer once.  Case is ignored for ASCII letters: the tokenizer folds
    case itself, but composes accents before that, so not where an accent may follow.  A
    mark after a letter or digit is a word of its own, as the tokenizer cuts there too.
    Words of plain letters go to its model straight away.
    """

    def __init__(self, path: str, most: int = 500_000) -> None:
        # Spark already runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes = _byte_characters()
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes = np.zeros(self.most + 1, np.int64), np.zeros(self.most + 1, np.int64)

    def _ids(self, word: str) -> list[int]:
        if _SIMPLE.fullmatch(word):
            return [t.id for t in self.model.tokenize(word.lower().encode().decode("latin-1").translate(self.bytes))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        made = [self._ids(w) for w in words]
        sizes = np.array([len(m) for m in made], np.int64)
        flat = np.array([x for m in made for x in m], np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        first = len(self.place)
        self.ids[self.used:self.used + len(flat)] = flat
        self.starts[first:first + len(made)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:first + len(made)] = sizes
        self.used += len(flat)
        self.place.update(zip(hashes, range(first, first + len(made))))

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """The bytes with case folded where that is safe, and start, end and row of each word."""
        starts, ends, row = T.spans(data, bounds)
        if b"<|" in data.tobytes():
            return data, starts, ends, row
        if _NO_ACCENT[data].all():
            data = T.lower(data)
        else:
            wide = np.zeros(len(data) + 1, np.int64)
            np.cumsum(data > 127, out=wide[1:])
            edge = np.zeros(len(data) + 1, np.int8)
            plain = wide[ends] == wide[starts]
            edge[starts[plain]] += 1
            edge[ends[plain]] -= 1
            data = np.where(np.cumsum(edge[:-1]) > 0, T.lower(data), data)
        # Step back over the marks at words' ends.
        marked = np.flatnonzero(_MARK[data[ends - 1]])
        last = ends[marked] - 1
        going = np.arange(len(marked))
        while len(going):
            last[going] -= 1
            going = going[last[going] >= starts[marked[going]]]
            going = going[_MARK[data[last[going]]]]
        good = last >= starts[marked]
        good[good] &= _ALNUM[data[last[good]]]
        cut = np.zeros(len(starts), bool)
        cut[marked[good]] = True
        at = np.arange(len(starts)) + np.cumsum(cut) - cut
        first, second = np.empty(len(starts) + int(cut.sum()), np.int64), np.empty(len(starts) + int(cut.sum()), np.int64)
        first[at], second[at] = starts, ends
        second[at[cut]] = first[at[cut] + 1] = last[good] + 1
        second[at[cut] + 1] = ends[cut]
        return data, first, second, np.repeat(row, 1 + cut)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's."""
        rows = len(bounds) - 1
        data, starts, ends, row = self._cut(data, bounds)
        distinct, first, inverse = np.unique(T.hashes(data, starts, ends), return_index=True,
                                             return_inverse=True)
        if len(distinct) > self.most:
            self.most = 2 * len(distinct)
            self.clear()
        elif len(self.place) + len(distinct) > self.most:
            self.clear()
        keys = distinct.tolist()
        place = np.array([self.place.get(h, -1) for h in keys], np.int64)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            raw = data.tobytes()
            known = len(self.place)
            self._learn([keys[k] for k in missing.tolist()],
                        [raw[s:e].decode() for s, e in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist())])
            place[missing] = np.arange(known, known + len(missing))
        place = place[inverse]
        sizes = self.sizes[place]
        total = int(sizes.sum())
        at = np.arange(total) + np.repeat(self.starts[place] - (np.cumsum(sizes) - sizes), sizes)
        return self.ids[at], np.bincount(row, sizes, rows).astype(np.int64)


#: Each Python worker keeps its tokenizers, and the words they know, for its next tasks.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenized_pieces(docs: DataFrame, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                     text_col: str = "text", tokenizer: str | None = None,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, of each text's ids and ``end_id`` after them.

    A null text is an empty one and gives a piece with ``end_id`` alone.  ``start`` counts the
    document's ids before the piece.  ``ids`` holds the ids too if asked for.  Rows that
    repeat an id are documents of their own.  ``tokenizer`` is the path of a tokenizer
    file on all workers; by default the public one of 49,408 ids.
    """
    def run(batches):
        if tokenizer is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        else:
            path = tokenizer
        words = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordTokenizer(path))
        for batch in batches:
            data, bounds = T.utf8(batch.column(1))
            for lo, hi in T.groups(bounds, 1 << 18):
                ids, sizes = words.encode(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo])
                firsts = np.cumsum(sizes) - sizes
                of, piece, start, length, crc, kept = [], [], [], [], [], []
                for k in range(hi - lo):
                    whole = np.append(ids[firsts[k]:firsts[k] + sizes[k]], np.uint32(end_id)).astype("<u4")
                    for n, at in enumerate(range(0, len(whole), capacity)):
                        part = whole[at:at + capacity]
                        of.append(lo + k)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            kept.append(part.astype(np.int32))
                # Copies of a document should not all meet in one partition.
                salt = T.mix(np.array(crc, np.uint64) + np.arange(len(crc), dtype=np.uint64))
                columns = [batch.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                           pa.array(salt.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.list_(pa.int32()))] * with_ids,
                                                 names=names)

    T.prepare_workers(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = kept.drop("text").schema
    for name in ("piece", "start", "length", "ids_crc32", "salt"):
        schema = schema.add(name, "integer" if name == "piece" else "long")
    if with_ids:
        schema = schema.add("ids", S.ArrayType(S.IntegerType()))
    names = schema.names
    return kept.mapInArrow(run, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by two families of dual-feasible functions.

    Each function maps lengths so that whatever fits into one sequence maps to 1 at most;
    the sum over all pieces is then a bound.
    """
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1].astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(1, 51):
        # Rounds (k+1)x down to whole sequences, unless it is whole already.
        value = np.where((k + 1) * x % capacity == 0, k * x, capacity * ((k + 1) * x // capacity))
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    many, total = np.cumsum(count), np.cumsum(count * x)
    for small in range(1, capacity // 2 + 1):
        # Pieces below ``small`` count nothing, so those above capacity - small count 1.
        high = int(many[-1] - many[capacity - small])
        middle = int(total[capacity - small] - total[small - 1])
        best = max(best, high + -(-middle // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each of ``lengths``, which must not rise; and each sequence's fill."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if a sequence has room for r tokens
    for k, length in enumerate(lengths.tolist()):
        fitting = open_rooms >> length
        if fitting:
            least = length + (fitting & -fitting).bit_length() - 1
            chosen = room[least].pop()
            if not room[least]:
                open_rooms &= ~(1 << least)
        else:
            chosen = len(fill)
            fill.append(0)
        sequence[k], offset[k] = chosen, fill[chosen]
        fill[chosen] += length
        left = capacity - fill[chosen]
        if left:
            room[left].append(chosen)
            open_rooms |= 1 << left
    return sequence, offset, np.array(fill, np.int64)


def _pack_partition(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "salt", "ids_crc32", "piece"], ascending=[False, True, True, True],
                                kind="stable")
        lengths = rows["length"].to_numpy()
        sequence, offset, fill = best_fit_decreasing(lengths, capacity)
        return rows.assign(sequence=sequence, offset=offset, fill=fill[sequence], sequences=len(fill),
                           bound=lower_bound(lengths, capacity))

    return run


def pack(pieces: DataFrame, capacity: int = 4096, per_partition: int = 50_000, rounds: int = 3) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, and what certifies the packing.

    ``pieces`` has what ``tokenized_pieces`` returns, and other columns are kept.  A
    partition holds about ``per_partition`` pieces.  ``sequences`` and ``bound`` are the
    number its partition ended with and the least possible one.  An exchange that would
    need more sequences than before is not taken.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    done, pool = [], pieces
    before = None
    for turn in range(1 + rounds):
        parts = max(1, -(-pool.count() // per_partition))
        part = F.pmod(F.xxhash64("salt", "ids_crc32", "piece", F.lit(turn)), F.lit(parts))
        schema = pool.select(*names, part.alias("part")).schema
        for column in ("sequence", "offset", "fill", "sequences", "bound"):
            schema = schema.add(column, "long")
        packed = stage(pool.select(*names, part.alias("part")).groupBy("part")
                       .applyInPandas(_pack_partition(capacity), schema)
                       .withColumn("sequence_id", F.lit(turn << 58) + F.shiftleft("part", 24) + F.col("sequence")),
                       f"packed-{turn}")
        made = packed.where(F.col("offset") == 0).count()
        if before is not None and made >= before[0]:
            done.append(before[1])
            break
        gap = (F.col("sequences") > F.col("bound")) & (F.col("fill") < capacity)
        done.append(packed.where(~gap))
        loose = packed.where(gap)
        count = loose.where(F.col("offset") == 0).count()
        if not count:
            break
        before = (count, loose)
        pool = loose.select(*names)
    else:
        done.append(before[1])
    out = reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], packed.schema)
    return out.select(*names, "sequence_id", "offset", "sequences", "bound")


def pack_documents(docs: DataFrame, capacity: int = 4096, **settings) -> DataFrame:
    """Where each piece of each document stands; see ``tokenized_pieces`` and ``pack``."""
    return pack(stage(tokenized_pieces(docs, capacity, **settings), "pieces"), capacity).drop("salt")
