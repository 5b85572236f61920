"""Byte-pair pieces of a SentencePiece model, merged in rounds over numpy arrays.

The vocabulary file is the caller's; nothing is trained here.  All distinct words of a batch
are symbols in one flat array.  Each round looks up, for each word, the best rank of its neighbouring
pairs, merges the leftmost pairs of that rank that do not overlap, in all words at once, and closes
the gaps; a word without a pair is done.  A word here is a run of characters of which every two
neighbours occur somewhere inside a piece, as no merge joins two others.

The model must be of kind BPE with byte fallback, without own symbols and with the text taken as it
is, but for a space put before it and spaces written as a mark; others are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from starflow.llm import text as T

# How such a model writes a space, and the kinds of its pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Texts are merged in groups of about so many bytes, or one by one where they are longer.
GROUP_BYTES = 1 << 19
_NONE = np.int64(1) << 40


class Pieces:
    """The tables of one model: characters, pairs, pieces' bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        scores = np.array([model.get_score(i) for i in range(n)])
        byte = np.array([model.is_byte(i) for i in range(n)])
        special = np.array([model.is_control(i) or model.is_unknown(i) for i in range(n)])
        if byte.sum() != 256 or any(model.is_unused(i) for i in range(n)):
            raise ValueError("the model must have byte fallback and no unused pieces")
        if model.normalize("a  ﬁ　 b ") != "▁a▁▁ﬁ　▁b▁":
            raise ValueError("the model must take texts as they are, with a space before them")
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.of_byte = np.zeros(256, np.int64)
        for i in np.flatnonzero(byte):
            self.of_byte[int(names[i][3:-1], 16)] = i
        normal = [i for i in range(n) if not byte[i] and not special[i]]
        # Symbols are pieces, then characters that only occur inside pieces, then all others as one.
        symbol = {names[i]: i for i in normal}
        for i in normal:
            for c in names[i]:
                symbol.setdefault(c, len(symbol) + n)
        self.first_other = n
        self.char = np.full(0x110000, -1, np.int64)
        for text, s in symbol.items():
            if len(text) == 1:
                self.char[ord(text)] = s
        self.rank = np.full(n, _NONE)
        # Equal scores merge from the left like one rank.
        _, order = np.unique(-scores[normal], return_inverse=True)
        self.rank[normal] = order
        pairs = {}
        neighbours = set()
        for i in normal:
            name = names[i]
            neighbours.update(zip(name, name[1:]))
            for cut in range(1, len(name)):
                left, right = symbol.get(name[:cut]), symbol.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = _Table(pairs)
        self.near = _Table({ord(a) << 32 | ord(b): 1 for a, b in neighbours})
        # What each id writes: its bytes, with spaces; nothing for a control symbol.
        written = [b"" if special[i] else bytes([int(names[i][3:-1], 16)]) if byte[i]
                   else names[i].replace(SPACE, " ").encode() for i in range(n)]
        written[self.unknown] = model.decode([self.unknown]).encode() if self.unknown >= 0 else b""
        self.sizes = np.array([len(w) for w in written], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(written), np.uint8)
        self.spaced = np.array([name.startswith(SPACE) for name in names])
        self.is_byte = byte

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        piece = self.pairs.get(left << 32 | right)
        return np.where(piece >= 0, self.rank[piece], _NONE), piece


class _Table:
    """Whole numbers by whole numbers, in open slots; -1 where there is none."""

    def __init__(self, entries: dict[int, int]) -> None:
        size = 1 << (4 * len(entries) + 4).bit_length()
        self.mask = np.int64(size - 1)
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        keys = np.array(list(entries), np.int64)
        values = np.array(list(entries.values()), np.int64)
        slot, self.most = self._slot(keys), 0
        while len(keys):
            free = self.keys[slot] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.mask
            self.most += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (T.mix(keys.astype(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            found[left[hit]] = self.values[slot[hit]]
            more = ~hit & (there >= 0)
            left, slot = left[more], (slot[more] + 1) & self.mask
        return found


def _leftmost(chosen: np.ndarray) -> np.ndarray:
    """Of chosen pairs that stand next to each other every second one, from the left."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return at
    begins = np.concatenate([[True], np.diff(at) > 1])
    begin = at[begins][np.cumsum(begins) - 1]
    return at[(at - begin) % 2 == 0]


def merge(symbols: np.ndarray, starts: np.ndarray, tables: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Merge each word's symbols until no pair is left; symbols and the words' bounds.

    ``starts`` holds where each word begins; none is empty.
    """
    n_words = len(starts)
    sizes = np.diff(np.concatenate([starts, [len(symbols)]]))
    done_symbols, done_words, done_sizes = [], [], []
    word = np.arange(n_words)
    sym = symbols.astype(np.int64)
    rank = np.full(len(sym), _NONE)
    piece = np.full(len(sym), -1, np.int64)
    if len(sym) > 1:
        rank[:-1], piece[:-1] = tables.pair_rank(sym[:-1], sym[1:])
    while n_words and len(sym):
        ends = np.cumsum(sizes)
        begins = ends - sizes
        rank[ends - 1] = _NONE  # a pair over the end of a word
        best = np.minimum.reduceat(rank, begins)
        over = best == _NONE
        if over.any():
            mine = np.repeat(over, sizes)
            done_symbols.append(sym[mine])
            done_words.append(word[over])
            done_sizes.append(sizes[over])
            keep = ~mine
            sym, rank, piece = sym[keep], rank[keep], piece[keep]
            word, sizes, best = word[~over], sizes[~over], best[~over]
            if not len(word):
                break
            ends = np.cumsum(sizes)
            begins = ends - sizes
        owner = np.repeat(np.arange(len(word)), sizes)
        at = _leftmost(rank == best[owner])
        at = _in_turn(sym, piece, at, owner, best, ends, tables)
        sym[at] = piece[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sizes = sizes - np.bincount(owner[at], minlength=len(word))
        fresh = np.zeros(len(sym), bool)
        fresh[at] = True
        # The pairs of a merged symbol with both neighbours are new.
        fresh, sym, rank, piece = fresh[keep], sym[keep], rank[keep], piece[keep]
        fresh[:-1] |= fresh[1:]
        new = np.flatnonzero(fresh[:-1])
        rank[new], piece[new] = tables.pair_rank(sym[new], sym[new + 1])
        rank[-1] = _NONE
    order = np.concatenate([*done_words, np.zeros(0, np.int64)])
    size = np.zeros(n_words, np.int64)
    size[order] = np.concatenate([*done_sizes, np.zeros(0, np.int64)])
    bounds = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate([*done_symbols, np.zeros(0, np.int64)])
    result = np.zeros(len(flat), np.int64)
    sent = size[order]
    before = np.cumsum(sent) - sent
    result[np.repeat(bounds[order] - before, sent) + np.arange(len(flat))] = flat
    return result, bounds


def _in_turn(sym, piece, at, owner, best, ends, tables: Pieces) -> np.ndarray:
    """Of several merges in a word only the first, if a merge would give a pair of better rank.

    One at a time, that better pair would come before the word's next merge.
    """
    several = np.bincount(owner[at], minlength=len(best)) > 1
    many = np.flatnonzero(several[owner[at]])
    if not len(many):
        return at
    here = at[many]
    whose = owner[here]
    made = piece[here]
    merges = np.zeros(len(sym) + 1, bool)
    merges[at] = True
    begin = np.concatenate([[0], ends[:-1]])
    bad = np.zeros(len(best), bool)

    def judge(left, right, where):
        r, _ = tables.pair_rank(left, right)
        bad[whose[where[r < best[whose[where]]]]] = True

    # To the left the neighbour is as it was, or was itself just merged.
    left = np.flatnonzero(here - 1 >= begin[whose])
    judge(sym[here[left] - 1], made[left], left)
    left = np.flatnonzero(here - 2 >= begin[whose])
    left = left[merges[here[left] - 2]]
    judge(piece[here[left] - 2], made[left], left)
    right = np.flatnonzero(here + 2 < ends[whose])
    judge(made[right], sym[here[right] + 2], right)
    if not bad.any():
        return at
    first = np.concatenate([[True], owner[at][1:] != owner[at][:-1]])
    return at[first | ~bad[owner[at]]]


class Encoder:
    """Ids of texts; the words of a batch are merged once each."""

    def __init__(self, path: str) -> None:
        self.tables = Pieces(path)

    def words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the marked texts, and where words and texts begin in them."""
        text = data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        # A code point begins at each byte that is no continuation.
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
        mark = ord(SPACE)
        points[points == 0x20] = mark
        some = np.flatnonzero(np.diff(begins))
        marked = np.insert(points, begins[some], mark)
        shift = np.zeros(len(begins), np.int64)
        shift[some + 1] = 1
        begins = begins + np.cumsum(shift)
        cut = np.ones(len(marked), bool)
        if len(marked) > 1:
            cut[1:] = self.tables.near.get(marked[:-1] << 32 | marked[1:]) < 0
        cut[begins[:-1][np.diff(begins) > 0]] = True
        return marked, np.flatnonzero(cut), begins

    def ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, without ends, and their bounds."""
        points, starts, begins = self.words(data, bounds)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
        ends = np.concatenate([starts[1:], [len(points)]])
        sizes = ends - starts
        h = _hashes(points, starts, ends)
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        own = self._differs(points, starts, sizes, first, inverse)
        if len(own):
            # Words that share a hash with another one are merged by themselves.
            inverse = inverse.copy()
            inverse[own] = len(first) + np.arange(len(own))
            first = np.concatenate([first, own])
        size = sizes[first]
        at = np.cumsum(size) - size
        flat = points[np.repeat(starts[first] - at, size) + np.arange(size.sum())]
        symbols = self.tables.char[flat]
        # What no piece holds never merges; the code point is kept, below 0.
        merged, cuts = merge(np.where(symbols < 0, -2 - flat, symbols), at, self.tables)
        merged, cuts = self._to_bytes(merged, cuts)
        length = np.diff(cuts)[inverse]
        last = np.cumsum(length)
        out = merged[np.repeat(cuts[inverse] - last + length, length) + np.arange(last[-1])]
        upto = np.concatenate([[0], last])
        return out, upto[np.searchsorted(starts, begins)]

    def _differs(self, points, starts, sizes, first, inverse) -> np.ndarray:
        like = first[inverse]
        short = sizes != sizes[like]
        same = np.flatnonzero(~short)
        size = sizes[same]
        at = np.cumsum(size) - size
        step = np.arange(size.sum())
        equal = (points[np.repeat(starts[same] - at, size) + step] == points[np.repeat(starts[like[same]] - at, size) + step])
        short[same] = ~np.logical_and.reduceat(equal, at) if len(same) else False
        return np.flatnonzero(short)

    def _to_bytes(self, symbols: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace what is no piece by the ids of its UTF-8 bytes."""
        t = self.tables
        odd = (symbols < 0) | (symbols >= t.first_other)
        if not odd.any():
            return symbols, cuts
        others = {int(s): c for c, s in enumerate(t.char.tolist()) if s >= t.first_other} if (
            symbols >= t.first_other).any() else {}
        kinds, inverse = np.unique(symbols[odd], return_inverse=True)
        written = [chr(-2 - k if k < 0 else others[k]).encode() for k in kinds.tolist()]
        sizes = np.array([len(w) for w in written], np.int64)
        length = np.ones(len(symbols), np.int64)
        length[odd] = sizes[inverse]
        ends = np.cumsum(length)
        out = np.zeros(int(ends[-1]), np.int64)
        out[(ends - 1)[~odd]] = symbols[~odd]
        flat = t.of_byte[np.frombuffer(b"".join(written), np.uint8)]
        begin = (np.cumsum(sizes) - sizes)[inverse]
        size = sizes[inverse]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat((ends - length)[odd], size) + step] = flat[np.repeat(begin, size) + step]
        return out, np.concatenate([[0], ends])[cuts]


def _hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = T._power_tables(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:len(points)], out=sums[1:])
    return T.mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def decode(ids: np.ndarray, bounds: np.ndarray, t: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that ids stand for, and their bounds.

    The space before a text is taken off its first piece.  Bytes that are no UTF-8 stay as they
    are; the caller replaces them.
    """
    if len(ids) and (ids.min() < 0 or ids.max() >= len(t.sizes)):
        raise ValueError("an id is not in the model")
    size = t.sizes[ids]
    begin = t.at[ids]
    visible = np.flatnonzero(size)
    row = np.searchsorted(bounds, visible, "right") - 1
    first = visible[np.concatenate([[True], row[1:] != row[:-1]])] if len(visible) else visible
    first = first[t.spaced[ids[first]]]
    size[first] -= 1
    begin[first] += 1
    ends = np.cumsum(size)
    out = t.bytes[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
    return out, np.concatenate([[0], ends])[bounds]


_loaded: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """A worker's tables, made once."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _rows(fn):
    """Run ``fn`` on the last column of each batch; the other columns stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            done = fn(column)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], done], batch.schema.names)

    return run


def _unused(name: str, names: list[str]) -> str:
    while name in names:
        name = f"_{name}"
    return name


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each text, an end at last, exactly as the sentencepiece library gives them.

    A null or empty text has the end alone.  Repeated rows stay repeated, a table without rows gives
    none, and all columns are kept; a column named ``ids`` is replaced.  A text is encoded whole, by one task,
    with memory that grows with it.  ``path`` must exist on every worker.
    """
    T.prepare_workers(df.sparkSession)

    def encode(column: pa.Array) -> pa.Array:
        encoder = _encoder(path)
        data, bounds = T.utf8(column)
        parts, sizes = [], []
        for a, b in T.groups(bounds, GROUP_BYTES):
            out, cuts = encoder.ids(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
            parts.append(np.insert(out, cuts[1:], encoder.tables.end))
            sizes.append(np.diff(cuts) + 1)
        size = np.concatenate([*sizes, np.zeros(0, np.int64)])
        flat = np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    kept = [c for c in df.columns if c != ids]
    given = df.select(*kept, F.col(text).cast("string").alias(_unused("text", kept)))
    schema = S.StructType([*df.select(*kept).schema.fields, S.StructField(ids, S.ArrayType(S.IntegerType()))])
    return given.mapInArrow(_named(_rows(encode), schema.names), schema)


def _named(run, names: list[str]):
    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names)

    return renamed


def decode_ids(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that each list of ids stands for; null gives null, no ids the empty text.

    Control symbols write nothing, and bytes that are no UTF-8 become U+FFFD.  All columns are kept; one
    named ``text`` is replaced.  An id that the model lacks, or null among ids, fails.
    """
    T.prepare_workers(df.sparkSession)

    def decoded(column: pa.Array) -> pa.Array:
        t = _encoder(path).tables
        lists = column.cast(pa.large_list(pa.int64()))
        if lists.null_count:
            valid = pc.is_valid(lists)
            lists = pc.if_else(valid, lists, pa.scalar([], pa.large_list(pa.int64())))
        else:
            valid = None
        flat = lists.flatten()
        if flat.null_count:
            raise ValueError("null among ids")
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        out, cuts = decode(flat.to_numpy(zero_copy_only=False), offsets, t)
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(cuts), pa.py_buffer(out)])
        try:
            texts = texts.cast(pa.large_string())
        except pa.ArrowInvalid:
            texts = pa.array([x.as_py().decode("utf-8", "replace") for x in texts], pa.large_string())
        texts = texts.cast(pa.string())
        return texts if valid is None else pc.if_else(valid, texts, pa.scalar(None, pa.string()))

    kept = [c for c in df.columns if c != text]
    given = df.select(*kept, F.col(ids).alias(_unused("ids", kept)))
    schema = S.StructType([*df.select(*kept).schema.fields, S.StructField(text, S.StringType())])
    return given.mapInArrow(_named(_rows(decoded), schema.names), schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """How many ids each text has, and hashes of its ids and of what they decode to."""
    encoded = encode_texts(docs.select(F.col(id_col), F.col(text)), path, text, "ids").select(id_col, "ids")
    read = decode_ids(encoded, path)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return read.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
