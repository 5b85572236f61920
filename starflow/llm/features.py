"""Sparse features of texts for the classifiers: hashed words, and the shape of the text."""

from __future__ import annotations

import numpy as np

from starflow.llm import text as T

WORD_BITS = 20
#: Beginnings of words in bytes that count as features of their own.
STEMS = (4, 5, 6)
TRIGRAM_BITS = 12

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?'\"-")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(row: np.ndarray, column: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and number of repeats of each pair."""
    pairs, repeats = np.unique((row.astype(np.uint64) << np.uint64(bits)) | column, return_counts=True)
    mask = np.uint64((1 << bits) - 1)
    return (pairs >> np.uint64(bits)).astype(np.int64), (pairs & mask).astype(np.int64), repeats


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words and beginnings of words, weighted to unit length, and a constant.

    Words are runs of letters in lower case, so marks beside a word don't hide it.
    """
    rows = len(bounds) - 1
    kept = T.lower(np.where(_LETTER[data], data, 32).astype(np.uint8))
    starts, ends, row = T.spans(kept, bounds)
    grams, of = [T.hashes(kept, starts, ends)], [row]
    for size in STEMS:
        longer = ends - starts > size
        begin = starts[longer]
        grams.append(T.mix(T.hashes(kept, begin, begin + size) + np.uint64(size)))
        of.append(row[longer])
    row, column, repeats = _distinct(np.concatenate(of), np.concatenate(grams) >> np.uint64(64 - WORD_BITS),
                                     WORD_BITS)
    value = 1 + np.log(repeats)
    norm = np.sqrt(np.bincount(row, value ** 2, rows))
    return _with_dense(rows, row, column, 8 * value / norm[row], np.ones((rows, 1)), WORDS_ALWAYS)


WORDS_ALWAYS = 1 << WORD_BITS
WORDS_WIDTH = WORDS_ALWAYS + 1


def shape(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How a text is written: shares of kinds of characters, repeats, and hashed byte trigrams."""
    rows = len(bounds) - 1
    size = np.maximum(1, np.diff(bounds))
    starts, ends, row = T.spans(data, bounds)
    h = T.hashes(T.lower(data), starts, ends)
    n = np.bincount(row, minlength=rows)
    some = np.maximum(1, n)

    def repeated(grams: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Share of a row's grams that stand there before."""
        total = np.bincount(of, minlength=rows)
        distinct = np.bincount(_distinct(of, grams >> np.uint64(24), 40)[0], minlength=rows)
        return 1 - distinct / np.maximum(1, total) - (total == 0)

    beside = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    three = beside[1:] & beside[:-1] if len(row) > 2 else np.zeros(0, bool)
    trigrams = T.mix(h[:-2] + T.mix(h[1:-1] + T.mix(h[2:])))[three] if len(three) else h[:0]
    lone = (ends - starts == 1) & ~_LETTER[data[starts]] & ~_DIGIT[data[starts]] if len(starts) else np.zeros(0, bool)
    ending = _SYMBOL[data[ends - 1]] & ~_MARKS[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    dense = np.stack([
        np.ones(rows),
        _per_row(_SYMBOL[data] & ~_MARKS[data], bounds) / size,
        _per_row(_MARKS[data], bounds) / size,
        _per_row(_UPPER[data], bounds) / np.maximum(1, _per_row(_LETTER[data], bounds)),
        _per_row(_DIGIT[data], bounds) / size,
        _per_row(data == 10, bounds) / size,
        np.bincount(row[1:][beside & (h[1:] == h[:-1])] if len(row) else row, minlength=rows) / some,
        repeated(trigrams, row[2:][three] if len(three) else row[:0]),
        np.bincount(row[lone], minlength=rows) / some,
        np.bincount(row[ending], minlength=rows) / some,
        np.minimum(1, size / some / 40),
        1 / (1 + n),
    ], axis=1) * np.array([1, 20, 10, 5, 10, 10, 10, 10, 10, 10, 5, 1])

    flat = T.lower(data).astype(np.uint64)
    if len(flat) > 2:
        inside = np.ones(len(flat) - 2, bool)
        edges = bounds[1:-1]
        for back in (1, 2):
            at = edges - back
            inside[at[(at >= 0) & (at < len(inside))]] = False
        grams = (flat[:-2] << np.uint64(16) | flat[1:-1] << np.uint64(8) | flat[2:])[inside]
        of = (np.searchsorted(bounds, np.arange(len(flat) - 2), "right") - 1)[inside]
        mask = np.uint64((1 << TRIGRAM_BITS) - 1)
        of, column, repeats = _distinct(of, T.mix(grams) & mask, TRIGRAM_BITS)
    else:
        of, column, repeats = (np.zeros(0, np.int64) for _ in range(3))
    value = 20 * repeats / size[of]
    return _with_dense(rows, of, column, value, dense, SHAPE_ALWAYS)


SHAPE_ALWAYS = 1 << TRIGRAM_BITS
SHAPE_WIDTH = SHAPE_ALWAYS + 12


def _with_dense(rows, row, column, value, dense, first):
    """Append each row's dense features, as columns from ``first`` on, and put rows together."""
    wide = dense.shape[1]
    row = np.concatenate([row, np.repeat(np.arange(rows), wide)])
    column = np.concatenate([column, np.tile(np.arange(first, first + wide), rows)])
    value = np.concatenate([value, dense.ravel()])
    order = np.argsort(row, kind="stable")
    return (np.bincount(row, minlength=rows), column[order].astype(np.int32),
            value[order].astype(np.float32))
