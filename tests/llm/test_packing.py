import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starflow.llm import text as T
from starflow.llm.packing import (
    WordTokenizer, best_fit_decreasing, lower_bound, pack, pack_documents, tokenized_pieces)

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "It's THE <|endoftext|> <|ENDOFTEXT|> don't!!", "a.b c'd's. e!!'s 12.5% x&&& ***", "  tab\tnew\nline ",
       "H̱ ẖ ÉtÉ É! İ ΣΣ Σ.  nb sp", "日本語 text. 'll 're x'LL", "-----'s a--'s",
       "x" * 3000, "the " * 9000, "́a ... .a a. .", "e.́ a!̧ b"]


def test_ids_are_the_tokenizers():
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    bits = ["a", "B", "É", ".", "'", "s", " ", "!", "<|", "9", "́", "\n", "ß", "日", "|>", "T", "ll", "-", "é", "Ÿ"]
    texts = [*ODD, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(3000))]
    plain = [t for t in texts if t and "<|" not in t]
    latin = [t for t in plain if max(t) < "\u0180"]
    letters = [chr(c) * 2 + chr(c + 1) for c in range(0xC0, 0x17E)]
    for group in (texts, plain, latin, letters):
        ids, sizes = WordTokenizer(PATH, most=900).encode(*T.utf8(pa.array(group)))
        cuts = np.split(ids, np.cumsum(sizes)[:-1])
        for t, got in zip(group, cuts):
            assert got.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def least(lengths, capacity):
    """Fewest sequences, by trying all set partitions of a few pieces."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity:
                place(k + 1, bins[:i] + [bins[i] + lengths[k]] + bins[i + 1:])
        place(k + 1, bins + [lengths[k]])

    place(0, [])
    return best


def test_bound_and_best_fit():
    rng = random.Random(1)
    sharp = 0
    for _ in range(300):
        capacity = rng.choice([10, 12, 30])
        lengths = np.array(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True))
        sequence, offset, fill = best_fit_decreasing(lengths, capacity)
        true = least(lengths.tolist(), capacity)
        assert lower_bound(lengths, capacity) <= true <= len(fill) and fill.max() <= capacity
        sharp += lower_bound(lengths, capacity) == true
    assert sharp > 270
    assert lower_bound(np.zeros(0, np.int64), 10) == 0


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(ODD)] + [(None, "x", 1), (3, ODD[3], 2)],
                                 "doc_id long, text string, sequence_id int")
    tokenizer = Tokenizer.from_file(PATH)
    rows = pack_documents(docs).collect()
    check(rows, 4096)
    want = sorted((i if i is not None else -1, n, at, len(ids[at:at + 4096]),
                   zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes()))
                  for i, t, _ in docs.collect()
                  for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [1]]
                  for n, at in enumerate(range(0, len(ids), 4096)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"],
                   r["ids_crc32"]) for r in rows) == want
    assert pack_documents(docs.limit(0)).count() == 0
    ids = tokenized_pieces(docs.where("doc_id = 1"), with_ids=True).first()
    assert ids["ids"] == [1] and ids["length"] == 1


@pytest.mark.parametrize("sizes", [range(1, 60), range(20, 41), range(34, 36)])
def test_exchange(spark, sizes):
    rng = random.Random(7)
    data = [(i, 0, 0, rng.choice(sizes), i % 11, rng.getrandbits(60)) for i in range(3000)]
    pieces = spark.createDataFrame(data, "doc_id long, piece int, start long, length long, ids_crc32 long, salt long")
    rows = pack(pieces, capacity=100, per_partition=400).collect()
    used = check(rows, 100)
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    assert used <= 1.05 * lower_bound(np.array([d[3] for d in data]), 100) + 1
    assert all(a["bound"] <= a["sequences"] for a in rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = pack_documents(docs).collect()
    total = sum(r["length"] for r in rows)
    assert check(rows, 4096) <= -(-total // 4096) + 1
    tokenizer = Tokenizer.from_file(PATH)
    sizes = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
             for r in docs.where(F.col("doc_id") % 9 == 0).collect()}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert all(got[i] == n for i, n in sizes.items()) and len(got) == docs.count()
