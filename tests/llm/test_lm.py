import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starflow.llm import lm

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def brute_base(train, texts):
    counts = Counter(t for x in train for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    return [(len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
             sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x))) for x in texts]


def brute_score(train, text, model):
    """The same model with exact counts put to their levels."""
    decode = model.count_of_level()
    grams = Counter()
    for x in train:
        seq = ["", *tokens(x)]
        for k in range(1, model.order + 1):
            grams.update(tuple(seq[i:i + k]) for i in range(len(seq) - k + 1))

    def count(g):
        return decode[lm._levels(np.array([grams[g]]), model.base)[0]] if grams[g] else 0.0

    total, seq = 0.0, ["", *tokens(text)]
    for i in range(1, len(seq)):
        p = (count((seq[i],)) + 1) / (model.train_tokens + model.distinct + 1)
        for k in range(1, min(model.order - 1, i) + 1):
            c = count(tuple(seq[i - k:i]))
            trust = c / (c + model.smoothing)
            p = trust * min(1.0, count(tuple(seq[i - k:i + 1])) / c if c else 0.0) + (1 - trust) * p
        total += math.log10(min(1.0, p))
    return total


TRAIN = ["The cat sat on the mat", "the cat SAT on\tthe hat\n", "", None, "É É é", "a " * 3000,
         "The cat sat on the mat"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    model = lm.train(spark.createDataFrame([(t,) for t in TRAIN], "text string"), order=order, bits_per_entry=64)
    texts = [*TRAIN, "the dog sat", "zzz", " \n "]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    whole = lm.score(docs, model)
    assert whole.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = sorted(whole.collect())
    for r, want, text in zip(rows, brute_base(TRAIN, texts), texts):
        assert tuple(r)[1:4] == want[:3] and r["base_score"] == pytest.approx(want[3])
        assert r["score"] == pytest.approx(brute_score(TRAIN, text, model), abs=1e-6)
    in_blocks = sorted(lm.score(docs, model, max_broadcast=200).collect())
    assert len(lm._blocks(model, 200)) > 2
    for a, b in zip(rows, in_blocks):
        assert tuple(a)[:4] == tuple(b)[:4] and tuple(a)[4:] == pytest.approx(tuple(b)[4:])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = lm.train(none)
    assert lm.score(none, model).count() == 0
    row = lm.score(spark.createDataFrame([(1, "a b")], none.schema), model).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


def test_levels_are_found_and_errors_are_few():
    rng = np.random.default_rng(0)
    h = np.unique(rng.integers(1, 1 << 63, 50_000).astype(np.uint64))
    n = rng.integers(1, 200, len(h))
    import pyarrow as pa

    rows = pa.table({"shard": pa.array([0], pa.int32()), "kind": pa.array([0], pa.int32()),
                     "once": [b""], "more": [h.tobytes()], "counts": [n.astype(np.int64).tobytes()]})
    built = lm._build_shard(12, 1.5)((pa.scalar(0),), rows).to_pylist()
    block = lm._Block(1, built)
    want = lm._levels(n, 1.5)
    got = block.levels(h)
    assert (got >= want).all() and (got > want).mean() < 0.05
    assert (block.levels(rng.integers(1, 1 << 63, 50_000).astype(np.uint64)) > 0).mean() < 0.05
    assert (block.exact(h) == n).all()


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    train = [i for i in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    model = lm.train(docs.where("crc32(cast(doc_id as string)) % 7 != 2"))
    want = dict(zip(rows, brute_base([rows[i] for i in train], rows.values())))
    for r in lm.score(docs, model).collect():
        assert tuple(r)[1:4] == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3])
