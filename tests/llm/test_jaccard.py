import random
import re

import numpy as np
import pytest

from starflow.llm import jaccard
from starflow.llm.components import components
from starflow.llm.jaccard import jaccard_components, keep_one_of_each, linked, prefix_size

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min(least.get(x, i), i)
    return sorted((i, len(s), least[x]) for (i, _), s, x in zip(rows, sets, label))


def near_copies(rng, n, edits, words=120):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        yield " ".join(text)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = ["", None, " \n", "one two", "One  TWO", "one two three", "É x", "a b c d e", "a b c d e f"]
    for edits in (1, 3, 6):
        texts += near_copies(rng, 60, edits)
    texts += list(near_copies(rng, 40, 2, 12))
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{passage} " + " ".join(f"t{rng.randrange(1000)}" for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts += ["same words as before here"] * 30
    texts += [" ".join(f"l{k}" for k in range(20_000)), " ".join(f"l{k}" for k in range(20_500))]
    rng.shuffle(texts)
    return [(7 * i - 50, t) for i, t in enumerate(texts)]


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, rep string")
    assert result(jaccard_components(docs)) == brute(rows)


def test_blocks_equal_brute_force(spark, rows, monkeypatch):
    """With blocks so small that every family is cut into many."""
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(jaccard_components(docs)) == brute(rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    text = "a b c d e f g"
    got = result(jaccard_components(spark.createDataFrame([(3, text), (3, text), (2, text), (3, "x y z"), (9, None)], schema)))
    assert got == [(2, 3, 2), (3, 1, 3), (3, 3, 2), (3, 3, 2), (9, 0, 9)]
    without = jaccard_components(spark.createDataFrame([(None, text), (4, text), (None, "q r s")], schema)).collect()
    assert {(r["n_shingles"], r["component_id"]) for r in without} == {(3, 4), (1, None)}
    none = spark.createDataFrame([], schema)
    assert jaccard_components(none).count() == 0 and keep_one_of_each(none).count() == 0


def test_keeps_one_of_each(spark, rows):
    docs = spark.createDataFrame([(i, t, i) for i, t in rows] + [rows[0] + (0,), (None, "x", 5)],
                                 "doc_id long, text string, component_id long")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, _, c in brute(rows) if i == c)
    assert ids.count(None) == 1


def test_overlap_counts():
    rng = np.random.default_rng(0)
    common = np.arange(100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(common, 60), rng.integers(0, 500, 50).astype(np.uint64)]))
            for _ in range(90)]
    rows = np.array([0, 5, 89])
    want = [[len(np.intersect1d(sets[i], s)) for s in sets] for i in rows]
    assert (jaccard._overlaps(sets, rows) == want).all()
    assert linked(np.arange(2), sets[:2], np.zeros(2, int), 80) == []


def test_prefix_size_is_enough():
    for n in range(1, 200):
        assert prefix_size(n, 80) == n - min(k for k in range(n + 1) if 100 * k >= 80 * n) + 1


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(500, i) for i in range(300)],
    [(i * 37 % 101, (i * 53 + 7) % 101) for i in range(60)]])
def test_components(spark, edges):
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(tuple(r) for r in got.collect()) == label


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    """Repeated ids with other texts, near copies among them; columns named like the ones used inside."""
    a = " ".join(f"a{i}" for i in range(60))
    near = a.replace("a59", "z")
    b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "bc")
    rows = [(1, a, 0), (1, b, 0), (2, near, 0), (2, c, 0), (3, b, 0), (3, b, 0), (4, None, 0), (4, "", 0), (4, "", 0),
            (5, "few words", 0), (5, "other few words", 0), (None, a, 0), (None, a, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(1, a), (1, b), (2, c), (4, None), (4, ""), (5, "few words"), (5, "other few words"), (None, a), (None, a)]
    assert got == sorted(want, key=str)
