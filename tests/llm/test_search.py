import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starflow.llm import search as X
from starflow.llm.search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, top=10):
    counts = [(i, Counter(t), len(t)) for i, t in ((i, terms(text)) for i, text in docs)]
    n_docs, total = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        if item is not None:
            wanted[item].update(terms(text))
    out = []
    for item, held in wanted.items():
        scored = []
        for doc, c, n in counts:
            m = 10 + (90 * n * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in held if c[t])
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, score string")
    b = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    found = search(d.repartition(4), b, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def tables(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé日9", k=r.randint(1, 3))) for _ in range(60)]
    weights = [1 / (k + 1) for k in range(60)]

    def text(most):
        return "".join(w.upper() * (r.random() < 0.2) or w + r.choice([" ", "-", "_", "\n", " ;"])
                       for w in r.choices(words, weights, k=r.randint(0, most)))

    return [(i, text(40)) for i in range(300)], [(k, text(8)) for k in range(20)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs, items = tables(seed)
    assert run(spark, docs, items) == brute_force(docs, items)


def test_blocks_of_items_and_small_work(spark, monkeypatch):
    docs, items = tables(7)
    monkeypatch.setattr(X, "MOST_SUMS", 30)
    assert run(spark, docs, items, most_bytes=400) == brute_force(docs, items)


def test_ties_copies_nulls_and_long_texts(spark):
    docs = [(i, "same text here") for i in range(40)] + [(None, "same text here"), (50, None), (51, ""), (52, "..."),
            (7, "same text here"), (60, "filler words " * 50_000 + "same"), (61, "q" * 200_000)]
    items = [(1, "same"), (1, "TEXT other"), (2, None), (3, ""), (None, "same"), (4, "absent"), (5, "here here"), (6, "q" * 200_000)]
    got = run(spark, docs, items)
    assert got == brute_force(docs, items)
    assert [d for i, _, d, _ in got if i == 1] == [0, 1, 2, 3, 4, 5, 6, 7, 7, 8]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a")], [])
    assert run(spark, [(1, None)], [(1, "a")]) == []


def test_terms_that_share_a_hash_are_told_apart():
    index = X.Index(["alpha beta"], np.array([0]), np.array([5]))
    data = np.frombuffer(b"alpha gamma", np.uint8)
    starts, ends = np.array([0, 6]), np.array([5, 11])
    index.h[:] = np.sort(X.T.hashes(data, starts, ends))
    found, place = index.find(data, starts, ends)
    assert all(index.bytes[index.at[p]:index.at[p + 1]].tobytes() == data[starts[f]:ends[f]].tobytes() for f, p in zip(found, place))


def test_heaps_keep_the_best():
    r = np.random.default_rng(1)
    heaps, rows = X.Heaps(4, 3), []
    for _ in range(50):
        item, doc, score = r.integers(0, 4, 6), r.integers(0, 1000, 6), r.integers(0, 9, 6)
        heaps.push(item, doc, score)
        rows += zip(item.tolist(), (-score).tolist(), doc.tolist())
    want = [x for k in range(4) for x in sorted(t for t in rows if t[0] == k and t[1] < 0)[:3]]
    assert list(zip(heaps.item.tolist(), (-heaps.score).tolist(), heaps.id.tolist())) == want
