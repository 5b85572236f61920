import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starflow.llm import phrases
from starflow.llm.phrases import collocations, count_phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 3) for i, (t, g) in enumerate(rows)], SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counted(rows, longest=5):
    """All phrases' counts by language, with the number of words at ``()``."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = re.findall(r"[^ \t]+", piece)
            counts[lang or "und" if lang != "" else ""][()] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang or "und" if lang != "" else ""][tuple(words[i:i + n])] += 1
    return counts


def brute_force(rows, threshold, longest=5, top=2000):
    out = []
    for lang, f in counted(rows, longest).items():
        n, found = f[()], []
        for p, a in f.items():
            if len(p) < 2 or a < threshold:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and f[q] >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q in f)
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def texts(seed, n, words=12, size=30):
    """Words of very different frequency, with spaces, tabs and marks of all kinds between them."""
    r = random.Random(seed)
    names = ["".join(r.choices("abAé日'", k=r.randint(1, 4))) for _ in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " ! ", "\r\n"]
    return [("".join(w + r.choice(gaps) for w in r.choices(names, weights, k=r.randint(0, size))),
             r.choice(["en", "fr", None])) for _ in range(n)]


@pytest.mark.parametrize("threshold, shards, slots", [(5, 4, 1 << 24), (20, 3, 1 << 16), (2, 1, 1 << 24), (9, 7, 1 << 4)])
def test_equals_brute_force(spark, monkeypatch, threshold, shards, slots):
    monkeypatch.setattr(phrases, "_BLOCK_BITS", 2)
    rows = texts(threshold, 150)
    df = table(spark, rows).repartition(5)
    if slots < 1 << 16:
        # So few slots that most phrases share one.
        found = count_phrases(df, threshold, shards=shards, most_slots=slots)
        want = {(g, " ".join(p)): c for g, f in counted(rows).items() for p, c in f.items() if c >= threshold}
        assert {(r["lang"], r["phrase"]): r["c"] for r in found.collect()} == want
    got = sorted(tuple(r) for r in collocations(df, threshold, shards=shards).collect())
    assert got == brute_force(rows, threshold) and got


def test_phrases_start_when_both_parts_have_reached_the_threshold():
    words = phrases.Words(np.frombuffer(b"a b c\n", np.uint8), np.array([0, 6]), np.zeros(1, np.uint64))
    low, high = np.full(1 << 16, 255, np.uint8), np.zeros(1 << 16, np.uint8)
    for word, since in ((0, 2), (1, 3), (2, 9)):
        slot = int(words.hashes(np.array([word]), 1)[0]) & 0xFFFF
        low[slot] = high[slot] = since
    slots = phrases.Slots(low, high)
    scans = {s: [words.texts(at, n).to_pylist() for n, at, _, _ in phrases.to_count(words, s, 4, slots, 5) if n == 2]
             for s in range(1, 14)}
    assert [s for s, got in scans.items() if "a b" in got[0]] == [3, 4, 5, 6]
    assert [s for s, got in scans.items() if "b c" in got[0]] == [9, 10, 11, 12]


def test_a_task_that_holds_few_phrases_sends_them_on_early(spark, monkeypatch):
    rows = texts(3, 200)
    monkeypatch.setattr(phrases, "MOST_HELD", 8)
    monkeypatch.setattr(phrases, "_BLOCK_BITS", 4)
    assert sorted(tuple(r) for r in collocations(table(spark, rows), 10).collect()) == brute_force(rows, 10)


def test_top_ties_and_repeated_rows(spark):
    rows = [("x y. z w. p q", "en")] * 12 + [("x y", "fr")] * 12 + [("X  Y", "")] * 12
    got = sorted(tuple(r) for r in collocations(table(spark, rows), 10, top=2).collect())
    assert got == brute_force(rows, 10, top=2)
    assert [r[2] for r in got if r[0] == "en"] == ["p q", "x y"] and {r[0] for r in got} == {"en", "fr", ""}


def test_long_texts_nulls_and_empty_tables(spark):
    rows = [("ab cd " * 40_000, "en"), (None, "en"), ("", None), (" \t.\n", "fr"), ("one", None), ("q" * 100_000, "en")]
    assert sorted(tuple(r) for r in collocations(table(spark, rows), 100).collect()) == brute_force(rows, 100)
    assert collocations(table(spark, []), 1).collect() == []
    assert collocations(table(spark, [(None, None)]), 1).collect() == []


def test_exact_beyond_64_bits(spark, monkeypatch):
    def counts(docs, *rest, **more):
        big = [("en", 0, "", 4 * 10**13), ("en", 1, "a", 3 * 10**13 + 7), ("en", 1, "b", 10**13 - 3), ("en", 2, "a b", 10**13 - 9)]
        return spark.createDataFrame(big, "lang string, n int, phrase string, c long")

    monkeypatch.setattr(phrases, "count_phrases", counts)
    (row,) = collocations(table(spark, [])).collect()
    assert row["score"] == 1000 * (10**13 - 9) * 4 * 10**13 // ((3 * 10**13 + 7) * (10**13 - 3))


def test_too_many_scans_are_refused(spark):
    with pytest.raises(ValueError):
        count_phrases(table(spark, []), shards=60)
