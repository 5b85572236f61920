import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starflow.llm import fingerprints
from starflow.llm.fingerprints import as_text, edit_fingerprints, likeness, sampled, successors


def jaccard(a, b):
    x, y = (Counter(w for w in re.split("[\x09-\x0d ]+", t.lower()) if w) for t in (a, b))
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


def edited(rows):
    """Text after the edit of each (id, text), in the order of id."""
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        taken = len(t) // 4
        out[i] = t[:len(t) - taken] + after[:taken]
    return out


def test_edits_and_likeness_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(tuple(r) for r in docs.collect())
    want, got = edited(rows), {r["doc_id"]: r for r in edit_fingerprints(docs).collect()}
    text = dict(rows)
    after = {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}
    assert set(got) == set(text)
    for i, r in got.items():
        assert r["n_chars"] == len(text[i])
        assert r["edited_sha256"] == hashlib.sha256(want[i].encode()).hexdigest()
    for column, other in (("near_edited", want), ("near_next", after)):
        long = [i for i in got if len(text[i].split()) > 100 and len(other[i].split()) > 100]
        errors = [got[i][column] - jaccard(text[i], other[i]) for i in long]
        assert abs(sum(errors) / len(errors)) < 0.03
        assert sum(e * e for e in errors) / len(errors) < 0.015
    same = {}
    for i, r in got.items():
        assert same.setdefault(text[i], r["fingerprint"]) == r["fingerprint"]


@pytest.mark.parametrize("bins, samples", [(1, 256), (64, 4), (256, 1)])
def test_collision_rate_is_generalised_jaccard(spark, bins, samples):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        a = [rng.choice(vocabulary) for _ in range(600)] * 2
        b = [w if rng.random() < share else rng.choice(vocabulary) for w in a]
        texts += [" ".join(a), " ".join(b)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    draws = sampled(df, ["k"], "text", bins, samples)
    pairs = draws.join(draws.select((F.col("k") - 1).alias("k"), F.col("draws").alias("other")), "k").where("k % 2 = 0")
    rows = pairs.select("k", likeness(F.col("draws"), F.col("other")).alias("near"), as_text(F.col("draws")).alias("t")).collect()
    assert len(rows) == 5
    for r in rows:
        assert abs(r["near"] - jaccard(texts[r["k"]], texts[r["k"] + 1])) < 0.1
        assert re.fullmatch("[0-9a-f]*", r["t"]) and len(r["t"]) % 6 == 0


def test_odd_rows(spark):
    schema = "doc_id long, text string, kind string"
    long = "é word " * 40_000
    docs = spark.createDataFrame([(5, "é b c d e f g h", "x"), (5, "é b c d e f g h", "x"), (7, None, "x"), (9, "", "x"),
                                  (11, long, None), (None, "zz yy", "x"), (3, " \n ", "x"), (11, "another text here", "x")], schema)
    got = edit_fingerprints(docs).collect()
    assert len(got) == 7
    by = {(r["doc_id"], r["n_chars"]): r for r in got}
    assert by[7, 0]["fingerprint"] == "" and by[7, 0]["near_next"] == 1.0 and by[9, 0]["near_edited"] == 1.0
    five = by[5, 15]
    assert five["edited_sha256"] == hashlib.sha256("é b c d e f ".encode()).hexdigest()
    none = by[None, 5]
    assert none["edited_sha256"] == hashlib.sha256(b"zz y ").hexdigest()
    assert (11, len(long)) in by and (11, 17) in by
    one = edit_fingerprints(docs.where("doc_id = 5")).first()
    assert one["near_next"] == 1.0 and edit_fingerprints(docs.limit(0)).count() == 0


def test_successors_over_many_ranges(spark, many_parts):
    rows = spark.range(0, 1000, 1, 13).select((F.col("id") * 7919 % 10007).alias("v"), F.col("id").alias("k"))
    got = {r["k"]: r["next_k"] for r in successors(rows, ["v"], ["k"]).collect()}
    order = [r["k"] for r in rows.orderBy("v").collect()]
    assert got == {k: order[(i + 1) % len(order)] for i, k in enumerate(order)}


def test_each_text_is_near_its_exact_similarity(spark):
    """Five standard errors at most for any text, short and repetitive ones included."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(tuple(r) for r in docs.collect())
    last = rows[-1][0]
    rows += [(last + 1 + k, t) for k, t in enumerate((
        "same " * 900 + " ".join(f"a{i}" for i in range(100)), "same " * 900 + " ".join(f"b{i}" for i in range(100)),
        "x", "x y", "one two three", "ha " * 4000))]
    want, text = edited(rows), dict(rows)
    after = {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}
    got = edit_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        for column, other in (("near_edited", want), ("near_next", after)):
            exact = jaccard(text[r["doc_id"]], other[r["doc_id"]])
            assert abs(r[column] - exact) <= 5 * max(exact * (1 - exact), 0.01) ** 0.5 / 8, (r["doc_id"], column)


@pytest.mark.parametrize("within", [0.05, 1.0, 12.0])
def test_giving_up_on_far_terms_changes_no_draw(spark, monkeypatch, within):
    """However many draws are missing at first, the result is that of drawing from all terms."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(40)], [1 / (k + 1) for k in range(40)], k=rng.randint(0, 120))) for _ in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "a b"), (90, None), (91, "one")], "doc_id long, text string")
    monkeypatch.setattr(fingerprints, "_WITHIN", within)
    got = sorted(map(tuple, fingerprints.edit_fingerprints(docs).collect()), key=str)
    monkeypatch.setattr(fingerprints, "_WITHIN", None)
    assert got == sorted(map(tuple, fingerprints.edit_fingerprints(docs).collect()), key=str)
    plain = {r["n"]: r["draws"] for r in fingerprints.sampled(
        docs.where("doc_id >= 0").select(F.col("doc_id").alias("n"), "text"), ["n"], "text").collect()}
    text = {r[0]: r[3] for r in got}
    assert all(text[n] == "".join(f"{d:06x}" for d in draws) and len(draws) == 64 for n, draws in plain.items())
