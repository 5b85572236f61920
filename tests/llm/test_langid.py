import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from starflow.llm import langid as L
from starflow.llm import pu
from starflow.llm import text as T

ROWS = [r for r in pq.read_table("/root/testdata/sf0.1/documents.parquet").select(["doc_id", "lang", "text"]).to_pylist()
        if r["text"] and r["lang"]]
HELD = [r for r in ROWS if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
LEARNT = [r for r in ROWS if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
STRANGE = ["xqzjk vvwpq zzkx qwpl kjhx mnbv", "qqq zzz xxx wwq", "これは日本語の文章です。今日は天気がいいですね。",
           "Tämä on suomenkielinen lause ja siinä on monta sanaa joita kukaan ei ymmärrä",
           "To jest zdanie w języku polskim i ma wiele słów których nikt nie rozumie", "Это предложение на русском языке"]


def sparse(texts):
    return pu.Sparse(*L.features(*T.utf8(pa.array(texts, pa.large_string()))))


def learnt(languages, each=800):
    rows = [r for lang in languages for r in [x for x in LEARNT if x["lang"] == lang][:each]]
    return L.train(sparse([r["text"] for r in rows]), np.array([languages.index(r["lang"]) for r in rows]), languages)


def strange(model, texts):
    return L._predictions(model, pa.array(texts, pa.string()))[2]


@pytest.fixture(scope="module")
def model():
    return learnt(["de", "en", "es", "fr"])


def test_known_texts_pass_and_others_do_not(model):
    names, p, rejected = L._predictions(model, pa.array([r["text"] for r in HELD], pa.string()))
    assert rejected.mean() <= 0.005
    assert np.mean([a == r["lang"] for a, r in zip(names, HELD)]) >= 0.99 and (p >= 0).all() and (p <= 1).all()
    assert strange(model, STRANGE).all()


def test_mixtures_and_short_texts_pass(model):
    r = random.Random(1)
    mixed = [" ".join(" ".join(r.choice(HELD)["text"].split()[:60]) for _ in range(2)) for _ in range(300)]
    assert strange(model, mixed).mean() <= 0.01
    short = [" ".join(r.choice(HELD)["text"].split()[:5]) for _ in range(300)]
    assert strange(model, short).mean() <= 0.02


@pytest.mark.parametrize("left", ["de", "en", "es", "fr"])
def test_a_language_that_was_not_learnt_is_rejected(left):
    languages = [x for x in ["de", "en", "es", "fr"] if x != left]
    model = learnt(languages, 600)
    long = [r["text"] for r in HELD if len(r["text"]) >= 40]
    assert strange(model, [t for t, r in zip(long, [r for r in HELD if len(r["text"]) >= 40]) if r["lang"] == left]).mean() >= 0.9
    assert strange(model, [r["text"] for r in HELD if r["lang"] != left]).mean() <= 0.01


def test_one_language_rejects_others_too():
    model = learnt(["en"])
    assert strange(model, STRANGE).all()
    assert strange(model, [r["text"] for r in HELD if r["lang"] == "en"]).mean() <= 0.01


def test_frequencies_are_of_the_texts():
    rows = pu.Sparse(np.array([2, 1]), np.array([3, 5, 5]), np.array([0.25, 0.75, 1.0]))
    f = L.frequencies(rows)
    total = 2 + 0.5 ** 11 * (1 << L.BITS)
    assert np.isclose(np.exp(f[5]), (1.75 + 0.5 ** 11) / total) and np.isclose(np.exp(f).sum(), 1)
    got = L.familiarity(rows, f, 2.0)
    assert np.allclose(got, [0.25 * f[3] + 0.75 * f[5] + 2 * 0.5, f[5] + 2.0])


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog of the house", "en", 1), (2, None, "en", 1), (3, "", "en", 1), (4, "123 !!", None, 1),
            (None, "le chat et le chien de la maison", "fr", 1), (1, "le chat et le chien de la maison", "fr", 1),
            (5, "word " * 60_000, "en", 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = L.learn_languages(df)
    assert model.languages == ["en", "fr"]
    got = L.identify_languages(df, model)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score", "rejected"] and got.count() == len(rows)
    by = {(r["doc_id"], r["lang"]): r for r in got.collect()}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 and by[k]["rejected"] for k in [(2, "en"), (3, "en"), (4, None)])
    assert L.keep_identified(df, model).columns == df.columns
    none = L.learn_languages(df.limit(0))
    assert {r["lang_pred"] for r in L.identify_languages(df, none).collect()} == {"und"}
    assert L.identify_languages(df.limit(0), model).collect() == [] and L.keep_identified(df, none).count() == 0


def test_languages_beyond_the_most_frequent_are_learnt_as_one(spark):
    rows = [(i, r["text"], r["lang"]) for i, r in enumerate(LEARNT[:600])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.learn_languages(df, max_languages=2)
    assert len(model.languages) == 3 and "und" in model.languages
    names = L._predictions(model, pa.array([r["text"] for r in HELD], pa.string()))[0]
    want = [r["lang"] if r["lang"] in model.languages else "und" for r in HELD]
    assert np.mean([a == b for a, b in zip(names, want)]) >= 0.98


def test_the_softmax_learns_from_its_gradient():
    """Training lowers the loss on the rows it has seen, and the temperature is the best of its grid on those kept back."""
    rows = sparse(["aa ab aa", "bb ba bb"] * 30)
    labels = np.array([0, 1] * 30)
    model = L.train(rows, labels, ["x", "y"], epochs=30)
    best, p, _ = model.predict(*T.utf8(pa.array(["aa aa", "bb bb"], pa.large_string())))
    assert best.tolist() == [0, 1] and (p > 0.6).all()
