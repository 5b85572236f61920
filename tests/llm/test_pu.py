import numpy as np
import pytest

from starflow.llm import features, pu
from starflow.llm.quality import learn_quality, score_quality
from starflow.llm.toxicity import held_out_scores, learn_toxicity, score_toxicity

WIDTH = 12


def sparse(matrix):
    rows, columns = np.nonzero(matrix)
    return pu.Sparse(np.bincount(rows, minlength=len(matrix)), columns, matrix[rows, columns])


def data(seed, n, m):
    r = np.random.default_rng(seed)
    return tuple(np.where(r.random((k, WIDTH)) < 0.5, r.normal(size=(k, WIDTH)), 0) for k in (n, m))


def plain_risk(pos, unl, w, prior):
    """The estimator written out row by row."""
    def loss(z):
        return np.log(1 + np.exp(-z))

    positive = prior * sum(loss(x @ w) for x in pos) / len(pos)
    negative = sum(loss(-(x @ w)) for x in unl) / len(unl) - prior * sum(loss(-(x @ w)) for x in pos) / len(pos)
    return positive, negative


@pytest.mark.parametrize("seed", range(4))
def test_risk_and_gradient(seed):
    a, b = data(seed, 9, 17)
    w, prior = np.random.default_rng(seed + 9).normal(size=WIDTH), 0.3
    positive, negative, gradient = pu.risk_and_gradient(sparse(a), sparse(b), w, prior, non_negative=False)
    assert np.allclose((positive, negative), plain_risk(a, b, w, prior))
    step = 1e-6
    slopes = [(sum(plain_risk(a, b, w + step * e, prior)) - sum(plain_risk(a, b, w - step * e, prior))) / (2 * step)
              for e in np.eye(WIDTH)]
    assert np.allclose(gradient, slopes, atol=1e-6)


def test_a_negative_part_below_zero_is_climbed():
    a, b = data(1, 9, 17)
    w = 4 * a.sum(axis=0)
    positive, negative, gradient = pu.risk_and_gradient(sparse(a), sparse(-np.abs(b) @ np.diag(np.sign(w))), w, 0.9)
    assert negative < 0
    step, unl = 1e-6, -np.abs(b) @ np.diag(np.sign(w))
    slopes = [(plain_risk(a, unl, w + step * e, 0.9)[1] - plain_risk(a, unl, w - step * e, 0.9)[1]) / (2 * step) for e in np.eye(WIDTH)]
    assert np.allclose(gradient, -np.array(slopes), atol=1e-5)


@pytest.mark.parametrize("prior", [0.05, 0.2, 0.5, 0.8])
def test_the_prior_of_known_mixtures(prior):
    r = np.random.default_rng(3)
    pos = r.normal(2, 1, 4000)
    unl = np.where(r.random(8000) < prior, r.normal(2, 1, 8000), r.normal(-2, 1, 8000))
    assert abs(pu.estimate_prior(pos, unl) - prior) < 0.06


def test_the_prior_stays_in_its_bounds():
    assert pu.estimate_prior(np.ones(50), np.zeros(50)) == pu.LEAST_PRIOR
    assert pu.estimate_prior(np.zeros(50), np.zeros(50)) == 0.99


def test_telling_columns():
    r = np.random.default_rng(4)
    a, b = (r.random((300, WIDTH)) < 0.3).astype(float), (r.random((500, WIDTH)) < 0.3).astype(float)
    a[:, 2], b[:, 5], a[:, 7], b[:, 7] = 1, 1, 0, 0
    got = pu.telling(sparse(a), sparse(b), WIDTH, 11, 4)
    z = []
    for k in range(WIDTH):
        x, y = (a[:, k] != 0).sum(), (b[:, k] != 0).sum()
        p = (x + y) / 800
        z.append(0 if x + y < 5 else abs(x / 300 - y / 500) / np.sqrt(max(1e-12, p * (1 - p)) * (1 / 300 + 1 / 500)))
    want = {k for k in sorted(range(WIDTH), key=lambda k: -z[k])[:4] if z[k] >= 3} | {11}
    assert set(np.flatnonzero(got)) == want and {2, 5} <= want


def test_training_separates_and_keeps_the_prior():
    r = np.random.default_rng(5)
    centre = r.normal(size=WIDTH)
    good, bad = r.normal(size=(900, WIDTH)) + centre, r.normal(size=(900, WIDTH)) - centre
    unl = np.concatenate([good[300:600], bad])
    model = pu.fit(sparse(good[:300]), sparse(unl), WIDTH, 0, prior=0.25)
    scores = model.score(sparse(np.concatenate([good[600:], bad[:300]])))
    assert (scores[:300] > 0.5).mean() > 0.95 and (scores[300:] < 0.5).mean() > 0.95


def test_sparse_rows():
    a, _ = data(6, 7, 1)
    a[3] = 0
    rows = sparse(a)
    assert np.allclose(rows.dot(np.arange(WIDTH)), a @ np.arange(WIDTH))
    assert np.allclose(rows.back(np.arange(7.0), WIDTH), np.arange(7.0) @ a)
    assert np.allclose(rows.take(np.array([5, 3, 5])).dot(np.ones(WIDTH)), a[[5, 3, 5]] @ np.ones(WIDTH))
    kept = np.arange(WIDTH) % 2 == 0
    assert np.allclose(rows.only(kept).dot(np.ones(WIDTH)), a[:, kept].sum(axis=1))


SCHEMA = "doc_id long, text string, score string, held_out int, h long, label string"
ROWS = [(i, t, "x", 1, 2, "y") for i, t in enumerate(
    ["awful vile trash", "kind words here", None, "", "word " * 60_000, "same", "same", "\x00 é 日本"] * 6)] + [(None, "no id", "x", 1, 2, "y")]


@pytest.mark.parametrize("learn, score, width", [(learn_toxicity, score_toxicity, features.WORDS_WIDTH), (learn_quality, score_quality, features.SHAPE_WIDTH)])
def test_odd_rows(spark, learn, score, width):
    df = spark.createDataFrame(ROWS, SCHEMA)
    some = spark.createDataFrame([(0,), (8,), (None,), (999,)], "doc_id long")
    model = learn(df, some)
    scored = score(df, model)
    assert scored.columns == ["doc_id", "held_out", "h", "label", "score"] and scored.count() == len(ROWS)
    values = [r["score"] for r in scored.collect()]
    assert all(0 <= v <= 1 for v in values)
    by = {}
    for r in scored.collect():
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert by[5] == by[6] and by[2] == by[3]
    assert score(df.limit(0), model).collect() == []
    for empty in (learn(df, some.limit(0)), learn(df.limit(0), some)):
        assert {r["score"] for r in score(df, empty).collect()} == {pu.LEAST_PRIOR}


def test_without_positives_nothing_is_flagged(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([(0, 0), (None, 1)], "doc_id long, toxic int")
    got = held_out_scores(df, labels, "toxic", learn_toxicity, score_toxicity, 0.5)
    assert got.count() == len(ROWS) and {r["predicted"] for r in got.collect()} == {0}
