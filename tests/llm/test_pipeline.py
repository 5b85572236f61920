import re

import duckdb
import pytest
from test_jaccard import brute

import corpus_pipeline
from starflow.llm.langid import identify_languages, learn_languages
from starflow.llm.packing import WordTokenizer
from starflow.llm.queries import ORACLE
from starflow.llm.secret_scan import KINDS, find, scan_secrets
from starflow.llm.text import utf8

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows each stage keeps, from the first table to the last result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, apply in corpus_pipeline.STAGES:
        out.append(docs)
        docs = apply(spark, docs, SF)
    return [*out, docs]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_each_stage_equals_brute_force(spark, stages):
    start, named, unique, clean, redacted, packed = map(by_id, stages)
    assert all(df.columns == COLUMNS for df in stages[:-1])
    rejected = {r["doc_id"] for r in identify_languages(stages[0], learn_languages(stages[0])).collect() if r["rejected"]}
    assert set(named) == set(start) - rejected
    assert set(unique) == {i for i, _, c in brute([(i, r["text"]) for i, r in named.items()]) if i == c}

    con = duckdb.connect()
    con.execute(f"create view benchmark as select * from '{SF}/benchmark.parquet'")
    table = stages[2].toPandas()
    con.register("documents", table)
    assert set(clean) == set(unique) - {r[0] for r in con.execute(ORACLE["op1_decontamination"]).fetchall()}

    assert set(redacted) == set(clean)
    for i, r in clean.items():
        spans = find(r["text"])
        assert (redacted[i]["text"] == r["text"]) == (not spans)
        assert redacted[i]["n_chars"] == (len(redacted[i]["text"]) if spans else r["n_chars"])
        assert not re.search("AKIA[A-Z0-9]{12}|[0-9a-f]{32}", redacted[i]["text"])
    assert sum(bool(find(r["text"])) for r in clean.values()) > 5

    import pyarrow as pa
    import public_tokenizers

    ids = list(redacted)
    _, sizes = WordTokenizer(public_tokenizers.path("word_bpe_49k.json")).encode(
        *utf8(pa.array([redacted[i]["text"] for i in ids])))
    total = {}
    for r in stages[-1].collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: n + 1 for i, n in zip(ids, sizes.tolist())}
    assert set(KINDS[:3]) == {"assign", "access", "hex"} and scan_secrets(stages[3]).count() == len(clean)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.columns == stages[-1].columns
    assert sorted(got.select(key).collect()) == sorted(stages[-1].select(key).collect())


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, rep string"
    text = "some words that make up a text here"
    docs = spark.createDataFrame([(1, text, "en", "s", 1, "x"), (1, text, "en", "s", 1, "x"), (2, None, None, None, None, None),
                                  (3, "123 456", "en", "s", 7, "x"), (None, text, None, "s", 0, "x"), (4, "", "de", "s", 0, "x")], schema)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "rep"], name
    assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1]
    empty = spark.createDataFrame([], schema)
    for _, apply in corpus_pipeline.STAGES:
        empty = apply(spark, empty, SF)
        assert empty.count() == 0
