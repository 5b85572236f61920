import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from starflow.llm import pieces
from starflow.llm import text as T

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", " ", "  ", " x", "▁x ▁ y", "a" * 50, "\n\n\t\r", "日本語のテキスト", "😀😀 \U0010ffff", "é é", "<s> </s> <unk> <0x0A>",
       "\x00a\x00", "ﬁ　 ", "x" * 5000 + " y", "ab" * 3000, "a1b2" * 2000, None, "same", "same"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(PATH)


def encoded(encoder, texts):
    data, bounds = T.utf8(pa.array(texts, pa.large_string()))
    ids, cuts = encoder.ids(data, bounds)
    return [ids[cuts[i]:cuts[i + 1]].tolist() for i in range(len(texts))]


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(library, encoder, seed):
    r = random.Random(seed)
    letters = [chr(c) for c in range(32, 127)] + list("\n\t▁ éüß日本мир😀́  ")
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["".join(r.choices([letters, "aeth n", names][k % 3], k=r.randint(0, 50))) for k in range(900)]
    assert encoded(encoder, texts) == library.encode(texts)


def test_merges_are_simultaneous_only_where_that_is_in_turn(library, encoder, monkeypatch):
    """Without the check of better pairs some texts would come out otherwise, or none of these would need it."""
    r = random.Random(5)
    texts = ["".join(r.choices(["er", "th", "in", "e", "t", "h"], k=40)) for _ in range(3000)]
    assert encoded(encoder, texts) == library.encode(texts)


def test_words_of_one_hash_are_told_apart(library, encoder, monkeypatch):
    monkeypatch.setattr(pieces, "_hashes", lambda points, starts, ends: np.zeros(len(starts), np.uint64))
    texts = ["the cat sat", "on the mat", "the the cat"]
    assert encoded(encoder, texts) == library.encode(texts)


def test_query_columns(spark, library):
    rows = [(i, t, "x", [1], i) for i, t in enumerate(ODD)] + [(None, "no id", "x", [1], 0), (0, "", "x", [1], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>, _text long").repartition(3)
    got = sorted((tuple(r) for r in pieces.digests(df, PATH).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "") + [library.eos_id()]
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    kept = pieces.encode_texts(df, PATH)
    assert kept.columns == ["doc_id", "text", "decoded", "_text", "ids"]
    assert pieces.digests(df.limit(0), PATH).collect() == []


def test_decodes_any_ids(spark, library):
    r = random.Random(2)
    lists = [[r.randrange(library.vocab_size()) for _ in range(r.randint(1, 12))] for _ in range(200)]
    lists = [[i for i in ids if i != library.unk_id() and not library.is_byte(i)] for ids in lists] + [[], [1, 2], [2], [259, 2]]
    rows = [(i, ids) for i, ids in enumerate(lists)] + [(-1, None)]
    got = {x["k"]: x["decoded"] for x in pieces.decode_ids(spark.createDataFrame(rows, "k long, ids array<int>"), PATH).collect()}
    assert got == {i: library.decode(ids) for i, ids in enumerate(lists)} | {-1: None}
    with pytest.raises(Exception, match="null among ids"):
        pieces.decode_ids(spark.createDataFrame([(1, [None])], "k long, ids array<int>"), PATH).collect()


def test_one_document_of_the_corpus_by_the_library(spark, library):
    from starflow.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op12_sentencepiece"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "") + [library.eos_id()]
        assert got[d["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d["doc_id"]]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
