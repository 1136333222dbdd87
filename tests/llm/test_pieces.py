import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from llm_fixtures import frame  # noqa: F401
from torque.llm import pieces, sentencepiece_codec, token_counts
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def strange_texts():
    rng = random.Random(5)
    letters = "ab ct  hene\nrstü▁é中<0x41>😀aaaa"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    vocab = [p.replace("▁", " ") for p in pieces.load(pieces.default_model()).id_of]
    out += ["".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    return out + [" " * k for k in range(40)] + ["a" * k for k in range(40)] + ["<s> </s>", "\x00a", "x" * 3000]


def test_words_equal_the_library(library):
    model, texts = pieces.load(pieces.default_model()), strange_texts()
    words = {w for t in texts for w in pieces.split(t)}
    ids, counts = model.encode_words(words), model.count_words(words)
    want = library.encode(texts)
    for text, ref in zip(texts, want, strict=True):
        parts = pieces.split(text)
        assert np.frombuffer(b"".join(ids[w] for w in parts), "<i4").tolist() == list(ref)
        assert sum(counts[w] for w in parts) == len(ref)


def test_prefix_counts_and_truncation(library):
    model = pieces.load(pieces.default_model())
    for text in ["Hello  wörld\n\nabc abcd 中", "", " ", "aaaaaaa bb", "▁x y"]:
        table = token_counts.PrefixCounts(model, text)
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert [table.at(i) for i in range(len(text) + 1)] == want
        for budget in range(6):
            assert table.longest_prefix(budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_queries_equal_the_library(spark, library):
    t = pq.read_table(f"{SF}/documents.parquet")
    texts = dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    want = {i: list(library.encode(x or "")) for i, x in texts.items()}
    got = {r["doc_id"]: r for r in QUERIES["op5_sentencepiece_codec"](spark, SF).collect()}
    assert {i: list(r["ids"]) for i, r in got.items()} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(want[i]) for i, r in got.items())
    counted = {r["doc_id"]: tuple(r) for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    assert counted == {i: (i, len((x or "").encode()), len(want[i]), len(want[i]) > 4096) for i, x in texts.items()}


def test_edge_cases(frame, spark, library):
    rows = [(1, None), (2, ""), (3, " "), (4, "a b"), (4, "a b"), (None, "x"), (5, "▁"), (6, "w " * 50_000)]
    df = frame(rows, ", ids string, n_tokens int")
    enc = sentencepiece_codec.encode(df)
    assert set(enc.columns) == set(df.columns) and enc.schema["ids"].dataType.simpleString() == "array<int>"
    checked = sentencepiece_codec.encode_checked(df).collect()
    assert len(checked) == len(rows) and all(r["round_trip"] for r in checked)
    assert {r["doc_id"]: r["n_tokens"] for r in checked}[1] == 0
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df).collect()}
    assert counts[6] == len(library.encode("w " * 50_000)) and counts[1] == counts[2] == 0
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncate(df, 3).collect()}
    assert cut[1] is None and cut[2] == "" and len(library.encode(cut[6])) <= 3
    odd = spark.createDataFrame([([1, 2],), (None,), ([3 + 0xFF],), ([None, 261],)], "ids array<int>")
    assert [r["decoded"] for r in sentencepiece_codec.decode(odd).collect()] == ["", None, "�", "t"]
    empty = spark.createDataFrame([], df.schema)
    assert sentencepiece_codec.encode_checked(empty).count() == token_counts.token_counts(empty).count() == 0
