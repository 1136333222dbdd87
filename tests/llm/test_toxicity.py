import zlib

import pyarrow.parquet as pq

from llm_fixtures import frame  # noqa: F401
from torque.llm import toxicity as T
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p and y for p, y in seen)
    assert hit >= 0.6 * sum(y for _, y in seen) and hit >= 0.85 * sum(p for p, _ in seen)


def test_misspellings_share_subwords():
    clean = [f"the cat{i} sat on a mat{i} by the door".encode() for i in range(60)]
    toxic = [t + b" you stupid moron" for t in clean[:30]]
    weight, bias = T.fit(clean + toxic, __import__("numpy").array([0] * 60 + [1] * 30))

    def logit(text):
        bucket, _ = T.subwords(T.tokens(text))
        return weight[bucket].mean() + bias

    assert logit(b"the dog sat stupidd") > logit(b"the dog sat quietly") + 1


def test_edge_cases(frame, spark):
    rows = [(i, f"plain text number {i}") for i in range(40)] + [(100 + i, f"vile rotten words {i}") for i in range(40)]
    rows += [(900, None), (901, ""), (902, "!!! ..."), (903, "vile " * 30_000), (903, "vile " * 30_000), (None, "plain")]
    df = frame(rows, ", score string, predicted string")
    schema = "doc_id bigint, quality int, toxic int"
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 1, 1) for i in range(40)]
                                   + [(100, 1, 0), (5, 1, None), (None, 1, 1)], schema)
    out = T.toxicity(df, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert by[900].score == by[901].score == by[902].score and by[903].score > by[1].score
    assert not by[None].held_out
    kept = T.drop_toxic(df, labels)
    assert kept.columns == df.columns and {900, 901, 902, 1} <= {r.doc_id for r in kept.collect()}
    none = T.toxicity(df, labels.limit(0)).collect()
    assert all(r.score == 0.0 and r.predicted == 0 for r in none)
    assert T.toxicity(spark.createDataFrame([], df.schema), labels).count() == 0
