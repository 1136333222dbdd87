from collections import Counter

import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_line_dedup import is_near
from test_simhash import brute as components

import corpus_pipeline
from torque.llm import pieces, toxicity
from torque.llm.common import read_table, stage

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def without_repeated_lines(texts):
    """Brute force by the rule of the docstring: a plain edit distance over all pairs of lines of like length."""
    place = {}
    for i, t in sorted(texts.items()):
        for k, x in enumerate(t.split("\n")):
            if x := x.strip(" \t\n\x0b\f\r"):
                place.setdefault(x, (i, k))
    lines = sorted(place, key=len)
    letters = {x: Counter(x) for x in lines}
    beaten = set()
    for a, x in enumerate(lines):
        for y in lines[a + 1:]:
            if len(y) - len(x) > min(2, len(x) // 5):
                break
            # More letters of one line alone than two edits bring in: not near.
            if (letters[y] - letters[x]).total() <= 2 and is_near(x, y):
                beaten.add(max(x, y, key=place.get))
    out = {}
    for i, t in texts.items():
        parts = t.split("\n")
        marks = [x.strip(" \t\n\x0b\f\r") for x in parts]
        out[i] = "\n".join(x for k, (x, m) in enumerate(zip(parts, marks, strict=True))
                           if not m or (place[m] == (i, k) and m not in beaten))
    return out


def test_stages_match_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    items = [(b["item_id"], b["text"]) for b in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    for name, fn in corpus_pipeline.STAGES:
        before = rows(docs)
        after = stage(fn(spark, docs, SF), "test-stage")
        if name == "sentencepiece":
            got = {r["doc_id"]: (list(r["ids"]), r["round_trip"]) for r in after.collect()}
            assert got == {i: (list(library.encode(t)), True) for i, t in before.items()}
            break
        assert after.columns == docs.columns
        if name == "toxicity":
            scored = toxicity.toxicity(docs, read_table(spark, SF, "labels")).collect()
            want = {r.doc_id: before[r.doc_id] for r in scored if not r.predicted}
        elif name == "line_dedup":
            want = without_repeated_lines(before)
        elif name == "simhash_near_dedup":
            want = {i: before[i] for i, (_, c) in components(list(before.items())).items() if i == c}
        else:
            want = {r[0]: before[r[0]] for r in contaminated(list(before.items()), items) if not r[-1]}
            assert 0 < len(want) < len(before)
        assert rows(after) == want
        docs = after


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        read_table(spark, SF, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def odd_rows():
    """Null texts and ids, empty and very long texts, repeated rows, copies without an id."""
    toxic = [r["doc_id"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["toxic"]]
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    item = next(b["text"] for b in pq.read_table(f"{SF}/benchmark.parquet").to_pylist() if len((b["text"] or "").split()) > 12)
    plain = " ".join(f"word{i} of a quiet line" for i in range(30))
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in docs if d["doc_id"] in set(toxic) or d["doc_id"] % 4 == 0]
    rows += [(10_001, None, "en", "s", None), (10_002, "", "en", "s", 0), (10_003, plain, None, None, None), (10_003, plain, None, None, None),
             (None, plain + " end", "en", "s", 1), (None, plain + " end", "en", "s", 1), (None, None, None, None, None),
             (None, f"before {item} after", "en", "s", 1), (10_004, f"clean\n{item}", "en", "s", 1),
             (10_005, " ".join(f"x{i * 7919 % 100_003}" for i in range(60_000)), "en", "s", 1)]
    return rows


def test_odd_rows_through_every_stage(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hit int, number int, key string, ids string"
    docs = spark.createDataFrame([(*r, "r", 1, 2, "k", "i") for r in odd_rows()], schema).repartition(3)
    sizes = [docs.count()]
    for name, fn in corpus_pipeline.STAGES:
        out = stage(fn(spark, docs, SF), "odd")
        if name == "sentencepiece":
            assert out.count() == docs.count() and out.filter("not round_trip").count() == 0
            break
        assert out.columns == docs.columns
        texts = out.select("doc_id", "text").collect()
        by = Counter((r.doc_id, (r.text or "")[:40]) for r in texts)
        if name == "toxicity":
            assert by[10_003, odd_rows()[-8][1][:40]] == 2          # clean rows stay, repeated ones too
        if name == "simhash_near_dedup":
            assert by[10_003, odd_rows()[-8][1][:40]] <= 1           # one row of a group, whatever its ids
            assert max(by.values()) == 1
        if name == "benchmark_decontamination":
            assert not any(t.text and t.text.startswith("before ") for t in texts)     # no id, still hit
            assert any(r.doc_id == 10_005 for r in texts)
        docs = out
        sizes.append(out.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 10


def test_text_ids_through_the_stages(spark):
    docs = read_table(spark, SF, "documents").filter("doc_id % 3 = 0").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    for name, fn in corpus_pipeline.STAGES[1:]:
        docs = stage(fn(spark, docs, SF), "text-ids")
    assert docs.count() > 0 and docs.filter("not round_trip").count() == 0
