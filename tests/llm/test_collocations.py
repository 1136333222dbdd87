import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from llm_fixtures import frame  # noqa: F401
from torque.llm import collocations as C
from torque.llm.queries import QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, top=2000, longest=3, least=10, scale=1_000_000, percent=50):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(scale * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang, p] = (a, f[lang, p[:k]], f[lang, p[k:]], score)
    gone = {(lang, p[i:i + k]) for (lang, p), v in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * v[0] >= percent * found[lang, p[i:i + k]][0]}
    out = []
    for lang in n:
        rows = sorted((-v[3], -v[0], " ".join(p).encode(), v) for (x, p), v in found.items() if x == lang and (x, p) not in gone)
        out += [(lang, i, p.decode(), *v[:3], n[lang], v[3]) for i, (_, _, p, v) in enumerate(rows[:top], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def some(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "a", "é", "É", "x1", "zz", "of", "#"]
    out = []
    for _ in range(n):
        text = "".join(rng.choices(words, [9, 2, 5, 3, 1, 1, 1, 4, 1])[0] + rng.choices([" ", "\t ", ". ", ",", "\n"], [12, 1, 1, 1, 1])[0]
                       for _ in range(rng.randint(0, 40)))
        out.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return out


EDGES = [("en", None), ("en", ""), (None, "  . ,\n"), ("fr", "a b c d " * 30), ("fr", "a b c d " * 30), ("de", "A b c a b c\x0ba b c"),
         ("xx", "w " * 5_000), ("en", "b" * 200_000 + " c")]


def docs_frame(spark, docs, extra=""):
    rows = [(t, None if i % 5 else i, lang, *[None] * extra.count(",")) for i, (lang, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "text string, doc_id bigint, lang string" + extra).repartition(4)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    want = brute(docs)
    assert len(want) > 100
    assert got(QUERIES["op12_phrase_collocation_mining"](spark, sf)) == want


@pytest.mark.parametrize("budget, longest", [(10**6, 3), (300, 3), (40, 4), (25, 2)])
def test_groups_of_any_budget_give_the_same_counts(spark, budget, longest):
    docs = some(budget, 150) + EDGES
    df = docs_frame(spark, docs, ", phrase string, n int, grp string, prefix string")
    assert got(C.collocations(df, budget=budget, longest=longest)) == brute(docs, longest=longest)


def test_other_thresholds_ties_and_empty_tables(spark):
    docs = some(7, 80)
    df = docs_frame(spark, docs)
    assert got(C.collocations(df, top=5, least=2, percent=80, budget=100)) == brute(docs, top=5, least=2, percent=80)
    assert got(C.collocations(df.limit(0))) == []
    assert got(C.collocations(docs_frame(spark, [("en", None), (None, "")]))) == []


def test_many_rows_are_thinned_before_they_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(C, "RANKED", 20)
    docs = some(8, 200)
    df = docs_frame(spark, docs)
    assert got(C.collocations(df, top=4, least=2)) == brute(docs, top=4, least=2)


def test_hot_words_and_prefixes_are_parted(spark, monkeypatch):
    """A word with a third of all suffixes, and a pair with most of that word's, leave no group over its budget."""
    seen = {}
    runs = C._runs

    def watched(groups, longest, heavy):
        seen["heavy"] = heavy
        return runs(groups, longest, heavy)

    monkeypatch.setattr(C, "_runs", watched)
    docs = [("en", f"the cat {i % 7}w the {i}b {i}c {i}d") for i in range(400)]
    assert got(C.collocations(docs_frame(spark, docs), budget=350)) == brute(docs)
    assert seen["heavy"] == {("en", "the"), ("en", "the cat"), ("en", "cat")}


def test_scores_past_64_bits(spark):
    unigrams = spark.createDataFrame([("en", "p", 4_000_000_000_000), ("en", "q", 5_000_000_000_000)], "lang string, prefix string, n bigint")
    phrases = spark.createDataFrame([("en", "p q", 2, 3_999_999_999_999)], "lang string, phrase string, n_words bigint, f bigint")
    row = C.scored(unigrams, phrases).first()
    assert row.score == 1_000_000 * 3_999_999_999_999**2 // (4_000_000_000_000 * 5_000_000_000_000)


def test_subtree_adds_leaves_up():
    lines = pa.array(["a b c", "a b", "a b d", "a", "b c d", "a b c"])
    import numpy as np
    words, depth, total = C.subtree(lines, np.array([3, 2, 4, 9, 1, 5]), 3, 4)
    nodes = {" ".join(x for x in w if x): (d, t) for *w, d, t in zip(*[x.to_pylist() for x in words], depth, total, strict=True)}
    assert nodes == {"a b": (2, 14), "a b c": (3, 8), "a b d": (3, 4)}
