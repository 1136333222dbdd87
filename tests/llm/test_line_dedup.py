import hashlib
import random
from collections import Counter

import pyarrow.parquet as pq

from llm_fixtures import frame  # noqa: F401
from torque.llm import line_dedup as L
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LETTERS = "abcé"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def is_near(a, b, distance=2):
    """The documented rule: so many edits, and one for every five characters of the shorter line."""
    return edits(a, b) <= min(distance, min(len(a), len(b)) // 5)


def changed(rng, text, n):
    t = list(text)
    for _ in range(n):
        k = rng.randrange(len(t) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            t.insert(k, rng.choice(LETTERS))
        elif t and kind == 1:
            t.pop(min(k, len(t) - 1))
        elif t:
            t[min(k, len(t) - 1)] = rng.choice(LETTERS)
    return "".join(t)


def test_banded_distance():
    rng = random.Random(4)
    for distance in (1, 2, 3):
        left, right = [], []
        for _ in range(1500):
            a = "".join(rng.choice(LETTERS) for _ in range(rng.randint(distance, 40)))
            left.append(a)
            right.append(changed(rng, a, rng.randint(0, 5)))
        got = L.near(left, right, distance)
        # Lines too short to be near may still be equal; the operator never compares those.
        want = [is_near(a, b, distance) and min(len(a), len(b)) >= 5 for a, b in zip(left, right, strict=True)]
        assert got.tolist() == want and any(want) and not all(want)


def test_segment_keys_find_every_near_pair():
    rng = random.Random(8)
    for distance in (1, 2, 3):
        for _ in range(400):
            a = "".join(rng.choice(LETTERS) for _ in range(rng.randint(2 * distance + 2, 30)))
            b = changed(rng, a, rng.randint(0, distance))
            short, long = sorted((a, b), key=len)
            index = set(L.segment_keys(*L.coded([short.encode()]), distance, False)[1].tolist())
            assert index & set(L.segment_keys(*L.coded([long.encode()]), distance, True)[1].tolist())


def test_sketches_never_part_near_lines():
    rng = random.Random(12)
    for distance in (1, 2, 3):
        a = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(8, 40))) for _ in range(300)]
        b = [changed(rng, x, distance) for x in a]
        left, right = (L.sketches(*L.coded([x.encode() for x in side])).tolist() for side in (a, b))
        for x, y in zip(left, right, strict=True):
            differ = (x ^ y) & (2**64 - 1)
            assert (differ & (2**32 - 1)).bit_count() <= 2 * distance and (differ >> 32).bit_count() <= 4 * distance


def brute(docs, distance, min_chars):
    places = {}
    for i, text in docs:
        if text is not None:
            for k, x in L.lines_of(text.encode(), min_chars):
                p = (i is None, i or 0, k)
                x = x.decode()
                places[x] = min(p, places.get(x, p))
    lines = sorted(places, key=len)
    letters = {x: Counter(x) for x in lines}
    beaten = set()
    for a, x in enumerate(lines):
        for y in lines[a + 1:]:
            if len(y) - len(x) > min(distance, len(x) // 5):
                break
            # More letters of one line alone than so many edits bring in: not near.
            if (letters[y] - letters[x]).total() <= distance and is_near(x, y, distance):
                beaten.add(x if places[y] < places[x] else y)
    out = []
    for i, text in docs:
        parts = [] if text is None else text.split("\n")
        marks = {k: x.decode() for k, x in L.lines_of((text or "").encode(), min_chars)}
        exact = {k for k, x in marks.items() if places[x] < (i is None, i or 0, k)}
        near = {k for k, x in marks.items() if k not in exact and x in beaten}
        kept = "\n".join(x for k, x in enumerate(parts) if k not in exact | near)
        out.append((i, len(parts), len(exact | near), len(near), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_random_lines(frame, spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(6, 30))) for _ in range(25)]
    docs = [(i, "\n".join(changed(rng, rng.choice(pool), rng.randint(0, 4)) + rng.choice(["", " "]) for _ in range(rng.randint(0, 6))))
            for i in range(60)]
    docs += [(70, docs[3][1]), (70, docs[3][1]), (71, None), (72, ""), (73, "\n\n" + pool[0] * 900), (None, docs[5][1])]
    df = frame(docs, ", key string, row int, gone int, number int")
    assert got(L.line_dedup(df, 2, 8)) == brute(docs, 2, 8)
    out = L.dedup_lines(df, 2, 8)
    assert out.columns == df.columns and out.count() == len(docs)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[71] is None and texts[72] == ""
    assert got(L.line_dedup(spark.createDataFrame([], df.schema))) == []


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute(docs, L.DISTANCE, L.MIN_CHARS)
    assert any(r[2] for r in want) and got(QUERIES["op8_line_dedup"](spark, SF)) == want


def test_text_ids_and_repeated_rows(spark):
    docs = [("b", "one line here\nb"), ("a", "one lime here\nb"), ("c", "one line here"), ("c", "one line here"), (None, "b\nzz"),
            ("10", "zz"), ("9", "zz")]
    rows = L.line_dedup(spark.createDataFrame(docs, "doc_id string, text string")).collect()
    assert sorted(((r.doc_id, r.n_removed, r.n_near) for r in rows), key=repr) == sorted(
        [("b", 2, 1), ("a", 0, 0), ("c", 1, 0), ("c", 1, 0), (None, 2, 0), ("10", 0, 0), ("9", 1, 0)], key=repr)


def test_many_unlike_short_lines_stay(frame):
    lines = [f"{a}{b}{c}." for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    docs = [(i, "\n".join(lines[i::7])) for i in range(7)] + [(9, lines[3])]
    rows = {r.doc_id: (r.n_removed, r.n_near) for r in L.line_dedup(frame(docs)).collect()}
    assert rows == {**dict.fromkeys(range(7), (0, 0)), 9: (1, 0)}


def test_short_lines_take_part(frame):
    """Lines of 1 to 19 characters: equal ones go at any length, near ones from five characters."""
    docs = [(1, "}\nab\nabc\nshort line\n \t\n"), (2, "}\nac\nabd\nshort lime\n\n"), (3, "ab\n}\nqrs\n é \n  short line"),
            (4, "é\nxyz"), (None, "qrs\nab")]
    rows = {r["doc_id"]: r for r in L.line_dedup(frame(docs)).collect()}
    assert {i: (r["n_lines"], r["n_removed"], r["n_near"]) for i, r in rows.items()} == {
        1: (6, 0, 0), 2: (6, 2, 1), 3: (5, 3, 0), 4: (2, 1, 0), None: (2, 2, 0)}
    texts = {r["doc_id"]: r["text"] for r in L.dedup_lines(frame(docs)).collect()}
    assert texts == {1: docs[0][1], 2: "ac\nabd\n\n", 3: "qrs\n é ", 4: "xyz", None: ""}
