import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import common
from ledgerlift.llm import periodic_runs as pr
from ledgerlift.llm.common import prepared
from ledgerlift.llm.queries import op12_periodic_runs, with_planted_periods

SMALL = "/root/testdata/sf0.001"


def brute(words, least=24, powers=3):
    """Every longest stretch of each period; a stretch counts for its smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // powers + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(least, powers * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if not any(q % p == 0 and p < q and s2 <= s and e <= e2 for (s2, e2), p in found.items()))


def dropped(n, found):
    return {i for s, length, q in found for i in range(s + q, s + length)}


def planted(words, doc_id):
    h = crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def texts(seed):
    picker = random.Random(seed)
    made = []
    for _ in range(60):
        words = [f"w{picker.randrange(picker.choice((1, 2, 3, 40)))}" for _ in range(picker.randrange(0, 150))]
        for _ in range(picker.randrange(3)):
            block = [f"w{picker.randrange(4)}" for _ in range(picker.randrange(1, 30))]
            cut = picker.randrange(len(words) + 1)
            repeated = (block * 12)[: picker.randrange(len(block), 12 * len(block) + 1)]
            words = words[:cut] + repeated + words[cut:]
        made.append(words)
    # Periods inside periods, and two runs that overlap.
    made += [(["a"] * 30 + ["b"]) * 4, (["a", "b"] * 20 + ["c"]) * 3 + ["a"] * 24, ["a", "b"] * 15 + ["a", "c"] * 15, ["x"] * 23, ["x"] * 24]
    return made


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("least,powers", [(24, 3), (1, 3), (10, 4)])
def test_runs_equal_brute_force(seed, least, powers):
    made = texts(seed)
    found = list(pr._found([" ".join(w).encode() for w in made], least, powers))
    for words, got in zip(made, found):
        want = brute(words, least, powers)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
        gone = dropped(len(words), want)
        assert got["n_words"] == len(words)
        assert got["collapsed"].decode() == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_many_small_pieces_equal_one(monkeypatch):
    made = [" \t".join(w).encode() for w in texts(9)]
    whole = list(pr._found(made, 24, 3))
    monkeypatch.setattr(common, "PIECE", 7)
    monkeypatch.setattr(pr, "WORDS_AT_ONCE", 100)
    assert [x for group in pr._together(made) for x in pr._found(group, 24, 3)] == whole


def test_a_long_text_of_one_word():
    got = next(pr._found([b"a " * 200_000], 24, 3))
    assert got["runs"] == [{"start": 0, "length": 200_000, "period": 1}] and got["collapsed"] == b"a"
    assert pr.runs(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)).shape == (0, 3)
    with pytest.raises(ValueError):
        pr.runs(np.zeros(3, np.int64), np.zeros(3, np.int64), np.full(3, 3), 1, 2)


def test_odd_rows(odd, nothing, odd_rows):
    got = sorted(map(str, pr.periodic_runs(odd).collect()))
    want = []
    for row in odd_rows:
        words = (row[1] or "").encode().split()
        assert not brute(words[:400])
        want.append((row[0], len(words), [], b" ".join(words).decode()))
    assert len(got) == len(want)
    assert sorted(map(str, (tuple(r) for r in pr.periodic_runs(odd).collect()))) == sorted(map(str, want))
    assert pr.periodic_runs(nothing).collect() == []


def test_query_equals_brute_force(spark):
    rows = {r["doc_id"]: r for r in op12_periodic_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows.values()) > 10
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for doc_id, text in docs:
        words = planted((text or "").encode().split(), doc_id)
        if len(words) > 3000:
            continue  # the plain version would take minutes
        found, row = brute(words), rows[doc_id]
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(found), *best)
        assert row["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        assert row["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode())
        gone = dropped(len(words), found)
        assert row["collapsed_sha256"] == sha(b" ".join(w for i, w in enumerate(words) if i not in gone))


def test_planted_periods(spark):
    picker = random.Random(5)
    rows = [(i, " \n".join(f"é{picker.randrange(90)}" for _ in range(picker.randrange(60)))) for i in range(300)] + [(None, "a b"), (7, None), (-3, "x  y z ")]
    frame = prepared(spark).createDataFrame(rows, "doc_id long, text string")
    got = frame.select("doc_id", "text", with_planted_periods(F.col("doc_id"), F.col("text")).alias("made")).collect()
    for doc_id, text, made in got:
        words = (text or "").encode().split()
        assert (made or "").encode().split() == (words if doc_id is None else planted(words, doc_id))
