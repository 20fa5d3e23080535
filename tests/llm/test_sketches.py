import hashlib
import math

from pyspark.sql import functions as F

from ledgerlift.llm import sketches
from ledgerlift.llm.common import prepared
from tests.llm.conftest import words


def shingles(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_pairs_equal_brute_force(spark, nothing):
    texts = {i * 7: words(i, 20 * i) for i in range(1, 14)} | {3: None, 5: "", 6: "one two", 100: words(3, 60)}
    rows = sorted(texts.items())
    frame = prepared(spark).createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, head string").repartition(3)
    got = {r["doc_id"]: r for r in sketches.edited_pairs(frame).collect()}
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert math.isclose(r["near_edited"], likeness(text, edited), abs_tol=0.0 if len(shingles(text) | shingles(edited)) <= 128 else 0.15)
        assert math.isclose(r["near_next"], likeness(text, after), abs_tol=0.1)
    assert sketches.edited_pairs(nothing).collect() == []


def test_odd_rows(odd, odd_rows):
    got = sketches.edited_pairs(odd).collect()
    assert len(got) == len(odd_rows)
    prints = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1
        assert (r["near_next"] is None) == (r["doc_id"] is None)
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[1] == prints[2] and len(prints[3]) == 1 and prints[4] == prints[5] == {""}


def test_parts_merge_and_estimates(spark):
    left, right = words(1, 900, 5000), words(2, 500, 5000)
    row = spark.createDataFrame([(left, right, left + " " + right)], "a string, b string, c string")
    a, b, c = (sketches.sketch(F.col(x)) for x in "abc")
    r = row.select(a.alias("a"), b.alias("b"), c.alias("c")).select(sketches.resemblance(sketches.merged(F.col("a"), F.col("b")), F.col("c")).alias("m"), sketches.containment(F.col("a"), F.col("c")).alias("in_c"), sketches.distinct_shingles(F.col("c")).alias("n")).first()
    assert r["m"] > 0.95 and r["in_c"] > 0.85 and abs(r["n"] / len(shingles(left + " " + right)) - 1) < 0.25
