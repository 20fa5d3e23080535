import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlift.llm import quality
from ledgerlift.llm.common import prepared
from tests.llm.conftest import words


def corpus(n, seed=0):
    picker = random.Random(seed)
    for i in range(n):
        bad = picker.random() < (0.8 if i % 5 == 0 else 0.1)
        prose = words(i, picker.randint(20, 120), 3000).replace(" w7", ", w7").capitalize() + "."
        text = picker.choice([prose.upper().replace(" ", "!! "), prose.replace(" ", " | "), " ".join([prose.split()[0]] * 60)]) if bad else prose
        yield i, text, f"h{i % 5}", f"p{i % 2}", int(not bad)


def test_held_out_accuracy_and_site_priors(spark, nothing):
    rows = list(corpus(900))
    frame = prepared(spark).createDataFrame([r[:4] for r in rows], "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(r[0], r[4], 0) for r in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classified(frame, labels, F.col("host"), F.col("path")).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert sum(got[r[0]]["keep"] == bool(r[4]) for r in held) >= 0.95 * len(held) > 100
    mean = lambda host: sum(got[r[0]]["p_host"] for r in rows if r[2] == host) / 180
    assert mean("h0") < 0.4 < 0.8 < mean("h1")
    assert quality.classified(nothing, labels, F.col("source"), F.col("lang")).collect() == []


def test_a_repeated_label_counts_in_one_row(spark, monkeypatch):
    """However often a labelled row occurs, the driver gets its features once; the fit is that of all rows."""
    rows = [r[:4] for r in corpus(120)]
    labels = spark.createDataFrame([(r[0], r[4]) for r in corpus(120)], "doc_id long, quality int")
    sizes, fit = [], quality._fit

    def seen(x, y, times):
        sizes.append((len(x), times.sum()))
        once, again = fit(x, y, times), fit(np.repeat(x, times.astype(int), 0), np.repeat(y, times.astype(int)), np.ones(int(times.sum())))
        assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(once, again))
        return once

    monkeypatch.setattr(quality, "_fit", seen)
    frame = prepared(spark).createDataFrame(rows + rows[:1] * 5000, "doc_id long, text string, host string, path string")
    assert quality.classified(frame, labels, F.col("host"), F.col("path")).count() == 5120
    learned = 120 - sum(zlib.crc32(str(i).encode()) % 5 == 2 for i in range(120))
    assert len(sizes) == 1 and sizes[0][0] <= learned and sizes[0][1] == learned + 5000 * (zlib.crc32(b"0") % 5 != 2)


def plain_posteriors(got, labels, weights):
    """The posteriors, document by document, from the texts' evidence and the two prior weights."""
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    site = [labels[i] if i in labels and not held else p for i, _, _, held, p in got]
    base = sum(site) / len(site)
    for j, (i, host, path, held, p) in enumerate(got):
        at = [k for k in range(len(got)) if got[k][1] == host and k != j]
        within = [k for k in at if got[k][2] == path]
        mean = (sum(site[k] for k in at) + weights[0] * base) / (len(at) + weights[0])
        mean = (sum(site[k] for k in within) + weights[1] * mean) / (len(within) + weights[1])
        x = logit(p) + logit(mean) - math.log(base / (1 - base))
        yield i, 0.0 if p == 0 else 1 / (1 + math.exp(-x))


def test_posteriors_equal_the_plain_version(spark, monkeypatch):
    made = list(corpus(300, 3))
    labels = {r[0]: float(r[4]) for r in made if r[0] % 2}
    weights, weigh = [], quality._weight
    monkeypatch.setattr(quality, "_weight", lambda *a: weights.append(weigh(*a)) or weights[-1])
    frame = prepared(spark).createDataFrame([r[:4] for r in made] + [(1000, "", "h1", "p0"), (1001, "lone text", None, None)], "doc_id long, text string, host string, path string")
    known = spark.createDataFrame([(i, int(y)) for i, y in labels.items()], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in quality.classified(frame, known, F.col("host"), F.col("path")).collect()}
    places = {r[0]: (r[2], r[3]) for r in made} | {1000: ("h1", "p0"), 1001: (None, None)}
    rows = [(i, *places[i], r["held_out"], r["p_text"]) for i, r in found.items()]
    want = dict(plain_posteriors(rows, labels, weights))
    assert all(abs(want[i] - r["p_quality"]) < 1e-9 for i, r in found.items())
    assert all(r["keep"] == (r["p_text"] > 0 and r["p_quality"] >= quality.KEEP) for r in found.values())


def test_odd_rows(odd, odd_rows, spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 0), (9, 1), (9, 0)], "doc_id long, quality int")
    got = quality.classified(odd, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r["p_quality"] <= 1 for r in got)
    assert sum(r["p_text"] == 0 for r in got) == sum(not (r[1] or "").split() for r in odd_rows)
    unlabelled = quality.classified(odd, labels.where("false"), F.col("source"), F.col("lang")).collect()
    assert sum(r["keep"] for r in unlabelled) == sum(bool((r[1] or "").split()) for r in odd_rows)


def test_sparse_sites_shrink_towards_their_parents(spark):
    rows = [(i, words(i, 40), "big", "a") for i in range(200)] + [(500, words(500, 40), "tiny", "a")]
    labels = spark.createDataFrame([(i, i % 4 > 0) for i in range(200)], "doc_id long, quality boolean").select("doc_id", F.col("quality").cast("int").alias("quality"))
    got = {r["doc_id"]: r for r in quality.classified(prepared(spark).createDataFrame(rows, "doc_id long, text string, host string, path string"), labels, F.col("host"), F.col("path")).collect()}
    assert abs(got[500]["p_host"] - got[0]["p_host"]) < 0.1
