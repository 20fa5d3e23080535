import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlift.llm import lm_scoring as lm
from ledgerlift.llm.common import prepared
from tests.llm.conftest import words


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def exact(rows):
    """(held out, tokens, known, N, base score, score from exact counts) of each row."""
    singles, pairs = Counter(), Counter()
    for d, text, *_ in rows:
        if not out(d):
            singles.update(tokens(text))
            pairs.update(zip([b"\n"] + tokens(text), tokens(text)))
    n, v = sum(singles.values()), len(singles)
    for d, text, *_ in rows:
        found = tokens(text)
        word = lambda w: (singles[w] + 1) / (n + v + 1)
        pair = lambda a, b: lm.PAIR_WEIGHT * pairs[a, b] / singles[a] + (1 - lm.PAIR_WEIGHT) * word(b) if singles[a] else word(b)
        yield d, out(d), len(found), sum(singles[w] > 0 for w in found), n, sum(math.log10(word(w)) for w in found), sum(math.log10(pair(a, b)) for a, b in zip([b"\n"] + found, found))


def close(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=0.12, abs=1.0)


def test_scores_equal_exact_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 9000)
    rows = [(i, words(i % 50, 30 + 7 * i % 200, 900), "x") for i in range(150)]
    frame = prepared(spark).createDataFrame(rows, "doc_id long, text string, words string")
    got = lm.scored(frame).collect()
    close(got, exact(rows))
    routed = lm.scored(frame, broadcast_bytes=0).collect()
    assert sorted(routed) == sorted(got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(odd, odd_rows, nothing):
    close(lm.scored(odd).collect(), exact(odd_rows))
    assert lm.scored(nothing).collect() == []


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if out(i))
    r = lm.scored(prepared(spark).createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r["n_known"], r["train_tokens"], r["n_tokens"], r["base_score"], r["score"]) == (0, 0, 3, 0.0, 0.0)


def test_filter_never_misses_and_seldom_errs():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 40_000).astype(np.uint64))
    counts = np.random.default_rng(2).geometric(0.2, h.size)
    segments = 3
    of = lm._segment(h, segments)
    model = lm.Filter({s: lm.filter_segment(h[of == s], counts[of == s]) for s in range(segments)}, segments)
    levels, want = model.levels(h), np.searchsorted(lm.LADDER, counts, side="right")
    assert (levels >= want).all() and (levels != want).mean() < 0.03
    absent = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 40_000).astype(np.uint64))
    assert (model.levels(absent) > 0).mean() < 0.03
    assert not lm.Filter({}, 4).levels(absent[:5]).any()


def test_slices_of_a_chunk_equal_the_whole(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 9000)
    rows = [(i, words(i % 50, 30 + 7 * i % 200, 900)) for i in range(60)] + [(60, words(9, 700, 900)), (61, ""), (62, None)]
    frame = prepared(spark).createDataFrame(rows, "doc_id long, text string")
    whole = {limit: sorted(lm.scored(frame, broadcast_bytes=limit).collect(), key=lambda r: r["doc_id"]) for limit in (0, lm.BROADCAST_BYTES)}
    monkeypatch.setattr(lm, "SLICE_TOKENS", 100)
    monkeypatch.setattr(lm, "LOOKED_UP", 50)
    for limit, want in whole.items():
        assert sorted(lm.scored(frame, broadcast_bytes=limit).collect(), key=lambda r: r["doc_id"]) == want
    close(want, exact(rows))


def test_scoring_a_chunk_takes_little_memory():
    """Beyond the chunk and its distinct n-grams, a worker holds arrays of a slice of the tokens, not of all."""
    rng = np.random.default_rng(4)
    lengths = np.full(8000, 160)
    hashes = rng.integers(1, 1 << 63, 150_000).astype(np.uint64)
    tokens = rng.integers(0, hashes.size, int(lengths.sum())).astype(np.uint32)
    tokens[np.cumsum(lengths) - 1] = 7
    counts = pa.array([[{"first": 0, "counts": np.ones(hashes.size, np.int64)}]])
    row = {"ids": [list(range(lengths.size))], "held": [[False] * lengths.size], "lengths": [lengths], "tokens": [tokens.tobytes()], "parts": counts, "hashes": [hashes.tobytes()]}
    batch = pa.record_batch(row)
    run = lm._scores(1000, 100, pa.int64(), lambda row, grams: np.ones(grams.size, np.uint8))
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in run(iter([batch]))) == lengths.size
        assert tracemalloc.get_traced_memory()[1] < 80 << 20
    finally:
        tracemalloc.stop()
