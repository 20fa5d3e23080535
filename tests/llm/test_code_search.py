import random

import numpy as np
import pytest

from ledgerlift.llm import code_search as cs
from ledgerlift.llm.common import prepared


def signed(x):
    return int(np.uint64(x).view(np.int64))


def brute(rows, queries, k):
    out = {}
    for q, code in set(queries):
        others = sorted(((code ^ c).bit_count() if (code ^ c) >= 0 else ((code ^ c) & (2**64 - 1)).bit_count(), i) for i, c in set(rows) if (i, c) != (q, code))
        out[q, code] = [(d, i) for d, i in others[:k]]
    return sorted((q, r + 1, i, d) for (q, _), found in out.items() for r, (d, i) in enumerate(found))


@pytest.mark.parametrize("spread,n,k", [(3, 400, 5), (12, 700, 10), (30, 300, 3), (2, 6, 10)])
def test_nearest_equals_brute_force(spark, monkeypatch, spread, n, k):
    monkeypatch.setattr(cs, "CODE_TILE", 128)
    monkeypatch.setattr(cs, "QUERY_TILE", 8)
    picker = random.Random(n)
    centres = [picker.getrandbits(64) for _ in range(4)]
    rows = [(i, signed(picker.choice(centres) ^ sum(1 << b for b in picker.sample(range(64), picker.randrange(spread + 1))))) for i in range(n)]
    rows += [(i + 10_000, rows[0][1]) for i in range(n // 3)] + rows[:3]
    queries = [r for r in rows if r[0] % 25 == 0]
    codes = prepared(spark).createDataFrame(rows, "id long, code long")
    got = sorted(map(tuple, cs.nearest(codes, codes.where("id % 25 = 0"), k).collect()))
    assert got == brute(rows, queries, k)


def test_codes_of_odd_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 0.0]), (3, None), (None, [1.0]), (4, []), (5, [float("nan"), None]), (6, [-1.0, -2.0])]
    got = dict(cs.binary_codes(prepared(spark).createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert set(got) == {1, 2, 4, 5, 6} and got[1] == got[2] and got[4] == got[5] and (got[1] ^ got[6]) == -1


def test_empty_tables(spark):
    empty = prepared(spark).createDataFrame([], "vec_id long, embedding array<double>")
    codes = cs.binary_codes(empty)
    assert cs.nearest(codes, codes, 3).collect() == []


def random_rows(seed, n, centres=3, spread=20):
    picker = random.Random(seed)
    middle = [picker.getrandbits(64) for _ in range(centres)]
    return [(i, signed(picker.choice(middle) ^ sum(1 << b for b in picker.sample(range(64), picker.randrange(spread + 1))))) for i in range(n)]


@pytest.mark.parametrize("tile,in_hand,block", [(1 << 19, 1 << 19, 1 << 13), (100, 7, 3)])
def test_tiles_of_any_size_equal_brute_force(spark, monkeypatch, tile, in_hand, block):
    for name, value in (("INDEX_TILE", tile), ("IN_HAND", in_hand), ("QUERY_BLOCK", block)):
        monkeypatch.setattr(cs, name, value)
    rows = random_rows(tile, 300) + [(i + 10_000, 7) for i in range(20)]
    queries = [r for r in rows if r[0] % 40 == 0]
    codes = prepared(spark).createDataFrame(rows, "id long, code long")
    assert sorted(map(tuple, cs.nearest(codes, codes.where("id % 40 = 0"), 5).collect())) == brute(rows, queries, 5)


def test_names_as_ids(spark):
    rows = random_rows(3, 300)
    codes = prepared(spark).createDataFrame([(f"n{i:03d}", c) for i, c in rows], "id string, code long")
    want = [(f"n{q:03d}", rank, f"n{i:03d}", d) for q, rank, i, d in brute(rows, [r for r in rows if r[0] % 30 == 0], 4)]
    got = cs.nearest(codes, codes.where("cast(substr(id, 2) as int) % 30 = 0"), 4)
    assert sorted(map(tuple, got.collect())) == want


def test_values_to_look_up_are_in_no_plan(spark, monkeypatch):
    """What leaves the queries' side of a round is a block for each tile: neither a row nor a literal for each value looked up."""
    rows = random_rows(5, 500, centres=500)
    codes = prepared(spark).createDataFrame(rows, "id long, code long")
    seen = {}
    monkeypatch.setattr(cs, "written", lambda df, name, *options, f=cs.written: seen.setdefault(name, (df._jdf.queryExecution().optimizedPlan().toString(), f(df, name, *options)))[1])
    cs.nearest(codes, codes.where("id % 10 = 0"), 5).count()
    assert len([x for x in seen if x.startswith("nearest-") and x != "nearest-compared"]) >= 2
    for name, (plan, table) in seen.items():
        assert len(plan) < 20_000 and "explode([" not in plan
        if name.startswith("blocks-"):
            assert table.count() <= 8
