import random

import numpy as np
import xxhash

from ledgerlift.llm import common, simhash
from ledgerlift.llm.graph import components
from tests.llm.oracle import fingerprint, groups, union_find


def test_fingerprints_and_components_equal_brute_force(odd, odd_rows):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_groups(odd).collect())
    prints = [fingerprint(r[1], 3) for r in odd_rows]
    want = sorted((r[0] is None, r[0], f"{p:016x}", c) for r, p, c in zip(odd_rows, prints, groups([r[0] for r in odd_rows], prints, 3)))
    assert got == want


def test_empty_table(nothing):
    assert simhash.near_groups(nothing).collect() == []
    assert simhash.near_dedup(nothing).collect() == []


def test_links_of_dense_and_spread_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    picker = random.Random(5)
    centre = [picker.getrandbits(64) for _ in range(3)]
    codes = {c ^ sum(1 << b for b in picker.sample(range(64), picker.randrange(7))) for c in centre for _ in range(120)} | {picker.getrandbits(64) for _ in range(150)}
    frame = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long")
    edges = [tuple(int(np.int64(x).view(np.uint64)) for x in r) for r in simhash.links(frame, 3).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    want = [(a, b) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= 3]
    assert union_find(codes, edges) == union_find(codes, want)


def test_near_dedup_keeps_one_row_of_each_group(odd):
    kept = simhash.near_dedup(odd).collect()
    groups_ = {r["component_id"] for r in simhash.near_groups(odd).collect()}
    assert len(kept) == len(groups_)
    assert kept[0].asDict().keys() == set(odd.columns)
    assert sum(r["text"] is not None and r["text"].startswith("w") and r["doc_id"] in (1, 2, 3) for r in kept) == 1


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (139, 150), (150, 139)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = union_find({x for e in edges for x in e}, edges)
    assert found == {x: r for x, r in want.items() if x != r}


def test_hash_is_the_one_of_the_contract():
    assert xxhash.xxh64_intdigest(b"a b c", 42) == fingerprint("A b\tC", 3)


def test_long_texts_are_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(common, "PIECE", 11)
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 5)
    picker = random.Random(8)
    for n in (0, 1, 2, 3, 40, 200):
        text = "".join(picker.choice(["word", "É", "x", "longer-than-a-piece"]) + picker.choice([" ", "\t\n", "  "]) for _ in range(n))
        assert simhash.fingerprint(text, 3) == fingerprint(text, 3)
