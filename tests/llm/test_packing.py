import random
from collections import defaultdict

from ledgerlift.llm import packing, simhash
from ledgerlift.llm.common import prepared


def plain_best_fit(items, capacity):
    bins = []
    out = []
    for size, source, cluster in items:
        fits = [b for b in bins if b["room"] >= size and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])]
        if fits:
            chosen = min(fits, key=lambda b: b["room"])
        else:
            chosen = {"room": capacity, "sources": set(), "clusters": set()}
            bins.append(chosen)
        chosen["room"] -= size
        chosen["sources"].add(source)
        chosen["clusters"].add(cluster)
        out.append(chosen["room"])
    return out


def test_best_fit_takes_the_tightest_compatible_bin():
    picker = random.Random(2)
    for _ in range(30):
        items = sorted(((picker.randint(1, 50), picker.choice([None, "a", "b", "c", "d", "e"]), picker.choice([None, 1, 2, 3] + list(range(4, 40)))) for _ in range(120)), key=lambda x: -x[0])
        placed = packing.best_fit(items, 50)
        # The room left after each placement is the same, whichever of equally tight bins was taken.
        got = []
        for (size, _, _), (_, offset) in zip(items, placed):
            got.append(50 - offset - size)
        assert got == plain_best_fit(items, 50)
        held = defaultdict(list)
        for item, (number, offset) in zip(items, placed):
            held[number].append((offset, *item))
        for pieces in held.values():
            pieces.sort()
            assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:i]) for i in range(len(pieces))]
            assert sum(p[1] for p in pieces) <= 50
            for k in (2, 3):
                known = [p[k] for p in pieces if p[k] is not None]
                assert len(known) == len(set(known))


def test_best_fit_without_conflicts_equals_the_plain_version():
    picker = random.Random(4)
    items = [(picker.randint(1, 30), None, None) for _ in range(200)]
    assert [30 - o - s for (s, _, _), (_, o) in zip(items, packing.best_fit(items, 30))] == plain_best_fit(items, 30)


def test_tightest_bin_is_found_behind_conflicts():
    items = [(8, "a", 1), (7, "b", 2), (6, "c", 3), (2, "a", 9), (2, "z", 2)]
    # Rooms 2, 3 and 4; source a is barred from the first, cluster 2 from the second.
    assert packing.best_fit(items, 10) == [(0, 0), (1, 0), (2, 0), (1, 7), (0, 8)]


def test_pack_words_places_every_word_once(odd, odd_rows, nothing):
    got = packing.pack_words(odd, capacity=256).collect()
    words = sum(len((r[1] or "").split()) for r in odd_rows)
    assert sum(r["n"] for r in got) == words
    pieces = defaultdict(list)
    for r in got:
        pieces[r["h"], r["copy"]].append((r["first"], r["n"]))
    assert len(pieces) == len(odd_rows)
    for parts in pieces.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
    assert all((r["bin_id"] is None) == (r["n"] == 0) for r in got)
    assert packing.pack_words(nothing).collect() == []


def test_sequences_hold_the_texts(odd, odd_rows, nothing):
    got = packing.sequences(odd, capacity=256, per_source=1).collect()
    found = sorted(w for r in got for w in r["text"].split())
    assert found == sorted(w for r in odd_rows for w in (r[1] or "").split())
    for r in got:
        assert r["n_words"] == sum(r["lengths"]) == len(r["text"].split()) <= 256
        known = [s for s in r["sources"] if s is not None]
        assert len(known) == len(set(known))
    assert packing.sequences(nothing).collect() == []


def test_a_source_may_be_allowed_more_than_once():
    items = [(3, "a", None)] * 7 + [(2, "b", None)] * 3
    for allowed in (1, 2, 3):
        held = defaultdict(list)
        for (_, source, _), (number, _) in zip(items, packing.best_fit(items, 20, allowed)):
            held[number].append(source)
        assert max(h.count("a") for h in held.values()) == allowed
        assert len(held) == -(-7 // allowed)


def near_copies():
    """Groups of texts that differ in one word, and the stretches of one document."""
    rows = []
    for group in range(4):
        picker = random.Random(group)
        words = [f"w{picker.randrange(5000)}" for _ in range(400)]
        rows += [(100 * group + i, " ".join(words[:-1] + [f"end{i}"]), f"s{i}") for i in range(12)]
    parts = [f"p{random.Random(i).randrange(5000)}x{i}" for i in range(600)]
    rows += [(900, " ".join(parts), "t0"), (900, " ".join(parts[:200]), "t1"), (900, " ".join(parts[200:450]), "t2")]
    return rows


def test_no_bin_holds_two_of_a_component_or_document(spark):
    df = prepared(spark).createDataFrame(near_copies(), "doc_id long, text string, source string")
    component = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_groups(df).collect()}
    of = {}
    for (doc_id, _), c in component.items():
        of.setdefault(doc_id, set()).add(c)
    assert len(set().union(*of.values())) < len(of)  # there are components to tell apart
    held = defaultdict(list)
    for r in packing.pack_words(df.where("doc_id < 900")).collect():
        held[r["bin_id"]] += of[r["doc_id"]]
    assert all(len(x) == len(set(x)) for x in held.values()) and max(map(len, held.values())) > 1
    for r in packing.sequences(df).collect():
        assert len(r["doc_ids"]) == len(set(r["doc_ids"]))
        known = [c for d in r["doc_ids"] if d < 900 for c in of[d]]
        assert len(known) == len(set(known))


def test_every_copy_of_a_repeated_row_is_placed(spark):
    """Copies are documents of one component: each stands in a sequence of its own, whole or in parts."""
    text = " ".join(f"w{i}" for i in range(50))
    long = " ".join(f"x{i}" for i in range(130))
    frame = prepared(spark).createDataFrame([(1, text, "a")] * 40 + [(2, long, "b")] * 3 + [(3, "y  z", "c")], "doc_id long, text string, source string")
    rows = packing.sequences(frame, capacity=60).collect()
    parts = [p for r in rows for p in r["text"].split("\n")]
    assert parts.count(text) == 40 and parts.count("y  z") == 1
    assert sorted(w for p in parts for w in p.split()) == sorted((text + " ").split() * 40 + long.split() * 3 + ["y", "z"])
    for r in rows:
        assert r["n_words"] <= 60 and len(set(r["doc_ids"])) == len(r["doc_ids"])
