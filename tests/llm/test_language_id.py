import random
from collections import Counter

import numpy as np

from ledgerlift.llm import language_id as li
from ledgerlift.llm.common import prepared

SYLLABLES = {"xx": ["ka", "to", "mi", "ru", "ne"], "yy": ["sch", "ung", "ein", "ber", "ö"], "zz": ["ção", "lhe", "nho", "que", "é"]}


def text(lang, seed, n=60):
    picker = random.Random(f"{lang}{seed}")
    return " ".join("".join(picker.choice(SYLLABLES[lang]) for _ in range(picker.randint(1, 4))) for _ in range(n))


def test_held_out_texts_get_their_language(spark):
    rows = [(i, text(lang, i), lang) for i in range(120) for lang in SYLLABLES]
    train = prepared(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    fresh = [(1000 + i, text(lang, 1000 + i, 8), lang, "s") for i in range(60) for lang in SYLLABLES]
    got = li.identified(prepared(spark).createDataFrame(fresh, "doc_id long, text string, want string, t string"), li.fit(train)).collect()
    assert sum(r["lang_pred"] == r["want"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 and r["t"] == "s" for r in got)


def test_odd_rows(odd, odd_rows, nothing):
    got = li.identified(odd.drop("score"), li.learned(odd)).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank and (not blank or r["score"] == 0)
        assert r["lang_pred"] in ("aa", "bb", "und") and 0 <= r["score"] <= 1
    assert li.identified(nothing, li.learned(odd)).collect() == []
    untaught = li.identified(odd, li.learned(nothing)).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"} and len(untaught) == len(odd_rows)


def test_slices_hold_every_gram(monkeypatch):
    codes = li._codes(text("xx", 1, 500))
    whole = li._hashes(codes, 4)
    monkeypatch.setattr(li, "_SLICE", 100)
    assert (np.concatenate(list(li._slices(codes, 4))) == whole).all()


def test_other_characters_are_one_space():
    assert "".join(map(chr, li._codes("12 Ab--c! "))) == " ab c "
    assert not li._codes("123 !?").size


def ideographs(base, seed, n=400):
    picker = random.Random(f"{base}{seed}")
    return "".join(chr(base + int(picker.paretovariate(0.6)) % 3000) for _ in range(n))


def test_languages_of_many_letters_do_not_fill_the_table(spark, monkeypatch):
    monkeypatch.setattr(li, "SLOTS", 1 << 10)
    rows = [(ideographs(base, i), lang) for i in range(40) for lang, base in (("hh", 0x4E00), ("kk", 0x5000))]
    train = prepared(spark).createDataFrame(rows, "text string, lang string")
    fresh = prepared(spark).createDataFrame([(ideographs(base, 1000 + i), lang) for i in range(20) for lang, base in (("hh", 0x4E00), ("kk", 0x5000))], "text string, want string")
    sized = li.fit(train)
    assert sized.table.shape[1] > 1 << 10 and max(sized.false_rate) <= 0.27
    monkeypatch.setattr(li, "MAX_TABLE_BYTES", 8 << 12)
    bound = li.fit(train)
    assert bound.table.shape[1] == 1 << 12 and 0.2 < min(bound.false_rate) and max(bound.false_rate) <= 0.3
    for model in (sized, bound):
        got = li.identified(fresh, model).collect()
        assert all(r["lang_pred"] == r["want"] and r["score"] > 0 for r in got)


def test_cutoff_takes_the_highest_levels_and_part_of_the_next():
    levels = [(1, 100), (2, 10), (7, 5)]
    assert li._cutoff(levels, 200) == (0, 1.0) and li._cutoff(levels, 40) == (1, 0.25) and li._cutoff(levels, 10) == (2, 0.5)


def syllables(seed):
    """Ten syllables of a language's own and five that all share."""
    picker = random.Random(f"language{seed}")
    return ["".join(picker.choice(x) for x in ("bdfgklmnprstvz", "aeiou", "lmnrst")) for _ in range(10)] + ["an", "er", "is", "on", "ta"]


def sentence(of, seed, n=60):
    picker = random.Random(f"{of}{seed}")
    return " ".join("".join(picker.choice(of) for _ in range(picker.randint(1, 3))) for _ in range(n))


def test_acceptance_depends_on_what_is_recognised(spark):
    for count in (1, 2, 4, 30):
        known = {f"l{i:02}": syllables(i) for i in range(count)}
        train = prepared(spark).createDataFrame([(sentence(x, i), lang) for lang, x in known.items() for i in range(40)], "text string, lang string")
        fresh = [(sentence(x, 1000 + i), lang) for lang, x in known.items() for i in range(4)]
        fresh += [(sentence(syllables(1000 + i), i), "unlearned") for i in range(10)]
        fresh += [(sentence("abcdefghijklmnopqrstuvwxyz", i, 200), "junk") for i in range(10)]
        got = li.identified(prepared(spark).createDataFrame(fresh, "text string, want string"), li.fit(train))
        for r in got.withColumn("kept", li.accepted(got["lang_pred"], got["score"], got["margin"])).collect():
            assert r["kept"] == (r["want"] in known), (count, r)
            assert not r["kept"] or r["lang_pred"] == r["want"]


def test_more_languages_than_any_mask_word_count(spark):
    """300 labels take five mask words; nothing stops the query, and texts still get their language."""
    known = {f"l{i:03}": syllables(i) for i in range(300)}
    train = prepared(spark).createDataFrame([(sentence(x, i), lang) for lang, x in known.items() for i in range(6)], "text string, lang string")
    model = li.fit(train)
    assert model.table.shape[0] == 5 and model.table.nbytes <= li.MAX_TABLE_BYTES
    fresh = [(sentence(x, 1000), lang) for lang, x in list(known.items())[::3]]
    got = li.identified(prepared(spark).createDataFrame(fresh, "text string, want string"), model).collect()
    assert sum(r["lang_pred"] == r["want"] for r in got) >= 0.95 * len(got)


def grams(text):
    """Letters in lower case, all else one blank, also at both ends; runs of three and four of them."""
    spaced = f" {''.join(c if c.isalpha() else ' ' for c in text.lower())} "
    while "  " in spaced:
        spaced = spaced.replace("  ", " ")
    return [spaced[i : i + n] for n in (3, 4) for i in range(len(spaced) - n + 1)]


def test_languages_and_scores_equal_the_plain_version(spark):
    """Exact sets in place of the filter: the same languages, and scores as close as its false positives allow."""
    rows = [(text(lang, i), lang) for i in range(60) for lang in SYLLABLES]
    counts = {lang: Counter(g for t, x in rows if x == lang for g in grams(t)) for lang in SYLLABLES}
    sizes = {lang: sum(len(t) for t, x in rows if x == lang) for lang in SYLLABLES}
    rate = lambda lang, g: counts[lang][g] / sizes[lang]
    every = set().union(*counts.values())
    own = {lang: {g for g in every if counts[lang][g] and rate(lang, g) >= 0.999999 * sum(rate(x, g) for x in SYLLABLES) / len(SYLLABLES)} for lang in SYLLABLES}
    expected = {lang: max(li.LEAST_EXPECTED, sum(n for g, n in counts[lang].items() if g in own[lang] and n >= 2) / sum(counts[lang].values())) for lang in SYLLABLES}
    fresh = [f"{text(a, 500 + i, 9)} {text(b, 900 + i, i % 7)}" for i in range(40) for a, b in (("xx", "yy"), ("zz", "xx"), ("yy", "zz"))] + ["12 34", "a"]
    got = li.identified(prepared(spark).createDataFrame([(t,) for t in fresh], "text string"), li.fit(prepared(spark).createDataFrame(rows, "text string, lang string"))).collect()
    for r in got:
        found = grams(r["text"])
        hits = {lang: sum(g in own[lang] for g in found) for lang in sorted(SYLLABLES)}
        best = max(hits, key=lambda x: hits[x])
        if not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif sorted(hits.values())[-1] > sorted(hits.values())[-2]:
            assert r["lang_pred"] == best
            assert abs(r["score"] - min(1.0, hits[best] / len(found) / expected[best])) < 0.02
