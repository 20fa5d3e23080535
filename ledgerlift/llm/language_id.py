"""Language identification with bit-sliced Bloom filters of character n-grams.

One table holds the filters of all languages: a slot is a 64-bit word per 64 languages, bit l of
it belongs to language l.  An n-gram is inserted for the languages it is typical of; a lookup
ANDs its slots and so returns all languages containing the n-gram at once.  A text is decided by
the number of its n-grams per language, corrected for the filter's false positives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

NGRAMS = (3, 4)
HASHES = 2
#: Least slots of the table (a power of two) and most bytes of it, which are broadcast: 8 a slot per 64 languages.
SLOTS = 1 << 21
MAX_TABLE_BYTES = 64 << 20
#: A language's share of set bits that its n-grams may reach; beyond it the filter tells too little.
MAX_DENSITY = 0.5
#: Counts below this are a level each when n-grams are ranked, larger ones are levels of 1 %.
_EXACT_LEVELS = 1 << 10
#: Texts a language is learned from at most (by expectation of a hash sample).
TEXTS_PER_LANGUAGE = 20_000
UNDETERMINED = "und"
#: A document is accepted from this score on, and if the second best language falls short of the best
#: by this share of it.  Neither depends on the number of languages.
MIN_SCORE, MIN_MARGIN = 0.6, 0.1
#: Share of a fresh text's n-grams that a language counts on at least, however little it was learned from.
LEAST_EXPECTED = 0.2
_SLICE = 1 << 19


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (mask words, slots) uint64; slots are a power of two
    false_rate: np.ndarray  # per language: share of absent n-grams that the filter reports
    expected: np.ndarray  # per language: share of a fresh text's n-grams that the language contains


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Is a letter, by code point."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def _codes(text: str) -> np.ndarray:
    """Lower-case code points; each run of other characters is one space, also before and after the text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint32)
    before = np.concatenate(([False], letter[:-1]))
    kept = np.where(letter, points, np.uint32(32))[letter | before]
    ends = [np.array([32], np.uint32)]
    return np.concatenate(ends + [kept] + (ends if kept[-1] != 32 else []))


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each n-gram of consecutive code points."""
    size = codes.size - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    wide = codes.astype(np.uint64)
    packed = wide[:size].copy()
    for i in range(1, n):
        packed = packed * np.uint64(0x9E3779B97F4A7C15) + wide[i : size + i]
    return _mixed(packed + np.uint64(n))


def _slices(codes: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Hashes of all n-grams in pieces of bounded size; neighbouring pieces overlap by n - 1 code points."""
    for at in range(0, max(0, codes.size - n + 1), _SLICE):
        yield _hashes(codes[at : at + _SLICE + n - 1], n)


def _counts(index: dict[str, int]):
    """Arrow batches of (text, lang) -> n-gram counts per language, summed within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[int, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = _codes(text)
                parts.setdefault(index[lang], []).extend(h for n in NGRAMS for h in _slices(codes, n))
            for lang, hashes in parts.items():
                found, counts = np.unique(np.concatenate([*hashes, np.empty(0, np.uint64)]), return_counts=True)
                yield pa.record_batch([pa.array(np.full(found.size, lang, np.int32)), pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from the rows of `labelled` with a text and a language.

    The sample is bounded: of each language about TEXTS_PER_LANGUAGE texts at most, chosen by the
    texts' hashes, so that reruns agree.  An n-gram belongs to a language if its rate there is at
    least the mean of its rates over the languages.  The table has as many slots as keep each language
    within MAX_DENSITY; where MAX_TABLE_BYTES allows fewer, a language has its n-grams of highest rate
    that do: the more languages, the fewer slots.  No labelled row gives a model without languages.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = dict(rows.groupBy("lang").agg(F.count("*").alias("n")).collect())  # the classes of the model
    languages = sorted(sizes, key=lambda x: x.encode())
    words = max(1, -(-len(languages) // 64))
    if not languages:
        return LanguageModel(languages, np.zeros((words, SLOTS), np.uint64), np.zeros(0), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, TEXTS_PER_LANGUAGE / v))])
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    counts = sample.mapInArrow(_counts({x: i for i, x in enumerate(languages)}), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    rate = F.col("n") / F.element_at(F.array(*[F.lit(float(max(1, totals.get(x) or 1))) for x in languages]), F.col("lang") + 1)
    grams = counts.withColumn("rate", rate).groupBy("gram").agg(F.collect_list(F.struct("lang", "rate", "n")).alias("rates"), (F.sum("rate") / len(languages)).alias("mean"))
    found = grams.select("gram", F.explode("rates").alias("r"), "mean").select("gram", "r.lang", "r.n", F.expr("r.rate >= mean * 0.999999").alias("own"))
    found = written(found.withColumn("level", _level(F.col("n"))), "language-grams")
    levels: dict[int, list[tuple[int, int]]] = {}
    held: dict[int, dict[int, int]] = {}
    seen = np.zeros(len(languages))
    for r in found.groupBy("lang", "level", "own").agg(F.count("*").alias("grams"), F.sum("n").alias("n")).toArrow().to_pylist():
        seen[r["lang"]] += r["n"]
        if r["own"]:
            levels.setdefault(r["lang"], []).append((r["level"], r["grams"]))
            held.setdefault(r["lang"], {})[r["level"]] = r["n"]
    typical = found.where("own")
    slots = _table_slots(max((sum(n for _, n in x) for x in levels.values()), default=0), words)
    limits = [(x, *_cutoff(levels[x], _room(slots))) for x in sorted(levels)]
    expected = np.full(len(languages), LEAST_EXPECTED)
    for x, least, part in limits:
        # Without those seen once: left out of learning, they would not be found again.
        known = sum(n * (part if level == least else 1.0) for level, n in held[x].items() if level >= max(2, least))
        expected[x] = max(LEAST_EXPECTED, known / seen[x])
    limits = F.broadcast(spark.createDataFrame(limits, "lang int, least int, part double"))
    # Of the level that fits in part, the hashes choose; other bits than those of the slots.
    chosen = (F.col("level") > F.col("least")) | ((F.col("level") == F.col("least")) & (F.pmod(F.xxhash64("gram"), F.lit(1_000_003)) < F.col("part") * 1_000_003))
    bits = slots.bit_length() - 1
    slot = F.explode(F.array(*[F.shiftrightunsigned("gram", k * bits).bitwiseAND(F.lit(slots - 1)) for k in range(HASHES)])).alias("slot")
    set_bits = (
        typical.join(limits, "lang")
        .where(chosen)
        .select(slot, "lang")
        .groupBy("slot", (F.col("lang") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pmod(lang, 64))")).alias("bits"))
    )
    found = set_bits.toArrow()  # at most a row for each word of the table
    table = np.zeros((words, slots), np.uint64)
    if found.num_rows:
        table[found.column("word").to_numpy(), found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    density = np.array([np.count_nonzero(table[i // 64] & np.uint64(1 << (i % 64))) / slots for i in range(len(languages))])
    return LanguageModel(languages, table, density**HASHES, expected)


def _level(n: Column) -> Column:
    """Rank of a count: the count itself, from _EXACT_LEVELS on its logarithm."""
    return F.when(n < _EXACT_LEVELS, n).otherwise(_EXACT_LEVELS + F.floor(100 * F.log(n / F.lit(float(_EXACT_LEVELS))))).cast("int")


def _room(slots: int) -> int:
    """N-grams that set MAX_DENSITY of so many slots, by expectation."""
    return int(-math.log1p(-MAX_DENSITY) * slots / HASHES)


def _table_slots(grams: int, words: int) -> int:
    """The least power of two from SLOTS on that has room for `grams` n-grams, within MAX_TABLE_BYTES."""
    most = 1 << max(0, (MAX_TABLE_BYTES // (8 * words)).bit_length() - 1)
    slots = min(SLOTS, most)
    while slots < most and _room(slots) < grams:
        slots *= 2
    return slots


def _cutoff(levels: list[tuple[int, int]], room: int) -> tuple[int, float]:
    """(lowest level taken, share of it), from the highest of (level, n-grams) down, for `room` n-grams in all."""
    for level, n in sorted(levels, reverse=True):
        if n > room:
            return level, room / n
        room -= n
    return 0, 1.0


def _slots(gram: np.ndarray, k: int, slots: int) -> np.ndarray:
    """The k-th slot: a run of the hash's own bits."""
    return (gram >> np.uint64(k * (slots.bit_length() - 1))) & np.uint64(slots - 1)


def identified(df: DataFrame, model: LanguageModel, text: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "margin")) -> DataFrame:
    """`df` with the predicted language, its score and its margin, both from 0 to 1.

    The score is the share of the text's n-grams that the language contains, corrected for false
    positives, against the share that a fresh text of the language has on average; the margin is the
    part of the best count by which the second best falls short.
    ``und`` with score and margin 0 for a text that is null, empty or has no letter, and where no language was
    learned.  Ties go to the first language by code point.  All other columns stay as they are,
    whatever their names, but for columns of the names `out`, which are replaced; equal rows get equal
    answers, an empty table gives an empty result.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.table, model.false_rate, model.expected))

    def decide(texts: list) -> tuple[list, list, list]:
        languages, table, false_rate, expected = shared.value
        names, scores, margins = [], [], []
        for text in texts:
            codes = _codes(text) if text and languages else ()
            if not len(codes):
                names.append(UNDETERMINED)
                scores.append(0.0)
                margins.append(0.0)
                continue
            hits, total = np.zeros(len(languages)), 0
            for n in NGRAMS:
                for grams in _slices(codes, n):
                    total += grams.size
                    slots = [_slots(grams, k, table.shape[1]) for k in range(HASHES)]
                    for word in range(table.shape[0]):
                        masks = np.bitwise_and.reduce([table[word][s] for s in slots])
                        for lang in range(word * 64, min(len(languages), word * 64 + 64)):
                            hits[lang] += np.count_nonzero(masks & np.uint64(1 << (lang % 64)))
            corrected = np.maximum(0.0, hits - false_rate * total) / np.maximum(1e-9, 1 - false_rate)
            best = int(np.argmax(corrected))
            names.append(languages[best])
            second = float(np.delete(corrected, best).max(initial=0.0))
            scores.append(min(1.0, float(corrected[best] / total / expected[best])))
            margins.append(float(1 - second / corrected[best]) if corrected[best] > 0 else 0.0)
        return names, scores, margins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, margins = decide(batch.column(batch.num_columns - 1).to_pylist())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())], [f"c{i}" for i in range(batch.num_columns + 2)])

    kept = [c for c in df.columns if c not in out]
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").cast("string").alias("t"))
    fields = [f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    found = inner.mapInArrow(run, ", ".join([*fields, f"c{len(kept)} string", f"c{len(kept) + 1} double", f"c{len(kept) + 2} double"]))
    return found.toDF(*kept, *out)


def held_out(doc_id: Column) -> Column:
    """True for the rows that are kept from learning; a null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> LanguageModel:
    """The model of the query and of the pipeline: from the documents that aren't held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))))


def accepted(lang_pred: Column, score: Column, margin: Column) -> Column:
    """True where a language was told with at least MIN_SCORE and MIN_MARGIN."""
    return (lang_pred != UNDETERMINED) & (score >= MIN_SCORE) & (margin >= MIN_MARGIN)
