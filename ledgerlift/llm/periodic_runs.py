"""Periodic runs of words: stretches that repeat one block of words three times or more, found and collapsed.

The dictionary of basic factors names, for each power of two L, every factor of L words by a number;
equal factors have equal names, and a factor of 2L words is the pair of its halves' names.  Two
occurrences of a factor inside a window of twice its length lie at most L words apart, and all of a
window form one arithmetic progression; so the gap to the next occurrence, up to L, proposes a period,
and neighbouring positions with the same gap propose one stretch.  A run of period q and three periods
or more is proposed as a whole at the first L >= q: each of its factors that has another one a period
on has none nearer, the period being the smallest.  Stretches are extended as far as the period holds
and counted once.  Factors that occur once in a text have no name, so ordinary prose ends after few levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import pieces

#: Words whose factors are named together; a longer text is named alone.
WORDS_AT_ONCE = 1 << 18
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
FOUND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def numbered(text: bytes, first: int) -> tuple[np.ndarray, int]:
    """Numbers of the text's words, counted from `first`; equal words have equal numbers.  Also the next free one."""
    known: dict[bytes, int] = {}
    parts = [np.array([known.setdefault(w, first + len(known)) for w in words], np.int64) for words in pieces(text)]
    return np.concatenate([*parts, np.empty(0, np.int64)]), first + len(known)


def runs(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int = 24, powers: int = 3) -> np.ndarray:
    """(start, end, period) of every run, by start, then period.

    `words` are the numbers of one or more texts, no number in two of them; `begins` and `ends` say for
    each position where its text begins and ends.  A run has `least` words and `powers` periods at least.
    """
    if powers < 3:
        raise ValueError("a run of less than three periods need not show at a level of its own")
    size, low = 1, np.int64((1 << 32) - 1)
    at, name, found = np.arange(words.size), words.copy(), [np.empty((0, 3), np.int64)]
    while at.size:
        # Positions by name, then place: neighbours of one name are successive occurrences.
        keys = np.sort((name[at] << 32) | at)
        place, kind = keys & low, keys >> 32
        same = kind[1:] == kind[:-1]
        gaps = place[1:] - place[:-1]
        near = same & (gaps <= size)
        found.append(_stretches(place[:-1][near], gaps[near], size, least, powers))
        twice = np.zeros(place.size, bool)
        twice[1:] |= same
        twice[:-1] |= same
        named = np.full(words.size, -1, np.int64)
        named[place[twice]] = kind[twice]
        at = np.sort(place[twice])
        at = at[at + 2 * size <= ends[at]]
        at = at[named[at + size] >= 0]
        halves = (named[at] << 32) | named[at + size]
        order = np.argsort(halves)
        changed = np.ones(order.size, np.int64)
        changed[1:] = halves[order][1:] != halves[order][:-1]
        name[at[order]] = np.cumsum(changed) - 1
        size *= 2
    return np.unique(_extended(np.concatenate(found), words, begins, ends), axis=0)[:, [0, 2, 1]]


def _stretches(place: np.ndarray, gaps: np.ndarray, size: int, least: int, powers: int) -> np.ndarray:
    """(start, period, end) of the stretches that successors at equal gaps from neighbouring positions propose."""
    order = np.argsort(place)
    place, gaps = place[order], gaps[order]
    edge = np.ones(place.size, bool)
    edge[1:] = (place[1:] != place[:-1] + 1) | (gaps[1:] != gaps[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], place.size) - 1
    start, period = place[first], gaps[first]
    end = place[last] + period + size if first.size else start
    long = end - start >= np.maximum(least, powers * period)
    return np.stack([start, period, end], axis=1)[long]


def _extended(proposed: np.ndarray, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The stretches as far as their period holds."""
    proposed = np.unique(proposed, axis=0)
    start, period, end = proposed.T
    if not start.size:
        return proposed
    bottom, top = begins[start], ends[start]
    while (more := np.flatnonzero(start > bottom)).size:
        more = more[words[start[more] - 1] == words[start[more] - 1 + period[more]]]
        if not more.size:
            break
        start[more] -= 1
    while (more := np.flatnonzero(end < top)).size:
        more = more[words[end[more]] == words[end[more] - period[more]]]
        if not more.size:
            break
        end[more] += 1
    return np.stack([start, period, end], axis=1)


def collapsed(text: bytes, found: np.ndarray) -> bytes:
    """The words of a text, one space apart, without those that a run holds after its first period."""
    parts, at, n = [], 0, 0
    cuts = sorted((int(s + q), int(e)) for s, e, q in found)
    for words in pieces(text):
        kept = words
        if cuts:
            keep = np.ones(len(words), bool)
            for a, b in cuts:
                keep[max(0, a - at) : max(0, b - at)] = False
            kept = [words[i] for i in np.flatnonzero(keep)]
        at += len(words)
        n += len(kept)
        if kept:
            parts.append(b" ".join(kept))
    return b" ".join(parts)


def _found(texts: list[bytes], least: int, powers: int) -> Iterator[dict]:
    """What a few texts hold; their factors are named together."""
    parts, lengths, free = [], [], 0
    for text in texts:
        part, free = numbered(text, free)
        parts.append(part)
        lengths.append(part.size)
    edges = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    found = runs(np.concatenate([*parts, np.empty(0, np.int64)]), np.repeat(edges[:-1], lengths), np.repeat(edges[1:], lengths), least, powers)
    of = np.searchsorted(edges, found[:, 0], side="right") - 1
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        mine = found[bounds[i] : bounds[i + 1]] - np.array([edges[i], edges[i], 0])
        listed = [{"start": s, "length": e - s, "period": q} for s, e, q in mine.tolist()]
        yield {"n_words": lengths[i], "runs": listed, "collapsed": collapsed(text, mine)}


def _together(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in groups of at most WORDS_AT_ONCE words, in order; a longer text is a group of its own."""
    held, size = [], 0
    for text in texts:
        n = len(text) // 2 + 1
        if held and size + n > WORDS_AT_ONCE:
            yield held
            held, size = [], 0
        held.append(text)
        size += n
    if held:
        yield held


def found_in(text: Column, least: int = 24, powers: int = 3) -> Column:
    """A struct for each text: n_words, its runs by start, then period, and the text with its runs collapsed.

    A run is a longest stretch of words with smallest period q: words q apart are the same, and it has
    `least` words and `powers` times q of them at least.  ``start`` is the number of its first word, from
    0.  ``collapsed`` holds the words, one space apart, that no run contains after its first q words.  A
    null or empty text has no words.  A worker holds about 100 bytes for each word of the longest text.
    """

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        whole = texts.fill_null("").cast(pa.binary()).to_pylist()
        return pa.array([x for group in _together(whole) for x in _found(group, least, powers)], _FOUND)

    return run(text.cast("string"))


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, powers: int = 3) -> DataFrame:
    """A row for each row of `df`: id, n_words, runs and collapsed, as `found_in` has them.

    Null ids stay; repeated rows come out as often as they go in; an empty table gives an empty result;
    further columns of `df`, whatever their names, don't matter.  Nothing is shuffled.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), found_in(F.col(f"`{text_col}`"), least, powers).alias("found"))
    return rows.select(F.col("id").alias(id_col), "found.n_words", "found.runs", "found.collapsed")
