"""Scoring texts with an n-gram model whose counts live in a log-frequency Bloom filter.

The filter holds words and word pairs.  A count is quantised to a level on a ladder that grows by a
quarter a step; an n-gram of level q is inserted q times, once with each number up to q.  A lookup
probes for 1, 2, ... until one is missing, and so finds the level.  The bits of an insertion lie in two
words of 64, so that a probe reads two places.  Probabilities of pairs are mixed
with those of words.  The filter is cut into segments by the n-gram's hash, sized by what they hold.

Texts are read once: a scan cuts them into chunks, a chunk being a list of distinct words and the
documents as numbers into it.  Counts per chunk are summed by segment, each segment in one task;
the sums come back to the chunks the same way.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import HEAVY_ROWS, adopted, shuffles_dropped, written
from ledgerlift.llm.token_output import decode, encode

#: Bits of the filter for each insertion, and hash functions, three of them in each of two words: about 1 % false probes.
BITS_PER_ENTRY, PROBES = 10, 6
GROWTH, LEVELS = 1.25, 96
#: Levels that are probed segment by segment.
_BY_SEGMENT = 3
#: Weight of the pair's relative frequency against the word's.
PAIR_WEIGHT = 0.3
#: A filter up to this size is broadcast; beyond it the lookups go to the segments instead.
BROADCAST_BYTES = 128 << 20
#: Bytes of text of a chunk, and that a segment stands for.
CHUNK_BYTES, SEGMENT_BYTES = 8 << 20, 16 << 20
#: Tokens of a chunk that are scored at once, and n-grams of a segment that are looked up at once: they bound a worker's arrays.
SLICE_TOKENS, LOOKED_UP = 1 << 18, 1 << 19
END = b"\n"  # no word holds it


def _ladder() -> np.ndarray:
    """Least count of each level, from level 1 on."""
    steps = [1]
    while len(steps) < LEVELS:
        steps.append(max(steps[-1] + 1, int(np.ceil(steps[-1] * GROWTH))))
    return np.array(steps, np.int64)


LADDER = _ladder()
#: By level: the least and the greatest count it stands for; 0 for level 0.
LOW = np.concatenate(([0], LADDER)).astype(np.float64)
HIGH = np.concatenate(([0], LADDER[1:] - 1, [LADDER[-1]])).astype(np.float64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: N-grams are told apart by the upper 48 bits of their hashes: sorted, they take some four bytes each.
_LOW_BITS = np.uint64(16)


def _cut(h: np.ndarray) -> np.ndarray:
    return h >> _LOW_BITS << _LOW_BITS


def word_hashes(words: np.ndarray) -> np.ndarray:
    return _cut(_mix(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _cut(_mix(first * np.uint64(0x9E3779B97F4A7C15) + second))


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as bytes, in variable length where they allow it."""
    if values.size and values.max() >> np.uint64(32):
        return b"\0" + values.astype("<u8").tobytes()
    control, data = encode(values.astype(np.uint32))
    return b"\1" + values.size.to_bytes(8, "little") + control + data


def _unpacked(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, "<u8", offset=1)
    n = int.from_bytes(raw[1:9], "little")
    groups = -(-n // 4)
    return decode(raw[9 : 9 + groups], raw[9 + groups :], n).astype(np.uint64)


def _packed_hashes(h: np.ndarray) -> bytes:
    """Ascending hashes by their differences."""
    return _packed(np.diff(h >> _LOW_BITS, prepend=np.uint64(0)))


def _unpacked_hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw), dtype=np.uint64) << _LOW_BITS


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)


def _probes(h: np.ndarray, level: int) -> np.ndarray:
    """The first probe of a level: the upper half of it says which word, the lowest 18 bits which three bits of it."""
    return _mix(h + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def _second(probe: np.ndarray) -> np.ndarray:
    """The second probe, of another word."""
    other = probe * np.uint64(0x9E3779B97F4A7C15)
    return other ^ (other >> np.uint64(32))


def _word(probe: np.ndarray, words: np.ndarray | np.uint64) -> np.ndarray:
    """The word of a probe in a segment of so many."""
    return ((probe >> np.uint64(32)) * words) >> np.uint64(32)


def _bits(probe: np.ndarray) -> list[np.ndarray]:
    return [(probe >> np.uint64(6 * i)) & np.uint64(63) for i in range(PROBES // 2)]


def _mask(probe: np.ndarray) -> np.ndarray:
    return functools.reduce(np.bitwise_or, [np.uint64(1) << bit for bit in _bits(probe)])


def filter_segment(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of a filter segment that holds `h` with their counts."""
    levels = np.searchsorted(LADDER, counts, side="right")
    words = max(1, -(-int(levels.sum()) * BITS_PER_ENTRY // 64))
    held = np.zeros(64 * words, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        first = _probes(h[levels >= level], level)
        for probe in (first, _second(first)):
            start = _word(probe, np.uint64(words)) << np.uint64(6)
            for bit in _bits(probe):
                held[start + bit] = True
    return np.packbits(held, bitorder="little")


class Filter:
    """All segments, end to end."""

    def __init__(self, parts: dict[int, np.ndarray], segments: int):
        self.segments = segments
        self.words = np.array([len(parts.get(i, b"")) // 8 for i in range(segments)], np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.words)[:-1])).astype(np.uint64)
        self.held = np.concatenate([np.empty(0, np.uint8)] + [parts[i] for i in range(segments) if i in parts]).view("<u8")

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Level of each n-gram, by repeated probes; 0 for an absent one.

        `h` ascends.  The first levels, at which most lookups end, are probed segment by segment, so that
        a segment's bits stay in the processor's cache; what is left goes on all together.
        """
        found = np.zeros(h.size, np.uint8)
        ends = np.searchsorted(_segment(h, self.segments), np.arange(self.segments + 1, dtype=np.uint64))
        rest = [np.empty(0, np.int64)]
        for segment in np.flatnonzero((self.words > 0) & (ends[1:] > ends[:-1])):
            left = np.arange(ends[segment], ends[segment + 1])
            rest.append(self._probed(h, left, found, range(1, _BY_SEGMENT + 1), self.words[segment], self.starts[segment]))
        left = np.concatenate(rest)
        if left.size:
            segment = _segment(h[left], self.segments).astype(np.int64)
            words, starts = np.zeros(h.size, np.uint64), np.zeros(h.size, np.uint64)
            words[left], starts[left] = self.words[segment], self.starts[segment]
            for level in range(_BY_SEGMENT + 1, LEVELS + 1):
                left = self._probed(h, left, found, (level,), words[left], starts[left])
                if not left.size:
                    break
        return found

    def _probed(self, h: np.ndarray, left: np.ndarray, found: np.ndarray, levels, words, base) -> np.ndarray:
        """Probe the places `left` for some levels, note what is found, and return those still there."""
        for level in levels:
            probe = _probes(h[left], level)
            for again in range(2):
                probe = _second(probe) if again else probe
                mask = _mask(probe)
                there = np.flatnonzero(self.held[base + _word(probe, words)] & mask == mask)
                if there.size < left.size:
                    left, probe = left[there], probe[there]
                    if np.ndim(words):
                        words, base = words[there], base[there]
                if not left.size:
                    return left
            found[left] = level
        return left


_CHUNK = "chunk long, ids array<{id}>, held array<boolean>, lengths array<long>, tokens binary, words array<binary>, hashes binary, seen array<long>"


def _chunked(segments: int, id_type: pa.DataType):
    """Arrow batches of (id, held, text) -> chunks; a chunk's words are ordered by segment."""

    def finish(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        split = pc.ascii_split_whitespace(pc.ascii_lower(table.column(2).combine_chunks()))
        flat = split.flatten()
        real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        of_row = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))[real]
        codes = pc.dictionary_encode(flat.filter(pa.array(real)))
        words = [*codes.dictionary.cast(pa.binary()).to_pylist(), END]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        order = np.argsort(_segment(hashes, segments), kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        # Each document's words, then its end.
        counts = np.bincount(of_row, minlength=len(split))
        lengths = counts + 1
        tokens = np.full(int(lengths.sum()), place[-1], np.uint32)
        tokens[np.arange(of_row.size) + of_row] = place[codes.indices.to_numpy(zero_copy_only=False)]
        held = table.column(1).to_numpy().astype(bool)
        seen = np.bincount(tokens[~np.repeat(held, lengths)], minlength=len(words))
        fields = [
            pa.array([number], pa.int64()),
            pa.array([table.column(0).to_pylist()], pa.list_(id_type)),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([tokens.tobytes()], pa.binary()),
            pa.array([[words[i] for i in order]], pa.list_(pa.binary())),
            pa.array([hashes[order].tobytes()], pa.binary()),
            pa.array([seen], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(fields, ["chunk", "ids", "held", "lengths", "tokens", "words", "hashes", "seen"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            # A batch is cut where a chunk is full.
            ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False) + 64) if batch.num_rows else []
            first, before = 0, 0
            for row, end in enumerate(ends):
                if size + end - before >= CHUNK_BYTES:
                    parts.append(batch.slice(first, row + 1 - first))
                    yield finish(number, parts)
                    number, parts, size, first, before = number + 1, [], 0, row + 1, end
            if first < batch.num_rows:
                parts.append(batch.slice(first))
                size += ends[-1] - before
        if parts:
            yield finish(number, parts)

    return run


def _word_parts(segments: int):
    """Chunks -> (segment, chunk, first, words, seen): a chunk's words of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                words, seen = batch.column("words")[at].values, batch.column("seen")[at].values
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
                found, first = np.unique(_segment(hashes, segments), return_index=True)
                ends = [*first[1:], len(words)]
                parts = [(words.slice(a, b - a), seen.slice(a, b - a)) for a, b in zip(first, ends)]
                offsets = pa.array([*first, len(words)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int64)), pa.array([batch.column("chunk")[at].as_py()] * len(parts), pa.int64()), pa.array(first.astype(np.int64)), pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, seen)],
                    ["segment", "chunk", "first", "words", "seen"],
                )

    return run


def _word_sums(table: pa.Table) -> pa.Table:
    """The words of a segment from all chunks -> (chunk, first, counts) for each part, and the segment's totals."""
    words = pc.list_flatten(table.column("words")).combine_chunks()
    seen = pc.list_flatten(table.column("seen")).combine_chunks().to_numpy(zero_copy_only=False)
    codes = pc.dictionary_encode(words)
    index = codes.indices.to_numpy(zero_copy_only=False)
    sums = np.bincount(index, weights=seen, minlength=len(codes.dictionary)).astype(np.int64)
    sizes = pc.list_value_length(table.column("words")).to_numpy()
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    rows = table.num_rows
    first_row = lambda value: pa.array([value] + [0] * (rows - 1), pa.int64())
    counts = pa.ListArray.from_arrays(offsets, pa.array(sums[index], pa.int64()))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in codes.dictionary.to_pylist()), np.uint64, len(sums))[sums > 0]
    blobs = [(hashes.tobytes(), sums[sums > 0].astype(np.int64).tobytes())] + [(None, None)] * (rows - 1)
    return pa.table(
        [table.column("segment"), table.column("chunk"), table.column("first"), counts, first_row(int(sums.sum())), first_row(int((sums > 0).sum())), pa.array([b[0] for b in blobs], pa.binary()), pa.array([b[1] for b in blobs], pa.binary())],
        names=["segment", "chunk", "first", "counts", "n", "v", "h", "c"],
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def _token_hashes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: hashes of its words, its tokens, each token's predecessor (the end, at a document's start)."""
    hashes = np.frombuffer(row["hashes"], np.uint64)
    tokens = np.frombuffer(row["tokens"], np.uint32)
    lengths = np.array(row["lengths"], np.int64)
    ends = np.cumsum(lengths)
    before = np.concatenate(([0], tokens[:-1])).astype(np.uint32)
    before[ends - lengths] = tokens[ends - 1]  # a document's last token is the end
    return hashes, tokens, before, lengths


def _pair_parts(segments: int):
    """Chunks -> (segment, h, c): hashes and counts of the training pairs, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                hashes, tokens, before, lengths = _token_hashes(row)
                trained = ~np.repeat(np.array(row["held"], bool), lengths)
                pairs = _pairs(hashes, tokens[trained], before[trained])
                pairs.sort()
                first = np.flatnonzero(_first(pairs))
                found, counts = pairs[first], np.diff(first, append=pairs.size)
                if found.size:
                    yield from _by_segment(found, counts, segments)

    return run


def _first(ascending: np.ndarray) -> np.ndarray:
    """True where a value is met first."""
    return np.concatenate((np.ones(min(1, ascending.size), bool), ascending[1:] != ascending[:-1]))


def _bounds(h: np.ndarray, segments: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The segments that ascending hashes fall into, and where each begins and ends: they are ascending in segments, too."""
    found, first = np.unique(_segment(h, segments), return_index=True)
    return found.astype(np.int64), list(zip(first, [*first[1:], h.size]))


def _by_segment(h: np.ndarray, counts: np.ndarray, segments: int) -> Iterator[pa.RecordBatch]:
    found, bounds = _bounds(h, segments)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found), pa.array([_packed_hashes(h[a:b]) for a, b in bounds], pa.binary()), pa.array([_packed(counts[a:b].astype(np.uint64)) for a, b in bounds], pa.binary())],
        ["segment", "h", "c"],
    )


def _fill(table: pa.Table) -> pa.Table:
    """All (h, c) parts of a segment -> its filter bytes."""
    h = np.concatenate([_unpacked_hashes(x) for x in table.column("h").to_pylist()])
    c = np.concatenate([_unpacked(x) for x in table.column("c").to_pylist()]).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    held = filter_segment(h[first], np.add.reduceat(c, first))
    return pa.table([table.column("segment").slice(0, 1), pa.array([held.tobytes()], pa.binary())], names=["segment", "held"])


def _pairs(hashes: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The pair that each token ends, made slice by slice."""
    pairs = np.empty(tokens.size, np.uint64)
    for at in range(0, tokens.size, SLICE_TOKENS):
        end = at + SLICE_TOKENS
        pairs[at:end] = pair_hashes(hashes[before[at:end]], hashes[tokens[at:end]])
    return pairs


def _distinct_grams(hashes: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    """All words and pairs of a chunk, ascending, once each."""
    grams = np.concatenate([word_hashes(hashes), _pairs(hashes, tokens, before)])
    grams.sort()
    return grams[_first(grams)]


def _query_parts(segments: int):
    """Chunks -> (segment, chunk, h): the distinct n-grams of a chunk that a segment has to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                hashes, tokens, before, _ = _token_hashes(row)
                asked = _distinct_grams(hashes, tokens, before)
                found, bounds = _bounds(asked, segments)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([row["chunk"]] * found.size, pa.int64()), pa.array([_packed_hashes(asked[a:b]) for a, b in bounds], pa.binary())], ["segment", "chunk", "h"])

    return run


def _answers(segments: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        parts = {int(s): np.frombuffer(b, np.uint8) for s, b in zip(held.column("segment").to_pylist(), held.column("held").to_pylist())}
        model = Filter(parts, segments)
        # What chunks ask for is small each: many are looked up at once, a repeated n-gram once.
        levels, waiting, size = [], [], 0

        def answer() -> None:
            h, of = np.unique(np.concatenate(waiting), return_inverse=True)
            found = model.levels(h)[of]
            levels.extend(x.tobytes() for x in np.split(found, np.cumsum([w.size for w in waiting])[:-1]))

        for blob in asked.column("h"):
            waiting.append(_unpacked_hashes(blob.as_py()))
            size += waiting[-1].size
            if size >= LOOKED_UP:
                answer()
                waiting, size = [], 0
        if waiting:
            answer()
        return pa.table([asked.column("chunk"), asked.column("segment"), pa.array(levels, pa.binary())], names=["chunk", "segment", "levels"])

    return run


def _scores(total: int, distinct: int, id_type: pa.DataType, levels_of):
    """Chunks with their words' counts -> a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            for at, row in enumerate(_rows(batch.drop_columns(["parts"]))):
                hashes, tokens, before, lengths = _token_hashes(row)
                counts = np.empty(len(hashes), np.int64)
                # Counts are many and stay numbers of Arrow's all the way.
                found = parts[at].values
                firsts, listed = found.field("first").to_numpy(), found.field("counts")
                for first, part in zip(firsts, listed):
                    values = part.values.to_numpy(zero_copy_only=False)
                    counts[first : first + values.size] = values
                # Each distinct n-gram is looked up once, in the order of the segments.
                grams = _distinct_grams(hashes, tokens, before)
                levels = levels_of(row, grams)
                single = levels[np.searchsorted(grams, word_hashes(hashes))]
                of_word = _of_words(counts, single, total, distinct)
                made = [_of_tokens(hashes, tokens[a:b], before[a:b], lengths[x:y], grams, levels, *of_word) for x, y, a, b in _slices(lengths)]
                base, known, score = (np.concatenate(x) for x in zip(*made))
                n = len(lengths)
                columns = [pa.array(row["ids"], id_type), pa.array(row["held"], pa.bool_()), pa.array(lengths), pa.array(known), pa.array(np.full(n, total, np.int64)), pa.array(base), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """A chunk's documents in stretches of about SLICE_TOKENS tokens: first and last document, first and last token."""
    ends = np.cumsum(lengths)
    first, at = 0, 0
    while first < lengths.size:
        last = max(first + 1, int(np.searchsorted(ends, at + SLICE_TOKENS, side="right")))
        yield first, last, at, int(ends[last - 1])
        first, at = last, int(ends[last - 1])


def _of_words(counts: np.ndarray, single: np.ndarray, total: int, distinct: int) -> tuple[np.ndarray, ...]:
    """Of each word: the add-one score, whether it is known, the greatest count of its level, its chance by the least."""
    return np.log10((counts + 1) / (total + distinct + 1)), (counts > 0).astype(np.int64), HIGH[single], (LOW[single] + 1) / (total + distinct + 1)


def _of_tokens(hashes: np.ndarray, tokens: np.ndarray, before: np.ndarray, lengths: np.ndarray, grams: np.ndarray, levels: np.ndarray, log_base: np.ndarray, is_known: np.ndarray, high: np.ndarray, chance_alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_score, n_known and score of some documents, whose tokens these are."""
    starts = np.cumsum(lengths) - lengths
    base = np.add.reduceat(log_base[tokens], starts)
    known = np.add.reduceat(is_known[tokens], starts)
    asked, of_token = np.unique(_pairs(hashes, tokens, before), return_inverse=True)
    pairs = LOW[levels[np.searchsorted(grams, asked)]][of_token]
    pairs = np.minimum(pairs, np.minimum(high[before], high[tokens]))
    word = chance_alone[tokens]
    after = np.maximum(high[before], 1)
    backed = high[before] > 0
    chance = np.where(backed, PAIR_WEIGHT * pairs / after + (1 - PAIR_WEIGHT) * word, word)
    return base, known, np.add.reduceat(np.log10(np.minimum(chance, 1.0)), starts)


def _broadcast_levels(shared):
    return lambda row, grams: shared.value.levels(grams)


def _routed_levels(row: dict, grams: np.ndarray) -> np.ndarray:
    """Lookups of a chunk whose answers came with it, in the order of its distinct n-grams."""
    return np.frombuffer(b"".join(p["levels"] for p in row.pop("answers")), np.uint8)


def held_out(doc_id: Column) -> Column:
    """True for the rows the model doesn't learn from; a null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def scored(df: DataFrame, held: Column | None = None, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row for each row of `df`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z lower-cased, and one end.  base_score is the add-one score from exact
    counts; score is the model's log10 probability of the text.  A null text counts as empty: its one
    token is the end.  Repeated rows count and come out as often as they occur.  Where nothing is left
    to learn from, all counts are 0.  An empty table gives an empty result; other columns don't matter.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    id_field = df.schema[id_col].dataType
    kind, id_type = id_field.simpleString(), to_arrow_type(id_field)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    held = held_out(F.col(f"`{id_col}`")) if held is None else held
    rows = df.select(F.col(f"`{id_col}`").alias("id"), held.alias("held"), text.alias("t"))
    size = rows.agg(F.sum(F.octet_length("t") + 1)).collect()[0][0] or 0
    segments = max(4, -(-size // SEGMENT_BYTES))
    chunks = written(rows.mapInArrow(_chunked(segments, id_type), _CHUNK.format(id=kind)), "lm-chunks", HEAVY_ROWS)

    # Chunks are few and heavy rows: they go to Python one at a time.
    chunks = adopted(chunks, rows=1)
    words = chunks.select("chunk", "words", "seen").mapInArrow(_word_parts(segments), "segment long, chunk long, first long, words array<binary>, seen array<long>")
    sums = written(words.groupBy("segment").applyInArrow(_word_sums, "segment long, chunk long, first long, counts array<long>, n long, v long, h binary, c binary"), "lm-words")
    total, distinct = (int(x or 0) for x in sums.agg(F.sum("n"), F.sum("v")).collect()[0])
    singles = sums.where("h is not null").select("segment", "h", "c").mapInArrow(_mixed_singles(segments), "segment long, h binary, c binary")
    pairs = chunks.select("held", "lengths", "tokens", "hashes").mapInArrow(_pair_parts(segments), "segment long, h binary, c binary")
    held_bits = written(singles.unionByName(pairs).groupBy("segment").applyInArrow(_fill, "segment long, held binary"), "lm-filter")
    parts = sums.groupBy("chunk").agg(F.collect_list(F.struct("first", "counts")).alias("parts"))
    asked = chunks.select("chunk", "ids", "held", "lengths", "tokens", "hashes").join(parts, "chunk")
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    whole = held_bits.agg(F.sum(F.length("held"))).collect()[0][0] or 0
    if whole <= broadcast_bytes:
        found = held_bits.toArrow()
        model = Filter({s: np.frombuffer(b, np.uint8) for s, b in zip(found.column("segment").to_pylist(), (x.as_buffer() for x in found.column("held")))}, segments)
        levels_of = _broadcast_levels(spark.sparkContext.broadcast(model))
    else:
        shuffles_dropped(spark)
        queries = chunks.select("chunk", "lengths", "tokens", "hashes").mapInArrow(_query_parts(segments), "segment long, chunk long, h binary")
        answers = queries.groupBy("segment").cogroup(held_bits.groupBy("segment")).applyInArrow(_answers(segments), "chunk long, segment long, levels binary")
        answers = written(answers, "lm-answers")
        shuffles_dropped(spark)
        answers = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("segment", "levels"))).alias("answers"))
        asked, levels_of = asked.join(answers, "chunk"), _routed_levels
    result = written(asked.mapInArrow(_scores(total, distinct, id_type, levels_of), schema), "lm-scores")
    return adopted(result.withColumnRenamed("id", id_col))


def _mixed_singles(segments: int):
    """Words enter the filter under their mixed hash, which has a segment of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h, c = word_hashes(np.frombuffer(row["h"], np.uint64)), np.frombuffer(row["c"], np.int64)
                order = np.argsort(h)
                if h.size:
                    yield from _by_segment(h[order], c[order], segments)

    return run
