"""Token ids as files: frequency-ranked, in byte-aligned variable length with separate control bytes.

A file set is a folder of Parquet tables.  ``blocks`` holds documents in ascending order, cut into
blocks: the documents' ids and lengths, and their token ids as ranks by corpus frequency, each in one
to four bytes.  Four ranks share a control byte that holds their lengths; control and data bytes are
columns of their own.  ``ranks`` holds the token of each rank.  Decoding looks a control byte's
lengths and offsets up in tables.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import running_bases, scratch_path, written

END_ID = 1
#: Tokens from which on a block takes no more documents; text of one range of documents.
BLOCK_TOKENS, RANGE_BYTES = 1 << 18, 24 << 20
#: Ranges at most; beyond that they hold more text, which a task goes through block by block.
MAX_RANGES = 20_000
#: Ranges whose token counts one task adds up.
RANGES_SUMMED = 128
#: Words and parts of words whose ids a worker remembers: some 200 bytes each.
REMEMBERED = 1_200_000

#: By control byte: the four lengths, where each value starts among the group's bytes, and their sum.
_LENGTHS = np.array([[1 + (c >> (2 * i) & 3) for i in range(4)] for c in range(256)], np.uint8)
_STARTS = np.concatenate((np.zeros((256, 1), np.int64), np.cumsum(_LENGTHS, axis=1, dtype=np.int64)[:, :3]), axis=1)
_SUMS = _LENGTHS.sum(axis=1, dtype=np.int64)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values; the last group is filled up with zeros."""
    padded = np.zeros(-(-values.size // 4) * 4, np.uint32)
    padded[: values.size] = values
    extra = (padded > 0xFF).astype(np.uint8)
    extra += padded > 0xFFFF
    extra += padded > 0xFFFFFF
    codes = extra.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    sizes = extra + np.uint8(1)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = ends - sizes
    data = np.empty(int(ends[-1]) if ends.size else 0, np.uint8)
    data[at] = padded.astype(np.uint8)
    for byte in range(1, 4):
        longer = np.flatnonzero(extra >= byte)
        data[at[longer] + byte] = (padded[longer] >> np.uint32(8 * byte)).astype(np.uint8)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The `count` values that `encode` was given."""
    groups = np.frombuffer(control, np.uint8)
    held = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)))
    sums = _SUMS[groups]
    at = ((np.cumsum(sums) - sums)[:, None] + _STARTS[groups]).ravel()[:count]
    lengths = _LENGTHS[groups].ravel()[:count]
    values = held[at].astype(np.uint32)
    for byte in range(1, 4):
        longer = np.flatnonzero(lengths > byte)
        values[longer] |= held[at[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


class _Mapped(dict):
    """Code point -> what the tokenizer's byte-level step makes of it."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        super().__init__()
        self.step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = self.step.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class _Words(dict):
    """Word -> its ids, which are asked for when it is met first."""

    def __init__(self, ids_of):
        super().__init__({"": b""})
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.ids_of(word)
        return ids


class Encoder:
    """Token ids of whole texts.

    Where the tokenizer drops white space before it looks at anything else, a text's ids are those of
    its words, and words are remembered.  Words of Latin letters between punctuation are cut into these
    three, which such a tokenizer never joins, and its model is asked for each; all other words go
    through the whole tokenizer.  Other tokenizers get whole texts.
    """

    #: The steps of tokenizers whose words can be encoded one by one.
    BY_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    NORMALIZED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    _PUNCTUATION = r"[!-&(-/:;=?@\[-`{}~]*"
    _PARTS = re.compile(rf"({_PUNCTUATION})([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)({_PUNCTUATION})")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.typecode = "H" if self.kind is np.uint16 else "I"
        self.words = _Words(self._word)
        self.mapped = _Mapped()
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split = steps[0] if len(steps) == 2 else {}
        normal = (spec.get("normalizer") or {}).get("normalizers")
        self.by_word = split.get("behavior") == "Removed" and split.get("invert") is True and split.get("pattern") == {"Regex": self.BY_WORD} and steps[1].get("type") == "ByteLevel" and steps[1].get("use_regex") is False and normal == self.NORMALIZED

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        found = self.words.get(part)  # a part is a word, too
        if found is None:
            plain = part if part.isascii() else part.translate(self.mapped)
            found = self.words[part] = array(self.typecode, [x.id for x in self.model.tokenize(plain)]).tobytes()
        return found

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._part(word.lower())
        found = self._PARTS.fullmatch(word)
        if not found:
            return self._ids([word])[0].tobytes()
        before, letters, after = found.groups()
        ids = self._part(letters.lower())
        return self._part(before) + ids + self._part(after) if before or after else ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return self._ids(texts)
        out = []
        for text in texts:
            # Only these four separate; other white space stays in its word and is the tokenizer's affair.
            words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(np.frombuffer(b"".join(map(self.words.__getitem__, words)), self.kind))
            if len(self.words) > REMEMBERED:
                self.words = _Words(self._word)
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each worker process, kept from task to task."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _tokens(path: str, end_id: int, id_type: pa.DataType):
    """Ordered batches of (id, text) -> blocks of raw ids, numbered within the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        seq, start, ids, lengths, held, count = 0, 0, [], [], [], 0
        seen = np.zeros(max(encoder.tokenizer.get_vocab_size(), end_id + 1), np.int64)

        def block(last: bool = False) -> pa.RecordBatch:
            nonlocal seen
            flat = np.concatenate(held)
            narrow = flat.astype(np.uint16) if encoder.kind is np.uint16 and end_id < 1 << 16 else flat
            seen += np.bincount(flat, minlength=seen.size)
            fields = [pa.array([x], pa.int64()) for x in (part, seq, start, count)] + [pa.array([ids], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([narrow.tobytes()], pa.binary()), pa.array([narrow.itemsize], pa.int64())]
            # A range's last block also says how often each token occurs in the range.
            fields.append(pa.array([seen.tobytes() if last else None], pa.binary()))
            return pa.RecordBatch.from_arrays(fields, ["part", "seq", "start", "n", "ids", "lengths", "raw", "width", "seen"])

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for id_, found in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                if count >= BLOCK_TOKENS:
                    yield block()
                    seq, start, ids, lengths, held, count = seq + 1, start + count, [], [], [], 0
                ids.append(id_)
                lengths.append(found.size + 1)
                held += [found, end]
                count += found.size + 1
        if ids:
            yield block(last=True)

    return run


_RAW = "part long, seq long, start long, n long, ids array<{id}>, lengths array<long>, raw binary, width long, seen binary"
_BLOCK = "part long, seq long, start long, n long, ids array<{id}>, lengths array<long>, control binary, data binary"


def _raw(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if width == 2 else np.uint32)


def _summed(table: pa.Table) -> pa.Table:
    """Token counts of some ranges -> their sum."""
    total = np.sum([np.frombuffer(x, np.int64) for x in table.column("seen").to_pylist()], axis=0)
    return pa.table([pa.array([total.tobytes()], pa.binary())], names=["seen"])


def _encoded(rank_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [encode(rank_of[_raw(raw, width)]) for raw, width in zip(batch.column("raw").to_pylist(), batch.column("width").to_pylist())]
            kept = [batch.column(c) for c in ("part", "seq", "start", "n", "ids", "lengths")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())], ["part", "seq", "start", "n", "ids", "lengths", "control", "data"])

    return run


def write_tokens(df: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Write the file set of `df` to `folder`: every row's token ids and `end_id`, by ascending id.

    Null ids come first; rows of one id are ordered by a hash of their texts, equal rows are
    interchangeable.  A null text is empty: its one id is the end.  An empty table writes empty tables.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    id_field = df.schema[id_col].dataType
    kind = id_field.simpleString()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    size = rows.agg(F.sum(F.octet_length("t") + 1)).collect()[0][0] or 0
    # A frequent id is cut by what follows it.
    order = [F.col("id"), F.col("tie"), F.col("row")]
    rows = rows.withColumn("tie", F.xxhash64("t")).withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(min(MAX_RANGES, max(1, -(-size // RANGE_BYTES))), *order).sortWithinPartitions(*order)
    raw = written(ranged.select("id", "t").mapInArrow(_tokens(tokenizer, end_id, to_arrow_type(id_field)), _RAW.format(id=kind)), "tokens")
    sums = raw.where("seen is not null").select(F.expr(f"part div {RANGES_SUMMED}").alias("some"), "seen").groupBy("some").applyInArrow(_summed, "seen binary")
    # A vocabulary's counts for each RANGES_SUMMED ranges, so MAX_RANGES / RANGES_SUMMED rows at most.
    found = [np.frombuffer(x, np.int64) for x in sums.toArrow().column("seen").to_pylist()]
    total = np.sum(found, axis=0) if found else np.zeros(1, np.int64)
    tokens = np.flatnonzero(total)
    tokens = tokens[np.lexsort((tokens, -total[tokens]))]
    rank_of = np.zeros(int(tokens.max(initial=0)) + 1, np.uint32)
    rank_of[tokens] = np.arange(tokens.size, dtype=np.uint32)
    raw.drop("seen").mapInArrow(_encoded(rank_of), _BLOCK.format(id=kind)).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    spark.createDataFrame(pa.table([pa.array(np.arange(tokens.size)), pa.array(tokens)], names=["rank", "token"])).write.parquet(f"{folder}/ranks")


def read_tokens(spark, folder: str, digest_only: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document of a file set; without `ids` on request.

    start counts the ids of all documents before it.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    ranks = spark.read.parquet(f"{folder}/ranks").toArrow()
    token_of = np.zeros(ranks.num_rows, "<u4")
    token_of[ranks.column("rank").to_numpy()] = ranks.column("token").to_numpy()
    id_kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = token_of[decode(row["control"], row["data"], row["n"])]
                ends = np.cumsum(row["lengths"])
                starts = ends - np.array(row["lengths"])
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [batch.schema.field("ids").type.value_type, pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                values = [row["ids"], [row["part"]] * len(crcs), starts + row["start"], row["lengths"], crcs]
                arrays = [pa.array(v, t) for v, t in zip(values, columns)]
                if not digest_only:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])

    schema = f"doc_id {id_kind}, part long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    docs = blocks.mapInArrow(run, schema)
    parts = running_bases(blocks.groupBy("part").agg(F.sum("n").alias("n")), [], "part", "n").select("part", "base")
    return docs.join(parts, "part").withColumn("start", F.col("start") + F.col("base")).drop("part", "base")


def encoded(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write `df` to a new folder in the shared one, and read the files' digests back."""
    folder = scratch_path(df.sparkSession, "token-files")
    write_tokens(df, tokenizer, folder, id_col, text_col, end_id)
    return read_tokens(df.sparkSession, folder, digest_only=True).withColumnRenamed("doc_id", id_col)
