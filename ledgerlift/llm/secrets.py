"""Secret scans: candidate spans in texts, judged by how many repositories and owners share a value.

Three fixed patterns give the base spans, which always stay.  A wider pattern gives opaque values
(long mixed runs of characters).  Values are hashed, and distinct owners and repositories are
counted per hash over the whole corpus: a value that many owners share is a copied example, one
that belongs to few and looks random, or that somebody also assigned to a password, is a live
credential and its span is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import whole_row, written

KINDS = ("assign", "access", "hex", "opaque")
#: The patterns of the base spans, with the least length of what they must hold.
_WORDS = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile("(" + re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", _WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # whole runs: a shorter one fails wherever it starts
LEAST = {"assign": 12, "access": 18}
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_ENTROPY = 3.5
#: A value of more owners, or of more repositories, than this is an example.
MAX_OWNERS, MAX_REPOS = 2, 16
MASK = "<secret>"


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, start of the value, its end), ordered by start, then kind."""
    found = [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def looks_random(value: str) -> bool:
    """Letters of both cases or with digits, and many different characters for its length."""
    if sum(map(any, ((c.isdigit() for c in value), (c.isupper() for c in value), (c.islower() for c in value)))) < 2:
        return False
    counts = Counter(value)
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values()) >= MIN_ENTROPY


def _opaque(text: str, base: list[tuple[int, int, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Opaque runs that base spans do not cover altogether: a part of a credential is not all of it."""
    covered: list[list[int]] = []  # stretches of base spans, in order
    for start, _, end, _, _ in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    at = 0
    for m in OPAQUE.finditer(text):
        while at < len(covered) and covered[at][1] < m.end():
            at += 1
        if at == len(covered) or covered[at][0] > m.start():
            yield m.start(), m.end()


def _named(kind: int, start: int, end: int) -> str:
    return f"{KINDS[kind]}:{start}:{end}"


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("h", pa.string()), ("random", pa.bool_())])
_SCANNED = "n_assign long, n_access long, n_hex long, base_sha256 string, found array<struct<start:long,kind:int,end:long,h:string,random:boolean>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans = [], [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            base = base_spans(text)
            counts.append([sum(s[1] == k for s in base) for k in range(3)])
            digests.append(hashlib.sha256(",".join(_named(k, a, b) for a, k, b, _, _ in base).encode()).hexdigest())
            whole = [(a, k, b, text[x:y]) for a, k, b, x, y in base] + [(a, 3, b, text[a:b]) for a, b in _opaque(text, base)]
            spans.append([(a, k, b, hashlib.sha256(v.encode("utf-8", "replace")).hexdigest()[:32], looks_random(v)) for a, k, b, v in whole])
        made = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
        spans = [[dict(zip(("start", "kind", "end", "h", "random"), s)) for s in doc] for doc in spans]
        arrays = [batch.column(i) for i in range(batch.num_columns - 1)] + [*made, pa.array(digests, pa.string()), pa.array(spans, pa.list_(_SPAN))]
        yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])


def owner_of(repository: Column) -> Column:
    """What stands before the first slash of a repository's name, or all of it."""
    return F.substring_index(repository, "/", 1)


def _text(df: DataFrame, text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source") -> DataFrame:
    """A row for each row of `df`: the id, counts and digest of the base spans, all spans and verdicts.

    A null text counts as empty.  A null repository is no owner: its value counts as owner-specific
    unless others share it.  Rows that agree in id and text are scanned alike, however often they
    occur; an empty table gives an empty result.  Columns of `df` beside the three don't matter.
    ``spans`` holds base and added spans; ``live`` and ``examples`` count spans of values that few and
    that many owners or repositories share; ``owners`` and ``repos`` are those of its most shared value.
    """
    text = _text(df, text_col)
    inner = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"), F.col(f"`{repo_col}`").cast("string").alias("repo"), text.alias("t"))
    kind = df.schema[id_col].dataType.simpleString()
    names = ["id", "key", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "found"]
    fields = [f"{n} {t}" for n, t in zip(names, (kind, "long", "string"))]
    rows = written(inner.mapInArrow(_scan, ", ".join([*fields, _SCANNED])), "secrets")
    spans = rows.where(F.size("found") > 0).select("id", "key", "repo", F.explode("found").alias("s"))
    shared = spans.groupBy(F.col("s.h").alias("h"), "repo").agg(F.max(F.col("s.kind") < 2).alias("assigned")).withColumn("owner", owner_of(F.col("repo")))
    verdict = shared.groupBy("h").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repo").alias("repos"), F.max("assigned").alias("assigned"))
    example = (F.col("owners") > MAX_OWNERS) | (F.col("repos") > MAX_REPOS)
    added = (F.col("s.kind") == 3) & ~example & (F.col("s.random") | F.col("assigned"))
    judged = (
        spans.withColumn("h", F.col("s.h"))
        .join(verdict, "h")
        .where((F.col("s.kind") < 3) | added)
        .groupBy("id", "key")
        .agg(F.collect_set(F.struct("s.start", "s.kind", "s.end", example.alias("example"))).alias("kept"), F.max("owners").alias("owners"), F.max("repos").alias("repos"))
    )
    joined = rows.drop("found", "repo").join(judged.withColumnsRenamed({"id": "id2", "key": "key2"}), F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2")), "left")
    kept = F.array_sort(F.coalesce("kept", F.expr("cast(array() as array<struct<start:long,kind:int,end:long,example:boolean>>)")))
    word = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return joined.select(
        F.col("id").alias(id_col),
        "key",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.array_join(F.transform(kept, word), ",").alias("spans"),
        F.size(F.filter(kept, lambda s: ~s["example"])).cast("long").alias("live"),
        F.size(F.filter(kept, lambda s: s["example"])).cast("long").alias("examples"),
        F.coalesce("owners", F.lit(0)).cast("long").alias("owners"),
        F.coalesce("repos", F.lit(0)).cast("long").alias("repos"),
    )


def masked(text: str, spans: str) -> str:
    """`text` with the values of its spans replaced; an assigned value goes, its name stays."""
    cuts = {(a, b) for _, _, _, a, b in base_spans(text)}
    cuts |= {(int(a), int(b)) for kind, a, b in (s.split(":") for s in spans.split(",") if s) if kind == KINDS[3]}
    parts, at = [], 0
    for a, b in sorted(cuts):
        if a >= at:
            parts += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source") -> DataFrame:
    """`df` with every found secret masked in the text and ``n_chars``, if there, counted anew; no row goes.

    Null, empty and long texts are as in `scanned`; a text without secrets stays as it is.  Rows that agree
    in id and text are masked alike, as often as they occur.  Columns keep their values whatever their
    names; an empty table gives an empty result.
    """
    found = scanned(df, id_col, text_col, repo_col).where("spans <> ''")
    found = found.select(F.col(f"`{id_col}`").alias("id"), "key", "spans").distinct()
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.xxhash64(_text(df, text_col)).alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"), whole_row(df).alias("row"))
    joined = rows.join(found, F.col("i").eqNullSafe(F.col("id")) & (F.col("k") == F.col("key")), "left")

    @F.pandas_udf("string")
    def mask(texts, spans):
        return texts.combine(spans, lambda t, s: masked(t, s) if s else t)

    # Few texts hold a secret; only those go to Python.
    clean = joined.where("spans is null").select("row.*")
    dirty = joined.where("spans is not null").withColumn("t", mask(F.col("t"), F.col("spans")))
    row = F.col("row").withField(f"`{text_col}`", F.col("t"))
    if "n_chars" in df.columns:
        row = row.withField("n_chars", F.length("t").cast(df.schema["n_chars"].dataType))
    return clean.union(dirty.select(row.alias("row")).select("row.*"))
