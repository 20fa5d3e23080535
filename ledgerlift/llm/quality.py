"""Quality classification by hierarchical empirical Bayes.

A logistic model of a text's form gives each document its evidence.  Means per host, and per path
within the host, are shrunk: a path's towards its host's, a host's towards the global one.  How hard
is estimated from the spread of the means themselves, by grouped aggregates.  A document's posterior
is its evidence with the prior of its path in place of the global one, the path's mean being taken
without the document itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

#: Distinct labelled texts, by their features, that the logistic model is fitted on, at most (by expectation of a hash sample).
LABELLED = 20_000
RIDGE, STEPS = 1e-3, 40
#: Bounds of the prior's weight in documents, and of a document's evidence in log odds.
WEIGHTS, EVIDENCE = (2.0, 10_000.0), 8.0
KEEP = 0.5
FEATURES = ("upper", "digits", "symbols", "stops", "length of words", "repeated words", "neighbours alike", "repeated lines", "words without letters", "log words")

_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """By code point: 0 space, 1 upper-case letter, 2 other letter, 3 digit, 4 full stop or comma, 5 symbol."""
    if not _CLASSES:
        kind = lambda c: 0 if c.isspace() else 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in ".," else 5
        _CLASSES.append(np.fromiter((kind(chr(i)) for i in range(0x110000)), np.uint8, 0x110000))
    return _CLASSES[0]


def features(text: str | None) -> list[float] | None:
    """Numbers that describe the form of the whole text; None without words."""
    words = (text or "").split()
    if not words:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    counts = np.bincount(_classes()[codes], minlength=6)
    inked = max(1, int(counts[1:].sum()))
    lines = [x for x in text.split("\n") if x.strip()]
    n = len(words)
    alike = sum(a == b for a, b in zip(words, words[1:])) / n
    bare = sum(not w.isalnum() and not any(map(str.isalnum, w)) for w in words) / n
    return [counts[1] / inked, counts[3] / inked, counts[5] / inked, counts[4] / inked, min(20.0, inked / n), 1 - len(set(words)) / n, alike, 1 - len(set(lines)) / max(1, len(lines)), bare, float(np.log(n))]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.float64()))], ["id", "host", "path", "x"])


def _fit(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the constant last, means, scales) of a ridge logistic regression, by Newton steps; a row counts `times`."""
    share = times[:, None] / times.sum()
    mean = (x * share).sum(0)
    scale = np.maximum(np.sqrt(((x - mean) ** 2 * share).sum(0)), 1e-6)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], RIDGE * times.sum())
    penalty[-1] = 0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (times * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(penalty + 1e-6)
        step = np.linalg.solve(h, z.T @ (times * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def held_out(doc_id: Column) -> Column:
    """True for labelled rows that the model doesn't learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 2, F.lit(False))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _weight(groups: DataFrame, total: str, n: str, centre: Column) -> float:
    """How many documents the prior of the groups' means counts for, by the method of moments."""
    mean, prior = F.col(total) / F.col(n), centre
    row = groups.agg(F.sum(F.col(n) * (mean - prior) ** 2).alias("spread"), F.sum(prior * (1 - prior)).alias("noise"), F.sum(F.col(n)).alias("n"), F.sum(F.col(n) * prior * (1 - prior)).alias("var")).collect()[0]
    if not row["n"] or not row["var"]:
        return WEIGHTS[1]
    between = (row["spread"] - row["noise"]) / row["n"]
    return min(WEIGHTS[1], max(WEIGHTS[0], row["var"] / row["n"] / max(between, 1e-9) - 1))


def classified(df: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """A row for each row of `df`: id, held_out, p_text, p_host, p_path, p_quality, keep.

    `labels` has 0/1 by id; nulls are ignored, repeated labels of an id are averaged.  Texts without
    words have p_text 0 and aren't kept.  Null hosts and paths are sites like any other.  Without labels
    the evidence says nothing, and all texts with words are kept.  Repeated rows count and come out as
    often as they occur; an empty table gives an empty result.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(f"`{text_col}`").cast("string").alias("t"))
    seen = written(rows.mapInArrow(_described, f"id {kind}, host string, path string, x array<double>"), "quality-features")
    known = labels.where(f"`{label_col}` is not null and `{label_id}` is not null").groupBy(F.col(f"`{label_id}`").alias("label_id")).agg(F.avg(label_col).alias("label"))
    joined = written(seen.join(known, F.col("id") == F.col("label_id"), "left").drop("label_id").withColumn("held_out", held_out(F.col("id"))), "quality-labelled")
    usable = joined.where("label is not null and x is not null and not held_out").groupBy("x", "label").agg(F.count(F.lit(1)).alias("times"))
    usable = written(usable, "quality-usable")
    share = min(1.0, LABELLED / max(1, usable.count()))
    sample = usable.where(F.pmod(F.xxhash64("x", "label"), F.lit(1_000_003)) < share * 1_000_003).orderBy("x", "label").toArrow()
    if sample.num_rows:
        w, mean, scale = _fit(np.array(sample.column("x").to_pylist()), sample.column("label").to_numpy(), sample.column("times").to_numpy().astype(float))
        score = F.lit(float(w[-1]))
        for i in range(len(FEATURES)):
            score = score + (F.col("x")[i] - float(mean[i])) * float(w[i] / scale[i])
    else:
        score = F.lit(0.0)
    evidence = F.least(F.greatest(score, F.lit(-EVIDENCE)), F.lit(EVIDENCE))
    p_text = F.when(F.col("x").isNull(), 0.0).otherwise(_sigmoid(evidence))
    # A label that the model may learn from is better evidence about a site than the model's guess.
    p_site = F.when(F.col("label").isNotNull() & ~F.col("held_out"), F.col("label")).otherwise(F.col("p_text"))
    judged = joined.withColumn("p_text", p_text).withColumn("p_site", p_site).drop("x", "label")
    paths = written(judged.groupBy("host", "path").agg(F.sum("p_site").alias("s"), F.count("*").cast("double").alias("n")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    whole = paths.agg(F.sum("s"), F.sum("n")).collect()[0]
    base = float(whole[0] / whole[1]) if whole[1] else 0.5
    host_weight = _weight(hosts, "hs", "hn", F.lit(base))
    p_host = (F.col("hs") + host_weight * base) / (F.col("hn") + host_weight)
    hosts = hosts.withColumn("p_host", p_host).withColumnRenamed("host", "host2")
    sites = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("host2"))).drop("host2"), "quality-sites")
    path_weight = _weight(sites, "s", "n", F.col("p_host"))
    # Both means are taken without the document: else it would be evidence for itself.
    own = F.col("p_site")
    out_host = (F.col("hs") - own + host_weight * base) / (F.col("hn") - 1 + host_weight)
    out_path = (F.col("s") - own + path_weight * F.col("out_host")) / (F.col("n") - 1 + path_weight)
    sites = sites.withColumnsRenamed({"host": "host2", "path": "path2"})
    full = judged.join(sites, F.col("host").eqNullSafe(F.col("host2")) & F.col("path").eqNullSafe(F.col("path2")))
    full = full.withColumn("out_host", out_host).withColumn("out_path", out_path)
    posterior = F.when(F.col("p_text") == 0, 0.0).otherwise(_sigmoid(_logit(F.col("p_text")) + _logit(F.col("out_path")) - F.lit(float(np.log(base / (1 - base)) if 0 < base < 1 else 0.0))))
    full = full.withColumn("p_quality", posterior)
    keep = (F.col("p_text") > 0) & (F.col("p_quality") >= KEEP) if sample.num_rows else F.col("p_text") > 0
    return full.select(F.col("id").alias(id_col), "held_out", "p_text", F.col("out_host").alias("p_host"), F.col("out_path").alias("p_path"), "p_quality", keep.alias("keep"))
