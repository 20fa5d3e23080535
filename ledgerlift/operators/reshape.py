"""Wide attachment pairs to long rows, in one pass over the input."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.numbers import whole_number
from ledgerlift.functions.text import clean
from ledgerlift.session import empty_table


class Pair(NamedTuple):
    id_col: str | None
    file_col: str
    label: str


def detect_pairs(columns: Sequence[str]) -> list[Pair]:
    """Pair every ``*filename`` column with its id column: base, base_id, or base without `_`."""
    present, pairs = set(columns), []
    for name in columns:
        if not name.lower().endswith("filename"):
            continue
        base = name[: -len("filename")]
        candidates = [base, f"{base}_id", base.rstrip("_")]
        pairs.append(Pair(next((c for c in candidates if c and c in present), None), name, base.upper()))
    return pairs


def unpivot_pairs(
    df: DataFrame,
    pairs: Sequence[Pair],
    carry: Sequence[str],
    need_id: bool = True,
    fixed_order: bool = False,
    dialect: str = "application",
) -> DataFrame:
    """One row per surviving pair: carried columns, ``document_name``, ``file_name``,
    ``documents_order``, ``logic_doc_id`` and the id cell as text, ``id_text``.

    A pair survives with a file name and, if `need_id`, a whole-number id.  The order counts
    surviving pairs of the row in `pairs` order; with `fixed_order` it is the position in
    `pairs`.  Everything happens inside the row, so there is no shuffle and no union per pair.
    """
    present = set(df.columns)
    usable = [
        (position, pair)
        for position, pair in enumerate(pairs, start=1)
        if pair.file_col in present and (pair.id_col in present or not need_id)
    ]
    if not usable:
        empty = "document_name string, file_name string, documents_order int, logic_doc_id bigint, id_text string"
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carry).schema.fields]
        return empty_table(df.sparkSession, ", ".join([*fields, empty]))
    # The cells of all pairs go into one array whose per-element work is a lambda, so the
    # generated code does not grow with the number of pairs.
    cells = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(pair.label).alias("label"),
                F.col(pair.file_col).cast("string").alias("file"),
                (F.col(pair.id_col).cast("string") if pair.id_col in present else F.lit(None).cast("string")).alias("id"),
            )
            for position, pair in usable
        ]
    )
    cleaned = F.transform(
        cells,
        lambda x: F.struct(
            x["position"].alias("position"),
            x["label"].alias("label"),
            clean(x["file"], dialect).alias("file"),
            clean(x["id"], dialect).alias("text"),
            whole_number(clean(x["id"], dialect)).alias("id"),
        ),
    )
    kept = F.filter(cleaned, lambda x: x["file"].isNotNull() & (x["id"].isNotNull() | F.lit(not need_id)))
    rows = df.select(*carry, F.posexplode(kept).alias("__i", "__x"))
    order = F.col("__x.position") if fixed_order else F.col("__i") + 1
    return rows.select(
        *carry,
        F.col("__x.label").alias("document_name"),
        F.col("__x.file").alias("file_name"),
        order.cast("int").alias("documents_order"),
        F.col("__x.id").alias("logic_doc_id"),
        F.col("__x.text").alias("id_text"),
    )
