"""Plug a user model in as a detector (Arrow-batched ``mapInPandas``).

A detector is a function ``pandas.DataFrame(item_id, text) -> DataFrame
(item_id, raw_type, confidence)``.  It runs once per Arrow batch, so a model
is loaded once per Python worker, not per row.  An exception in a batch
turns every row of that batch into ``kind = 'error'`` rows, which flow to
the fail-mode policy instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_blank
from .gates import gate_size

CUSTOM_SCHEMA = "item_id long, raw_type string, confidence double, kind string, message string"


def custom_detector(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    id_col: str = "item_id", text: str = "text",
                    max_chars: int | None = None) -> DataFrame:
    """Run ``fn`` over ``(item_id, text)`` batches; rows: findings or errors.

    Blank texts have nothing to scan and never reach Python: a ``filter``, as
    a ``CASE WHEN`` would still send the rows.  With ``max_chars`` the caller's
    size gate answers longer texts with a ``size_limit_exceeded`` row of kind
    ``gate``; without it every text is scanned.  A batch on which ``fn`` fails
    is tried again in halves, so that only the rows at fault become errors
    however rows fall into batches; an id that ``fn`` was not given is a fault.
    """

    def answer(b: pd.DataFrame) -> pd.DataFrame:
        found = fn(b)
        if not set(found["item_id"]) <= set(b["item_id"]):
            raise ValueError("the detector returned an id that it was not given")
        return pd.DataFrame({
            "item_id": found["item_id"].astype("int64"),
            "raw_type": found["raw_type"].astype(object),
            "confidence": found["confidence"].astype("float64"),
            "kind": "finding", "message": None})

    def halved(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        try:
            yield answer(b)
        except Exception as e:  # noqa: BLE001 -- becomes data, see module doc
            if len(b) > 1:
                yield from halved(b.iloc[: len(b) // 2])
                yield from halved(b.iloc[len(b) // 2:])
            else:
                yield pd.DataFrame({"item_id": b["item_id"].astype("int64"), "raw_type": None, "confidence": float("nan"),
                                    "kind": "error", "message": f"{type(e).__name__}: {e}"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield from halved(b)

    rows = df.select(F.col(id_col).alias("item_id"), F.col(text).alias("text"))
    rows = rows.where(~F.coalesce(is_blank(F.col("text")), F.lit(True)))
    if max_chars is None:
        return rows.mapInPandas(run, CUSTOM_SCHEMA)
    gated = gate_size(rows, "text", max_chars=max_chars).where("oversize").select(
        F.col("item_id").cast("long"), F.col("size_threat_type").alias("raw_type"), F.col("size_confidence").alias("confidence"),
        F.lit("gate").alias("kind"), F.col("size_reason").alias("message"))
    return rows.where(F.length("text") <= max_chars).mapInPandas(run, CUSTOM_SCHEMA).unionByName(gated)


# Example detector: shouting.  Flags texts whose ASCII letters are mostly
# upper case (at least 20 letters, ratio >= 0.6) as hostile tonality.
SHOUT_MIN_LETTERS = 20
SHOUT_RATIO = 0.6


def shouting_detector(b: pd.DataFrame) -> pd.DataFrame:
    t = b["text"].fillna("")
    letters = t.str.count(r"[A-Za-z]")
    upper = t.str.count(r"[A-Z]")
    ratio = (upper / letters.where(letters > 0)).fillna(0.0)
    hit = (letters >= SHOUT_MIN_LETTERS) & (ratio >= SHOUT_RATIO)
    return pd.DataFrame({"item_id": b["item_id"][hit], "raw_type": "tonality_drift_hostile",
                         "confidence": ratio[hit].round(4)})


def plain_text_shouting(b: pd.DataFrame) -> pd.DataFrame:
    """The same for callers whose texts must not be markup: it fails on some."""
    if b["text"].str.contains("<?php", regex=False).any():
        raise ValueError("markup")
    return shouting_detector(b)
