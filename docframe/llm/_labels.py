"""A bounded, seeded sample of labelled texts, and training on it in one executor task.

Defined results: rows of labels that repeat a doc_id and agree count once, a doc_id whose rows disagree is left
out; of several texts of one doc_id the first in order is learned; null, empty and longer texts are left out
whole, never cut."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm._io import cut, fold_of
from docframe.llm._words import lean


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int, held_fold: int = 0, folds: int = 5) -> DataFrame:
    """_id, _text, _label of at most per_class rows of each class outside the held-out fold, of texts of 1 to
    most_chars code points. Rows are chosen by a hash of doc_id; the ids (2 x per_class at most) are fixed
    first, so only the chosen texts move."""
    learn = labels.where(F.col(label).isin(0, 1) & (fold_of(F.col("doc_id"), folds) != held_fold)).select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
    learn = learn.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).where("_label = _most").drop("_most")
    texts = docs.where(F.length("text").between(1, most_chars)).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    pool = cut(learn.join(texts.select("_id"), "_id", "left_semi"), "labelled")
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = [pool.where(F.col("_label") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    met = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id")
    return met.groupBy("_id", "_label").agg(F.min("_text").alias("_text")).select("_id", "_text", "_label")


def trained(sample: DataFrame, fit: Callable[[list[str], list[int]], bytes | None]) -> bytes | None:
    """What fit makes of the sample's texts and labels, in the order of their ids: one task on an executor holds the
    sample, and only the parameters, whose size is fixed, come to the driver. None without texts of both classes."""

    def run(batches):
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        if len({r[2] for r in rows}) == 2:
            yield pa.RecordBatch.from_arrays([pa.array([fit([r[1] for r in rows], [r[2] for r in rows])], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(lean(run), "model binary").collect()
    return bytes(found[0].model) if found else None
