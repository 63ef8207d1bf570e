"""The other cropping mode: markers are parts of short lines, a document without a start is all theory, and plain lines
become headings by how they begin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.text import fold
from docframe.operators import render
from docframe.operators import structure as S
from docframe.plans import config


def relevel(text: Column, folded: Column) -> Column:
    """H2 to H5 for a line that begins like a heading of that level, P for any other; lines of no or over 250 bytes are
    left as they are."""
    size = F.octet_length(folded)
    patterns = dict(config.CROP_HEADINGS)
    out = F.when((size == 0) | (size > 250), "P").when(text.rlike(patterns["H2"]) | folded.rlike(config.MAJOR), "H2")
    for tag in ("H3", "H4", "H5"):
        out = out.when(text.rlike(patterns[tag]), tag)
    return out.otherwise("P")


def crop(blocks: DataFrame, key: str = "doc_id", idx: str = "block_idx", text: str = "text") -> DataFrame:
    """The theory's blocks: after the first start up to the first end after it, or all if there is no start."""
    folded = fold(F.col(text))
    short = F.octet_length(folded) <= 100
    limits = S.bounds(blocks, short & folded.rlike(config.CROP_START), short & folded.rlike(config.CROP_END), key, idx)
    met = blocks.join(limits.select(key, "first", "last"), key)
    inside = F.col("first").isNull() | ((F.col(idx) > F.col("first")) & (F.col("last").isNull() | (F.col(idx) < F.col("last"))))
    return met.where(inside).drop("first", "last")


def outline(blocks: DataFrame, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """key, idx, tag, text of the cropped blocks; a bullet's mark is taken off."""
    kept = crop(blocks, key, idx)
    bullet = F.col("text").rlike(render.BULLET)
    tag = F.when(bullet, "LI").otherwise(relevel(F.col("text"), fold(F.col("text"))))
    return kept.select(key, idx, tag.alias("tag"), F.when(bullet, F.trim(render.clean_bullet(F.col("text")))).otherwise(F.col("text")).alias("text"))


def outline_html(rows: DataFrame, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """key, html of outlines, lists kept together."""
    runs = S.runs_of(rows, F.col("tag") == "LI", "run", key, idx)
    items = F.transform(F.array_sort(F.collect_list(F.struct(idx, "tag", "text"))), lambda v: F.concat(F.lit("<"), F.lower(v["tag"]), F.lit(">"), render.html_escape(v["text"]), F.lit("</"), F.lower(v["tag"]), F.lit(">")))
    body = runs.groupBy(key, "run").agg(F.max(F.col("tag") == "LI").alias("_l"), F.array_join(items, "\n").alias("_h"))
    wrapped = F.when(F.col("_l"), F.concat(F.lit("<ul>\n"), F.col("_h"), F.lit("\n</ul>"))).otherwise(F.col("_h"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("run", wrapped.alias("_h")))), lambda v: v["_h"])
    return body.groupBy(key).agg(F.array_join(ordered, "\n").alias("html"))
