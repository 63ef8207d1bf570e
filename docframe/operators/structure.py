"""Structure over ordered blocks: slices between markers, levels, section trees, runs. All windows are within a
document; nothing moves but the blocks, once, by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.plans.config import LADDER

DEPTH = 6
NEVER = -(1 << 62)


def bounds(blocks: DataFrame, start: Column, end: Column, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """(key, first, last, n_starts, flags) of each document: the first start, the first end after it that is no
    start itself, the starts before that end."""
    marked = blocks.select(key, F.col(idx).alias("_i"), start.alias("_s"), (end & ~start).alias("_e"))
    seen = Window.partitionBy(key)
    marked = marked.withColumn("first", F.min(F.when(F.col("_s"), F.col("_i"))).over(seen))
    marked = marked.withColumn("last", F.min(F.when(F.col("_e") & (F.col("_i") > F.col("first")), F.col("_i"))).over(seen))
    before = F.col("_s") & (F.col("_i") < F.coalesce("last", F.lit((1 << 62))))
    out = marked.groupBy(key).agg(F.min("first").alias("first"), F.min("last").alias("last"), F.count_if(before).alias("n_starts"))
    flags = F.array_compact(
        F.array(
            F.when(F.col("first").isNull(), F.lit("THEORY_START_NOT_FOUND")),
            F.when(F.col("n_starts") > 1, F.concat(F.lit("MULTIPLE_THEORY_HEADERS:"), F.col("n_starts"))),
            F.when(F.col("first").isNotNull() & F.col("last").isNull(), F.lit("THEORY_END_NOT_FOUND")),
        )
    )
    return out.withColumn("flags", F.array_join(flags, ","))


def sliced(blocks: DataFrame, start: Column, end: Column, part: str, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """between of bounds in one exchange: each block learns its document's limits from a window and stays or goes."""
    seen = Window.partitionBy(key)
    marked = blocks.withColumn("_s", start).withColumn("_e", end & ~start)
    marked = marked.withColumn("_first", F.min(F.when(F.col("_s"), F.col(idx))).over(seen))
    marked = marked.withColumn("_last", F.min(F.when(F.col("_e") & (F.col(idx) > F.col("_first")), F.col(idx))).over(seen))
    inside = (F.col(idx) > F.col("_first")) & (F.col("_last").isNull() | (F.col(idx) < F.col("_last")))
    return marked.where(inside if part == "theory" else F.col(idx) > F.col("_last")).drop("_s", "_e", "_first", "_last")


def between(blocks: DataFrame, limits: DataFrame, part: str, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """The blocks of the theory (after the start, before the end) or of the exercises (from the end on)."""
    met = blocks.join(limits.select(key, "first", "last"), key)
    inside = (F.col(idx) > F.col("first")) & (F.col("last").isNull() | (F.col(idx) < F.col("last")))
    return met.where(inside if part == "theory" else F.col(idx) > F.col("last")).drop("first", "last")


def ladder(blocks: DataFrame, kind: Column, key: str = "doc_id") -> DataFrame:
    """(key, kind, level): the numeral kinds that a document uses, at contiguous levels from 1."""
    rank = F.array_position(F.array(*[F.lit(k) for k in LADDER]), kind)
    used = blocks.select(key, kind.alias("kind"), rank.alias("_r")).where(F.col("kind").isNotNull()).distinct()
    return used.select(key, "kind", F.dense_rank().over(Window.partitionBy(key).orderBy("_r")).cast("long").alias("level"))


def tree(headings: DataFrame, key: str = "doc_id", idx: str = "block_idx", depth: int = DEPTH) -> DataFrame:
    """headings (with level) plus parent_idx (null: a root), ord (from 1 among siblings) and path.

    A heading's ancestor at level k is the last level-k heading before it, if no heading above level k came in
    between; its parent is the latest of all headings above its own level. Both are last values of one window."""
    before = Window.partitionBy(key).orderBy(idx).rowsBetween(Window.unboundedPreceding, -1)
    last = {k: F.last(F.when(F.col("level") == k, F.col(idx)), ignorenulls=True).over(before).alias(f"_l{k}") for k in range(1, depth)}
    found = headings.select("*", *last.values())
    above = [F.when(F.col("level") > k, F.col(f"_l{k}")) for k in last]
    found = found.withColumn("parent_idx", F.greatest(*above, F.lit(None).cast("long")))
    siblings = Window.partitionBy(key, "parent_idx").orderBy(idx)
    found = found.withColumn("ord", F.row_number().over(siblings).cast("long"))
    orders = [F.last(F.when(F.col("level") == k, F.col("ord")), ignorenulls=True).over(before).alias(f"_o{k}") for k in last]
    found = found.select("*", *orders)
    steps = []
    for k in last:
        higher = [F.coalesce(F.col(f"_l{j}"), F.lit(NEVER)) for j in range(1, k)]
        valid = (F.col("level") > k) & (F.col(f"_l{k}") > (F.greatest(*higher, F.lit(NEVER)) if higher else F.lit(NEVER)))
        steps.append(F.when(valid, F.col(f"_o{k}").cast("string")))
    found = found.withColumn("path", F.array_join(F.array_compact(F.array(*steps, F.col("ord").cast("string"))), "."))
    return found.drop(*[f"_l{k}" for k in last], *[f"_o{k}" for k in last])


def owner(blocks: DataFrame, is_heading: Column, key: str = "doc_id", idx: str = "block_idx") -> DataFrame:
    """blocks plus owner_idx: the heading at or before each, null before the first."""
    upto = Window.partitionBy(key).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("owner_idx", F.last(F.when(is_heading, F.col(idx)), ignorenulls=True).over(upto))


def as_of(rows: DataFrame, value: Column, name: str, key: str, *order: str) -> DataFrame:
    """rows plus the latest non-null value so far."""
    upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(upto))


def islands(rows: DataFrame, boundary: Column, name: str, key: str, *order: str) -> DataFrame:
    """rows plus a run number: it grows at each boundary row."""
    upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.coalesce(boundary, F.lit(False)).cast("long")).over(upto))


def runs_of(rows: DataFrame, value: Column, name: str, key: str, *order: str) -> DataFrame:
    """rows plus the number of the run of equal neighbouring values, from 1."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = ~value.eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    return islands(rows.withColumn("_new", changed), F.col("_new"), name, key, *order).drop("_new")


def split_soft_breaks(paragraphs: DataFrame, is_heading, key: str = "doc_id", idx: str = "block_idx", least: int = 2) -> DataFrame:
    """(key, idx, part, text): paragraphs whose lines hold at least `least` headings, line by line; others whole."""
    counted = paragraphs.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    counted = counted.withColumn("_n", F.size(F.filter("_lines", is_heading)))
    parts = F.when(F.col("_n") >= least, F.col("_lines")).otherwise(F.array("text"))
    return counted.select(key, idx, F.posexplode(parts).alias("part", "text")).withColumn("part", F.col("part").cast("long"))


def with_intro(headings: DataFrame, blocks: DataFrame, filled: Column, key: str = "doc_id", idx: str = "block_idx", title: str = "Nội dung") -> DataFrame:
    """headings (key, idx, level, title, ...) and a first node of level 1 for what stands before a document's first
    heading: without a title where that holds something, with the given one where the document has no heading and
    nothing but blank blocks. Its idx is -1."""
    first = headings.groupBy(key).agg(F.min(idx).alias("_first"))
    met = blocks.join(first, key, "left")
    before = F.count_if(filled & (F.col(idx) < F.coalesce("_first", F.lit(1 << 62))))
    found = met.groupBy(key).agg(before.alias("_n"), F.max("_first").alias("_first")).where("_n > 0 OR _first IS NULL")
    made = {key: F.col(key), idx: F.lit(-1).cast("long"), "level": F.lit(1).cast("long"), "title": F.when(F.col("_n") > 0, "").otherwise(title)}
    rest = [F.lit(None).cast(headings.schema[c].dataType).alias(c) for c in headings.columns if c not in made]
    return headings.unionByName(found.select(*[v.alias(k) for k, v in made.items()], *rest))


def dedup_first(rows: DataFrame, key: list[str], *order: str, name: str = "is_first") -> DataFrame:
    """rows plus whether each is the first of its key by the order given, which must tell a key's rows apart. A key's first
    row comes from partial minima, so a key that most rows share is no task's burden; nulls are a key too."""
    first = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.min(F.struct(*order)).alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    met = rows.join(first, same)
    return met.withColumn(name, F.struct(*order).eqNullSafe(F.col("_first"))).drop("_first", *[f"_k{i}" for i in range(len(key))])
