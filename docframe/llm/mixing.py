"""Mixing sources to target weights by capped water-filling (operator 8, native).

Sources, in code-point order with null last, take the cyclic weights; a source's target is min(epochs x its
size, level x weight) with the one level at which the targets sum to the whole. The level comes from one
ordered pass over the sources (one row each), which is where redistributing the excess again and again ends.
A target of k + f times its source's size is met by k whole repetitions of every document and a seeded
fractional one: documents fall into 4,096 digest buckets, whole buckets are taken in order while they fit,
and in the bucket at the edge every document gives the same part of its words.

Documents meet their source's figures by (source, bucket), so a source with a third of all rows is dealt to
4,096 places. Defined results: null text has size 0; sources of size 0 have target 0; rows that repeat a
doc_id are dealt with alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.llm._io import cut as written

SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def bucket_of(doc_id: Column, seed: int) -> Column:
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 3)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 3) -> DataFrame:
    """source, source_size -> the same with target. One row a source; ordered twice over all sources."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_weight", F.get(cycle, place % len(weights)))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(epochs)))
    everything = Window.partitionBy()
    by_room = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    levelled = ranked.withColumn("_level", level).withColumn("_fits", F.col("_level") <= F.col("_cap") / F.col("_weight"))
    final = F.max(F.when(F.col("_fits"), F.col("_level"))).over(everything)
    target = F.least("_cap", F.coalesce(final, F.lit(float("inf"))) * F.col("_weight"))
    return levelled.select("source", "source_size", target.alias("target"))


#: What assign() adds; columns of docs with these names are left out of its result.
OWN = ("_size", "_source_size", "_target", "_copies", "_part")


def _assigned(docs: DataFrame, weights: tuple[float, ...], epochs: float, seed: int) -> DataFrame:
    """row (all columns of docs in one), doc_id, source and OWN. Whatever docs' other columns are called, they stay
    inside row."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = whole.select("row", "row.doc_id", "row.source", word_count(F.col("row.text")).alias("_size"), bucket_of(F.col("row.doc_id"), seed).alias("_bucket"))
    bins = rows.groupBy("source", "_bucket").agg(F.sum("_size").alias("_words"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, epochs)
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    whole = F.floor(F.try_divide(F.col("target"), F.col("source_size")))
    placed = bins.join(t, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_whole", F.coalesce(whole, F.lit(0)).cast("long"))
    running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("target") - F.col("_whole") * F.col("source_size") - F.coalesce(F.sum("_words").over(running), F.lit(0))
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(rest, F.col("_words")), F.lit(0.0))))
    plan = placed.select("_s", F.col("_bucket").alias("_b"), "source_size", "target", "_whole", share.alias("_share"))
    met = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    full = F.col("_share") >= 1
    part = F.when(full, F.lit(0)).otherwise(F.floor(F.col("_size") * F.col("_share") + 0.5)).cast("long")
    return met.select(
        "row", "doc_id", "source", "_size", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        (F.col("_whole") + full.cast("long")).alias("_copies"), part.alias("_part"),
    )


def assign(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 3, seed: int = 8) -> DataFrame:
    """docs with _size, _source_size, _target, _copies (whole repetitions) and _part (words of one more)."""
    mine = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in OWN]
    return _assigned(docs, weights, epochs, seed).select(*mine, *OWN)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space between kept."""
    pieces = F.split(text, f"(?<=[^{SPACE}])(?=[{SPACE}])", -1)
    return F.array_join(F.slice(pieces, 1, F.greatest(n, F.lit(1)).cast("int")), "")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 3, seed: int = 8) -> DataFrame:
    """The mixed corpus with docs' columns: whole repetitions as repeated rows, a fractional one as a row whose
    text is cut to its words. Documents without words are in no repetition."""
    rows = _assigned(docs, weights, epochs, seed).where("_size > 0 AND _copies + _part > 0")
    times = F.sequence(F.lit(0), F.col("_copies") + (F.col("_part") > 0).cast("long") - 1)
    dealt = rows.withColumn("_turn", F.explode(times))
    last = (F.col("_turn") == F.col("_copies")) & (F.col("_part") > 0)
    text = F.when(last, first_words(F.col("row.text"), F.col("_part"))).otherwise(F.col("row.text"))
    changed = dealt.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("row", F.col("row").withField("n_chars", F.when(last, F.length("row.text").cast("long")).otherwise(F.col("row.n_chars"))))
    return changed.select("row.*")


def mix_whole(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 3, seed: int = 8) -> DataFrame:
    """The mixed corpus in whole documents: as mix, but the words of the bucket at the edge are given by whole
    documents in seeded order, the last one where half of it or more is asked for."""
    rows = written(_assigned(docs, weights, epochs, seed).where("_size > 0 AND _copies + _part > 0"), "mixed")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), F.xxhash64("row.text")
    source = Window.partitionBy("source")
    edge = rows.where("_part > 0").withColumn("_before", F.coalesce(F.sum("_size").over(source.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    more = (2 * F.col("_before") + F.col("_size") <= 2 * F.sum("_part").over(source)).cast("long")
    edge = edge.withColumn("_copies", F.col("_copies") + more).drop("_before")
    dealt = rows.where("_part = 0").unionByName(edge).where("_copies > 0")
    return dealt.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
