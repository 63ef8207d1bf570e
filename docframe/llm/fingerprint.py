"""Document fingerprints by a homomorphic multiset hash (operator 3, native).

A paragraph (a line of the text) is hashed to a wide vector: 8 lanes of 32 bits from four seeded 64-bit
hashes of the paragraph, and 64 lanes that count the set bits of the hashes of its three-word shingles (all its
words where it has fewer; a blank paragraph has none). A document's fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo 2**32, and its number of shingles. Sums commute, so paragraph order plays no part, and
paragraphs are inserted or deleted by adding or subtracting their vectors (insert, delete). The counting lanes,
centred, are random signs summed over the shingles, so their mean product estimates the inner product of two
documents' shingle multisets; likeness is that product x over (a + b - x), clipped to 0..1. A fingerprint's text
holds all lanes in full (lanes reads it back), so likeness follows from two fingerprints alone.

Defined results: null text is empty; the empty text has one empty paragraph; texts without words are alike (1) and
unlike any other (0); equal texts have equal fingerprints; rows that repeat both doc_id and text count as one document in the order of next documents and
are each returned; rows with one doc_id and several texts follow each other by text hash; a table's only
document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.llm._io import cut

SEEDS = (11, 23, 37, 53)
PAIRS = 32
_LOW = 0xFFFFFFFF
_BITS = 0x0000000100000001
SPACES = r"[\x20\x09-\x0D]+"
SHINGLE = 3


def _sums() -> list[Column]:
    """The vector's lanes summed: exact0-7 from rows that open a paragraph, count0-31 (two lanes each), units."""
    exact = []
    for i in range(len(SEEDS)):
        h = F.col(f"_p{i}")
        for j, half in enumerate((h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))):
            exact.append(F.sum(F.when(F.coalesce("_pos", F.lit(0)) == 0, half).otherwise(F.lit(0))).alias(f"exact{2 * i + j}"))
    counts = [F.coalesce(F.sum(F.shiftrightunsigned("_unit", i).bitwiseAND(F.lit(_BITS))), F.lit(0)).alias(f"count{i}") for i in range(PAIRS)]
    return [*exact, *counts, F.sum((F.col("_unit").isNotNull()).cast("long")).alias("units")]


def shingle_hashes(paragraph: Column) -> Column:
    def slide(found: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(found) - SHINGLE, F.lit(0)))
        units = F.transform(places, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(found) > 0, units)

    # Inside the inner lambda the words are a bound variable; a column there would be split anew for each place.
    return F.get(F.transform(F.array(F.filter(F.split(paragraph, SPACES), lambda w: w != "")), slide), F.lit(0))


def vectors(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Fingerprint lanes of each row's text. keys identify a row; where the input is clustered by some of
    them already, no exchange is added."""
    paragraphs = texts.select(*keys, F.explode(F.split(F.col(text), "\n")).alias("_par"))
    hashed = paragraphs.select(
        *keys, *[F.xxhash64(F.lit(s), "_par").alias(f"_p{i}") for i, s in enumerate(SEEDS)], F.posexplode_outer(shingle_hashes(F.col("_par"))).alias("_pos", "_unit")
    )
    sums = hashed.groupBy(*keys).agg(*_sums())
    exact = F.array(*[F.col(f"exact{i}").bitwiseAND(F.lit(_LOW)) for i in range(2 * len(SEEDS))])
    low = [F.col(f"count{i}").bitwiseAND(F.lit(_LOW)) for i in range(PAIRS)]
    high = [F.shiftrightunsigned(f"count{i}", 32) for i in range(PAIRS)]
    return sums.select(*keys, exact.alias("exact"), F.array(*low, *high).alias("counts"), "units")


def as_text(exact: Column, counts: Column, units: Column) -> Column:
    """The fingerprint as text: 8 lanes of 8 hex digits, the number of shingles, 64 lanes of 8 hex digits."""
    eight = lambda lanes: F.array_join(F.transform(lanes, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")
    return F.concat_ws("-", eight(exact), F.lower(F.hex(units)), eight(counts))


def lanes(fingerprint: Column) -> dict[str, Column]:
    """exact, counts and units of a fingerprint's text."""
    part = lambda i: F.get(F.split(fingerprint, "-"), F.lit(i))
    number = lambda digits: F.conv(digits, 16, 10).cast("long")
    many = lambda digits, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: number(F.substr(digits, i * 8 + 1, F.lit(8))))
    return {"exact": many(part(0), 2 * len(SEEDS)), "counts": many(part(2), 2 * PAIRS), "units": number(part(1))}


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """a + b or a - b lane by lane modulo 2**32: insertion or deletion of what b was hashed from."""
    return F.zip_with(a, b, lambda x, y: (x + y * sign).bitwiseAND(F.lit(_LOW)))


def insert(fingerprints: DataFrame, paragraphs: DataFrame, keys: list[str], sign: int = 1) -> DataFrame:
    """fingerprints (keys, exact, counts, units) after the paragraphs (keys, text: one row holds one or more, a line
    each) were added to their texts as lines. Texts without new paragraphs keep theirs; no text is read again."""
    more = vectors(paragraphs, keys).select(*keys, *[F.col(c).alias(f"_{c}") for c in ("exact", "counts", "units")])
    summed = [F.when(F.col("_units").isNull(), F.col(c)).otherwise(combine(F.col(c), F.col(f"_{c}"), sign)).alias(c) for c in ("exact", "counts")]
    return fingerprints.join(more, keys, "left").select(*keys, *summed, (F.col("units") + F.coalesce("_units", F.lit(0)) * sign).alias("units"))


def delete(fingerprints: DataFrame, paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """fingerprints after the paragraphs were taken out of their texts."""
    return insert(fingerprints, paragraphs, keys, -1)


def likeness(counts_a: Column, units_a: Column, counts_b: Column, units_b: Column) -> Column:
    """Estimated Tanimoto likeness of two shingle multisets from their fingerprints, 0 to 1."""
    a = F.transform(counts_a, lambda v: (v * 2 - units_a).cast("double"))
    b = F.transform(counts_b, lambda v: (v * 2 - units_b).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x, total = dot(a, b), dot(a, a) + dot(b, b)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(x, total - x), F.lit(1.0))))


def next_links(docs: DataFrame) -> DataFrame:
    """doc_id, _h, _k (a quarter of its code points), next_id, next_h for each distinct (doc_id, text).

    Only ids move: they are dealt out by ranges, linked inside a range, and the last of a range is linked to
    the first of the next range that has any; that list has one row a range."""
    ids = docs.groupBy("doc_id", "_h").agg(F.max(F.floor(F.length("text") / 4)).alias("_k"))
    ranged = ids.repartitionByRange(F.col("doc_id"), F.col("_h")).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range").orderBy("doc_id", "_h")
    linked = ranged.select(
        "*", F.row_number().over(inside).alias("_rn"), F.lead("doc_id").over(inside).alias("next_id"), F.lead("_h").over(inside).alias("next_h")
    )
    linked = cut(linked, "next-links")
    heads = linked.where("_rn = 1").select(F.col("_range").alias("_from"), F.col("doc_id").alias("head_id"), F.col("_h").alias("head_h"))
    order = Window.orderBy("_from")
    heads = heads.select(
        F.coalesce(F.lag("_from").over(order), F.max("_from").over(Window.partitionBy())).alias("_range"), "head_id", "head_h"
    )
    inner = linked.where(F.col("next_h").isNotNull()).select("doc_id", "_h", "_k", "next_id", "next_h")
    ends = linked.where(F.col("next_h").isNull()).join(heads, "_range")
    return inner.unionByName(ends.select("doc_id", "_h", "_k", F.col("head_id").alias("next_id"), F.col("head_h").alias("next_h")))


def edited_texts(docs: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text) with _h, _row, edited, next_id, next_h. Texts move once, their borrowed
    beginnings once more."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base = base.withColumn("_h", F.xxhash64("text"))
    links = cut(next_links(base), "edit-links")
    same = Window.partitionBy("doc_id", "_h").orderBy(F.lit(1))
    rows = base.withColumn("_row", F.row_number().over(same))
    wanted = links.select(F.col("doc_id").alias("to_id"), F.col("_h").alias("to_h"), "_k", F.col("next_id").alias("doc_id"), F.col("next_h").alias("_h"))
    # Written so that no group limit is planned below the window: both joins then read one exchange of the texts.
    lent = rows.where("_row * 2 = 2").join(wanted.hint("merge"), ["doc_id", "_h"])
    lent = lent.select(F.col("to_id").alias("doc_id"), F.col("to_h").alias("_h"), "_k", F.col("doc_id").alias("next_id"), F.col("_h").alias("next_h"), F.substring("text", F.lit(1), F.col("_k").cast("int")).alias("_lent"))
    met = rows.join(lent.hint("merge"), ["doc_id", "_h"])
    kept = F.substring("text", F.lit(1), (F.length("text") - F.col("_k")).cast("int"))
    return met.select("doc_id", "_h", "_row", "text", F.concat(kept, "_lent").alias("edited"), "next_id", "next_h")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    both = edited_texts(docs).select(
        "doc_id", "_h", "_row", "next_id", "next_h", F.length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("_sha"),
        F.posexplode(F.array("text", "edited")).alias("_which", "_text"),
    )
    keys = ["doc_id", "_h", "_row", "next_id", "next_h", "n_chars", "_sha", "_which"]
    lanes = cut(vectors(both, keys, "_text"), "fingerprints")
    own = lanes.where("_which = 0").drop("_which")
    edited = lanes.where("_which = 1").select("doc_id", "_h", "_row", *[F.col(c).alias(f"e_{c}") for c in ("exact", "counts", "units")])
    following = own.where("_row = 1").select(F.col("doc_id").alias("next_id"), F.col("_h").alias("next_h"), F.col("counts").alias("f_counts"), F.col("units").alias("f_units"))
    met = own.join(edited, ["doc_id", "_h", "_row"]).join(following, ["next_id", "next_h"])
    return met.select(
        F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")).alias("doc_id"), "n_chars", F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text(F.col("exact"), F.col("counts"), F.col("units")).alias("fingerprint"),
        as_text(F.col("e_exact"), F.col("e_counts"), F.col("e_units")).alias("edited_fingerprint"),
        likeness(F.col("counts"), F.col("units"), F.col("e_counts"), F.col("e_units")).alias("near_edited"),
        likeness(F.col("counts"), F.col("units"), F.col("f_counts"), F.col("f_units")).alias("near_next"),
    )
