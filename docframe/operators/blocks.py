"""Blocks of a document: lines, numerals, headings, kinds of titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.functions.text import fold, head, strip
from docframe.plans.config import BOLD_TITLES, NUMBERING, TITLE_KINDS


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, block_idx, text) of every line that is not blank, counted from 0 over all lines."""
    found = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("block_idx", "_line"))
    return found.select(key, F.col("block_idx").cast("long").alias("block_idx"), strip(F.col("_line")).alias("text")).where("text != ''")


def numbering(text: Column) -> Column:
    """struct(kind, numeral, rest) of the first numeral pattern that a text begins with; null if none."""
    out = F.lit(None).cast("struct<kind:string,numeral:string,rest:string>")
    for kind, pattern in reversed(NUMBERING):
        numeral = F.regexp_extract(text, pattern, 1)
        found = F.struct(F.lit(kind).alias("kind"), numeral.alias("numeral"), F.regexp_extract(text, pattern, 2).alias("rest"))
        out = F.when(text.rlike(pattern) & (numeral != ""), found).otherwise(out)
    return out


def heading(text: Column, bold: Column, style: Column, most: int = 140) -> Column:
    """Whether a paragraph is a heading: by style, by a high numeral, or bold and title-like."""
    kind = numbering(text)["kind"]
    title = ((text == F.upper(text)) & (text != F.lower(text))) | fold(head(text, 1 + max(map(len, BOLD_TITLES)))).isin(*BOLD_TITLES) | ((F.length(text) <= 80) & text.endswith(":") & ~text.rlike(r"^\([0-9]+\)"))
    by_kind = F.when(kind.isin("roman", "arabic", "alpha_upper") & (bold | (F.length(text) <= 100)), True).when(kind.isin("alpha_lower", "dash", "star"), False)
    return F.length(text).between(1, most) & F.coalesce(style.startswith("Heading") | F.lit(False), F.lit(False)) | (
        F.length(text).between(1, most) & F.coalesce(by_kind, bold & title)
    )


def title_kind(title: Column) -> Column:
    """What a title's beginning says of its section. The beginning is folded once, and no more of the title than it needs."""
    begins = F.regexp_extract(fold(head(title, max(len(prefix) for prefix, _ in TITLE_KINDS))), f"^({'|'.join(prefix for prefix, _ in TITLE_KINDS)})", 1)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in TITLE_KINDS for x in pair])[begins], F.lit("concept"))


def bold_by_vote(bold_runs: Column, runs: Column) -> Column:
    """A paragraph is bold if at least half of its runs, and one, are."""
    return bold_runs >= F.greatest(F.lit(1), F.floor(runs / 2))


def split_lines(blocks: DataFrame, key: str = "path", least: int = 2) -> DataFrame:
    """blocks plus at (their order): a paragraph whose lines hold at least `least` headings is one block for each line,
    every line with its own inlines and its own bold vote; any other block is as it was. Only paragraphs with line
    breaks are taken apart."""
    at = F.shiftleft(F.col("block_idx").cast("long"), 20)
    broken = (F.col("kind") == "para") & F.col("text").contains("\n")
    whole = blocks.withColumn("at", at)
    pieces = whole.where(broken).select(key, "at", "style", F.posexplode("inlines").alias("_i", "_x"))
    pieces = pieces.select(key, "at", "style", "_i", "_x", F.posexplode(F.when(F.col("_x.kind") == "text", F.split("_x.text", "\n")).otherwise(F.array(F.lit("")))).alias("_j", "_t"))
    upto = Window.partitionBy(key, "at").orderBy("_i", "_j").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("_line", F.sum((F.col("_j") > 0).cast("long")).over(upto))
    text = F.col("_x.kind") == "text"
    piece = F.col("_x").withField("text", F.when(text, F.col("_t")).otherwise(F.col("_x.text")))
    shown = text & (strip(F.col("_t")) != "")
    lines = pieces.where(~text | (F.col("_t") != "")).groupBy(key, "at", "_line").agg(
        F.first("style").alias("style"), F.transform(F.array_sort(F.collect_list(F.struct("_i", "_j", piece.alias("x")))), lambda v: v["x"]).alias("inlines"),
        F.count_if(shown).alias("_n"), F.count_if(shown & F.col("_x.bold")).alias("_b"),
    )
    said = strip(F.array_join(F.transform(F.filter("inlines", lambda x: x["kind"] == "text"), lambda x: x["text"]), ""))
    lines = lines.withColumn("text", said).withColumn("bold", (F.col("_n") > 0) & bold_by_vote(F.col("_b"), F.col("_n")))
    apart = lines.withColumn("_heads", F.count_if(heading(F.col("text"), F.col("bold"), F.col("style"))).over(Window.partitionBy(key, "at"))).where(F.col("_heads") >= least)
    own = whole.drop("inlines", "text", "bold", "at", "style")
    split = apart.join(own.withColumn("at", at), [key, "at"]).withColumn("at", F.col("at") + F.col("_line"))
    kept = whole.where(~broken).unionByName(whole.where(broken).join(apart.select(key, "at").distinct(), [key, "at"], "left_anti"))
    return kept.unionByName(split.select(*kept.columns))
