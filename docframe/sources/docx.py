"""Packages as tables: files, blocks and assets. Python runs where bytes are decoded; the rest is native."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.functions.tex import confidence
from docframe.functions.text import fold, mime_of, slug
from docframe.plans import config

INLINE = "struct<kind:string,text:string,ref:int,bold:boolean,color:string,underline:boolean>"
BLOCK = f"struct<block_idx:int,kind:string,style:string,ilvl:int,bold:boolean,text:string,inlines:array<{INLINE}>,rows:array<array<array<{INLINE}>>>>"
ASSET = "struct<ref:int,number:int,uses:array<int>,kind:string,part_name:string,data:binary,latex:string,source:string,selectors:array<int>,width:int,height:int>"
PARSED = f"path string, part int, blocks array<{BLOCK}>, assets array<{ASSET}>, error string"
_INLINE = pa.struct([("kind", pa.string()), ("text", pa.string()), ("ref", pa.int32()), ("bold", pa.bool_()), ("color", pa.string()), ("underline", pa.bool_())])
_BLOCK = pa.struct([
    ("block_idx", pa.int32()), ("kind", pa.string()), ("style", pa.string()), ("ilvl", pa.int32()), ("bold", pa.bool_()), ("text", pa.string()), ("inlines", pa.list_(_INLINE)),
    ("rows", pa.list_(pa.list_(pa.list_(_INLINE)))),
])
_ASSET = pa.struct([
    ("ref", pa.int32()), ("number", pa.int32()), ("uses", pa.list_(pa.int32())), ("kind", pa.string()), ("part_name", pa.string()), ("data", pa.binary()), ("latex", pa.string()), ("source", pa.string()),
    ("selectors", pa.list_(pa.int32())), ("width", pa.int32()), ("height", pa.int32()),
])
_ARROW = {"path": pa.string(), "part": pa.int32(), "blocks": pa.list_(_BLOCK), "assets": pa.list_(_ASSET), "error": pa.string()}
#: Fixed value: about so many bytes of blocks and assets become a row, or go on together.
SLICE = 1 << 20


def scan(spark: SparkSession, paths: str | list[str], pattern: str = "*.docx") -> DataFrame:
    """path, content of every package below the paths, without temporary and resource files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths)
    return files.where(~F.element_at(F.split("path", "/"), -1).rlike(r"^(~\$|\._)")).select("path", "length", "content")


def _weight(inlines: list[dict]) -> int:
    return sum(60 + len(x["text"]) for x in inlines)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.values(), strict=True)], list(_ARROW))


def _read(path: str, content: bytes, most: int) -> tuple[list[pa.RecordBatch], tuple, int]:
    """The rows of a file: finished ones of a large file as batches, the last one, and about its bytes."""
    from docframe.sources.ooxml import Package

    try:
        package = Package(content)
        done, blocks, assets, size = [], [], [], 100
        for block in package.blocks():
            blocks.append(block)
            size += 100 + len(block["text"]) + _weight(block["inlines"]) + sum(_weight(cell) for row in block["rows"] for cell in row)
            if size >= most:
                done.append(_batch([(path, len(done), blocks, [], None)]))
                blocks, size = [], 0
        for asset in package.assets:
            assets.append(asset)
            size += 100 + len(asset["data"] or b"") + 4 * len(asset["uses"])
            if size >= most:
                done.append(_batch([(path, len(done), blocks, assets, None)]))
                blocks, assets, size = [], [], 0
        return done, (path, len(done), blocks, assets, None), size
    except Exception as e:  # a damaged package is a row with an error, not the job's end
        return [], (path, 0, [], [], f"{type(e).__name__}: {e}"), 100


def parse(files: DataFrame, most: int = SLICE) -> DataFrame:
    """A row a file: its blocks and distinct assets, or the error that kept it from being read. A file of more than about
    `most` bytes has several rows with a part of them each, numbered by part from 0. Rows go on together up to that size."""

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                done, last, more = _read(path.as_py(), content.as_py(), most)
                if done or size >= most:
                    if kept:
                        yield _batch(kept)
                    yield from done
                    kept, size = [], 0
                kept.append(last)
                size += more
        if kept:
            yield _batch(kept)

    return files.select("path", "content").mapInArrow(run, PARSED)


def readable(parsed: DataFrame) -> DataFrame:
    """path, digest of every file that could be read: of its parsed blocks."""
    own = parsed.where("error IS NULL").select("path", F.struct("part", F.sha2(F.to_json("blocks").cast("binary"), 256).alias("d")).alias("_p"))
    listed = F.transform(F.array_sort(F.collect_list("_p")), lambda v: v["d"])
    whole = F.when(F.size("_d") == 1, F.get("_d", F.lit(0))).otherwise(F.sha2(F.array_join("_d", "").cast("binary"), 256))
    return own.groupBy("path").agg(listed.alias("_d")).select("path", whole.alias("digest"))


def blocks(parsed: DataFrame) -> DataFrame:
    return parsed.select("path", F.explode("blocks").alias("_b")).select("path", "_b.*")


def overridden(found: DataFrame, overrides: DataFrame) -> DataFrame:
    """assets with the formulas that a person wrote for those no decoder gets right: overrides (sha256, latex)."""
    given = overrides.select("sha256", F.col("latex").alias("_given")).where("_given IS NOT NULL").dropDuplicates(["sha256"])
    met = found.join(given, "sha256", "left")
    mended = F.col("_given").isNotNull() & (F.col("kind") == "formula")
    columns = {"latex": F.when(mended, F.col("_given")).otherwise(F.col("latex")), "source": F.when(mended, "override").otherwise(F.col("source")), "confidence": F.when(mended, 1.0).otherwise(F.col("confidence"))}
    return met.withColumns(columns).select(*found.columns)


def assets(parsed: DataFrame) -> DataFrame:
    """Each distinct asset of a file once, by its bytes or formula, numbered in order of first use; uses lists the
    references that mean it."""
    rows = parsed.select("path", F.explode("assets").alias("_a")).select("path", "_a.*")
    rows = rows.withColumn("sha256", F.sha2(F.coalesce("data", F.col("latex").cast("binary"), F.concat(F.lit("unresolved:"), "part_name").cast("binary")), 256))
    prefix = F.when(F.col("kind") == "formula", "f").otherwise("img")
    kept = rows.withColumn("aid", F.concat(prefix, "number")).withColumn("mime", mime_of(F.regexp_extract("part_name", r"\.([A-Za-z]+)$", 1))).drop("number")
    return kept.withColumn("confidence", confidence(F.coalesce("source", F.lit("")), F.col("selectors")))


def heads(rows: DataFrame, most: int = 6) -> DataFrame:
    """path, head: the texts of the first paragraphs of each file, in order."""
    first = F.transform(F.array_sort(F.collect_list(F.when((F.col("kind") == "para") & (F.col("text") != ""), F.struct("block_idx", "text")))), lambda x: x["text"])
    return rows.where(F.col("block_idx") < most).groupBy("path").agg(first.alias("head"))


def metadata(path: Column, head: Column) -> dict[str, Column]:
    """subject, subject_name, grade, number, title, lesson, chapter and doc_id from a file's path and its first
    paragraphs (an array). What is not found is null, "UNK" and "?" for a subject; nothing is guessed."""
    parts = F.split(path, "/")
    stem = F.regexp_extract(path, r"([^/]+)\.[^.]+$", 1)
    folded = F.transform(parts, fold)
    folder = F.coalesce(F.get(F.filter(folded, lambda x: x.rlike(config.SUBJECT_FOLDER)), F.lit(0)), fold(stem))
    code = F.coalesce(*[F.when(folder.contains(k), F.lit(c)) for k, c, _ in config.SUBJECTS], F.lit("UNK"))
    name = F.coalesce(*[F.when(folder.contains(k), F.lit(n)) for k, _, n in config.SUBJECTS], F.lit("?"))
    grade = F.nullif(F.regexp_extract(folder, config.GRADE, 1), F.lit("")).cast("int")
    lines = F.concat(F.array(stem), F.coalesce(head, F.array().cast("array<string>")))
    named = F.get(F.filter(lines, lambda x: x.rlike(config.LESSON)), F.lit(0))
    number = F.regexp_extract(named, config.LESSON, 1).cast("int")
    reading = F.get(F.filter(head, lambda x: x.rlike(config.READING)), F.lit(0))
    none = lambda x: F.nullif(F.trim(x), F.lit(""))
    title = F.coalesce(
        none(F.regexp_replace(reading, config.READING, "")), none(F.regexp_replace(named, config.LESSON_PREFIX, "")), F.trim(F.regexp_replace(stem, r"^\s*[0-9]+\s*[.)]\s*", ""))
    )
    title = F.trim(F.regexp_replace(title, r"^\((.*)\)$", "$1"))
    title = F.coalesce(none(F.regexp_replace(title, r"^\(.+?\)\s*[-–]\s*", "")), stem)
    above = F.filter(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.rlike(config.CHAPTER))
    chapter = F.trim(F.coalesce(F.get(above, F.lit(0)), F.get(F.filter(head, lambda x: x.rlike(config.CHAPTER)), F.lit(0))))
    place = F.concat(F.lit("bai-"), F.coalesce(F.lpad(number.cast("string"), 2, "0"), F.lit("x")))
    doc_id = F.concat_ws("-", F.lower(code), F.coalesce(grade, F.lit(0)).cast("string"), F.lit(config.BOOK), place, F.nullif(slug(title), F.lit("")))
    lesson = F.when(number.isNotNull(), F.concat(F.lit("Bài "), number, F.lit(". "), title)).otherwise(title)
    return {"subject": code, "subject_name": name, "grade": grade, "number": number, "title": title, "lesson": lesson, "chapter": chapter, "doc_id": doc_id}


def described(rows: DataFrame) -> DataFrame:
    """path and metadata of every file that has blocks."""
    found = heads(rows)
    return found.select("path", *[c.alias(n) for n, c in metadata(F.col("path"), F.col("head")).items()])


def stem_of(path: str) -> str:
    return re.sub(r"\.[^.]+$", "", path.rsplit("/", 1)[-1])
