"""docframe theory|lessons|questions|exercises|label: packages to pages, lesson documents, question records, exercise
pages or labels, from the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arguments(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="docframe", description=__doc__)
    parser.add_argument("job", choices=["theory", "lessons", "questions", "exercises", "label"])
    parser.add_argument("inputs", nargs="+", help="files or folders, read recursively")
    parser.add_argument("-o", "--out", help="folder to write to")
    parser.add_argument("-j", "--jobs", type=int, help="tasks that read packages at once")
    parser.add_argument("--work", help="folder for finished stages, which a run that was stopped goes on from")
    parser.add_argument("--images", help="theory, lessons: folder for the packages' images as files of their own")
    parser.add_argument("--structured", action="store_true", help="questions: a folder for each file, as below the inputs")
    parser.add_argument("--inplace", action="store_true", help="label: write each record over its own file")
    parser.add_argument("--limit", type=int, help="label: only the first records by path")
    given = parser.parse_args(args)
    if not given.out and not given.inplace:
        parser.error("-o is needed unless records are labelled in place")
    return given


def records(spark: SparkSession, inputs: list[str]) -> DataFrame:
    """path, content: JSON records of one object a file, by path, with the fields that labelling reads; files that are
    missing are told of and left out."""
    from pyspark.errors import AnalysisException

    schema = "content string, choices array<struct<id:int,content:string>>, cognitive_level string, cognitive_level_num int"
    found = None
    for given in inputs:
        try:
            files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(given, wholetext=True)
        except AnalysisException:
            print(f"missing: {given}", file=sys.stderr)
            continue
        files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
        found = files if found is None else found.unionByName(files)
    if found is None:
        raise SystemExit(1)
    return found.withColumn("_r", F.from_json("raw", schema)).select("path", "raw", "_r.*")


def label(spark: SparkSession, given: argparse.Namespace) -> int:
    from docframe.operators import labelling
    from docframe.operators.questions import prompt
    from docframe.sources import sinks

    rows = records(spark, given.inputs)
    rows = rows.orderBy("path").limit(given.limit) if given.limit else rows
    asked = rows.withColumn("prompt", prompt(F.col("content"), F.transform(F.coalesce("choices", F.array().cast(rows.schema["choices"].dataType)), lambda c: c["content"])))
    labelled = labelling.enrich(asked, "prompt").select("path", labelling.with_label(F.col("raw"), F.col("cognitive_level"), F.col("cognitive_level_num")).alias("json"))
    if given.inplace:
        labelled = labelled.persist()
        labelled.count()  # every file is read before the first is written over
        sinks.write_named(labelled.withColumn("name", F.regexp_replace("path", "^file:/*", "")), "file:///", "name", "json").count()
    else:
        sinks.write_named(labelled.withColumn("name", F.element_at(F.split("path", "/"), -1)), given.out, "name", "json").count()
    return 0


def main(args: list[str] | None = None) -> int:
    given = arguments(args)
    spark = SparkSession.builder.appName("docframe").getOrCreate()
    if given.job == "label":
        return label(spark, given)
    from docframe.plans import exercises, lesson_schema, lessons
    from docframe.operators import schema
    from docframe.sources import docx, sinks

    files = docx.scan(spark, given.inputs)
    files = files.repartition(given.jobs) if given.jobs else files
    stage = (lambda rows, name: sinks.stage(rows, given.work, name)) if given.work else None
    parsed = stage(docx.parse(files), "parsed") if stage else docx.parse(files).persist(StorageLevel.DISK_ONLY)
    failed = parsed.where("error IS NOT NULL")
    for row in failed.select("path", "error").toLocalIterator():
        print(f"[ERROR] {row.path}: {row.error}", file=sys.stderr)
    bad = failed.count()
    if given.job in ("questions", "exercises"):
        found = exercises.questions(parsed).persist()
        described = docx.described(docx.blocks(parsed))
        if given.job == "questions":
            out = exercises.records(found, described)
            if given.structured:
                roots = [i for i in given.inputs if not i.endswith(".docx")]
                out = out.withColumn("name", exercises.structured_name(F.col("path"), roots[0])) if roots else out
            sinks.write_named(out, given.out, "name", "json").count()
        else:
            sinks.write_named(exercises.pages(found, described), given.out, "name", "html").count()
        for row in exercises.report(parsed, found).orderBy("path").toLocalIterator():
            print(f"[{row.status}] {row.path}: {row.questions} questions")
        for row in exercises.audit(found).where("flags != ''").orderBy("path", "q_order").toLocalIterator():
            print(f"    {row.path} {row.q_order}: {row.answer_source} {row.flags}")
        found.unpersist()
    elif given.job == "theory":
        named = lessons.pages(parsed).persist()
        sinks.write_named(named, given.out, "name", "html").count()
        bad += parsed.where("error IS NULL AND part = 0").join(named.select("path"), "path", "left_anti").count()
        named.unpersist()
    else:
        found = schema.validate(lessons.documents(parsed, files=files, work=stage), "json", lesson_schema.LESSON).withColumn("name", F.concat("doc_id", F.lit(".json"))).persist()
        sinks.write_named(found, given.out, "name", "json").count()
        bad += found.where(~schema.valid(F.col("violations"))).count()
        found.unpersist()
    if given.images:
        sinks.side_files(docx.assets(parsed), given.images).count()
    parsed.unpersist()
    return int(bad > 0)


if __name__ == "__main__":
    raise SystemExit(main())
