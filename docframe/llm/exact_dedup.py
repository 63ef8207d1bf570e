"""Exact deduplication by a persistent digest index (operator 4, native).

The index is a table in the shared folder, bucketed and sorted by SHA-256 digest, one row per known text.
A batch of rows is first reduced to its distinct digests (partial aggregation, so a text repeated any
number of times costs one row per task), the new digests come from a sort-merge anti-join against the
index, which needs no exchange of the index, and are appended.

An index folder holds data of one generation and a small table of generations with their bucket counts. The row of
a generation is written after its data, so a run that fails between leaves the generation before it in force. The
bucket count is fixed when an index is made; another one asked for later is refused, and what the session's shuffle
partitions are plays no part. compact() writes a new generation with one file a bucket.

Defined results: null text counts as empty; the row with the largest doc_id of equal texts stays, a null
doc_id counts as smaller than any; rows that repeat both doc_id and text are the same document (decide()
marks each of them kept, dedup() returns one, and which one's other columns is not defined); an empty table gives
an empty result; other columns, whatever their names, play no part and come through.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm._io import attach, cut, fresh_path

NULL_ID = -(1 << 63)
SCHEMA = "digest BINARY, keep_id BIGINT, seen BIGINT"


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (32 bytes), one row per row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"))


class DigestIndex:
    """A digest table that outlives a run: DigestIndex(spark, path) makes it or finds it again, add() deduplicates
    new rows against it. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "digest-index")
        last = self._last() if path else None
        if last and buckets not in (None, last["buckets"]):
            raise ValueError(f"the index at {self.path} has {last['buckets']} buckets, not {buckets}")
        self.buckets = last["buckets"] if last else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.generation = last["generation"] if last else 0
        if not last:
            self._begin(0)
        self._name()

    def _last(self) -> dict | None:
        """The generation in force."""
        try:
            rows = self.spark.read.schema("generation INT, buckets INT").parquet(f"{self.path}/generations").collect()  # a row for each compaction
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return max((r.asDict() for r in rows), key=lambda r: r["generation"], default=None)

    def _begin(self, generation: int) -> None:
        row = self.spark.range(1).select(F.lit(generation).alias("generation"), F.lit(self.buckets).alias("buckets"))
        row.write.mode("append").parquet(f"{self.path}/generations")
        self.generation = generation

    def _name(self) -> None:
        self.name = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {self.name} ({SCHEMA}) USING parquet OPTIONS (path '{self.folder()}') CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def folder(self) -> str:
        return f"{self.path}/data-{self.generation}"

    def known(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """The index as plain files: for joins that its buckets are of no use to, and after close()."""
        return self.spark.read.schema(SCHEMA).parquet(self.folder())

    def fresh(self, docs: DataFrame) -> DataFrame:
        """The digests of docs that the index has not, each with its keep_id and count."""
        found = digests(docs).groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("seen"))
        # Written first: the optimizer would move the anti-join below the aggregate, and every copy of a text
        # would go to its digest's task.
        found = cut(found, "batch-digests").repartition(self.buckets, "digest")
        return found.join(self.known().select("digest").hint("merge"), "digest", "left_anti")

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.folder()).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def add(self, docs: DataFrame) -> None:
        """Append what is new. The index is written once per batch; texts already known keep their row."""
        self._append(self.fresh(docs).select("digest", "keep_id", "seen"))

    def compact(self) -> None:
        """One file a bucket again, after many batches. The generation before it stays until it is removed by hand."""
        rows = self.rows().repartition(self.buckets, "digest")  # of the bucketed table the exchange would be left out, then the buckets too
        self.close()
        self.generation += 1
        self._name()
        self._append(rows)
        self._begin(self.generation)

    def close(self) -> None:
        """Forget the table's name; its files stay at path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest for every row of docs.

    docs is added to the index (a new one if none is given), and each row's answer is its index row, brought
    back in 64 places for each digest. The index holds rows of earlier batches too: a text known before keeps
    the id it had then, and none of docs' copies stays.
    """
    known = _added(docs, index).select("digest", "keep_id", F.col("seen").alias("group_size"))
    out = attach(digests(docs), "digest", known, F.col("doc_id"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def _added(docs: DataFrame, index: DigestIndex | None) -> DataFrame:
    own = index or DigestIndex(docs.sparkSession)
    own.add(docs)
    if index is None:
        own.close()
    return own.rows()


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: of equal texts the one with the largest doc_id, all columns as they are.

    The texts meet the list of kept pairs once, and rows that repeat doc_id and text fall to one there.
    """
    own = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NULL_ID))
    keep = _added(docs, None).select("digest", own("keep_id").alias("id"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = whole.select(digest_of(F.col("row.text")).alias("digest"), own("row.doc_id").alias("id"), "row")
    return named.join(keep.hint("merge"), ["digest", "id"], "left_semi").groupBy("digest", "id").agg(F.first("row").alias("row")).select("row.*")
