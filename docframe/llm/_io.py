"""Shared-folder tables, fold arithmetic and skew-proof joins used by the corpus operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; a temporary one where it is unset and
    all run in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="docframe-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


_written: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    _written.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _written[-1]


def clear(spark: SparkSession) -> int:
    """Remove the tables and archives that this process has written to the shared folder; how many there were. For after
    the results that were made from them are written; indexes and archives at paths of the caller's stay."""
    for path in _written:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    n = len(_written)
    _written.clear()
    return n


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of doc_id as text, modulo folds; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _salt(member: Column) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(64)).cast("int")


def _dealt(whole: DataFrame) -> DataFrame:
    """One row for each salt that a group's rows have, from the group's mask of them."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("_mask", i) == 1)
    return whole.withColumn("_salt", F.explode(bits)).drop("_mask")


def _mask(member: Column) -> Column:
    return F.bit_or(F.expr("shiftleft(1L, _salt)")).alias("_mask")


def with_group_stats(rows: DataFrame, key: str, member: Column, *aggs: Column, where: Column | None = None) -> DataFrame:
    """Attach aggregates of its group to every row of rows, however large a group is.

    Groups are aggregated by key (a row for each key and task moves) together with a 64-bit mask of their
    rows' salts; a group's result goes back once for each salt, so the rows of one key meet in 64 places and
    never in one. A place that is still too large for a task is split by adaptive execution, as it is a join with no
    aggregate above it in the same stage. member decides a row's salt; where keeps only the groups for which it holds.
    """
    salted = rows.withColumn("_salt", _salt(member))
    whole = salted.groupBy(key).agg(*aggs, _mask(member))
    whole = whole if where is None else whole.where(where)
    return salted.join(_dealt(whole), [key, "_salt"]).drop("_salt")


def attach(rows: DataFrame, key: str, lookup: DataFrame, member: Column) -> DataFrame:
    """Left join of rows with lookup (unique by key), in 64 places for each key, like with_group_stats."""
    salted = rows.withColumn("_salt", _salt(member))
    places = salted.groupBy(key).agg(_mask(member)).join(lookup, key)
    return salted.join(_dealt(places), [key, "_salt"], "left").drop("_salt")
