"""Label enrichment through a pluggable labeler. The default one is offline and repeatable; none is called over
a network from here."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.operators.questions import parse_label

Labeler = Callable[[list[str]], list[str | None]]

# Verbs that ask for more than recall, highest level first.
VERBS = (("van_dung_cao", ("chứng minh", "đề xuất", "prove")), ("van_dung", ("tính", "giải", "compute")), ("thong_hieu", ("giải thích", "so sánh", "explain")))


def by_verbs(prompts: list[str]) -> list[str | None]:
    return [next((label for label, verbs in VERBS if any(v in p.lower() for v in verbs)), "nhan_biet") for p in prompts]


class Busy(OSError):
    """A labeler that asks to be asked again later; wait: after how many seconds, if it says."""

    def __init__(self, wait: float | None = None):
        super().__init__("busy")
        self.wait = wait


def retrying(ask: Labeler, attempts: int = 3, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Labeler:
    """ask again on an error, up to `attempts` times, after a pause that doubles, or that the labeler names where it is
    busy; then the batch has no replies."""

    def run(prompts: list[str]) -> list[str | None]:
        for turn in range(attempts):
            try:
                return ask(prompts)
            except OSError as e:
                if turn + 1 < attempts:
                    sleep(e.wait if isinstance(e, Busy) and e.wait is not None else pause * 2**turn)
        return [None] * len(prompts)

    return run


def with_label(raw: Column, level: Column, number: Column) -> Column:
    """A record's JSON text with its level and number replaced; all else as it is, in its order."""

    def put(text: Column, name: str, value: Column) -> Column:
        found = rf'("{name}"\s*:\s*)(?:null|-?[0-9.]+|"(?:[^"\\]|\\.)*")'
        told = F.coalesce(F.to_json(F.array(value), {"ignoreNullFields": "false"}).substr(F.lit(2), F.length(F.to_json(F.array(value))) - 2), F.lit("null"))
        added = F.regexp_replace(text, r"\s*\}\s*$", F.concat(F.lit(f',"{name}":'), told, F.lit("}")))
        return F.when(text.rlike(found), F.regexp_replace(text, F.lit(found), F.concat(F.lit("$1"), told))).otherwise(added)

    return put(put(raw, "cognitive_level", level), "cognitive_level_num", number)


def enrich(questions: DataFrame, prompt: str, labeler: Labeler = by_verbs, level: str = "cognitive_level", number: str = "cognitive_level_num") -> DataFrame:
    """questions with level and number from the labeler's reply; what it has no label for keeps its own."""
    schema = questions.withColumn("_reply", F.lit("")).schema

    def run(batches):
        for batch in batches:
            replies = labeler([p or "" for p in batch[prompt]])
            yield batch.assign(_reply=pd.Series(replies, index=batch.index, dtype=object))

    replied = questions.mapInPandas(run, schema).withColumn("_p", parse_label(F.col("_reply")))
    out = replied.withColumn(level, F.coalesce("_p.name", F.col(level))).withColumn(number, F.coalesce("_p.number", F.col(number)))
    return out.select(*questions.columns)
