"""Questions: segments, choices, answers, types, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.functions.text import fold, strip_html
from docframe.operators.structure import islands
from docframe.plans import config


def segments(blocks: DataFrame, is_level: Column, is_question: Column, looks_like: Column, key: str, *order: str, size: Column | None = None, least: int = 30) -> DataFrame:
    """blocks of kept segments with seg and q_order. A level row opens a segment of its own kind and is not in it;
    a question row opens a question; what is before or after a level without a question is kept if one of its rows
    looks like one, or if their sizes sum to more than `least`."""
    marked = blocks.withColumn("_level", is_level).withColumn("_question", is_question & ~is_level)
    numbered = islands(marked, F.col("_level") | F.col("_question"), "seg", key, *order)
    whole = Window.partitionBy(key, "seg")
    kept = numbered.withColumn("_named", F.max("_question").over(whole)).withColumn("_looks", F.max(looks_like).over(whole))
    if size is not None:
        kept = kept.withColumn("_looks", F.col("_looks") | (F.sum(size).over(whole) > least))
    kept = kept.where(~F.col("_level") & (F.col("_named") | F.col("_looks")))
    return kept.withColumn("q_order", F.dense_rank().over(Window.partitionBy(key).orderBy("seg")).cast("long")).drop("_level", "_question", "_named", "_looks")


def choices(inlines: DataFrame, letter: Column, key: str, *order: str) -> DataFrame:
    """inlines plus choice (run number) and letter; what comes before a first letter that is not A is A, inferred."""
    marked = inlines.withColumn("_letter", letter)
    numbered = islands(marked, F.col("_letter").isNotNull(), "choice", key, *order)
    whole = Window.partitionBy(key)
    first = F.min_by("_letter", F.struct(*order)).over(whole) if order else None
    numbered = numbered.withColumn("_first", F.min(F.when(F.col("_letter").isNotNull(), F.struct(*order, "_letter"))).over(whole)["_letter"]) if first is not None else numbered
    own = F.max("_letter").over(Window.partitionBy(key, "choice"))
    inferred = (F.col("choice") == 0) & (F.col("_first") != "A")
    return numbered.withColumn("letter", F.when(inferred, F.lit("A")).otherwise(own)).withColumn("inferred", F.coalesce(inferred, F.lit(False))).drop("_letter", "_first")


def letter_of(text: Column, bold: Column) -> Column:
    """The letter that opens a choice: marked A. or A), or alone and bold."""
    marked = F.regexp_extract(text, config.OPTION_MARK, 1)
    bare = F.regexp_extract(text, config.BARE_LETTER, 1)
    return F.when(marked != "", marked).when(bold & (bare != ""), bare)


def odd_one_out(rows: DataFrame, key: str, value: str, label: str) -> DataFrame:
    """(key, odd): the label of the only row of its value, where a key has exactly two values (null is one) and
    exactly one of them once."""
    counted = rows.groupBy(key, F.coalesce(F.col(value), F.lit("∅")).alias("_v")).agg(F.count("*").alias("_n"), F.max(label).alias("_label"))
    whole = counted.groupBy(key).agg(F.count("*").alias("_kinds"), F.count_if(F.col("_n") == 1).alias("_single"), F.max(F.when(F.col("_n") == 1, F.col("_label"))).alias("odd"))
    return whole.where("_kinds = 2 AND _single = 1").select(key, "odd")


def only_marked(rows: DataFrame, key: str, mark: Column, label: str) -> DataFrame:
    """(key, marked): the label of the only marked row of a key."""
    return rows.groupBy(key).agg(F.count_if(mark).alias("_n"), F.max(F.when(mark, F.col(label))).alias("marked")).where("_n = 1").select(key, "marked")


def answer_from_text(first: Column, second: Column) -> Column:
    """struct(letters, source, skip, rest) of a question's tail, whose first lines are given: the answer's letters or
    null, where they come from, how many lines the explanation leaves out, and what is left of the last of those.

    A stated answer may list several letters. A null first line means that there is no tail."""
    stated, chosen, then = (F.upper(F.regexp_extract(line, pattern, 1)) for line, pattern in ((first, config.ANSWER), (first, config.CHOSEN), (second, config.CHOSEN)))
    rest = lambda line, pattern: F.regexp_replace(line, pattern, "")

    def said(letters: Column, source: str, skip: int, left: Column) -> Column:
        return F.struct(letters.alias("letters"), F.lit(source).alias("source"), F.lit(skip).alias("skip"), F.trim(left).alias("rest"))

    none = F.lit(None).cast("string")
    solution = first.rlike(config.SOLUTION)
    return (
        F.when(first.isNull(), said(none, "none", 0, F.lit("")))
        .when(stated != "", said(stated, "text:đáp_án", 1, rest(first, config.ANSWER)))
        .when(solution & (F.coalesce(then, F.lit("")) != ""), said(then, "text:chọn", 2, rest(second, config.CHOSEN)))
        .when(solution, said(none, "essay_no_answer_letter", 1, F.lit("")))
        .when(chosen != "", said(chosen, "text:chọn", 1, rest(first, config.CHOSEN)))
        .otherwise(said(none, "unrecognized_tail_format", 0, F.lit("")))
    )


def resolve(text_letter: Column, text_source: Column, underlined: Column, coloured: Column, has_choices: Column) -> Column:
    """struct(letter, source): stated text before underline before colour; null is never guessed."""
    return F.struct(
        F.coalesce(text_letter, underlined, coloured).alias("letter"),
        F.when(text_letter.isNotNull(), text_source).when(underlined.isNotNull(), "format:underline").when(coloured.isNotNull(), "format:color")
        .when(~has_choices, "essay_no_answer_letter").otherwise("none").alias("source"),
    )


def choice_id(letter: Column) -> Column:
    return F.ascii(letter) - 64


def fill_answers(stem: Column, tail: Column) -> Column:
    """[[..]] of a gap text's answers, without the words that announce them; [[""]] where none is given; null where the
    stem has no gap."""
    plain = F.regexp_replace(F.coalesce(tail, F.lit("")), config.ANSWER_HEAD + r"\s*[:.\-]?\s*", "")
    parts = F.filter(F.transform(F.split(plain, r"[,;]\s*"), F.trim), lambda x: x != "")
    return F.when(stem.rlike(config.GAP), F.array(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))))


def true_false(choices_text: Column) -> Column:
    """Whether two or more choices all begin like a), b) or 1., 2."""
    return (F.size(choices_text) >= 2) & F.forall(choices_text, lambda c: c.rlike(config.TRUE_FALSE))


def true_false_values(count: Column, tail: Column) -> Column:
    """[{id, value}] for each statement: "true" or "false" as the tail says of its letter, null where it says nothing."""

    def value(i: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])"), F.char(i + 96), F.lit(r"[.)]?\s*(đúng|sai|true|false)(?![\p{L}\p{N}_])"))
        word = F.lower(F.get(F.regexp_extract_all(tail, pattern, F.lit(1)), F.lit(0)))
        return F.struct(i.alias("id"), F.when(word.isin("đúng", "true"), "true").when(word.isin("sai", "false"), "false").alias("value"))

    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), value))


def question_type(n_choices: Column, grouped: Column, gap: Column, n_answers: Column) -> Column:
    return (
        F.when(grouped, "true-false-group").when((n_choices == 0) & gap, "fill-answer").when(n_choices == 0, "essay")
        .when(n_answers > 1, "multiple-choice").otherwise("single-choice")
    )


def essay_guideline(explanation: Column) -> Column:
    found = F.regexp_extract(explanation, r"(?iu)(chấm theo[^.<]*|hướng dẫn chấm[^.<]*)", 1)
    return F.when(found != "", found)


def record_id(stem: Column, order: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("_", stem, order.cast("string")).cast("binary")), 1, 24)


def heading_level(text: Column) -> Column:
    """struct(name, number) of a heading that states a cognitive level, or null."""
    folded, kind = fold(text), "struct<name:string,number:int>"
    digit = F.regexp_extract(folded, config.LEVEL, 1)
    out = F.when(digit != "", F.struct(F.element_at(F.array(*[F.lit(x) for x in ("knowledge", "comprehension", "application")]), F.when(digit != "", digit).cast("int")).alias("name"), digit.try_cast("int").alias("number")))
    phrase = F.regexp_extract(folded, config.BLOOM, 1)
    for name, level, number in config.HEADING_LEVELS:
        out = F.coalesce(out, F.when(phrase == name, F.struct(F.lit(level).alias("name"), F.lit(number).alias("number"))))
    return out.cast(kind)


def trim_question(text: Column) -> Column:
    return F.regexp_replace(text, config.QUESTION, "")


def prompt(question: Column, choices_text: Column, most: int = 800) -> Column:
    """The request to label a question: it and its lettered choices without tags, each of at most `most` characters."""
    plain = lambda c: strip_html(F.coalesce(c, F.lit("")), most)
    lettered = F.transform(choices_text, lambda c, i: F.concat(F.char(i + 65), F.lit(". "), plain(c)))
    listed = F.when(F.size(choices_text) > 0, F.concat(F.lit("\n\nLua chon:\n"), F.array_join(lettered, "\n")))
    return F.concat(F.lit("Cau hoi:\n"), plain(question), F.coalesce(listed, F.lit("")), F.lit("\n\nPhan loai muc do nhan thuc:"))


def parse_label(raw: Column) -> Column:
    """struct(name, number): the first label, highest first, that the reply holds or is; null if none."""
    said = F.lower(F.trim(raw))
    out = F.lit(None).cast("struct<name:string,number:int>")
    for _, parts, exact, name, number in reversed(config.LABELS):
        hit = said.isin(*exact)
        for part in parts:
            hit = hit | said.contains(part)
        out = F.when(hit, F.struct(F.lit(name).alias("name"), F.lit(number).alias("number"))).otherwise(out)
    return out
