"""Exercises of packages end to end: questions with choices, answers and levels, as rows, records and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.functions.text import definition_list, file_slug, fold_short, ray_names
from docframe.operators import questions as Q
from docframe.operators import render
from docframe.operators import structure as S
from docframe.plans import config
from docframe.sources import docx

KEY = ("path", "q_order")


def parts(parsed: DataFrame) -> DataFrame:
    """The blocks of every question with q_order, level and part: stem, option or tail. Options begin at the first
    paragraph, after the one that names the question, that holds a choice's mark; the tail at the first that announces
    an answer. Files without an end of their theory have no exercises."""
    rows = docx.blocks(parsed)
    folded, para = F.col("_f"), F.col("kind") == "para"
    beginnings = rows.select("path", "block_idx", fold_short(F.col("text"), 80).alias("_f"))  # a column: folded once
    limits = S.bounds(beginnings, folded.rlike(config.THEORY_START) & F.length(folded).between(1, 80), folded.rlike(config.THEORY_END) & (F.length(folded) <= 80), "path")
    body = S.between(rows, limits, "exercise", "path").withColumn("_lv", F.when(para, Q.heading_level(F.col("text"))))
    leveled = S.as_of(body, F.col("_lv"), "level", "path", "block_idx")
    option, answer = para & F.col("text").rlike(config.OPTION), para & F.col("text").rlike(config.ANSWER_HEAD)
    named = para & F.col("text").rlike(config.QUESTION)
    size = F.when(para, F.length("text")).otherwise(0)
    found = Q.segments(leveled.withColumn("named", named), F.col("_lv").isNotNull(), named, option | answer, "path", "block_idx", size=size)
    whole = Window.partitionBy(*KEY)
    tail = F.min(F.when(answer & ~F.col("named"), F.col("block_idx"))).over(whole)
    found = found.withColumn("_tail", F.coalesce(tail, F.lit(1 << 30)))
    first = F.min(F.when(option & ~F.col("named") & (F.col("block_idx") < F.col("_tail")), F.col("block_idx"))).over(whole)
    found = found.withColumn("_option", F.coalesce(first, F.lit(1 << 30)))
    part = F.when(F.col("block_idx") >= F.col("_tail"), "tail").when(F.col("block_idx") >= F.col("_option"), "option").otherwise("stem")
    return found.withColumn("part", part).drop("_lv", "_tail", "_option", "seg")


def choice_rows(options: DataFrame) -> DataFrame:
    """path, q_order, choice, letter, inferred, underline, color and the inlines of every choice.

    A choice opens at a text that begins with its mark, also after a line break inside a text, or at a bold letter that
    stands alone, whose full stop may follow in a text of its own."""
    flat = F.when(F.col("kind") == "table", F.flatten(F.flatten("rows"))).otherwise(F.col("inlines"))
    inlines = options.select(*KEY, "block_idx", F.posexplode(flat).alias("_i", "x"))
    apart = F.when(F.col("x.kind") == "text", F.split("x.text", r"\n(?=\s*[A-D][.)])")).otherwise(F.array(F.lit("")))
    pieces = inlines.select(*KEY, "block_idx", "_i", "x", F.posexplode(apart).alias("_j", "_t"))
    text = F.col("x.kind") == "text"
    pieces = pieces.withColumn("x", F.col("x").withField("text", F.when(text, F.col("_t")).otherwise(F.col("x.text"))))
    marked, bare = F.regexp_extract("x.text", config.OPTION_MARK, 1), F.regexp_extract("x.text", config.BARE_LETTER, 1)
    own = pieces.withColumn("_marked", text & (marked != "")).withColumn("_bare", text & (marked == "") & F.col("x.bold") & (bare != ""))
    own = own.withColumn("_l", F.when(F.col("_marked"), marked).when(F.col("_bare"), bare)).withColumn("_q", F.struct(*KEY))
    order = ("block_idx", "_i", "_j")
    before = F.lag("_bare").over(Window.partitionBy("_q").orderBy(*order))
    own = own.withColumn("_dot", F.coalesce(before, F.lit(False)) & text & F.col("x.text").rlike(config.PUNCTUATION))
    dealt = Q.choices(own, F.col("_l"), "_q", *order).where("choice > 0 OR inferred")
    body = F.when(F.col("_marked"), F.regexp_replace("x.text", config.OPTION_MARK, "")).when(F.col("_bare") | F.col("_dot"), "").otherwise(F.col("x.text"))
    opens = F.col("_marked") | F.col("_bare")
    shown = dealt.withColumn("x", F.col("x").withField("text", body)).withColumn("_blank", text & (F.trim("x.text") == ""))
    real = F.col("inferred") & ~F.col("_blank")
    grouped = shown.groupBy(*KEY, "choice").agg(
        F.max("letter").alias("letter"), F.max("inferred").alias("inferred"), F.max(real).alias("_real"),
        F.max((text | opens) & F.col("x.underline")).alias("underline"), F.max(F.when(opens, F.col("x.color"))).alias("color"),
        F.array_sort(F.collect_list(F.when(~text | (F.col("x.text") != ""), F.struct(*order, "x")))).alias("_v"),
    )
    kept = grouped.where("choice > 0 OR _real")
    return kept.withColumn("inlines", F.transform("_v", lambda v: v["x"])).drop("_v", "_real")


def _odd(values: Column, letters: Column) -> Column:
    """The letter whose value no other has, where there are two values."""
    single = F.filter(F.arrays_zip(values.alias("v"), letters.alias("l")), lambda o: F.size(F.filter(values, lambda x: x == o["v"])) == 1)
    return F.when((F.size(F.array_distinct(values)) == 2) & (F.size(single) == 1), F.get(single, F.lit(0))["l"])


def _ordered(what: Column, when: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("block_idx", what.alias("v"))))), lambda x: x["v"])


def questions(parsed: DataFrame) -> DataFrame:
    """One row a question: path, q_order, record_id, type, content and explanation (HTML), stem (its heading without
    "Câu n."), choices (letter, content), answer (JSON: ids, {id, value} pairs or gaps), letters, answer_source, level,
    inferred_a, essay_guideline."""
    shown = render.asset_html(docx.assets(parsed))
    rows = parts(parsed)
    bodies = render.paragraphs(rows, shown, "_body").join(render.tables(rows, shown).withColumnRenamed("html", "_table"), ["path", "block_idx"], "left")
    html = F.when(F.col("kind") == "table", F.col("_table")).when(F.col("_body") != "", F.concat(F.lit("<p>"), ray_names(F.col("_body")), F.lit("</p>")))
    bodies = bodies.withColumn("_html", html).withColumn("_trimmed", F.when(F.col("named"), F.regexp_replace("_html", r"^(<p>(?:<[bu]>)*)\s*(?iu:câu)\s*\d+\s*[.:)]?\s*", "$1")).otherwise(F.col("_html")))
    stem, tail = F.col("part") == "stem", F.col("part") == "tail"
    grouped = bodies.groupBy(*KEY).agg(
        _ordered(F.col("_html"), stem).alias("_stem"), _ordered(F.col("_trimmed"), stem).alias("_own"), _ordered(F.col("text"), stem).alias("_plain"),
        _ordered(F.col("text"), tail).alias("_tail"), _ordered(F.col("_html"), tail).alias("_shown"), F.max("level").alias("level"),
    )
    picked = choice_rows(rows.where("part = 'option'"))
    inlines = picked.select(*KEY, "choice", F.posexplode_outer("inlines").alias("_i", "x"))
    put = F.array_sort(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("_i", "x", "html"))))
    texts = render.resolved(inlines, shown).groupBy(*KEY, "choice").agg(F.trim(render.joined(put)).alias("_c"))
    content = F.when(F.col("_c").rlike(r"^[.,\s]*$"), "").otherwise(F.concat(F.lit("<p>"), ray_names(F.col("_c")), F.lit("</p>")))
    picked = picked.drop("inlines").join(texts, [*KEY, "choice"], "left").withColumn("content", F.coalesce(content, F.lit("")))
    listed = picked.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("choice", "letter", "content", "underline", "color", "inferred"))).alias("_choices"))
    met = grouped.join(listed, list(KEY), "left").withColumn("_choices", F.coalesce("_choices", F.array().cast(listed.schema["_choices"].dataType)))
    told = Q.answer_from_text(F.get("_tail", F.lit(0)), F.coalesce(F.get("_tail", F.lit(1)), F.lit("")))
    met = met.withColumn("_told", told)
    underlined = F.filter("_choices", lambda c: c["underline"])
    by_line = F.when(F.size(underlined) == 1, F.get(underlined, F.lit(0))["letter"])
    by_colour = _odd(F.transform("_choices", lambda c: F.coalesce(c["color"], F.lit("∅"))), F.transform("_choices", lambda c: c["letter"]))
    some = F.size("_choices") > 0
    formatted = F.when(some & F.col("_told.letters").isNull(), F.coalesce(by_line, by_colour))
    source = F.when(formatted.isNull(), F.col("_told.source")).when(by_line.isNotNull(), "format:underline").otherwise("format:color")
    met = met.withColumn("letters", F.regexp_extract_all(F.coalesce("_told.letters", formatted, F.lit("")), F.lit("([A-D])"), 1)).withColumn("answer_source", source)
    rest = F.when(F.col("_told.rest") != "", F.concat(F.lit("<p>"), F.col("_told.rest"), F.lit("</p>")))
    left = F.concat(F.array(rest), F.slice("_shown", F.col("_told.skip") + 1, F.greatest(F.size("_tail") - F.col("_told.skip"), F.lit(0))))
    lines = lambda c: F.array_join(F.array_compact(c), "\n")
    met = met.withColumn("explanation", F.nullif(lines(left), F.lit(""))).withColumn("_said", F.array_join("_tail", " "))
    plain = F.array_join("_plain", "")
    grouped_tf = Q.true_false(F.transform("_choices", lambda c: c["content"]))
    kind = Q.question_type(F.size("_choices"), grouped_tf, plain.rlike(config.GAP), F.size("letters"))
    ids = F.transform("letters", Q.choice_id)
    answer = (
        F.when(kind == "true-false-group", F.to_json(Q.true_false_values(F.size("_choices"), F.col("_said")), {"ignoreNullFields": "false"}))
        .when(kind == "fill-answer", F.to_json(Q.fill_answers(plain, F.col("_said")))).when(kind.isin("single-choice", "multiple-choice") & (F.size("letters") > 0), F.to_json(ids))
    )
    name = F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1)
    return met.select(
        *KEY, Q.record_id(name, F.col("q_order")).alias("record_id"), kind.alias("type"), lines(F.col("_stem")).alias("content"), lines(F.col("_own")).alias("stem"),
        F.transform("_choices", lambda c: F.struct(c["letter"].alias("letter"), c["content"].alias("content"))).alias("choices"), answer.alias("answer"),
        F.array_join("letters", ",").alias("letters"), "answer_source", "explanation", F.when(kind == "essay", Q.essay_guideline(F.col("explanation"))).alias("essay_guideline"),
        F.when(kind == "fill-answer", "case_insensitive").alias("fill_match_mode"), F.col("level.name").alias("cognitive_level"), F.col("level.number").alias("cognitive_level_num"),
        F.exists("_choices", lambda c: c["inferred"]).alias("inferred_a"),
    )


def audit(found: DataFrame) -> DataFrame:
    """A line for each question: its answer, where it comes from, and what a person should look at."""
    flags = F.array(F.when((F.col("letters") == "") & (F.size("choices") > 0), "ANSWER_UNRESOLVED"), F.when(F.col("inferred_a"), "CHOICE_A_INFERRED"))
    return found.select(*KEY, "answer", "answer_source", F.size("choices").alias("n_choices"), F.array_join(F.array_compact(flags), ",").alias("flags"))


def report(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """path, status (ERROR, EMPTY, OK), error, questions of every file, those without questions included."""
    counts = found.groupBy("path").agg(F.count("*").alias("questions"))
    met = parsed.where("part = 0").select("path", "error").join(counts, "path", "left").withColumn("questions", F.coalesce("questions", F.lit(0)))
    return met.withColumn("status", F.when(F.col("error").isNotNull(), "ERROR").when(F.col("questions") == 0, "EMPTY").otherwise("OK"))


def records(found: DataFrame, described: DataFrame) -> DataFrame:
    """path, q_order, name (of its file), json: a question as the record that deliveries hold, all of its fields present."""
    met = found.join(described, "path", "left")
    null = F.lit(None).cast("string")
    choices = F.when(F.size("choices") > 0, F.transform("choices", lambda c, i: F.struct((i + 1).alias("id"), c["content"].alias("content"))))
    first = F.struct(F.struct(F.col("record_id").alias("$oid")).alias("_id"), null.alias("examId"), "type", "content", choices.alias("choices"))
    last = F.struct(
        F.col("fill_match_mode").alias("fillMatchMode"), F.col("essay_guideline").alias("essayGuideline"), "explanation", null.alias("imageUrl"), F.lit(None).cast("double").alias("score"),
        F.col("q_order").alias("order"), F.lit(0).alias("isDeleted"), null.alias("createdAt"), null.alias("updatedAt"), F.lower("subject").alias("subject"), F.col("subject_name").alias("subject_vi"),
        "grade", "cognitive_level", null.alias("difficulty"), F.lit(False).alias("is_synthesis"), F.lit(None).cast("int").alias("estimated_time_sec"), F.col("chapter").alias("chapter_name"),
        F.col("lesson").alias("lesson_name"), null.alias("kc_id"), F.lit(None).cast("array<string>").alias("kc_ids"), "cognitive_level_num", F.lit(None).cast("double").alias("elo_difficulty"),
        F.lit(None).cast("long").alias("time_fast_ms"), F.lit(None).cast("long").alias("time_slow_ms"),
    )
    whole = lambda s: F.to_json(s, {"ignoreNullFields": "false"})
    a, b = whole(first), whole(last)
    json = F.concat(F.substring(a, F.lit(1), F.length(a) - 1), F.lit(',"answer":'), F.coalesce("answer", F.lit("null")), F.lit(","), F.substring(b, F.lit(2), F.length(b)))
    name = F.concat(file_slug(F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1)), F.format_string("_q%03d.json", "q_order"))
    return met.select(*KEY, name.alias("name"), json.alias("json"))


def structured_name(path: Column, root: str) -> Column:
    """A record's folder and name below the folder that was read: root's own name, the file's folders, its stem."""
    base = root.rstrip("/").rsplit("/", 1)[0]
    below = F.regexp_replace(F.replace(F.regexp_replace(path, "^file:/+", "/"), F.lit(base + "/"), F.lit("")), r"\.[^./]+$", "")
    return F.concat(below, F.format_string("/q%03d.json", "q_order"))


def pages(found: DataFrame, described: DataFrame) -> DataFrame:
    """path, name, html: all questions of a file on one page, a section each."""
    met = found.join(described, "path", "left")
    listed = F.array_join(F.transform("choices", lambda c: F.concat(F.lit("<li>"), F.regexp_replace(c["content"], "^<p>|</p>$", ""), F.lit("</li>"))), "\n")
    facts = definition_list([
        ("Loại", F.when(F.size("choices") > 0, "single-choice").otherwise("essay")), ("Môn", F.col("subject_name")), ("Khối", F.col("grade").cast("string")), ("Bài", F.col("lesson")),
        ("Mức độ nhận thức", F.col("cognitive_level")), ("Mã mức độ", F.col("cognitive_level_num").cast("string")), ("Đáp án", F.col("letters")),
    ])
    pieces = F.array(
        F.lit("<section>"), F.concat(F.lit("<h2>Câu "), F.col("q_order"), F.lit("</h2>")), facts, F.nullif("stem", F.lit("")),
        F.when(F.size("choices") > 0, F.concat(F.lit('<ol type="A">\n'), listed, F.lit("\n</ol>"))), F.concat(F.lit("<div>\n"), F.col("explanation"), F.lit("\n</div>")), F.lit("</section>"),
    )
    sections = met.select("path", F.col("q_order").alias("block_idx"), F.array_join(F.array_compact(pieces), "\n").alias("html"))
    titles = described.select("path", F.col("lesson").alias("title"))
    name = F.concat(file_slug(F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1)), F.lit(".html"))
    return render.page(sections, titles).withColumn("name", name)
