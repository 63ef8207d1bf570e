"""Registered queries that send rows of the driver's tables through packages: each writes packages (sources.writer),
reads them with the package plans, and has an oracle that says from the same rows what must come out."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.formula import mtef, omml
from docframe.functions import tex
from docframe.operators import labelling, schema
from docframe.operators import blocks as B
from docframe.plans import exercises, lesson_schema, lessons
from docframe.plans.catalog import FOLD, KIND_SQL, LINES, PLAIN
from docframe.plans.registry import query, table
from docframe.sources import cfb, docx, sinks, writer


def folder_of(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one where none is named and all run in this process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='docframe-')}"
    return f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}"


def run(text: Column | str, bold: Column | bool = False, color: str | None = None, underline: bool = False, kind: str = "text", data: Column | None = None) -> Column:
    """A run; a plain str is literal text."""
    said = F.lit(text) if isinstance(text, str) else text
    mark = bold if isinstance(bold, Column) else F.lit(bold)
    return F.struct(
        F.lit(kind).alias("kind"), said.cast("string").alias("text"), mark.alias("bold"), F.lit(color).cast("string").alias("color"), F.lit(underline).alias("underline"),
        (F.lit(None).cast("binary") if data is None else data).alias("data"),
    )


def para(*runs: Column | str, style: str = "") -> Column:
    made = F.array(*[run(r) if isinstance(r, str) else r for r in runs])
    none = F.lit(None).cast(f"array<array<{writer.RUN}>>")
    return F.struct(F.lit("para").alias("kind"), F.lit(style).alias("style"), F.lit(None).cast("int").alias("ilvl"), made.alias("runs"), none.alias("cells"))


def number_of(path: Column | str) -> Column:
    """The number that is a file's whole name, or that ends it."""
    return F.regexp_extract(path, r"([0-9]+)\.docx$", 1).cast("long")


# ---- blocks and assets ---------------------------------------------------------------------------------------

SQUEEZED = "regexp_replace(nfc_normalize(part), '[ \t ]+', ' ', 'g')"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS block_idx FROM documents)
  SELECT doc_id, block_idx::BIGINT AS block_idx, regexp_replace(regexp_replace({SQUEEZED}, '^\\s+', ''), '\\s+$', '') AS text, length(part) <= 60 AS bold FROM l WHERE NOT regexp_matches(part, '^\\s*$')""")
def package_blocks(spark, sf_dir):
    """Every line of every document as a paragraph of a package, read back."""
    lines = F.transform(F.split("text", "\n"), lambda t: para(run(t, bold=F.length(t) <= 60)))
    docs = writer.spread(table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text"), "doc_id")
    rows = docs.select(F.concat(F.lit("/in/"), "doc_id", F.lit(".docx")).alias("path"), lines.alias("paragraphs"))
    found = docx.blocks(docx.parse(writer.packages(rows)))
    return found.where("text != ''").select(number_of("path").alias("doc_id"), F.col("block_idx").cast("long").alias("block_idx"), "text", "bold")


def _with_parts(rows: DataFrame) -> DataFrame:
    """rows (nation, k) plus image and equation: bytes of a picture and of an embedded equation."""

    def make(batches):
        image = lru_cache(writer.png)
        equation = lru_cache(lambda nation, d: writer.compound(writer.equation([("frac", list(str(nation)), list(str(d)))])))
        for batch in batches:
            images, equations = [], []
            for nation, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                images.append(image(1 + k % 5, 1 + k % 3))
                equations.append(equation(nation, 1 + k % 7))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(images, pa.binary()), pa.array(equations, pa.binary())], ["nation", "k", "image", "equation"])

    return rows.mapInArrow(make, "nation long, k long, image binary, equation binary")


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), F.col("c_custkey").cast("long").alias("k"))


def _parted(spark, sf_dir) -> DataFrame:
    """Parsed packages, one a nation, of a paragraph with a picture and an equation for each customer. Keys move and are
    ordered; bytes are made where the package is written."""
    one = para(run("x", kind="image", data=F.col("image")), run("y", kind="equation", data=F.col("equation")))
    rows = _with_parts(writer.gathered(_customers(spark, sf_dir), "nation", "k"))
    return docx.parse(writer.bundled(rows.select(F.concat(F.lit("/in/"), "nation", F.lit(".docx")).alias("path"), one.alias("paragraph"))))


@query("""WITH c AS (SELECT c_nationkey AS nation, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS j FROM customer),
  r AS (SELECT nation, 2 * j AS ref, 'figure' AS kind, 1 + k % 5 AS width, 1 + k % 3 AS height, NULL AS latex FROM c
        UNION ALL SELECT nation, 2 * j + 1, 'formula', 0, 0, '\\frac{' || nation || '}{' || (1 + k % 7) || '}' FROM c),
  d AS (SELECT nation, kind, width, height, latex, min(ref) AS first, count(*) AS uses, string_agg(ref, ',' ORDER BY ref) AS refs FROM r GROUP BY ALL)
  SELECT nation::BIGINT AS nation, CASE kind WHEN 'formula' THEN 'f' ELSE 'img' END || row_number() OVER (PARTITION BY nation ORDER BY first) AS aid, kind, latex, width::BIGINT AS width, height::BIGINT AS height,
    uses, refs, CASE kind WHEN 'formula' THEN 0.93 ELSE 0 END::DOUBLE AS confidence, CASE kind WHEN 'formula' THEN 'mtef' END AS source, 'image/png' AS mime FROM d""")
def package_assets(spark, sf_dir):
    """Pictures and embedded equations of one package a nation: each distinct asset once, numbered by first use."""
    found = docx.assets(_parted(spark, sf_dir))
    uses = F.array_join(F.transform("uses", lambda x: x.cast("string")), ",")
    return found.select(
        number_of("path").alias("nation"), "aid", "kind", "latex", F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"), F.size("uses").cast("long").alias("uses"),
        uses.alias("refs"), F.round("confidence", 6).alias("confidence"), "source", "mime",
    )


# ---- formulas ------------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE l_linenumber WHEN 1 THEN '\\frac{' || l_partkey || '}{' || l_suppkey || '}' WHEN 2 THEN 'x^{' || l_partkey || '}' WHEN 3 THEN '\\sqrt{' || l_partkey || '}'
    WHEN 4 THEN '\\left( ' || l_partkey || ' \\right)' WHEN 5 THEN '\\frac{' || l_partkey || '}{2}' WHEN 6 THEN '\\frac{' || l_partkey || '}{' || l_suppkey || '}' END AS latex,
    CASE WHEN l_linenumber = 5 THEN 'tex' WHEN l_linenumber = 6 THEN 'mtef_partial' WHEN l_linenumber > 6 THEN 'unresolved' ELSE 'mtef' END AS source,
    CASE WHEN l_linenumber = 5 THEN 1 WHEN l_linenumber = 6 THEN 0.73 WHEN l_linenumber > 6 THEN 0 ELSE 0.93 END::DOUBLE AS confidence FROM lineitem""")
def equation_forms(spark, sf_dir):
    """Equations in compound files: templates, typed formulas, a stream that ends early, no equation at all."""

    def stream(line: int, part: int, supplier: int) -> bytes:
        a, b = list(str(part)), list(str(supplier))
        made = {
            1: lambda: writer.equation([("frac", a, b)]), 2: lambda: writer.equation(["x", ("script", [], a)]), 3: lambda: writer.equation([("root", a, [])]), 4: lambda: writer.equation([("fence", a)]),
            5: lambda: writer.equation(["x"]) + mtef.TEX_MARK + rf"\[ \frac{{{part}}}{{2}} \]".encode() + b"\0", 6: lambda: writer.equation([("frac", a, b)])[:-3],
        }
        return made.get(line, lambda: b"no equation")()

    def read(batches):
        decoded = lru_cache(8)(lambda *equation: mtef.decode(cfb.equation_stream(writer.compound(stream(*equation)))))  # equal ones follow each other
        for batch in batches:
            out = []
            for key, line, part, supplier in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                form = min(line or 7, 7)
                found = decoded(form, part if form < 7 else 0, supplier if form in (1, 6) else 0)
                out.append((key, line, found["latex"], found["source"], found["selectors"]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["l_orderkey", "l_linenumber", "latex", "source", "selectors"])

    rows = writer.spread(table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long"), "l_partkey", "l_suppkey"), "l_linenumber", "l_partkey")
    rows = rows.sortWithinPartitions("l_linenumber", "l_partkey", "l_suppkey")
    found = rows.mapInArrow(read, "l_orderkey long, l_linenumber long, latex string, source string, selectors array<int>")
    return found.select("l_orderkey", "l_linenumber", "latex", "source", F.round(tex.confidence(F.col("source"), F.col("selectors")), 6).alias("confidence"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '\\frac{' || p_partkey || '}{' || p_size || '}' WHEN 1 THEN '\\sqrt[' || p_size || ']{' || p_partkey || '}' WHEN 2 THEN 'x_{' || p_size || '}^{' || p_partkey || '}'
    WHEN 3 THEN '\\sum_{' || p_size || '}^{' || p_partkey || '} k' WHEN 4 THEN '\\left[ ' || p_partkey || ' \\right]' ELSE '\\begin{matrix}' || p_partkey || ' & ' || p_size || '\\end{matrix}' END AS latex FROM part""")
def omml_forms(spark, sf_dir):
    """Typed formulas as packages hold them."""
    r = lambda x: F.concat(F.lit("<m:r><m:t>"), F.lit(x) if isinstance(x, str) else x.cast("string"), F.lit("</m:t></m:r>"))
    e = lambda name, *inner: F.concat(F.lit(f"<m:{name}>"), *inner, F.lit(f"</m:{name}>"))
    a, b, turn = F.col("p_partkey"), F.col("p_size"), F.col("p_size") % 6
    body = (
        F.when(turn == 0, e("f", e("num", r(a)), e("den", r(b)))).when(turn == 1, e("rad", e("deg", r(b)), e("e", r(a)))).when(turn == 2, e("sSubSup", e("e", r("x")), e("sub", r(b)), e("sup", r(a))))
        .when(turn == 3, e("nary", F.lit("<m:naryPr><m:chr m:val='∑'/></m:naryPr>"), e("sub", r(b)), e("sup", r(a)), e("e", r("k"))))
        .when(turn == 4, e("d", F.lit("<m:dPr><m:begChr m:val='['/><m:endChr m:val=']'/></m:dPr>"), e("e", r(a)))).otherwise(e("m", e("mr", e("e", r(a)), e("e", r(b)))))
    )
    xml = F.concat(F.lit(f"<m:oMath xmlns:m='{omml.NAMESPACE.strip('{}')}'>"), body, F.lit("</m:oMath>"))

    def read(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([omml.to_latex(x) for x in batch.column(1).to_pylist()], pa.string())], ["p_partkey", "latex"])

    return table(spark, sf_dir, "part").select("p_partkey", xml.alias("xml")).mapInArrow(read, "p_partkey long, latex string")


@query("""SELECT p_partkey, 'x_{' || p_size || '}\\ne \\lim\\limits_{n\\to' || p_partkey || '}\\setminus ab12c + \\text{ điện } 3y_{' || p_size || '}' AS shown FROM part""")
def formula_display(spark, sf_dir):
    """What a page's typesetter gets of a formula."""
    n, k = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    latex = F.concat(F.lit("x"), n, F.lit("\\neq lim_{n\\to"), k, F.lit("}∖ab12c + điện 3y"), n)
    return table(spark, sf_dir, "part").select("p_partkey", F.replace(tex.display(latex), F.lit("\\ne\\lim"), F.lit("\\ne \\lim")).alias("shown"))


@query("""WITH p AS (SELECT p_partkey, p_size % 5 AS o, p_size % 3 AS c, p_size % 4 AS l, p_size % 2 AS r FROM part)
  SELECT p_partkey, (o - c)::BIGINT AS braces, (l - r)::BIGINT AS fences, o = c AND l = r AS sendable FROM p""")
def formula_balance(spark, sf_dir):
    """Balance of braces, escaped ones apart, and of fences."""
    n = F.col("p_size")
    latex = F.concat(F.lit(r"\{"), F.repeat(F.lit("{a"), n % 5), F.repeat(F.lit("}"), n % 3), F.repeat(F.lit(r"\left("), n % 4), F.repeat(F.lit(r"\right)"), n % 2), F.lit(r"\leftarrow"))
    b = tex.balance(latex)
    return table(spark, sf_dir, "part").select("p_partkey", b["braces"].cast("long").alias("braces"), b["fences"].cast("long").alias("fences"), tex.sendable(latex).alias("sendable"))


# ---- metadata ------------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT p_partkey, p_size % 4 AS c, 1 + p_size % 20 AS n, 'p' || p_partkey AS t FROM part)
  SELECT p_partkey, CASE c WHEN 0 THEN 'MATH' WHEN 1 THEN 'CHEM' WHEN 2 THEN 'LIT' ELSE 'UNK' END AS subject, CASE c WHEN 0 THEN 12 WHEN 1 THEN 11 WHEN 2 THEN 10 END::BIGINT AS grade,
    CASE WHEN c < 3 THEN n END::BIGINT AS number, CASE c WHEN 2 THEN 'Đọc ' || t WHEN 3 THEN t ELSE 'Đạo hàm ' || t END AS title, CASE c WHEN 1 THEN 'Chương 2' END AS chapter,
    CASE c WHEN 0 THEN 'math-12-kntt-bai-' || lpad(n::VARCHAR, 2, '0') || '-dao-ham-' || t WHEN 1 THEN 'chem-11-kntt-bai-' || lpad(n::VARCHAR, 2, '0') || '-dao-ham-' || t
      WHEN 2 THEN 'lit-10-kntt-bai-' || lpad(n::VARCHAR, 2, '0') || '-doc-' || t ELSE 'unk-0-kntt-bai-x-' || t END AS doc_id FROM p""")
def file_metadata(spark, sf_dir):
    """Subject, grade, lesson and chapter from paths and first paragraphs."""
    c, n, t = F.col("p_size") % 4, (F.col("p_size") % 20 + 1).cast("string"), F.concat(F.lit("p"), "p_partkey")
    path = (
        F.when(c == 0, F.concat(F.lit("/in/Toán 12/Bài "), n, F.lit(" - Đạo hàm "), t)).when(c == 1, F.concat(F.lit("/in/Hóa 11/Chương 2/(Bài "), n, F.lit(". Đạo hàm "), t))
        .when(c == 2, F.concat(F.lit("/in/Văn 10/"), t)).otherwise(F.concat(F.lit("/in/khác/3. "), t))
    )
    head = F.when(c == 2, F.array(F.concat(F.lit("BÀI "), n, F.lit(": Tên chương")), F.concat(F.lit("VĂN BẢN 1: Đọc "), t))).otherwise(F.array(F.lit("Mở đầu")))
    found = docx.metadata(F.concat(path, F.lit(".docx")), head)
    names = ("subject", "title", "chapter", "doc_id")
    rows = writer.spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    return rows.select("p_partkey", *[found[x].alias(x) for x in names], found["grade"].cast("long").alias("grade"), found["number"].cast("long").alias("number"))


# ---- exercises -----------------------------------------------------------------------------------------------


def _questions(spark, sf_dir) -> DataFrame:
    """Parsed packages, one a conversation: a level for each system turn, a question for any other, of nine kinds. Paragraphs
    reach the writer as rows of their own, in order: what it holds does not grow with how many conversations a task has."""
    start, end = para("A. KIẾN THỨC TRỌNG TÂM"), para("B. BÀI TẬP")
    turn, kind = F.col("turn").cast("string"), (F.col("conv_id") + F.col("turn")) % 9
    stem = F.concat(F.lit("Câu "), turn, F.lit(". "), F.col("_m"))
    asked = lambda *more: F.array(para(run(stem)), *more)
    lettered = [para(run(F.concat(F.lit(f"{c}. {c.lower()}"), turn))) for c in "ABCD"]
    made = (
        F.when(F.col("role") == "system", F.array(para(run(F.concat(F.lit("Level "), (F.col("turn") % 3 + 1).cast("string"))))))
        .when(kind == 0, asked(*lettered, para("Đáp án: B"), para("vì")))
        .when(kind == 1, asked(para(run("A. p", bold=True), "q ", run("B. r", bold=True), "s"), para("Lời giải"), para("Chọn A. do")))
        .when(kind == 2, asked(para("A. x"), para(run("B. y", underline=True)), para("C. z")))
        .when(kind == 3, asked(para(run("A. x", color="FF0000")), para("B. y"), para("C. z")))
        .when(kind == 4, asked(para(run("A", bold=True), run(".", color="111111"), " x"), para("B. y")))
        .when(kind == 5, asked(para("một ", run("B. hai", bold=True))))
        .when(kind == 6, F.array(para(run(F.concat(stem, F.lit(" ___")))), para("Đáp án: một, hai")))
        .when(kind == 7, asked(para("Lời giải"), para("Chấm theo thang điểm")))
        .otherwise(asked(para("A. a) x"), para("B. b) y"), para("Đáp án: A, B"), para("a) đúng b) sai")))
    )
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("_m"))
    order = ("turn", "_p")
    turns = writer.spread(said, "conv_id").select("conv_id", "turn", made.alias("_p")).sortWithinPartitions("conv_id", *order)
    turns = turns.withColumn("_n", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    every = F.when(F.col("_n") == 1, F.concat(F.array(start, para("1. x"), end), "_p")).otherwise(F.col("_p"))
    rows = turns.select("conv_id", F.explode(every).alias("paragraph")).select(F.concat(F.lit("/in/"), "conv_id", F.lit(".docx")).alias("path"), "paragraph")
    return sinks.stage(docx.parse(writer.bundled(rows)), folder_of(spark), "parsed")


ASKED = """a AS (SELECT *, (conv_id + turn) % 9 AS k, md5(text) AS m, last_value(CASE WHEN role = 'system' THEN 1 + turn % 3 END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS num FROM conversations),
  q AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS q_order FROM a WHERE role <> 'system'),
  e AS (SELECT *, CASE k WHEN 6 THEN 'fill-answer' WHEN 7 THEN 'essay' WHEN 8 THEN 'true-false-group' ELSE 'single-choice' END AS type,
    CASE k WHEN 0 THEN ['a' || turn, 'b' || turn, 'c' || turn, 'd' || turn] WHEN 1 THEN ['pq ', 'rs'] WHEN 2 THEN ['x', 'y', 'z'] WHEN 3 THEN ['x', 'y', 'z'] WHEN 4 THEN ['x', 'y']
      WHEN 5 THEN ['một ', 'hai'] WHEN 8 THEN ['a) x', 'b) y'] ELSE [] END AS c,
    CASE k WHEN 0 THEN '[2]' WHEN 1 THEN '[1]' WHEN 2 THEN '[2]' WHEN 3 THEN '[1]' WHEN 6 THEN '[["một","hai"]]' WHEN 8 THEN '[{"id":1,"value":"true"},{"id":2,"value":"false"}]' END AS answer,
    CASE k WHEN 0 THEN 'B' WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'A' WHEN 8 THEN 'A,B' ELSE '' END AS letters,
    CASE k WHEN 0 THEN 'text:đáp_án' WHEN 1 THEN 'text:chọn' WHEN 2 THEN 'format:underline' WHEN 3 THEN 'format:color' WHEN 6 THEN 'unrecognized_tail_format' WHEN 7 THEN 'essay_no_answer_letter'
      WHEN 8 THEN 'text:đáp_án' ELSE 'none' END AS answer_source,
    CASE k WHEN 0 THEN '<p>vì</p>' WHEN 1 THEN '<p>do</p>' WHEN 6 THEN '<p>Đáp án: một, hai</p>' WHEN 7 THEN '<p>Chấm theo thang điểm</p>' WHEN 8 THEN '<p>a) đúng b) sai</p>' END AS explanation,
    CASE k WHEN 7 THEN 'Chấm theo thang điểm' END AS essay_guideline, m || CASE WHEN k = 6 THEN ' ___' ELSE '' END AS said FROM q)"""


@query(f"""WITH {ASKED} SELECT conv_id, q_order, substr(md5(conv_id || '_' || q_order), 1, 24) AS record_id, type, '<p>Câu ' || turn || '. ' || said || '</p>' AS content,
  array_to_string(list_transform(c, lambda x: '<p>' || trim(x) || '</p>'), '|') AS choices, answer, letters, answer_source, explanation, essay_guideline,
  ['knowledge', 'comprehension', 'application'][num] AS cognitive_level, num::BIGINT AS cognitive_level_num, k = 5 AS inferred_a FROM e""")
def exercise_questions(spark, sf_dir):
    """Questions of nine kinds with choices in one paragraph, letters of their own, marks, gaps, statements and levels."""
    found = exercises.questions(_questions(spark, sf_dir))
    choices = F.array_join(F.transform("choices", lambda c: c["content"]), "|")
    return found.select(
        number_of("path").alias("conv_id"), "q_order", "record_id", "type", "content", choices.alias("choices"), "answer", "letters", "answer_source", "explanation", "essay_guideline", "cognitive_level",
        F.col("cognitive_level_num").cast("long").alias("cognitive_level_num"), "inferred_a",
    )


@query(f"""WITH {ASKED}, s AS (SELECT conv_id, q_order, concat_ws(chr(10), '<section>', '<h2>Câu ' || q_order || '</h2>',
    '<dl><dt>Loại</dt><dd>' || CASE WHEN len(c) > 0 THEN 'single-choice' ELSE 'essay' END || '</dd><dt>Môn</dt><dd>?</dd>' || CASE WHEN conv_id IN (10, 11, 12) THEN '<dt>Khối</dt><dd>' || conv_id || '</dd>' ELSE '' END ||
      '<dt>Bài</dt><dd>' || conv_id || '</dd>' || coalesce('<dt>Mức độ nhận thức</dt><dd>' || ['knowledge', 'comprehension', 'application'][num] || '</dd><dt>Mã mức độ</dt><dd>' || num || '</dd>', '') ||
      CASE WHEN letters <> '' THEN '<dt>Đáp án</dt><dd>' || letters || '</dd>' ELSE '' END || '</dl>', '<p>' || said || '</p>',
    CASE WHEN len(c) > 0 THEN '<ol type="A">' || chr(10) || array_to_string(list_transform(c, lambda x: '<li>' || trim(x) || '</li>'), chr(10)) || chr(10) || '</ol>' END,
    '<div>' || chr(10) || explanation || chr(10) || '</div>', '</section>') AS html FROM e)
  SELECT conv_id, conv_id || '.html' AS name, md5('<!doctype html>' || chr(10) || '<html>' || chr(10) || '<head><meta charset="utf-8"><title>' || conv_id || '</title></head>' || chr(10) || '<body>' || chr(10) || '<h1>' || conv_id || '</h1>' ||
    chr(10) || string_agg(html, chr(10) ORDER BY q_order) || chr(10) || '</body>' || chr(10) || '</html>') AS html_md5 FROM s GROUP BY conv_id""")
def exercise_pages(spark, sf_dir):
    """One page a file, a section a question."""
    parsed = _questions(spark, sf_dir)
    found = exercises.pages(exercises.questions(parsed), docx.described(docx.blocks(parsed)))
    return found.select(number_of("path").alias("conv_id"), "name", F.md5(F.col("html").cast("binary")).alias("html_md5"))


@query(f"""WITH {ASKED} SELECT conv_id, q_order, conv_id || '_q' || lpad(q_order::VARCHAR, greatest(3, length(q_order::VARCHAR))::INT, '0') || '.json' AS name, substr(md5(conv_id || '_' || q_order), 1, 24) AS oid, type, len(c) AS n_choices, answer,
    letters = '' AND len(c) > 0 AS unresolved, ['knowledge', 'comprehension', 'application'][num] AS cognitive_level, 30 AS fields FROM e""")
def exercise_records(spark, sf_dir):
    """Questions as the records that deliveries hold, taken apart again."""
    parsed = _questions(spark, sf_dir)
    questions = sinks.stage(exercises.questions(parsed), folder_of(spark), "questions")
    made = exercises.records(questions, docx.described(docx.blocks(parsed))).join(exercises.audit(questions).select(*exercises.KEY, "flags"), list(exercises.KEY))
    read = F.from_json("json", "_id struct<`$oid`:string>, type string, choices array<struct<id:int,content:string>>, cognitive_level string, `order` long")
    rows = made.withColumn("_r", read)
    return rows.select(
        number_of("path").alias("conv_id"), F.col("_r.order").alias("q_order"), "name", F.col("_r._id.$oid").alias("oid"), F.col("_r.type").alias("type"),
        F.coalesce(F.size("_r.choices"), F.lit(0)).cast("long").alias("n_choices"), F.nullif(F.get_json_object("json", "$.answer"), F.lit("")).alias("answer"),
        F.col("flags").contains("ANSWER_UNRESOLVED").alias("unresolved"), F.col("_r.cognitive_level").alias("cognitive_level"), F.json_object_keys("json").alias("_k"),
    ).withColumn("fields", F.size("_k").cast("long")).drop("_k")


# ---- lessons -------------------------------------------------------------------------------------------------


def _lessons(spark, sf_dir) -> DataFrame:
    """Parsed packages, one a document: its lines, some of them numbered, between the theory's markers."""
    lines = B.lines(table(spark, sf_dir, "documents"))
    size, line = F.length("text"), F.col("text")
    made = F.when((size % 6 == 0) & (size <= 80), F.concat(F.lit("I. "), line)).when((size % 6 == 1) & (size <= 80), F.concat(F.lit("1. "), line)).when(size % 6 == 2, F.concat(F.lit("a) "), line)).otherwise(line)
    body = F.transform(F.array_sort(F.collect_list(F.struct("block_idx", para(run(made)).alias("p")))), lambda v: v["p"])
    path = F.concat(F.lit("/in/toan 12/Bài 7 - t"), "doc_id", F.lit(".docx"))
    rows = lines.groupBy("doc_id").agg(body.alias("_b")).select(path.alias("path"), F.concat(F.array(para("A. KIẾN THỨC TRỌNG TÂM")), "_b", F.array(para("B. BÀI TẬP"))).alias("paragraphs"))
    return sinks.stage(docx.parse(writer.packages(rows)), folder_of(spark), "parsed")


NUMERALS = {"roman": "^(X{0,2}(?:IX|IV|V?I{0,3}))\\\\s*[.)\\\\-–:]\\\\s+(.*)$", "arabic": "^([0-9]{1,2})\\\\s*[.)\\\\-–:]\\\\s+(.*)$", "alpha_upper": "^([A-Z])\\\\s*[.)\\\\-–:]\\\\s+(.*)$"}
NUMERAL_SQL = {k: v.replace("\\\\", "\\") for k, v in NUMERALS.items()}
NODES = LINES + f""", z AS (SELECT doc_id, block_idx, regexp_replace(nfc_normalize(CASE WHEN length(text) % 6 = 0 AND length(text) <= 80 THEN 'I. ' || text WHEN length(text) % 6 = 1 AND length(text) <= 80 THEN '1. ' || text
    WHEN length(text) % 6 = 2 THEN 'a) ' || text ELSE text END), '[ \t ]+', ' ', 'g') AS text FROM b),
  y AS (SELECT *, CASE WHEN length(text) <= 100 THEN CASE WHEN regexp_extract(text, '{NUMERAL_SQL["roman"]}', 1) <> '' THEN 'roman' WHEN regexp_matches(text, '{NUMERAL_SQL["arabic"]}') THEN 'arabic'
    WHEN regexp_matches(text, '{NUMERAL_SQL["alpha_upper"]}') THEN 'alpha_upper' END END AS kind FROM z),
  x AS (SELECT doc_id, block_idx, kind, CASE kind WHEN 'roman' THEN regexp_extract(text, '{NUMERAL_SQL["roman"]}', 1) WHEN 'arabic' THEN regexp_extract(text, '{NUMERAL_SQL["arabic"]}', 1) ELSE regexp_extract(text, '{NUMERAL_SQL["alpha_upper"]}', 1) END AS numbering,
    coalesce(nullif(CASE kind WHEN 'roman' THEN regexp_extract(text, '{NUMERAL_SQL["roman"]}', 2) WHEN 'arabic' THEN regexp_extract(text, '{NUMERAL_SQL["arabic"]}', 2) ELSE regexp_extract(text, '{NUMERAL_SQL["alpha_upper"]}', 2) END, ''), text) AS title,
    CASE kind WHEN 'alpha_upper' THEN 1 WHEN 'roman' THEN 2 ELSE 3 END AS rank FROM y WHERE kind IS NOT NULL),
  r AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY rank) AS level FROM x),
  i AS (SELECT y.doc_id, min(block_idx) FILTER (kind IS NULL) < coalesce(min(block_idx) FILTER (kind IS NOT NULL), 1000000000) OR count(kind) = 0 AS intro FROM y GROUP BY y.doc_id),
  h AS (SELECT doc_id, block_idx, level, numbering, title FROM r UNION ALL SELECT doc_id, -1, 1, '', '' FROM i WHERE intro),
  l AS (SELECT *, last_value(CASE WHEN level = 1 THEN block_idx END IGNORE NULLS) OVER w AS l1, last_value(CASE WHEN level = 2 THEN block_idx END IGNORE NULLS) OVER w AS l2
        FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  t AS (SELECT *, CASE level WHEN 2 THEN l1 WHEN 3 THEN greatest(l1, l2) END AS parent_idx FROM l),
  o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, parent_idx ORDER BY block_idx) AS ord FROM t)"""


@query(f"""WITH RECURSIVE {NODES}, p AS (SELECT doc_id, block_idx, level, numbering, title, ord::VARCHAR AS tree_path FROM o WHERE parent_idx IS NULL
  UNION ALL SELECT o.doc_id, o.block_idx, o.level, o.numbering, o.title, p.tree_path || '.' || o.ord FROM o JOIN p ON o.doc_id = p.doc_id AND o.parent_idx = p.block_idx),
  g AS (SELECT *, {FOLD.format('title')} AS f FROM p)
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block_idx) AS place, level, numbering, md5(title) AS title_md5, tree_path, {KIND_SQL} AS title_kind FROM g""")
def lesson_sections(spark, sf_dir):
    """The nodes of lessons read from packages, with what stands before the first heading."""
    _, kept = lessons.theory(_lessons(spark, sf_dir))
    kept = sinks.stage(kept, folder_of(spark), "theory-blocks")
    place = F.row_number().over(Window.partitionBy("path").orderBy("at")).cast("long")
    return lessons.sections(kept).select(number_of("path").alias("doc_id"), place.alias("place"), "level", "numbering", F.md5(F.col("title").cast("binary")).alias("title_md5"), "tree_path", "title_kind")


@query(f"""WITH {NODES}, w AS (SELECT doc_id, count(*) FILTER (kind IS NULL) AS blocks, sum(len(regexp_extract_all(text, '[^\\s]+'))) AS words FROM y GROUP BY doc_id), n AS (SELECT doc_id, count(*) AS nodes FROM h GROUP BY doc_id)
  SELECT doc_id, 'math-12-kntt-bai-07-t' || doc_id AS lesson_id, 0 AS violations, nodes, blocks, words::BIGINT AS words, CASE WHEN words < 50 THEN 'FAIL' WHEN words < 150 THEN 'WARN' ELSE 'PASS' END AS status FROM w JOIN n USING (doc_id)""")
def lesson_documents(spark, sf_dir):
    """Lesson documents of those packages, held against their schema."""
    folder = folder_of(spark)
    made = lessons.documents(_lessons(spark, sf_dir), work=lambda rows, name: sinks.stage(rows, folder, name))
    found = schema.validate(made, "json", lesson_schema.LESSON)
    count = lambda key: F.regexp_count("json", F.lit(rf'"{key}":')).cast("long")
    return found.select(
        number_of("path").alias("doc_id"), F.col("doc_id").alias("lesson_id"), F.size("violations").cast("long").alias("violations"), count("node_id").alias("nodes"), count("block_id").alias("blocks"),
        F.get_json_object("json", "$.stats.words").cast("long").alias("words"), F.get_json_object("json", "$.quality.status").alias("status"),
    )


# ---- labels --------------------------------------------------------------------------------------------------

_ASKS = " ".join(f"WHEN {' OR '.join(f'contains(p, {v!r})' for v in verbs)} THEN '{label}'" for label, verbs in labelling.VERBS)
_LEVEL = "CASE l WHEN 'van_dung_cao' THEN 4 WHEN 'van_dung' THEN 3 WHEN 'thong_hieu' THEN 2 ELSE 1 END"
_NAME = "CASE l WHEN 'van_dung_cao' THEN 'application_high' WHEN 'van_dung' THEN 'application' WHEN 'thong_hieu' THEN 'comprehension' ELSE 'knowledge' END"


@query(f"""WITH c AS (SELECT conv_id, turn, lower({PLAIN.format("text || CASE turn % 4 WHEN 0 THEN ' prove' WHEN 1 THEN ' compute' WHEN 2 THEN ' explain' ELSE '' END")}) AS p FROM conversations),
  l AS (SELECT conv_id, turn, CASE {_ASKS} ELSE 'nhan_biet' END AS l FROM c) SELECT conv_id, turn, {_NAME} AS cognitive_level, {_LEVEL}::BIGINT AS cognitive_level_num FROM l""")
def label_enrichment(spark, sf_dir):
    """Turns labelled through the labeler's interface, by the one that needs no network."""
    from docframe.functions.text import strip_html

    verb = F.when(F.col("turn") % 4 == 0, " prove").when(F.col("turn") % 4 == 1, " compute").when(F.col("turn") % 4 == 2, " explain").otherwise("")
    none = F.lit(None)
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", strip_html(F.concat("text", verb)).alias("prompt"), none.cast("string").alias("cognitive_level"), none.cast("int").alias("cognitive_level_num")
    )
    return labelling.enrich(rows, "prompt").select("conv_id", "turn", "cognitive_level", F.col("cognitive_level_num").cast("long").alias("cognitive_level_num"))



