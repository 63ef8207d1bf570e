"""Registered queries of sources, sinks, streams, markers and rendering on rows that stand for documents, each with an
oracle that says from the same rows what must come out."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.formula import mtef
from docframe.formula.tables import TCVN3
from docframe.functions import tex
from docframe.functions.text import file_slug, fold, fold_plain
from docframe.operators import blocks as B
from docframe.operators import labelling, quality, render
from docframe.operators import questions as Q
from docframe.plans import config, exercises
from docframe.plans.catalog import FOLD, LINES
from docframe.plans.package_queries import folder_of, number_of, para, run
from docframe.plans.registry import query, table
from docframe.sources import docx, sinks, writer
from docframe.streaming import ingest


# ---- sources and sinks ---------------------------------------------------------------------------------------


@query("""SELECT lower(replace(n_name, ' ', '-')) || '.docx' AS name, length(n_name) + 2 AS bytes FROM nation""")
def directory_scan(spark, sf_dir):
    """Named files in folders of their own, scanned without temporary and resource files and other kinds."""
    nation, folder = table(spark, sf_dir, "nation"), folder_of(spark)
    body, base = F.concat("n_name", F.lit("é")), file_slug(F.col("n_name"))
    kinds = F.array(*[F.concat(F.lit(p), base, F.lit(e)) for p, e in (("a/", ".docx"), ("a/~$", ".docx"), ("b/._", ".docx"), ("", ".txt"))])
    sinks.write_named(nation.select(F.explode(kinds).alias("name"), body.alias("body")), folder, "name", "body").count()
    return docx.scan(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


@query("""SELECT n_regionkey::VARCHAR AS region, n_name || '.txt' AS name, md5(n_name) AS body_md5 FROM nation""")
def zip_bundle(spark, sf_dir):
    """One archive a group, opened again."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.concat("n_name", F.lit(".txt")).alias("name"), F.col("n_name").alias("body"))

    def opened(batches):
        for batch in batches:
            found = [(g, n, z.read(n).decode()) for g, a in zip(*(c.to_pylist() for c in batch.columns), strict=True) for z in [zipfile.ZipFile(io.BytesIO(a))] for n in z.namelist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found, strict=True)], ["region", "name", "body"])

    back = sinks.zip_bundles(rows, "region", "name", "body").mapInArrow(opened, "region string, name string, body string")
    return back.select("region", "name", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@query("SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def json_lines(spark, sf_dir):
    """Rows as JSON lines, read back."""
    rows, folder = table(spark, sf_dir, "conversations"), folder_of(spark)
    sinks.write_json_lines(rows, folder)
    return spark.read.schema(rows.schema).json(folder).select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("""SELECT doc_id, md5(text || CASE WHEN doc_id % 3 = 0 THEN '!' ELSE '' END) AS content_hash FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, md5(text) FROM documents WHERE doc_id % 2 = 1 AND doc_id % 5 = 0""")
def delivered_state(spark, sf_dir):
    """The delivered state after a second delivery, of which only what is new or changed is sent."""
    docs = table(spark, sf_dir, "documents")
    old = docs.where("doc_id % 2 = 0 OR doc_id % 5 = 0").select("doc_id", F.md5(F.col("text").cast("binary")).alias("content_hash"))
    text = F.concat("text", F.when(F.col("doc_id") % 3 == 0, "!").otherwise(""))
    return sinks.deliver(docs.where("doc_id % 2 = 0").select("doc_id", F.md5(text.cast("binary")).alias("content_hash")), old)[1]


@query("SELECT r_name AS name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def stage_tables(spark, sf_dir):
    """A stage kept as a table: the second call reads what the first one wrote, whatever it is given."""
    folder = folder_of(spark)
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("n"))
    sinks.stage(joined, folder, "counts")
    return sinks.stage(joined.where("n < 0"), folder, "counts")


# ---- streams -------------------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """The events as a stream through build, all of it, into a table."""
    folder = folder_of(spark)
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    made = build(events)
    made.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(made.schema).parquet(f"{folder}/out")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
  SELECT start, event_type, n FROM w, m WHERE start + INTERVAL 1 HOUR <= mark""")
def stream_windows(spark, sf_dir):
    """Counts of event-time windows; those that the watermark has not passed are not out yet."""
    counted = _streamed(spark, sf_dir, lambda e: ingest.windowed_counts(e, "ts", "1 hour", "10 minutes", "event_type").select(F.col("window.start").alias("start"), "event_type", "n"))
    return counted.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    """Each content once within the watermark's delay, which is longer here than all events."""
    marked = lambda e: e.select("ts", "user_id", "event_type", F.sha2(F.concat_ws(":", "user_id", "event_type"), 256).alias("content_hash"))
    return _streamed(spark, sf_dir, lambda e: ingest.once(marked(e), "ts", "400 days").select("user_id", "event_type"))


# ---- markers, letters and levels -----------------------------------------------------------------------------

MADE = """m AS (SELECT n_nationkey AS k, CASE n_nationkey % 25 WHEN 0 THEN 'A. KIẾN THỨC TRỌNG TÂM' WHEN 1 THEN 'A – LÝ THUYẾT (KIẾN THỨC TRỌNG TÂM)' WHEN 2 THEN 'A. TÓM TẮT LÝ THUYẾT' WHEN 3 THEN 'Phần A: Tóm tắt kiến thức' WHEN 4 THEN 'B. Phần lí thuyết'
  WHEN 5 THEN 'Kiến thức trọng tâm' WHEN 6 THEN 'A) PHẦN LÝ THUYẾT' WHEN 7 THEN 'B. BÀI TẬP' WHEN 8 THEN 'B – BÀI TẬP' WHEN 9 THEN 'BÀI TẬP TRẮC NGHIỆM' WHEN 10 THEN 'Phần bài tập' WHEN 11 THEN 'B. PHẦN BÀI TẬP' WHEN 12 THEN 'B. PEPTIDE' WHEN 13 THEN 'Level 1: dễ'
  WHEN 14 THEN 'LEVEL3' WHEN 15 THEN 'II. Thông hiểu' WHEN 16 THEN 'Vận dụng cao' WHEN 17 THEN 'Vận dụng' WHEN 18 THEN '=> Đáp án: B' WHEN 19 THEN 'Lời giải' WHEN 20 THEN 'Chọn C.' WHEN 21 THEN 'A. một B. hai' WHEN 22 THEN 'Câu 12: hỏi' WHEN 23 THEN 'Lever 2' ELSE 'Nhận biết' END AS text FROM nation)"""


def _made(spark, sf_dir) -> DataFrame:
    """Lines that documents use as markers, and some that look like them."""
    texts = [
        "A. KIẾN THỨC TRỌNG TÂM", "A – LÝ THUYẾT (KIẾN THỨC TRỌNG TÂM)", "A. TÓM TẮT LÝ THUYẾT", "Phần A: Tóm tắt kiến thức", "B. Phần lí thuyết", "Kiến thức trọng tâm", "A) PHẦN LÝ THUYẾT", "B. BÀI TẬP",
        "B – BÀI TẬP", "BÀI TẬP TRẮC NGHIỆM", "Phần bài tập", "B. PHẦN BÀI TẬP", "B. PEPTIDE", "Level 1: dễ", "LEVEL3", "II. Thông hiểu", "Vận dụng cao", "Vận dụng", "=> Đáp án: B", "Lời giải", "Chọn C.",
        "A. một B. hai", "Câu 12: hỏi", "Lever 2", "Nhận biết",
    ]
    text = F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("n_nationkey") % 25 + 1).cast("int"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), text.alias("text"))


@query(f"""WITH {MADE} SELECT k, k <= 6 AS is_start, k BETWEEN 7 AND 11 AS is_end, k IN (18, 19, 20) AS is_answer, k IN (0, 2, 4, 6, 7, 11, 12, 20, 21) AS has_option, k = 22 AS is_question,
  CASE WHEN k IN (13, 24) THEN 1 WHEN k = 15 THEN 2 WHEN k IN (14, 17) THEN 3 WHEN k = 16 THEN 4 END::BIGINT AS level, CASE WHEN k IN (13, 24) THEN 'knowledge' WHEN k = 15 THEN 'comprehension' WHEN k IN (14, 16, 17) THEN 'application' END AS level_name FROM m""")
def markers(spark, sf_dir):
    """The markers of theory, exercises, questions, answers, options and levels on lines of their own."""
    folded, text = fold(F.col("text")), F.col("text")
    level = Q.heading_level(text)
    return _made(spark, sf_dir).select(
        "k", folded.rlike(config.THEORY_START).alias("is_start"), folded.rlike(config.THEORY_END).alias("is_end"), text.rlike(config.ANSWER_HEAD).alias("is_answer"), text.rlike(config.OPTION).alias("has_option"),
        text.rlike(config.QUESTION).alias("is_question"), level["number"].cast("long").alias("level"), level["name"].alias("level_name"),
    )


@query(f"WITH {MADE} SELECT k, lower(replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D')) AS plain, {FOLD.format('text')} AS folded FROM m")
def folded_markers(spark, sf_dir):
    """Both ways of folding."""
    return _made(spark, sf_dir).select("k", fold_plain(F.col("text")).alias("plain"), fold(F.col("text")).alias("folded"))


@query(f"WITH {LINES}, s AS (SELECT doc_id, block_idx, length(text) % 7 AS n, length(text) % 4 AS k FROM b) SELECT doc_id, block_idx, k >= greatest(1, n // 2) AS bold FROM s")
def bold_vote(spark, sf_dir):
    """A paragraph is bold if half of its runs, and one at least, are."""
    size = F.length("text")
    return B.lines(table(spark, sf_dir, "documents")).select("doc_id", "block_idx", B.bold_by_vote(size % 4, size % 7).alias("bold"))


# ---- equations -----------------------------------------------------------------------------------------------


def _decoded(rows: DataFrame, nodes) -> DataFrame:
    """k, latex of the equation that nodes(k) makes of each k, through a compound file's stream."""

    def read(batches):
        for batch in batches:
            found = [mtef.decode(writer.equation(nodes(k)))["latex"] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["k", "latex"])

    return rows.select(F.col("k").cast("long").alias("k")).mapInArrow(read, "k long, latex string")


SELECTORS = {
    0: "\\left\\langle {0} \\right\\rangle", 1: "\\left( {0} \\right)", 2: "\\left\\{{ {0} \\right\\}}", 3: "\\left[ {0} \\right]", 4: "\\left| {0} \\right|", 5: "\\left\\| {0} \\right\\|", 6: "\\left\\lfloor {0} \\right\\rfloor",
    7: "\\left\\lceil {0} \\right\\rceil", 8: "\\left\\llbracket {0} \\right\\rrbracket", 10: "\\sqrt[7]{{{0}}}", 11: "\\frac{{{0}}}{{7}}", 12: "\\underline{{{0}}}", 13: "\\overline{{{0}}}", 14: "\\xrightarrow[7]{{{0}}}",
    15: "\\iiint_{{7}}^{{8}} {0}", 16: "\\sum_{{7}}^{{8}} {0}", 17: "\\prod_{{7}}^{{8}} {0}", 18: "\\coprod_{{7}}^{{8}} {0}", 19: "\\bigcup_{{7}}^{{8}} {0}", 20: "\\bigcap_{{7}}^{{8}} {0}", 21: "\\int_{{7}}^{{8}} {0}",
    22: "\\sum_{{7}}^{{8}} {0}", 23: "{0}_{{7}}^{{8}}", 24: "\\overbrace{{{0}}}^{{7}}", 26: "\\overline{{){0}}}^{{7}}", 27: "_{{{0}}}", 28: "^{{7}}", 29: "_{{{0}}}^{{7}}", 32: "\\tilde{{{0}}}", 33: "\\hat{{{0}}}",
    34: "\\overset{{\\frown}}{{{0}}}", 36: "\\cancel{{{0}}}", 37: "\\boxed{{{0}}}",
}
_SELECTED = " ".join(f"WHEN {s} THEN '" + "' || k || '".join(t.replace("{{", "{").replace("}}", "}").split("{0}")) + "'" for s, t in SELECTORS.items())


@query(f"SELECT DISTINCT p_partkey AS k, CASE (p_partkey % 38)::INT {_SELECTED} END AS latex FROM part WHERE (p_partkey % 38)::INT IN ({', '.join(map(str, SELECTORS))})")
def equation_selectors(spark, sf_dir):
    """A template of every published selector around a number of its own. Numbers without such a selector make no equation."""
    known = set(SELECTORS)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")).where((F.col("k") % 38).isin(*known))
    return _decoded(rows, lambda k: [("template", k % 38, 1 if k % 38 == 11 else 3, list(str(k)), ["7"], ["8"])])


@query("""SELECT p_partkey AS k, CASE p_partkey % 9 WHEN 0 THEN p_partkey || ' 7' WHEN 1 THEN '\\begin{array}{l}x=' || p_partkey || ' \\\\ y=7\\end{array}' WHEN 2 THEN 'x=' || p_partkey || ' =7' WHEN 3 THEN 'y=\\lim_{x\\to' || p_partkey || '} 7'
  WHEN 4 THEN p_partkey || '.' WHEN 5 THEN '(' || p_partkey || ' ;7)' WHEN 6 THEN '\\left( \\begin{array}{l}' || p_partkey || ' \\\\ 7\\end{array} \\right)' WHEN 7 THEN 'x=' || p_partkey || ' 7'
  ELSE '\\begin{matrix}' || p_partkey || ' & 7 \\\\ x & y\\end{matrix}' END AS latex FROM part""")
def equation_rows(spark, sf_dir):
    """Rows that go on, systems, limits over two rows, rows in a fence, matrices."""

    def nodes(k: int) -> list:
        n = list(str(k))
        rows = {
            0: [n, ["7"]], 1: [["x", "=", *n], list("y=7")], 2: [["x", "=", *n], list("=7")], 3: [list("y=lim"), ["x", "→", *n], ["7"]], 4: [n, ["."]], 5: [["(", *n], list(";7)")], 7: [["x", "=", *n], ["7"]]
        }
        if k % 9 == 6:
            return [("fence", [("lines", [n, ["7"]])])]
        return [("matrix", [[n, ["7"]], [["x"], ["y"]]])] if k % 9 == 8 else [("lines", rows[k % 9])]

    return _decoded(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), nodes)


@query("""SELECT k, '\\text{' || w || '}' AS latex FROM (SELECT n_nationkey AS k, ['điện', 'chứa', 'không', 'Hạt', 'nhân', 'nguyên', 'tử', 'các', 'vận tốc', 'đổi'][1 + n_nationkey % 10] AS w FROM nation) WHERE NOT contains(w, ' ')""")
def equation_words(spark, sf_dir):
    """Words that were typed in the national single-byte encoding."""
    words = ("điện", "chứa", "không", "Hạt", "nhân", "nguyên", "tử", "các", "", "đổi")
    codes = {letter: code for code, letter in TCVN3.items()}

    def read(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            streams = [bytes(28) + bytes([5, 1, 0, 6, 9]) + b"DSMT6\0\0" + bytes([17, 1]) + b".VnTime\0" + bytes([1, 0]) + b"".join(bytes([2, 0, 127, codes.get(c, ord(c)), 0]) for c in words[k % 10]) + b"\0\0" for k in keys]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([mtef.decode(s)["latex"] for s in streams], pa.string())], ["k", "latex"])

    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k")).where("k % 10 <> 8")
    return rows.mapInArrow(read, "k long, latex string")


# ---- rendering -----------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT c_custkey AS k, c_nationkey AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer),
  h AS (SELECT nation, i, i % 8 = 3 OR i % 8 = 4 AS bullet, CASE i % 8 WHEN 0 THEN '<i>“trích ' || k || '”</i>' WHEN 1 THEN '<p><b>Chú ý:</b> số ' || k || '</p>' WHEN 2 THEN '<h4>1. Về số</h4><p>' || k || '</p>' WHEN 3 THEN '<li>ý ' || k || '</li>' WHEN 4 THEN '<li>ý ' || k || '</li>'
      WHEN 5 THEN '<table><tr><td>' || k || '</td><td><ul><li>a</li><li>b</li></ul></td></tr></table>' WHEN 6 THEN '<p>tia \\(Ox\\) &amp; ' || k || '</p>' ELSE '<p>số <span class="math">\\(' || k || '\\)</span> ở</p>' END AS html FROM c),
  r AS (SELECT *, sum((NOT bullet OR i % 8 = 3)::INT) OVER (PARTITION BY nation ORDER BY i) AS run FROM h)
  SELECT nation::BIGINT AS nation, min(i) AS place, CASE WHEN bool_or(bullet) THEN '<ul>' || string_agg(html, '' ORDER BY i) || '</ul>' ELSE max(html) END AS html FROM r GROUP BY nation, run""")
def rendered_blocks(spark, sf_dir):
    """Quotes, callouts, numbered leads, lists, tables, rays, marks and formulas as a page shows them."""
    from pyspark.sql.window import Window

    k, turn = F.col("c_custkey").cast("string"), F.col("i") % 8
    text = lambda *parts: run(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    cell = lambda c: F.array(c)
    grid = F.struct(F.lit("table").alias("kind"), F.lit("").alias("style"), F.lit(None).cast("int").alias("ilvl"), F.array().cast(f"array<{writer.RUN}>").alias("runs"), cell(F.array(run(k), run("- a - b"))).alias("cells"))
    formula = run(F.concat(F.lit("<m:r><m:t>"), k, F.lit("</m:t></m:r>")), kind="math")
    made = (
        F.when(turn == 0, para(text("“trích ", k, "”"))).when(turn == 1, para(text("Chú ý: số ", k))).when(turn == 2, para(text("1. Về số:", k))).when(turn == 3, para(text("- ý ", k)))
        .when(turn == 4, para(run("+ ý", bold=True), text(" ", k))).when(turn == 5, grid).when(turn == 6, para(run("tia Ox & "), run(k, underline=True))).otherwise(para(run("số"), formula, run("ở")))
    )
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    rows = writer.gathered(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), "c_nationkey", "c_custkey").select("c_nationkey", "c_custkey", place.alias("i"))
    packed = writer.bundled(rows.select(F.concat(F.lit("/in/"), "c_nationkey", F.lit(".docx")).alias("path"), made.alias("paragraph")))
    parsed = sinks.stage(docx.parse(packed), folder_of(spark), "parsed")
    shown = render.block_html(docx.blocks(parsed), render.asset_html(docx.assets(parsed)))
    return shown.select(number_of("path").alias("nation"), F.col("block_idx").cast("long").alias("place"), "html")


@query("""SELECT p_partkey AS k, 'cho [MATH: ' || p_size || '], hình [IMAGE: image2.png].' AS plain FROM part""")
def plain_markup(spark, sf_dir):
    """The plain-text form of paragraphs with a formula and an image."""
    formula = run(F.concat(F.lit("<m:r><m:t>"), F.col("p_size").cast("string"), F.lit("</m:t></m:r>")), kind="math")
    image = lambda: run("", kind="image", data=F.lit(writer.png(1, 1)))
    first = para(run("đầu"), run("", kind="image", data=F.lit(writer.png(2, 2))))
    rows = writer.spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    packed = rows.select(F.concat(F.lit("/in/"), "p_partkey", F.lit(".docx")).alias("path"), F.array(first, para(run("cho"), formula, run(", hình"), image(), run("."))).alias("paragraphs"))
    parsed = sinks.stage(docx.parse(writer.packages(packed)), folder_of(spark), "parsed")
    rows = docx.blocks(parsed).where("block_idx = 1")
    shown = render.paragraphs(rows, render.asset_markup(docx.assets(parsed)), "plain", text=render.plain_joined)
    return shown.select(number_of("path").alias("k"), "plain")


@query("""WITH d AS (SELECT n_nationkey AS k, n_nationkey % 3 AS t, n_name AS x FROM nation)
  SELECT k::BIGINT AS k, 0::BIGINT AS line, 'I. ' || x AS text, TRUE AS bold FROM d WHERE t = 0 UNION ALL SELECT k, 1, 'thân ' || x, FALSE FROM d WHERE t = 0 UNION ALL SELECT k, 2, '2. ' || x, TRUE FROM d WHERE t = 0
  UNION ALL SELECT k, 0, 'thơ ' || x || chr(10) || 'câu hai', FALSE FROM d WHERE t = 1 UNION ALL SELECT k, 0, 'I. ' || x || chr(10) || 'một dòng', FALSE FROM d WHERE t = 2""")
def soft_breaks(spark, sf_dir):
    """Paragraphs in which headings were typed with line breaks are taken apart; a poem, or a single heading, is not."""
    x, turn = F.col("n_name"), F.col("n_nationkey") % 3
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    made = (
        F.when(turn == 0, para(run(text("I. ", x, "\n"), bold=True), run(text("thân ", x, "\n")), run(text("2. ", x), bold=True))).when(turn == 1, para(run(text("thơ ", x, "\ncâu hai"))))
        .otherwise(para(run(text("I. ", x), bold=True), run("\nmột dòng"), run(" "), run("", underline=True)))
    )
    packed = table(spark, sf_dir, "nation").select(F.concat(F.lit("/in/"), "n_nationkey", F.lit(".docx")).alias("path"), F.array(made).alias("paragraphs"))
    found = B.split_lines(docx.blocks(docx.parse(writer.packages(packed))))
    return found.select(number_of("path").alias("k"), F.col("at").bitwiseAND(F.lit((1 << 20) - 1)).alias("line"), "text", "bold")


# ---- reports and labels --------------------------------------------------------------------------------------


@query("""SELECT n_nationkey::BIGINT AS k, CASE n_nationkey % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'EMPTY' ELSE 'OK' END AS status, CASE n_nationkey % 3 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS questions, n_nationkey % 3 = 0 AS failed FROM nation""")
def exercise_report(spark, sf_dir):
    """A status for every file: one that is no package, one without exercises, one with a question."""
    named = F.concat(F.lit("/in/"), "n_nationkey", F.lit(".docx")).alias("path")
    body = F.array(para("A. KIẾN THỨC TRỌNG TÂM"), F.when(F.col("n_nationkey") % 3 == 2, para("B. BÀI TẬP")).otherwise(para("thân")), para(run(F.concat(F.lit("Câu 1. "), "n_name"))), para("Đáp án: A"))
    nation = table(spark, sf_dir, "nation")
    files = writer.packages(nation.where("n_nationkey % 3 <> 0").select(named, body.alias("paragraphs")))
    broken = nation.where("n_nationkey % 3 = 0").select(named, F.lit(3).cast("long").alias("length"), F.col("n_name").cast("binary").alias("content"))
    parsed = docx.parse(files.unionByName(broken))
    found = exercises.report(parsed, exercises.questions(parsed))
    return found.select(number_of("path").alias("k"), "status", F.col("questions").cast("long").alias("questions"), F.col("error").isNotNull().alias("failed"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, '{"a":' || l_partkey || CASE l_linenumber % 3 WHEN 0 THEN ',"cognitive_level":"application","cognitive_level_num":3,"b":null}' WHEN 1 THEN ',"cognitive_level":"application","cognitive_level_num":3}'
  ELSE ',"cognitive_level":null,"b":"x","cognitive_level_num":null}' END AS json FROM lineitem""")
def label_records(spark, sf_dir):
    """Records with their level replaced in place, added at the end, or taken away."""
    turn = F.col("l_linenumber") % 3
    raw = F.concat(F.lit('{"a":'), F.col("l_partkey").cast("string"), F.when(turn == 0, ',"cognitive_level":"know\\"ledge","cognitive_level_num":1,"b":null}').when(turn == 1, "}").otherwise(',"cognitive_level":"x","b":"x","cognitive_level_num":-2}'))
    level, number = F.when(turn < 2, "application"), F.when(turn < 2, 3)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), labelling.with_label(raw, level, number).alias("json"))


@query("SELECT n_nationkey::BIGINT AS k, 'A. ' || n_name AS a, CASE WHEN n_nationkey % 2 = 0 THEN 'ERROR' ELSE 'OK' END AS b FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey > 4")
def upsert_rows(spark, sf_dir):
    """Rows of the same key replaced, others kept."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.concat(F.lit("A. "), "n_name").alias("a"))
    old = n.where("k > 4").withColumn("b", F.lit("OK"))
    return quality.upsert(old, n.where("k % 2 = 0").withColumn("b", F.lit("ERROR")), "k")


@query("""WITH c AS (SELECT c_nationkey AS nation, 1 + c_custkey % 7 AS d, 2 * (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) + 1 AS ref FROM customer)
  SELECT nation::BIGINT AS nation, ref::BIGINT AS ref, CASE WHEN d = 3 THEN '<code>\\frac{' || nation || '}{3}</code>' WHEN d = 5 THEN '<i>5</i>' ELSE '<i>\\frac{' || nation || '}{' || d || '}</i>' END AS html FROM c""")
def typeset_formulas(spark, sf_dir):
    """Formulas by a renderer that sees each distinct one once, some of them replaced by hand, some of which it refuses."""
    from docframe.plans.package_queries import _customers, _parted, _with_parts

    found = docx.assets(sinks.stage(_parted(spark, sf_dir), folder_of(spark), "parsed"))
    by_hand = _with_parts(writer.spread(_customers(spark, sf_dir).where("1 + k % 7 = 5"), "k")).select(F.sha2("equation", 256).alias("sha256"), F.lit("5").alias("latex")).distinct()
    shown = render.typeset(docx.overridden(found, by_hand), lambda latex: [None if x.endswith("{3}") else f"<i>{x}</i>" for x in latex])
    return shown.where("NOT startswith(html, '<img')").select(number_of("path").alias("nation"), F.col("ref").cast("long").alias("ref"), "html")


@query("""SELECT n_nationkey::BIGINT AS k, '<h2>I. ' || n_name || '</h2>' || chr(10) || '<p>thân</p>' || chr(10) || '<ul>' || chr(10) || '<li>một</li>' || chr(10) || '<li>hai &amp; ba</li>' || chr(10) || '</ul>' || chr(10) || '<h4>a) ý</h4>' AS html FROM nation""")
def crop_pages(spark, sf_dir):
    """Pages of the other cropping mode, lists kept together."""
    from docframe.plans import crop

    body = F.array(F.lit("mở đầu"), F.lit("LÝ THUYẾT"), F.concat(F.lit("I. "), "n_name"), F.lit("thân"), F.lit("- một"), F.lit("• hai & ba"), F.lit("a) ý"), F.lit("B. BÀI TẬP"), F.lit("câu"))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.posexplode(body).alias("i", "text"))
    return crop.outline_html(crop.outline(rows, "k", "i"), "k", "i")


@query("""SELECT p_partkey AS k, 'x' || p_size || '\\ney\\lea\\geb60^\\circ\\toc\\tod.e\\frac' || p_size || p_partkey || 'text' AS form FROM part""")
def formula_comparison(spark, sf_dir):
    """The form in which two spellings of one formula are compared."""
    n, k = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    latex = F.concat(F.lit("\\left x "), n, F.lit("\\right \\neq {y} \\leq a~\\geq b 60° \\rightarrow c\\Rightarrow d \\cdot e \\frac{"), n, F.lit("}{"), k, F.lit("}\\mathrm{\\text{text}}"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), tex.normalize(latex).alias("form"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 3 THEN 0 ELSE 1 + p_size END::BIGINT AS width, CASE p_partkey % 4 WHEN 3 THEN 0 ELSE 300 + p_size END::BIGINT AS height,
  ['image/png', 'image/gif', 'image/jpeg', 'image/x-wmf'][1 + (p_partkey % 4)::INT] AS mime FROM part""")
def image_headers(spark, sf_dir):
    """Sizes and types of images by their headers and names; a metafile keeps its own type and has no size."""
    from docframe.functions.text import mime_of
    from docframe.sources.ooxml import image_size

    def header(kind: int, w: int, h: int) -> bytes:
        jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big")
        return (writer.png(w, 1)[:20] + h.to_bytes(4, "big"), b"GIF89a" + w.to_bytes(2, "little") + h.to_bytes(2, "little"), jpeg, b"\xd7\xcd\xc6\x9a")[kind]

    def read(batches):
        for batch in batches:
            sizes = [image_size(header(k % 4, 1 + n, 300 + n)) for k, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w for w, _ in sizes], pa.int64()), pa.array([h for _, h in sizes], pa.int64())], ["k", "width", "height"])

    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("long"))
    extension = F.element_at(F.array(*[F.lit(x) for x in ("png", "GIF", "jpeg", "wmf")]), (F.col("k") % 4 + 1).cast("int"))
    return rows.mapInArrow(read, "k long, width long, height long").withColumn("mime", mime_of(extension))


@query("""SELECT n_name || '.json' AS name, 'Câu ' || n_nationkey AS content, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 0 END::BIGINT AS choices, n_nationkey::BIGINT AS level FROM nation""")
def record_files(spark, sf_dir):
    """Records of one object a file, over several lines and folders, read with the fields that labelling uses."""
    from docframe.cli import records

    k = F.col("n_nationkey").cast("string")
    choices = F.when(F.col("n_nationkey") % 2 == 0, '[{"id": 1, "content": "a"},\n {"id": 2, "content": null}]').otherwise("null")
    json = F.concat(F.lit('{\n  "content": "Câu '), k, F.lit('",\n  "choices": '), choices, F.lit(',\n  "cognitive_level_num": '), k, F.lit("\n}"))
    folder = folder_of(spark)
    sinks.write_named(table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey"), F.lit("/"), "n_name", F.lit(".json")).alias("name"), json.alias("body")), folder, "name", "body").count()
    found = records(spark, [folder])
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    return found.select(name.alias("name"), "content", F.coalesce(F.size("choices"), F.lit(0)).cast("long").alias("choices"), F.col("cognitive_level_num").cast("long").alias("level"))


@query("""WITH s AS (SELECT n_nationkey AS k, 10 * n_nationkey + 2 AS words, n_nationkey % 3 AS figures, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey % 5 + 1 END AS formulas, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey % 5 END AS resolved FROM nation),
  g AS (SELECT *, CASE WHEN formulas = 0 THEN 1 ELSE resolved / formulas END AS share FROM s)
  SELECT k::BIGINT AS k, words::BIGINT AS words, figures::BIGINT AS figures, formulas::BIGINT AS formulas, resolved::BIGINT AS resolved, CASE WHEN k = 0 THEN 1 ELSE 2 END::BIGINT AS sections,
    concat_ws(',', CASE WHEN words < 50 AND figures < 2 THEN 'FEW_WORDS' END, CASE WHEN share < 0.7 THEN 'FORMULAS_UNRESOLVED' END, CASE WHEN words < 150 THEN 'SHORT' END, CASE WHEN share < 0.9 THEN 'SOME_UNRESOLVED' END) AS flags,
    CASE WHEN (words < 50 AND figures < 2) OR share < 0.7 THEN 'FAIL' WHEN words < 150 OR share < 0.9 THEN 'WARN' ELSE 'PASS' END AS status FROM g""")
def lesson_gates(spark, sf_dir):
    """Statistics and gates of packages: words, figures, sections, formulas that could and could not be read."""
    from docframe.plans import lessons

    k = F.col("n_nationkey")
    words = para(run(F.trim(F.repeat(F.lit("từ "), k * 10))))
    figures = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.when(i < k % 3, para(run("", kind="image", data=F.lit(writer.png(2, 2))))).otherwise(para("")))
    good = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.when(i <= k % 5, para(run(F.concat(F.lit("<m:r><m:t>"), i.cast("string"), F.lit("</m:t></m:r>")), kind="math"))).otherwise(para("")))
    bad = F.when(k % 5 > 0, para(run("", kind="equation", data=F.lit(writer.compound(b"none"))))).otherwise(para(""))
    body = F.concat(F.array(para("A. KIẾN THỨC TRỌNG TÂM"), words, para(run("I. Một", bold=True))), figures, good, F.array(bad, para("B. BÀI TẬP")))
    folder = folder_of(spark)
    keep = lambda rows, name: sinks.stage(rows, folder, name)
    packed = table(spark, sf_dir, "nation").select(F.concat(F.lit("/in/"), "n_nationkey", F.lit(".docx")).alias("path"), body.alias("paragraphs"))
    parsed = keep(docx.parse(writer.packages(packed)), "parsed")
    counts = [F.col(c).cast("long").alias(c) for c in ("words", "figures", "formulas", "resolved", "sections")]
    return lessons.gates(parsed, keep).select(number_of("path").alias("k"), *counts, "flags", "status")
