import io
import struct
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docframe.operators import labelling
from docframe.plans import exercises, lessons, package_queries, source_queries  # noqa: F401
from docframe.plans.registry import QUERIES
from docframe.sources import docx, ooxml, sinks, writer
from docframe.sources.cfb import equation_stream
from docframe.streaming import ingest

NS = (
    'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" '
    'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:o="urn:schemas-microsoft-com:office:office" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math"'
)
PNG = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 3, 2) + bytes(9)


def compound(stream):
    """A compound file with one stream in its mini stream."""
    size, mini = 512, -(-len(stream) // 64)
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(10)
    end, free = 0xFFFFFFFE, 0xFFFFFFFF
    head += struct.pack("<IIIIIII", 1, 0, 4096, 2, 1, end, 0)
    head = head[:44] + struct.pack("<I", 1) + struct.pack("<IIIIIII", 1, 0, 4096, 2, 1, end, 0) + struct.pack("<109I", 0, *[free] * 108)
    sectors = -(-mini * 64 // size)
    fat = [0xFFFFFFFD, end, end] + [4 + i for i in range(sectors - 1)] + [end]
    fat += [free] * (128 - len(fat))
    minifat = [i + 1 for i in range(mini - 1)] + [end] + [free] * (128 - mini)

    def entry(name, kind, start, length):
        raw = name.encode("utf-16-le")
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw) + 2, kind, 1) + struct.pack("<III", free, free, free) + bytes(36) + struct.pack("<III", start, length, 0)

    directory = entry("Root Entry", 5, 3, mini * 64) + entry("Equation Native", 2, 0, len(stream)) + bytes(256)
    body = struct.pack("<128I", *fat) + directory + struct.pack("<128I", *minifat) + stream.ljust(sectors * size, b"\0")
    return head[:512].ljust(512, b"\0") + body


def p(*runs, style=""):
    return f"<w:p><w:pPr><w:pStyle w:val='{style}'/></w:pPr>{''.join(runs)}</w:p>"


def r(text, bold=False, underline=False, color=None):
    look = ("<w:b/>" if bold else "") + (f"<w:color w:val='{color}'/>" if color else "") + ("<w:u w:val='single'/>" if underline else "")
    return f"<w:r><w:rPr>{look}</w:rPr><w:t xml:space='preserve'>{text}</w:t></w:r>"


def package(*body, files=None):
    out = io.BytesIO()
    rels = "".join(f"<Relationship Id='{k}' Target='{v[0]}'/>" for k, v in (files or {}).items())
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{''.join(body)}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", f"<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>{rels}</Relationships>")
        for name, data in (files or {}).values():
            z.writestr(f"word/{name}", data)
    return out.getvalue()


OLE = compound(bytes(28) + bytes([5, 1, 0, 6, 9]) + b"DSMT6\0\0" + b"\x01\x00\x02\x00\x83x\x00\x00\x00")
IMAGE = "<w:r><w:drawing><a:blip r:embed='i1'/></w:drawing></w:r>"
LESSON = package(
    p(r("Mở đầu")), p(r("A. KIẾN THỨC TRỌNG TÂM", bold=True)), p(r("1. Định nghĩa", bold=True)), p(r("Hàm "), r("số "), r("f", bold=True), "<w:r><w:object><o:OLEObject r:id='o1'/></w:object></w:r>", IMAGE),
    p(r("a) Ý nhỏ")), p(r("2. Ví dụ", bold=True)), p(r("- một")), p(r("- hai")), p(IMAGE), "<w:tbl><w:tr><w:tc>" + p(r("ô")) + "</w:tc></w:tr></w:tbl>",
    p(r("B. PEPTIDE", bold=True)), p(r("B. BÀI TẬP", bold=True)), p(r("Level 2")), p(r("Câu 1. Chọn số?")), p(r("A. một")), p(r("B. hai")), p(r("Đáp án: B")), p(r("Vì hai.")),
    p(r("Câu 2: Màu nào?")), p(r("A. đỏ", color="FF0000")), p(r("B. xanh")), p(r("C. xanh")), p(r("Câu 3. Gạch?")), p(r("A", bold=True), r(". x")), p(r("B. y", underline=True)), p(r("Câu 4. Viết ___ vào.")),
    files={"i1": ("media/image1.png", PNG), "o1": ("embeddings/oleObject1.bin", OLE)},
)


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    (folder / "toan 12").mkdir()
    for name, data in (("toan 12/Bài 3 - Đạo hàm.docx", LESSON), ("bad.docx", b"no zip"), ("~$tmp.docx", b""), ("empty.docx", package())):
        (folder / name).write_bytes(data)
    return docx.parse(docx.scan(spark, str(folder))).cache()


def test_scan_and_errors(parsed):
    rows = {r.path.rsplit("/", 1)[-1]: r for r in parsed.collect()}
    assert len(rows) == 3 and rows["bad.docx"].error.startswith("BadZipFile") and rows["empty.docx"].blocks == []


def test_compound_file():
    assert equation_stream(OLE)[28] == 5 and equation_stream(b"x") is None and equation_stream(OLE[:600]) in (None, b"", equation_stream(OLE[:600]))


def test_blocks_and_assets(parsed):
    blocks = {r.block_idx: r for r in docx.blocks(parsed).collect()}
    assert [x.text for x in blocks[3].inlines if x.kind == "text"] == ["Hàm số ", "f"]
    assert blocks[9].kind == "table" and blocks[9].rows[0][0][0].text == "ô"
    assets = {r.aid: r for r in docx.assets(parsed).collect()}
    assert set(assets) == {"f1", "img2"} and assets["f1"].latex == "x" and assets["f1"].confidence == 0.98
    assert assets["img2"].uses == [1, 2] and (assets["img2"].width, assets["img2"].height) == (3, 2)


def test_theory_sections_and_page(spark, parsed):
    limits, kept = lessons.theory(parsed)
    row = limits.where("first IS NOT NULL").collect()[0]
    assert (row.first, row["last"], row.flags) == (1, 11, "")
    sections = [(r.tree_path, r.title, r.level, r.numbering, r.title_kind) for r in lessons.sections(kept).orderBy("at").collect()]
    assert sections == [("1", "Định nghĩa", 2, "1", "definition"), ("2", "Ví dụ", 2, "2", "example"), ("3", "PEPTIDE", 1, "B", "concept")]
    html = lessons.pages(parsed).collect()[0].html
    assert "<ul><li>một</li><li>hai</li></ul>" in html and r'<span class="math">\(x\)</span>' in html and "data:image/png;base64," in html
    assert "Hàm số f" in html and "<table><tr><td>ô</td></tr></table>" in html


def test_questions(parsed):
    rows = {r.q_order: r for r in exercises.questions(parsed).collect()}
    assert [(rows[i].type, rows[i].answer, rows[i].answer_source) for i in sorted(rows)] == [
        ("single-choice", "[2]", "text:đáp_án"), ("single-choice", "[1]", "format:color"), ("single-choice", "[2]", "format:underline"), ("fill-answer", '[[""]]', "none"),
    ]
    assert [c.content for c in rows[1].choices] == ["<p>một</p>", "<p>hai</p>"] and rows[1].cognitive_level_num == 2 and "Vì hai." in rows[1].explanation


def test_sinks(spark, parsed, tmp_path):
    rows = spark.createDataFrame([("a/x.html", "một", "g"), ("b/y.html", None, "g")], "name string, body string, kind string")
    written = {r.name: r.bytes for r in sinks.write_named(rows, f"file://{tmp_path}", "name", "body").collect()}
    assert written == {"a/x.html": 5, "b/y.html": 0} and (tmp_path / "a/x.html").read_text() == "một"
    with pytest.raises(ValueError):
        sinks.write_named(rows.withColumn("name", F.lit("same")), f"file://{tmp_path}", "name", "body")
    bundle = sinks.zip_bundles(rows, "kind", "name", "body").collect()[0]
    assert zipfile.ZipFile(io.BytesIO(bytes(bundle.archive))).namelist() == ["a/x.html", "b/y.html"]
    old = spark.createDataFrame([(1, "h"), (2, "h")], "doc_id int, content_hash string")
    new, state = sinks.deliver(spark.createDataFrame([(1, "h"), (2, "i"), (3, "h")], "doc_id int, content_hash string"), old)
    assert sorted(map(tuple, new.collect())) == [(2, "i"), (3, "h")] and sorted(map(tuple, state.collect())) == [(1, "h"), (2, "i"), (3, "h")]


def test_labelling(spark):
    rows = spark.createDataFrame([(1, "Chứng minh", "knowledge", 1), (2, None, "application", 3)], "id int, content string, cognitive_level string, cognitive_level_num int")
    got = {r.id: r.cognitive_level_num for r in labelling.enrich(rows, "content").collect()}
    assert got == {1: 4, 2: 1}
    kept = {r.id: r.cognitive_level for r in labelling.enrich(rows, "content", lambda prompts: ["?"] * len(prompts)).collect()}
    assert kept == {1: "knowledge", 2: "application"}


def test_stream(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    for name in ("a.docx", "b.docx", "~$c.docx"):
        (folder / name).write_bytes(LESSON)
    stream = ingest.once(ingest.with_hash(ingest.file_stream(spark, str(folder))))
    ingest.run_batches(stream, lambda df, i: seen.extend(r.path for r in df.select("path").collect()), str(tmp_path / "ck")).awaitTermination(120)
    assert len(seen) == 1


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_packages_of_a_query_are_read_once(spark):

    plan = plan_of(QUERIES["plain_markup"](spark, "/root/testdata/sf0.001"))
    assert "MapInPandas" not in plan and "MapInArrow" not in plan  # a table of parsed packages, not packages again for each use


def test_a_large_file_is_read_in_parts(spark, tmp_path):
    body = [p(r(f"dòng {i} " + "x" * 40)) for i in range(200)]
    (tmp_path / "a.docx").write_bytes(package(*body))
    (tmp_path / "b.docx").write_bytes(b"none")
    files = docx.scan(spark, str(tmp_path))
    whole, parts = docx.parse(files), docx.parse(files, most=2000)
    assert parts.where("error IS NULL").count() > 10 and parts.where("part = 0").count() == whole.count() == 2
    assert sorted(docx.blocks(parts).collect()) == sorted(docx.blocks(whole).collect()) and docx.readable(parts).count() == 1


def test_a_large_package_is_written_as_its_paragraphs_come(spark):

    assert "collect_list" not in plan_of(QUERIES["package_assets"](spark, "/root/testdata/sf0.001"))
    runs = [{"kind": "image", "data": PNG}, {"kind": "equation", "data": b"none"}]
    content = writer.Writer().package(({"runs": runs} for _ in range(3)), packed=True)
    assert sorted(zipfile.ZipFile(io.BytesIO(content)).namelist()) == ["word/_rels/document.xml.rels", "word/document.xml", "word/embeddings/oleObject2.bin", "word/media/image1.png"]


def test_typeset_formulas_meet_a_table_of_packages(spark):

    plan = plan_of(QUERIES["typeset_formulas"](spark, "/root/testdata/sf0.001"))
    assert "collect_list" not in plan and "MapInPandas" not in plan


def test_rendered_blocks_meet_a_table_of_packages(spark):
    assert "MapIn" not in plan_of(QUERIES["rendered_blocks"](spark, "/root/testdata/sf0.001"))


def test_metadata_of_a_small_table_is_dealt_out(spark):
    assert "REPARTITION_BY_NUM" in plan_of(QUERIES["file_metadata"](spark, "/root/testdata/sf0.001"))


def test_equations_are_dealt_out_and_equal_ones_meet(spark):
    plan = plan_of(QUERIES["equation_forms"](spark, "/root/testdata/sf0.001"))
    assert "REPARTITION_BY_NUM" in plan and "Sort" in plan


def test_lesson_sections_keep_the_theory_as_a_table(spark):
    found = QUERIES["lesson_sections"](spark, "/root/testdata/sf0.001").inputFiles()
    assert found and all("theory-blocks" in f for f in found)


def test_documents_go_on_in_arrow_batches(spark):
    plan = plan_of(QUERIES["package_blocks"](spark, "/root/testdata/sf0.001"))
    assert "MapInPandas" not in plan and plan.count("MapInArrow") == 2


def test_packages_go_on_when_they_are_large():
    assert [b.num_rows for b in writer._handed_on((str(i), bytes(1 << 20)) for i in range(10))] == [4, 4, 2]


def test_documents_are_dealt_out_before_their_packages_are_written(spark):
    assert "REPARTITION_BY_NUM" in plan_of(QUERIES["package_blocks"](spark, "/root/testdata/sf0.001"))


def test_nested_columns_become_the_objects_they_are():
    run = pa.struct([("text", pa.string()), ("bold", pa.bool_()), ("n", pa.int32()), ("data", pa.binary())])
    rows = [
        [{"runs": [{"text": "a", "bold": True, "n": 1, "data": b"\0"}, {"text": None, "bold": None, "n": None, "data": None}], "cells": [[]]}, None], None, [],
        [{"runs": None, "cells": None}, {"runs": [], "cells": [[None, {"text": "ô", "bold": False, "n": 2, "data": b""}], None]}],
    ]
    made = pa.array(rows * 3, pa.list_(pa.struct([("runs", pa.list_(run)), ("cells", pa.list_(pa.list_(run)))])))
    for at in range(5):
        assert writer.objects(made.slice(at, 6)) == made.slice(at, 6).to_pylist()


def test_blanks_become_one_space():
    texts = ["a  b", "a\tb", "a b", "a \t  b", "a b", " a", "a\nb"]
    assert [ooxml.squeezed(t) for t in texts] == ["a b", "a b", "a b", "a b", "a b", " a", "a\nb"]


def test_conversations_reach_the_writer_paragraph_by_paragraph(spark, monkeypatch):
    monkeypatch.setattr(sinks, "stage", lambda rows, *_: rows)
    parsed = package_queries._questions(spark, "/root/testdata/sf0.001")
    assert "collect_list" not in plan_of(parsed) and "REPARTITION_BY_NUM" in plan_of(parsed)
    assert docx.blocks(parsed).groupBy("path").agg(F.count_if(F.col("text") == "B. BÀI TẬP").alias("n")).where("n <> 1").count() == 0


def test_lesson_documents_keep_the_limits_as_a_table(parsed):
    kept = []
    lessons.documents(parsed, work=lambda rows, name: kept.append(name) or rows)
    assert kept[0] == "theory-limits" and len(set(kept)) == 4
