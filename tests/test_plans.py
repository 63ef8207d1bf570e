"""The schema checker, lesson documents and the command line."""

import json

import pytest

from docframe import cli
from docframe.operators import labelling, schema
from docframe.plans import lesson_schema, lessons
from docframe.sources import docx, writer


def said(text, **look):
    return {"runs": [{"text": text} | look]}


LESSON = [
    said("Bài 7. Đạo hàm"), said("A. KIẾN THỨC TRỌNG TÂM", bold=True), said("mở đầu"), said("I. Khái niệm", bold=True), {"runs": [{"text": "ảnh"}, {"kind": "image", "data": writer.png(2, 3)}]},
    {"runs": [{"text": "x là "}, {"kind": "equation", "data": writer.compound(writer.equation([("frac", ["1"], ["x"])]))}]}, said("1. Chú ý"), said("- một"), said("“trích dẫn”"), said("Ví dụ: hai"),
    {"kind": "table", "cells": [[{"text": "ô"}, {"text": "p"}]]}, said("II. Hết", bold=True), said("B. BÀI TẬP"), said("Level 1"), said("Câu 1. Số?"), said("A. một"), said("B. hai"), said("Đáp án: B"), said("vì"), said("Câu 2. ___"),
]


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "toan 12"
    (root / "chương 1").mkdir(parents=True)
    (root / "chương 1" / "Bài 7 - Đạo hàm.docx").write_bytes(writer.Writer().package(LESSON))
    (root / "~$x.docx").write_bytes(b"")
    return root


def test_violations():
    check = lambda value, rule: list(schema.violations(value, rule))
    assert check(3, {"type": "integer", "minimum": 4}) == ["$: minimum"] and check(True, {"type": "integer"}) == ["$: type"] and check(None, {"type": ["string", "null"]}) == []
    assert check("ab", {"pattern": "^a$", "minLength": 3, "enum": ["x"]}) == ["$: enum", "$: pattern", "$: minLength"]
    rule = {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "array", "minItems": 2, "items": {"type": "number", "maximum": 1}}}, "additionalProperties": False}
    assert check({"a": [2], "c": 1}, rule) == ["$.b: required", "$.a: minItems", "$.a[0]: maximum", "$.c: additionalProperties"]
    tree = {"$ref": "#/$defs/n", "$defs": {"n": {"type": "object", "properties": {"v": {"type": "string"}, "c": {"type": "array", "items": {"$ref": "#/$defs/n"}}}}}}
    assert check({"v": "x", "c": [{"c": [{"v": 1}]}]}, tree) == ["$.c[0].c[0].v: type"]
    assert schema.check("{", {}) == schema.check(None, {}) == ["$: json"]


def test_lesson_document(spark, folder):
    files = docx.scan(spark, str(folder))
    found = schema.validate(lessons.documents(docx.parse(files), files=files), "json", lesson_schema.LESSON).collect()
    assert len(found) == 1 and found[0].violations == [] and found[0].doc_id == "math-12-kntt-bai-07-dao-ham"
    lesson = json.loads(found[0].json)
    outline = lambda nodes: [(n["path"], n["numbering"], n["title"], [b["type"] for b in n["blocks"]], outline(n["children"])) for n in nodes]
    assert outline(lesson["sections"]) == [
        ("1", "", "", ["paragraph"], []), ("2", "I", "Khái niệm", ["paragraph", "paragraph"], [("2.1", "1", "Chú ý", ["list", "quote", "callout", "table"], [])]), ("3", "II", "Hết", [], []),
    ]
    assert {k: v["kind"] for k, v in lesson["assets"].items()} == {"img1": "figure", "f2": "formula"} and lesson["assets"]["f2"]["latex"] == r"\frac{1}{x}"
    assert lesson["sections"][1]["blocks"][1]["inlines"][1] == {"t": "formula", "ref": "f2"} and lesson["meta"]["lesson"]["chapter"] == {"number": 1, "title": "chương 1"}
    assert lesson["stats"]["formulas"] == {"total": 1, "resolved_latex": 1, "fallback_image": 0} and lesson["source"]["theory_heading"] == "A. KIẾN THỨC TRỌNG TÂM"


def test_command_line(spark, folder, tmp_path, capsys):
    out = str(tmp_path / "out")
    assert cli.main(["theory", str(folder), "-o", f"{out}/t", "-j", "2"]) == 0
    page = (tmp_path / "out/t/math-12-kntt-bai-07-dao-ham.html").read_text()
    assert "<h2>I. Khái niệm</h2>" in page and "<h3>1. Chú ý</h3>" in page and r"\(\frac{1}{x}\)" in page and "<ul><li>một</li></ul>" in page and "<title>Đạo hàm</title>" in page
    assert cli.main(["lessons", str(folder), "-o", f"{out}/l", "--work", f"{out}/work"]) == 0 and (tmp_path / "out/work/theory-blocks/_SUCCESS").exists()
    assert json.loads((tmp_path / "out/l/math-12-kntt-bai-07-dao-ham.json").read_text())["doc_id"] == "math-12-kntt-bai-07-dao-ham"
    assert cli.main(["exercises", str(folder), "-o", f"{out}/e"]) == 0 and "<dt>Đáp án</dt><dd>B</dd>" in (tmp_path / "out/e/bài-7---đạo-hàm.html").read_text()
    assert cli.main(["questions", str(folder), "-o", f"{out}/q", "--structured"]) == 0
    first = json.loads((tmp_path / "out/q/toan 12/chương 1/Bài 7 - Đạo hàm/q001.json").read_text())
    assert first["answer"] == [2] and first["chapter_name"] == "chương 1" and first["lesson_name"] == "Bài 7. Đạo hàm" and first["choices"][1] == {"id": 2, "content": "<p>hai</p>"} and len(first) == 30
    second = tmp_path / "out/q/toan 12/chương 1/Bài 7 - Đạo hàm/q002.json"
    assert json.loads(second.read_text())["answer"] == [[""]]
    assert "[OK]" in capsys.readouterr().out
    assert cli.main(["label", f"{out}/q", "--inplace"]) == 0
    assert json.loads(second.read_text()) | {"cognitive_level": None} == json.loads(second.read_text()) | {"cognitive_level": None} and json.loads(second.read_text())["cognitive_level"] == "knowledge"
    (folder / "bad.docx").write_bytes(b"no package")
    assert cli.main(["exercises", str(folder), "-o", f"{out}/e2"]) == 1 and "BadZipFile" in capsys.readouterr().err


def test_labeler_that_is_busy():
    slept, turns = [], iter([labelling.Busy(7), OSError(), labelling.Busy()])

    def ask(prompts):
        for e in turns:
            raise e
        return ["nhan_biet"] * len(prompts)

    assert labelling.retrying(ask, 4, 1.0, slept.append)(["a"]) == ["nhan_biet"] and slept == [7, 2.0, 4.0]
    assert labelling.retrying(lambda p: (_ for _ in ()).throw(OSError()), 2, 1.0, slept.append)(["a", "b"]) == [None, None]
