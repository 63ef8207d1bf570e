"""Queries on texts of any length, null and empty ones, against plain Python."""

import base64
import re

from docframe.plans.catalog import QUERIES


def test_data_uri_of_every_document(spark, tmp_path):
    texts = [(1, "a" * 501, 501), (2, "đ\n" * 4000, 8000), (3, "short", None), (4, "", 0), (5, None, None), (None, "x" * 77, 77)]
    spark.createDataFrame(texts, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.img for r in QUERIES["data_uri"](spark, str(tmp_path)).collect()}
    assert got == {i: f'<img src="data:text/plain;base64,{base64.b64encode(t.encode()).decode()}">' if t else "" for i, t, _ in texts}


def test_label_prompt_of_whole_turns(spark, tmp_path):
    turns = [(1, 0, "<p>Which  of\n these</p>?"), (1, 1, "a choice that is longer than <b>twenty</b> characters"), (1, 2, "x " * 500 + "<i>y</i>"), (2, 1, None), (2, 0, "đ" * 900)]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plain = lambda t: re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", t or "")).strip()[:800]
    want = {}
    for conv in (1, 2):
        said = [plain(t) for c, _, t in sorted(turns, key=lambda x: x[:2]) if c == conv]
        want[conv] = f"Cau hoi:\n{said[0]}\n\nLua chon:\n" + "\n".join(f"{chr(65 + i)}. {t}" for i, t in enumerate(said)) + "\n\nPhan loai muc do nhan thuc:"
    assert {r.conv_id: r.prompt for r in QUERIES["label_prompt"](spark, str(tmp_path)).collect()} == want


def test_documents_without_lines_are_counted(spark, tmp_path):
    texts = [(1, "one two", "en"), (2, None, "en"), (3, "", "vi"), (4, " \n\t", None), (None, None, "vi")]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {name: QUERIES[name](spark, str(tmp_path)).collect() for name in ("doc_stats", "qa_gates", "qa_rollup", "theory_bounds")}
    assert {r.doc_id: (r.blocks, r.sections, r.words, r.tables, r.n_starts) for r in rows["doc_stats"]} == {1: (1, 1, 2, 0, 1)} | dict.fromkeys((2, 3, 4, None), (0,) * 5)
    gates = {r.doc_id: (r.flags, r.status) for r in rows["qa_gates"]}
    assert len(gates) == 5 and all("FEW_WORDS" in gates[i][0] and "NO_SECTIONS" in gates[i][0] and gates[i][1] == "FAIL" for i in (2, 3, 4, None))
    assert max(r.docs for r in rows["qa_rollup"]) == 5
    bounds = {r.doc_id: (r.first, r.last, r.n_starts, r.flags) for r in rows["theory_bounds"]}
    assert len(bounds) == 5 and all(bounds[i] == (None, None, 0, "THEORY_START_NOT_FOUND") for i in (2, 3, 4, None))
