"""Packages written from rows: paragraphs and tables of runs, with embedded equations, typed formulas and images.

A package written here and read by sources.docx gives its rows back, which is how queries over plain tables meet the
readers."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from itertools import batched, groupby
from operator import itemgetter
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = "struct<kind:string,text:string,bold:boolean,color:string,underline:boolean,data:binary>"
PARAGRAPH = f"struct<kind:string,style:string,ilvl:int,runs:array<{RUN}>,cells:array<array<{RUN}>>>"
_FREE, _END, _TABLE = 0xFFFFFFFF, 0xFFFFFFFE, 0xFFFFFFFD
_HEADER = struct.pack("<8s16xHHHHH6xIIIIIIIII109I", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", 62, 3, 0xFFFE, 9, 6, 0, 1, 1, 0, 4096, 2, 1, _END, 0, 0, *[_FREE] * 108)
#: Rows that become Python objects at once, bytes of packages that are handed on together, paragraphs that are
#: written at once.
_AT_ONCE, _TOGETHER, _PIECES = 256, 4 << 20, 64
_UNWRITABLE = re.compile("[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]")
_NAMES = {
    "w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "a": "http://schemas.openxmlformats.org/drawingml/2006/main", "o": "urn:schemas-microsoft-com:office:office", "m": "http://schemas.openxmlformats.org/officeDocument/2006/math",
}


def png(width: int, height: int) -> bytes:
    """A grey image of that size."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = (b"\0" + b"\x80" * width) * height
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def compound(stream: bytes, name: str = "Equation Native") -> bytes:
    """A compound file (512-byte sectors) that holds one stream of under 4,096 bytes."""
    blocks = max(1, -(-len(stream) // 64))
    sectors = -(-blocks * 64 // 512)
    table = [_TABLE, _END, _END, *range(4, 3 + sectors), _END]
    minis = [*range(1, blocks), _END]

    def entry(title: str, kind: int, start: int, size: int) -> bytes:
        raw = title.encode("utf-16-le")
        return struct.pack("<64sHBBIII36xIII", raw, len(raw) + 2, kind, 1, _FREE, _FREE, 1 if kind == 5 else _FREE, start, size, 0)

    whole = lambda numbers: struct.pack(f"<{len(numbers)}I", *numbers).ljust(512, b"\xff")
    directory = entry("Root Entry", 5, 3, blocks * 64) + entry(name, 2, 0, len(stream)) + bytes(256)
    return _HEADER + whole(table) + directory + whole(minis) + stream.ljust(sectors * 512, b"\0")


def equation(nodes: list, key: str = "DSMT6") -> bytes:
    """The equation stream of an expression tree of characters, fractions, roots, scripts, round fences, rows of a pile
    ("lines"), matrices, and any template by its number ("template", selector, variation, slots...)."""

    def record(node) -> bytes:
        if isinstance(node, str):
            return struct.pack("<BBBH", 2, 0, 0x83, ord(node))
        kind, *parts = node
        if kind == "lines":
            return bytes([4, 0, 0, 0]) + b"".join(line(r) for r in parts[0]) + b"\0"
        if kind == "matrix":
            rows, columns = len(parts[0]), len(parts[0][0])
            rules = bytes((2 * (rows + 1) + 7) // 8) + bytes((2 * (columns + 1) + 7) // 8)
            return bytes([5, 0, 0, 0, 0, rows, columns]) + rules + b"".join(line(c) for r in parts[0] for c in r) + b"\0"
        if kind == "template":
            return bytes([3, 0, parts[0], parts[1], 0]) + b"".join(line(p) for p in parts[2:]) + b"\0"
        selector = {"frac": 11, "root": 10, "script": 29, "fence": 1}[kind]
        return bytes([3, 0, selector, 3 if kind == "fence" else 0, 0]) + b"".join(line(p) for p in parts) + b"\0"

    def line(part: list) -> bytes:
        return b"\x01\x00" + b"".join(map(record, part)) + b"\0" if part else b"\x01\x01"

    return bytes(28) + bytes([5, 1, 0, 6, 9]) + key.encode() + b"\0\0" + line(nodes) + b"\0"


class Writer:
    """One package; package() may be called once. Equal pictures, or equal embedded objects, are one part."""

    def __init__(self):
        self.parts: list[tuple[str, bytes]] = []
        self.known: dict[tuple[str, bytes], str] = {}

    def add(self, name: str, ending: str, data: bytes) -> str:
        if (name, data) not in self.known:
            self.parts.append((f"{name}{len(self.parts) + 1}{ending}", data))
            self.known[name, data] = f"rId{len(self.parts)}"
        return self.known[name, data]

    def run(self, r: dict) -> str:
        kind, data = r.get("kind") or "text", r.get("data") or b""
        if kind == "math":
            return f"<m:oMath>{r.get('text') or ''}</m:oMath>"
        if kind == "image":
            return f"<w:r><w:drawing><a:blip r:embed='{self.add('media/image', '.png', data)}'/></w:drawing></w:r>"
        if kind == "equation":
            return f"<w:r><w:object><o:OLEObject r:id='{self.add('embeddings/oleObject', '.bin', data)}'/></w:object></w:r>"
        look = "<w:b/>" * bool(r.get("bold")) + (f"<w:color w:val='{escape(r['color'])}'/>" if r.get("color") else "") + "<w:u w:val='single'/>" * bool(r.get("underline"))
        text = r.get("text") or ""
        text = escape(text if text.isprintable() else _UNWRITABLE.sub("", text))  # what can be printed can be written
        pieces = "<w:br/>".join(f"<w:t xml:space='preserve'>{x}</w:t>" for x in text.split("\n"))
        return f"<w:r><w:rPr>{look}</w:rPr>{pieces}</w:r>"

    def paragraph(self, p: dict) -> str:
        if p.get("kind") == "table":
            cells = lambda row: "".join(f"<w:tc><w:p>{self.run(c)}</w:p></w:tc>" for c in row)
            return "<w:tbl>" + "".join(f"<w:tr>{cells(row)}</w:tr>" for row in p.get("cells") or ()) + "</w:tbl>"
        level = f"<w:numPr><w:ilvl w:val='{p['ilvl']}'/></w:numPr>" if p.get("ilvl") is not None else ""
        style = f"<w:pStyle w:val='{escape(p['style'])}'/>" if p.get("style") else ""
        return f"<w:p><w:pPr>{style}{level}</w:pPr>{''.join(self.run(r) for r in p.get('runs') or ())}</w:p>"

    def package(self, paragraphs: Iterable[dict], packed: bool = False) -> bytes:
        """The package's bytes. Paragraphs are written as they come; packed: the body is compressed."""
        names = " ".join(f"xmlns:{k}='{v}'" for k, v in _NAMES.items())
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            put = lambda name, data: z.writestr(zipfile.ZipInfo(name), data)  # noqa: E731  no date: equal rows, equal bytes
            body = zipfile.ZipInfo("word/document.xml")
            body.compress_type = zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED
            with z.open(body, "w", force_zip64=packed) as part:
                part.write(f"<w:document {names}><w:body>".encode())
                for few in batched(paragraphs, _PIECES):
                    part.write("".join(map(self.paragraph, few)).encode())
                part.write(b"</w:body></w:document>")
            links = "".join(f"<Relationship Id='rId{i}' Target='{name}'/>" for i, (name, _) in enumerate(self.parts, 1))
            put("word/_rels/document.xml.rels", f"<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>{links}</Relationships>")
            for name, data in self.parts:
                put(f"word/{name}", data)
        return out.getvalue()


def objects(array: pa.Array) -> list:
    """array.to_pylist() of texts, bytes, integers, booleans and what nests them, put together from whole columns: to_pylist makes
    an object of its own for each value on the way."""
    if array.null_count == len(array):
        return [None] * len(array)
    if pa.types.is_struct(array.type):
        names = [field.name for field in array.type]
        made = [dict(zip(names, values)) for values in zip(*map(objects, array.flatten()))]
        return made if not array.null_count else [x if held else None for x, held in zip(made, array.is_valid().to_pylist(), strict=True)]
    if pa.types.is_list(array.type):
        flat, at, made = objects(array.flatten()), 0, []
        for size in array.value_lengths().to_pylist():
            made.append(None if size is None else flat[at : at + size])
            at += size or 0
        return made
    if array.null_count and not (pa.types.is_string(array.type) or pa.types.is_binary(array.type)):
        return array.to_pylist()  # else numbers beside nulls become fractions
    return array.to_numpy(zero_copy_only=False).tolist()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches of two columns, few at a time as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, _AT_ONCE):
            few = batch.slice(at, _AT_ONCE)
            yield from zip(few.column(0).to_pylist(), objects(few.column(1)), strict=True)


def _handed_on(made: Iterable[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
    """Batches of path, length, content."""
    kept: list[tuple[str, int, bytes]] = []
    size = 0
    for path, content in made:
        kept.append((path, len(content), content))
        size += len(content)
        if size >= _TOGETHER:
            yield _batch(kept)
            kept, size = [], 0
    if kept:
        yield _batch(kept)


def _batch(kept: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)], ["path", "length", "content"])


def packages(rows: DataFrame) -> DataFrame:
    """path, length, content of a package for every row (path, paragraphs array<PARAGRAPH>), as sources.docx.scan gives
    them. A row's paragraphs meet in one task and must fit it; see bundled for packages of many."""

    def run(batches):
        yield from _handed_on((path, Writer().package(p or [])) for path, p in _rows(batches))

    narrow = rows.select(F.col("path").cast("string").alias("path"), F.col("paragraphs").cast(f"array<{PARAGRAPH}>").alias("paragraphs"))
    return narrow.mapInArrow(run, "path string, length long, content binary")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt out by keys to as many tasks as a shuffle has: a small table that much work is done for."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def gathered(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """rows with those of one key after one another in one task, ordered: what bundled asks for."""
    return spread(rows, key).sortWithinPartitions(key, *order)


def bundled(rows: DataFrame) -> DataFrame:
    """packages of rows (path, paragraph PARAGRAPH) that are gathered: a task writes paragraphs as they come and holds one
    package's compressed body and its distinct parts, never its paragraphs."""

    def run(batches):
        def made():
            for path, own in groupby(_rows(batches), key=itemgetter(0)):
                yield path, Writer().package((p for _, p in own), packed=True)

        yield from _handed_on(made())

    narrow = rows.select(F.col("path").cast("string").alias("path"), F.col("paragraph").cast(PARAGRAPH).alias("paragraph"))
    return narrow.mapInArrow(run, "path string, length long, content binary")
