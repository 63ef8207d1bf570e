"""Binary equations (version 5) to LaTeX: a reader of the record grammar builds a tree, latex.py writes it.

Layout, as published for the format: after the OLE header of 28 bytes come version, platform, product, its
version and subversion, the application key as a C string and an options byte; then records. LINE, CHAR, TMPL,
PILE, MATRIX and EMBELL carry an options byte. A damaged stream never raises out of decode().
"""

from __future__ import annotations

import re

from docframe.formula import latex, rows
from docframe.formula import tables as t

END, LINE, CHAR, TMPL, PILE, MATRIX, EMBELL, RULER, FONT_STYLE, SIZE, FULL, SUBSYM, COLOR, COLOR_DEF, FONT_DEF, PREFS, ENCODING = 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14, 15, 16, 17, 18, 19
NULL_LINE, EMBELLISHED, HAS_RULER, CHAR_BYTE, LINE_SPACE, NUDGED, CHAR_WORD, NO_CODE = 0x01, 0x01, 0x02, 0x04, 0x04, 0x08, 0x10, 0x20
TEX_MARK = b"TeX Input Language\x00"
DEEPEST = 24


class Damaged(Exception):
    """The stream ends early or is no equation."""


class Stream:
    def __init__(self, data: bytes):
        self.data, self.at, self.fonts, self.selectors, self.damaged, self.fences = data, 0, [], [], False, 0

    def byte(self) -> int:
        at = self.at
        if at >= len(self.data):
            raise Damaged("ends early")
        self.at = at + 1
        return self.data[at]

    def word(self) -> int:
        return self.byte() | self.byte() << 8

    def string(self) -> bytes:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise Damaged("string without end")
        out, self.at = self.data[self.at : end], end + 1
        return out

    def nudge(self, options: int) -> None:
        if options & NUDGED and (self.byte(), self.byte()) == (128, 128):
            self.word()
            self.word()

    def unsigned(self) -> int:
        first = self.byte()
        return self.word() if first == 255 else first

    def nibbles(self, count: int) -> None:
        """Lengths or styles in half bytes, each list entry ended by 0xF."""
        pending: list[int] = []

        def half() -> int:
            if not pending:
                b = self.byte()
                pending.extend((b & 15, b >> 4))
            return pending.pop()

        for _ in range(count):
            half()
            while half() != 15:
                pass

    def ruler(self) -> None:
        for _ in range(self.byte()):
            self.byte()
            self.word()

    def skip(self, kind: int) -> None:
        """Records without a part in the formula."""
        if kind >= 100:
            size = self.unsigned()
            self.at += size
        elif kind == SIZE:
            first = self.byte()
            if first == 101:
                self.word()
            elif first == 100:
                self.byte()
                self.word()
            else:
                self.byte()
        elif kind == COLOR:
            self.unsigned()
        elif kind == COLOR_DEF:
            options = self.byte()
            for _ in range(4 if options & 1 else 3):
                self.word()
            if options & 4:
                self.string()
        elif kind == FONT_DEF:
            self.unsigned()
            self.fonts.append(self.string().decode("latin1"))
        elif kind == FONT_STYLE:
            self.unsigned()
            self.byte()
        elif kind == PREFS:
            self.byte()
            self.nibbles(self.byte())
            self.nibbles(self.byte())
            for _ in range(self.byte()):
                if self.byte():
                    self.byte()
        elif kind == ENCODING:
            self.string()
        elif kind == RULER:
            self.ruler()
        elif not FULL <= kind <= SUBSYM:
            raise Damaged(f"record {kind}")

    def objects(self, depth: int = 0) -> list:
        """Nodes up to the list's END record, or up to where the stream ends or is damaged."""
        out: list = []
        try:
            if depth > DEEPEST:
                raise Damaged("too deep")
            while depth or self.at < len(self.data):
                kind = self.byte()
                if kind == END:
                    break
                out += self.node(kind, depth)
        except Damaged:
            self.damaged, self.at = True, len(self.data)
        return out

    def node(self, kind: int, depth: int) -> list:
        if kind == LINE:
            return [("row", self.line(depth))]
        if kind == CHAR:
            return self.char(depth)
        if kind == TMPL:
            return [self.template(depth)]
        if kind == MATRIX:
            return [self.matrix(depth)]
        if kind == PILE:
            options = self.byte()
            self.nudge(options)
            self.byte(), self.byte()
            if options & HAS_RULER:
                self.ruler()
            found = [x[1] for x in self.objects(depth + 1) if x[0] == "row"]
            return [("row", rows.arrange(found, self.fences > 0))]
        self.skip(kind)
        return []

    def line(self, depth: int) -> list:
        options = self.byte()
        self.nudge(options)
        if options & LINE_SPACE:
            self.byte()
        if options & HAS_RULER:
            self.byte()
            self.ruler()
        return [] if options & NULL_LINE else self.objects(depth + 1)

    def char(self, depth: int) -> list:
        options = self.byte()
        self.nudge(options)
        face = self.byte() - 128
        code = 0 if options & NO_CODE else self.word()
        if options & CHAR_BYTE:
            code = self.byte() if options & NO_CODE else (self.byte(), code)[1]
        if options & CHAR_WORD:
            code = self.word() if options & NO_CODE else (self.word(), code)[1]
        marks = []
        if options & EMBELLISHED:
            while (kind := self.byte()) != END:
                if kind != EMBELL:
                    raise Damaged(f"embellishment {kind}")
                self.nudge(self.byte())
                marks.append(self.byte())
        return embellished(self.letter(code, face), marks)

    def letter(self, code: int, face: int) -> list:
        font = self.fonts[-face - 1] if face < 0 and -face <= len(self.fonts) else ""
        if code in t.PRIVATE_LETTERS:
            return [t.PRIVATE_LETTERS[code]]
        if font.lower().startswith(".vn") and code in t.TCVN3:
            return [t.TCVN3[code]]
        if 0xE000 <= code <= 0xF8FF:
            code = code & 0xFF if 0x20 < code & 0xFF < 0x7F else 0x20
        return [chr(code)] if code else []

    def matrix(self, depth: int):
        options = self.byte()
        self.nudge(options)
        self.byte(), self.byte(), self.byte()
        rows, columns = self.byte(), self.byte()
        if not (0 < rows <= 20 and 0 < columns <= 20):
            raise Damaged("matrix size")
        for count in (rows, columns):
            self.at += (2 * (count + 1) + 7) // 8
        cells = [x[1] for x in self.objects(depth + 1) if x[0] == "row"]
        cells += [[]] * (rows * columns - len(cells))
        grid = [cells[r * columns : (r + 1) * columns] for r in range(rows)]
        return ("row", grid[0][0]) if rows == columns == 1 else ("matrix", grid)

    def template(self, depth: int):
        self.nudge(self.byte())
        selector, variation = self.byte(), self.byte()
        if variation & 0x80:
            variation = variation & 0x7F | self.byte() << 7
        self.byte()
        self.selectors.append(selector)
        fence = selector in t.FENCES or selector == t.INTERVAL
        self.fences += fence
        parts = self.objects(depth + 1)
        self.fences -= fence
        slots = [x[1] for x in parts if isinstance(x, tuple) and x[0] == "row"]
        drawn = next((x for x in reversed(parts) if isinstance(x, str)), "")
        return shaped(selector, variation, [*slots, [], [], []], drawn)


def embellished(letter: list, marks: list[int]) -> list:
    """A character with the marks above it, then its primes."""
    out = letter
    for mark in marks:
        if mark in t.MARKS and letter:
            out = [("dress", t.MARKS[mark], out)]
    return [*out, *["'"] * sum(t.PRIMES.get(mark, 0) for mark in marks)]


def shaped(selector: int, variation: int, slots: list[list], drawn: str):
    """The node of a template; drawn is the sign that it draws itself. An unknown selector keeps all its slots."""
    body, second, third = slots[:3]
    if selector in t.FENCES:
        left, right = t.FENCES[selector]
        if variation & 3:
            left, right = left if variation & 1 else ".", right if variation & 2 else "."
        return ("fence", left, right, body)
    if selector == t.INTERVAL:
        sides = ("(", ")", "[", "]")
        return ("fence", sides[variation & 3], sides[variation >> 4 & 3], body)
    if selector == t.DIRAC:
        middle = [*body, "|", *second] if variation & 3 == 3 else body or second
        return ("fence", r"\langle" if variation & 3 != 2 else "|", r"\rangle" if variation & 3 != 1 else "|", middle)
    if selector == t.ROOT:
        return ("root", body, second)
    if selector == t.FRACTION:
        return ("row", [*body, "/", *second]) if variation & 2 else ("frac", body, second)
    if selector == t.DIVISION:
        return ("row", [("dress", r"\overline", [")", *body]), ("script", [], second)])
    if selector in (t.SUB, t.SUP, t.SUBSUP):
        low, high = (body, second) if selector == t.SUBSUP else (body, []) if selector == t.SUB else ([], second or body)
        return ("script", low, high)
    if selector == t.LIMIT:
        return ("row", [("row", body), ("script", second, third)])
    if selector == t.INTEGRAL:
        sign = r"\oint" if variation & 0xC else (r"\int", r"\int", r"\iint", r"\iiint")[variation & 3]
        return ("big", sign, body, second, third)
    if selector in t.OPERATORS:
        return ("big", t.OPERATORS[selector], body, second, third)
    if selector in (t.INTEGRAL_LIKE, t.SUM_LIKE):
        return ("big", latex.char(drawn) or (r"\int" if selector == t.INTEGRAL_LIKE else r"\sum"), body, second, third)
    if selector in (t.BRACE, t.BRACKET):
        over = variation & 1
        return ("row", [("dress", r"\overbrace" if over else r"\underbrace", body), ("script", [] if over else second, second if over else [])])
    if selector == t.ARROW:
        return ("arrow", r"\xleftarrow" if variation & 0x10 and not variation & 0x20 else r"\xrightarrow", body, second)
    if selector == t.VECTOR:
        both = variation & 3 == 3
        return ("dress", r"\overleftrightarrow" if both else r"\overleftarrow" if variation & 1 else r"\vec" if len(body) < 2 else r"\overrightarrow", body)
    if selector in t.DRESSINGS:
        return ("dress", t.DRESSINGS[selector], body)
    return ("row", [("row", body), ("script", second, third)])


def decode(stream: bytes | None) -> dict:
    """latex, source (tex, mtef, mtef_partial, unresolved), selectors, defects of an equation stream."""
    none = {"latex": None, "source": "unresolved", "selectors": [], "defects": []}
    if not stream:
        return none
    mark = stream.find(TEX_MARK)
    if mark >= 0:
        typed = stream[mark + len(TEX_MARK) :].split(b"\0", 1)[0].decode("latin1").strip()
        typed = re.sub(r"^(?:\\\[|\$+)|(?:\\\]|\$+)$", "", typed).strip()
        return {"latex": typed, "source": "tex", "selectors": [], "defects": latex.defects(typed)} if typed else none
    reader, partial = Stream(stream), False
    reader.at = 28
    nodes: list = []
    try:
        if reader.byte() != 5:
            return none
        reader.at += 4
        reader.string()
        reader.byte()
        nodes = reader.objects()
        partial = reader.damaged or any(stream[reader.at :])
    except Damaged:
        partial = True
    lines = [x[1] for x in nodes if isinstance(x, tuple) and x[0] == "row"]
    text = latex.to_latex(rows.arrange(lines) if len(lines) == len(nodes) > 1 else nodes)
    if not text:
        return none | {"selectors": reader.selectors}
    found = latex.defects(text)
    return {"latex": latex.repair(text, found), "source": "mtef_partial" if partial else "mtef", "selectors": reader.selectors, "defects": found}
