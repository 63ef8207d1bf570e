"""The equation format as published: one stream for each selector, the national encoding, rows."""

import struct

import pytest

from docframe.formula import mtef, tables
from tests.test_formula import HEAD, char, decode, line, template

A, B, I, N = (line(char(c)) for c in "abin")
NIL = b"\x01\x01"

# (selector, variation, slots, what is written)
TEMPLATES = [
    (0, 3, [A], r"\left\langle a \right\rangle"), (1, 3, [A], r"\left( a \right)"), (2, 1, [A], r"\left\{ a \right."), (3, 2, [A], r"\left. a \right]"),
    (4, 3, [A], r"\left| a \right|"), (5, 3, [A], r"\left\| a \right\|"), (6, 3, [A], r"\left\lfloor a \right\rfloor"), (7, 3, [A], r"\left\lceil a \right\rceil"),
    (8, 3, [A], r"\left\llbracket a \right\rrbracket"), (9, 0x12, [A], r"\left[ a \right)"), (9, 0x30, [A], r"\left( a \right]"), (10, 0, [A, NIL], r"\sqrt{a}"),
    (10, 1, [A, N], r"\sqrt[n]{a}"), (11, 0, [A, B], r"\frac{a}{b}"), (11, 2, [A, B], "a/b"), (12, 0, [A], r"\underline{a}"), (13, 0, [A], r"\overline{a}"),
    (14, 0x20, [A, B], r"\xrightarrow[b]{a}"), (14, 0x10, [A, NIL], r"\xleftarrow{a}"), (15, 1, [A, I, N], r"\int_{i}^{n} a"), (15, 2, [A, NIL, NIL], r"\iint a"),
    (15, 4, [A, NIL, NIL], r"\oint a"), (16, 0x30, [A, I, N], r"\sum_{i}^{n} a"), (17, 0, [A, I, N], r"\prod_{i}^{n} a"), (18, 0, [A, NIL, NIL], r"\coprod a"),
    (19, 0, [A, I, NIL], r"\bigcup_{i} a"), (20, 0, [A, I, NIL], r"\bigcap_{i} a"), (21, 0, [A, NIL, NIL], r"\int a"), (22, 0, [A, I, NIL], r"\sum_{i} a"),
    (23, 16, [A, I, NIL], "a_{i}"), (24, 1, [A, N], r"\overbrace{a}^{n}"), (24, 0, [A, N], r"\underbrace{a}_{n}"), (25, 1, [A, NIL], r"\overbrace{a}"),
    (26, 0, [A, B], r"\overline{)a}^{b}"), (27, 0, [A], "_{a}"), (28, 0, [NIL, A], "^{a}"), (29, 0, [A, B], "_{a}^{b}"), (30, 3, [A, B], r"\left\langle a|b \right\rangle"),
    (31, 2, [A], r"\vec{a}"), (31, 1, [A], r"\overleftarrow{a}"), (32, 0, [A], r"\tilde{a}"), (33, 0, [A], r"\hat{a}"), (34, 0, [A], r"\overset{\frown}{a}"),
    (36, 0, [A], r"\cancel{a}"), (37, 0, [A], r"\boxed{a}"),
]


@pytest.mark.parametrize(("selector", "variation", "slots", "written"), TEMPLATES)
def test_every_published_selector(selector, variation, slots, written):
    found = decode(template(selector, *slots, variation=variation))
    assert found["latex"] == written and found["selectors"] == [selector] and found["source"] == "mtef" and found["defects"] == []


def test_operator_that_draws_its_own_sign():
    drawn = bytes([3, 0, 22, 0, 0]) + A + I + NIL + char("⊕") + b"\0"
    assert decode(drawn)["latex"] == "⊕_{i} a"


def test_national_encoding():
    def words(raw):
        return mtef.decode(HEAD + bytes([17, 1]) + b".VnTime\0" + line(*[bytes([2, 0, 127]) + struct.pack("<H", c) for c in raw]) + b"\0")["latex"]

    known = {b"\xaei\xd6n": "điện", b"ch\xf8a": "chứa", b"kh\xabng": "không", b"H\xb9t": "Hạt", b"nh\xa9n": "nhân", b"v\xb5": "và", b"nguy\xaan": "nguyên", b"t\xf6": "tử", b"c\xb8c": "các"}
    for raw, word in known.items():
        assert words(raw) == r"\text{" + word + "}"
    assert len(tables.TCVN3) == len(set(tables.TCVN3.values())) == 74
    assert {c for c in tables.TCVN3.values() if c.islower()} == set("àảãáạăằẳẵắặâầẩẫấậđèẻẽéẹêềểễếệìỉĩíịòỏõóọôồổỗốộơờởỡớợùủũúụưừửữứựỳỷỹýỵ")


def test_private_letters_marks_and_degrees():
    private = lambda code: bytes([2, 0, 0x83]) + struct.pack("<H", code)
    assert decode(private(0x0200), private(0x0203), private(0x0219), private(0x021A), private(0x0233))["latex"] == "xawAZ"
    marked = lambda *codes: decode(bytes([2, 1, 0x83, ord("x"), 0]) + b"".join(bytes([6, 0, c]) for c in codes) + b"\0")["latex"]
    assert (marked(5), marked(6), marked(9), marked(2, 18)) == ("x'", "x''", r"\hat{x}", r"\dot{x}" + "'" * 3)
    assert decode(char("6"), char("0"), char("°"))["latex"] == r"60^\circ"
    assert decode(template(1, NIL), char("x"))["latex"] == "x"
    assert decode(*map(char, "x∈R"))["latex"] == r"x\in\mathbb{R}" and decode(*map(char, "R=2"))["latex"] == "R=2"


def pile(*texts, fenced=False):
    raw = bytes([4, 0, 0, 0]) + b"".join(line(*map(char, x)) if isinstance(x, str) else x for x in texts) + b"\0"
    return decode(template(2, line(raw), variation=1) if fenced else raw)["latex"]


def test_rows_of_a_pile():
    assert pile("a", "b") == "a b"
    assert pile("a", "b", fenced=True) == r"\left\{ \begin{array}{l}a \\ b\end{array} \right."
    assert pile("x=1", "y=2") == r"\begin{array}{l}x=1 \\ y=2\end{array}"
    assert pile("x=1", "=y") == "x=1 =y" and pile("x", ".") == "x." and pile("(a", ";b)") == "(a ;b)"
    assert pile("y=lim", "x→0", "f") == r"y=\lim_{x\to0} f" and pile("x=a", "b") == "x=a b"
    assert pile("lim", "", "x→2") == r"\lim_{x\to2}"
    call = line(*map(char, "y=1sin"), template(1, line(char("x")), variation=3))
    assert pile(call, "=z") == r"\begin{array}{l}y=1 \\ \sin \left( x \right) =z\end{array}"
    limit = line(*map(char, "lim"), template(27, line(*map(char, "x→0"))))
    assert pile(limit, line(template(28, NIL, line(char("+"))), char("f"))) == r"\lim_{x\to0^{+}}f"


def test_rows_at_the_top():
    rows = [line(*map(char, "x=1")), line(*map(char, "y=2"))]
    assert mtef.decode(HEAD + b"".join(rows) + b"\0")["latex"] == r"\begin{array}{l}x=1 \\ y=2\end{array}"
