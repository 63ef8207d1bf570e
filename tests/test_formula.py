import struct

from hypothesis import given
from hypothesis import strategies as st

from docframe.formula import latex, mtef, omml

HEAD = bytes(28) + bytes([5, 1, 0, 6, 9]) + b"DSMT6\0" + b"\0"


def char(c, face=0x83):
    return bytes([2, 0, face]) + struct.pack("<H", ord(c))


def line(*items):
    return b"\x01\x00" + b"".join(items) + b"\0"


def template(selector, *slots, variation=0):
    return bytes([3, 0, selector, variation, 0]) + b"".join(slots) + b"\0"


def decode(*items):
    return mtef.decode(HEAD + line(*items) + b"\0")


def test_plain_characters_and_functions():
    found = decode(*[char(c) for c in "y=sinx"])
    assert found["latex"] == r"y=\sin x" and found["source"] == "mtef" and found["defects"] == []


def test_function_of_x_as_dumped():
    """A fence template with colour records and its own fence characters, as writers store it."""
    fence = bytes([3, 0, 1, 3, 0, 0x0F, 0, 1, 0, 0x0F, 1]) + char("x") + b"\0" + char("(", 0x96) + char(")", 0x96) + b"\0"
    found = decode(char("y"), char("="), char("f"), fence)
    assert found["latex"] == r"y=f\left( x \right)" and found["selectors"] == [1]


def test_templates():
    a, b = line(char("a")), line(char("b"))
    assert decode(template(11, a, b))["latex"] == r"\frac{a}{b}"
    assert decode(template(10, a, line()))["latex"] == r"\sqrt{a}"
    assert decode(template(10, a, b))["latex"] == r"\sqrt[b]{a}"
    assert decode(char("x"), template(29, a, b))["latex"] == "x_{a}^{b}"
    assert decode(char("x"), template(28, b"\x01\x01", b))["latex"] == "x^{b}"
    assert decode(template(2, a, variation=1))["latex"] == r"\left\{ a \right."
    assert decode(template(99, a))["latex"] == "a"


def test_matrix_pile_and_damage():
    cells = b"".join(line(char(c)) for c in "abcd")
    grid = bytes([5, 0, 0, 0, 0, 2, 2]) + bytes(1) + bytes(1) + cells + b"\0"
    assert decode(grid)["latex"] == r"\begin{matrix}a & b \\ c & d\end{matrix}"
    pile = bytes([4, 0, 0, 0]) + line(char("a")) + line(char("b")) + b"\0"
    assert decode(pile)["latex"] == "a b"
    cut = (HEAD + line(char("a"), template(11, line(char("b")), line(char("c")))))[:-6]
    assert mtef.decode(cut)["source"] == "mtef_partial"
    assert mtef.decode(None)["source"] == mtef.decode(b"xx")["source"] == "unresolved"


def test_typed_tex_wins():
    assert mtef.decode(HEAD + b"..TeX Input Language\0\\[\\frac{1}{2}\\]\0")["latex"] == r"\frac{1}{2}"


@given(st.binary(max_size=200))
def test_decode_never_raises(tail):
    mtef.decode(HEAD + tail)


@given(st.text(alphabet="ab{}\\ leftright()", max_size=40))
def test_repair_is_sound_and_idempotent(text):
    once = latex.repair(text)
    assert latex.repair(once) == once
    if not latex.defects(text):
        assert once == text


def test_omml():
    m = 'xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math"'
    run = lambda t: f"<m:r><m:t>{t}</m:t></m:r>"
    body = f"<m:oMath {m}><m:f><m:num>{run('a')}</m:num><m:den>{run('b')}</m:den></m:f><m:sSup><m:e>{run('x')}</m:e><m:sup>{run('2')}</m:sup></m:sSup>"
    body += f"<m:nary><m:naryPr><m:chr m:val='∑'/></m:naryPr><m:sub>{run('i')}</m:sub><m:sup>{run('n')}</m:sup><m:e>{run('k')}</m:e></m:nary></m:oMath>"
    assert omml.to_latex(body) == r"\frac{a}{b}x^{2}\sum_{i}^{n} k"
