"""Rows of an equation that a writer broke by hand: which belong to one line, which are a system, which are joined.

A row is a list of nodes (see latex.py). Nothing here looks at a whole formula; each rule is about how a row begins or
ends.
"""

from __future__ import annotations

LIMITS = ("lim", "max", "min", "sup", "inf")
TRIGONOMETRIC = ("arcsin", "arccos", "arctan", "sin", "cos", "tan", "cot")
SAME = set("=≈≥≤")
RELATIONS = SAME | set("≠⇔⇒")
GOES_ON = RELATIONS | set("<>+-−,;.∪∩∖∈∉⊂⊃⊄→")
OPEN, CLOSED = "([{", ")]}"


def bare(row: list) -> list:
    """The row without outer blanks, out of the rows that hold nothing but it."""
    out = list(row)
    while len(out) == 1 and isinstance(out[0], tuple) and out[0][0] == "row":
        out = list(out[0][1])
    while out and out[0] == " ":
        out.pop(0)
    while out and out[-1] == " ":
        out.pop()
    return out


def letters(row: list, end: bool = False) -> str:
    """The run of plain letters that a row begins or ends with."""
    out = ""
    for node in reversed(row) if end else row:
        if not (isinstance(node, str) and len(node) == 1 and node.isascii() and node.isalpha()):
            break
        out = node + out if end else out + node
    return out


def limit_at_end(row: list) -> bool:
    return letters(row, end=True).lower().endswith(LIMITS)


def limits_in(row: list) -> bool:
    return any(letters(row[k:]).startswith(LIMITS) for k in range(len(row)))


def approaches(row: list) -> bool:
    """x → a: letters and digits, then an arrow."""
    for node in row:
        if node == "→":
            return True
        if not (isinstance(node, str) and (node.isalnum() or node == " ") or isinstance(node, tuple) and node[0] == "script"):
            return False
    return False


def holds(row: list, signs: set | str) -> bool:
    """Whether one of the signs stands anywhere in the row."""
    return any(node in signs if isinstance(node, str) else any(holds(part, signs) for part in node if isinstance(part, list)) for node in row)


def depth(row: list) -> int:
    """Brackets that a row opens and leaves open."""
    return sum(isinstance(n, str) and n in OPEN for n in row) - sum(isinstance(n, str) and n in CLOSED for n in row)


def call_at_end(row: list) -> int | None:
    """Where a function call that ends a row begins, if an equation with a right side stands before it."""
    if not row or not (isinstance(row[-1], tuple) and row[-1][0] == "fence"):
        return None
    name = letters(row[:-1], end=True)
    found = next((f for f in TRIGONOMETRIC if name.endswith(f)), None)
    at = len(row) - 1 - len(found) if found else 0
    equal = next((i for i, n in enumerate(row[:at]) if n in ("=", "≈")), None)
    return at if equal is not None and bare(row[equal + 1 : at]) else None


def with_limits(rows: list[list]) -> list[list]:
    """A row that ends in lim, max, ... and the row of what it runs over are one."""
    out: list[list] = []
    for row in rows:
        if out and limit_at_end(out[-1]) and approaches(row):
            out[-1] = [*out[-1], ("script", row, [])]
        else:
            out.append(row)
    return out


def one_sided(rows: list[list]) -> list[list]:
    """The sign of a one-sided limit that slipped to the next row goes back under the limit."""
    rows = list(rows)
    for i in range(len(rows) - 1):
        last, first = rows[i][-1:], rows[i + 1][:1]
        limit = last and isinstance(last[0], tuple) and last[0][0] == "script" and "→" in last[0][1]
        sign = first and isinstance(first[0], tuple) and first[0][0] == "script" and not first[0][1] and first[0][2] in (["+"], ["-"], ["−"])
        if limit and sign:
            rows[i + 1] = [*rows[i][:-1], ("script", [*last[0][1], first[0]], last[0][2]), *rows[i + 1][1:]]
            rows[i] = []
    return [r for r in rows if r]


def continued(rows: list[list]) -> list[list]:
    """Rows that go on from the row before are one with it."""
    rows, out = [list(r) for r in rows], []
    for i, row in enumerate(rows):
        following = rows[i + 1] if i + 1 < len(rows) else []
        if following and following[0] in SAME and (at := call_at_end(row)) is not None:
            rows[i + 1] = [*row[at:], " ", *following]
            row = bare(row[:at])
        before = out[-1] if out else []
        condition = (row[0] == "(" or isinstance(row[0], tuple) and row[0][0] == "fence" and row[0][1] == "(") and holds(row, "≠∈")
        rest = holds(before, "=≈") and not holds(row, "=") and before[-1:] != ["."] and not limits_in(before) and not letters(row).startswith(TRIGONOMETRIC)
        if before and all(isinstance(n, str) and n in ".,;:" for n in row):
            out[-1] = [*before, *row]
        elif before and (row[0] in SAME or condition or rest or depth(before) > 0 or row[0] in (";", ",")):
            out[-1] = [*before, " ", *row]
        else:
            out.append(row)
    return out


def arrange(rows: list[list], fenced: bool = False) -> list:
    """Nodes for the rows of a pile: a system of lines, or one line."""
    rows = [r for r in map(bare, rows) if r]
    if not fenced:
        rows = continued(one_sided(with_limits(rows)))
    if len(rows) < 2:
        return rows[0] if rows else []
    split = any(isinstance(r[0], str) and r[0] in GOES_ON for r in rows[1:])
    if fenced or (not split and all(holds(r, RELATIONS) for r in rows) and not any(limits_in(r) for r in rows)):
        return [("lines", rows)]
    out = list(rows[0])
    for row in rows[1:]:
        out += row if row[0] in (",", ";", ".") else [" ", *row]
    return out
