"""LaTeX from expression trees, and checks of LaTeX text.

A tree is a list of nodes: a string (one character or command), or a tuple whose first item names it:
("row", [..]), ("frac", a, b), ("root", body, index), ("script", sub, sup), ("fence", left, right, body),
("big", command, body, low, high), ("dress", command, body), ("arrow", command, above, below), ("lines", [rows]),
("matrix", [[cells]]).
"""

from __future__ import annotations

import re

from docframe.formula.tables import ESCAPES, FUNCTIONS, SYMBOLS

SETS = {"N": "ℕ", "Z": "ℤ", "Q": "ℚ", "R": "ℝ", "C": "ℂ"}
_COMMAND, _BLANKS, _BEFORE_SCRIPT, _PRIVATE = re.compile(r"\\[A-Za-z]+$"), re.compile(r" {2,}"), re.compile(r" +(?=[_^])"), re.compile("[\ue000-\uf8ff]")
_NAMES = re.compile("|".join(sorted(FUNCTIONS, key=len, reverse=True)))


def _letters(text: str) -> str:
    """A run of letters: function names become commands, words in other scripts text."""
    if not text.isascii():
        return r"\text{" + text + "}"
    out, at = [], 0
    for m in _NAMES.finditer(text):
        out += [text[at : m.start()], "\\" + m[0] + " "]
        at = m.end()
    return "".join([*out, text[at:]])


def char(c: str) -> str:
    return SYMBOLS.get(c) or ESCAPES.get(c) or c


def sets(nodes: list) -> list:
    """Number sets as such: one of N, Z, Q, R, C alone after a sign of belonging, or before a set difference."""
    if not any(isinstance(x, str) and x in SETS for x in nodes):
        return nodes
    out = list(nodes)
    alone = lambda i: not (0 <= i < len(out) and isinstance(out[i], str) and len(out[i]) == 1 and out[i].isalpha())
    for i, node in enumerate(out):
        if isinstance(node, str) and node in SETS and alone(i - 1) and alone(i + 1):
            before = next((x for x in reversed(out[:i]) if x != " "), None)
            after = next((x for x in out[i + 1 :] if x != " "), None)
            if before in ("∈", "∉", "⊂", "⊆") or after in ("∖", "\\"):
                out[i] = SETS[node]
    return out


def to_latex(nodes: list) -> str:
    out: list[str] = []
    run = ""
    for node in [*sets(nodes), None]:
        if isinstance(node, str) and node.isalpha() and node not in SYMBOLS:
            run += node
            continue
        if run:
            out.append(_letters(run))
            run = ""
        if node is not None:
            out.append(_one(node))
    text = ""
    for piece in out:
        gap = piece[:1].isalpha() and "\\" in text and _COMMAND.search(text)
        text += (" " if gap else "") + piece
    return _BEFORE_SCRIPT.sub("", _BLANKS.sub(" ", text)).strip() if " " in text else text.strip()


def _one(node) -> str:
    if isinstance(node, str):
        return char(node)
    kind, *rest = node
    if kind == "row":
        return to_latex(rest[0])
    if kind == "frac":
        return rf"\frac{{{to_latex(rest[0])}}}{{{to_latex(rest[1])}}}"
    if kind == "root":
        index = to_latex(rest[1])
        return r"\sqrt" + (f"[{index}]" if index else "") + f"{{{to_latex(rest[0])}}}"
    if kind == "script":
        return "".join(f"{mark}{{{x}}}" for mark, part in zip("_^", rest, strict=True) if (x := to_latex(part)))
    if kind == "fence":
        body = to_latex(rest[2])
        return rf"\left{rest[0]} {body} \right{rest[1]}" if body else ""  # a fence around nothing is no part of a formula
    if kind == "big":
        command, body, low, high = rest
        return f"{command}{_one(('script', low, high))} {to_latex(body)}"
    if kind == "dress":
        return f"{rest[0]}{{{to_latex(rest[1])}}}"
    if kind == "arrow":
        below = to_latex(rest[2])
        return rest[0] + (f"[{below}]" if below else "") + f"{{{to_latex(rest[1])}}}"
    if kind == "lines":
        return r"\begin{array}{l}" + r" \\ ".join(to_latex(r) for r in rest[0]) + r"\end{array}"
    if kind == "matrix":
        return r"\begin{matrix}" + r" \\ ".join(" & ".join(to_latex(c) for c in r) for r in rest[0]) + r"\end{matrix}"
    raise ValueError(f"unknown node {kind}")


_TOKEN = re.compile(r"\\[A-Za-z]+|\\.|[{}]|[^\\{}]+", re.S)


def defects(latex: str) -> list[str]:
    """What a strict formula gate has against a formula; empty: nothing."""
    found, depth, fences, environments = [], 0, 0, []
    tokens = _TOKEN.findall(latex)
    for i, token in enumerate(tokens):
        depth += (token == "{") - (token == "}")
        if depth < 0:
            found.append("BRACE_CLOSED_EARLY")
            depth = 0
        fences += (token == r"\left") - (token == r"\right")
        if fences < 0:
            found.append("FENCE_CLOSED_EARLY")
            fences = 0
        if token in (r"\begin", r"\end") and i + 2 < len(tokens):
            name = tokens[i + 2]
            if token == r"\begin":
                environments.append(name)
            elif not environments or environments.pop() != name:
                found.append("ENVIRONMENT_MISMATCH")
    found += ["BRACE_OPEN"] * (depth > 0) + ["FENCE_OPEN"] * (fences > 0) + ["ENVIRONMENT_OPEN"] * bool(environments)
    if _PRIVATE.search(latex):
        found.append("PRIVATE_CHARACTER")
    if not latex.strip():
        found.append("EMPTY")
    return found


def repair(latex: str, found: list[str] | None = None) -> str:
    """Close what is open and drop what closes nothing. Sound text is returned as it is. found: its defects, where they are known."""
    if not (defects(latex) if found is None else found):
        return latex
    out, stack = [], []
    for token in _TOKEN.findall(latex):
        if token in ("{", r"\left"):
            stack.append(token)
        elif token in ("}", r"\right"):
            if not stack or (stack[-1] == "{") != (token == "}"):
                continue
            stack.pop()
        out.append(token)
    closing = {"{": "}", r"\left": r"\right."}
    return "".join(out + [closing[x] for x in reversed(stack)])
