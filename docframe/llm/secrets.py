"""Secret scans by one combined deterministic automaton (operator 1).

All rules run as one automaton in one pass over a text's bytes; where it accepts, the rule's backward
automaton finds the leftmost start and its anchored automaton the longest end. Matches of one rule never
overlap: a match begins no earlier than the rule's last one ended, also when that one failed the rule's
lengths and was dropped.

A rule must not start before another of its matches and first accept after it (all rules here end in a run
of one class or a fixed text, which cannot). Defined results: null and empty texts have no spans; offsets are
code points, end exclusive; rows repeat as they are; a text of any length is scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm import automaton
from docframe.llm._words import lean, slices, text_buffer


@dataclass(frozen=True)
class Rule:
    """min_length: of the whole match; min_value: of the run that ends it, counted from the first byte at
    which the rule accepts."""

    name: str
    pattern: str
    ignore_case: bool = False
    min_length: int = 0
    min_value: int = 0


# The kinds in the order in which equal starts are listed.
RULES = (
    Rule("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", min_value=6),
    Rule("access", "AKIA[A-Z0-9]+", min_length=20),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git_token", "gh[opsu]_[A-Za-z0-9]+", min_length=40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", min_length=40),
)


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]):
    combined = automaton.build([automaton.parse(r.pattern, r.ignore_case) for r in rules], anchored=False)
    forward = [automaton.build([automaton.parse(r.pattern, r.ignore_case)], anchored=True) for r in rules]
    backward = [automaton.build([automaton.parse(r.pattern, r.ignore_case, backwards=True)], anchored=True) for r in rules]
    return combined, forward, backward


def _start(machine, data: bytes, last: int, bound: int) -> int:
    """The smallest start >= bound of a match whose last byte is at `last`, or -1."""
    rows, state, found = machine.rows, machine.start, -1
    for i in range(last, bound - 1, -1):
        state = rows[state][data[i]]
        if state == machine.dead:
            break
        if state >= machine.first_accepting:
            found = i
    return found


def _end(machine, data: bytes, start: int) -> tuple[int, int]:
    """The shortest and the longest end of a match from start."""
    rows, state, first, longest = machine.rows, machine.start, -1, -1
    for i in range(start, len(data)):
        state = rows[state][data[i]]
        if state == machine.dead:
            break
        if state >= machine.first_accepting:
            longest = i + 1
            if first < 0:
                first = longest
    return first, longest


def spans_of(data: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """(start, rule index, end) of every match in data, in bytes, by start and then rule."""
    combined, forward, backward = compiled(rules)
    rows, state, accepting = combined.rows, combined.start, combined.first_accepting
    free, out = [0] * len(rules), []
    for i, byte in enumerate(data):
        state = rows[state][byte]
        if state >= accepting:
            for k in combined.accepts[state]:
                if i < free[k]:
                    continue
                start = _start(backward[k], data, i, free[k])
                if start < 0:
                    continue
                first, end = _end(forward[k], data, start)
                free[k] = end
                if end - start >= rules[k].min_length and end - first + 1 >= rules[k].min_value:
                    out.append((start, k, end))
    return sorted(out)


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans with byte offsets turned to code points, by one walk over the places in order."""
    at, seen, points = 0, 0, {}
    for place in sorted({p for s, _, e in spans for p in (s, e)}):
        seen += len(data[at:place].decode("utf-8", "replace"))
        at = place
        points[place] = seen
    return [(points[s], k, points[e]) for s, k, e in spans]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end, value) of every row of docs, in the order of their starts."""

    def run(batches):
        for batch in slices(batches):
            data, offsets = text_buffer(batch.column(1))
            raw, found = data.tobytes(), []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                text = raw[a:b]
                spans = spans_of(text, rules)
                points = code_points(text, spans) if spans else []
                found.append([{"kind": rules[k].name, "start": s, "end": e, "value": text[x[0] : x[2]].decode()} for (s, k, e), x in zip(points, spans, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], ["doc_id", "spans"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lean(run), "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "*") -> DataFrame:
    """doc_id and text with every found span replaced by as many mask characters."""

    def run(batches):
        for batch in slices(batches):
            data, offsets = text_buffer(batch.column(1))
            raw, out = data.tobytes(), []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                text, at, parts = raw[a:b], 0, []
                for start, _, end in spans_of(text, rules):
                    if end > at:
                        start = max(start, at)
                        parts += [text[at:start].decode(), mask * len(text[start:end].decode())]
                        at = end
                out.append("".join([*parts, text[at:].decode()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lean(run), "doc_id long, text string")
