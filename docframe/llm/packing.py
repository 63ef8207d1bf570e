"""Packing token sequences by non-negative least squares over length combinations (operator 7).

A document is tokenized once and ends with token 1. Whole windows of its tokens are sequences of their own;
what remains has one of 2,047 lengths, and all planning is done on the histogram of those lengths, whose
size is fixed. All pairs and triples of lengths that fill a window exactly are enumerated, and for each length the
quadruple that splits what it leaves evenly; their repeat counts are solved as a non-negative least-squares fit to
the histogram and rounded, the largest first, to what the histogram still holds. What is left is packed greedily,
longest first, as one stream cut at window ends, so that only the last sequence is padded.

A remainder's place follows from its rank among those of its length: its rank in its own part of the input, which
the task that tokenizes that part counts, plus the parts before it, from a table of (part, length) counts. So no
length, however many documents share it, is ranked in one place, and no token bytes are sorted. The driver holds the
histogram (window numbers) and the plan (at most PLAN combinations and those that share a length with them).
Defined results: null and empty texts have the one token 1; every row is packed, repeated rows each on their own;
an empty table gives an empty result. A task holds the tokens of a few megabytes of text, or of one longer text.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.llm._io import cut
from docframe.llm._words import lean, slices

END, PLAN = 1, 1 << 16
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def _encoding(ranks_path: str):
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(text: str, vocabulary: str | None = None) -> list[int]:
    """The ids that the tokenizers library gives with the JSON form of the same vocabulary: the ranks file
    holds the same tokens and merges, and its reader takes a fifth of the time."""
    encoding = _encoding(vocabulary or default_vocabulary())
    return encoding.encode(text, allowed_special="all") if SPECIAL in text else encoding.encode_ordinary(text)


def tokens(docs: DataFrame, window: int, vocabulary: str | None = None) -> DataFrame:
    """part (of the input), doc_id, n_tokens, rest and whole (n_tokens as a remainder and whole windows), rank and
    whole_rank (rows and their whole windows before this one of its part and rest), and the little-endian unsigned
    32-bit ids, packed to 16 bits where all fit (wide tells)."""

    def run(batches):
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        seen, wholes = np.zeros(window, np.int64), np.zeros(window, np.int64)
        for batch in slices(batches):
            out, count, wide, rank, whole_rank = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = np.array([*encode(text or "", vocabulary), END], "<u4")
                big = bool(ids.max() > 0xFFFF)
                whole, rest = divmod(len(ids), window)
                out.append((ids if big else ids.astype("<u2")).tobytes())
                count.append(len(ids))
                wide.append(big)
                rank.append(int(seen[rest]))
                whole_rank.append(int(wholes[rest]))
                seen[rest] += 1
                wholes[rest] += whole
            n = np.array(count, np.int64)
            columns = [pa.array(x, pa.int64()) for x in (np.full(len(n), part), batch.column(0), n, n % window, n // window, rank, whole_rank)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(wide), pa.array(out, pa.binary())], [x.split()[0] for x in TOKENS.split(", ")])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lean(run), TOKENS)


TOKENS = "part long, doc_id long, n_tokens long, rest long, whole long, rank long, whole_rank long, wide boolean, ids binary"


def combinations(window: int) -> np.ndarray:
    """Rows of four lengths, longest first, that fill the window (0: none): all pairs and triples, and for each
    length the quadruple that splits what it leaves evenly."""
    low = np.arange(1, window // 2 + 1)
    found = [np.stack([window - low, low, 0 * low, 0 * low], 1)]
    for third in range(1, window // 3 + 1):
        second = np.arange(third, (window - third) // 2 + 1)
        found.append(np.stack([window - third - second, second, np.full(len(second), third), 0 * second], 1))
    first = np.arange(1, window - 2)
    even = np.stack([first, *[(window - first) // 3 + ((window - first) % 3 > i) for i in range(3)]], 1)
    found.append(-np.sort(-even, axis=1))
    return np.unique(np.concatenate(found), axis=0)


def fit(histogram: np.ndarray, combos: np.ndarray, steps: int = 200) -> np.ndarray:
    """x >= 0 that brings sum(x[c] * combo c) near the histogram in least squares, by multiplicative steps, which keep
    every x non-negative."""
    goal = histogram.astype(float)
    goal[0] = 0

    def covered(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, k], x, minlength=len(goal)) for k in range(combos.shape[1]))
        out[0] = 0
        return out

    x = np.full(len(combos), goal.sum() / max(3 * len(combos), 1))
    pull = goal[combos].sum(1)
    for _ in range(steps):
        x *= pull / np.maximum(covered(x)[combos].sum(1), 1e-12)
    return x


def _for_each_length(combos: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Which combos are among the `most` of largest x that hold some length."""
    place = np.empty(len(x), np.int64)
    place[np.argsort(-x, kind="stable")] = np.arange(len(x))
    length, which = combos.T.reshape(-1), np.tile(np.arange(len(x)), combos.shape[1])
    order = np.lexsort((place[which], length))
    length, which = length[order], which[order]
    rank = np.arange(len(length)) - np.searchsorted(length, length)
    out = np.zeros(len(x), bool)
    out[which[(rank < most) & (length > 0)]] = True
    return out


class Plan:
    """Where the k-th remainder of each length goes. Size: bounded by the number of combinations."""

    def __init__(self, histogram: np.ndarray, window: int, first_sequence: int, most: int = PLAN):
        combos = combinations(window)
        combos = combos[((histogram[combos] > 0) | (combos == 0)).all(1)]
        if len(combos) > most:
            combos = combos[_for_each_length(combos, fit(histogram, combos, 60), max(1, 3 * most // (2 * window)))]
        repeats = fit(histogram, combos)
        used = np.zeros(window, np.int64)
        slots: dict[int, list[tuple[int, int, int]]] = {}
        sequence = first_sequence
        order = np.argsort(-repeats, kind="stable")
        # First what the fit says, at least once each; then what the histogram still holds.
        for want in (np.maximum(1, np.floor(repeats)).astype(np.int64), None):
            left = histogram - used
            for c in order[((left[combos[order]] > 0) | (combos[order] == 0)).all(1)]:
                lengths, times = np.unique(combos[c][combos[c] > 0], return_counts=True)
                n = int(((histogram[lengths] - used[lengths]) // times).min())
                n = n if want is None else min(n, int(want[c]))
                if n <= 0:
                    continue
                offset = 0
                for length in combos[c][combos[c] > 0].tolist():
                    slots.setdefault(length, []).append((int(used[length]), sequence, offset))
                    used[length] += n
                    offset += length
                sequence += n
        self.window, self.used, self.stream = window, used, sequence
        self.slots = {n: tuple(np.array(v, np.int64) for v in zip(*s, strict=True)) for n, s in slots.items()}
        rest = (histogram - used) * np.arange(window)
        self.base = np.zeros(window, np.int64)
        self.base[::-1] = np.cumsum(rest[::-1]) - rest[::-1]

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, sequence, offset) of the remainder's one or two pieces."""
        if rank < self.used[length]:
            begins, sequences, offsets = self.slots[length]
            i = int(np.searchsorted(begins, rank, side="right")) - 1
            return [(length, int(sequences[i] + rank - begins[i]), int(offsets[i]))]
        at = int(self.base[length]) + (rank - int(self.used[length])) * length
        sequence, offset = self.stream + at // self.window, at % self.window
        head = min(length, self.window - offset)
        return [(head, sequence, offset)] + ([(length - head, sequence + 1, 0)] if head < length else [])


def pack(docs: DataFrame, window: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    vocabulary = vocabulary or default_vocabulary()
    rows = cut(tokens(docs, window, vocabulary), "tokens")
    counts = cut(rows.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("w")), "length-counts")
    histogram, wholes = np.zeros(window, np.int64), np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect():  # window rows at most
        histogram[r.rest], wholes[r.rest] = r.n, r.w
    whole_before = np.cumsum(wholes) - wholes
    histogram[0] = 0
    plan = Plan(histogram, window, int(wholes.sum()))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("_w"))
    ranked = rows.join(offsets.hint("shuffle_hash"), ["part", "rest"]).select(
        "doc_id", "n_tokens", "wide", "ids", "rest", "whole", (F.col("rank") + F.col("_n")).alias("rank"), (F.col("whole_rank") + F.col("_w")).alias("whole_rank")
    )

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc, n, wide, raw, rest, whole, rank, whole_rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4").tobytes()
                first = int(whole_before[rest]) + whole_rank
                pieces = [(window, first + i, 0) for i in range(whole)]
                if rest:
                    pieces += plan.place(rest, rank)
                start = 0
                for length, sequence, offset in pieces:
                    out.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, sequence, offset))
                    start += length
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], list(NAMES))

    return ranked.mapInArrow(lean(run), ", ".join(f"{n} long" for n in NAMES))


NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
