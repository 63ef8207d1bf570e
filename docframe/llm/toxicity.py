"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 2).

Input of a word: a learned vector of the word (hashed) plus the mean of learned vectors of its character
runs (3 and 4 bytes of the word between marks, hashed). Two gated recurrent layers read a window of 64 words
in both directions, attention weighs the 64 joint states, and a logistic output reads the pooled state. Windows
overlap (a new one begins every 48 words) and cover the text; a document scores as its highest window.

Trained by Adam in numpy on a bounded sample (sample_per_class labelled rows of each class, whole texts of up
to most_chars code points). As a label does not say where a text is toxic, training alternates: every window
of a toxic text counts first, then the window that scores highest; of clean texts the highest and a drawn one. In each step half of the words show only their character runs, so
that runs are learned beside words. A fifth of the sample is kept aside to set the output's bias, where the
errors at the stated share of toxic texts are fewest.

Texts are scored two megabytes at a time, or one longer text alone; memory is some 80 bytes for each byte of them.
Defined results: null and empty texts are one window without words, which scores as the output's bias alone;
repeated rows score alike; without labels every score is 0.5; labels, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm._labels import labelled_rows, trained
from docframe.llm._words import hash_spans, lean, mix, slices, text_buffer, word_bounds

WINDOW, STRIDE, DIM, HIDDEN, TABLE_BITS = 64, 48, 12, 10, 15


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Words:
    """The distinct words of some texts: table rows of each word and of its character runs, and the texts as
    indices of distinct words."""

    def __init__(self, column: pa.Array):
        data, offsets = text_buffer(column)
        starts, ends, self.rows = word_bounds(data, offsets)
        hashes, first, self.word_of = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        shift = np.uint64(64 - TABLE_BITS)
        self.word_rows = (mix(hashes) >> shift).astype(np.int64)
        a, b = starts[first], ends[first]
        order = np.argsort(a)
        runs, owner = [], []
        for width in (3, 4):
            n = np.maximum(b - a - width + 1, 1)[order]
            whose = np.repeat(order, n)
            begin = np.repeat(a[order], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            end = np.minimum(begin + width, b[whose])
            mark = (begin == a[whose]).astype(np.uint64) + np.uint64(2) * (end == b[whose]).astype(np.uint64)
            # A run at a word's edge counts once with its mark and once without.
            plain = hash_spans(data, begin, end)
            edge = mark > 0
            runs += [mix(plain), mix(plain[edge] + mark[edge])]
            owner += [whose, whose[edge]]
        whose = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        by_word = np.argsort(whose, kind="stable")
        self.run_rows = (np.concatenate(runs) >> shift).astype(np.int64)[by_word]
        self.run_ends = np.searchsorted(whose[by_word], np.arange(len(hashes) + 1))

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        """The input vector of each distinct word."""
        if not len(self.word_rows):
            return np.zeros((0, DIM), np.float32)
        count = np.diff(self.run_ends).astype(np.float32)
        return p["word"][self.word_rows] + np.add.reduceat(p["char"][self.run_rows], self.run_ends[:-1], axis=0) / count[:, None]


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, number of words) of every window; a text without words has an empty one."""
    size = np.diff(rows)
    n = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(size)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return text, rows[:-1][text] + place * STRIDE, np.minimum(WINDOW, size[text] - place * STRIDE)


def fresh(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {"word": draw(1 << TABLE_BITS, DIM, scale=0.1), "char": draw(1 << TABLE_BITS, DIM, scale=0.1)}
    for side in "fb":
        p |= {f"w{side}": draw(DIM, 3 * HIDDEN, scale=DIM**-0.5), f"u{side}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"attend": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}


def run_side(p: dict, side: str, projected: np.ndarray, steps: int, live: np.ndarray, keep: bool):
    """States (steps, n, HIDDEN) in text order; projected: (steps, n, 3 HIDDEN) inputs to the gates."""
    n, h = projected.shape[1], np.zeros((projected.shape[1], HIDDEN), np.float32)
    states, memory = np.zeros((steps, n, HIDDEN), np.float32), []
    u = p[f"u{side}"]
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        x = projected[t]
        g = h @ u[:, : 2 * HIDDEN]
        z, r = _sigmoid(x[:, :HIDDEN] + g[:, :HIDDEN]), _sigmoid(x[:, HIDDEN : 2 * HIDDEN] + g[:, HIDDEN:])
        c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
        on = live[t][:, None]
        new = h + on * z * (c - h)
        if keep:
            memory.append((t, h, z, r, c))
        h = states[t] = new
    return states, memory


def forward(p: dict, vectors: np.ndarray, index: np.ndarray, size: np.ndarray, keep: bool = False):
    """Logits of windows; index: (n, WINDOW) distinct words, size: words in each."""
    steps = max(int(size.max()) if len(size) else 0, 1)
    live = (np.arange(steps)[:, None] < size[None]).astype(np.float32)
    at = index[:, :steps].T
    sides, memories = [], []
    for side in "fb":
        projected = (vectors @ p[f"w{side}"] + p[f"c{side}"])[at] if len(vectors) else np.zeros((steps, len(size), 3 * HIDDEN), np.float32)
        states, memory = run_side(p, side, projected, steps, live, keep)
        sides.append(states)
        memories.append(memory)
    joint = np.concatenate(sides, 2)
    weight = np.where(live > 0, joint @ p["attend"], -1e9)
    weight = np.exp(weight - weight.max(0)) * live
    weight /= np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * joint).sum(0)
    logit = pooled @ p["out"] + p["bias"][0]
    return logit, (joint, weight, pooled, memories, live, at, steps)


def backward(p: dict, vectors: np.ndarray, kept, slope: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters but the tables, and of the distinct words' vectors."""
    joint, weight, pooled, memories, live, at, steps = kept
    grads = {"out": slope @ pooled, "bias": np.array([slope.sum()], np.float32)}
    d_pooled = slope[:, None] * p["out"]
    d_joint = weight[:, :, None] * d_pooled
    d_weight = (joint * d_pooled).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    grads["attend"] = np.einsum("tn,tnh->h", d_score, joint)
    d_joint += d_score[:, :, None] * p["attend"]
    d_vectors = np.zeros_like(vectors)
    for k, side in enumerate("fb"):
        u = p[f"u{side}"]
        d_u, carried = np.zeros_like(u), np.zeros((joint.shape[1], HIDDEN), np.float32)
        d_in = np.zeros((steps, joint.shape[1], 3 * HIDDEN), np.float32)
        for t, h, z, r, c in reversed(memories[k]):
            d_h = carried + d_joint[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            on = live[t][:, None]
            d_c = d_h * on * z * (1 - c * c)
            d_z = d_h * on * (c - h) * z * (1 - z)
            back = d_c @ u[:, 2 * HIDDEN :].T
            d_r = back * h * r * (1 - r)
            gates = np.concatenate([d_z, d_r], 1)
            d_u[:, : 2 * HIDDEN] += h.T @ gates
            d_u[:, 2 * HIDDEN :] += (r * h).T @ d_c
            carried = d_h * (1 - on * z) + back * r + gates @ u[:, : 2 * HIDDEN].T
            d_in[t] = np.concatenate([gates, d_c], 1)
        flat, words = d_in.reshape(-1, 3 * HIDDEN), at.reshape(-1)
        grads[f"u{side}"], grads[f"c{side}"] = d_u, flat.sum(0)
        summed = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
        order = np.argsort(words, kind="stable")
        which, begin = np.unique(words[order], return_index=True)
        summed[which] = np.add.reduceat(flat[order], begin, axis=0)
        grads[f"w{side}"] = vectors.T @ summed
        d_vectors += summed @ p[f"w{side}"].T
    return grads, d_vectors


class Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, grads: dict) -> None:
        """grads: name -> gradient, or (rows, gradient of those rows)."""
        self.t += 1
        fix = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for name, g in grads.items():
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            m, v = self.m[name], self.v[name]
            m[rows] = 0.9 * m[rows] + 0.1 * g
            v[rows] = 0.999 * v[rows] + 0.001 * g * g
            self.p[name][rows] -= fix * m[rows] / (np.sqrt(v[rows]) + 1e-8)


def _by_row(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    which, begin = np.unique(rows[order], return_index=True)
    return which, np.add.reduceat(grads[order], begin, axis=0)


def score_windows(p: dict, vectors: np.ndarray, word_of: np.ndarray, first: np.ndarray, size: np.ndarray, group: int = 2048) -> np.ndarray:
    out = np.empty(len(first), np.float32)
    order = np.argsort(size, kind="stable")
    for i in range(0, len(first), group):
        part = order[i : i + group]
        out[part] = forward(p, vectors, _index(word_of, first[part]), size[part])[0]
    return out


def _index(word_of: np.ndarray, first: np.ndarray) -> np.ndarray:
    return word_of[np.minimum(first[:, None] + np.arange(WINDOW), max(len(word_of) - 1, 0))] if len(word_of) else np.zeros((len(first), WINDOW), np.int64)


def train(texts: list[str], labels: list[int], rounds: int = 8, steps: int = 50, batch: int = 192, rate: float = 0.01, keep_words: float = 0.5, seed: int = 2) -> dict[str, np.ndarray]:
    """The parameters after rounds x steps Adam steps, a number that does not depend on the data's size."""
    rng = np.random.default_rng(seed)
    p = fresh(seed)
    own, truth = Words(pa.array(texts, pa.string())), np.array(labels)
    text, first, size = windows(own.rows)
    hot = np.flatnonzero(truth[text] == 1)
    clean = np.flatnonzero(truth[text] == 0)
    adam = Adam(p, rate)
    for turn in range(rounds):
        for _ in range(steps):
            pick = np.concatenate([rng.choice(hot, batch // 2), rng.choice(clean, batch // 2)])
            used, at = np.unique(_index(own.word_of, first[pick]), return_inverse=True)
            at = at.reshape(len(pick), WINDOW)
            spans = [np.arange(a, b) for a, b in zip(own.run_ends[used], own.run_ends[used + 1], strict=True)]
            runs = own.run_rows[np.concatenate(spans)]
            count = np.array([len(s) for s in spans])
            share = (1 / count).astype(np.float32)[:, None]
            shown = (rng.random(len(used)) < keep_words).astype(np.float32)[:, None]
            vectors = shown * p["word"][own.word_rows[used]] + np.add.reduceat(p["char"][runs], np.cumsum(count) - count, axis=0) * share
            logit, kept = forward(p, vectors, at, size[pick], keep=True)
            slope = ((_sigmoid(logit) - truth[text[pick]]) / len(pick)).astype(np.float32)
            grads, d_vectors = backward(p, vectors, kept, slope)
            grads["word"] = _by_row(own.word_rows[used], d_vectors * shown)
            grads["char"] = _by_row(runs, np.repeat(d_vectors * share, count, axis=0))
            adam.step(grads)
        if turn + 1 == rounds:
            break
        scores = score_windows(p, own.inputs(p), own.word_of, first, size)
        order = np.lexsort((-scores, text))
        top = order[np.searchsorted(text[order], np.arange(len(texts)))]
        hot = top[truth == 1]
        hard = top[truth == 0]
        drawn = rng.choice(np.flatnonzero(truth[text] == 0), len(hard))
        clean = np.concatenate([hard, drawn])
    return p


def text_logits(column: pa.Array, p: dict[str, np.ndarray]) -> np.ndarray:
    own = Words(column)
    text, first, size = windows(own.rows)
    scores = score_windows(p, own.inputs(p), own.word_of, first, size)
    return np.maximum.reduceat(scores, np.searchsorted(text, np.arange(len(own.rows) - 1))).astype(np.float64)


def score_texts(column: pa.Array, p: dict[str, np.ndarray]) -> np.ndarray:
    return _sigmoid(text_logits(column, p))


def fit(texts: list[str], labels: list[int], share: float = 0.1, least: int = 10, **how) -> dict[str, np.ndarray]:
    """Trained parameters with the bias set on every fifth text, if those hold `least` of each class."""
    aside = np.arange(len(texts)) % 5 == 4
    truth = np.array(labels)
    if min((truth[aside] == v).sum() for v in (0, 1)) < least:
        return train(texts, labels, **how)
    learn = np.flatnonzero(~aside)
    p = train([texts[i] for i in learn], [labels[i] for i in learn], **how)
    held = np.flatnonzero(aside)
    logits, toxic = text_logits(pa.array([texts[i] for i in held], pa.string()), p), truth[held] == 1
    cuts = np.sort(logits)
    cuts = (cuts[1:] + cuts[:-1]) / 2
    missed = (toxic[:, None] & (logits[:, None] < cuts)).sum(0) / toxic.sum()
    wrong = (~toxic[:, None] & (logits[:, None] >= cuts)).sum(0) / (~toxic).sum()
    cost = share * missed + (1 - share) * wrong
    p["bias"] = p["bias"] - np.float32(np.median(cuts[cost == cost.min()]))
    return p


def _packed(texts: list[str], labels: list[int]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **fit(texts, labels))
    return out.getvalue()


def _unpacked(model: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(model)) as arrays:
        return dict(arrays)


class ToxicityModel:
    """Parameters of fixed size (3 MB)."""

    def __init__(self, parameters: dict[str, np.ndarray] | None):
        self.parameters = parameters

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_per_class: int = 2000, most_chars: int = 8_000) -> ToxicityModel:
        model = trained(labelled_rows(docs, labels, label, sample_per_class, most_chars), _packed)
        return cls(None if model is None else _unpacked(model))

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, score of every row."""
        p = self.parameters

        def run(batches):
            for batch in slices(batches, most=1 << 21):
                score = np.full(batch.num_rows, 0.5) if p is None else score_texts(batch.column(1), p)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

        narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        return narrow.mapInArrow(lean(run), "doc_id long, score double")
