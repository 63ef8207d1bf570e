"""Language-model scoring by a weighted backoff automaton over contexts of one and of four words (operator 5).

Counts: every training token, bigram and five-gram of the corpus is counted. Documents are dealt into shards of bounded
size; a shard lists its distinct n-grams with its training counts, cut into ranges of the hash (blocks); a
block sums the counts of all shards and answers each shard in the order in which it asked. So no n-gram table
is ever in one place, nothing is broadcast, and what moves grows with the corpus.

Model: p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), p(w | h) = (c(h w) + m p(w)) / (c(h) + m) after the word h, and
p(w | g) = (c(g w) + k p(w | h)) / (c(g) + k) after four words g of which h is the last. For n-grams never seen these
are m / (c(h) + m) times p(w) and k / (c(g) + k) times p(w | h), which are exactly failure arcs' weights: the automaton
has a state for each known word, for the beginning and for each known context of four words, arcs for seen n-grams, and
failure arcs from a context to its last word and from a word to the root, where each word has an arc. A shard builds the
part of the automaton that its texts need, and all its texts traverse it left to right in strides, carrying their state
from one to the next and summing log10 probabilities. A text's beginning has contexts of one word only.

Words are told apart by 64 bits of hash, pairs and contexts by 40 (by more where the corpus has more than 2**32 bytes:
eight more than its size has, up to 48), the word after a context by 15. Defined results: null and empty texts are the
one token end; tokens never seen in training have count 0; without any training text every score of an unknown token is
log10(1) = 0; repeated rows are separate texts; texts of any length are read whole (a shard holds some megabytes of
texts, or one longer text, at some 300 bytes of memory for each word).
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm._io import cut, fold_of
from docframe.llm._words import mix, words

END = np.uint64(0x45D9F3B1A2C47E65)
START = np.uint64(0x1B873593CC9E2D51)
LONG, STRIDE, _NEXT = 4, 256, np.uint64(15)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and each key's place among them."""
    order = np.argsort(keys, kind="stable").astype(np.int32)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], place


class ShardTokens:
    """Token hashes of a shard's texts, each text's words and then END, with their distinct n-grams in order. bits: of
    the hashes of pairs and contexts."""

    def __init__(self, column: pa.ChunkedArray, train: np.ndarray, bits: int = 40):
        cut = np.uint64(64 - bits)
        hashes, rows = words(column)
        n = len(rows) - 1
        self.rows = rows + np.arange(n + 1)
        tokens = np.empty(len(hashes) + n, np.uint64)
        last = self.rows[1:] - 1
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = hashes
        tokens[last] = END
        size = np.diff(self.rows)
        self.train = np.repeat(train, size)
        self.words, self.word_of = _distinct(tokens)
        before = np.empty(len(tokens), np.uint64)
        before[1:] = tokens[:-1]
        before[self.rows[:-1]] = START
        self.pairs, self.pair_of = _distinct(mix(before * np.uint64(0x9DDFEA08EB382D69) + (tokens ^ (tokens >> np.uint64(29)))) >> cut)
        del before
        # Positions that have a context of four words, and the n-gram there: the context's hash, then some bits of the word.
        at = np.arange(len(tokens)) - np.repeat(self.rows[:-1], size)
        self.deep = np.flatnonzero(at >= LONG)
        context = np.zeros(len(self.deep), np.uint64)
        for k in range(LONG, 0, -1):
            context = mix(context * np.uint64(3) + tokens[self.deep - k])
        follows = mix(tokens[self.deep] + np.uint64(0x51ED27)) >> (np.uint64(64) - _NEXT)
        self.longs, self.long_of = _distinct(((context >> cut) << _NEXT) | follows)
        parts = self.longs >> _NEXT
        opens = np.ones(len(parts), bool)
        opens[1:] = parts[1:] != parts[:-1]
        self.contexts, self.context_of_long = parts[opens], np.cumsum(opens) - 1

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        learned = self.train[self.deep]
        return (
            np.bincount(self.word_of[self.train], minlength=len(self.words)), np.bincount(self.pair_of[self.train], minlength=len(self.pairs)),
            np.bincount(self.long_of[learned], minlength=len(self.longs)),
        )


def _blocks(keys: np.ndarray, bits: int, blocks: int) -> np.ndarray:
    """Where each of `blocks` equal ranges of the key space begins in sorted keys, and the end."""
    edges = [(i << bits) // blocks for i in range(blocks)]
    return np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys))


def _small(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes as almost all need; larger ones are marked and follow in eight bytes each.
    The first byte is the width, the next four the number of values."""
    values = np.asarray(values).astype(np.uint64)
    n, width = len(values), 8
    for w in (1, 2, 3, 4, 5, 6):
        if n < 4 or np.count_nonzero(values >= (1 << (8 * w)) - 1) * 64 <= n:
            width = w
            break
    mark = np.uint64((1 << (8 * width)) - 1)
    large = values >= mark
    shown = np.where(large, mark, values).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    return bytes([width]) + struct.pack("<I", n) + shown.tobytes() + values[large].astype("<u8").tobytes()


def _large(blob: bytes) -> np.ndarray:
    width, n = blob[0], struct.unpack_from("<I", blob, 1)[0]
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8, n * width, 5).reshape(n, width)
    out = wide.view("<u8").reshape(n).astype(np.uint64)
    rest = np.frombuffer(blob, "<u8", offset=5 + n * width)
    out[out == np.uint64((1 << (8 * width)) - 1)] = rest
    return out


def _counts(values: np.ndarray) -> bytes:
    """Counts, most of them small, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(_small(values))


def _counted(blob: bytes) -> np.ndarray:
    return _large(zstandard.ZstdDecompressor().decompress(blob))


def _deltas(keys: np.ndarray) -> bytes:
    return _small(np.diff(keys, prepend=np.uint64(0)))


def _keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_large(blob), dtype=np.uint64)


ASK = "block int, shard int, words binary, word_counts binary, pairs binary, pair_counts binary, contexts binary, longs binary, long_counts binary"
ANSWER = "shard int, block int, word_counts binary, pair_counts binary, context_counts binary, long_counts binary, tokens long, known long"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.Table.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def _pressed(rows: DataFrame) -> DataFrame:
    """rows (doc_id, train, shard, text) with each text compressed, as all texts move once."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = pa.array([press.compress(t.encode()) for t in batch.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], texts], ["doc_id", "train", "shard", "text"])

    return rows.select("doc_id", "train", "shard", "text").mapInArrow(run, "doc_id long, train boolean, shard int, text binary")


def _texts(column: pa.ChunkedArray) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(t) for t in column.to_pylist()], pa.large_binary())


def _ask(blocks: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        own = ShardTokens(_texts(table.column("text")), np.asarray(table.column("train")).astype(bool), bits)
        word_counts, pair_counts, long_counts = own.counts()
        w, p, c = _blocks(own.words, 64, blocks), _blocks(own.pairs, bits, blocks), _blocks(own.contexts, bits, blocks)
        g = np.searchsorted(own.context_of_long, c)
        # Of an n-gram the bits of its word go, and one that tells whether its context is the one before.
        opens = np.diff(own.context_of_long, prepend=-1).astype(np.uint64)
        longs = (own.longs & np.uint64((1 << int(_NEXT)) - 1)) | (opens << _NEXT)
        out = [
            (
                b, shard, _deltas(own.words[w[b] : w[b + 1]]), _counts(word_counts[w[b] : w[b + 1]]), _deltas(own.pairs[p[b] : p[b + 1]]), _counts(pair_counts[p[b] : p[b + 1]]),
                _deltas(own.contexts[c[b] : c[b + 1]]), longs[g[b] : g[b + 1]].astype("<u2").tobytes(), _counts(long_counts[g[b] : g[b + 1]]),
            )
            for b in range(blocks)
        ]
        return _table(out, ASK)

    return run


def _summed(lists: list[np.ndarray], counts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Each list's keys' counts over all lists, in its order, and the counts of all distinct keys."""
    _, place = np.unique(np.concatenate(lists), return_inverse=True)
    sums = np.bincount(place, weights=np.concatenate([_counted(x) for x in counts])).astype(np.int64)
    return np.split(sums[place], np.cumsum([len(x) for x in lists])[:-1]), sums


def _answer(table: pa.Table) -> pa.Table:
    shards, block = table.column("shard").to_pylist(), table.column("block")[0].as_py()
    of = lambda name: table.column(name).to_pylist()
    word_lists, word_sums = _summed([_keys(x) for x in of("words")], of("word_counts"))
    pair_lists, _ = _summed([_keys(x) for x in of("pairs")], of("pair_counts"))
    longs, contexts, ends = [], [], []
    for known, part in zip(of("contexts"), of("longs"), strict=True):
        keys, own = _keys(known), np.frombuffer(part, "<u2").astype(np.uint64)
        opens = own >> _NEXT
        place = np.cumsum(opens).astype(np.int64) - 1
        longs.append((keys[place] << _NEXT) | (own & np.uint64((1 << int(_NEXT)) - 1)))
        ends.append(np.flatnonzero(opens))
        contexts.append(keys)
    long_lists, _ = _summed(longs, of("long_counts"))
    # A context's count is the sum of its n-grams' in all shards.
    every = np.concatenate(longs)
    counts = np.concatenate([_counted(x) for x in of("long_counts")]).astype(np.int64)
    _, place = np.unique(every >> _NEXT, return_inverse=True)
    totals = np.bincount(place, weights=counts).astype(np.int64)
    starts = np.cumsum([0, *[len(x) for x in longs]])
    context_lists = [totals[place[start + e]] for start, e in zip(starts[:-1], ends, strict=True)]
    first = [i == 0 for i in range(len(shards))]
    rows = [
        (s, block, _counts(w), _counts(p), _counts(c), _counts(g), int(word_sums.sum()) * f, int((word_sums > 0).sum()) * f)
        for s, w, p, c, g, f in zip(shards, word_lists, pair_lists, context_lists, long_lists, first, strict=True)
    ]
    return _table(rows, ANSWER)


class BackoffAutomaton:
    """States: 0 is the root, 1 + i the word i as context, n + 1 the beginning of a text, then the contexts of four words.
    Arcs lie sorted by state and word; a long context's failure arc leads to its last word, any other to the root."""

    def __init__(self, word_counts: np.ndarray, total: int, known: int, starts: int, prior: float):
        n = len(word_counts)
        self.n, self.start, self.prior = n, n + 1, prior
        unigram = (word_counts + 0.5) / (total + 0.5 * (known + 1))
        self.root, self.unigram = np.log10(unigram), unigram
        self.context = np.concatenate([[0], word_counts, [starts]]).astype(float)
        self.failure = np.log10(prior / (self.context + prior))
        self.back = np.zeros(n + 2, np.int64)
        self.target = np.where(word_counts > 0, np.arange(1, n + 1), 0)
        self.keys, self.weight = np.zeros(0, np.int64), np.zeros(0)

    def _arcs(self, state: np.ndarray, word: np.ndarray, weight: np.ndarray) -> None:
        keys = np.concatenate([self.keys, state.astype(np.int64) * self.n + word])
        order = np.argsort(keys, kind="stable")
        self.keys, self.weight = keys[order], np.concatenate([self.weight, weight])[order]

    def add_pairs(self, state: np.ndarray, word: np.ndarray, count: np.ndarray) -> None:
        """Arcs of pairs seen in training, from states of one word."""
        self._arcs(state, word, np.log10((count + self.prior * self.unigram[word]) / (self.context[state] + self.prior)))

    def add_contexts(self, counts: np.ndarray, last: np.ndarray, context: np.ndarray, word: np.ndarray, count: np.ndarray, prior: float) -> np.ndarray:
        """States of contexts of four words with their counts and last words, and arcs of what was seen after them
        (context: index into counts); returns each context's state, 0 for one that was never seen."""
        seen = counts > 0
        state = np.where(seen, self.start + np.cumsum(seen), 0)
        self.failure = np.append(self.failure, np.log10(prior / (counts[seen] + prior)))
        self.back = np.append(self.back, last[seen] + 1)
        lower = 10 ** self.step(last[context] + 1, word)
        self._arcs(state[context], word, np.log10((count + prior * lower) / (counts[context] + prior)))
        return state

    def _found(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = state.astype(np.int64) * self.n + word
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (self.keys[place] == wanted) & (state > 0), self.weight[place]

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The weight of each state's arc for its word, over as many failure arcs as it takes."""
        if not len(self.keys):
            return self.failure[state] + self.root[word]
        hit, weight = self._found(state, word)
        weight = np.where(hit, weight, self.failure[state])
        fell = np.flatnonzero(~hit)
        if len(fell):
            lower, said = self.back[state[fell]], word[fell]
            long = lower > 0
            hit, more = self._found(lower[long], said[long])
            at = fell[long]
            weight[at] += np.where(hit, more, self.failure[lower[long]] + self.root[said[long]])
            weight[fell[~long]] += self.root[said[~long]]
        return weight

    def traverse(self, word_of: np.ndarray, rows: np.ndarray, entered: np.ndarray) -> np.ndarray:
        """The summed log10 probability of each text, all texts going left to right in strides of STRIDE tokens, each from
        the state in which its last stride ended. entered: the state of four words that a text is in before each of its
        tokens, 0 where it is in that of one word."""
        size = np.diff(rows)
        order = np.argsort(-size, kind="stable")
        longest_first, at = size[order], rows[:-1][order]
        state = np.full(len(order), self.start)
        score = np.zeros(len(order))
        for t in range(0, int(longest_first[0]) if len(order) else 0, STRIDE):
            live = int(np.searchsorted(-longest_first, -t, side="left"))
            n = np.minimum(longest_first[:live] - t, STRIDE)
            begin = np.cumsum(n) - n
            here = np.repeat(at[:live] + t - begin, n) + np.arange(n.sum())
            said = word_of[here]
            now = np.empty(len(said), np.int64)
            now[1:] = self.target[said[:-1]]
            now[begin] = state[:live]
            deep = entered[here]
            now = np.where(deep > 0, deep, now)
            score[:live] += np.add.reduceat(self.step(now, said), begin)
            state[:live] = self.target[said[begin + n - 1]]
        out = np.empty(len(order))
        out[order] = score
        return out


def _score(total: int, known: int, prior: float, long_prior: float, bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        own = ShardTokens(_texts(docs.column("text")), np.asarray(docs.column("train")).astype(bool), bits)
        order = np.argsort(np.asarray(answers.column("block")))
        of = lambda c: np.concatenate([_counted(answers.column(c)[int(i)].as_py()) for i in order]).astype(np.int64)
        word_counts, pair_counts, context_counts, long_counts = map(of, ("word_counts", "pair_counts", "context_counts", "long_counts"))
        first = np.zeros(len(own.word_of), bool)
        first[own.rows[:-1]] = True
        end = int(np.searchsorted(own.words, END))
        machine = BackoffAutomaton(word_counts, total, known, int(word_counts[end]), prior)
        place = np.zeros(len(own.pairs), np.int64)
        place[own.pair_of] = np.arange(len(own.pair_of))
        seen = place[pair_counts > 0]
        machine.add_pairs(np.where(first[seen], machine.start, own.word_of[seen - 1] + 1), own.word_of[seen], pair_counts[pair_counts > 0])
        place = np.zeros(len(own.longs), np.int64)
        place[own.long_of] = own.deep
        last = np.zeros(len(own.contexts), np.int64)
        last[own.context_of_long] = own.word_of[place - 1] if len(place) else 0
        hit = long_counts > 0
        state = machine.add_contexts(context_counts, last, own.context_of_long[hit], own.word_of[place[hit]], long_counts[hit], long_prior)
        entered = np.zeros(len(own.word_of), np.int64)
        entered[own.deep] = state[own.context_of_long[own.long_of]]
        score = machine.traverse(own.word_of, own.rows, entered)
        sums = lambda v: np.add.reduceat(v, own.rows[:-1])
        base = sums(machine.root[own.word_of])
        n = docs.num_rows
        columns = [
            docs.column("doc_id"), pa.array(~np.asarray(docs.column("train")).astype(bool)), pa.array(np.diff(own.rows), pa.int64()),
            pa.array(sums((word_counts[own.word_of] > 0).astype(np.int64)), pa.int64()), pa.array(np.full(n, total), pa.int64()), pa.array(base), pa.array(score),
        ]
        return pa.Table.from_arrays(columns, [x.split()[0] for x in RESULT.split(", ")])

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_fold: int = 1, folds: int = 5, shard_bytes: int = 1 << 22, block_bytes: int = 1 << 25, prior: float = 30.0, long_prior: float = 0.5) -> DataFrame:
    """Scores of every row of docs under the model learned from the rows outside fold held_fold."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards, blocks, bits = max(math.ceil(size / shard_bytes), least), max(math.ceil(size / block_bytes), least), min(48, max(40, size.bit_length() + 8))
    dealt = texts.withColumn("train", fold_of(F.col("doc_id"), folds) != held_fold)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    dealt = _pressed(dealt)
    asked = dealt.groupBy("shard").applyInArrow(_ask(blocks, bits), ASK)
    answers = cut(asked.groupBy("block").applyInArrow(_answer, ANSWER), "ngram-counts")
    total, known = answers.agg(F.sum("tokens"), F.sum("known")).first()
    met = dealt.groupBy("shard").cogroup(answers.drop("tokens", "known").groupBy("shard"))
    return met.applyInArrow(_score(total or 0, known or 0, prior, long_prior, bits), RESULT)
