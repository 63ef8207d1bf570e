"""Near-duplicates by one-permutation hashing with optimal densification (operator 6).

A document's set of word shingles is hashed once; the top 7 bits of a hash are its bin, and a bin keeps its
smallest hash. An empty bin borrows from the first bin that is not empty in an order of its own, the same
for all documents, so every bin agrees with probability equal to the Jaccard likeness. 32 bands of 4 bins
are the buckets: two sets of likeness 0.8 share a bucket with probability 1 - 5e-8.

Every row has a random number of its own (uid), given when its sketch is written, so rows are told apart whatever
their doc_ids are. Rows with equal sets are one class and only its first row goes on. In every bucket the member
with the most company in all its buckets is the centre and is paired with every other whose size allows it:
star-shaped candidates, a number linear in the bucket. A pair is a link if it passes on the full sets. Links are
contracted to components by minima of uids, a bounded number of rows per node and round.

Buckets of three or more whose members are then in several components are closed: every pair of such a bucket
that lies across components is compared, in blocks, by parity bitmaps of the sets; the members of its largest
component, which may be nearly all, meet the others only. Bitmaps of sets that differ in d
shingles differ in at most d bits, so a pair that differs in more bits than the likeness allows cannot pass, and
all other pairs are tested on the full sets. So two documents of one bucket that pass are always joined.

Defined results: documents without words (null and empty texts) have n_shingles 0, are linked with nothing and
have their own doc_id as component_id; a null doc_id counts as smaller than any; rows that repeat a doc_id are
linked only if their texts are; an empty table gives an empty result. Texts are hashed a few megabytes at a time
(or one longer text alone): memory is some 60 bytes for each byte of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm._io import attach, cut, with_group_stats
from docframe.llm._words import lean, mix, slices, words

BINS, ROWS, BLOCK = 128, 4, 1024
NULL_ID = -(1 << 63)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
#: For each bin, the order in which it looks for a bin to borrow from.
_BORROW = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(977)).reshape(BINS, BINS), axis=1)


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and the rows' offsets in them. A row with
    fewer than `width` words has its whole sequence as one shingle."""
    hashes, rows = words(column)
    count = np.diff(rows)
    total = len(hashes)
    doc = np.repeat(np.arange(len(count)), count)
    left = rows[1:][doc] - np.arange(total)
    out = np.zeros(total, np.uint64)
    for k in range(width):
        out[: total - k] += np.where(left[: total - k] > k, hashes[k:] * _PLACE[k], np.uint64(0))
    place = np.arange(total) - rows[:-1][doc]
    keep = (left >= width) | ((place == 0) & (count[doc] < width))
    short = np.minimum(count, width).astype(np.uint64)[doc]
    out, doc = mix(out[keep] + short[keep]), doc[keep]
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(count) + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """BINS minima per row; rows without shingles are all _NONE."""
    n = len(offsets) - 1
    out = np.full((n, BINS), _NONE)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    cell = doc * BINS + (hashes >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    out.reshape(-1)[cell[first]] = hashes[first]
    filled = out != _NONE
    thin = np.flatnonzero(filled.any(1) & ~filled.all(1))
    for i in range(0, len(thin), 1024):
        part = thin[i : i + 1024]
        lender = np.take_along_axis(_BORROW[None], filled[part][:, _BORROW].argmax(2)[:, :, None], 2)[:, :, 0]
        borrowed = np.take_along_axis(out[part], lender, 1)
        out[part] = np.where(filled[part], out[part], borrowed)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    bands = signature.reshape(len(signature), BINS // ROWS, ROWS)
    return mix((bands * _PLACE[:ROWS]).sum(2, dtype=np.uint64) + mix(np.arange(BINS // ROWS, dtype=np.uint64) + np.uint64(51)))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _narrow(docs: DataFrame) -> DataFrame:
    """doc_id (null as the smallest long), th (64 bits of the text: two texts of one doc_id differ in it), text."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), _text_hash(text).alias("th"), text.alias("text"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """uid, doc_id, th, n_shingles, the set's 128-bit digest (hi, lo) and its band keys, for every row."""

    def run(batches):
        context = TaskContext.get()
        begin = (context.partitionId() if context else 0) << 33
        for batch in slices(batches):
            hashes, offsets = shingles(batch.column(2), width)
            keys = band_keys(signatures(hashes, offsets))
            size = np.diff(offsets)
            some = keys[size > 0].view(np.int64).reshape(-1)
            ends = np.concatenate([[0], np.cumsum(np.where(size > 0, keys.shape[1], 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(some))
            digests = [pa.array(_sums(mix(hashes ^ np.uint64(seed)), offsets).view(np.int64)) for seed in (5, 6)]
            uid = mix(np.arange(begin, begin + len(size), dtype=np.uint64)).view(np.int64)
            begin += len(size)
            yield pa.RecordBatch.from_arrays([pa.array(uid), batch.column(0), batch.column(1), pa.array(size, pa.int64()), *digests, lists], ["uid", "doc_id", "th", "n_shingles", "hi", "lo", "bands"])

    return _narrow(docs).mapInArrow(lean(run), "uid long, doc_id long, th long, n_shingles long, hi long, lo long, bands array<long>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """uid and its sorted shingle hashes, of rows (uid, text)."""

    def run(batches):
        for batch in slices(batches):
            hashes, offsets = shingles(batch.column(1), width)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["uid", "items"])

    return texts.select("uid", "text").mapInArrow(lean(run), "uid long, items array<long>")


def _star(buckets: DataFrame, centre: Column, percent: int) -> DataFrame:
    """(a, b), a < b: each member of a bucket with the bucket's centre, where their sizes let the pair pass."""
    met = with_group_stats(buckets, "bucket", F.col("uid"), centre.alias("_c"))
    small, large = F.least("n", "_c.n"), F.greatest("n", "_c.n")
    pairs = met.where((F.col("uid") != F.col("_c.uid")) & (100 * small >= percent * large)).select("uid", F.col("_c.uid").alias("_c"))
    return pairs.select(F.least("uid", "_c").alias("a"), F.greatest("uid", "_c").alias("b")).distinct()


def _most_company(buckets: DataFrame) -> DataFrame:
    """buckets with _rank: how many members a document's buckets have in all, then a hash against ties. A text
    from which many others were made has their common bins, so it comes first among them."""
    company = buckets.groupBy("uid").agg(F.sum("_n").alias("_w"))
    tie = F.col("uid").bitwiseAND(F.lit((1 << 20) - 1))
    return buckets.join(company, "uid").withColumn("_rank", F.shiftleft(F.col("_w"), 20).bitwiseOR(tie)).drop("_w")


def sets_of(ids: DataFrame, firsts: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """uid and shingle hashes of the rows in ids; only their texts are hashed again. Rows that repeat doc_id and
    text fall to one where they meet the ids, in the order in which the join leaves them: a sort of whole texts before
    they move took more memory than all else."""
    wanted = firsts.select("uid", "doc_id", "th").join(ids, "uid", "left_semi")
    texts = _narrow(docs).join(wanted.hint("merge"), ["doc_id", "th"]).groupBy("doc_id", "th").agg(F.first("uid").alias("uid"), F.first("text").alias("text"))
    return cut(full_sets(texts, width), "shingle-sets")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets pass 100 x intersection >= percent x union. A document in many pairs meets them
    in 64 places."""
    left = sets.select(F.col("uid").alias("a"), F.col("items").alias("_x"))
    right = sets.select(F.col("uid").alias("b"), F.col("items").alias("_y"))
    met = attach(attach(pairs, "a", left, F.col("b")), "b", right, F.col("a"))
    both = F.size(F.array_intersect("_x", "_y"))
    return met.where(100 * both >= percent * (F.size("_x") + F.size("_y") - both)).select("a", "b")


def bitmap(items: np.ndarray) -> np.ndarray:
    """Parities of how many of a set's hashes fall on each of 64 to 65,536 bits, four or more a hash up to that."""
    bits = min(max(6, (4 * len(items) - 1).bit_length()), 16)
    odd = np.bincount((items >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _folded(maps: np.ndarray) -> np.ndarray:
    """The bitmaps with half the bits: the parities of neighbouring bits together."""
    bits = np.unpackbits(maps.view(np.uint8), axis=1)
    return np.packbits(bits[:, ::2] ^ bits[:, 1::2], axis=1).view(np.uint64)


def bitmaps(sets: DataFrame) -> DataFrame:
    """uid and its set's bitmap."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            values, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            maps = [bitmap(values[ends[i] : ends[i + 1]]).tobytes() for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.binary())], ["uid", "bits"])

    return sets.mapInArrow(lean(run), "uid long, bits binary")


def _near(label: np.ndarray, side: np.ndarray, n: np.ndarray, maps: list[bytes], percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of one cell across labels (and sides, where it has two) that their sizes and
    bitmaps let pass."""
    size = np.array([len(m) for m in maps])
    two, found = side.min() != side.max(), []
    stacked = {w: (rows := np.flatnonzero(size == w), np.frombuffer(b"".join(maps[i] for i in rows), np.uint64).reshape(len(rows), -1)) for w in np.unique(size)}
    for w, (rows, own) in stacked.items():
        for v, (others, theirs) in stacked.items():
            if v < w:
                continue
            # Larger sets may still be like enough however many times the bitmap doubles.
            fits = 100 * n[rows].max() >= percent * n[others].min()
            if not fits:
                continue
            while theirs.shape[1] > own.shape[1]:
                theirs = _folded(theirs)
            for k, i in enumerate(rows):
                first = k + 1 if v == w else 0
                to = others[first:]
                apart = np.bitwise_count(theirs[first:] ^ own[k]).sum(1, dtype=np.int64)
                ok = (label[to] != label[i]) & ((100 + percent) * apart <= (100 - percent) * (n[to] + n[i]))
                ok &= 100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i])
                if two:
                    ok &= side[to] != side[i]
                if ok.any():
                    found.append((np.full(ok.sum(), i), to[ok]))
    return found


def across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: the pairs of a bucket across components that may pass, of members (bucket, uid, label, n, bits, _top,
    _g, _all, _k: the bucket's largest component, its members, all members, components).

    The largest component's members and the others are dealt into blocks of about BLOCK each; a cell of two blocks, one
    of them of the others, is one task's work. So no task meets more than two blocks of a bucket at once, a member of a
    large component meets the others only, and only pairs that may pass become rows."""
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    dealt = members.withColumn("_a", blocks(F.col("_g"))).withColumn("_b", blocks(F.col("_all") - F.col("_g"))).withColumn("_big", F.col("label") == F.col("_top"))
    own = F.pmod(F.xxhash64("uid"), F.when(F.col("_big"), F.col("_a")).otherwise(F.col("_b"))).cast("int")
    dealt = dealt.withColumn("_i", own)
    cell = lambda kind, i, j, side: F.struct(F.xxhash64("bucket", F.lit(kind), i, j).alias("cell"), side.cast("int").alias("side"))
    places = lambda n, f: F.transform(F.sequence(F.lit(0), n - 1), f)
    mine, among = F.col("_i"), F.col("_k") > 2
    others = F.concat(
        places(F.col("_a"), lambda i: cell(0, i, mine, F.lit(1))),
        F.when(among, places(F.col("_b"), lambda j: cell(1, F.least(mine, j), F.greatest(mine, j), mine))).otherwise(F.array().cast("array<struct<cell:bigint,side:int>>")),
    )
    met = F.when(F.col("_big"), places(F.col("_b"), lambda j: cell(0, mine, j, F.lit(0)))).otherwise(others)
    rows = dealt.withColumn("_c", F.explode(met)).select("_c.cell", "_c.side", "uid", "label", "n", "bits")

    def pairs(whole: pa.Table):
        ids, label, side, n = (whole.column(c).to_numpy() for c in ("uid", "label", "side", "n"))
        maps, cells = whole.column("bits").to_pylist(), whole.column("cell").to_numpy()
        starts = np.r_[0, np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells)]
        for lo, hi in zip(starts[:-1], starts[1:]):
            for x, y in _near(label[lo:hi], side[lo:hi], n[lo:hi], maps[lo:hi], percent) if hi - lo > 1 else ():
                a, b = ids[lo:hi][x], ids[lo:hi][y]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held = []
        for batch in batches:
            if not len(batch):
                continue
            cells = batch.column(0).to_numpy()
            last = int(np.searchsorted(cells, cells[-1]))
            if held and (last or held[-1].column(0)[-1].as_py() != cells[-1]):
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif last:
                yield from pairs(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(lean(run), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of links (a, b), whose numbers are random longs: equal labels where a path joins them.

    Each round every node points to its smallest neighbour or itself, and the links between what is pointed to
    go to the next round, in which fewer nodes are left. Each round's pointers are kept and followed from the last
    round to the first."""
    edges, rounds = cut(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "links"), []
    while not rounds or not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        points = cut(ends.groupBy("u").agg(F.least("u", F.min("v")).alias("to")), "pointers")
        rounds.append(points)
        u, v = points.select("u", F.col("to").alias("x")), points.select(F.col("u").alias("v"), F.col("to").alias("y"))
        moved = attach(attach(edges, "u", u, F.col("v")), "v", v, F.col("x"))
        edges = cut(moved.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).where("u != v").distinct(), "links")
    labels = rounds.pop().select(F.col("u").alias("node"), F.col("to").alias("label"))
    for points in reversed(rounds):
        step = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        labels = attach(points.select(F.col("u").alias("node"), F.col("to").alias("label")), "label", step, F.col("node"))
        labels = cut(labels.select("node", F.coalesce("_next", "label").alias("label")), "labels")
    return labels


def _label(rows: DataFrame, key: str, labels: DataFrame, name: str, member: Column) -> DataFrame:
    """rows with the label of the node in key, or the node itself where no link has it."""
    named = labels.select(F.col("node").alias(key), F.col("label").alias("_l"))
    return attach(rows, key, named, member).withColumn(name, F.coalesce("_l", key)).drop("_l")


def near_rows(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """uid, doc_id (null as the smallest long), th, n_shingles, component_id, first_uid (the component's row with the
    smallest doc_id) for every row of docs."""
    sketch = cut(sketches(docs, width), "sketches")
    by_set = sketch.where("n_shingles > 0").withColumn("_set", F.struct("hi", "lo"))
    members = with_group_stats(by_set, "_set", F.col("uid"), F.min(F.struct("doc_id", "uid")).alias("_first"))
    bands = F.when(F.col("uid") == F.col("_first.uid"), F.col("bands")).alias("bands")
    members = cut(members.select("uid", "doc_id", "th", "n_shingles", F.col("_first.uid").alias("class"), bands), "classes")
    firsts = members.where("uid = class")
    rows = firsts.select("uid", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = cut(with_group_stats(rows, "bucket", F.col("uid"), F.count("*").alias("_n"), where=F.col("_n") > 1), "buckets")
    tested = cut(_star(_most_company(shared), F.max_by(F.struct("uid", "n"), "_rank"), percent), "pairs")
    sets = sets_of(shared.select("uid").distinct(), firsts, docs, width)
    links = cut(verify(tested, sets, percent), "near-links")
    labels = components(links)
    placed = shared.where("_n > 2").join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    held = placed.groupBy("bucket", "label").agg(F.count("*").alias("_c"))
    open_ = held.groupBy("bucket").agg(F.max_by("label", "_c").alias("_top"), F.max("_c").alias("_g"), F.sum("_c").alias("_all"), F.count("*").alias("_k")).where("_k > 1")
    members_of_open = attach(placed.select("bucket", "uid", "n", "label"), "bucket", open_, F.col("uid")).where("_top IS NOT NULL")
    maybe = across(members_of_open.join(bitmaps(sets), "uid"), percent)
    more = cut(maybe.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        found = _label(_label(verify(more, sets, percent), "a", labels, "_x", F.col("b")), "b", labels, "_y", F.col("a"))
        between = cut(found.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).distinct(), "near-links")
        if not between.isEmpty():
            joined = components(between)
            linked = labels.unionByName(joined.select("node", F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
            labels = cut(_label(linked, "label", joined, "_to", F.col("node")).select("node", F.col("_to").alias("label")), "labels")
    placed = _label(members.drop("bands"), "class", labels, "label", F.col("uid"))
    least = with_group_stats(placed, "label", F.col("uid"), F.min(F.struct("doc_id", "uid")).alias("_least"))
    out = least.select("uid", "doc_id", "th", "n_shingles", F.col("_least.doc_id").alias("component_id"), F.col("_least.uid").alias("first_uid"))
    alone = sketch.where("n_shingles = 0").select("uid", "doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.col("uid").alias("first_uid"))
    return out.unionByName(alone)


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) for every row of docs."""
    own = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c)).alias(c)
    return near_rows(docs, width, percent).select(own("doc_id"), "n_shingles", own("component_id"))


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each group the row with the smallest doc_id (null first), all columns as they are. Rows that repeat doc_id
    and text fall to one of them; other rows that repeat a doc_id or have none go only as near copies."""
    kept = near_rows(docs, width, percent).where("uid = first_uid").select("doc_id", "th").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = whole.select(F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), _text_hash(F.col("row.text").cast("string")).alias("th"), "row")
    return named.join(kept.hint("merge"), ["doc_id", "th"], "left_semi").groupBy("doc_id", "th").agg(F.first("row").alias("row")).select("row.*")
