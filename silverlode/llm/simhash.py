"""SimHash near-duplicates: fingerprints of word shingles, candidates by pigeonring chains, groups by links.

A fingerprint of W 64-bit words has a bit set where over half of the document's shingle hashes have it set.  Two
fingerprints are linked if they differ in at most ``budget`` bits.

Pigeonring filter: cut the bits into m segments on a ring.  If two fingerprints differ in at most ``budget`` bits, then
from some segment on every chain of l consecutive segments has at most l * budget / m differences.  The first segment of
such a chain is equal (for budget < m), and the next ones are nearly so; that gives exact lookup keys:

``ring_keys``   one word, budget 3, m = 5: segment i is equal and segments i+1, i+2 differ in one bit at most.  Cut the
                latter two into four quarters: three of them are equal.  5 chains x 4 dropped quarters = 20 keys of about
                33 bits; every linked pair shares one (no link is lost).
``sampled_keys``  wide fingerprints with many allowed differences have no equal segment for certain.  Keys are sets of
                ``bits`` positions of a fixed permutation; a pair whose bits differ at rate r shares one with
                probability 1 - (1 - (1 - r) ** bits) ** keys.

Rows of a key are compared in sorted blocks: first along ring chains of words, then in full.  Keys of more than BLOCK
rows are dealt out as pairs of blocks, so that no task holds a whole hot key.  A block's linked rows are reported as a
star, not as pairs.

``near_duplicates`` takes fingerprints only as a search for candidates and decides each by its shingle sets.

Results: texts of any length are read whole; null text and text without words have fingerprint zero, linked like any other; equal texts have equal
fingerprints and are one node; repeated rows return as often as they came; an empty table gives an empty table.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import per_slice, record_batch, texts_of
from silverlode.llm.graph import components
from silverlode.session import materialize, release

SEED = 42
#: Rows of one key that are compared at once.
BLOCK = 2048
#: Odd constants of the splitmix64 mixer, by which further words of a wide fingerprint come from one hash (fixed values).
STEP, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``shingle`` words, or of all words if there are fewer; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - shingle])).tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, (ends[shingle - 1 :] - 1).tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The 64-bit word whose bits are set in over half of ``hashes``."""
    lanes = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    whole = len(hashes) // 255 * 255  # a byte counts up to 255 rows
    parts = [lanes[:whole].reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64), lanes[whole:].sum(axis=0, dtype=np.uint64, keepdims=True)]
    counts = np.concatenate(parts).view(np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    if not word:
        return h
    with np.errstate(over="ignore"):
        x = h + np.uint64(STEP * word & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
        return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None, shingle: int = 3, words: int = 1) -> list[int]:
    hashes = shingle_hashes(text, shingle)
    return [majority(_mixed(hashes, w)) for w in range(words)] if len(hashes) else [0] * words


def names(words: int) -> list[str]:
    return [f"f{w}" for w in range(words)]


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the fingerprint's words f0, f1, ... as signed longs."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.LongType()) for n in names(words)]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = np.array([fingerprint(t, shingle, words) for t in texts_of(batch, "text")], np.uint64).reshape(-1, words)
        return record_batch(schema, [batch.column(0), *[np.ascontiguousarray(marks[:, w]).view(np.int64) for w in range(words)]])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(per_slice("text", work), schema)


def ring_keys(budget: int = 3) -> list[list[int]]:
    """Bit masks of the exact keys of one 64-bit word; see the module's text."""
    if not 0 <= budget <= 3:
        raise ValueError("exact keys hold for a budget of at most 3 bits")
    widths, starts = [13, 13, 13, 13, 12], [0, 13, 26, 39, 52]
    bits = [list(range(s, s + w)) for s, w in zip(starts, widths)]
    masks = []
    for i in range(5):
        one, two = bits[(i + 1) % 5], bits[(i + 2) % 5]
        quarters = [one[:6], one[6:], two[:6], two[6:]]
        for drop in range(4):
            kept = bits[i] + [b for q in range(4) if q != drop for b in quarters[q]]
            masks.append([sum(1 << b for b in kept)])
    return masks


def sampled_keys(words: int, bits: int, keys: int) -> list[list[int]]:
    """Bit masks of ``keys`` sets of ``bits`` positions; each full permutation of the positions is used up first."""
    rng, positions, masks = random.Random(SEED), [], []
    while len(masks) < keys:
        if len(positions) < bits:
            positions = rng.sample(range(64 * words), 64 * words)
        taken, positions = positions[:bits], positions[bits:]
        masks.append([sum(1 << (p & 63) for p in taken if p >> 6 == w) for w in range(words)])
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(marks: np.ndarray, i: np.ndarray, j: np.ndarray, budget: int) -> np.ndarray:
    """Which pairs (i, j) of rows differ in at most ``budget`` bits; ring chains of segments first, then all bits."""
    x = marks[i] ^ marks[j]
    if marks.shape[1] == 1:  # five segments of one word, as in ring_keys
        cuts = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
        parts = np.stack([np.bitwise_count((x[:, 0] >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in cuts], axis=1).astype(np.int64)
    else:
        parts = np.bitwise_count(x).astype(np.int64)
    m = parts.shape[1]
    alive = np.zeros(len(i), bool)
    for start in range(m):
        chain, sums = np.ones(len(i), bool), np.zeros(len(i), np.int64)
        for length in range(1, m):
            sums += parts[:, (start + length - 1) % m]
            chain &= sums * m <= length * budget
        alive |= chain
    alive[alive] = parts[alive].sum(axis=1) <= budget
    return alive


def _stars(keys: np.ndarray, nodes: np.ndarray, marks: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows are sorted by key and node; returns pairs of a node and the smallest node it is joined with within a key."""
    left, right = [], []
    i, d = np.arange(len(keys)), 1
    while True:
        i = i[i < len(keys) - d]
        i = i[keys[i] == keys[i + d]]
        if not len(i):
            break
        for part in np.array_split(i, len(i) // 500_000 + 1):
            part = part[_linked(marks, part, part + d, budget)]
            left.append(part)
            right.append(part + d)
        d += 1
    if not left:
        return nodes[:0], nodes[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(keys))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
    if marks.shape[1] > 1:
        label = _central(label, marks)
    far = np.flatnonzero(label != np.arange(len(keys)))
    return np.maximum(nodes[far], nodes[label[far]]), np.minimum(nodes[far], nodes[label[far]])


def _central(label: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For groups by ``label``: the row whose bits are nearest to those that most rows of the group have, as the group's label.

    Of near copies of one text that is the text itself, to which all of them are similar, though they may not be to each other.
    """
    out = label.copy()
    order = np.argsort(label, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
        if len(group) > 2:
            bits = np.unpackbits(np.ascontiguousarray(marks[group]).view(np.uint8), axis=1)
            most = bits.sum(axis=0, dtype=np.int64) * 2 > len(group)
            out[group] = group[(bits != most).sum(axis=1).argmin()]
    return out


def _open_pairs(keys: np.ndarray, nodes: np.ndarray, marks: np.ndarray, open_rows: np.ndarray, labels: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs with different labels of which one is open: (larger node, smaller node)."""
    left, right = [nodes[:0]], [nodes[:0]]
    i, d = np.arange(len(keys)), 1
    while True:
        i = i[i < len(keys) - d]
        i = i[keys[i] == keys[i + d]]
        if not len(i):
            break
        part = i[(open_rows[i] | open_rows[i + d]) & (labels[i] != labels[i + d])]
        for part in np.array_split(part, len(part) // 500_000 + 1):
            part = part[_linked(marks, part, part + d, budget)]
            left.append(nodes[part + d])
            right.append(nodes[part])
        d += 1
    return np.concatenate(left), np.concatenate(right)


def _links_in_order(budget: int, words: int, only_open: bool = False):
    """For ``mapInArrow`` over rows (key, node, f0, ...) sorted by key and node: the last key of a batch waits for the next batch."""
    width = 2 + words + 2 * only_open

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            marks = np.stack([c.view(np.uint64) for c in columns[2 : 2 + words]], axis=1)
            a, b = _open_pairs(*columns[:2], marks, *columns[-2:], budget) if only_open else _stars(*columns[:2], marks, budget)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)]
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns)]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1], side="left"))
            if cut:
                yield out([c[:cut] for c in columns])
            kept = [c[cut:] for c in columns]
        if kept is not None:
            yield out(kept)

    return run


def links(marks: DataFrame, words: int, masks: list[list[int]], budget: int, only_open: bool = False) -> DataFrame:
    """Node pairs (a, b) that join all linked rows of ``marks`` (node, f0, ...; one row per fingerprint) sharing a key.

    ``only_open``: all linked pairs in which the column ``open`` holds for one row at least and ``label`` differs.
    """
    if any(m.count(0) == len(m) for m in masks):
        raise ValueError("a key without bits would compare all rows")
    cols = [*names(words), *(["open", "label"] if only_open else [])]
    keys = F.array(*[F.xxhash64(F.lit(k), *[F.col(c).bitwiseAND(F.lit(_signed(m))) for c, m in zip(names(words), mask) if m]) for k, mask in enumerate(masks)])
    rows = marks.select(F.explode(keys).alias("key"), "node", *cols)
    counts = rows.groupBy("key").count().where(F.col("count") > BLOCK)
    hot = materialize(counts.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hotkeys")
    plain = rows.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key", "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda p: F.struct(F.least(own, p).alias("x"), F.greatest(own, p).alias("y")))
    dealt = rows.join(hot, "key").select("key", F.explode(meets).alias("at"), "node", *cols)
    dealt = dealt.select(F.xxhash64("key", "at.x", "at.y").alias("key"), "node", *cols).repartition("key").sortWithinPartitions("key", "node")
    run = _links_in_order(budget, words, only_open)
    return plain.mapInArrow(run, "a long, b long").union(dealt.mapInArrow(run, "a long, b long")).distinct()


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1, masks: list[list[int]] | None = None, budget: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, f0, ..., and component_id, the smallest doc_id reachable by links (itself included).

    A row without an id is linked too; its component_id is null only if no linked row has an id.
    """
    cols = names(words)
    rows = materialize(fingerprints(docs, id, text, shingle, words), "fingerprints")
    node = F.col("f0") if words == 1 else F.xxhash64(*cols)
    marks = materialize(rows.groupBy(*cols).agg(F.min("doc_id").alias("least")).withColumn("node", node), "marks")
    labels = components(links(marks, words, masks or ring_keys(budget), budget))
    placed = marks.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    found = placed.join(least, "label").select(*cols, "component_id")
    return rows.join(found, cols, "left").select("doc_id", *cols, "component_id")


#: Wide fingerprints for whole near-duplicates: 256 bits over five-word shingles.  Shingle sets with Jaccard similarity
#: 0.8 have a cosine of about 0.89, so that 15 % of the bits (39 of 256, give or take 6) differ; 64 lets all of them pass.
WIDE = {"shingle": 5, "words": 4, "budget": 64}
KEY_BITS, KEYS = 16, 96
SIMILAR = 0.8


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two shingle sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _wide_marks(docs: DataFrame) -> DataFrame:
    """(doc_id, same, f0, ...) of rows (doc_id, text): ``same`` is 128 bits of the shingle set."""
    cols, words, shingle = names(WIDE["words"]), WIDE["words"], WIDE["shingle"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("same", T.StringType()), *[T.StructField(n, T.LongType()) for n in cols]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        same, marks = [], []
        for text in texts_of(batch, "text"):
            hashes = shingle_hashes(text, shingle)
            same.append(xxhash.xxh3_128_hexdigest(np.unique(hashes).astype("<u8").tobytes()))
            marks.append([majority(_mixed(hashes, w)) for w in range(words)] if len(hashes) else [0] * words)
        marks = np.array(marks, np.uint64).reshape(-1, words)
        return record_batch(schema, [batch.column(0), same, *[np.ascontiguousarray(marks[:, w]).view(np.int64) for w in range(words)]])

    return docs.mapInArrow(per_slice("text", work), schema)


def _similar(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, alike) for each pair of ids: whether the shingle sets of their texts (doc_id, text) are SIMILAR, counted exactly.

    ``pairs`` is a written table, which is removed.
    """
    shingle = WIDE["shingle"]

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, shingle).astype("<u8").tobytes() for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k)] for k in (2, 3)]
            alike = [jaccard(x, y) >= SIMILAR for x, y in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike, pa.bool_())], names=["a", "b", "alike"])

    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = docs.join(asked, docs.doc_id == asked.node, "left_semi")
    held = texts.mapInArrow(per_slice("text", sets), "node long, shingles binary").groupBy("node").agg(F.min("shingles").alias("shingles"))
    held = materialize(held, "shingles")
    left = held.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = held.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")
    found = materialize(met.mapInArrow(compared, "a long, b long, alike boolean"), "compared")
    release(held)  # larger than the texts
    release(pairs)
    return found


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and component_id of the rows with an id; links are pairs whose five-word shingle sets have Jaccard similarity SIMILAR or more.

    Texts with the same shingle set are one node, named by its smallest id.  The rows of a key that are within the budget
    of each other are first compared with the central one of them.  A row that is not similar to that one is compared with
    every row within the budget that is not joined with it by then.  No link is taken from bits alone, and a group of copies makes no pairs.  Of rows that repeat an id, the smallest set counts.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL")
    cols, masks = names(WIDE["words"]), sampled_keys(WIDE["words"], KEY_BITS, KEYS)
    marked = materialize(_wide_marks(rows), "fingerprints")
    marks = materialize(marked.groupBy("same").agg(F.min(F.struct("doc_id", *cols)).alias("m")).select("same", F.col("m.doc_id").alias("node"), *[f"m.{c}" for c in cols]), "marks")
    stars = materialize(links(marks.select("node", *cols), WIDE["words"], masks, WIDE["budget"]), "candidates")
    first = _similar(stars, rows)
    # whoever is not similar to the central row of a key meets those there that are not joined with it yet
    joined = components(first.where("alike").select("a", "b"))
    apart = first.where(~F.col("alike")).select(F.explode(F.array("a", "b")).alias("node")).distinct()
    open_marks = marks.select("node", *cols).join(apart.withColumn("open", F.lit(True)), "node", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    open_marks = open_marks.join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    others = links(open_marks, WIDE["words"], masks, WIDE["budget"], only_open=True)
    others = others.join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = _similar(materialize(others, "candidates"), rows)
    labels = components(first.union(second).where("alike").select("a", "b"))
    placed = marks.select("same", "node").join(labels, "node", "left").select("same", F.coalesce("label", "node").alias("component_id"))
    return marked.join(placed, "same").select("doc_id", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that with the smallest id; columns stay.

    Rows without an id cannot be told apart and all stay.  Texts without words say nothing and all stay, too.  Of rows
    that repeat an id, one stays.
    """
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col(id).isNotNull()
    found = near_duplicates(docs.where(worded), id, text)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    chosen = docs.where(worded).join(kept, F.col(id) == F.col("_kept")).drop("_kept").dropDuplicates([id])
    return chosen.unionByName(docs.where(~worded))
