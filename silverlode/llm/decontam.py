"""Benchmark decontamination: latent semantic search for passages, then subsequence and answer checks.

Texts are words (letters and digits in lower case), hashed into DIMENSIONS terms.  Passages are windows of WINDOW words,
weighted by tf-idf; no word weighs nothing, common ones weigh less.  Each different text is worked on once, whatever its
number of copies, and what is found is joined back to the rows that hold it.  A distributed randomised SVD of the passages-by-terms matrix A gives the latent
space: every task adds up A' (A R) for a fixed random R, the sums are added in a tree, and the driver finds the leading
right singular vectors V from that sketch (Nystroem form; terms x RANK numbers, whatever the corpus).  Term counts, the
sketch, windows and matches take in every text.

Every window of every document, a new one each half WINDOW, is projected as V' x and compared with the benchmark's
windows; those of a cosine of at least NEAR are candidates, if they hold OVERLAP of the rarer words asked for (of all its
words, if a window has under LEAST_WORDS rarer ones).  Beside that, every place where a document holds a run of RUN words of
a benchmark text is a candidate, by hashes of the runs: a copy of n words with under (n - RUN + 1) / RUN changed words
holds one, however common its words are.  A candidate counts as a leak if the longest common subsequence of the benchmark text and the words around the window covers COPIED of the benchmark text, or PARAPHRASED of
it and all words of the answer.  For a benchmark text without an answer of its own (no such column, or no words in it) the
ANSWER_WORDS words of it whose terms are rarest among the documents stand for the answer.

The benchmark is a stated query set: the driver reads it whole and sends it out in blocks of BENCHMARK_BLOCK texts, one pass
over the different texts each.

Results: texts that are null or without words match nothing; a benchmark text of under LEAST_WORDS words is skipped, as it
says too little; repeated rows give repeated results; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import partition_sums, slices, texts_of
from silverlode.session import materialize, release

DIMENSIONS, RANK, WINDOW = 1 << 13, 64, 32
HALF = WINDOW // 2
NEAR, COPIED, PARAPHRASED, LEAST_WORDS = 0.38, 0.7, 0.5, 8
#: Words that stand for the answer where there is none.
ANSWER_WORDS = 3
#: A candidate holds this share of the benchmark window's rarer words.
OVERLAP = 0.25
BENCHMARK_BLOCK = 2000
#: Terms of over this share of the passages (and this number) say less about a passage: their tf-idf is damped.
COMMON, COMMON_LEAST, DAMPED = 0.005, 50, 0.1
#: Words of a run that makes a candidate whatever its cosine; odd multiplier of the run hashes (a fixed value).
RUN, RUN_ODD = 4, 0x9E3779B97F4A7C15
#: Passages whose part of the sketch is worked out at once.
SKETCH = 1 << 11
#: Words that are handled at once.
CHUNK = 1 << 16
#: Pieces of HALF rows that are summed at once.
STEP = 256

_WORD_BYTES = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> np.ndarray:
    """32-bit hashes of a text's words in order."""
    data = (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return np.fromiter(map(zlib.crc32, data), np.uint32, len(data))


def same_text(text: Column) -> Column:
    """What equal texts have in common: 128 bits, so that different ones are not taken for each other."""
    return F.md5(text)


def tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """(same, words): the word hashes of each different text as bytes, written once for the passes over them.

    Copies are left out in each task before words are made and shuffled, and then across tasks: a text that a third of
    the rows hold reaches no task more often than there are tasks.
    """
    rows = docs.select(same_text(F.col(text).cast("string")).alias("same"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str] = set()
        for batch in slices(batches, "text"):
            batch = _first(batch, known)
            found = [words_of(t).astype("<u4").tobytes() for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["same", "words"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str] = set()
        for batch in slices(batches, "words"):
            yield _first(batch, known)

    kinds = "same string, words binary"
    return materialize(rows.mapInArrow(read, kinds).repartition("same").mapInArrow(once, kinds), "words", compression="zstd")


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Runs of rows of about CHUNK words: their places in the batch and their words."""
    places, words, held = [], [], 0
    for place, data in enumerate(batch.column(batch.schema.get_field_index("words"))):
        found = np.frombuffer(data.as_buffer(), np.uint32)
        if not len(found):
            continue
        places.append(place)
        words.append(found)
        held += len(found)
        if held >= CHUNK:
            yield places, words
            places, words, held = [], [], 0
    if places:
        yield places, words


def _blocks(words: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts one after another: the block of ``step`` words each word is in, and each block's text and first word."""
    lengths = np.array([len(w) for w in words])
    counts = -(-lengths // step)
    text = np.repeat(np.arange(len(lengths)), counts)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    sizes = np.minimum(step, lengths[text] - first)
    return np.repeat(np.arange(len(text)), sizes), text, first


def _sums(rows: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows`` by ``key``, which rises; zeros for keys that don't occur."""
    out = np.zeros((n, *rows.shape[1:]), rows.dtype)
    if len(key):
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        out[key[edges]] = np.add.reduceat(rows, edges, axis=0)
    return out


def _sums_of_rows(rows: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``rows[index]`` over the runs of ``index`` that begin at ``starts``.

    Runs are cut into pieces of HALF and filled up with a row of zeros, so that a piece is summed by a product with ones;
    STEP pieces at a time, so that what is looked up at once fits a processor's cache.
    """
    lengths = np.diff(starts, append=len(index))
    counts = -(-lengths // HALF)
    first = np.cumsum(counts) - counts
    padded = np.full(counts.sum() * HALF, len(rows), np.intp)
    padded[np.arange(len(index)) + np.repeat(first * HALF - starts, lengths)] = index
    padded = padded.reshape(-1, HALF)
    rows, ones = np.concatenate((rows, np.zeros_like(rows[:1]))), np.ones(HALF, rows.dtype)
    out = np.empty((len(padded), rows.shape[1]), rows.dtype)
    for a in range(0, len(padded), STEP):
        out[a : a + STEP] = ones @ rows.take(padded[a : a + STEP], axis=0)
    return out if len(out) == len(starts) else np.add.reduceat(out, first, axis=0)


@dataclass(frozen=True)
class Space:
    """Projects terms into the latent space: one row per term, tf-idf weight included; and how often each was seen."""

    rows: np.ndarray
    common: np.ndarray
    seen: np.ndarray

    def windows(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of all windows of some texts, each window's text and its first word within the text."""
        block, text, first = _blocks(words, HALF)
        terms = np.concatenate(words) % DIMENSIONS
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        sums = _sums_of_rows(self.rows, terms, starts)
        follows = np.concatenate((text[1:] == text[:-1], [False]))
        whole = follows | (first == 0)  # a last half stands alone only if it is all there is
        joined = sums[whole]
        joined[follows[whole]] += sums[np.flatnonzero(follows) + 1]
        norm = np.sqrt((joined * joined).sum(axis=1, keepdims=True))
        return joined / np.maximum(norm, 1e-12), text[whole], first[whole]


def _first(batch: pa.RecordBatch, known: set[str]) -> pa.RecordBatch:
    """The rows whose hash is not among ``known``, which grows by them."""
    places = []
    for place, same in enumerate(batch.column(0).to_pylist()):
        if same not in known:
            known.add(same)
            places.append(place)
    return batch if len(places) == batch.num_rows else batch.take(pa.array(places, pa.int64()))


def latent_space(words: DataFrame) -> Space:
    """Randomised SVD of tf-idf passages; counts and sketch are taken over all different texts (rows of ``tokens``)."""
    rows = words.select("words")

    def count(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        for _, words in _chunks(batch):
            sums[:DIMENSIONS] += np.bincount(np.concatenate(words) % DIMENSIONS, minlength=DIMENSIONS)
            sums[DIMENSIONS] += sum(-(-len(w) // WINDOW) for w in words)

    counts = partition_sums(rows, DIMENSIONS + 1, count, "words", "terms")
    seen, passages = counts[:DIMENSIONS], counts[DIMENSIONS]
    common = seen > max(COMMON_LEAST, COMMON * passages)
    weight = (np.where(common, DAMPED, 1.0) * np.log1p(passages / (1 + seen))).astype(np.float32)
    # the random matrix R has one entry a term: +1 or -1 in one of RANK columns
    rng = np.random.default_rng(42)
    column, sign = rng.integers(0, RANK, DIMENSIONS), rng.choice([-1.0, 1.0], DIMENSIONS)
    signed = weight * sign

    def add(terms: np.ndarray, passage: np.ndarray, passages: int, z: np.ndarray) -> None:
        # a word weighs weight / length of its passage: lengths divide whole passages, weights multiply sums of a term
        square = _sums(weight[terms] ** 2, passage, passages) + 1e-12
        y = np.bincount(passage * RANK + column[terms], signed[terms], passages * RANK).reshape(-1, RANK)
        y = (y / square[:, None]).astype(np.float32)
        order = np.argsort(terms, kind="stable")  # by radix: terms have 16 bits
        ranked = terms[order]
        edges = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        z[ranked[edges]] += weight[ranked[edges], None] * _sums_of_rows(y, passage[order], edges)

    def sketch(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        z = sums.reshape(DIMENSIONS, RANK)
        for _, words in _chunks(batch):
            all_terms = (np.concatenate(words) % DIMENSIONS).astype(np.uint16)
            blocks, text, _ = _blocks(words, WINDOW)
            edges = np.searchsorted(blocks, np.arange(0, len(text) + SKETCH, SKETCH))
            for n, (begin, until) in enumerate(zip(edges[:-1], edges[1:])):
                add(all_terms[begin:until], blocks[begin:until] - n * SKETCH, min(SKETCH, len(text) - n * SKETCH), z)

    z = partition_sums(rows, DIMENSIONS * RANK, sketch, "words", "sketch").reshape(DIMENSIONS, RANK)
    core = np.zeros((RANK, RANK))
    np.add.at(core, column, sign[:, None] * z)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(1e-9, values.max(initial=0.0) * 1e-9)
    if not good.any():
        return Space(np.zeros((DIMENSIONS, 1), np.float32), common, seen)
    v, s, _ = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return Space((weight[:, None] * v[:, s > s.max() * 1e-6]).astype(np.float32), common, seen)


def common_subsequence(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks``: by word, the bits of its places in the benchmark text."""
    row, full = (1 << length) - 1, (1 << length) - 1
    for w in words:
        hit = row & masks.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


@dataclass(frozen=True)
class Item:
    item_id: int | None
    words: list[int]
    vocabulary: frozenset[int]
    masks: dict[int, int]
    answer: frozenset[int]


def items_of(rows: list[tuple], seen: np.ndarray) -> list[Item]:
    """Benchmark texts (id, text, answer) that have enough words; ``seen``: how often each term was seen."""
    out = []
    for item_id, text, answer in rows:
        words = words_of(text).tolist()
        if len(words) >= LEAST_WORDS:
            rarest = sorted(set(words), key=lambda w: (seen[w % DIMENSIONS], w))[:ANSWER_WORDS]
            out.append(Item(item_id, words, frozenset(words), masks_of(words), frozenset(words_of(answer).tolist() or rarest)))
    return out


def share_of(item: Item, words: np.ndarray, start: int) -> float:
    """How much of the benchmark text the words around a window hold in order; 0 if it is no leak."""
    n = len(item.words)
    around = words[max(0, start - n) : start + WINDOW + n].tolist()
    if len(item.vocabulary.difference(around)) > (1 - PARAPHRASED) * n:
        return 0.0
    share = common_subsequence(item.masks, n, around) / n
    if share >= COPIED or (share >= PARAPHRASED and item.answer.issubset(around)):
        return share
    return 0.0


SCHEMA = "same string, item_id long, share double, similarity double, first_word long"


@dataclass(frozen=True)
class Shared:
    """Which words asked for each benchmark window has, by place in a sorted list of all of them; ``table`` has their leading 20 bits."""

    vocabulary: np.ndarray
    member: np.ndarray
    least: np.ndarray
    table: np.ndarray

    def codes(self, words: list[np.ndarray]) -> np.ndarray:
        joined = np.concatenate(words)
        out = np.full(len(joined), len(self.vocabulary))
        likely = np.flatnonzero(self.table[joined >> np.uint32(12)])
        at = np.minimum(np.searchsorted(self.vocabulary, joined[likely]), len(self.vocabulary) - 1)
        found = self.vocabulary[at] == joined[likely]
        out[likely[found]] = at[found]
        return out

    def enough(self, codes: np.ndarray, begin: np.ndarray, until: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Whether a window of words holds as many of the words asked for in a benchmark window as a leak needs."""
        none = len(self.vocabulary)
        held = np.lib.stride_tricks.sliding_window_view(np.concatenate((codes, np.full(WINDOW, none))), WINDOW)[begin]
        short = np.flatnonzero(until - begin < WINDOW)
        held[short] = np.where(np.arange(WINDOW) < (until - begin)[short, None], held[short], none)
        held += (asked * (none + 1))[:, None]
        return np.count_nonzero(self.member.ravel().take(held), axis=1) >= self.least[asked]


def _asked(space: Space, items: list[Item]) -> tuple[np.ndarray, np.ndarray, Shared]:
    """The benchmark's windows: vectors as columns, the item of each, and their rarer words (all words, if few are rarer)."""
    words = [np.array(i.words, np.uint32) for i in items]
    vectors, of, first = space.windows(words)
    weighted = []
    for w in (words[k][a : a + WINDOW] for k, a in zip(of.tolist(), first.tolist())):
        rarer = np.unique(w[~space.common[w % DIMENSIONS] & (space.seen[w % DIMENSIONS] > 0)])
        weighted.append(rarer if len(rarer) >= LEAST_WORDS else np.unique(w))
    vocabulary = np.unique(np.concatenate([*weighted, np.zeros(1, np.uint32)]))
    member = np.zeros((len(of), len(vocabulary) + 1), bool)
    for k, w in enumerate(weighted):
        member[k, np.searchsorted(vocabulary, w)] = True
    least = np.array([max(1, len(w) * OVERLAP) for w in weighted])
    table = np.zeros(1 << 20, bool)
    table[vocabulary >> np.uint32(12)] = True
    return np.ascontiguousarray(vectors.T), of, Shared(vocabulary, member, least, table)


def _run_hashes(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every run of RUN words."""
    n = max(0, len(words) - RUN + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(RUN):
            out = (out ^ (out >> np.uint64(29)) ^ words[k : k + n]) * np.uint64(RUN_ODD)
    return out


@dataclass(frozen=True)
class Runs:
    """The runs of RUN words of the benchmark texts: sorted hashes, the item of each, and a table of 2^20 leading bits."""

    hashes: np.ndarray
    items: np.ndarray
    table: np.ndarray

    def found(self, words: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(text, item, first word of the half window) wherever a text holds a run of an item, once each."""
        joined, lengths = np.concatenate(words), np.array([len(w) for w in words])
        hashes = _run_hashes(joined)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(44)).astype(np.int64)])
        ends = np.cumsum(lengths)
        text = np.searchsorted(ends, at, side="right")
        whole = at + RUN <= ends[text]
        at, text = at[whole], text[whole]
        low, high = (np.searchsorted(self.hashes, hashes[at], side=s) for s in ("left", "right"))
        counts = high - low
        item = self.items[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
        start = (at - (ends - lengths)[text]) // HALF * HALF
        places = np.stack([np.repeat(text, counts), item, np.repeat(start, counts)], axis=1)
        yield from map(tuple, np.unique(places, axis=0).tolist())


def runs_of(items: list[Item]) -> Runs:
    hashes = [np.unique(_run_hashes(np.array(i.words, np.uint32))) for i in items]
    joined, of = np.concatenate(hashes), np.repeat(np.arange(len(items)), [len(h) for h in hashes])
    order = np.argsort(joined, kind="stable")
    table = np.zeros(1 << 20, bool)
    table[(joined >> np.uint64(44)).astype(np.int64)] = True
    return Runs(joined[order], of[order], table)


def _matches(space: Space, items: list[Item]):
    """For ``mapInArrow`` over (same, words): the leaks of each text, the best place for each benchmark text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, of, shared = _asked(space, items)
        runs = runs_of(items)
        for batch in slices(batches, "words"):
            out = []
            for places, words in _chunks(batch):
                vectors, text, first = space.windows(words)
                codes = shared.codes(words)
                begin = (np.cumsum([len(w) for w in words]) - [len(w) for w in words])[text] + first
                until = np.minimum(begin + WINDOW, np.cumsum([len(w) for w in words])[text])
                best: dict[tuple[int, int], tuple] = {}
                tried: set[tuple[int, int, int]] = set()
                for a in range(0, len(vectors), 2 * STEP):
                    cosine = (vectors[a : a + 2 * STEP] @ asked).ravel()
                    at = np.flatnonzero(cosine >= NEAR)
                    rows, columns = np.divmod(at, asked.shape[1])
                    near = cosine[at]
                    rows += a
                    alike = shared.enough(codes, begin[rows], until[rows], columns)
                    for r, c, similarity in zip(rows[alike].tolist(), columns[alike].tolist(), near[alike].tolist()):
                        key, start = (int(text[r]), int(of[c])), int(first[r])
                        if (*key, start) in tried:
                            continue
                        tried.add((*key, start))
                        share = share_of(items[key[1]], words[key[0]], start)
                        if share and (key not in best or share > best[key][0]):
                            best[key] = (share, similarity, start)
                for t, i, start in runs.found(words):
                    if (t, i, start) in tried:
                        continue
                    share = share_of(items[i], words[t], start)
                    if share and ((t, i) not in best or share > best[t, i][0]):
                        window = np.flatnonzero((text == t) & (first <= start))[-1]
                        best[t, i] = (share, float((vectors[window] @ asked[:, of == i]).max()), start)
                out += [(places[t], items[i].item_id, *found) for (t, i), found in best.items()]
            if out:
                place, item, share, similarity, start = zip(*out)
                ids = batch.column(0).take(pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(item, pa.int64()), pa.array(share, pa.float64()), pa.array(similarity, pa.float64()), pa.array(start, pa.int64())], names=["same", "item_id", "share", "similarity", "first_word"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """(doc_id, item_id, share, similarity, first_word): documents that hold a benchmark text, copied or paraphrased."""
    asked = benchmark.select(F.col(item).cast("long"), F.col(item_text).cast("string"), F.col(answer).cast("string") if answer else F.lit(None).cast("string"))
    rows = tokens(docs, text)
    space = latent_space(rows)
    found, block = None, []

    def searched(block: list) -> None:
        nonlocal found
        items = items_of(block, space.seen)
        if items:
            part = rows.mapInArrow(_matches(space, items), SCHEMA)
            found = part if found is None else found.union(part)

    for row in asked.toLocalIterator():
        block.append(tuple(row))
        if len(block) == BENCHMARK_BLOCK:
            searched(block)
            block = []
    searched(block)
    found = None if found is None else materialize(found, "leaks")
    release(rows)
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA.replace("same string", "doc_id long"))
    # from texts back to the rows that hold them
    holders = docs.select(F.col(id).cast("long").alias("doc_id"), same_text(F.col(text).cast("string")).alias("same"))
    found = holders.join(found, "same").drop("same")
    order = F.struct(F.col("share"), F.col("similarity"), -F.col("first_word"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("best"))
    return best.select("doc_id", "item_id", "best.share", "best.similarity", (-F.col("best.col3")).alias("first_word"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """``docs`` without the rows whose id holds a benchmark text.  Rows without an id are judged together, as one id."""
    bad = leaks(docs, benchmark, id, text, item, item_text, answer).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(bad, F.col(id).eqNullSafe(F.col("_leak")), "left_anti")
