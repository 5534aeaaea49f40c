"""Packing token streams into windows of fixed size by order-preserving dynamic programming.

Documents keep their order.  A window may end at a document's end (free), at a sentence's end (CUT_SENTENCE) or, only
where a sentence leaves no other choice, inside it (CUT_INSIDE).  A window costs its padding: ``size`` less its length,
or nothing if the length is a power of two, as such sequences are not padded.  With f(j) the least cost of a window
ending at boundary j,

    f(j) = cut(j) + min( min over i within size of f(i) + p(i), plus size - p(j);  f(i) where p(j) - p(i) = 2^n ),

p being positions.  The inner minimum slides over a monotone queue, so a boundary costs constant time.

Each task packs the documents of its partition: the DP runs over about STRETCH tokens at a time and hands the documents
of its last, open window on to the next stretch, so memory is bounded and a partition leaves one short tail, which it
cuts at powers of two.  No shuffle, no order among partitions; sequence ids are (partition << 32) + count.  A partition's
rows come from a file scan, so a task that is run again makes the same sequences.

Results: null text counts as empty; an empty document is its end token alone; repeated rows are packed as often as they
come; a text of any length is cut over as many sequences as it needs; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import slices, texts_of

SIZE, END = 4096, 2
CUT_SENTENCE, CUT_INSIDE, SEQUENCE = 6, 48, 1
STRETCH = 64 * SIZE
#: A worker remembers so many chunks of text in each of two generations.
REMEMBERED = 500_000
TOKENIZER = "word_bpe_49k.json"


class Words:
    """Token ids of white-space separated chunks, each encoded once while remembered.

    White space always separates tokens of this tokenizer, so a text's ids are those of its chunks in a row; letters and
    marks are separate tokens too, so marks that close a word become a chunk.  Chunks are kept in two generations: what is
    in use survives the change.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.index: dict[str, int] = {}
        self.renew()

    def renew(self) -> None:
        self.old = (self.index, self.flat, self.starts, self.lengths) if self.index else ({}, (), (), ())
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.lengths, self.closing = array("I"), array("q"), array("q"), array("b")

    def _learn(self, chunks: list[str]) -> None:
        """Adds new chunks to the index; chunks of letters alone are encoded in one call."""
        index, flat, starts, lengths = self.old
        known, fresh, others = [c for c in chunks if c in index], [], []
        for c in chunks:
            if c not in index:
                (fresh if _only_letters(c) else others).append(c)
        found = [flat[starts[k] : starts[k] + lengths[k]] for k in map(index.__getitem__, known)]
        if fresh:
            coded = self.tokenizer.encode(" ".join(fresh), add_special_tokens=False)
            ids = coded.ids
            edges = np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(fresh) + 1)).tolist()
            found += [array("I", ids[a:b]) for a, b in zip(edges, edges[1:])]
        found += [array("I", self.tokenizer.encode(c, add_special_tokens=False).ids) for c in others]
        for chunk, ids in zip([*known, *fresh, *others], found):
            self.index[chunk] = len(self.starts)
            self.starts.append(len(self.flat))
            self.lengths.append(len(ids))
            self.closing.append(chunk.rstrip(_QUOTES)[-1:] in _STOPS)
            self.flat.extend(ids)

    def lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all texts in a row: token ids, whether a sentence ends after each, and each text's number of ids."""
        split = [chunks_of(t) for t in texts]
        if len(self.index) > REMEMBERED:
            self.renew()
        chunks = [c for per in split for c in per]
        new = set(chunks).difference(self.index)
        if new:
            self._learn(sorted(new))
        place = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        n = np.array(self.lengths, np.int64)[place] if len(place) else place
        after = np.cumsum(n)
        begin = np.array(self.starts, np.int64)[place] if len(place) else place
        ids = np.array(self.flat, np.uint32)[np.repeat(begin - (after - n), n) + np.arange(int(n.sum()))]
        ends = np.zeros(len(ids), bool)
        closing = np.array(self.closing, bool)[place] if len(place) else np.empty(0, bool)
        ends[after[closing & (n > 0)] - 1] = True
        until = np.concatenate(([0], after))[np.cumsum([len(per) for per in split])] if split else np.empty(0, np.int64)
        return ids, ends, np.diff(np.concatenate(([0], until)))


_QUOTES = "\"')]»”’"
_STOPS = frozenset(".!?…。")
_ODD, _FOREIGN = re.compile("[\x1c-\x1f]"), re.compile("[^\x00-\u024f]")
#: Marks that close a word: after a letter or digit, before white space or the end.
_CLOSING = re.compile(r"[.,;:!?#$%&*|](?<=[^\W_].)[.,;:!?#$%&*|]*(?!\S)")


def _only_letters(chunk: str) -> bool:
    """Whether the tokenizer, which composes and lower-cases, takes the chunk for one run of letters."""
    return chunk.isalpha() and (chunk.isascii() or unicodedata.normalize("NFC", chunk).lower().isalpha())


def chunks_of(text: str) -> list[str]:
    """Pieces of ``text`` whose ids in a row are the text's ids."""
    if not _FOREIGN.search(text):  # beyond Latin letters, lower case may depend on the place; the tokenizer does it itself
        text = text.lower()
    text = _CLOSING.sub(r" \g<0>", text)
    # str.split also splits at \x1c-\x1f, which the tokenizer does not take for white space
    return re.split(r"[ \n]+", text) if _ODD.search(text) else text.split()


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One per Python worker, kept from task to task."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def boundaries(doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, from 0, with what a cut there costs; no gap is over ``size``."""
    position = np.union1d(doc_ends, sentence_ends)
    cost = np.where(np.isin(position, doc_ends), 0, CUT_SENTENCE)
    gaps = np.diff(np.concatenate(([0], position)))
    wide = np.flatnonzero(gaps > size)
    if len(wide):
        step = max(1, size // 8)
        extra = np.concatenate([np.arange(position[k] - gaps[k] + step, position[k], step) for k in wide])
        position, cost = np.concatenate((position, extra)), np.concatenate((cost, np.full(len(extra), CUT_INSIDE)))
        order = np.argsort(position, kind="stable")
        position, cost = position[order], cost[order]
    return np.concatenate(([0], position)), np.concatenate(([0], cost))


def best_cuts(position: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """Window ends (positions, the last one included) of least total cost."""
    p, c = position.tolist(), cost.tolist()
    n = len(p)
    f, back = [0] * n, [0] * n
    # pairs of boundaries a power of two apart, by the later one
    pairs = []
    for length in (1 << b for b in range(size.bit_length())):
        i = np.searchsorted(position, position - length)
        hit = np.flatnonzero((position >= length) & (position[i] == position - length))
        pairs.append(np.stack((hit, i[hit])))
    joined = np.concatenate(pairs, axis=1)
    order = np.argsort(joined[0], kind="stable")
    later, earlier = joined[0][order].tolist() + [n], joined[1][order].tolist()
    at = 0
    queue: deque[tuple[int, int]] = deque()
    for j in range(1, n):
        key = f[j - 1] + p[j - 1]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j - 1))
        here = p[j]
        while p[queue[0][1]] < here - size:
            queue.popleft()
        best, prior = queue[0]
        best += size - here
        while later[at] == j:
            i = earlier[at]
            at += 1
            if f[i] < best:
                best, prior = f[i], i
        f[j], back[j] = best + c[j] + SEQUENCE, prior
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(p[j])
        j = back[j]
    return cuts[::-1]


def tail_cuts(position: int, end: int) -> list[int]:
    """Ends that cut [position, end) at falling powers of two."""
    out, left = [], end - position
    while left:
        step = 1 << (left.bit_length() - 1)
        position, left = position + step, left - step
        out.append(position)
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Stretch:
    """Documents not yet written: id, total tokens, tokens written before, and the token array that is left."""

    def __init__(self, size: int, base: int):
        self.size, self.next = size, base
        self.docs: list[tuple[int | None, int, int, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), 0, ids, ends))
        self.held += len(ids)

    def flush(self, last: bool) -> pa.RecordBatch | None:
        """Writes all windows but the last one, or all of them; what is left stays for the next call."""
        if not self.docs:
            return None
        ids = np.concatenate([d[3] for d in self.docs])
        marks = np.concatenate([d[4] for d in self.docs])
        doc_ends = np.cumsum([len(d[3]) for d in self.docs])
        position, cost = boundaries(doc_ends, np.flatnonzero(marks) + 1, self.size)
        cuts = best_cuts(position, cost, self.size)
        if last:
            before = cuts[-2] if len(cuts) > 1 else 0
            cuts = [*cuts[:-1], *tail_cuts(before, int(doc_ends[-1]))]
        elif len(cuts) > 1:
            cuts = cuts[:-1]
        pieces = np.union1d(np.array(cuts, np.int64), doc_ends[doc_ends <= cuts[-1]])
        begins = np.concatenate(([0], pieces[:-1]))
        doc = np.searchsorted(doc_ends, begins, side="right")
        window = np.searchsorted(np.array(cuts), begins, side="right")
        window_start = np.concatenate(([0], cuts))[window]
        doc_start = np.concatenate(([0], doc_ends))[doc]
        written = np.array([d[2] for d in self.docs], np.int64)[doc]
        totals = np.array([d[1] for d in self.docs], np.int64)[doc]
        raw = ids.astype("<u4")
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(begins.tolist(), pieces.tolist())]
        names = [self.docs[k][0] for k in doc.tolist()]
        columns = [pa.array(names, pa.int64()), written + begins - doc_start, pieces - begins, pa.array(crc, pa.int64()), totals, self.next + window, begins - window_start]
        out = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(np.int64)) for x in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])
        self.next += len(cuts)
        done = cuts[-1]
        left, at = [], 0
        for doc_id, n, before, tokens, ends in self.docs:
            stop = at + len(tokens)
            if stop > done:
                skip = max(0, done - at)
                left.append((doc_id, n, before + skip, tokens[skip:], ends[skip:]))
            at = stop
        self.docs, self.held = left, int(doc_ends[-1]) - done
        return out


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents, cut by least cost.

    ``tokenizer`` is the path of a tokenizer file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        stretch = Stretch(size, TaskContext.get().partitionId() << 32)
        tail, mark = np.array([end], np.uint32), np.array([True])
        for batch in slices(batches, "text"):
            names = batch.column(0).to_pylist()
            ids, ends, counts = words.lookup([t or "" for t in texts_of(batch, "text")])
            stops = np.cumsum(counts)
            for name, a, b in zip(names, (stops - counts).tolist(), stops.tolist()):
                stretch.add(name, np.concatenate((ids[a:b], tail)), np.concatenate((ends[a:b], mark)))
                if stretch.held >= STRETCH:
                    yield stretch.flush(False)
        if stretch.docs:
            yield stretch.flush(True)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
