"""Quality by compression: text resembles what a dictionary of like text compresses well.

Two zstandard dictionaries of at most DICTIONARY_BYTES hold good and bad labelled text: all of it where that fits, else an
equal share of each text, taken in STRETCHES evenly spread from its first to its last byte.  A text is compressed in pieces of PIECE bytes
with each of them; the difference (bad size - good size) / bytes, averaged over the whole text, is positive for text like
the good sample.  A logistic curve, fitted on labelled rows that the dictionaries do not hold, turns it into a score.

The fit takes at most SAMPLE labelled rows per label, the smallest hashes of the id, of at most SAMPLE_CHARS characters;
scoring reads every row whole and uses nothing but its text.

Results: null and empty texts score as a difference of 0; repeated rows score alike; a document labelled both ways counts
for both; null labels, ids and labelled texts are not learned from; without both labels every score is the share of label
1 among the sample, or 0.5 without any; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import per_slice, record_batch, texts_of

SAMPLE, SAMPLE_CHARS = 2000, 20_000
DICTIONARY_BYTES, PIECE, LEVEL, STRETCHES = 1 << 20, 2048, 3, 4
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
        made = []
        for content in (self.bad, self.good):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=held, compression_params=params))
        return made

    def score(self, difference: float) -> float:
        x = self.slope * difference + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def difference(text: str | None, compressors: list) -> float:
    """(bad - good) compressed bytes per byte of text; 0 for no text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0
    bad, good = compressors
    pieces = [data[a : a + PIECE] for a in range(0, len(data), PIECE)]
    return sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces) / len(data)


def _stretches(data: bytes, share: int) -> bytes:
    """``share`` bytes of ``data`` in STRETCHES pieces, the first at its start and the last at its end."""
    if len(data) <= share:
        return data
    size = max(1, (share - STRETCHES + 1) // STRETCHES)
    return b"\n".join(data[a : a + size] for a in ((len(data) - size) * k // (STRETCHES - 1) for k in range(STRETCHES)))


def _dictionary(texts: list[str]) -> bytes:
    """The texts, or what they leave to each other of DICTIONARY_BYTES: shorter ones whole, longer ones in stretches."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    share, room, left = DICTIONARY_BYTES, DICTIONARY_BYTES - len(data), len(data)
    for size in sorted(map(len, data)):
        share = room // left
        if size > share:
            break
        room, left = room - size, left - 1
    return b"\n".join(_stretches(d, max(share, 64)) for d in data)[:DICTIONARY_BYTES] or b"\n" * 8


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), by Newton steps on standardised x with a slight pull to a zero slope."""
    mean, scale = x.mean(), x.std() or 1.0
    z = np.stack([(x - mean) / scale, np.ones_like(x)], axis=1)
    w, pull = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (p - y) + pull @ w)
        w -= np.clip(step, -4, 4)
        if abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def learn(rows: list[tuple[str, int]]) -> Model:
    """A model from (text, label) rows: every other one goes into the dictionaries, the rest are for the curve."""
    by = {label: [t for t, y in rows if y == label] for label in (0, 1)}
    share = len(by[1]) / len(rows) if rows else 0.5
    flat = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if min(map(len, by.values())) < 2:
        return Model(b"\n" * 8, b"\n" * 8, 0.0, flat)
    held = {label: [t for k, t in enumerate(texts) if k % 2 == 0] for label, texts in by.items()}
    rest = [(t, label) for label, texts in by.items() for k, t in enumerate(texts) if k % 2]
    model = Model(_dictionary(held[1]), _dictionary(held[0]), 0.0, 0.0)
    compressors = model.compressors()
    x = np.array([difference(t, compressors) for t, _ in rest])
    slope, offset = _logistic(x, np.array([y for _, y in rest], float))
    return Model(model.good, model.bad, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from the labelled rows of ``docs``; whatever must stay unseen is left out of ``labels`` beforehand."""
    named = labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").distinct()
    # the shorter texts first narrows to rows that exist and fit; then the smallest hashes of each label
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    chosen = [named.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(2 * SAMPLE) for y in (0, 1)]
    found = texts.join(F.broadcast(chosen[0].union(chosen[1])), "id").dropDuplicates(["id", "label"])  # at most 4 * SAMPLE ids
    found = found.withColumn("place", F.xxhash64("id"))
    rows = [r for y in (0, 1) for r in found.where(F.col("label") == y).orderBy("place", "id").limit(SAMPLE).collect()]
    return learn([(r.text, r.label) for r in rows])


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more like the good sample)."""
    schema = T.StructType([*[f for f in docs.schema if f.name != "score"], T.StructField("score", T.DoubleType())])

    def run(batches):
        compressors = model.compressors()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.score(difference(t, compressors)) for t in texts_of(batch, text)]
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "score"]
            return record_batch(schema, [*columns, found])

        yield from per_slice(text, work)(batches)

    return docs.mapInArrow(run, schema)
