"""Language identification in two steps: the family first, then one-versus-one separators of its languages.

Features are the letters of a text in lower case, hashed as runs of one to four bytes (other characters count as one
space), square-rooted and scaled to length 1.  Linear support vector machines tell families apart (each against the
rest) and, within the family that wins, each pair of languages; the language with most votes wins, the larger margin
deciding ties.  Languages without a known family are a family of their own.

The fit takes at most SAMPLE rows per language of at most SAMPLE_CHARS characters, the smallest hashes of the id, and fewer
per language (LEAST_SAMPLE at least) once all languages together would have over SAMPLE_ROWS: the driver gets their feature
vectors.  Every language with a labelled text of that size is learned, however many there are.  Predictions read whole
texts and nothing else.

Results: text that is null or holds no letter is ``und`` with score 0; so is every text if nothing could be learned;
rows without id, language or letters are not learned from; of rows that repeat an id the smallest text is;
repeated rows are predicted alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import per_slice, record_batch, texts_of

UNDETERMINED = "und"
SAMPLE, SAMPLE_CHARS = 400, 20_000
SAMPLE_ROWS, LEAST_SAMPLE = 24_000, 8
DIMENSIONS = 1 << 13

#: Languages by family, as ISO 639-1 codes (fixed values).
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang.split("-")[0].lower() in members), lang)


def _letters_table() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    for b in [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]:
        table[b] = b
    return table


_LETTERS = _letters_table()
#: Odd multipliers of the run hashes (fixed values).
_RUNS = ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D), (4, 0x27D4EB2F))


def features(text: str | None) -> np.ndarray:
    """A vector of length 1, or zeros for a text without letters."""
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    raw = _LETTERS[np.frombuffer(b" " + data + b" ", np.uint8)]
    spaces = raw == 32
    b = raw[~(spaces & np.concatenate(([False], spaces[:-1])))].astype(np.uint32)  # runs of spaces as one
    counts = np.zeros(DIMENSIONS)
    value = np.zeros(len(b), np.uint32)
    for n, odd in _RUNS:
        if len(b) < n:
            break
        value = value[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :]
        counts += np.bincount((value * np.uint32(odd)) >> np.uint32(32 - 13), minlength=DIMENSIONS)
    out = np.sqrt(counts)
    length = math.sqrt(float(counts.sum()))
    return (out / length if length and len(b) > 1 else out * 0).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, epochs: int = 12, penalty: float = 1e-4) -> np.ndarray:
    """Weights (last: offset) of a linear SVM for labels -1 and 1: averaged sub-gradient steps on the hinge loss."""
    rng = np.random.default_rng(42)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)  # both sides weigh alike
    w, mean, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    for epoch in range(epochs):
        for block in np.array_split(rng.permutation(len(x)), max(1, len(x) // 16)):
            step += 1
            rate = 1 / (penalty * (step + 100))
            wrong = y[block] * (x[block] @ w) < 1
            gradient = ((share[block] * y[block] * wrong)[:, None] * x[block]).mean(axis=0)
            w = (1 - rate * penalty) * w + rate * gradient
        if epoch >= epochs // 2:
            mean += w
    return (mean / (epochs - epochs // 2)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not text or not any(c.isalpha() for c in text):
            return UNDETERMINED, 0.0
        x = np.append(features(text), np.float32(1))
        sure, name = 1.0, self.families[0]
        if self.family_weights is not None:
            margins = self.family_weights @ x
            best = int(margins.argmax())
            name, sure = self.families[best], _confidence(margins[best])
        members = self.languages[name]
        if len(members) == 1:
            return members[0], sure
        margins = self.pairs[name] @ x
        votes = {m: [0, 0.0] for m in members}
        for (a, b), m in zip(combinations(members, 2), margins.tolist()):
            winner = a if m >= 0 else b
            votes[winner][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        lang = max(members, key=lambda m: votes[m])
        against = [m if a == lang else -m for (a, b), m in zip(combinations(members, 2), margins.tolist()) if lang in (a, b)]
        return lang, sure * _confidence(min(against))


def _confidence(margin: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, 2 * float(margin)))))


def learn(vectors: np.ndarray, langs: list[str]) -> Model:
    """A model from feature vectors and their languages."""
    known = sorted(set(langs))
    if not known:
        return Model()
    families: dict[str, list[str]] = {}
    for lang in known:
        families.setdefault(family_of(lang), []).append(lang)
    names, tags = sorted(families), np.array(langs)
    own = np.array([family_of(x) for x in langs])
    weights = np.stack([svm(vectors, np.where(own == n, 1.0, -1.0)) for n in names]) if len(names) > 1 else None
    pairs = {}
    for name, members in families.items():
        if len(members) > 1:
            rows = []
            for a, b in combinations(members, 2):
                among = (tags == a) | (tags == b)
                rows.append(svm(vectors[among], np.where(tags[among] == a, 1.0, -1.0)))
            pairs[name] = np.stack(rows)
    return Model(names, weights, families, pairs)


def fit(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from rows with text and language; whatever must stay unseen is left out of ``labelled`` beforehand."""
    rows = labelled.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"\p{L}"))
    known = rows.select("lang", "id").distinct().withColumn("place", F.xxhash64("id"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row a language
    each = max(LEAST_SAMPLE, min(SAMPLE, SAMPLE_ROWS // max(1, len(counts))))
    # hashes spread evenly: this share of them holds well over ``each`` ids of a language, and no task gets many more
    limits = [(lang, (1 << 63) - 1 if n <= 8 * each else int((1 << 64) * 4 * each / n) - (1 << 63)) for lang, n in counts.items()]
    limit = labelled.sparkSession.createDataFrame(limits, "lang string, below long")
    order = Window.partitionBy("lang").orderBy("place", "id")
    near = known.join(F.broadcast(limit), "lang").where(F.col("place") <= F.col("below"))
    ids = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each)
    chosen = F.broadcast(ids.select("lang", "id"))  # at most SAMPLE_ROWS, or LEAST_SAMPLE a language
    ranked = rows.join(chosen, ["lang", "id"]).groupBy("lang", "id").agg(F.min("text").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = [features(t).astype("<f4").tobytes() for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], names=["lang", "id", "vector"])

    found = sorted(ranked.mapInArrow(per_slice("text", work), "lang string, id long, vector binary").collect(), key=lambda r: (r.lang, r.id is None, r.id, bytes(r.vector)))
    vectors = np.stack([np.frombuffer(r.vector, "<f4") for r in found]) if found else np.zeros((0, DIMENSIONS), np.float32)
    return learn(vectors, [r.lang for r in found])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of ``text``."""
    added = ("lang_pred", "score")
    keep = [f.name for f in docs.schema if f.name not in (text, *added)]
    schema = T.StructType([*[docs.schema[n] for n in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t) for t in texts_of(batch, text)]
        columns = [batch.column(batch.schema.get_field_index(n)) for n in keep]
        return record_batch(schema, [*columns, [f[0] for f in found], [f[1] for f in found]])

    return docs.mapInArrow(per_slice(text, work), schema)
