"""The registered queries of this subpackage, each over its whole table, and the SQL that checks those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import chat, decontam, langid, licenses, linededup, merkle, negatives, packing, pii, quality, simhash, topk, wrappers
from silverlode.llm.common import ascii_lower, id_remainder
from silverlode.session import materialize, tune

#: Key of the registered pseudonym query; a real run passes its own secret.
PSEUDONYM_KEY = b"registered query"


def tokenizer_path(name: str = packing.TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{table}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(read(spark, folder, "documents"), shingle=3, words=1, budget=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", linededup.host_of(F.col("url")).alias("host"), linededup.visible_lines(F.col("html")).alias("text"))
    found = linededup.without_boilerplate(materialize(pages, "visible"), F.col("host"), unit=None)
    return found.select("page_id", "host", F.col("lines_before").cast("long").alias("lines_before"), F.col("lines_dropped").cast("long").alias("lines_dropped"), "text")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    remainder = id_remainder(F.col("doc_id"), 3)
    model = langid.fit(docs.where(remainder != 1))
    return langid.identify(docs.select("doc_id", (remainder == 1).alias("held_out"), "text"), model)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_path())


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    remainder = id_remainder(F.col("doc_id"), 5)
    model = quality.fit(docs, read(spark, folder, "labels").where(remainder != 0))
    found = quality.scores(docs.withColumn("held_out", remainder == 0), model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.private(read(spark, folder, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatted(read(spark, folder, "conversations"))


def op10_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(docs, F.col("lang"), F.col("doc_id"), fields, [*fields[:-1], changed])
    text = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof_sha256": "proof", "folded_root": "folded"}
    return found.select(F.col("order").alias("doc_id"), *[F.lower(F.hex(c)).alias(name) for name, c in text.items()], (F.col("folded") == F.col("root")).alias("verified"))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_html(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_texts(read(spark, folder, "pages"))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_HTML = "html"
for _pattern in linededup._HIDDEN:
    _HTML = f"regexp_replace({_HTML}, '{_pattern}', '', 'gis')"
_HTML = rf"regexp_replace({_HTML}, '[\r\n]+', ' ', 'g')"
_HTML = f"regexp_replace({_HTML}, '{linededup._BLOCK}', chr(10), 'gis')"
_HTML = f"regexp_replace({_HTML}, '<[^>]*>', '', 'gs')"
_NORMAL = r"trim(regexp_replace(x, '[\x09-\x0D\x20]+', ' ', 'g'))"

OP3_SQL = f"""
WITH p AS (
  SELECT page_id, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host, {_HTML} AS text FROM pages
), seen AS (
  SELECT host, text, min(second) OVER (PARTITION BY host, first) AS class
  FROM (SELECT host, text, list_min(digests) AS first, list_min(list_transform(digests, lambda x: substr(x, 17, 16))) AS second
    FROM (SELECT host, text, list_transform(CASE WHEN len(s) > 0 THEN s ELSE [text] END, lambda x: md5(x)) AS digests
      FROM (SELECT host, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_NORMAL}), lambda x: x <> '') AS s
        FROM (SELECT DISTINCT host, text FROM p WHERE text IS NOT NULL))))
), hosts AS (SELECT host, count(DISTINCT class) AS pages FROM seen GROUP BY host),
lines AS (
  SELECT host, line, count(DISTINCT class) AS n
  FROM (SELECT host, class, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: {_NORMAL}))) AS line FROM seen)
  WHERE line <> '' GROUP BY host, line
), bad AS (
  SELECT l.host, list(l.line) AS lines FROM lines l JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host
  WHERE n >= {linededup.LEAST} AND n > pages * {linededup.RATIO} GROUP BY l.host
), kept AS (
  SELECT page_id, p.host, p.text, string_split(p.text, chr(10)) AS all_lines,
         list_filter(string_split(p.text, chr(10)), lambda x: NOT coalesce(list_contains(b.lines, {_NORMAL}), false)) AS left_lines
  FROM p LEFT JOIN bad b ON p.host IS NOT DISTINCT FROM b.host
)
SELECT page_id, host, coalesce(CAST(len(all_lines) AS BIGINT), 0) AS lines_before,
       coalesce(CAST(len(all_lines) - len(left_lines) AS BIGINT), 0) AS lines_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(left_lines, chr(10)) END AS text
FROM kept
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS alike, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.id % 100 = 0 AND c.id <> a.id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

def _merkle_sql(levels: int = 8) -> str:
    """Levels of both trees one after another, each node as the hash of its run; good for 8 ** levels rows of a language."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    # CRC-32 of the id's digits, bit by bit
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    crc = f"xor(list_reduce({bits}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"docs AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS tampered FROM documents)",
        "a0 AS (SELECT doc_id, lang, leaf, tampered, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM docs)",
        "n0 AS (SELECT lang, k, n, leaf AS d FROM a0)",
        "p0 AS (SELECT doc_id, lang, leaf, k, n, tampered AS folded, '' AS proof FROM a0)",
    ]

    def tree(nodes: str, paths: str, key: str) -> None:
        """CTEs for each level: the nodes above, and each row's way over its siblings."""
        for h in range(levels):
            parts.append(
                f"{nodes}{h + 1} AS (SELECT {key}, k // 8 AS k, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY k)) END AS d "
                f"FROM {nodes}{h} GROUP BY {key}, k // 8, n)"
            )
            parts.append(
                f"{paths}{h + 1} AS (SELECT p.* EXCLUDE (k, n, folded, proof), p.k // 8 AS k, (p.n + 7) // 8 AS n, "
                "CASE WHEN p.n = 1 THEN p.folded ELSE sha256(coalesce(s.l, '') || p.folded || coalesce(s.r, '')) END AS folded, p.proof || coalesce(s.l, '') || coalesce(s.r, '') AS proof "
                f"FROM {paths}{h} p LEFT JOIN (SELECT me.{key} AS g, me.k AS k, string_agg(o.d, '' ORDER BY o.k) FILTER (o.k < me.k) AS l, string_agg(o.d, '' ORDER BY o.k) FILTER (o.k > me.k) AS r "
                f"FROM {nodes}{h} me JOIN {nodes}{h} o ON me.{key} IS NOT DISTINCT FROM o.{key} AND me.k // 8 = o.k // 8 AND me.k <> o.k GROUP BY ALL) s ON s.g IS NOT DISTINCT FROM p.{key} AND s.k = p.k)"
            )

    tree("n", "p", "lang")
    parts.append(f"sub AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM n{levels})")
    parts.append("t0 AS (SELECT 0 AS one, k, n, subroot AS d FROM sub)")
    parts.append(f"q0 AS (SELECT p.doc_id, p.leaf, s.subroot, 0 AS one, s.k, s.n, p.folded, p.proof FROM p{levels} p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang)")
    tree("t", "q", "one")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.d AS verified "
        f"FROM q{levels} q JOIN t{levels} t ON q.one = t.one"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk, op2_simhash, op3_line_dedup, op4_language, op5_licenses, op6_packing, op7_quality, op8_pii, op9_chat, op10_decontam, op11_merkle, op12_negatives, op13_html)
}
ORACLE_SQL: dict[str, str] = {"op1_topk": OP1_SQL, "op3_line_dedup": OP3_SQL, "op11_merkle": _merkle_sql(), "op12_negatives": OP12_SQL}
