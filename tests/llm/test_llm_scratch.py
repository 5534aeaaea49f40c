"""What a stage writes for itself goes when it has been read."""

import numpy as np
import pytest

from silverlode import session
from silverlode.llm import decontam, simhash


def texts(n):
    rng = np.random.default_rng(5)
    words = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 60)) for _ in range(n // 2)]
    return [(k, words[k // 2] + (" more" if k % 2 else "")) for k in range(n)]


def kinds(folder):
    return {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if any(f.suffix == ".parquet" for f in p.iterdir())}


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    return tmp_path


def test_near_duplicates_leave_no_shingles(spark, scratch):
    docs = session.materialize(spark.createDataFrame(texts(80), "doc_id long, text string"), "given")
    assert simhash.keep_one(docs).count() == 40
    assert not kinds(scratch) & {"shingles", "candidates"} and "given" in kinds(scratch)


def test_decontamination_leaves_no_words(spark, scratch):
    rows = texts(80)
    docs = session.materialize(spark.createDataFrame(rows, "doc_id long, text string"), "given")
    bench = spark.createDataFrame([(1, rows[4][1]), (2, "eight words that no document of these holds here")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()} == {(4, 1), (5, 1)}
    assert decontam.leaks(docs, bench.limit(0)).count() == 0
    assert not kinds(scratch) & {"words", "terms", "sketch"} and "given" in kinds(scratch)


def test_words_are_written_by_the_stronger_codec(spark):
    rows = decontam.tokens(spark.createDataFrame(texts(20), "doc_id long, text string"))
    assert rows.count() == 20 and rows.inputFiles()
    assert all(".zstd." in file for file in rows.inputFiles())
