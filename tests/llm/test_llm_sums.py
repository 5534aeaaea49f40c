"""Sums of looked-up rows are those of plain numpy."""

import numpy as np

from silverlode.llm import decontam


def test_sums_of_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(-9, 9, (500, 8)).astype(np.float32)
    lengths = np.concatenate((rng.integers(1, 17, 700), [1, 16, 17, 300, 32]))
    for run in (lengths, lengths[:700]):
        index = rng.integers(0, 500, run.sum()).astype(np.uint32)
        starts = np.cumsum(run) - run
        assert (decontam._sums_of_rows(rows, index, starts) == np.add.reduceat(rows[index], starts, axis=0)).all()
