"""Rows as blocks of numbers, for fits that pass over their rows many times.

A block is one table row: up to ``BLOCK_ROWS`` rows as the bytes of a NumPy
array. A pass reads blocks as they are, without a conversion of every row, and
a task holds one block at a time. Blocks are dealt evenly to the cores, however
the input lies in files, so that a pass is one wave of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from pulsekit.session import ship_package

BLOCK_ROWS, PASS_ROWS = 32_768, 1_024  # rows of a block; rows whose intermediate values fit a core's cache


def gathered(parts: Iterator[pd.DataFrame], rows: int = BLOCK_ROWS) -> Iterator[pd.DataFrame]:
    """The same rows in frames of ``rows`` rows, the last one smaller; none is empty."""
    held, n = [], 0
    for part in parts:
        at = 0
        while at < len(part):
            piece = part.iloc[at : at + rows - n]
            held.append(piece)
            at, n = at + len(piece), n + len(piece)
            if n == rows:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def deal(blocks: DataFrame) -> DataFrame:
    return blocks.repartition(max(1, blocks.sparkSession.sparkContext.defaultParallelism))


def number_blocks(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """(by int, x binary): the columns as doubles, row by row; a block holds rows of one value of ``by`` (0 without)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in gathered(parts):
            for key, rows in frame.groupby(by) if by else [(0, frame)]:
                yield pd.DataFrame({"by": [key], "x": [rows[columns].to_numpy(np.float64).tobytes()]})

    ship_package(df.sparkSession)
    rows = df.select(*columns, *([by] if by else []))
    return deal(rows.mapInPandas(run, "by int, x binary"))


def summing(blocks: DataFrame, width: int) -> Callable:
    """``run(part)`` is one pass: the sum of the arrays that ``part`` makes of every task's blocks.

    The driver adds up one array a core, whatever the rows: :func:`deal` makes no more tasks.
    """
    data = blocks.select("x").rdd

    def run(part: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
        def task(rows):
            yield part(np.frombuffer(r.x).reshape(-1, width) for r in rows)

        return data.mapPartitions(task).reduce(np.add)

    return run
