"""Row counts of the stages of a run."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def stage_row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stage with its number of rows. Scans read no columns for it.

    ``quality.watch`` gives the same number for free where the stage is written anyway.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    return functools.reduce(DataFrame.unionAll, counts)
