"""Levelled sorted runs of distinct keys (a logarithmic index family).

A batch of keys is merge-joined with the runs of all levels, and its new keys
become a level-0 run.  As many runs as ``fanout`` of one level are compacted
into one run of the next, so a key is rewritten a logarithmic number of times
and a batch meets a logarithmic number of runs.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import drop_table, materialize, path_of


def sorted_run(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Write ``rows`` hash-partitioned and sorted by their keys."""
    return materialize(rows.repartition(*keys).sortWithinPartitions(*keys), name)


class SortedRuns:
    def __init__(self, keys: list[str], fanout: int = 2):
        self.keys = keys
        self.fanout = fanout
        self.levels: dict[int, list[DataFrame]] = {}

    def runs(self) -> list[DataFrame]:
        return [run for level in sorted(self.levels) for run in self.levels[level]]

    def mark(self, rows: DataFrame) -> DataFrame:
        """``rows`` (distinct keys) with ``seen``: whether a run has the key."""
        runs = self.runs()
        if not runs:
            return rows.withColumn("seen", F.lit(False))
        # runs are disjoint: a key enters one only if no run had it
        held = reduce(DataFrame.unionByName, runs).withColumn("in_run", F.lit(True))
        return (rows.join(held, self.keys, "left")
                .withColumn("seen", F.coalesce("in_run", F.lit(False))).drop("in_run"))

    def add(self, run: DataFrame, level: int = 0) -> None:
        """Add a run of new keys; full levels are compacted upwards."""
        held = self.levels.setdefault(level, [])
        held.append(run)
        if len(held) >= self.fanout:
            merged = sorted_run(reduce(DataFrame.unionByName, held), self.keys, f"run-{level + 1}")
            for old in self.levels.pop(level):
                if level:  # level 0 is part of a batch's key table, which callers read again
                    drop_table(old.sparkSession, path_of(old))
            self.add(merged, level + 1)
