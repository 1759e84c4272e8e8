"""Stage runner: named stages over written tables, with a manifest, skipping and timing."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .params import Params

Stage = Callable[[SparkSession, dict[str, DataFrame], Params], dict[str, DataFrame]]


@dataclass
class Report:
    """What became of each stage: done, skipped, kept (its outputs exist) or failed, with seconds and rows."""

    rows: list[tuple[str, str, float, int]] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "stage string, status string, seconds double, rows long")


class Pipeline:
    """Stages in order; each reads the tables of those before it and writes its own under ``folder``."""

    def __init__(self, stages: Sequence[tuple[str, tuple[str, ...], Stage]], folder: str):
        self.stages, self.folder = list(stages), folder

    def _existing(self, spark: SparkSession, name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return None

    def run(
        self, spark: SparkSession, params: Params, only: Sequence[str] | None = None, skip: Sequence[str] | None = None, overwrite: bool = False
    ) -> Report:
        """Run all stages, those of ``only``, or all but ``skip`` (not both); finished outputs are kept unless ``overwrite``."""
        if only and skip:
            raise ValueError("give either stages to run or stages to skip")
        unknown = {*(only or ()), *(skip or ())} - {name for name, _, _ in self.stages}
        if unknown:
            raise KeyError(f"unknown stages: {sorted(unknown)}")
        report, tables = Report(), {}
        for name, outputs, stage in self.stages:
            began, rows = time.time(), 0
            there = {o: self._existing(spark, o) for o in outputs}
            complete = all(df is not None for df in there.values())
            if (only and name not in only) or (skip and name in skip):
                status = "skipped"
            elif complete and not overwrite:
                status = "kept"
            else:
                try:
                    made = stage(spark, tables, params)
                    for output in outputs:
                        made[output].write.mode("overwrite").parquet(f"{self.folder}/{output}")
                    there = {o: self._existing(spark, o) for o in outputs}
                    rows = sum(df.count() for df in there.values())
                    status = "done"
                except Exception:
                    report.rows.append((name, "failed", time.time() - began, 0))
                    raise
            tables |= {o: df for o, df in there.items() if df is not None}
            report.rows.append((name, status, time.time() - began, rows))
        return report


def replace_round(table: DataFrame, redone: DataFrame, number: int, column: str = "round") -> DataFrame:
    """``table`` with one round's rows taken from ``redone``."""
    return table.filter(~F.col(column).eqNullSafe(F.lit(number))).unionByName(redone.filter(F.col(column) == number).select(*table.columns))


def rewrite_round(redone: DataFrame, path: str, column: str = "round") -> None:
    """Overwrite in a stored table, partitioned by round, the rounds that ``redone`` holds and no others."""
    redone.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def pass_through(files: DataFrame, source: str, target: str, chosen: Column) -> DataFrame:
    """``files`` (stage, path, ...) with the chosen ones of stage ``source`` standing for themselves in ``target``, too."""
    linked = files.filter((F.col("stage") == source) & chosen).withColumn("stage", F.lit(target))
    return files.unionByName(linked)


def sweep(grid: dict[str, Sequence], run: Callable[..., DataFrame]) -> DataFrame:
    """The results of ``run`` for every combination of parameters, which stand before them as columns."""
    out = None
    for values in itertools.product(*grid.values()):
        named = dict(zip(grid, values))
        part = run(**named)
        part = part.select(*(F.lit(v).alias(n) for n, v in named.items()), *part.columns)
        out = part if out is None else out.unionByName(part)
    return out
