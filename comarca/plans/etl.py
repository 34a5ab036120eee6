"""The run that joins the phases: extract, transform, load.

As in a scheduled run, each phase hands Parquet to the next. The source text is
parsed once however many targets there are, a file that breaks while it is read
stops its own source only, row counts come from file footers, and lost executors
cost no more than the phase they were working on. Within a phase the sources, which do not
depend on each other, go side by side: each has a driver thread, a job group and a
scheduler pool of its own, so that small ones do not wait for large ones and the jobs of
one that fails can be ended without the others'.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators.combine import union_all
from comarca.operators.quality import completeness
from comarca.plans import indicators, industry, population
from comarca.plans.steps import StepLog
from comarca.schemas import REJECTED_CELLS
from comarca.session import scratch_path
from comarca.sinks.files import stage_parquet
from comarca.sinks.registry import Loader, LoadLog, expand_targets, load_all
from comarca.sources.delimited import rejected_cells
from comarca.sources.registry import Reader, empty_table, extract_all

log = logging.getLogger("comarca")

Transform = Callable[[DataFrame, StepLog], DataFrame]

TRANSFORMS: dict[str, Transform] = {
    "despoblamiento": indicators.transform,
    "poblacion": population.transform,
    "industria": industry.transform,
}

_METRICS = "phase string, source string, target string, rows long, success boolean, seconds double"


def transform_all(
    data: Mapping[str, DataFrame],
    transforms: Mapping[str, Transform] = TRANSFORMS,
    logs: dict[str, StepLog] | None = None,
    errors: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Transforms each source that has a transform and rows; a failing one keeps its input."""
    transformed = {}
    for name, df in data.items():
        transformed[name] = df
        if name not in transforms:
            continue
        steps = StepLog()
        try:
            if not df.isEmpty():
                transformed[name] = transforms[name](df, steps)
        except Exception as error:
            log.error("transformation of %s failed: %s", name, error)
            if errors is not None:
                errors[name] = str(error)
        if logs is not None:
            logs[name] = steps
    return transformed


@dataclass
class Run:
    """One run over a set of sources."""

    spark: SparkSession
    readers: Mapping[str, Reader]
    loaders: Mapping[str, Loader]
    targets: list[str] = field(default_factory=lambda: ["table"])
    transforms: Mapping[str, Transform] = field(default_factory=lambda: dict(TRANSFORMS))
    # Whether a source whose transform failed is loaded as it was read.
    load_untransformed: bool = False
    # Where phases leave their Parquet; a fresh folder unless named. A named one serves one
    # run and a later run of its load phase.
    staging: str | None = None
    # Sources at work at a time.
    threads: int = 8

    def __post_init__(self) -> None:
        self.targets = expand_targets(self.targets)
        self.staging = self.staging or scratch_path(self.spark, "run")
        self.errors: dict[str, str] = {}
        self.steps: dict[str, StepLog] = {}
        self.loads = LoadLog()
        self.transformed: dict[str, DataFrame] = {}
        self._lost: dict[str, DataFrame] = {}
        self._metrics: list[tuple] = []

    def _measure(self, phase: str, source: str, target: str | None, rows: int | None, ok: bool, start: float) -> None:
        self._metrics.append((phase, source, target, rows, ok, time.monotonic() - start))

    def _stage(self, phase: str, name: str, df: DataFrame, fallback: DataFrame) -> DataFrame:
        start = time.monotonic()
        ok = name not in self.errors
        try:
            # What failed is kept apart, so that a later load does not take it.
            staged = stage_parquet(df, f"{self.staging}/{phase if ok else f'{phase}-failed'}/{name}")
            rows = staged.count()
        except Exception as error:
            log.error("%s of %s failed: %s", phase, name, error)
            self.errors[name] = str(error)
            staged, ok, rows = fallback, False, 0
        self._measure(phase, name, None, rows, ok, start)
        return staged

    def _side_by_side(self, phase: str, work: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
        """Results of one call per source, in the given order; a call that raises does so here."""
        context, done = self.spark.sparkContext, len(self._metrics)

        def alone(name: str, call: Callable[[], Any]) -> Any:
            group = f"{self.staging}/{phase}/{name}"
            context.setJobGroup(group, f"{phase} of {name}", interruptOnCancel=True)
            context.setLocalProperty("spark.scheduler.pool", name)
            failed = len(self.errors)
            try:
                return call()
            finally:
                if len(self.errors) > failed and name in self.errors:
                    # What a failed source still has running goes with it.
                    context.cancelJobGroup(group)

        with ThreadPoolExecutor(max(1, min(len(work), self.threads))) as pool:
            running = {
                name: pool.submit(inheritable_thread_target(self.spark)(partial(alone, name, call)))
                for name, call in work.items()
            }
            results = {name: call.result() for name, call in running.items()}
        place = {name: i for i, name in enumerate(work)}
        self._metrics[done:] = sorted(self._metrics[done:], key=lambda m: place.get(m[1], 0))
        return results

    def extract(self) -> dict[str, DataFrame]:
        def one(name: str, reader: Reader) -> DataFrame:
            df = extract_all(self.spark, {name: reader}, self.errors)[name]
            return self._stage("extract", name, df, empty_table(self.spark))

        staged = self._side_by_side("extract", {name: partial(one, name, read) for name, read in self.readers.items()})
        # The staged copy holds rows and lost cells, so the text was parsed once for both.
        self._lost = {name: df for name, df in staged.items() if REJECTED_CELLS in df.columns}
        return {name: df.drop(REJECTED_CELLS) for name, df in staged.items()}

    def rejected_cells(self) -> DataFrame:
        """``(source, source_file, column, text)`` of every cell that was filled but no value of its column's type."""
        none = self.spark.createDataFrame([], "source string, source_file string, column string, text string")
        lost = [rejected_cells(df, REJECTED_CELLS).select(F.lit(name).alias("source"), "*") for name, df in self._lost.items()]
        return union_all([none, *lost])

    def transform(self, data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        def one(name: str, df: DataFrame) -> DataFrame:
            done = transform_all({name: df}, self.transforms, self.steps, self.errors)[name]
            return self._stage("transform", name, done, df)

        self.transformed = self._side_by_side("transform", {name: partial(one, name, df) for name, df in data.items()})
        return self.transformed

    def load(self, data: Mapping[str, DataFrame]) -> dict[str, dict[str, bool]]:
        def one(target: str, name: str, df: DataFrame) -> tuple[LoadLog, bool]:
            start, record = time.monotonic(), LoadLog()
            ok = load_all({name: df}, target, self.loaders, record)[name]
            self._measure("load", name, target, record.entries[0][2] if record.entries else 0, ok, start)
            return record, ok

        results: dict[str, dict[str, bool]] = {}
        for target in self.targets:
            # An unknown target is an error of the run, whatever there is to load.
            load_all({}, target, self.loaders)
            loaded = self._side_by_side(f"load-{target}", {name: partial(one, target, name, df) for name, df in data.items()})
            for record, _ in loaded.values():
                self.loads.entries += record.entries
            results[target] = {name: ok for name, (_, ok) in loaded.items()}
        return results

    def load_staged(self) -> bool:
        """The load phase alone, over what the transform phase left in ``staging``."""
        data = {}
        for name in self.readers:
            try:
                data[name] = self.spark.read.parquet(f"{self.staging}/transform/{name}")
            except AnalysisException as error:
                log.error("%s is not staged: %s", name, error)
                self.errors[name] = str(error)
        try:
            results = self.load(data)
        except Exception as error:
            log.error("load failed: %s", error)
            return False
        return not self.errors and all(ok for loaded in results.values() for ok in loaded.values())

    def run(self) -> bool:
        """All phases; True only if nothing failed and every source reached every target.

        A source that failed to transform leaves what its targets hold as it is,
        unless ``load_untransformed`` asks for its rows as they were read.
        """
        try:
            raw = self.extract()
            unread = set(self.errors)
            done = self.transform(raw)
            if not self.load_untransformed:
                done = {name: df for name, df in done.items() if name not in self.errors or name in unread}
            results = self.load(done)
        except Exception as error:
            log.error("run failed: %s", error)
            return False
        return not self.errors and all(ok for loaded in results.values() for ok in loaded.values())

    def quality(self) -> DataFrame:
        """Completeness of every transformed source that has rows."""
        return union_all([completeness(df, name) for name, df in self.transformed.items() if not df.isEmpty()])

    def metrics(self) -> DataFrame:
        """``(phase, source, target, rows, success, seconds)`` of everything done so far."""
        return self.spark.createDataFrame(self._metrics, _METRICS)
