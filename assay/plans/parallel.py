"""Run independent small result plans side by side.

Per-table (or per-column-batch) metric plans are independent Spark jobs.
Submitting them from a few driver threads lets the scheduler overlap them
(Spark's documented way to run concurrent jobs in one application), and
keeps every plan small. Each result is checkpointed - a few rows per plan -
so the union that follows reads stored rows, never the data again.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame

from assay.session import materialize

MAX_PARALLEL = 8


def _materialize(frame) -> DataFrame:
    return materialize(frame() if callable(frame) else frame)


def materialize_all(frames: Sequence, max_parallel: int = MAX_PARALLEL) -> list[DataFrame]:
    """Checkpoint every frame (or zero-argument frame builder), up to ``max_parallel`` jobs at a time."""
    frames = list(frames)
    if len(frames) <= 1 or max_parallel <= 1:
        return [_materialize(f) for f in frames]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(frames))) as pool:
        return list(pool.map(_materialize, frames))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of frames with the same columns."""
    return reduce(DataFrame.unionByName, frames)


def materialized_union(frames: Sequence[DataFrame], max_parallel: int = MAX_PARALLEL) -> DataFrame:
    return union_all(materialize_all(frames, max_parallel))


def _isolated(df: DataFrame, todo: list, name: str) -> list[DataFrame]:
    """Materialized metrics of ``todo``; analyzers that fail while running become failed metrics.

    A plan that fails is halved until the culprits stand alone, so one bad rule costs a few
    extra small jobs and the others keep their values. If not even the row count can be
    computed, the input itself is unreadable and the error is raised.
    """
    from assay.operators.analyzers import Size, failed_metrics, run_part

    try:
        return [materialize(run_part(df, todo, name))]
    except Exception as e:  # noqa: BLE001 - any error of the plan
        materialize(run_part(df, [(0, Size())], name))
        if len(todo) == 1:
            return [failed_metrics(df.sparkSession, todo, name, str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__)]
        half = len(todo) // 2
        return _isolated(df, todo[:half], name) + _isolated(df, todo[half:], name)


def compute_metrics(
    tables: dict[str, tuple[DataFrame, Sequence]],
    max_columns: int = 32,
    max_parallel: int = MAX_PARALLEL,
) -> DataFrame:
    """Materialized long-form metrics of several tables: ``{name: (df, analyzers)}``.

    Every table is split into bounded plans (see ``analyzer_plans``); all
    plans of all tables run side by side and their rows are unioned. An
    analyzer that cannot be computed yields a failed metric with a message.
    """
    from assay.operators.analyzers import dedupe, empty_metrics, plan_parts

    jobs = [
        (df, part, name)
        for name, (df, analyzers) in tables.items()
        for part in plan_parts(df, list(enumerate(dedupe(analyzers))), max_columns)
    ]
    # plans are built in the worker threads as well, so building overlaps running
    done = [d for frames in map_tables(lambda j: _isolated(*j), jobs, max_parallel) for d in frames]
    if not done:
        return empty_metrics(next(iter(tables.values()))[0].sparkSession)
    return union_all(done)


def profile_tables(
    tables: dict[str, DataFrame],
    max_columns: int = 32,
    max_parallel: int = MAX_PARALLEL,
) -> DataFrame:
    """Materialized profile metrics of several tables."""
    from assay.operators.profile import profile_analyzers

    return compute_metrics(
        {n: (df, profile_analyzers(df.schema)) for n, df in tables.items()}, max_columns, max_parallel
    )


def map_tables(fn, items: Sequence, max_parallel: int = MAX_PARALLEL) -> list:
    """``fn`` over independent items (e.g. tables) from up to ``max_parallel`` threads, in order."""
    items = list(items)
    if len(items) <= 1 or max_parallel <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(items))) as pool:
        return list(pool.map(fn, items))
