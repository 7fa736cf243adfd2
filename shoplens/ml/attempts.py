"""Several fits side by side, none of which may cost the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def attempt_all(spark: SparkSession, fits: Mapping, parallelism: int) -> tuple[dict, dict[object, str]]:
    """Run the fits and return (results, errors) by name, in the order given.

    Iterative fits leave executors idle between their short jobs; side by side they fill
    each other's gaps.
    """

    def attempt(fit: Callable):
        try:
            return fit(), None
        except Exception as error:  # recorded, so that the other fits still count
            return None, str(error)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        target = inheritable_thread_target(spark)(attempt)
        outcomes = dict(zip(fits, pool.map(target, fits.values()), strict=True))
    results = {name: result for name, (result, error) in outcomes.items() if error is None}
    errors = {name: error for name, (_, error) in outcomes.items() if error is not None}
    return results, errors
