"""Independent steps of a load, submitted at the same time.

Tables that do not depend on each other fill the cluster better side by side than one after the other: the
last tasks of one leave room for the others.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")


def together(*steps: Callable[[], R]) -> list[R]:
    """Results of the steps, in their order; the first failure is raised."""
    in_thread = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(in_thread(step)) for step in steps]
        return [step.result() for step in running]
