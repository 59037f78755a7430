"""Independent tables side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def side_by_side(work: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Runs ``work`` for each item in a thread of its own and waits for all.

    The threads only submit Spark jobs, so a small table does not keep the
    cluster idle while it is the only one at work.
    """
    items = list(items)
    # Threads take over the job group, tags and pool of the caller.
    work = inheritable_thread_target(SparkSession.active())(work)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        # Each thread has a copy of the caller's context, such as the owner of scratch tables.
        running = [pool.submit(copy_context().run, work, item) for item in items]
        return [future.result() for future in running]


def raise_all(problems: list[Exception], message: str) -> None:
    if len(problems) == 1:
        raise problems[0]
    if problems:
        raise ExceptionGroup(message, problems)
