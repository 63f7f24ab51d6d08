"""Independent writes of a flow, submitted side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def together(*steps: Callable[[], object]) -> list[object]:
    """Run a few steps that do not need each other and return their results.

    Each step is one Spark write.  Submitting them at once lets the tasks of one
    fill the cores another leaves idle.  All steps end before an error is raised.
    """
    if not steps:
        return []
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [job.result() for job in [pool.submit(step) for step in steps]]
