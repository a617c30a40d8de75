"""Memory of Python workers, which Spark keeps for the tasks of later stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def tidy(rows: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``rows`` for ``mapInArrow``; at its end the worker gives back what its allocators hold without need.

    An idle worker would keep the memory of its largest batches while others work beside it.
    """

    @wraps(rows)
    def run(batches: Batches) -> Batches:
        try:
            yield from rows(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return run
