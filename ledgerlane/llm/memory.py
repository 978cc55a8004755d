"""Memory of Python workers, which Spark keeps alive between tasks.

Several stages run one after the other in the same executor. What a worker's allocators keep of the texts of one
stage is missing to the next, whose tasks may run in other workers of that executor.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa


def give_back() -> None:
    """Return to the system what Arrow and the C library keep of memory that was freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def mapped(function: Callable[[pd.Series], pd.Series], batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``function`` of every batch of a column of texts; memory is given back after each and at the end."""
    for texts in batches:
        found = function(texts)
        del texts
        yield found
        del found
        give_back()
    give_back()
