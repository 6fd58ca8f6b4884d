"""One memory at a time in a Python worker: workers go from task to task, of any kind."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_held: list[tuple[str, Callable[[], None]]] = []


def take(name: str, clear: Callable[[], None]) -> None:
    """Says that ``name``'s memory is in use now; another one that was is cleared."""
    if _held and _held[0][0] == name:
        return
    for _, forget in _held:
        forget()
    pa.default_memory_pool().release_unused()
    _held[:] = [(name, clear)]
