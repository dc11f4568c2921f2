"""One model per backend and Python worker process.

This module is imported on the worker, so its dictionary lives as long as the process; a
function that Spark ships by value would bring an empty one of its own to every task.
"""

from __future__ import annotations

from collections.abc import Callable

_MODELS: dict[str, object] = {}


def get(key: str, factory: Callable[[], object]):
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]
