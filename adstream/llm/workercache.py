"""Objects that a Python worker keeps between its tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

_PLACE = "adstream_worker_cache"


def worker_cached(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker process. Only for what can be made again at any time."""
    place = sys.modules.setdefault(_PLACE, ModuleType(_PLACE))
    kept = place.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def worker_latest(name: str, key: Any, make: Callable[[], Any]) -> Any:
    """As ``worker_cached``, but only the newest object of a name is kept."""
    found = worker_cached(("latest", name), dict)
    if key not in found:
        found.clear()
        found[key] = make()
    return found[key]
