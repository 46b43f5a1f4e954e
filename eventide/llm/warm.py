"""What a Python worker keeps between tasks: one object, so that workers shared by several operators stay small."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import Any

_HELD: dict[Hashable, Any] = {}


def warm(key: Hashable, make: Callable[[], Any]) -> Any:
    """The object kept under ``key``; making it lets go of any other first."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Called by tasks that keep nothing, in workers that other operators may have used."""
    if _HELD:
        _HELD.clear()
        gc.collect()  # what was kept may refer to itself
