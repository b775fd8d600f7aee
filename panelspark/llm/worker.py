"""Objects that a Python worker keeps between its tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

MODULE = "panelspark_kept_in_worker"


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, once per worker process and key. Functions of this package travel by value, so that their own
    module variables would be new for every task."""
    objects = sys.modules.setdefault(MODULE, types.ModuleType(MODULE)).__dict__
    if key not in objects:
        objects[key] = make()
    return objects[key]
