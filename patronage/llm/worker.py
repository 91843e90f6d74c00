"""What a Python worker keeps from one task to the next: one thing at a time.

Spark reuses workers over stages, so what each operator keeps for itself would add up over a pipeline.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: tuple[Hashable, Any] = (None, None)


def keep(key: Hashable, make: Callable[[], Any]) -> Any:
    """The thing kept under the key, made if it isn't there; anything else that was kept goes first."""
    global _kept
    if _kept[0] != key:
        _kept = (None, None)
        _kept = (key, make())
    return _kept[1]
