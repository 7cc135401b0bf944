"""What a Python worker keeps from one task to the next, within bounds."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """The value of ``key``, made at the first call; what the worker kept before goes.

    Workers serve one query and stage after the other: the tables of all that they ever ran would add up beside each other.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Known[K, V]:
    """A table of at most about two times ``size`` entries, in two generations.

    When the newer one is full it becomes the older one, and what is asked for again moves on.  So frequent keys stay, and the rare
    ones, most of them seen once, are dropped.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.now: dict[K, V] = {}
        self.old: dict[K, V] = {}

    def missing(self, keys: set[K]) -> list[K]:
        """Those of ``keys`` that have no value in either generation; the others are in ``now`` after this, and so should these be."""
        new = keys.difference(self.now)
        if len(self.now) + len(new) > self.size:
            self.old, self.now = self.now, {}
            new = keys
        found = self.old.keys() & new
        self.now.update(zip(found, map(self.old.__getitem__, found)))
        return list(new - found)
