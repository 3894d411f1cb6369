"""What a Python worker keeps of its work, in bounded space."""

from __future__ import annotations

from collections.abc import Callable, Hashable

ENTRY = 130  # bytes that an entry takes besides what is in its key and value
SHARE = 64  # an entry that takes more than this part of a generation is not kept


class Store:
    """Values by key in two generations, each of at most ``limit``.

    What is looked up moves to the young generation; when that is full it becomes the old one,
    and what was not looked up meanwhile is gone. So frequent keys stay.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


class ByteStore(Store):
    """The same for bytes by bytes, each generation of at most ``limit`` bytes: a text may be one word."""

    def __init__(self, limit: int):
        super().__init__(limit)
        self.size = 0

    def put(self, key: bytes, value: bytes) -> None:
        size = ENTRY + len(key) + len(value)
        if size * SHARE > self.limit:
            return
        if self.size + size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = value
        self.size += size


_held: dict[Hashable, object] = {}


def hold(name: Hashable, make: Callable[[], object]):
    """What ``make`` makes, kept in this worker until another operator's work begins there."""
    if name not in _held:
        release()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Let go of what an earlier operator kept: Spark uses a worker again for the next one."""
    _held.clear()
