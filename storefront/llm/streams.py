"""Groups read from a sorted stream of Arrow batches, a group or a part of one at a time.

``mapInArrow`` behind a shuffle by key and a sort within partitions sees the rows of a key one
after the other. Nothing but what the caller keeps is held, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa


def rows(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """The rows of the batches as tuples in the order of ``names``."""
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names])


class Output:
    """Gathers rows and gives them out as batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = 2_000, most_bytes: int = 8 << 20):
        self.schema, self.limit, self.most_bytes = schema, limit, most_bytes
        self.held, self.size = [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.held.append(row)
        self.size += size
        if len(self.held) >= self.limit or self.size >= self.most_bytes:
            yield self.batch()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.held)
        made = [pa.array(c, f.type) for c, f in zip(columns, self.schema)]
        self.held, self.size = [], 0
        return pa.RecordBatch.from_arrays(made, schema=self.schema)
