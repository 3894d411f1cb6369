"""Exact top-k inner products: a ball tree per shard, searched by branch and bound.

Components x become floor(256 * x), so scores are whole numbers and ties are real. Vectors
are dealt to cells by the nearest of ``CELLS`` centres, fitted on a bounded sample (the rows
with the ``SAMPLE`` lowest hashes); the radius of a cell is measured over all its vectors. A
cell with more rows than a shard may have is split by hash, so one vector repeated any number
of times makes no large shard. Each shard builds a ball tree: halves along the line between
two far vectors, a centre and a radius per node. A query q can score at most q.c + |q| r
within a ball.

Queries come to a shard as a stream behind its vectors, in blocks. Down the tree, nodes whose
bound is below a query's kth score are left out; the leaves that remain are taken in the order
of their bounds, first each query's own best ones, then all leaves from the highest bound on,
and the kth score rises meanwhile. Queries first visit the shard of the cell with the highest
bound. The kth score found there goes with them, and they are sent on only to cells whose
bound reaches it. The best of all visits is the exact result: the sample decides only how
much is left out.

A shard has at most ``SHARD_ROWS`` vectors, four bytes a component; its queries are never held
together. Vectors that nothing prunes meet every shard, as exact search asks.

Cases: vectors that are NULL or hold a NULL or non-finite component (also after scaling) take
no part; vectors of unlike length have no score; empty vectors score 0 with each other; rows
with one vec_id are candidates of their own, and a row never finds itself, but its copy; ties
go to the smaller vec_id, NULL last; scores beyond 64 bits are cut to the range of a long;
queries without candidates have no row; other columns, whatever they are called, are left
out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.common import land, ship
from storefront.llm.streams import Output

SCALE = 256
CELLS = 64
SAMPLE = 8_192
SHARD_ROWS = 250_000
LEAF = 256
QUERIES_AT_ONCE = 512
OWN_LEAVES = 2  # leaves that each query takes in its own order before all are swept
LAST = np.iinfo(np.int64).max
EXACT = 2**53  # whole numbers up to here are exact as doubles
_SHARD = 1 << 32  # shards are numbered within their cell


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.asarray(vectors, np.float64))


def pack(vector: np.ndarray) -> bytes:
    """A quantised vector as bytes, two a component where they suffice."""
    narrow = not len(vector) or np.abs(vector).max() < 2**15
    return vector.astype("<i2" if narrow else "<f8").tobytes()


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    if not packed or not dim:
        return np.zeros((len(packed), dim))
    if len(set(map(len, packed))) == 1:
        kind = "<i2" if len(packed[0]) == 2 * dim else "<f8"
        return np.frombuffer(b"".join(packed), kind).reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(x, "<i2" if len(x) == 2 * dim else "<f8").astype(np.float64) for x in packed])


class Vectors:
    """Vectors of one length with their row numbers and ids (None: last)."""

    def __init__(self, rows, ids, values: np.ndarray):
        self.rows = np.asarray(rows, np.int64)
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        # whole numbers below 2**24 are exact in four bytes
        small = not values.size or np.abs(values).max() < 2**24
        self.values = values.astype(np.float32 if small else np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", values, values))

    def __len__(self):
        return len(self.rows)

    def take(self, order: np.ndarray) -> Vectors:
        held = Vectors.__new__(Vectors)
        for name in ("rows", "null", "ids", "values", "norms"):
            setattr(held, name, getattr(self, name)[order])
        return held


def products(queries: np.ndarray, values: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products; ``bound`` is the largest product of norms."""
    if bound < 2**24:  # every sum on the way is a whole number that the type holds
        return (queries.astype(np.float32) @ values.T.astype(np.float32)).astype(np.float64)
    if bound < EXACT:
        return queries.astype(np.float64) @ values.T.astype(np.float64)
    whole = np.frompyfunc(int, 1, 1)
    found = whole(queries).dot(whole(values).T) if queries.shape[1] else np.zeros((len(queries), len(values)), object)
    return np.minimum(np.maximum(found, -(2**63)), 2**63 - 1)


def floors(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """kth scores as doubles that are not above them, and the ids up to which they tie."""
    near = scores.astype(np.float64)
    large = np.abs(near) >= EXACT
    return np.where(large, np.nextafter(near, -np.inf), near), np.where(large, LAST, ids)


def _radius(values: np.ndarray, centre: np.ndarray) -> float:
    parts = [values[i : i + 8_192].astype(np.float64) - centre for i in range(0, len(values), 8_192)]
    return float(np.sqrt(max(np.einsum("ij,ij->i", p, p).max() for p in parts)))


class BallTree:
    """A complete binary tree of balls over the vectors, split at medians."""

    def __init__(self, vectors: Vectors, leaf: int = LEAF):
        order, spans = np.arange(len(vectors)), [(0, len(vectors))]
        self.levels: list[list[tuple[int, int]]] = [spans]
        while max(b - a for a, b in spans) > leaf:
            halves = []
            for a, b in spans:
                part = order[a:b]
                held = vectors.values[part]
                far = held[np.argmax(((held - held[:1]) ** 2).sum(axis=1))]
                other = held[np.argmax(((held - far) ** 2).sum(axis=1))]
                along = np.lexsort((vectors.ids[part], held @ (far - other)))
                order[a:b] = part[along]
                halves += [(a, a + (b - a) // 2), (a + (b - a) // 2, b)]
            spans = halves
            self.levels.append(spans)
        for a, b in spans:  # within a leaf by id
            order[a:b] = np.sort(order[a:b])[np.argsort(vectors.ids[np.sort(order[a:b])], kind="stable")]
        self.vectors = vectors.take(order)
        self.centres, self.radii, self.least = [], [], []
        for spans in self.levels:
            centres = np.stack([self.vectors.values[a:b].mean(axis=0, dtype=np.float64) for a, b in spans])
            self.centres.append(centres)
            self.radii.append(np.array([_radius(self.vectors.values[a:b], c) for (a, b), c in zip(spans, centres)]))
            self.least.append(np.array([self.vectors.ids[a:b].min() for a, b in spans]))
        self.spans = spans
        self.largest = float(self.vectors.norms.max())


def upper_bounds(values: np.ndarray, norms: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The most a query can score within each ball; scores are whole, rounding errs upwards."""
    bound = values @ centres.T + norms[:, None] * radii[None, :]
    slack = 1e-9 * (norms[:, None] * (np.sqrt((centres**2).sum(axis=1)) + radii)[None, :]) + 1e-6
    return np.floor(bound + slack)


class Search:
    """The best k of a block of queries so far; ``floor`` are kth (score, id) found elsewhere."""

    def __init__(self, queries: Vectors, k: int, floor: tuple[np.ndarray, np.ndarray]):
        self.queries, self.k = queries, k
        self.floor_score, self.floor_id = floor[0].copy(), floor[1].copy()
        self.own = [np.zeros(0, np.int64)] * 5  # query, score, id, null, row

    def alive(self, bounds: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which (query, ball) can still hold one of the best."""
        kth, at = self.floor_score[:, None], self.floor_id[:, None]
        return (bounds > kth) | ((bounds == kth) & (least[None, :] <= at))

    def scan(self, which: np.ndarray, tree: BallTree, span: tuple[int, int]) -> None:
        a, b = span
        held = tree.vectors
        bound = float(self.queries.norms[which].max() * tree.largest)
        scores = products(self.queries.values[which], held.values[a:b], bound)
        hit = (scores >= self.floor_score[which][:, None]) & (held.rows[a:b][None, :] != self.queries.rows[which][:, None])
        q, c = np.nonzero(hit)
        if not len(q):
            return
        c_at = c + a
        found = [which[q], scores[q, c].astype(np.int64) if scores.dtype != object else np.array([int(x) for x in scores[q, c]], np.int64),
                 held.ids[c_at], held.null[c_at].astype(np.int64), held.rows[c_at]]
        touched = np.zeros(len(self.queries), bool)
        touched[found[0]] = True
        stay = ~touched[self.own[0]]
        merged = [np.concatenate([o[~stay], f]) for o, f in zip(self.own, found)]
        order = np.lexsort((merged[4], merged[2], merged[3], -merged[1].astype(np.float64), merged[0])) if bound < EXACT else np.array(
            sorted(range(len(merged[0])), key=lambda i: (merged[0][i], -int(merged[1][i]), merged[3][i], merged[2][i], merged[4][i]))
        )
        merged = [m[order] for m in merged]
        starts = np.searchsorted(merged[0], merged[0], side="left")
        place = np.arange(len(merged[0])) - starts
        keep = place < self.k
        # the kth of a query raises its floor; equal scores count up to the kth id
        kth = place == self.k - 1
        q, score, at = merged[0][kth], merged[1][kth], merged[2][kth]
        better = (score > self.floor_score[q]) | ((score == self.floor_score[q]) & (at < self.floor_id[q]))
        self.floor_score[q[better]], self.floor_id[q[better]] = floors(score[better], at[better])
        self.own = [np.concatenate([o[stay], m[keep]]) for o, m in zip(self.own, merged)]

    def run(self, tree: BallTree) -> None:
        queries = self.queries
        bounds = None
        for level, centres in enumerate(tree.centres):
            here = upper_bounds(queries.values, queries.norms, centres, tree.radii[level])
            if bounds is not None:  # children of what was left out stay out
                here = np.where(np.repeat(open_, 2, axis=1), here, -np.inf)
            open_ = self.alive(here, tree.least[level]) & np.isfinite(here)
            bounds = here
        bounds = np.where(open_, bounds, -np.inf)
        least = tree.least[-1]
        for _ in range(min(OWN_LEAVES, len(tree.spans))):
            best = np.argmax(bounds, axis=1)
            live = self.alive(bounds, least)[np.arange(len(best)), best] & np.isfinite(bounds[np.arange(len(best)), best])
            for leaf in np.unique(best[live]):
                self.scan(np.flatnonzero(live & (best == leaf)), tree, tree.spans[leaf])
            bounds[np.arange(len(best)), best] = -np.inf
        for leaf in np.argsort(-bounds.max(axis=0), kind="stable"):
            live = self.alive(bounds[:, leaf : leaf + 1], least[leaf : leaf + 1])[:, 0] & np.isfinite(bounds[:, leaf])
            if live.any():
                self.scan(np.flatnonzero(live), tree, tree.spans[leaf])


# -- Spark ---------------------------------------------------------------------------------


def _finite(vector: Column) -> Column:
    """True where all components are there and finite; NaN is above infinity for Spark."""
    good = lambda x: F.abs(x.cast("double")) * SCALE < F.lit(float("inf"))
    return F.forall(vector, lambda x: F.coalesce(good(x), F.lit(False)))


def prepared(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """row, vec_id, dim, packed: the vectors that take part, quantised, landed."""

    def run(batches):
        for batch in batches:
            packed = [pack(quantised(np.array(v, np.float64))) for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("dim"), pa.array(packed, pa.binary())], ["vec_id", "dim", "packed"]
            )

    ship(vectors.sparkSession)
    taken = vectors.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    taken = taken.where(F.col("v").isNotNull() & _finite(F.col("v"))).withColumn("dim", F.size("v"))
    return land(taken.mapInArrow(run, "vec_id long, dim int, packed binary").withColumn("row", F.monotonically_increasing_id()), "vectors")


def centres_of(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centres of a sample by Lloyd's rounds from far points."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(cells, len(sample)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    centres = sample[chosen].copy()
    for _ in range(rounds):
        of = _nearest(sample, centres)
        for i in range(len(centres)):
            if (of == i).any():
                centres[i] = sample[of == i].mean(axis=0)
    return centres


def _nearest(values: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * values @ centres.T).argmin(axis=1)


class Cells:
    """Centres of the commonest vector length; other lengths share one cell, numbered last."""

    def __init__(self, dim: int, centres: np.ndarray):
        self.dim, self.centres, self.other = dim, centres, len(centres)


def _fitted(vectors: DataFrame) -> Cells:
    drawn = vectors.select("dim", "packed", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).collect()
    dims = pd.Series([r.dim for r in drawn], dtype="int64")
    dim = int(dims.mode().iloc[0]) if len(dims) else 0
    return Cells(dim, centres_of(unpack([bytes(r.packed) for r in drawn if r.dim == dim], dim), CELLS))


def _celled(vectors: DataFrame, cells: Cells) -> DataFrame:
    """``vectors`` with the cell and the distance to its centre."""

    def run(batches):
        for batch in batches:
            dims = np.array(batch.column("dim"))
            packed = batch.column("packed").to_pylist()
            cell, apart = np.full(len(dims), cells.other), np.zeros(len(dims))
            own = np.flatnonzero(dims == cells.dim)
            if len(own):
                values = unpack([packed[i] for i in own], cells.dim)
                cell[own] = _nearest(values, cells.centres)
                apart[own] = np.sqrt(((values - cells.centres[cell[own]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(apart, pa.float64())], [*batch.schema.names, "cell", "apart"]
            )

    fields = [f"{n} {t}" for n, t in vectors.dtypes]
    return vectors.mapInArrow(run, ", ".join([*fields, "cell int", "apart double"]))


def _routed(queries: DataFrame, cells: Cells, shards: dict[int, int], radii: dict[int, float], first: bool) -> DataFrame:
    """The queries with ``shard``: of the best cell, or of all others that their kth score lets through."""
    known = sorted(c for c in shards if c != cells.other)
    centres = cells.centres[known]
    reach = np.array([radii[c] for c in known])

    def run(batches):
        for batch in batches:
            dims = np.array(batch.column("dim"))
            packed, rows = batch.column("packed").to_pylist(), np.array(batch.column("row"))
            kth, _ = _known(batch.column("kth").to_pylist(), batch.column("kth_id").to_pylist())
            at, shard = [], []
            for own, group in ((True, np.flatnonzero(dims == cells.dim)), (False, np.flatnonzero(dims != cells.dim))):
                if not len(group) or (own and not known):
                    continue
                if own:
                    values = unpack([packed[i] for i in group], cells.dim)
                    bounds = upper_bounds(values, np.sqrt((values**2).sum(axis=1)), centres, reach)
                    best = bounds.argmax(axis=1)
                else:
                    bounds, best = np.full((len(group), 1), np.inf), np.zeros(len(group), int)
                for j, i in enumerate(group):
                    for c in [best[j]] if first else np.flatnonzero(bounds[j] >= kth[i]):
                        cell = known[c] if own else cells.other
                        n = shards[cell]
                        home = int(rows[i] % n)
                        parts = [home] if first else [s for s in range(n) if not (c == best[j] and s == home)]
                        at += [i] * len(parts)
                        shard += [cell * _SHARD + s for s in parts]
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(shard, pa.int64())], [*picked.schema.names, "shard"])

    fields = [f"{n} {t}" for n, t in queries.dtypes]
    return queries.mapInArrow(run, ", ".join([*fields, "shard long"]))


_FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("row", pa.int64())]
)


def _visited(held: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """What the queries find in their shards; a shard's vectors come before its queries."""

    def run(batches):
        out = Output(_FOUND, 20_000)
        now, trees, pending, waiting = None, {}, {}, {}

        def answered(dim):
            block = waiting.pop(dim, None)
            if not block:
                return
            if dim in pending:
                trees[dim] = BallTree(Vectors(*_columns(pending.pop(dim), dim)))
            if dim not in trees:
                return
            rows_, ids, packed, kth, kth_id = zip(*block)
            queries_ = Vectors(rows_, ids, unpack(list(packed), dim))
            search = Search(queries_, k, _known(kth, kth_id))
            search.run(trees[dim])
            for q, score, ident, null, row in zip(*[x.tolist() for x in search.own]):
                yield from out.add((int(queries_.rows[q]), ids[q], None if null else ident, score, row))

        def ended():
            for dim in list(waiting):
                yield from answered(dim)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "kind", "row", "vec_id", "dim", "packed", "kth", "kth_id")]
            for shard, kind, row, ident, dim, packed, kth, kth_id in zip(*columns):
                if shard != now:
                    yield from ended()
                    now, trees, pending, waiting = shard, {}, {}, {}
                if kind == 0:
                    pending.setdefault(dim, []).append((row, ident, packed))
                else:
                    waiting.setdefault(dim, []).append((row, ident, packed, kth, kth_id))
                    if len(waiting[dim]) >= QUERIES_AT_ONCE:
                        yield from answered(dim)
        yield from ended()
        yield from out.rest()

    sides = held.select("shard", F.lit(0).alias("kind"), "row", "vec_id", "dim", "packed").unionByName(
        queries.select("shard", F.lit(1).alias("kind"), "row", "vec_id", "dim", "packed", "kth", "kth_id"), allowMissingColumns=True
    )
    dealt = sides.repartition("shard").sortWithinPartitions("shard", "kind", "row")
    return dealt.mapInArrow(run, "query_row long, query_id long, vec_id long, score long, row long")


def _known(kth, kth_id) -> tuple[np.ndarray, np.ndarray]:
    """Floors from kth scores and ids, with none where there is no kth."""
    none = np.array([x is None for x in kth], bool)
    score, at = floors(np.array([x or 0 for x in kth], np.int64), np.array([LAST if x is None else x for x in kth_id], np.int64))
    return np.where(none, -np.inf, score), np.where(none, LAST, at)


def _columns(held: list[tuple], dim: int):
    rows_, ids, packed = zip(*held)
    return rows_, ids, unpack(list(packed), dim)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query row with their rank."""
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int, is_query: Column, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query row.

    ``is_query`` picks the query rows by ``vec_id``; all other rows, and those of other
    queries, are candidates.
    """
    held = prepared(vectors, ident, vector)
    cells = _fitted(held)
    held = land(_celled(held, cells), "vector-cells")
    sizes = held.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect()  # a row per cell
    total = sum(r.n for r in sizes)
    most = max(1, min(SHARD_ROWS, -(-total // CELLS)))
    shards = {r.cell: -(-r.n // most) for r in sizes} or {0: 1}
    radii = {r.cell: r.r for r in sizes} or {0: 0.0}
    counts = F.create_map(*[F.lit(x) for c, n in sorted(shards.items()) for x in (c, n)])
    held = held.withColumn("shard", F.col("cell").cast("long") * _SHARD + F.pmod(F.xxhash64("row"), counts[F.col("cell")]))
    queries = held.where(is_query).select("row", "vec_id", "dim", "packed")
    unknown = queries.withColumns({"kth": F.lit(None).cast("long"), "kth_id": F.lit(None).cast("long")})
    first = land(_visited(held, _routed(unknown, cells, shards, radii, True), k), "vector-first")
    kth = _best(first, k).where(F.col("rank") == k).select("query_row", F.col("score").alias("kth"), F.col("vec_id").alias("kth_id"))
    known = queries.join(kth, queries.row == F.col("query_row"), "left").drop("query_row")
    later = _visited(held, _routed(known, cells, shards, radii, False), k)
    best = _best(first.unionByName(later), k)
    return best.select("query_id", "rank", "vec_id", "score")
