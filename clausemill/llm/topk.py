"""Exact top-k by inner product, block at a time.

Rows are range-partitioned by id, so that a task reads documents of a range; it takes them ``shard_rows`` at a
time, puts rows that are alike next to each other by halving along their widest direction, and cuts them
into blocks of ``block_rows``. A block keeps a forward index (its rows' weights) and, for each term (a
dimension, by sign), the largest weight it holds. A query's bound on a block is the sum over its terms of query
weight times that maximum, or what the rows' distance from the block's centre allows where that is less. Each
query takes the blocks by falling bound, twice as many each time, and stops once the next bound is below its
k-th score; a bound equal to it is still scored, as ties go to the smaller id.

Queries start with a k-th score: that among ``seed_rows`` rows drawn from all, which it is never below. They go
round in blocks of ``query_rows``, each broadcast once to all tasks; rows are moved once, into their ranges, and
read again for each block of queries. Only a task's k best for each query travel on.

Defined results: vectors that are null, or hold null or non-finite components, take no part; vectors
shorter than others lack the further terms (weight 0); rows of a repeated id are each a query and each a
candidate of all others; an empty vector scores 0; other columns are ignored; an empty table gives no rows. Scores are
compared exactly, whatever their size; components and scores beyond 64 bits are given as the last number on their side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, rows_of, trimmed

LEAST = np.iinfo(np.int64).min
GROUP = 4096
SCHEMA = "query_row long, query_id long, vec_id long, score long, exact string, scored long"


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of lists of int64, filled up with 0."""
    cuts, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    size = np.diff(cuts)
    out = np.zeros((len(size), dim), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = flat[cuts[0] : cuts[-1]]
    return out


def _kind(rows: np.ndarray, queries: np.ndarray):
    """A number type in which all sums are exact."""
    largest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    top = largest(rows) * largest(queries) * max(1, rows.shape[1])
    return np.float64 if top < 2**53 else np.int64 if top < 2**63 else object


def alike(rows: np.ndarray, most: int, seed: int = 5) -> np.ndarray:
    """An order of the rows in which like ones are near each other: halves along the widest direction of each part."""
    x, rng = rows.astype(np.float64), np.random.default_rng(seed)
    x /= max(np.abs(x).max(initial=0), 1)
    out, stack = [], [np.arange(len(x))]
    while stack:
        part = stack.pop()
        if len(part) <= most:
            out.append(part)
            continue
        y = x[part] - x[part].mean(0)
        way = rng.normal(size=y.shape[1])
        for _ in range(4):
            way = (y @ way) @ y
            way /= max(np.linalg.norm(way), 1e-300)
        order = part[np.argsort(y @ way, kind="stable")]
        half = -(-len(order) // (2 * most)) * most
        stack += [order[half:], order[:half]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class Blocks:
    """A shard's blocks: forward indexes, term maxima, centres and radii."""

    def __init__(self, names: np.ndarray, ids: np.ndarray, rows: np.ndarray, block_rows: int):
        """names: of the rows; ids: theirs, by which ties are ordered."""
        order = alike(rows, block_rows)
        self.cuts = list(range(0, len(ids), block_rows)) + [len(ids)]
        self.names, self.ids, self.rows = names[order], ids[order], rows[order]
        parts = [self.rows[a:z] for a, z in zip(self.cuts, self.cuts[1:], strict=False)]
        self.most = np.stack([np.maximum(p.max(0), 0) for p in parts])
        self.least = np.stack([np.minimum(p.min(0), 0) for p in parts])
        self.centre = np.stack([p.mean(0, dtype=np.float64) for p in parts])
        self.radius = np.array([np.sqrt(((p - c) ** 2).sum(1).max()) for p, c in zip(parts, self.centre, strict=True)])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Of each query on each block: no row scores more."""
        got = np.maximum(q, 0) @ self.most.astype(q.dtype).T + np.minimum(q, 0) @ self.least.astype(q.dtype).T
        if q.dtype == np.float64:
            near = q @ self.centre.T
            far = np.linalg.norm(q, axis=1)[:, None] * self.radius[None, :]
            got = np.minimum(got, near + far + 1e-9 * (np.abs(near) + far) + 1)
        return got

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(queries' places, ids, scores) of the k best for each, and how many rows each met; own: their names, least: scores that k others reach."""
        kind = _kind(self.rows, queries)
        rows, q = self.rows.astype(kind), queries.astype(kind)
        bounds = self.bounds(q)
        order = np.argsort(-bounds, axis=1, kind="stable")
        least = np.full(len(q), LEAST) if least is None else least
        kth = np.where(least > LEAST, least, -np.inf) if kind is np.float64 else least.astype(kind)
        if kind is object:
            kth[least == LEAST] = -np.inf  # sums may lie below the least number of 64 bits
        who, where, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
        scored, open_, step, wave = np.zeros(len(q), np.int64), np.arange(len(q)), 0, 1
        while step < order.shape[1] and len(open_):
            upto = min(order.shape[1], step + wave)
            block = order[open_, step:upto]
            goes = bounds[open_[:, None], block] >= kth[open_, None]
            one, which = np.nonzero(goes)
            one, which = open_[one], block[goes]
            by = np.argsort(which, kind="stable")
            one, which = one[by], which[by]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else [], len(which)).astype(int)
            found = [(who, where, best)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                mine, b = one[a:z], which[a]
                lo, hi = self.cuts[b], self.cuts[b + 1]
                got = q[mine] @ rows[lo:hi].T
                scored[mine] += hi - lo
                r, c = np.nonzero((got >= kth[mine, None]) & (self.names[None, lo:hi] != own[mine, None]))
                found.append((mine[r], lo + c, got[r, c]))
            who, where, best = (np.concatenate(x) for x in zip(*found, strict=True))
            by = np.lexsort((self.ids[where], -best, who)) if kind is not object else np.array(sorted(range(len(who)), key=lambda i: (who[i], -best[i], self.ids[where[i]])), int)
            who, where, best = who[by], where[by], best[by]
            on = np.arange(len(who)) - np.searchsorted(who, who) < k
            who, where, best = who[on], where[on], best[on]
            last = np.flatnonzero(np.arange(len(who)) - np.searchsorted(who, who) == k - 1)
            kth[who[last]] = np.maximum(kth[who[last]], best[last])
            open_ = open_[goes[:, -1]]  # bounds fall: where the last of these can't matter, none after it can
            step, wave = upto, 2 * wave
        return who, self.ids[where], best, scored


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, *, block_rows: int = 32, shard_rows: int = 16_384, query_rows: int = 65_536, seed_rows: int = 2048, part_rows: int = 65_536) -> DataFrame:
    """rows, queries: (row long, id long, vector array<long>), a row's number its own -> query_id, rank, vec_id, score, scored.

    A query is no candidate of itself, by its row; scored: how many rows its score was computed for, of all.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "topk")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dim")).first()
    asked = queries.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dim")).first()
    dim = max(size["dim"], asked["dim"], 1)
    if not size["n"] or not asked["n"]:
        return rows_of(spark, [], "query_id long, rank int, vec_id long, score long, scored long")
    parts = max(1, -(-size["n"] // part_rows))
    ranged = scratch.keep(rows.repartitionByRange(parts, "id", "row"), "rows")

    def opened(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vectors = table.column("vector")
        return table.column("row").to_numpy(), table.column("id").to_numpy(), matrix(vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors, dim)

    def drawn(df: DataFrame, of: int, most: int, salt: int, slot: int = 0) -> DataFrame:
        return df.where(F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(max(1, -(-of // most)))) == slot)

    # About seed_rows rows, whatever the table's size.
    some = drawn(ranged, size["n"], seed_rows, 1).select("row", "id", "vector").toArrow()
    first = spark.sparkContext.broadcast(opened(some) if len(some) else None)
    groups = -(-asked["n"] // query_rows)
    found = []
    for g in range(groups):
        # About query_rows queries, whatever the table's size.
        group = opened(drawn(queries, asked["n"], query_rows, 2, g).select("row", "id", "vector").toArrow())
        if not len(group[0]):
            continue
        sent = spark.sparkContext.broadcast(group)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, ids, asked_for = sent.value
            held, n = [], 0
            best: list[tuple] = []
            least = None

            def shard() -> None:
                nonlocal best, least
                index = Blocks(*(np.concatenate(x) for x in zip(*held, strict=True)), block_rows)
                held.clear()
                if least is None:
                    least = _seeds(first.value, mine, asked_for, k)
                new = []
                for a in range(0, len(mine), GROUP):
                    who, where, score, scored = index.search(mine[a : a + GROUP], asked_for[a : a + GROUP], k, least[a : a + GROUP])
                    met[a : a + GROUP] += scored
                    new.append((who + a, where, score.astype(object) if score.dtype == object else score.astype(np.int64)))
                best = _merged([*best, *new], k)
                _raise(least, best, k)

            met = np.zeros(len(mine), np.int64)
            for b in batches:
                if not len(b):
                    continue
                held.append(opened(b))
                n += len(b)
                if n >= shard_rows:
                    shard()
                    n = 0
            if n:
                shard()
            if met.any():
                who, where, score = best[0]
                there = np.flatnonzero(met)
                fits = np.clip(score, LEAST, np.iinfo(np.int64).max).astype(np.int64)
                text = [str(s) if f != s else None for s, f in zip(score, fits, strict=True)] if score.dtype == object else [None] * len(score)
                yield _batch(mine[who], ids[who], where, fits, text, None)
                yield _batch(mine[there], ids[there], None, None, None, met[there])

        found.append(scratch.keep(ranged.mapInArrow(trimmed(search), SCHEMA), f"found-{g}"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    part = every.where("vec_id IS NOT NULL").drop("scored")
    seen = every.where("scored IS NOT NULL").groupBy("query_row").agg(F.sum("scored").alias("scored"))
    # Scores that 64 bits can't hold are compared as the text of their decimals: sign, number of digits, digits.
    text = F.col("exact")
    digits = F.regexp_replace(text, "^-", "")
    side = F.when(F.startswith(text, F.lit("-")), -1).otherwise(1)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.desc(F.coalesce(side * F.length(digits), F.lit(0))), F.desc(F.when(side > 0, digits)), F.when(side < 0, digits), "vec_id")
    best = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(seen, "query_row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "scored")


def _seeds(first, mine: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th score among the rows drawn, or the least number where there are fewer."""
    out = np.full(len(queries), LEAST, np.int64)
    if first is None or len(first[0]) <= k:
        return out
    kind = _kind(first[2], queries)
    if kind is object:
        return out
    rows = first[2].astype(kind).T
    for a in range(0, len(queries), 1024):
        got = queries[a : a + 1024].astype(kind) @ rows
        got[mine[a : a + 1024, None] == first[0][None, :]] = -np.inf if kind is np.float64 else LEAST
        kth = np.partition(got, len(first[0]) - k, axis=1)[:, len(first[0]) - k]
        out[a : a + 1024] = np.where(np.isfinite(kth), kth, LEAST) if kind is np.float64 else kth
    return out


def _merged(parts: list[tuple], k: int) -> list[tuple]:
    if any(p[2].dtype == object for p in parts):
        parts = [(a, b, c.astype(object)) for a, b, c in parts]
    who, where, score = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.array(sorted(range(len(who)), key=lambda i: (who[i], -score[i], where[i])), int) if score.dtype == object else np.lexsort((where, -score, who))
    who, where, score = who[by], where[by], score[by]
    on = np.arange(len(who)) - np.searchsorted(who, who) < k
    return [(who[on], where[on], score[on])]


def _raise(least: np.ndarray, best: list[tuple], k: int) -> None:
    who, _, score = best[0]
    last = np.flatnonzero(np.arange(len(who)) - np.searchsorted(who, who) == k - 1)
    least[who[last]] = np.maximum(least[who[last]], np.clip(score[last], LEAST, np.iinfo(np.int64).max).astype(np.int64))


def _batch(row, query, vec, score, exact, scored) -> pa.RecordBatch:
    n = len(row)
    made = [pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in ((row, pa.int64()), (query, pa.int64()), (vec, pa.int64()), (score, pa.int64()), (exact, pa.string()), (scored, pa.int64()))]
    return pa.RecordBatch.from_arrays(made, ["query_row", "query_id", "vec_id", "score", "exact", "scored"])


def integer_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """(row, id, vector) of the usable rows of (vec_id, embedding): floor(scale * x), x as double; write it before use, as rows are numbered anew each time."""
    ok = table.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    top, low = F.lit(float(2**63)), F.lit(float(-(2**63)))

    def whole(x: Column) -> Column:
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        v = F.lit(float(scale)) * x.cast("double")
        return F.when(v >= top, F.lit(2**63 - 1)).when(v <= low, F.lit(-(2**63) + 1)).otherwise(y.cast("long"))

    return ok.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.transform("embedding", whole).alias("vector"))
