"""Near-duplicate vectors by spherical k-means cells, in two levels.

Equal vectors are one class from the start. Centroids are fitted on at most ``fit_rows`` classes, and where a cell would hold more
than ``cell_rows`` of them, on at most as many of each such cell once more: so cells grow in number with the
classes, to ``most_cells`` times ``most_parts``. Every class has its home cell and visits those other cells that could be home to
a vector with a cosine of ``least`` or more, and the same among the parts of each cell that it is in:
if u is at home in c and v in c', then (v - u).(c' - c) is at most
|v - u| |c' - c|, so one of the two lies within half of that of the other's cell. With ``reach`` 1 no
pair can be lost. That is the worst case, of a difference that points from one centroid to the other; the
default takes 0.35 of it, as a difference has only a small part of its length along any one direction (in
64 dimensions an eighth), and finds 0.996 of pairs made to lie at cosines of 0.90 to 0.92, all above 0.95. Where that
isn't enough for the input's own links, it is widened: about ``probes`` vectors are compared with all, which says what reach
each of their links needs, and the least reach, by hundredths, that finds ``recall`` of these is taken. In a part, those at home are
compared with all, and those at home in its cell alone with those that have their place of the cell there; the many that only visit aren't compared with each other,
as such a pair counts nowhere. Parts with more than ``block_rows`` at home, or 16 times as many in all, are dealt into
blocks, and each pair of blocks is one task. A task multiplies blocks, counts links and joins its rows
into local components; links themselves never leave it. A pair that meets in several parts counts in the first of
them, and there are four at most where it can. One vector of each component is kept.

Defined results: null and zero vectors, and those with null or non-finite components, link with nothing;
shorter vectors lack further components (0); repeated rows are each returned, but a repeated (id, vector)
counts as one vector; an empty table gives no rows; other columns pass through, but for those with a result's name, which gives way to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch, hidden, shown, trimmed
from .components import components
from .topk import usable

#: All centroids of the second level go to every task.
CENTROID_BYTES = 64 << 20
#: Numbers in a product at a time, and rows in a batch.
PRODUCT, BATCH_ROWS = 1 << 20, 4096
_PLACED = "cell int, id long, n long, flag byte, v binary, visits binary"


def dense(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def listed(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """As ``dense``, of a column of lists without nulls."""
    flat, size = vectors.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def packed(cuts: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary rows, cut from an array's bytes."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * data.itemsize).astype(np.int32)), pa.py_buffer(data.tobytes())])


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fit(x: np.ndarray, cells: int, seed: int = 17, rounds: int = 8) -> np.ndarray:
    """Unit centroids of at most ``cells`` cells; x has unit rows."""
    rng = np.random.default_rng(seed)
    cells = max(1, min(cells, len(x)))
    c = x[np.sort(rng.choice(len(x), cells, replace=False))].copy()
    for _ in range(rounds if cells > 1 else 0):
        home = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-300), c)
    return c


class Cells:
    """Home and visited cells for a least cosine."""

    def __init__(self, centroids: np.ndarray, least: float, reach: float):
        self.c = centroids
        apart = np.linalg.norm(centroids[:, None, :] - centroids[None, :, :], axis=2) if len(centroids) <= 512 else np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))
        self.whole = np.sqrt(2 - 2 * least) / 2 * apart
        self.slack = reach * self.whole + 1e-9

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(home, visited) of unit rows; visited is boolean by row and cell and holds the home too."""
        sims = x @ self.c.T
        home = np.argmax(sims, axis=1)
        best = sims[np.arange(len(x)), home]
        return home, sims >= best[:, None] - self.slack[home]


    def needed(self, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
        """The reach at which each link of an x and a y is found."""
        (sx, sy), (hx, hy) = (x @ self.c.T, y @ self.c.T), (self(x)[0], self(y)[0])
        r, c = np.nonzero(x @ y.T >= least)
        room = np.maximum(self.whole[hx[r], hy[c]], 1e-12)
        lead = np.minimum(sx[r, hx[r]] - sx[r, hy[c]], sy[c, hy[c]] - sy[c, hx[r]])
        return np.where(hx[r] == hy[c], 0.0, np.clip(lead / room, 0, 1))


def _local(labels: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Least label reachable by pairs of rows."""
    while True:
        new = labels.copy()
        np.minimum.at(new, r, labels[c])
        np.minimum.at(new, c, labels[r])
        if (new == labels).all():
            return labels
        labels = new


class Visits:
    """The places of a group's rows: codes of each row, by place, of four times the place, 2 where its cell is the row's home and 1 where it is the row's home in its cell."""

    def __init__(self, rows: list[bytes], parts: int):
        code = np.frombuffer(b"".join(rows), np.int32).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), [len(v) // 4 for v in rows])
        self.parts, self.wide = parts, int(code.max(initial=0)) // 4 + 1
        self.home = (code // 4)[code % 4 == 3]
        self.seen = row * self.wide + code // 4
        inner = code % 2 == 1
        self.cells, self.inside = (row * self.wide + code // 4 // parts)[inner], (code // 4)[inner]

    def sees(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = row * self.wide + place
        return self.seen[np.minimum(np.searchsorted(self.seen, key), len(self.seen) - 1)] == key

    def first(self, r: np.ndarray, c: np.ndarray, here: int) -> np.ndarray:
        """Whether pairs that meet here meet nowhere before: at the home of one, or at the other's place in that one's home cell."""
        before = np.zeros(len(r), bool)
        for a, b in ((r, c), (c, r)):
            place = self.home[a]
            before |= (place < here) & self.sees(b, place)
            key = b * self.wide + place // self.parts
            at = np.minimum(np.searchsorted(self.cells, key), len(self.cells) - 1)
            before |= (self.cells[at] == key) & (self.inside[at] < here) & self.sees(a, self.inside[at])
        return ~before


def _meetings(x: np.ndarray, flag: np.ndarray, block: np.ndarray, least: float, apart: bool):
    """Pairs (r, c) of a part's rows with a cosine of ``least``, each once, by where the rows are at home; ``apart``: those of two blocks."""
    norm = np.linalg.norm(x, axis=1)
    index = np.arange(len(x))
    for left, right in ((index[flag == 3], index), (index[flag == 2], index[flag == 1])):
        y, by = x[right], norm[right]
        step = max(1, PRODUCT // max(1, len(right)))
        for i in range(0, len(left), step):
            a = left[i : i + step]
            r, c = np.nonzero((x[a] @ y.T) / (norm[a, None] * by[None, :]) >= least)
            r, c = a[r], right[c]
            on = (r < c) | (flag[c] != 3) if right is index else np.ones(len(r), bool)  # two at home meet twice, and each meets itself
            on &= (block[r] != block[c]) | (not apart)
            yield r[on], c[on]


def near_duplicates(table: DataFrame, *, least: float = 0.9, reach: float = 0.35, recall: float = 0.999, probes: int = 512, cell_rows: int = 64, most_cells: int = 2048, most_parts: int = 64, fit_rows: int = 32_768, block_rows: int = 1024, seed: int = 17) -> DataFrame:
    """table (vec_id, embedding, ...) -> its columns, n_links, component_id, kept; a row for each row of it."""
    spark, scratch = table.sparkSession, Scratch(table.sparkSession, "vectors")
    cols, pairs = hidden(table, table.columns)
    v = F.transform(table["embedding"], lambda x: x.cast("double"))
    kind = table.schema["embedding"].dataType
    sent = np.float32 if kind == T.ArrayType(T.FloatType(), kind.containsNull) else np.float64  # what vectors are sent as holds every number of them
    ok = usable(table["embedding"]) & F.exists(v, lambda x: x != 0)
    rows = table.select(*cols, table["vec_id"].cast("long").alias("__id"), F.when(ok & table["vec_id"].isNotNull(), v).alias("__v"))
    live = rows.where(F.col("__v").isNotNull()).select("__id", "__v").distinct()
    classes = scratch.keep(live.groupBy("__v").agg(F.min("__id").alias("id"), F.count("*").alias("n")), "classes")
    total = classes.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("__v")), F.lit(1)).alias("dim")).first()
    size, dim = total["n"], total["dim"]

    sample = classes.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, size))) < fit_rows).select("__v").limit(2 * fit_rows) if size > fit_rows else classes.select("id", "__v")
    got = sample.toPandas()
    got = got.sort_values("id") if "id" in got else got
    centroids = fit(unit(dense(list(got["__v"]), dim)), min(most_cells, max(1, size // cell_rows)), seed) if size else np.zeros((1, dim))
    held = spark.sparkContext.broadcast(centroids)

    if len(centroids) > 1 and reach < 1:
        # At most twice the probes are sent to all tasks, and a task returns counts of links by hundredths of reach.
        asked = classes.where(F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(max(1, size))) < probes).select("__v").limit(2 * probes).toPandas()
        probing = spark.sparkContext.broadcast(unit(dense(list(asked["__v"]), dim)))

        def tried(batches):
            cells, found = Cells(held.value, least, reach), np.zeros(101, np.int64)
            for b in batches:
                y = unit(dense(list(b["__v"]), dim))
                for i in range(0, len(y), 2048):
                    found += np.bincount(np.ceil(cells.needed(probing.value, y[i : i + 2048], least) * 100).astype(np.int64), minlength=101)
            yield pd.DataFrame({"at": np.flatnonzero(found), "n": found[found > 0]})

        found = np.zeros(101)
        for r in classes.select("__v").mapInPandas(tried, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            found[r["at"]] = r["n"]
        found[0] = max(0.0, found[0] - len(asked))  # a probe meets itself
        reach = max(reach, int(np.argmax(np.cumsum(found) >= recall * found.sum())) / 100)

    # The second level: for cells that would hold more, centroids of their own, from at most fit_rows of each.
    count = len(centroids)
    parts = max(1, min(most_parts, size // (cell_rows * count), CENTROID_BYTES // (8 * dim * count)))

    def homes(batches):
        for b in batches:
            y = unit(dense(list(b["__v"]), dim))
            yield pd.DataFrame({"cell": np.argmax(y @ held.value.T, axis=1).astype(np.int32), "id": b["id"].to_numpy(), "v": b["__v"].to_numpy()})

    inner: dict[int, np.ndarray] = {}
    if parts > 1:
        per = max(1, size // (count * min(fit_rows, 64 * parts)))  # of each cell's vectors one in so many
        some = classes.where(F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(per)) == 0).mapInPandas(homes, "cell int, id long, v array<double>")
        first = some.withColumn("k", F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id"))).where(F.col("k") <= fit_rows)

        def refit(key, g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values("id")
            return pd.DataFrame({"cell": [int(key[0])], "data": [fit(unit(dense(list(g["v"]), dim)), parts, seed).tobytes()]})

        inner = {r["cell"]: np.frombuffer(r["data"]).reshape(-1, dim) for r in first.groupBy("cell").applyInPandas(refit, "cell int, data binary").collect()}
    lower = spark.sparkContext.broadcast(inner)

    def places(x: np.ndarray, cells: Cells, under: dict[int, Cells]) -> tuple[np.ndarray, np.ndarray]:
        """(row, code as in ``Visits``) of unit rows, by row and place."""
        home, sees = cells(x)
        row, at = np.nonzero(sees)
        by = np.argsort(at, kind="stable")
        made = []
        for mine in np.split(by, np.flatnonzero(np.diff(at[by])) + 1):
            c = int(at[mine[0]])
            if c in under:
                inside, visits = under[c](x[row[mine]])
                r, k = np.nonzero(visits)
                made.append((row[mine[r]], c * parts + k, k == inside[r]))
            else:
                made.append((row[mine], np.full(len(mine), c * parts), np.ones(len(mine), bool)))
        row, place, sub = (np.concatenate(z) for z in zip(*made, strict=True))
        by = np.lexsort((place, row))
        row, place, sub = row[by], place[by], sub[by]
        return row, place * 4 + (place // parts == home[row]) * 2 + sub

    def levels() -> tuple[Cells, dict[int, Cells]]:
        return Cells(held.value, least, reach), {c: Cells(m, least, reach) for c, m in lower.value.items()}

    def assign(batches):
        """A row for each part that a vector is in; all that a vector's rows say goes with each of them."""
        cells, under = levels()
        for b in batches:
            if not b.num_rows:
                continue
            x = listed(b.column("__v"), dim)
            row, code = places(unit(x), cells, under)
            v = packed(np.arange(len(x) + 1) * dim, x.astype(sent))
            visits = packed(np.searchsorted(row, np.arange(len(x) + 1)), code.astype(np.int32))
            for i in range(0, len(row), BATCH_ROWS):
                r, k = pa.array(row[i : i + BATCH_ROWS]), code[i : i + BATCH_ROWS]
                columns = [pa.array((k // 4).astype(np.int32)), b.column("id").take(r), b.column("n").take(r), pa.array((k % 4).astype(np.int8)), v.take(r), visits.take(r)]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "id", "n", "flag", "v", "visits"])

    def tally(batches):
        """Of each part, rows and those at home."""
        cells, under = levels()
        for b in batches:
            if b.num_rows:
                _, code = places(unit(listed(b.column("__v"), dim)), cells, under)
                cell, at = np.unique(code // 4, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(np.bincount(at)), pa.array(np.bincount(at, code % 4 == 3).astype(np.int64))], ["cell", "rows", "homes"])

    placed = classes.mapInArrow(trimmed(assign), _PLACED)
    # A row for each part to split, of at most most_cells * most_parts.
    counts = classes.mapInArrow(trimmed(tally), "cell int, rows long, homes long").groupBy("cell").agg(F.sum("rows").alias("rows"), F.sum("homes").alias("homes"))
    blocks = F.ceil(F.greatest(F.col("homes") / block_rows, F.col("rows") / (16 * block_rows))).cast("int")
    split = scratch.keep(counts.select("cell", blocks.alias("blocks")).where("blocks > 1"), "split")
    dealt = placed.join(F.broadcast(split), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("blocks", "other")

    def compare(key, g):
        cell, one, two = (k.as_py() for k in key)
        g = g.sort_by("id")
        ids, n, flag, block = (g.column(c).to_numpy() for c in ("id", "n", "flag", "block"))
        x = np.frombuffer(b"".join(g.column("v").to_pylist()), sent).astype(np.float64).reshape(-1, dim)
        found = list(_meetings(x / np.abs(x).max(axis=1, keepdims=True), flag, block, least, one != two))
        r, c = (np.concatenate([np.zeros(0, np.int64), *z]) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        if len(r):
            on = Visits(g.column("visits").to_pylist(), parts).first(r, c, cell)
            r, c = r[on], c[on]
        links = (np.bincount(r, n[c], len(ids)) + np.bincount(c, n[r], len(ids))).astype(np.int64)
        labels = _local(ids, r, c)
        on = links > 0
        return pa.table({"id": ids[on], "links": links[on], "label": labels[on]})

    met = scratch.keep(dealt.groupBy("cell", "one", "two").applyInArrow(compare, "id long, links long, label long"), "met")
    same = components(met.select(F.col("id").alias("a"), F.col("label").alias("b")), scratch)
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    results = ("n_links", "component_id", "kept")
    by_class = classes.join(links, "id", "left").join(same, "id", "left").select(
        F.col("__v").alias("cv"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    out = rows.join(by_class, rows["__v"] == by_class["cv"], "left").select(
        *cols_back(pairs, results), "__id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "__id").alias("component_id")
    )
    return out.withColumn("kept", F.col("__id").eqNullSafe(F.col("component_id"))).select(*shown(pairs, *results), *results)


def cols_back(pairs, results) -> list:
    return [F.col(inner) for inner, name in pairs if name not in results]
