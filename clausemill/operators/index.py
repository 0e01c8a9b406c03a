"""Retrieval for many queries at once: a kept inverted file of cards with product-quantised residuals.

A card lies in the list of its nearest centroid; what is left of its vector is kept as a short code, with how far the code is off. So
a query knows each card's similarity to within that distance, and a list's best to within the list's radius: a first visit to each query's
nearest lists gives the least score that its k-th card has, a second one the cards that may reach it, scored by their vectors, which lie
beside the codes. The second goes by shards, which are runs of lists: a query comes to a shard once, whatever it visits
there, and leaves with its k best, so what moves grows with queries times shards and not with visits or cards that may do. Filters hold
inside the lists, before anything is counted. Queries are rows of a table like any other: nothing of
them, or of the cards, passes through the driver but a bounded sample to fit from and one row for each list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import delete_folder

#: Structural filters of a query: null asks for nothing.
FILTERS = {"document_id": "long", "article": "string", "khoan": "string", "actor": "string", "topic": "string", "penalty": "boolean"}
CODES = "card_id long, list int, block int, shard int, code binary, off float, vector binary, document_id long, article string, khoans array<string>, actor string, topics array<string>, penalty boolean"
MODEL = "kind string, at int, data binary"
#: Single precision, and sums of products in another order: what a bound may be wrong by.
ROUNDING = 1e-5
#: A task holds so many queries beside a block or shard at most; more of them go round in turns.
QUERY_BLOCK = 65_536
#: Scores that a task holds at a time.
SCORES = 4_000_000


@dataclass(frozen=True)
class Settings:
    """lists: at most so many, of about ``list_cards`` cards; pieces: parts of a vector that get a code of their own; the sample to fit from has
    at most twice ``fit_rows`` cards; a block is the part of a list that one task holds at a time, a shard is so many cards in blocks of lists that are near each other."""

    lists: int = 4096
    list_cards: int = 128
    pieces: int = 16
    fit_rows: int = 16_384
    block_cards: int = 4096
    shard_cards: int = 65_536
    seed: int = 17


def _unit(rows: list, dim: int) -> np.ndarray:
    x = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x[i] = np.asarray(r, np.float64)
    return np.divide(x, np.linalg.norm(x, axis=1, keepdims=True), out=np.zeros_like(x), where=np.linalg.norm(x, axis=1, keepdims=True) > 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from k of the rows; an empty one stays where it was."""
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        home = _nearest(x, centres)
        sums, n = np.zeros_like(centres), np.bincount(home, minlength=len(centres))
        np.add.at(sums, home, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class Model:
    """Centroids of the lists, and of each piece of what is left of a vector."""

    def __init__(self, centroids: np.ndarray, books: list[np.ndarray]):
        self.centroids, self.books = centroids, books
        self.dim = centroids.shape[1]
        self.cuts = np.linspace(0, self.dim, len(books) + 1).astype(int)

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, pieces: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        centroids = _kmeans(x, lists, rng)
        left = x - centroids[_nearest(x, centroids)]
        cuts = np.linspace(0, x.shape[1], pieces + 1).astype(int)
        return cls(centroids, [_kmeans(left[:, a:z], 256, rng) for a, z in zip(cuts, cuts[1:], strict=False)])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, code, how far the code is off, how far the vector is from its centroid) of each row."""
        home = _nearest(x, self.centroids)
        left = x - self.centroids[home]
        code = np.stack([_nearest(left[:, a:z], b) for a, z, b in zip(self.cuts, self.cuts[1:], self.books, strict=False)], axis=1).astype(np.uint8)
        return home, code, np.linalg.norm(left - self.decode(code), axis=1), np.linalg.norm(left, axis=1)

    def decode(self, code: np.ndarray) -> np.ndarray:
        return np.concatenate([b[code[:, i]] for i, b in enumerate(self.books)], axis=1)


def _dim(cards: DataFrame) -> int:
    return cards.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]


def described(cards: DataFrame, clauses: DataFrame) -> DataFrame:
    """Cards with what filters ask for: article is the number of their article, khoans those of the clauses in it."""
    number = F.regexp_extract("citation", r"^Điều (.*)$", 1)
    below = clauses.where("kind = 'khoan'").groupBy(F.col("document_id").alias("d"), F.col("dieu").alias("a")).agg(F.sort_array(F.collect_set("number")).alias("khoans"))
    rows = cards.withColumn("article", number)
    rows = rows.join(below, (F.col("document_id") == F.col("d")) & (F.col("article") == F.col("a")), "left").drop("d", "a")
    return rows.withColumn("actor", F.col("bound_actor")).withColumn("topics", F.col("topic_tags")).withColumn("penalty", F.col("penalty").isNotNull())


def _lengths(x: np.ndarray) -> np.ndarray:
    """As ``vectors.norm`` to the last bit: sums in the order of the components."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        v = x[:, j].astype(np.float64)
        total += v * v
    return np.sqrt(total)


def _cosines(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of the rows of a and b in pairs, as ``vectors.dot`` over the product of their lengths to the last bit, so that copies tie."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j].astype(np.float64) * b[:, j].astype(np.float64)
    return np.divide(total, sizes, out=np.zeros(len(a)), where=sizes > 0)


def _shards(model: Model, sizes: np.ndarray, blocks: np.ndarray, settings: Settings) -> np.ndarray:
    """Rows (list, block, shard): lists in an order in which near ones are neighbours are cut into shards between blocks."""
    coarse = _kmeans(model.centroids, max(1, int(len(model.centroids) ** 0.5)), np.random.default_rng(settings.seed))
    order = np.argsort(_nearest(model.centroids, coarse), kind="stable")
    many = blocks[order].astype(int)
    lists = np.repeat(order, many)
    at = np.arange(len(lists)) - np.repeat(np.cumsum(many) - many, many)
    each = sizes[lists] / blocks[lists]
    return np.stack([lists, at, ((np.cumsum(each) - each) // settings.shard_cards).astype(int)], axis=1)


class Index:
    """Tables under a path: ``model`` and ``codes`` (by shard), which are all that a search reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.codes = spark.read.schema(CODES).parquet(f"{self.path}/codes")
        parts: dict[str, list] = {}
        for r in spark.read.schema(MODEL).parquet(f"{self.path}/model").orderBy("kind", "at").collect():  # one row for each piece
            parts.setdefault(r["kind"], []).append(np.frombuffer(r["data"]))
        self.model = None
        if "lists" in parts:
            dim, pieces = (int(v) for v in parts["shape"][0])
            cuts = np.linspace(0, dim, pieces + 1).astype(int)
            self.model = Model(parts["lists"][0].reshape(-1, dim), [b.reshape(-1, z - a) for b, a, z in zip(parts["piece"], cuts, cuts[1:], strict=False)])
            self.radius, self.blocks = parts["radius"][0], parts["blocks"][0].astype(int)
            self.shards = parts["shards"][0].astype(int).reshape(-1, 3)

    @classmethod
    def build(cls, cards: DataFrame, path: str, settings: Settings = Settings()) -> Index:  # noqa: B008
        """cards (card_id, embedding, and what ``described`` adds); those without a vector, or with one of another length than the longest, can't be found.

        A card's id stands once; building again replaces the index.
        """
        spark = cards.sparkSession
        live = cards.where("embedding IS NOT NULL AND card_id IS NOT NULL")
        dim = _dim(live)
        live = live.where(F.size("embedding") == dim) if dim else live.where("false")
        size = live.count()
        rows: list[tuple] = []
        if size:
            every = max(1, size // settings.fit_rows)
            sample = live.where(F.pmod(F.xxhash64("card_id", F.lit(settings.seed)), F.lit(every)) == 0).select("card_id", "embedding").limit(2 * settings.fit_rows).toPandas().sort_values("card_id")
            x = _unit(list(sample["embedding"]), dim) if len(sample) else _unit([live.first()["embedding"]], dim)
            model = Model.fit(x, max(1, min(settings.lists, size // settings.list_cards)), max(1, min(settings.pieces, dim)), settings.seed)
        else:
            model = Model(np.zeros((1, 1)), [np.zeros((1, 1))])
        held = spark.sparkContext.broadcast(model)
        about = ["document_id", "article", "khoans", "actor", "topics", "penalty"]

        def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                home, code, off, far = held.value.encode(_unit(list(b["embedding"]), held.value.dim))
                vector = [np.asarray(v, np.float32).tobytes() for v in b["embedding"]]
                out = b.drop(columns="embedding")
                yield out.assign(vector=vector, list=home.astype(np.int32), code=[c.tobytes() for c in code], off=np.nextafter(off.astype(np.float32), np.float32(9)), far=far)

        said = live.select("card_id", "embedding", *about)
        made = said.mapInPandas(encode, "card_id long, document_id long, article string, khoans array<string>, actor string, topics array<string>, penalty boolean, list int, code binary, off float, far double, vector binary")
        made.write.mode("overwrite").parquet(f"{path}/raw")
        raw = spark.read.parquet(f"{path}/raw")
        # One row for each list: how far its cards lie from its centroid, and in how many blocks it is held.
        stats = raw.groupBy("list").agg(F.max("far").alias("far"), F.count("*").alias("n")).toPandas() if size else pd.DataFrame({"list": [], "far": [], "n": []})
        radius, blocks = np.full(len(model.centroids), -np.inf), np.ones(len(model.centroids))
        sizes = np.zeros(len(model.centroids))
        sizes[stats["list"].astype(int)] = stats["n"]
        radius[stats["list"].astype(int)], blocks[stats["list"].astype(int)] = stats["far"], np.ceil(stats["n"] / settings.block_cards)
        shards = np.zeros((0, 3), int)
        if size:
            rows = [("shape", 0, np.array([model.dim, len(model.books)], float)), ("lists", 0, model.centroids), ("radius", 0, radius), ("blocks", 0, blocks), ("shards", 0, (shards := _shards(model, sizes, blocks, settings))), *[("piece", i, b) for i, b in enumerate(model.books)]]
        spark.createDataFrame([(k, i, bytearray(np.ascontiguousarray(d, float).tobytes())) for k, i, d in rows], MODEL).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        per = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "l int, blocks int")
        placed = raw.join(F.broadcast(per), F.col("list") == F.col("l")).withColumn("block", F.pmod(F.xxhash64("card_id"), F.col("blocks")).cast("int"))
        of = spark.createDataFrame([tuple(map(int, r)) for r in shards], "sl int, sb int, shard int")
        placed = placed.join(F.broadcast(of), (F.col("list") == F.col("sl")) & (F.col("block") == F.col("sb")))
        names = [x.split()[0] for x in CODES.split(", ")]
        placed.select(*names).repartition("shard").sortWithinPartitions("shard", "list", "block").write.mode("overwrite").parquet(f"{path}/codes")
        delete_folder(spark, f"{path}/raw")
        return cls(spark, path)

    def _visits(self, queries: DataFrame, wanted: str, probes: int) -> DataFrame:
        """queries (query_id, q, filters, floor) -> a row for each block of each of a query's nearest lists, or for each shard that may hold a card above its floor."""
        held = self.spark.sparkContext.broadcast((self.model, self.radius, self.blocks, self.shards))
        fields = ", ".join(f"{c} {t}" for c, t in FILTERS.items())

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model, radius, blocks, shards = held.value
            # Which lists a shard has blocks of.
            among, pairs = shards[:, 2].max() + 1, np.unique(shards[:, [2, 0]], axis=0)
            begins = np.searchsorted(pairs[:, 0], np.arange(among))
            for b in batches:
                for i in range(0, len(b), 256):
                    part = b.iloc[i : i + 256]
                    base = _unit(list(part["q"]), model.dim) @ model.centroids.T
                    if wanted == "shards":
                        best = np.maximum.reduceat((base + radius)[:, pairs[:, 1]], begins, axis=1)
                        row, shard = np.nonzero(best + ROUNDING >= part["floor"].to_numpy()[:, None])
                        yield part.iloc[row].assign(shard=shard.astype(np.int32))
                        continue
                    order = np.argsort(-np.where(radius >= 0, base, -np.inf), axis=1, kind="stable")[:, :probes]
                    seen = np.zeros(base.shape, bool)
                    np.put_along_axis(seen, order, True, axis=1)
                    seen &= radius >= 0
                    row, lists = np.nonzero(seen)
                    many = blocks[lists]
                    block = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    out = part.iloc[np.repeat(row, many)]
                    yield out.assign(list=np.repeat(lists, many).astype(np.int32), block=block.astype(np.int32))

        return queries.mapInPandas(visit, f"query_id long, q array<float>, floor double, {fields}, " + ("shard int" if wanted == "shards" else "list int, block int"))

    def _scan(self, visits: DataFrame, by: list[str], k: int, slack: float, turns: int) -> DataFrame:
        """The k best cards that each query finds in each block or shard that it visits, of those that pass its filters and may reach its floor."""
        held = self.spark.sparkContext.broadcast((self.model, self.radius))

        def scan(key: tuple, asked: pd.DataFrame, cards: pd.DataFrame) -> pd.DataFrame:
            out: list[pd.DataFrame] = []
            if len(asked) and len(cards):
                model, radius = held.value
                cards = cards.sort_values(["list", "card_id"], ignore_index=True)
                x = np.frombuffer(b"".join(cards["vector"]), np.float32).reshape(len(cards), -1)
                length, ids = _lengths(x), cards["card_id"].to_numpy()
                unit = np.divide(x, length[:, None], out=np.zeros(x.shape, np.float32), where=length[:, None] > 0, casting="same_kind")
                lists, begins = np.unique(cards["list"].to_numpy(), return_index=True)
                ends = np.append(begins[1:], len(cards))
                if slack < 1:
                    code = np.frombuffer(b"".join(cards["code"]), np.uint8).reshape(len(cards), -1)
                    about = model.centroids[cards["list"].to_numpy()] + model.decode(code)
                    off = cards["off"].to_numpy(np.float64) * slack + ROUNDING
                passes = _Filter(cards)
                step = max(1, min(512, SCORES // len(cards)))
                # Queries with the same filters or near vectors skip the same cards.
                asked = asked.sort_values([*FILTERS, "floor"], ignore_index=True)
                for i in range(0, len(asked), step):
                    part = asked.iloc[i : i + step]
                    said = np.stack([np.asarray(v, np.float32) for v in part["q"]])
                    q, size, floor = _unit(list(said), model.dim), _lengths(said), part["floor"].to_numpy()
                    may = (q @ model.centroids[lists].T + radius[lists] + ROUNDING >= floor[:, None]).any(axis=0)
                    near = np.repeat(may, ends - begins)
                    alike: dict[tuple, list[int]] = {}
                    for n, row in enumerate(part[list(FILTERS)].itertuples(index=False)):
                        alike.setdefault(tuple(None if pd.isna(v) else v for v in row), []).append(n)
                    for filters, of in alike.items():
                        rows, cols = np.array(of), np.flatnonzero(passes(filters) & near)
                        if not len(cols):
                            continue
                        score = q[rows].astype(np.float32) @ unit[cols].T
                        if slack < 1:
                            score = np.where(q[rows] @ about[cols].T + off[cols] >= floor[rows, None], score, -np.inf)
                        least = floor[rows] - ROUNDING
                        if len(cols) > k:
                            least = np.maximum(least, np.partition(score, len(cols) - k, axis=1)[:, len(cols) - k] - 2 * ROUNDING)
                        a, z = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                        for at in range(0, len(a), SCORES // 8):
                            r, c = rows[a[at : at + SCORES // 8]], cols[z[at : at + SCORES // 8]]
                            out.append(pd.DataFrame({"query_id": part["query_id"].to_numpy()[r], "card_id": ids[c], "score": _cosines(x[c], said[r], length[c] * size[r])}))
                            if at:  # many that are as near, as copies are: k of each query are enough
                                out[-2:] = [_first(pd.concat(out[-2:]), k)]
                        if len(a):
                            out[-1] = _first(out[-1], k)
            return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "card_id": np.zeros(0, np.int64), "score": np.zeros(0)})

        by = [*by, "turn"]
        asked = visits.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int"))
        cards = self.codes.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        return asked.groupBy(*by).cogroup(cards.groupBy(*by)).applyInPandas(scan, "query_id long, card_id long, score double")

    def search(self, queries: DataFrame, k: int = 10, probes: int = 8, slack: float = 1.0) -> DataFrame:
        """queries (query_id, embedding, any of FILTERS) -> query_id, rank, card_id, score: each query's k best cards by cosine, ties to the smaller id.

        With ``slack`` 1 the result is that of comparing all; with less of the codes' distances allowed for, fewer cards are scored and
        some may be missed. Queries without an id, or a vector of the index's length, find nothing; ids stand once.
        """
        asked = [F.col(c).cast(t).alias(c) if c in queries.columns else F.lit(None).cast(t).alias(c) for c, t in FILTERS.items()]
        if self.model is None:
            return self.spark.createDataFrame([], "query_id long, rank int, card_id long, score double")
        live = queries.where("query_id IS NOT NULL").where(F.size("embedding") == self.model.dim)
        live = live.select("query_id", F.col("embedding").cast("array<float>").alias("q"), F.lit(-2.0).alias("floor"), *asked)
        turns = max(1, -(-live.count() // QUERY_BLOCK))
        sure = self._scan(self._visits(live, "nearest", probes), ["list", "block"], k, 1.0, turns)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"))
        floors = sure.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
        raised = live.join(floors, F.col("query_id") == F.col("id"), "left").withColumn("floor", F.coalesce("least", "floor")).select(*live.columns)
        scored = self._scan(self._visits(raised, "shards", probes), ["shard"], k, slack, turns)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "card_id"))
        return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "card_id", "score")


def _first(scored: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k best, ties to the smaller id."""
    return scored.sort_values(["query_id", "score", "card_id"], ascending=[True, False, True]).groupby("query_id").head(k)


class _Filter:
    """Which of a block's cards a query's filters let through; each value is worked out once."""

    def __init__(self, cards: pd.DataFrame):
        self.cards, self.known = cards, {}

    def _one(self, name: str, value) -> np.ndarray:
        if (name, value) not in self.known:
            several = {"khoan": "khoans", "topic": "topics"}.get(name)
            if several:
                mask = np.array([v is not None and value in list(v) for v in self.cards[several]])
            else:
                mask = (self.cards[name] == value).to_numpy(bool)
            self.known[name, value] = mask
        return self.known[name, value]

    def __call__(self, asked) -> np.ndarray:
        mask = np.ones(len(self.cards), bool)
        for name, value in zip(FILTERS, asked, strict=True):
            if not pd.isna(value):
                mask &= self._one(name, value)
        return mask
