"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is one stream: its documents in a keyed pseudo-random order, ``most`` times one after the
other. The stream is ruled off into blocks of ``block_words``; a document belongs to the block its first
word falls in. A keyed permutation puts a source's blocks in an order, and its quota of blocks is the first
of them whose words reach its target, rounded; the last of these is cut where it does, which is the only
place where a document is cut. So a quota is exact in blocks, and met to the word.

The tree shares the quotas out: its root holds each source's number of blocks, each node draws its left
half of the output shards a part of them without replacement (so the sources' counts are a
multivariate-hypergeometric draw) and leaves its right half the rest. A leaf, one shard, thus has exact
counts, and takes so many blocks of each source: the next ones of the permuted order that the leaves before it
didn't take. What the leaves draw is the mix; a document is taken as often as a block that has it is drawn.
Each shard is put in a keyed order of its own.

Nothing of the size of a source is gathered: positions come from sums over (source, bucket) pairs, of
which there are at most ``BUCKETS`` plus one per source, and from windows within one bucket. Blocks are at
most ``MOST_BLOCKS`` and two for each source, as they grow with the tables beyond that; one row for each goes
to the driver, which draws, and to all tasks. Where blocks grow, shards do too, to ``SHARD_BLOCKS`` blocks at least.

Defined results: null text has size 0; a null source is a source of its own, last in order; documents
of size 0 are taken with the words around them and count nothing; repeated rows are documents of their
own, and rows of one doc_id and text have places next to each other; an empty table gives an empty mix; other
columns pass through, but for those with a result's name, which gives way to it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, hidden, rows_of, shown, small_batches, word_count

BUCKETS = 100_000
LEAST_BUCKET = 512
MOST_BLOCKS = 1 << 18
SHARD_BLOCKS = 64


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; what exceeds ``most`` times a size is shared among the others, until none does."""
    got, open_ = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0]
    left = min(total, most * sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                got[i] = unit * weights[i]
            break
        for i in full:
            got[i] = float(most * sizes[i])
            left -= got[i]
        open_ = [i for i in open_ if i not in full]
    return got


def _keys(*parts) -> list[str]:
    return [hashlib.md5(":".join(map(str, p)).encode()).hexdigest() for p in zip(*parts, strict=True)]


class SplittingTree:
    """Exact shares of the sources' quotas of blocks for each of ``shards``.

    A node with its shards from ``lo`` on draws by the keys seed:lo:source:place of its blocks, the least
    going left; its draw depends on these alone, so any node's can be made again.
    """

    def __init__(self, quotas: Sequence[int], shards: int, seed: int):
        self.quotas, self.shards, self.seed = np.array(quotas, np.int64), shards, seed

    def _left(self, lo: int, mid: int, hi: int, counts: np.ndarray) -> np.ndarray:
        part = int(counts.sum()) * (mid - lo) // (hi - lo)
        source = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = np.array(_keys([f"{self.seed}:{lo}:{hi}"] * len(source), source.tolist(), place.tolist()) or [""])
        drawn = source[np.argsort(keys[: len(source)], kind="stable")[:part]]
        return np.bincount(drawn, minlength=len(counts))

    def leaves(self) -> np.ndarray:
        """Blocks by shard and source."""
        out = np.zeros((self.shards, len(self.quotas)), np.int64)
        stack = [(0, self.shards, self.quotas)]
        while stack:
            lo, hi, counts = stack.pop()
            if hi - lo == 1:
                out[lo] = counts
            else:
                mid = (lo + hi) // 2
                left = self._left(lo, mid, hi, counts)
                stack += [(lo, mid, left), (mid, hi, counts - left)]
        return out


def drawn_blocks(blocks: pd.DataFrame, quotas: Sequence[int], shard_words: int, seed: int) -> pd.DataFrame:
    """blocks (i, block, words) -> (i, block, room, shard) of those that the leaves draw; room: the words taken of it."""
    blocks = blocks.assign(key=_keys([seed] * len(blocks), blocks["i"], blocks["block"])).sort_values(["i", "key", "block"])
    i, words = blocks["i"].to_numpy(np.int64), blocks["words"].to_numpy(np.int64)
    quota = np.asarray(quotas, np.int64)[i] if len(i) else np.zeros(0, np.int64)
    first = np.searchsorted(i, i)
    before = np.cumsum(words) - words
    before -= before[first] if len(i) else 0
    room = np.clip(quota - before, 0, words)
    taken = before < quota
    tree = SplittingTree(np.bincount(i[taken], minlength=len(quotas)), max(1, math.ceil(sum(quotas) / shard_words)), seed)
    shares = tree.leaves()
    # Source by source, the leaves take the next blocks of the permuted order.
    shard = np.concatenate([np.repeat(np.arange(tree.shards), shares[:, k]) for k in range(len(quotas))] or [np.zeros(0, np.int64)])
    out = blocks.loc[taken, ["i", "block"]].assign(room=room[taken], shard=shard)
    return out.astype({"i": "int32", "block": "int64", "room": "int64", "shard": "int64"})


def cycle_weights(sources: Sequence[str | None], weights: Sequence[float] = (5, 2, 1)) -> list[float]:
    """The default: sources in their order have these weights, repeating."""
    return [weights[i % len(weights)] for i in range(len(sources))]


def mix_plan(
    docs: DataFrame,
    *,
    weigh: Callable[[Sequence[str | None]], Sequence[float]] = cycle_weights,
    ratio: float = 1.5,
    most: int = 2,
    size: Column | None = None,
    text_key: Column | None = None,
    carry: list[str] | None = None,
    block_words: int = 4096,
    shard_words: int = 1 << 18,
    seed: int = 17,
) -> DataFrame:
    """One row per document: the carried columns, mix_size, mix_source_size, mix_target and mix_draws.

    mix_draws has a struct (pass, shard, words) for each time the mix takes the document; words is less
    than the size where the quota ends inside it. ``weigh`` maps the sources, sorted by code point with
    null last, to weights; sources are listed on the driver, one number each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cols, pairs = hidden(docs, carry if carry is not None else docs.columns)
    n = (word_count(docs["text"]) if size is None else size).cast("long")
    said = F.md5(F.coalesce(docs["text"], F.lit(""))) if text_key is None else text_key
    ident = F.concat_ws(":", F.lit(str(seed)), F.coalesce(docs["doc_id"].cast("string"), F.lit("")), said)
    base = docs.select(*cols, docs["source"].cast("string").alias("__s"), n.alias("__n"), F.md5(ident).alias("__k"))

    found = base.groupBy("__s").agg(F.sum("__n").alias("n"), F.count("*").alias("rows")).collect()
    found.sort(key=lambda r: (r["__s"] is None, r["__s"] or ""))
    sizes, rows = [r["n"] for r in found], [r["rows"] for r in found]
    got = targets(sizes, list(weigh([r["__s"] for r in found])), ratio * sum(sizes), most)
    quotas = [round(t) for t in got]
    length = max(block_words, -(-most * sum(sizes) // MOST_BLOCKS))
    per = max(LEAST_BUCKET, sum(rows) // BUCKETS)
    known = rows_of(
        spark,
        [(r["__s"], i, sizes[i], got[i], math.ceil(rows[i] / per)) for i, r in enumerate(found)],
        "s string, __i int, __w long, __t double, __b int",
    )
    keyed = base.join(F.broadcast(known), base["__s"].eqNullSafe(known["s"])).drop("s")
    keyed = keyed.withColumn("__b", F.floor(F.conv(F.substring("__k", 1, 8), 16, 10).cast("long") * F.col("__b") / F.lit(2**32)).cast("int"))
    sums = keyed.groupBy("__i", "__b").agg(F.sum("__n").alias("sum"))
    before = Window.partitionBy("__i").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__i").alias("i"), F.col("__b").alias("b"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("__o"))
    placed = keyed.join(F.broadcast(sums), (F.col("__i") == F.col("i")) & (F.col("__b") == F.col("b"))).drop("i", "b")
    within = Window.partitionBy("__i", "__b").orderBy("__k", "__n").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("__o", F.col("__o") + F.coalesce(F.sum("__n").over(within), F.lit(0)))
    placed = Scratch(spark, "mix").keep(placed.drop("__k", "__s", "__b"), "placed")

    start = lambda p: F.col("__o") + p * F.col("__w")
    block = lambda p: F.floor(start(p) / F.lit(length)).cast("long")
    firsts = F.explode(F.array(*[F.struct(block(p).alias("block"), start(p).alias("at")) for p in range(most)]))
    each = placed.select("__i", "__n", firsts.alias("f")).groupBy(F.col("__i").alias("i"), F.col("f.block").alias("block")).agg(F.sum("__n").alias("words"), F.min("f.at").alias("first"))
    # At most MOST_BLOCKS rows and two for each source, here and in the broadcasts.
    each = each.toPandas()
    made = drawn_blocks(each, quotas, max(shard_words, SHARD_BLOCKS * length) if length > block_words else shard_words, seed).merge(each[["i", "block", "first"]], on=["i", "block"])
    drawn = spark.createDataFrame(pa.Table.from_pandas(made.astype({"first": "int64"}), preserve_index=False))

    draws = []
    for p in range(most):
        mine = F.broadcast(drawn.select(F.col("i").alias("i"), F.col("block").alias("b"), *[F.col(c).alias(f"__{c}{p}") for c in ("room", "shard", "first")]))
        placed = placed.join(mine, (F.col("__i") == F.col("i")) & (block(p) == F.col("b")), "left").drop("i", "b")
        left = F.col(f"__room{p}") - (start(p) - F.col(f"__first{p}"))  # words of the block's room from this document on
        words = F.least(F.col("__n"), left)
        goes = (left > 0) | ((F.col("__n") == 0) & (left == 0))
        draws.append(F.when(goes, F.struct(F.lit(p).alias("pass"), F.col(f"__shard{p}").alias("shard"), words.alias("words"))))
    taken = F.filter(F.array(*draws), lambda d: d.isNotNull())
    results = {"mix_size": F.col("__n"), "mix_source_size": F.col("__w"), "mix_target": F.col("__t"), "mix_draws": taken}
    return placed.select(*shown(pairs, *results), *[c.alias(name) for name, c in results.items()])


def first_words(text: Column, k: Column) -> Column:
    """The text up to the end of its k-th word, white space kept."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), k.cast("int")), "")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the documents' columns, a row for each time one is taken, shard by shard in a keyed order.

    Where a quota ends inside a document, its text (and n_chars, if there is one) is cut there.
    """
    seed = options.get("seed", 17)
    names = docs.columns
    cols, pairs = hidden(docs, names)
    inner = docs.select(*cols)
    back = {name: name_ for name_, name in pairs}
    plan = mix_plan(docs.select(*cols, docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), docs["text"].alias("text")), carry=inner.columns, **options)
    draw = plan.select(*inner.columns, "mix_size", F.explode("mix_draws").alias("d"))
    cut = F.col("d.words") < F.col("mix_size")
    text = F.when(cut, first_words(F.col(back["text"]), F.col("d.words"))).otherwise(F.col(back["text"]))
    order = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.col("d.pass").cast("string"), F.col(back["doc_id"]).cast("string"), F.col(back["text"])))
    draw = draw.select(*inner.columns, text.alias("__text"), cut.alias("__cut"), F.col("d.shard").alias("__shard"), order.alias("__order"))
    draw = draw.repartition("__shard").sortWithinPartitions("__shard", "__order")
    out = []
    for held, name in pairs:
        if name == "text":
            out.append(F.col("__text").alias(name))
        elif name == "n_chars":
            out.append(F.when(F.col("__cut"), F.length("__text").cast(docs.schema[name].dataType)).otherwise(F.col(held)).alias(name))
        else:
            out.append(F.col(held).alias(name))
    return draw.select(*out)
