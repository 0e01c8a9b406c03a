"""Collocations: phrases whose words stand together more often than their parts would by chance.

A shard of texts becomes a count trie of at most five words' depth, written sorted by language and path. Tries are merged by ranges
of paths, wherever those cut: a walk along a range sums the shards' counts, and when a node closes, the counts of the nodes above
it are its left parts. Right parts are the nodes that suffix links lead to. Nodes that lie on a range's first or last
path may go on in the neighbouring ranges: what each range has of them is summed afterwards.

A phrase is no more frequent than any two neighbouring words in it, so a first pass counts neighbours by 64-bit hashes, and tries go
deeper only where a bit table says that a pair may be frequent. The table has a fixed size; a bit set for nothing costs a node, no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, small_batches, trimmed
from .words import mixed

LONGEST = 5
#: Bytes of text in a shard's trie; a longer text is cut where a piece ends.
SHARD_BYTES = 4 << 20
#: The table of pairs that may be frequent has 2^27 bits: 16 MB, whatever the corpus.
TABLE_BITS = 27
ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[list(ENDS)] = 2


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts of at most a shard's size, cut at ends of pieces; only a piece may be longer."""
    while len(text) > most:
        at = max(text.rfind(bytes([c]), 0, most) for c in ENDS)
        if at < 0:
            at = min((k for c in ENDS if (k := text.find(bytes([c]), most)) >= 0), default=len(text) - 1)
        yield text[: at + 1]
        text = text[at + 1 :]
    yield text


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(languages, texts) of runs of about ``most`` bytes."""
    langs, texts, size = [], [], 0
    for b in batches:
        for lang, text in zip(b.column(0), b.column(1), strict=True):
            for part in _parts(text.as_py(), most):
                langs.append(lang.as_py())
                texts.append(part)
                size += len(part)
                if size >= most:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if size:
        yield langs, texts


def _words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(id of each word, the distinct words, whether the next word is in the same piece, each word's text)."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    low = _LOWER[raw]
    kind = _KIND[low]
    solid = kind == 0
    edges = np.flatnonzero(np.diff(solid, prepend=False))
    begin, end = edges[0::2], edges[1::2]
    offsets = np.zeros(len(begin) + 1, np.int32)
    np.cumsum(end - begin, out=offsets[1:])
    spelt = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(low[solid])]).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    goes_on = np.zeros(len(begin), bool)
    goes_on[:-1] = piece[1:] == piece[:-1]
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return spelt.indices.to_numpy(zero_copy_only=False).astype(np.int64), spelt.dictionary, goes_on, np.searchsorted(starts, begin, "right") - 1


def _hashes(names: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in names], np.uint64)


def _pairs(langs: list[bytes], ids: np.ndarray, spelt: pa.Array, goes_on: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of words that another follows, hash of language and both words)."""
    at = np.flatnonzero(goes_on)
    word, lang = _hashes(spelt.to_pylist()), _hashes(langs)
    first = mixed(word[ids[at]] + lang[text[at]])
    return at, mixed(first * np.uint64(0x9E3779B97F4A7C15) + word[ids[at + 1]])


def _count_pairs(shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Neighbouring words of each shard by hash, with how many there are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _shards(batches, shard_bytes):
            found = np.sort(_pairs(langs, *_words(texts))[1])
            new = np.flatnonzero(np.diff(found, prepend=~found[:1]) != 0)
            yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64)), pa.array(np.diff(new, append=len(found)).astype(np.int64))], names=["pair", "c"])

    return trimmed(read)


def _trie(langs: list[bytes], ids: np.ndarray, spelt: pa.Array, text: np.ndarray, reach: np.ndarray) -> pa.Table:
    """lang, path (each word with a space after it), c: how many places end their path there; sorted.

    Level by level: a node is a node above and a word. ``reach`` says how many words the path from a place has.
    """
    kinds = pa.array(langs, pa.binary()).dictionary_encode()
    lang, path = kinds.dictionary, pa.array([b""] * len(kinds.dictionary), pa.binary())
    at, node, level, out = np.arange(len(ids)), kinds.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text], 0, []
    while len(at):
        keys, node = np.unique(node * len(spelt) + ids[at + level], return_inverse=True)
        above = pa.array(keys // len(spelt))
        lang = lang.take(above)
        path = pc.binary_join_element_wise(path.take(above), spelt.take(pa.array(keys % len(spelt))), b"")
        path = pc.binary_join_element_wise(path, pa.scalar(b" "), b"")
        level += 1
        ends = reach[at] == level
        c = np.bincount(node[ends], minlength=len(keys))
        some = pa.array(np.flatnonzero(c))
        out.append(pa.table({"lang": lang.take(some), "path": path.take(some), "c": pa.array(c[c > 0].astype(np.int64))}))
        at, node = at[~ends], node[~ends]
    table = pa.concat_tables(out)
    return table.take(pc.sort_indices(table, [("lang", "ascending"), ("path", "ascending")]))


def _tries(table_of: Callable[[], np.ndarray], bits: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of()
        for langs, texts in _shards(batches, shard_bytes):
            ids, spelt, goes_on, text = _words(texts)
            if not len(ids):
                continue
            at, pairs = _pairs(langs, ids, spelt, goes_on, text)
            spot = pairs >> np.uint64(64 - bits)
            may = np.zeros(len(ids) + LONGEST, bool)
            may[at] = table[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1) > 0
            reach, on = np.ones(len(ids), np.int64), np.ones(len(ids), bool)
            for k in range(LONGEST - 1):
                on &= may[k : k + len(ids)]
                reach += on
            yield from _trie(langs, ids, spelt, text, reach).combine_chunks().to_batches()

    return trimmed(read)


class _Walk:
    """A sorted run of paths -> nodes with at least ``least`` places, and all that may go on outside the run.

    The stack holds the present path: [word, count, open, nodes found below]. A node found below waits for the counts above it.
    """

    def __init__(self, least: int):
        self.least, self.stack, self.lang, self.path = least, [], None, None
        self.out: list[tuple] = []

    def _close(self, opened: bool) -> None:
        word, count, first, below = self.stack.pop()
        opened = opened or first
        if self.stack:
            self.stack[-1][1] += count
        kept = [((word, *words), a, [None if opened else count, *left], o) for words, a, left, o in below]
        if opened or count >= self.least:
            kept.append(((word,), count, [], opened))
        if self.stack:
            self.stack[-1][3].extend(kept)
        else:
            self.out.extend((self.lang, b" ".join(words), len(words), a, left, o) for words, a, left, o in kept)

    def add(self, lang: bytes, path: bytes, count: int) -> None:
        if path == self.path and lang == self.lang:
            self.stack[-1][1] += count
            return
        words = path.split(b" ")[:-1]
        first = self.path is None
        same = 0
        if lang == self.lang:
            for node, word in zip(self.stack, words, strict=False):
                if node[0] != word:
                    break
                same += 1
        while len(self.stack) > same:
            self._close(False)
        self.lang, self.path = lang, path
        self.stack.extend([word, 0, first, []] for word in words[same:])
        self.stack[-1][1] += count

    def end(self) -> None:
        while self.stack:
            self._close(True)

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "phrase", "depth", "a", "left", "open"])


def _walked(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(least)
        for b in batches:
            for lang, path, count in zip(b.column("lang").to_pylist(), b.column("path").to_pylist(), b.column("c").to_pylist(), strict=True):
                walk.add(lang, path, count)
            if walk.out:
                yield walk.batch()
        walk.end()
        if walk.out:
            yield walk.batch()

    return trimmed(read)


def pair_table(texts: DataFrame, least: int, bits: int, shard_bytes: int) -> np.ndarray:
    """A table of 2^bits bits, set where a pair with at least ``least`` places has its hash; gathered as 64-bit words."""
    seen = texts.mapInArrow(_count_pairs(shard_bytes), "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    spots = seen.select(F.shiftrightunsigned("pair", 64 - bits).alias("spot"))
    one = F.expr("shiftleft(1L, cast(spot & 63 AS INT))")
    words = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table


def nodes(docs: DataFrame, least: int, scratch: Scratch, text: str = "text", lang: str = "lang", bits: int = TABLE_BITS, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases of 1 to 5 words with at least ``least`` places: lang, phrase, depth, a, left (counts of the first 1, 2, ... words);
    words by language: lang, n)."""
    spark = docs.sparkSession
    small_batches(spark)
    said = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANG)).cast("binary").alias("lang"), F.col(f"`{text}`").cast("binary").alias("text")).where("text IS NOT NULL")
    shared = spark.sparkContext.broadcast(pair_table(said, least, bits, shard_bytes))
    tries = scratch.keep(said.mapInArrow(_tries(lambda: shared.value, bits, shard_bytes), "lang binary, path binary, c long"), "tries")
    shared.unpersist()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Shards' counts of a path are summed within its range: the sum has the ranges' partitioning, so nothing moves again.
    runs = tries.repartitionByRange(n, "lang", "path").groupBy("lang", "path").agg(F.sum("c").alias("c")).sortWithinPartitions("lang", "path")
    walked = scratch.keep(runs.mapInArrow(_walked(least), "lang binary, phrase binary, depth int, a long, left array<long>, open boolean"), "walked")
    at_edges = walked.where("open").groupBy("lang", "phrase", "depth").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    at_edges = scratch.keep(at_edges.withColumn("left", F.array_repeat(F.lit(None).cast("long"), F.col("depth") - 1)), "edges")
    closed = walked.where("NOT open").drop("open")
    lacking = F.exists("left", lambda x: x.isNull())
    mine = at_edges.select(F.col("lang").alias("l"), F.col("phrase").alias("p"), F.col("a").alias("b"))
    mend = closed.where(lacking).unionByName(at_edges)
    words = F.split(F.col("phrase").cast("string"), " ", -1)
    for k in range(1, LONGEST):
        # A node above that is open is in the table of edges, with all its places.
        above = F.when((F.col("depth") > k) & F.get("left", F.lit(k - 1)).isNull(), F.array_join(F.slice(words, 1, k), " ").cast("binary"))
        mend = mend.join(mine, (F.col("lang") == F.col("l")) & (above == F.col("p")), "left")
        at = F.lit(k - 1)
        mend = mend.withColumn("left", F.transform("left", lambda x, i: F.when(i == at, F.coalesce(x, F.col("b"))).otherwise(x))).drop("l", "p", "b")  # noqa: B023
    both = closed.where(~lacking).unionByName(mend)
    named = both.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "depth", "a", "left")
    count = tries.groupBy("lang").agg(F.sum("c").alias("n")).select(F.col("lang").cast("string").alias("lang"), "n")
    return scratch.keep(named, "nodes"), scratch.keep(count, "sizes")


def collocations(docs: DataFrame, least: int = 100, share: int = 100, most: int = 2000, text: str = "text", lang: str = "lang", bits: int = TABLE_BITS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``most`` best phrases of 2 to 5 words with at least ``least`` places.

    Words are runs of anything but space and tab in pieces between ``. , ; : ! ?`` and line ends; A-Z are lower-cased. n is the
    language's number of words, a the phrase's, l and r those of what stands before and after the cut with the least
    floor(1000 a n / (l r)), the first of equal ones. Phrases inside a longer one that has at least ``share`` percent of their places go.
    By score, then a, both descending, then phrase by its bytes.

    A null text is empty, a null language ``und``; rows count as often as they are there; other columns are left alone; no words, no
    rows. A text of any length is read in parts that end where pieces end. Bytes that aren't UTF-8 are kept as they are.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    found, sizes = nodes(docs, least, scratch, text, lang, bits, shard_bytes)
    scratch.drop("tries", "walked", "edges")
    words = F.split("phrase", " ", -1)
    long = found.where("depth > 1")
    # A cut after k words: the first k are a node above, the others the node that k suffix links lead to.
    cuts = long.select("lang", "phrase", "a", "depth", F.posexplode("left").alias("at", "l")).withColumn("rest", F.array_join(F.slice(words, F.col("at") + 2, F.col("depth")), " "))
    right = found.select(F.col("lang").alias("rl"), F.col("phrase").alias("rp"), F.col("a").alias("r"))
    cuts = cuts.join(right, (F.col("lang") == F.col("rl")) & (F.col("rest") == F.col("rp"))).join(sizes, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * big("a") * big("n")).withColumn("under", big("l") * big("r")).withColumn("score", F.expr("over div under"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "at", "l", "r", "a", "n")).alias("cut"))
    # One word more, before or after, is enough to ask: what is longer still is no more frequent.
    longer = found.where("depth > 2").select("lang", "a", F.explode(F.array(F.array_join(F.slice(words, 2, LONGEST), " "), F.array_join(F.slice(words, F.lit(1), F.col("depth") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("within").isNull() | (100 * F.col("within") < share * F.col("cut.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = kept.select("lang", "phrase", *[F.col(f"cut.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
