"""Packing along a space-filling curve.

Each document's bag of words is hashed to a vector and projected to ``DIMS`` coordinates by random signs;
coordinates become ``BITS`` bits by their distribution function, and the cell's place on the Hilbert curve
is the document's key. Documents are range-sorted by key, so that neighbours on the curve have like words,
and their tokens, one end token after each, form one stream, which is cut every ``length`` tokens. What a
partition has left over after its last full sequence moves to the end of the stream. Only the stream's own
end is then left over; it is cut into pieces of powers of two, so no sequence needs padding.

One exchange deals texts to ranges; each range's pieces are written once with their places in the range,
and the ranges' totals (two numbers for each partition) turn these into places in the stream. A task holds
one document, and the pieces of about a million tokens.

Defined results: null text is empty, so its document is the end token alone; texts of any length are cut
as often as needed; documents of one key are ordered by a hash of doc_id and text; repeated rows are documents of their own; an
empty table gives no rows; columns named by ``carry`` pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch, hidden, rows_of, shown, small_batches, trimmed
from .bytebpe import Encoder, vocabulary
from .words import mixed, slices, words

DIMS, BITS = 4, 8
RANGE = 64 << 20


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with integer coordinates below 2^bits; axes: (points, dims)."""
    x, dims = axes.astype(np.int64).T.copy(), axes.shape[1]
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of the coarser levels
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(texts: pa.Array) -> np.ndarray:
    out = []
    for _, _, raw, offsets in slices(texts.fill_null("")):
        hashes, counts = words(raw, offsets)
        doc, signs = np.repeat(np.arange(len(counts)), counts), mixed(hashes)
        axes = np.stack([np.bincount(doc, weights=1.0 - 2.0 * ((signs >> np.uint64(d)) & np.uint64(1)).astype(float), minlength=len(counts)) for d in range(DIMS)], axis=1)
        # A sum of n random signs has deviation sqrt(n); the logistic curve stands for the normal distribution function.
        z = axes / np.sqrt(np.maximum(counts, 1))[:, None]
        cell = np.clip((1 / (1 + np.exp(-1.702 * z / 2)) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        out.append(hilbert(cell, BITS))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _keyed(bounds: np.ndarray):
    """Texts with their keys and the ranges that these fall in."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = _places(b)
            ranges = np.searchsorted(bounds, keys, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64()), pa.array(ranges)], [*b.schema.names, "__key", "__range"])

    return trimmed(read)


def _places(b: pa.RecordBatch) -> np.ndarray:
    """Keys on the curve, then the documents' hashes: many copies of one text fall in many ranges."""
    tie = b.column("__tie").to_numpy().view(np.uint64) >> np.uint64(64 - 63 + DIMS * BITS)
    return (curve_keys(b.column("__text")) << (63 - DIMS * BITS)) | tie.astype(np.int64)


def _bounds(inner: DataFrame, parts: int, total: int, per: int = 128) -> np.ndarray:
    """Places that cut the curve into ranges of about as much text, from some ``per`` documents a range; they decide where rows go, and nothing else."""
    some = inner.select("__text", "__tie").sample(False, min(1.0, parts * per / max(1, total)), seed=17)
    read = lambda batches: (pa.RecordBatch.from_arrays([pa.array(_places(b), pa.int64()), pc.binary_length(b.column("__text")).cast(pa.int64())], ["key", "size"]) for b in batches)
    found = some.mapInArrow(read, "key long, size long").toPandas().sort_values("key")
    if not len(found):
        return np.zeros(0)
    # Long documents of one language are near each other, so ranges are of like size by text and not by documents.
    upto = np.cumsum(found["size"].to_numpy() + 1)
    return found["key"].to_numpy()[np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)]


def pack(docs: DataFrame, *, length: int = 2048, end: int = 1, tokenizer: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Pieces: the carried columns, start, ids (array of int), doc_tokens, sequence_id, offset.

    ``tokenizer`` is a byte-level BPE file, read on every task; the default is the public vocabulary of the README.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "packing")
    small_batches(spark)
    file = tokenizer or vocabulary()
    cols, pairs = hidden(docs, list(carry))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    inner = docs.select(*cols, F.xxhash64(docs["doc_id"].cast("string"), text).alias("__tie"), text.alias("__text"))
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")).first()
    # As many ranges as keep RANGE characters in each.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["chars"] // RANGE))
    schema = T.StructType([*inner.schema.fields, T.StructField("__key", T.LongType()), T.StructField("__range", T.IntegerType())])
    keyed = inner.mapInArrow(_keyed(_bounds(inner, parts, size["rows"])), schema)
    # Ranges are partitions as they are, so that Spark needs no second look at the texts to find their bounds.
    ranged = keyed.repartitionById(parts, F.col("__range")).sortWithinPartitions("__key", "__tie").drop("__key", "__tie", "__range")
    kept = [f for f in ranged.schema.fields if f.name != "__text"]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = Encoder(file), TaskContext.get().partitionId(), 0
        done, open_ = [], []  # pieces of finished sequences, and of the one being filled
        held = 0

        def rows(pieces: list, tail: bool) -> pa.RecordBatch:
            heads, starts, sizes, places, ids = zip(*pieces, strict=True)
            n = len(pieces)
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), pa.array(np.concatenate(ids), pa.int32()))
            arrays = [*(pa.array([h[k] for h in heads], t) for k, t in enumerate(types)), *(pa.array(x, pa.int64()) for x in (starts, sizes, places, np.full(n, part))), pa.array(np.full(n, tail)), lists]
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            types = [b.schema.field(f.name).type for f in kept]
            heads = list(zip(*(b.column(f.name).to_pylist() for f in kept), strict=True)) if kept else [()] * len(b)
            texts = b.column("__text")
            for k in range(len(b)):
                ids = np.append(coder.array(texts[k].as_py()), np.int32(end))
                start = 0
                while start < len(ids):
                    take = min(len(ids) - start, length - at % length)
                    open_.append((heads[k], start, len(ids), at, ids[start : start + take]))
                    at, start = at + take, start + take
                    if at % length == 0:
                        done, open_, held = done + open_, [], held + length
                if held >= 1 << 20:
                    yield rows(done, False)
                    done, held = [], 0
        if done:
            yield rows(done, False)
        if open_:
            yield rows(open_, True)

    longs = [T.StructField(x, T.LongType()) for x in ("__start", "__n", "__at", "__part")]
    stored = T.StructType([*kept, *longs, T.StructField("__tail", T.BooleanType()), T.StructField("__ids", T.ArrayType(T.IntegerType()))])
    names = stored.names
    table = scratch.keep(ranged.mapInArrow(trimmed(tokens), stored).withColumn("__len", F.size("__ids").cast("long")), "tokens", "__tail")
    # Finished sequences come first, partition by partition; what each partition has left over makes the stream's end.
    lens = table.groupBy("__part", "__tail").agg(F.sum("__len").alias("n"), F.min("__at").alias("first")).collect()
    places, total = [], 0
    for tail in (False, True):
        for r in sorted((r for r in lens if r["__tail"] == tail), key=lambda r: r["__part"]):
            places.append((r["__part"], tail, total - r["first"]))
            total += r["n"]
    full = total - total % length
    ends, at = [], full  # where the stream's end is cut
    for b in range(length.bit_length() - 1, -1, -1):
        if (total - full) >> b & 1:
            at += 1 << b
            ends.append(at)

    # Two numbers for each partition: at most twice as many rows as the exchange has partitions.
    base = rows_of(spark, places, "__p long, __t boolean, __base long")
    placed = table.join(F.broadcast(base), (F.col("__part") == F.col("__p")) & (F.col("__tail") == F.col("__t")), "left")
    big = lambda x: F.lit(x).cast("long")
    start, n = F.col("__base") + F.col("__at"), F.col("__len")
    stop = start + n
    first, last = (F.floor(start / length) + 1).cast("long") * length, F.least(stop - 1, big(full))
    none = F.array().cast("array<bigint>")
    whole = F.when(first <= last, F.sequence(first, F.greatest(first, last), big(length))).otherwise(none)
    late = F.filter(F.array(*map(big, ends)) if ends else none, lambda x: (x > start) & (x < stop))
    cuts = F.concat(F.array(start), whole, late, F.array(stop))
    begins = F.array(*map(big, [full, *ends]))

    def piece(k):
        a, z = F.get(F.col("__cuts"), k), F.get(F.col("__cuts"), k + 1)
        extra = F.size(F.filter(begins, lambda x: x <= a)) - 1
        return F.struct(
            (F.col("__start") + a - start).alias("start"),
            F.slice("__ids", (a - start + 1).cast("int"), (z - a).cast("int")).alias("ids"),
            F.when(a < full, F.floor(a / length)).otherwise(extra + full // length).cast("long").alias("seq"),
            F.when(a < full, a % length).otherwise(a - F.get(begins, extra)).cast("long").alias("off"),
        )

    # Finished sequences' pieces are as they are; only what was left over is cut again.
    finished = placed.where("NOT __tail").withColumn("__g", start).select(
        *(f.name for f in kept), "__n", F.struct(F.col("__start").alias("start"), F.col("__ids").alias("ids"), F.expr(f"__g div {length}").alias("seq"), F.expr(f"__g % {length}").alias("off")).alias("p")
    )
    made = placed.where("__tail").withColumn("__cuts", cuts)
    made = made.select(*(f.name for f in kept), "__n", F.explode(F.transform(F.sequence(F.lit(0), F.size("__cuts") - 2), piece)).alias("p"))
    made = finished.union(made)
    return made.select(*shown(pairs), F.col("p.start").alias("start"), F.col("p.ids").alias("ids"), F.col("__n").alias("doc_tokens"), F.col("p.seq").alias("sequence_id"), F.col("p.off").alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids and the pieces' offsets in it, for training; a sequence has at most ``length`` pieces."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.offset").alias("offsets"))


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with length and CRC-32 in place of the ids."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            flat, cuts = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("start"), pa.array(np.diff(cuts), pa.int64()), pa.array(sums, pa.int64()), *(b.column(x) for x in ("doc_tokens", "sequence_id", "offset"))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return pieces.select("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset").mapInArrow(
        crc, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
