"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set are its distinct word n-grams. Documents with the same set are one class. Two classes of
n and m grams link when 100 |intersection| >= percent |union|; each then shares at least t = percent/100 of
its own grams with the other. In any one order of all grams, two such sets share at least l grams among
their first n - t + l and m - t' + l; documents choose their own l, and a pair then shares at least the
smaller of the two. The order is by document frequency, rarest first.

Frequencies come from one exchange of packed grams. Map tasks send each bin of the hash space a sorted,
difference-coded run of the grams of their classes; what a bin finds in one class only is dropped there,
and the rest goes back to its class with its frequency. A class that keeps fewer than t grams can't have a
partner, so only candidates' grams travel again, and these decide every overlap exactly, as a gram of one
class is in no intersection. A gram that HOT classes of one run share isn't sent class by class: the bin gets
a mark, the classes keep it, and it is last in the order for all.

A class takes the l for which its frequencies promise the least work: entries to read, plus candidates,
which are at most entries over l. Buckets of the index are first joined in stars: every class with its
one pivot of its buckets, which is linear, however large a group of near copies is. Classes that verified stars
connect need no further comparison with each other. Stars repeat with other pivots while they shorten the
work; all pairs of a bucket that are not yet connected then meet, are counted and verified. So no link
that joins two components is lost, and links inside a component aren't spelled out.

Defined results: null text, and text without words, has 0 grams, and is a component of its own; a text with
fewer than n words has one gram, its whole sequence; repeated rows are copies; a null doc_id is no
component's name if there is another; texts of any length are read whole; an empty table gives no rows;
other columns pass through, but for those with a result's name, which gives way to it. Grams are known by 56-bit
hashes, sets by 64-bit ones.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, by_key, dealt, hidden, rows_of, shown, small_batches, trimmed
from .components import components
from .words import mixed, shingles, slices

log = logging.getLogger(__name__)
HOT = 512
RUN = 1 << 20
MOST_L = 8
SLICES = 8
BIN = 1 << 21
BITS, TOP = 56, 32
LAST = np.int32(2**31 - 1)


def _sets(texts: pa.Array, grams: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(grams, how many each text has, the sets' hashes) of runs of texts."""
    for _, _, raw, offsets in slices(texts):
        h, n = shingles(raw, offsets, grams)
        h = h >> np.uint64(64 - BITS)  # ascending and, but for hashes that agree so far, still distinct
        at = np.cumsum(n) - n
        with np.errstate(over="ignore"):
            value = mixed(h * np.uint64(0xA0761D6478BD642F) + np.uint64(1))
            total = np.zeros(len(n), np.uint64)
            some = n > 0
            if some.any():
                total[some] = np.add.reduceat(value, at[some])
            yield h, n, mixed(total + n.astype(np.uint64)).view(np.int64)


def memberships(docs: DataFrame, grams: int) -> DataFrame:
    """docs (.., __text) -> its other columns, __n and __sig (null for empty sets)."""
    kept = [f for f in docs.schema.fields if f.name != "__text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(n, s) for _, n, s in _sets(b.column("__text"), grams)]
            n = np.concatenate([x for x, _ in got]) if got else np.zeros(0, np.int64)
            s = np.concatenate([x for _, x in got]) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(n, pa.int64()), pa.array(s, pa.int64(), mask=n == 0)], [*(f.name for f in kept), "__n", "__sig"])

    schema = docs.drop("__text").schema.add("__n", "long").add("__sig", "long")
    return docs.mapInArrow(trimmed(read), schema)


def _planes(x: np.ndarray) -> bytes:
    """The values' bytes, all first bytes first: high bytes that are zero then compress to nothing."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplaned(data: memoryview, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size).reshape(size, n).T).view(kind).ravel()


def encode_run(tokens: np.ndarray, refs: np.ndarray, sigs: np.ndarray, ns: np.ndarray, hot: np.ndarray) -> bytes:
    """tokens: ascending; refs: their classes, as places in sigs and ns; hot: marks."""
    head = np.array([len(tokens), len(sigs), len(hot)], np.int64).tobytes()
    return b"".join([head, _planes(np.diff(tokens, prepend=np.uint64(0))), _planes(refs.astype(np.uint32)), sigs.tobytes(), _planes(ns.astype(np.int32)), hot.tobytes()])


def decode_run(data: bytes) -> tuple[np.ndarray, ...]:
    view = memoryview(data)
    n, c, m = np.frombuffer(view, np.int64, 3)
    at, out = 24, []
    for count, kind, planed in ((n, np.uint64, True), (n, np.uint32, True), (c, np.int64, False), (c, np.int32, True), (m, np.uint64, False)):
        size = int(count) * np.dtype(kind).itemsize
        part = view[at : at + size]
        out.append(_unplaned(part, int(count), kind) if planed else np.frombuffer(part, kind).copy())
        at += size
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return tuple(out)


def _runs(grams: int, bins: int):
    """Texts -> (bin, data): runs of grams for bins from 0; classes' hot grams for bins below 0."""

    def flush(hs, ns, sigs):
        h, n, sig = np.concatenate(hs), np.concatenate(ns), np.concatenate(sigs)
        for x in (hs, ns, sigs):
            x.clear()
        at = np.cumsum(n) - n
        full = np.flatnonzero(n > 0)
        _, first = np.unique(sig[full], return_index=True)
        own = full[np.sort(first)]  # one document of each class
        n_own = n[own]
        total = int(n_own.sum())
        if len(own) < len(full):
            h = h[np.arange(total) - np.repeat(np.cumsum(n_own) - n_own - at[own], n_own)]
        order = np.argsort(h, kind="stable")
        h, ref = h[order], np.repeat(np.arange(len(own), dtype=np.uint32), n_own)[order]
        del order
        begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if total else np.zeros(0, int)
        times = np.diff(begin, append=total)
        often = np.repeat(times >= HOT, times)
        marks, some, ref_some = h[begin[times >= HOT]], h, ref
        if len(marks):
            some, ref_some = h[~often], ref[~often]
        cuts, mark_cuts = _cuts(some, bins), _cuts(marks, bins)
        for k in np.flatnonzero((np.diff(cuts) > 0) | (np.diff(mark_cuts) > 0)):
            a, z = cuts[k], cuts[k + 1]
            here, place = np.unique(ref_some[a:z], return_inverse=True)
            # What is sent is counted from the bin's least value.
            base = _base(int(k), bins)
            yield int(k), encode_run(some[a:z] - base, place, sig[own][here], n_own[here], marks[mark_cuts[k] : mark_cuts[k + 1]] - base)
        if often.any():
            for k, data in _parcels(sig[own], n_own, ref[often], h[often], np.full(int(often.sum()), LAST), bins):
                yield -1 - k, data

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ns, sigs, held = [], [], [], 0
        rows = lambda it: pa.RecordBatch.from_arrays([pa.array([k for k, _ in it], pa.int32()), pa.array([d for _, d in it], pa.binary())], ["bin", "data"])
        for b in batches:
            for h, n, s in _sets(b.column("__text"), grams):
                hs.append(h), ns.append(n), sigs.append(s)
                held += len(h)
                if held >= RUN:
                    yield rows(list(flush(hs, ns, sigs)))
                    hs, ns, sigs, held = [], [], [], 0
        if held:
            yield rows(list(flush(hs, ns, sigs)))

    return trimmed(read)


def _base(k: int, bins: int) -> np.uint64:
    """The least hash of bin k."""
    return np.uint64((-(-(k << TOP) // bins)) << (BITS - TOP))


def _cuts(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Where each bin's part of ascending hashes begins, and the end."""
    edges = (-(-(np.arange(bins, dtype=np.int64) << TOP) // bins)).astype(np.uint64) << np.uint64(BITS - TOP)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _parcels(sig: np.ndarray, n: np.ndarray, ref: np.ndarray, grams: np.ndarray, df: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, data) of classes' grams, for the parts that the classes belong to; ref: places in sig and n."""
    to = (sig.view(np.uint64) % np.uint64(parts)).astype(np.int64)[ref]
    order = np.lexsort((grams, ref, to))
    to, ref, grams, df = to[order], ref[order], grams[order], df[order]
    cuts = np.searchsorted(to, np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        a, z = cuts[k], cuts[k + 1]
        here, count = np.unique(ref[a:z], return_counts=True)
        head = np.array([len(here), z - a], np.int64).tobytes()
        yield int(k), b"".join([head, sig[here].tobytes(), _planes(n[here].astype(np.int64)), _planes(count), grams[a:z].astype(np.int64).tobytes(), _planes(df[a:z].astype(np.int32))])


def _unparcelled(data: bytes) -> tuple[np.ndarray, ...]:
    """(sig, n, count, grams, df)."""
    view, at, out = memoryview(data), 16, []
    c, m = (int(x) for x in np.frombuffer(view, np.int64, 2))
    for size, kind, planed in ((c, np.int64, False), (c, np.int64, True), (c, np.int64, True), (m, np.int64, False), (m, np.int32, True)):
        part = view[at : at + size * np.dtype(kind).itemsize]
        out.append(_unplaned(part, size, kind) if planed else np.frombuffer(part, kind))
        at += len(part)
    return tuple(out)


def _shared(parts: list[tuple[np.ndarray, np.ndarray]], hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, grams, frequencies) of the grams of several classes, or marked hot, in parts of (grams, classes)."""
    t, r = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(t, kind="stable")
    t, r = t[order], r[order]
    several = np.zeros(len(t), bool)
    several[1:] = t[1:] == t[:-1]
    several[:-1] |= several[1:]
    marked = np.zeros(len(t), bool)
    if len(hot) and len(t):
        marked = hot[np.minimum(np.searchsorted(hot, t), len(hot) - 1)] == t
    kept = np.flatnonzero(several | marked)
    t, r, marked = t[kept], r[kept], marked[kept]
    order = np.lexsort((r, t))
    t, r, marked = t[order], r[order], marked[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    t, r, marked = t[new], r[new], marked[new]
    begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, int)
    times = np.diff(begin, append=len(t))
    df = np.where(marked, LAST, np.repeat(times, times)).astype(np.int32)
    on = df >= 2
    return r[on], t[on], df[on]


def _bin(bins: int):
    """One bin's runs -> (part, data): the grams that several classes share there, for the parts the classes belong to."""

    def work(k: int, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        if k < 0:
            yield pa.RecordBatch.from_arrays([pa.array([-1 - k] * len(data), pa.int32()), pa.array(data, pa.binary())], ["part", "data"])
            return
        runs = []
        while data:
            runs.append(decode_run(data.pop()))
        offsets = np.cumsum([0, *(len(x[2]) for x in runs)])
        # A class that several runs sent is one class here.
        sig, first, same = np.unique(np.concatenate([x[2] for x in runs]), return_index=True, return_inverse=True)
        n, same = np.concatenate([x[3] for x in runs])[first], same.astype(np.int32)
        hot = np.unique(np.concatenate([x[4] for x in runs]))
        edges = np.linspace(0, float(_base(k + 1, bins) - _base(k, bins)), SLICES + 1).astype(np.uint64)
        edges[-1] = np.uint64(2**63)
        found = [_shared([(t[a:z], same[r[a:z] + at]) for (t, r, *_), at in zip(runs, offsets, strict=False) for a, z in [np.searchsorted(t, edges[q : q + 2])]], hot) for q in range(SLICES)]
        r, t, each = (np.concatenate(x) for x in zip(*found, strict=True))
        del runs, found
        out = list(_parcels(sig, n, r, t + _base(k, bins), each, bins))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["part", "data"])

    return work


def _part(percent: int):
    """One part's parcels -> the classes that keep enough grams for a partner."""

    def work(_: int, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        got = [_unparcelled(d) for d in data]
        sig, n, count, grams, df = (np.concatenate(x) for x in zip(*got, strict=True))
        sigs, first, same = np.unique(sig, return_index=True, return_inverse=True)
        n, ref = n[first], np.repeat(same, count)
        enough = np.bincount(ref, minlength=len(sigs)) * 100 >= n * percent
        on = enough[ref]
        ref, grams, df = ref[on], grams[on], df[on]
        order = np.lexsort((grams, ref))
        ref, grams, df = ref[order], grams[order], df[order]
        new = np.ones(len(ref), bool)  # several runs may have sent a class's hot grams
        new[1:] = (ref[1:] != ref[:-1]) | (grams[1:] != grams[:-1])
        ref, grams, df = ref[new], grams[new], df[new]
        per = np.bincount(ref, minlength=len(sigs))
        here = np.flatnonzero(per * 100 >= n * percent)
        on = (per * 100 >= n * percent)[ref]
        offsets = pa.array(np.concatenate([[0], np.cumsum(per[here])]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[on], kind)) for x, kind in ((grams, pa.int64()), (df, pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array(sigs[here], pa.int64()), pa.array(n[here], pa.int64()), *lists], ["sig", "n", "grams", "df"])

    return work


def prefix(n: int, least: int, grams: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, int]:
    """(the shared grams of a class's prefix, in their order, its l); none if no partner is possible."""
    order = np.lexsort((grams, df))
    grams, df = grams[order], df[order]
    alone = n - len(grams)
    best, got = None, (grams[:0], 1)
    read = np.cumsum(df.astype(np.int64) - 1)
    for l in range(1, MOST_L + 1):
        upto = min(n, n - least + l) - alone
        if upto < l:
            break
        entries = int(read[upto - 1])
        work = entries + 4 * entries / l
        if best is None or work < best:
            best, got = work, (grams[:upto], l)
        if n - least + l >= n:
            break
    return got


def _entries(percent: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            sigs, ns = b.column("sig").to_numpy(), b.column("n").to_numpy()
            cuts, grams = b.column("grams").offsets.to_numpy(), b.column("grams").values.to_numpy()
            dfs = b.column("df").values.to_numpy()
            got = [prefix(int(n), -(-int(n) * percent // 100), grams[a:z], dfs[a:z]) for n, a, z in zip(ns, cuts, cuts[1:], strict=False)]
            size, have = np.array([len(x) for x, _ in got]), np.diff(cuts)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            # How common its grams are on the whole: near copies of one text are likest to the one with the most common grams.
            centre = np.add.reduceat(np.log(dfs[cuts[0] : cuts[-1]].astype(float)), cuts[:-1] - cuts[0]) / ns
            each = lambda x, kind: pa.array(np.repeat(x, size), kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x for x, _ in got]), pa.int64()), each(sigs, pa.int64()), each(ns, pa.int64()), each(have, pa.int64()), each([l for _, l in got], pa.int32()), pa.array(np.repeat(ns - have, size) + place, pa.int64()), each(centre, pa.float64())],
                ["gram", "sig", "n", "s", "l", "at", "centre"],
            )

    return trimmed(read)


def candidates(docs: DataFrame, grams: int, percent: int, scratch: Scratch, total: int) -> DataFrame:
    """docs (__text), with ``total`` grams in all -> sig, n, grams, df of the classes that share enough grams with others to have a partner."""
    # As many bins as keep BIN grams in each, and one for each partition at least.
    bins = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BIN))
    sent = dealt(docs.mapInArrow(_runs(grams, bins), "bin int, data binary"), "bin")
    back = dealt(sent.mapInArrow(by_key(_bin(bins), "bin"), "part int, data binary"), "part")
    found = back.mapInArrow(by_key(_part(percent), "part"), "sig long, n long, grams array<long>, df array<int>")
    return scratch.keep(found, "candidates")


def link(found: DataFrame, percent: int, scratch: Scratch, *, stars: int = 6, slack: int = 2) -> DataFrame:
    """candidates -> (sig, root): the component of every class that has a link."""
    spark = found.sparkSession
    # What two classes can share is no more than either shares with any other at all (s, z).
    fits = F.least("n", "m", "s", "z") * (100 + percent) >= (F.col("n") + F.col("m")) * percent
    sets = scratch.bucketed(found.select("sig", "n", "grams"), "sets", "sig")
    live = scratch.keep(found.mapInArrow(_entries(percent), "gram long, sig long, n long, s long, l int, at long, centre double").selectExpr("*", "sig AS root", "CAST(NULL AS BIGINT) AS p", "CAST(NULL AS BIGINT) AS o"), "live")
    edges = rows_of(spark, [], "a long, b long")
    roots, seen = rows_of(spark, [], "sig long, root long"), None

    def measured(pairs: DataFrame, k: int) -> DataFrame:
        """pairs (a, b), where many a may share a b -> also both, what they share, and linked; only the sets of the b and, with them, the a move."""
        pairs = scratch.keep(pairs, f"pairs-{k}")
        one = pairs.join(sets.select(F.col("sig").alias("a"), "n", F.col("grams").alias("ga")), "a")
        others = sets.join(pairs.select(F.col("b").alias("sig")).distinct(), "sig", "left_semi").select(F.col("sig").alias("b"), F.col("n").alias("m"), F.col("grams").alias("gb"))
        both = one.join(others, "b").withColumn("both", F.size(F.array_intersect("ga", "gb")))
        linked = F.col("both") * 100 >= (F.col("n") + F.col("m") - F.col("both")) * percent
        return scratch.keep(both.select("a", "b", "both", linked.alias("linked")), f"met-{k}")

    for k in range(stars + 1):
        # Buckets where more than one component meets, and how many pairs they have between components.
        per = live.groupBy("gram", "root").count().groupBy("gram").agg(F.sum("count").alias("size"), F.sum(F.col("count") * F.col("count")).alias("within"), F.count("*").alias("roots"))
        open_ = scratch.keep(per.where("roots > 1"), f"open-{k}")
        total = open_.agg(F.coalesce(F.sum((F.col("size") * F.col("size") - F.col("within")) / 2), F.lit(0.0)).alias("pairs"), F.coalesce(F.sum("size"), F.lit(0)).alias("entries")).first()
        if not total["pairs"]:
            break
        live = scratch.keep(live.join(open_.select("gram"), "gram", "left_semi"), f"live-{k}")
        log.info("round %d: %s entries, %.0f pairs between components", k, total["entries"], total["pairs"])
        last = k == stars or total["pairs"] <= slack * total["entries"] or (seen is not None and total["pairs"] > 0.95 * seen)
        if last:
            left = live.select("gram", F.col("sig").alias("a"), "n", "s", F.col("l").alias("la"), F.col("root").alias("ra"), "p", "o", F.col("at").alias("i"))
            right = live.select("gram", F.col("sig").alias("b"), F.col("n").alias("m"), F.col("s").alias("z"), F.col("l").alias("lb"), F.col("root").alias("rb"), F.col("p").alias("q"), F.col("o").alias("r"), F.col("at").alias("j"))
            # Two that met the same pivot p share at most the smaller part of it that either has, and the smaller
            # number of the shared grams that either has outside it; a class and its own pivot have met already.
            most = F.least("o", "r") + F.least(F.col("s") - F.col("o"), F.col("z") - F.col("r"))
            apart = (F.col("p") == F.col("q")) & (most * (100 + percent) < (F.col("n") + F.col("m")) * percent)
            done = (F.col("b") == F.col("p")) | (F.col("a") == F.col("q"))
            # With both sizes known the prefixes are shorter: what must be shared is more than of the smallest partner.
            need = F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))
            early = (F.col("i") < F.col("n") - need + F.least("la", "lb")) & (F.col("j") < F.col("m") - need + F.least("la", "lb"))
            met = left.join(right, "gram").where("a < b and ra <> rb").where(fits).where(early).where(~F.coalesce(apart, F.lit(False)) & ~F.coalesce(done, F.lit(False)))
            pairs = met.groupBy("a", "b").agg(F.count("*").alias("k"), F.min(F.least("la", "lb")).alias("l")).where("k >= l").select("a", "b")
            log.info("last round, from %d", k)
        else:
            # Each class meets that pivot of another component with which it shares most of its grams' buckets.
            seen = total["pairs"]
            turn = F.pmod(F.xxhash64("sig", F.lit(k)), F.lit(k + 1)) == 0  # the most central of all, then of a half, a third and so on
            order = F.struct(turn.alias("t"), F.col("centre"), F.col("sig").alias("b"), F.col("n").alias("m"), F.col("s").alias("z"), F.col("root").alias("rb"))
            # Written, so that a gram of very many classes is split in the join.
            pivots = scratch.keep(live.groupBy("gram").agg(F.max(order).alias("p")).select("gram", "p.b", "p.m", "p.z", "p.rb"), f"pivots-{k}")
            met = live.select("gram", F.col("sig").alias("a"), "n", "s", "root").join(pivots, "gram").where("root <> rb").where(fits)
            best = met.groupBy("a", "b").count().groupBy("a").agg(F.max(F.struct("count", "b")).alias("p"))
            pairs = best.select("a", F.col("p.b").alias("b"))
        met = measured(pairs, k)
        edges = edges.union(met.where("linked").select("a", "b"))
        roots = components(edges, scratch, f"roots-{k}").select(F.col("id").alias("sig"), F.col("component_id").alias("root"))
        if last:
            break
        live = live.drop("root").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        if k == 0:
            live = live.drop("p", "o").join(met.select(F.col("a").alias("sig"), F.col("b").alias("p"), F.col("both").cast("long").alias("o")), "sig", "left")
    return roots


def near_duplicates(docs: DataFrame, *, grams: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id", carry: list[str] | None = None, root: bool = False) -> DataFrame:
    """The carried columns (all, by default), n_shingles and component_id of every row: that of its own text, also where a key repeats.

    With ``root`` also component_root, which tells components apart that have one least key; null for texts without a word.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near")
    cols, pairs = hidden(docs, carry if carry is not None else docs.columns)
    body = docs[f"`{text}`"].cast("string").alias("__text")
    # Other columns go along with the rows; the key alone is there anyway.
    rest = [] if [name for _, name in pairs] == [key] else cols
    members = scratch.keep(memberships(docs.select(*rest, docs[f"`{key}`"].cast("long").alias("__id"), body), grams), "members")
    total = members.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    roots = link(candidates(docs.select(body), grams, percent, scratch, total), percent, scratch)
    least = members.where(F.col("__sig").isNotNull()).groupBy("__sig").agg(F.min("__id").alias("least"))
    named = least.join(roots, least["__sig"] == roots["sig"], "left").select("__sig", F.coalesce("root", "__sig").alias("root"), "least")
    by_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = scratch.keep(named.join(by_root, "root").select(F.col("__sig").alias("s"), "component_id", F.col("root").alias("component_root")), "labels")
    scratch.drop_but("members", "labels")
    made = [F.col("__n").alias("n_shingles"), F.coalesce("component_id", "__id").alias("component_id"), *([F.col("component_root")] if root else [])]
    names = ["n_shingles", "component_id", *(["component_root"] if root else [])]
    kept = shown(pairs, *names) if rest else [F.col("__id").alias(key)]
    return members.join(labels, members["__sig"] == labels["s"], "left").select(*kept, *made)
