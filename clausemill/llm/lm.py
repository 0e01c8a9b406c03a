"""Scores by a causal self-attention model over subword ids, beside an add-one word model.

The model is one attention layer and a small network, trained in numpy by Adam on all windows of all training documents (``Training``).
It predicts a class of ids; an id's share of its class comes from the counts of all training documents, which also say what the classes
are: the most frequent ids have one of their own, other frequent ones share it with those that stand after and before the same ids as they
do (so that one language's are together), and all rarer ones are one class. So the probabilities of all ids sum to one. Shared classes are in
groups of like ones: a group is predicted first, then a class within it, so that only the group that an id is in is worked out. A text is read as its ids and an end; windows of
``WINDOW`` inputs overlap by half, every token is scored once, in the first window that has it, and so from
at least half a window of inputs but at a text's start. All windows of a batch go through one masked
attention; what a window shares with the one before is only looked at, not scored again. Each text is coded
once, into a table.

Word counts come from all training documents. Words so frequent that there can be at most ``HEAVY`` of
them go to every task; the others' counts meet the documents' words in bins of the hash space, packed as
sorted runs, and each bin returns a sum for each text. Pairs of ids go the same way, but for those of two of the
``PAIRED`` most frequent ids, which are in a table of every task.

Defined results: null text is empty, so that its only token is the end; with no training documents counts
are 0 and the model is uniform over its classes; texts of any length are scored whole; repeated rows have
equal scores; a null doc_id isn't held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._shared import Scratch, rows_of, small_batches, trimmed
from .bytebpe import Encoder, vocabulary
from .near import _planes, _unplaned
from .words import mixed, slices, words

VOCABULARY, END_ID = 50_257, 50_256
WINDOW, STRIDE = 32, 16
OWN, LIKE = 16, 76
CLASSES = OWN + LIKE + 1
SIZES = (19,) * 4  # of the groups of shared classes
FIRST = OWN + len(SIZES) + 1
EDGES = OWN + np.cumsum((0, *SIZES))
#: What is predicted first for each class: itself, or its group.
FIRST_OF = np.concatenate([np.arange(OWN), np.repeat(np.arange(OWN, FIRST - 1), SIZES), [FIRST - 1]]).astype(np.uint8)
GROUPED = 2048
COMMON = 960
PAIRED = 2048
HEAVY = 65_536
END_HASH = np.uint64(0x5EED0FE2D0C0FFEE)
RUN = 1 << 20
BIN = 1 << 24
PAD = 65_535
END = np.array([END_ID], np.int32)


# ---- the model


@dataclass(frozen=True)
class Training:
    """How the fit goes. It starts with ``steps`` batches of ``batch`` from about ``first`` windows on the driver; then all windows of
    all training documents are gone through once, in parts of about ``part`` windows that each go on from there, and the parts' weights
    are averaged. A ``share`` below 1 takes so many of the windows, from anywhere in whole texts, or ``first`` where that is more."""

    share: float = 1.0
    first: int = 65_536
    part: int = 32_768
    later: float = 0.002
    steps: int = 1500
    batch: int = 128
    width: int = 16
    inner: int = 32
    rate: float = 0.02
    seed: int = 17


def ranked(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by falling count, rank of each id)."""
    order = np.lexsort((np.arange(VOCABULARY), -counts))
    rank = np.empty(VOCABULARY, np.int64)
    rank[order] = np.arange(VOCABULARY)
    return order, rank


def classes(counts: np.ndarray, keys: np.ndarray, times: np.ndarray, dims: int = 24, rounds: int = 25) -> np.ndarray:
    """Each id's class. Of the pairs only those of two of the GROUPED most frequent ids count: k-means of the shares, as square roots, of
    what follows an id and of what it follows, in ``dims`` directions."""
    order, rank = ranked(counts)
    rng, before, after = np.random.default_rng(3), rank[keys // VOCABULARY], rank[keys % VOCABULARY]
    here = (before < GROUPED) & (after < GROUPED)
    met = np.zeros((GROUPED, GROUPED), np.float32)
    met[before[here], after[here]] = times[here]
    x = np.concatenate([np.sqrt(m / np.maximum(m.sum(axis=1, keepdims=True), 1)) for m in (met, met.T)], axis=1)
    weight = counts[order[:GROUPED]] + 1e-3
    way = x.T @ (weight[:, None] * (x @ rng.normal(size=(2 * GROUPED, dims)).astype(np.float32))).astype(np.float32)
    x = (x @ np.linalg.qr(way)[0].astype(np.float32))[OWN:].astype(np.float64)
    x, weight = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), weight[OWN:]
    centre = x[rng.choice(len(x), LIKE, replace=False, p=weight / weight.sum())]
    for _ in range(rounds):
        home = np.argmax(x @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, home, x * weight[:, None])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centre)
    near = x @ centre.T
    home = np.argmax(near, axis=1)
    for k in np.flatnonzero(np.bincount(home, minlength=LIKE) == 0):  # no class is empty
        several = np.bincount(home, minlength=LIKE)[home] > 1
        home[np.flatnonzero(several)[np.argmax(near[several, k])]] = k
    number = np.empty(LIKE, np.int64)
    number[_grouped(centre)] = np.arange(LIKE)
    out = np.full(VOCABULARY, OWN + LIKE, np.int32)
    out[order[:OWN]], out[order[OWN:GROUPED]] = np.arange(OWN), OWN + number[home]
    return out


def _grouped(centre: np.ndarray) -> np.ndarray:
    """Shared classes in such an order that like ones are in one group: halved and halved again where they differ most."""
    parts = [np.arange(LIKE)]
    while len(parts) < len(SIZES):
        halves = []
        for part in parts:
            x = centre[part] - centre[part].mean(axis=0)
            part = part[np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")]
            halves += [part[: len(part) // 2], part[len(part) // 2 :]]
        parts = halves
    return np.concatenate(parts)


class Vocabulary:
    """Input rows and classes of ids, and ids' shares of their classes given the id before, from counts.

    counts: of ids; keys, times: pairs of (id before, id), int64 keys ``before * VOCABULARY + id``, and their counts. Counts of
    two of the ``PAIRED`` most frequent ids are in a table. elsewhere: pairs whose counts are in bins, as (ids before, classes,
    counts, kinds) summed by id before and class; ``lifts`` is what their own counts add to the log shares that are told here.
    """

    def __init__(self, counts: np.ndarray, keys: np.ndarray, times: np.ndarray, elsewhere: tuple[np.ndarray, ...] | None = None, klass: np.ndarray | None = None):
        order, rank = ranked(counts)
        self.klass = classes(counts, keys, times) if klass is None else klass
        self.row = rank.astype(np.int32)
        self.size = PAIRED
        self.place = np.minimum(rank, PAIRED).astype(np.int32)
        own = (counts + 1.0) / (counts + 1.0).sum()
        per = np.bincount(self.klass, own, CLASSES)
        self.prior = np.log(np.maximum(per, 1e-12)).astype(np.float32)
        self.own = np.log(own).astype(np.float32)

        before, after = keys // VOCABULARY, keys % VOCABULARY
        cells = np.bincount(before * CLASSES + self.klass[after], times, VOCABULARY * CLASSES).astype(np.float64).reshape(VOCABULARY, CLASSES)
        kinds = np.bincount(before, minlength=VOCABULARY)
        if elsewhere is not None:
            b, k, n, more = elsewhere
            np.add.at(cells, (b, k), n)
            kinds = kinds + np.bincount(b, more, VOCABULARY)
        # Of what follows an id, so much is spread as ids are by themselves: one for each kind of pair, and one more.
        self.spread = np.maximum(counts - cells.sum(axis=1), 0) + kinds + 1.0
        cells += self.spread[:, None] * per[None, :]
        with np.errstate(divide="ignore"):
            np.log(cells, out=cells)
            self.after = (np.log(self.spread)[:, None] - cells).astype(np.float32)
            top, here = order[:PAIRED], (rank[before] < PAIRED) & (rank[after] < PAIRED)
            self.paired = np.zeros((PAIRED + 1, PAIRED + 1), np.float32)
            kept = np.zeros((PAIRED, PAIRED))
            kept[rank[before[here]], rank[after[here]]] = times[here]
            kept += self.spread[top][:, None] * own[top][None, :]
            self.paired[:PAIRED, :PAIRED] = np.log(kept) - cells[top][:, self.klass[top]]
        by = np.flatnonzero(~here)[np.argsort(keys[~here], kind="stable")]
        self.rare, self.lift = keys[by], self.lifts(keys[by], times[by])

    def lifts(self, keys: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Natural log of how much larger the counts of pairs make their shares."""
        return np.log1p(times / (self.spread[keys // VOCABULARY] * np.exp(self.own[keys % VOCABULARY].astype(np.float64))))

    def apart(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of pairs that aren't in the table."""
        return np.flatnonzero((self.place[before] == self.size) | (self.place[ids] == self.size))

    def shares(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log of each id's share of its class after the id before, without the counts that are elsewhere."""
        out = self.paired[self.place[before], self.place[ids]]
        rare = self.apart(before, ids)
        b, i = before[rare], ids[rare]
        out[rare] = self.after[b, self.klass[i]] + self.own[i]
        if len(self.rare):
            place, there = _in(self.rare, b.astype(np.int64) * VOCABULARY + i)
            out[rare] += np.where(there, self.lift[place], 0)
        return out


class Attention:
    def __init__(self, width: int, inner: int, prior: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        normal = lambda *s, by: (rng.normal(size=s) * by).astype(np.float32)
        d = width
        self.p = {
            "emb": normal(VOCABULARY, d, by=0.3), "pos": normal(WINDOW, d, by=0.1), "qkv": normal(d, 3 * d, by=d**-0.5), "out": normal(d, d, by=d**-0.5),
            "w1": normal(2 * d, inner, by=(2 * d) ** -0.5), "b1": np.zeros(inner, np.float32), "w2": normal(inner, d, by=inner**-0.5),
            "u": normal(2 * d, FIRST + LIKE, by=0.05), "b": np.concatenate([np.log(np.bincount(FIRST_OF, np.exp(prior)) + 1e-12), prior[OWN:-1]]).astype(np.float32),
        }
        self.p["emb"][COMMON:] = 0  # rare ids start alike; those that the sample has go apart
        #: The most that a product may be: nothing where an input is later, so that its exponential is 0.
        self.mask = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), 30, -1e9).astype(np.float32)

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Input rows by window -> log probabilities of all classes."""
        p, top = self.p, self._top(rows)
        logits = top @ p["u"] + p["b"]
        logs = lambda x: x - np.log(np.exp(x).sum(axis=1, keepdims=True))
        first = logs(logits[:, :FIRST])
        within = [logs(logits[:, a:z]) for a, z in _columns()]
        return first[:, FIRST_OF] + np.concatenate([np.zeros_like(first[:, :OWN]), *within, np.zeros_like(first[:, :1])], axis=1)

    def _top(self, rows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Input rows by window -> what the classes are told from; ``keep`` gets what the backward pass needs."""
        p, (b, t) = self.p, rows.shape
        d = p["emb"].shape[1]
        # What the network says, the inputs, and what attention says lie side by side: the classes are told from the first two, the network
        # reads the last two. The last input itself so reaches the classes beside what attention and the network say.
        side = np.empty((b * t, 3 * d), p["emb"].dtype)
        top, both, x = side[:, : 2 * d], side[:, d:], side[:, d : 2 * d]
        np.add(np.take(p["emb"], rows, axis=0), p["pos"], out=x.reshape(b, t, d))
        w = self._scaled()
        # The ones beside the values give the sums, by which what is read is divided instead of each weight.
        qkv = np.empty((b * t, 3 * d + 1), side.dtype)
        np.matmul(x, w, out=qkv[:, : 3 * d])
        qkv[:, 3 * d] = 1
        q, k, v = (qkv[:, i * d : (i + 1) * d + i // 2].reshape(b, t, -1) for i in range(3))
        a = np.matmul(q, k.transpose(0, 2, 1))
        np.minimum(a, self.mask, out=a)
        np.exp(a, out=a)
        read = np.matmul(a, v).reshape(-1, d + 1)
        over = 1 / read[:, d:]
        mixed_ = read[:, :d] * over
        np.matmul(mixed_, p["out"], out=side[:, 2 * d :])
        r = both @ p["w1"]
        r += p["b1"]
        np.maximum(r, 0, out=r)
        np.matmul(r, p["w2"], out=side[:, :d])
        if keep is not None:
            keep.update(x=x, w=w, q=q, k=k, v=v, a=a, over=over, mixed=mixed_, both=both, r=r)
        return top

    def _scaled(self) -> np.ndarray:
        """Weights of queries, keys and values, with the scale of the products in the queries'."""
        p, d = self.p, self.p["emb"].shape[1]
        return np.concatenate([p["qkv"][:, :d] * np.float32(d**-0.5), p["qkv"][:, d:]], axis=1)

    def ready(self) -> None:
        """Products of the weights, for ``tail``."""
        p, d = self.p, self.p["emb"].shape[1]
        w = self._scaled()
        self.q, self.q_at = p["emb"] @ w[:, :d], p["pos"] @ w[:, :d]
        self.kv = np.concatenate([p["emb"] @ w[:, d:], np.zeros((VOCABULARY, 1), np.float32)], axis=1)
        self.kv_at = np.concatenate([p["pos"] @ w[:, d:], np.ones((WINDOW, 1), np.float32)], axis=1)
        self.into = np.concatenate([p["w1"][:d], p["out"] @ p["w1"][d:]])

    def tail(self, rows: np.ndarray, begin: int) -> np.ndarray:
        """What classes are told from, for the inputs from ``begin`` on in each window; those before are only attended to."""
        p, (b, t), d = self.p, rows.shape, self.p["emb"].shape[1]
        last = rows[:, begin:]
        q = np.take(self.q, last, axis=0)
        q += self.q_at[begin:]
        kv = np.take(self.kv, rows, axis=0)
        kv += self.kv_at
        a = np.matmul(q, kv[:, :, :d].transpose(0, 2, 1))
        np.minimum(a, self.mask[begin:], out=a)
        np.exp(a, out=a)
        side = np.empty((b, t - begin, 3 * d), np.float32)
        np.add(np.take(p["emb"], last, axis=0), p["pos"][begin:], out=side[:, :, d : 2 * d])
        read = np.matmul(a, kv[:, :, d:])
        np.divide(read[:, :, :d], read[:, :, d:], out=side[:, :, 2 * d :])
        side = side.reshape(-1, 3 * d)
        z = side[:, d:] @ self.into
        z += p["b1"]
        np.maximum(z, 0, out=z)
        np.matmul(z, p["w2"], out=side[:, :d])
        return side[:, : 2 * d]

    def _by_group(self, first: np.ndarray) -> Iterator[tuple[int, int, slice]]:
        """(first column, end, places) of the groups that are met; first: ascending."""
        cuts = np.searchsorted(first, np.arange(OWN, FIRST))
        for (a, z), lo, hi in zip(_columns(), cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield a, z, slice(lo, hi)

    def told(self, top: np.ndarray, klass: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each row's class."""
        order = np.argsort(FIRST_OF[klass], kind="stable")
        top, klass, at = np.take(top, order, axis=0), klass[order], np.arange(len(top))
        first = FIRST_OF[klass]

        def share(a: int, z: int, top: np.ndarray, k: np.ndarray) -> np.ndarray:
            e = _exponentials(top @ self.p["u"][:, a:z])
            by = np.exp(self.p["b"][a:z])
            return e[at[: len(k)], k] * by[k] / (e @ by)

        got = share(0, FIRST, top, first)
        for a, z, here in self._by_group(first):
            got[here] *= share(a, z, top[here], klass[here] - (OWN + a - FIRST))
        out = np.empty_like(got)
        out[order] = np.log(got)
        return out

    def step(self, rows: np.ndarray, klass: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients; weight is 0 for inputs that score nothing."""
        loss, out, on = self.gradients(rows, klass, weight)
        emb = np.zeros_like(self.p["emb"])
        emb[on] = out["emb"]
        return loss, out | {"emb": emb}

    def gradients(self, rows: np.ndarray, klass: np.ndarray, weight: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Loss, gradients, and the input rows that those of ``emb`` are of."""
        keep: dict = {}
        top = self._top(rows, keep)
        p, (b, t), d, n = self.p, rows.shape, self.p["emb"].shape[1], rows.size
        out: dict = {"u": np.zeros_like(p["u"]), "b": np.zeros_like(p["b"])}
        loss, at, ones = 0.0, np.arange(n), np.ones(n, top.dtype)
        # Targets go by their groups, so that each group's are a slice.
        klass = klass.ravel()
        order = np.argsort(FIRST_OF[klass], kind="stable")
        klass, w, top = klass[order], (weight.ravel() / max(weight.sum(), 1))[order].astype(top.dtype), np.take(top, order, axis=0)
        first = FIRST_OF[klass]

        def back(a: int, z: int, top: np.ndarray, k: np.ndarray, w: np.ndarray) -> np.ndarray:
            nonlocal loss
            g = p["u"][:, a:z].T @ top.T
            g += p["b"][a:z, None]
            _exponentials(g)
            g *= w / (ones[: z - a] @ g)
            own = at[: len(k)]
            said = g[k, own]
            loss -= (np.log(said / np.maximum(w, 1e-20) + 1e-20) * w).sum()
            g[k, own] = said - w
            out["u"][:, a:z], out["b"][a:z] = (g @ top).T, g @ ones[: len(k)]
            return g.T @ p["u"][:, a:z].T

        dtop_ = back(0, FIRST, top, first, w)
        for a, z, here in self._by_group(first):
            dtop_[here] += back(a, z, top[here], klass[here] - (OWN + a - FIRST), w[here])
        dtop = np.empty_like(dtop_)
        dtop[order] = dtop_
        # What comes back to the network, queries, keys and values, side by side: one product leads from there to the inputs.
        h = p["w1"].shape[1]
        side = np.empty((n, h + 3 * d), top.dtype)
        dr, dqkv = side[:, :h], side[:, h:]
        np.matmul(dtop[:, :d], p["w2"].T, out=dr)
        out["w2"] = keep["r"].T @ dtop[:, :d]
        dr *= keep["r"] > 0
        out["w1"], out["b1"] = keep["both"].T @ dr, ones @ dr
        dh = dr @ p["w1"][d:].T
        out["out"] = keep["mixed"].T @ dh
        dm = np.empty((n, d + 1), top.dtype)
        np.matmul(dh, p["out"].T, out=dm[:, :d])
        dm[:, :d] *= keep["over"]
        dm[:, d] = -np.einsum("ij,ij->i", dm[:, :d], keep["mixed"])
        dm, by = dm.reshape(b, t, d + 1), dqkv.reshape(b, t, 3 * d)
        ds = np.matmul(dm, keep["v"].transpose(0, 2, 1))
        ds *= keep["a"]
        np.matmul(ds, keep["k"], out=by[:, :, :d])
        np.matmul(ds.transpose(0, 2, 1), keep["q"], out=by[:, :, d : 2 * d])
        np.matmul(keep["a"].transpose(0, 2, 1), dm[:, :, :d], out=by[:, :, 2 * d :])
        out["qkv"] = keep["x"].T @ dqkv
        out["qkv"][:, :d] *= np.float32(d**-0.5)
        dx = side @ np.concatenate([p["w1"][:d], keep["w"]], axis=1).T
        dx += dtop[:, d:]
        out["pos"] = (np.ones(b, dx.dtype) @ dx.reshape(b, t * d)).reshape(t, d)
        flat = rows.ravel()
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        flat = flat[order]
        begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        out["emb"] = np.add.reduceat(np.take(dx, order, axis=0), begin, axis=0)
        return float(loss), out, flat[begin]


def _exponentials(x: np.ndarray) -> np.ndarray:
    """In place; of at most 60, so that their sums are finite."""
    if x.max() > 60:
        np.minimum(x, np.float32(60), out=x)
    return np.exp(x, out=x)


def _columns() -> Iterator[tuple[int, int]]:
    """Columns of each group's classes."""
    shift = FIRST - OWN
    return ((int(a) + shift, int(z) + shift) for a, z in zip(EDGES[:-1], EDGES[1:], strict=True))


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, first input that scores) of each window over texts of n inputs; a text's last window ends with it."""
    per = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = np.minimum(k * STRIDE, np.maximum(n[text] - WINDOW, 0))
    first = np.where(k > 0, (k - 1) * STRIDE + WINDOW - start, 0)
    return text, start, first


def pieces(texts: list[np.ndarray], seeds: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(windows of WINDOW inputs and the id after them, their hashes) that make up so much of the texts; after an end there is PAD."""
    room = np.array([len(t) + 2 for t in texts], np.int64)
    at = np.cumsum(room + WINDOW) - room - WINDOW
    stream = np.full(int((room + WINDOW).sum()) + 1, PAD, np.uint16)
    stream[at] = stream[at + room - 1] = END_ID
    for a, t in zip(at, texts, strict=True):
        stream[a + 1 : a + 1 + len(t)] = t
    # A text is cut into windows from a place that its seed says, and the part before it begins one as well.
    phase = (mixed(seeds) % np.uint64(WINDOW)).astype(np.int64)
    phase[phase > 0] -= WINDOW
    per = -(-(room - 1 - phase) // WINDOW)
    text = np.repeat(np.arange(len(texts)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = np.maximum(phase[text] + k * WINDOW, 0)
    key = mixed(seeds[text] + mixed(k.astype(np.uint64) + np.uint64(1)))
    on = (key >> np.uint64(11)).astype(np.float64) < share * 2**53
    if not on.any():
        return np.zeros((0, WINDOW + 1), np.uint16), key[:0]
    return np.lib.stride_tricks.sliding_window_view(stream, WINDOW + 1)[at[text[on]] + start[on]], key[on]


def _ordered(windows_: np.ndarray) -> np.ndarray:
    """In an order that only what they hold says."""
    odd = np.random.default_rng(5).integers(1, 2**63, WINDOW + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return windows_[np.argsort(mixed((windows_.astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64)), kind="stable")]


class Adam:
    """All weights but ``emb`` are parts of one array, so that a step is a few operations on it; of ``emb`` a step takes the rows that are met."""

    def __init__(self, model: Attention):
        self.model, self.i, p = model, 0, model.p
        self.names = [k for k in p if k != "emb"]
        self.flat = np.concatenate([p[k].ravel() for k in self.names])
        at = np.cumsum([0, *(p[k].size for k in self.names)])
        p.update({k: self.flat[a:z].reshape(p[k].shape) for k, a, z in zip(self.names, at[:-1], at[1:], strict=True)})
        self.moments, self.emb = np.zeros((2, len(self.flat)), np.float32), np.zeros((VOCABULARY, 2, p["emb"].shape[1]), np.float32)

    def __call__(self, windows_: np.ndarray, row: np.ndarray, klass: np.ndarray, rate: float) -> None:
        there = windows_ != PAD
        ids = np.where(there, windows_, END_ID)
        rows = row[ids[:, :-1]]
        _, grads, met = self.model.gradients(rows, klass[ids[:, 1:]], there[:, 1:].astype(np.float32))
        self.i += 1
        first, second = np.float32(rate / (1 - 0.9**self.i)), np.float32(1 / (1 - 0.99**self.i))

        def moved(m: np.ndarray, v: np.ndarray, g: np.ndarray) -> np.ndarray:
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            v *= np.float32(0.99)
            v += np.float32(0.01) * (g * g)
            by = np.sqrt(v * second)
            by += np.float32(1e-6)
            return first * m / by

        self.flat -= moved(*self.moments, np.concatenate([grads[k].ravel() for k in self.names]))
        own = np.take(self.emb, met, axis=0)
        self.model.p["emb"][met] -= moved(own[:, 0], own[:, 1], grads["emb"])
        self.emb[met] = own


def start(pool: np.ndarray, words_: Vocabulary, how: Training) -> Attention:
    """A model fitted by batches drawn from the windows."""
    model = Attention(how.width, how.inner, words_.prior, how.seed)
    rng, adam = np.random.default_rng(how.seed), Adam(model)
    for i in range(1, (how.steps if len(pool) else 0) + 1):
        adam(pool[rng.integers(0, len(pool), how.batch)], words_.row, words_.klass, how.rate * min(1, i / 50) * (1 - 0.9 * i / how.steps))
    return model


def train(texts: list[np.ndarray], words_: Vocabulary, how: Training) -> Attention:
    """texts: ids of the documents to learn from, all of them."""
    return start(pieces(texts, np.arange(len(texts), dtype=np.uint64), 1.0)[0], words_, how)


class Scorer:
    def __init__(self, model: Attention, words_: Vocabulary, chunk: int = 128):
        self.model, self.words, self.chunk = model, words_, chunk
        model.ready()

    def __call__(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text's ids and its end."""
        rows, first, last, doc, targets = [], [], [], [], []
        n = np.array([len(ids) + 1 for ids in texts])
        room = np.maximum(n, WINDOW)
        at = np.cumsum(room) - room
        # Inputs are the end and the ids, what they lead to the ids and the end; short texts are padded to a window.
        inputs = np.full(int(room.sum()), END_ID, np.int32)
        wanted = inputs.copy()
        for a, ids in zip(at, texts, strict=True):
            inputs[a + 1 : a + 1 + len(ids)] = ids
            wanted[a : a + len(ids)] = ids
        text, start, first = windows(n)
        last = np.minimum(n[text] - start, WINDOW)
        begin = at[text] + start
        logs = self.words.shares(inputs, wanted)
        inputs, wanted = self.words.row[inputs], self.words.klass[wanted]
        place = np.arange(WINDOW)
        got = np.empty(len(begin))
        # A text's first window scores from its start, the others in what they don't share.
        for from_, those in ((0, np.flatnonzero(first == 0)), (WINDOW - STRIDE, np.flatnonzero(first > 0))):
            on_from = place[from_:]
            for k in range(0, len(those), self.chunk):
                w = those[k : k + self.chunk]
                where = begin[w, None] + place
                top = self.model.tail(inputs[where], from_)
                where = where[:, from_:]
                said = self.model.told(top, wanted[where].ravel())
                on = (on_from >= first[w, None]) & (on_from < last[w, None])
                got[w] = ((said.reshape(on.shape) + logs[where]) * on).sum(axis=1, dtype=np.float64)
        return np.bincount(text, got, len(texts)) / np.log(10)


# ---- counts over all training documents


_COUNTED = "kind int, key long, n long"
WORD, ID, PAIR = 0, 1, 2


class _Counts:
    """Counts of ids and their neighbours of one task: a table of the ids that are frequent in its first texts; other pairs by sorting."""

    def __init__(self):
        self.ids, self.place = np.zeros(VOCABULARY, np.int64), None
        self.table = np.zeros(PAIRED * PAIRED, np.int32)

    def add(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, count) of the pairs that aren't in the table."""
        per = np.bincount(ids, minlength=VOCABULARY)
        self.ids += per
        if self.place is None:
            self.top = np.argsort(-per, kind="stable")[:PAIRED]
            self.place = np.full(VOCABULARY, PAIRED, np.int32)
            self.place[self.top] = np.arange(PAIRED)
        stream = np.concatenate([np.array([END_ID], np.int32), ids])
        here = self.place[stream]
        dense = (here[:-1] < PAIRED) & (here[1:] < PAIRED)
        part = np.bincount(here[:-1][dense] * PAIRED + here[1:][dense])
        self.table[: len(part)] += part.astype(np.int32)
        return np.unique(stream[:-1][~dense].astype(np.int64) * VOCABULARY + stream[1:][~dense], return_counts=True)

    def rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind, key, count) of all ids and of the table's pairs."""
        i, p = np.flatnonzero(self.ids), np.flatnonzero(self.table)
        keys = np.concatenate([i, self.top[p // PAIRED] * VOCABULARY + self.top[p % PAIRED]])
        return np.repeat([ID, PAIR], [len(i), len(p)]), keys, np.concatenate([self.ids[i], self.table[p]])


def _coded(file: str, schema: pa.Schema):
    """Rows with a text -> the same with its ids, two bytes each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(file)
        for b in batches:
            ids = [coder.array(t).astype(np.uint16).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in schema if f.name != "ids"), pa.array(ids, pa.binary())], schema=schema)

    return read


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int32) for x in column.to_pylist()]


def _count():
    def rows(kinds, keys, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["kind", "key", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        held: list[list[np.ndarray]] = [[], []]
        texts = size = 0

        def flush():
            w, nw = np.unique(np.concatenate(held[0]), return_counts=True)
            p, np_ = counts.add(np.concatenate(held[1]))
            return rows(np.repeat([WORD, PAIR, WORD], [len(w), len(p), 1]), np.concatenate([w.view(np.int64), p, [END_HASH.view(np.int64)]]), np.concatenate([nw, np_, [texts]]))

        for b in batches:
            column = b.column("text").fill_null("")
            for lo, hi, raw, offsets in slices(column):
                hashes, _ = words(raw, offsets)
                held[0].append(hashes)
                held[1] += [np.append(x, np.int32(END_ID)) for x in _ids(b.column("ids").slice(lo, hi - lo))]
                texts, size = texts + hi - lo, size + len(hashes)
                if size >= RUN:
                    yield flush()
                    held, texts, size = [[], []], 0, 0
        if texts:
            yield flush()
        if counts.place is not None:
            yield rows(*counts.rest())

    return read


@dataclass
class Statistics:
    counts: DataFrame  # kind, key, n
    total: int
    distinct: int
    ends: int
    tokens: int
    vocabulary: Vocabulary


def statistics(docs: DataFrame, scratch: Scratch) -> Statistics:
    """docs: the training documents' columns text and ids."""
    spark = docs.sparkSession
    counts = scratch.keep(docs.mapInArrow(trimmed(_count()), _COUNTED).groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    word = counts.where(F.col("kind") == WORD)
    end = int(END_HASH.view(np.int64))
    row = word.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), F.coalesce(F.sum(F.when(F.col("key") == end, F.col("n"))), F.lit(0)).alias("ends")).first()
    # At most a row for each id, and one for each pair of the most frequent ones.
    got = counts.where(F.col("kind") == ID).select("key", "n").toPandas()
    ids = np.zeros(VOCABULARY)
    ids[got["key"].to_numpy(np.int64)] = got["n"].to_numpy()
    _, rank = ranked(ids)
    # A row for each id, and so at most one for each two frequent ids, and one for each id and class.
    pairs = counts.where(F.col("kind") == PAIR).withColumn("a", F.floor(F.col("key") / VOCABULARY).cast("long")).withColumn("b", F.col("key") % VOCABULARY)
    ranks = rows_of(spark, list(zip(range(VOCABULARY), rank.tolist(), strict=True)), "b long, r long")
    pairs = pairs.join(F.broadcast(ranks), "b").join(F.broadcast(ranks.select(F.col("b").alias("a"), F.col("r").alias("s"))), "a").withColumn("top", F.greatest("r", "s"))
    met = pairs.where(F.col("top") < max(PAIRED, GROUPED)).select("key", "n", "top").toPandas()
    keys, times, top = met["key"].to_numpy(np.int64), met["n"].to_numpy(np.float64), met["top"].to_numpy()
    klass = classes(ids, keys, times)
    kinds = rows_of(spark, list(zip(range(VOCABULARY), klass.tolist(), strict=True)), "b long, k int")
    rest = pairs.where(F.col("top") >= PAIRED).join(F.broadcast(kinds), "b").groupBy("a", "k").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).toPandas()
    elsewhere = tuple(rest[c].to_numpy(np.int64) for c in ("a", "k", "n", "kinds"))
    words_ = Vocabulary(ids, keys[top < PAIRED], times[top < PAIRED], elsewhere, klass)
    return Statistics(counts, row["total"], row["distinct"], row["ends"], int(ids.sum()), words_)


# ---- the fit over all training documents


def _opening(share: float):
    """Coded texts -> data: the windows that are drawn to start with."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got, _ = pieces(_ids(b.column("ids")), _seeds(b), share)
            yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()], pa.binary())], ["data"])

    return read


def _seeds(b: pa.RecordBatch) -> np.ndarray:
    return b.column("__o").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _gone_through(work, share: float, how: Training):
    """Coded texts -> one row of a task, as ``_added`` makes it: all their windows, part by part as they come."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, sums = TaskContext.get().partitionId(), 0, None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def learn(last: bool) -> None:
            nonlocal held, part, sums
            got, key = (np.concatenate([x[i] for x in held]) for i in range(2))
            end = len(got) if last else len(got) - len(got) % how.part
            for a in range(0, end, how.part):
                z = min(a + how.part, end)
                mixed_up = got[a:z][np.argsort(key[a:z], kind="stable")]
                one = work(pa.table({"part": pa.array([part], pa.int32()), "data": pa.array([mixed_up.tobytes()], pa.binary())}))
                new = _sum_up(one.to_pylist(), how.width)
                sums = new if sums is None else tuple(x + y for x, y in zip(sums, new, strict=True))
                part += 1
            held = [(got[end:], key[end:])]

        for b in batches:
            held.append(pieces(_ids(b.column("ids")), _seeds(b), share))
            if sum(len(w) for w, _ in held) >= how.part:
                learn(False)
        if held:
            learn(True)
        if sums is not None:
            yield from _summed_row(at % SLOTS, at, *sums).to_batches()

    return read


def _opened_windows(data: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(d, np.uint16).reshape(-1, WINDOW + 1) for d in data] or [np.zeros((0, WINDOW + 1), np.uint16)])


SLOTS = 16


def _improved(held, how: Training):
    """A part's windows -> (n, data, rows, met, emb): the weights after them, times their number; input rows, times how often they are met."""

    def work(table: pa.Table) -> pa.Table:
        p, row, klass = held.value
        model = Attention(how.width, how.inner, np.zeros(CLASSES), how.seed)
        model.p = {k: v.copy() for k, v in p.items()}
        adam, got = Adam(model), _opened_windows(table.column("data").to_pylist())
        steps = -(-len(got) // how.batch)
        for i in range(steps):
            adam(got[i * how.batch : (i + 1) * how.batch], row, klass, how.later * min(1, (i + 1) / 20) * (1 - 0.9 * i / steps))
        flat = np.concatenate([v.ravel() for k, v in model.p.items() if k != "emb"]).astype(np.float64) * len(got)
        ids = got[:, :-1]
        met = np.bincount(row[ids[ids != PAD]], minlength=VOCABULARY)
        on = np.flatnonzero(met)
        data = dict(data=flat, rows=on.astype(np.int64), met=met[on].astype(np.float64), emb=model.p["emb"][on] * met[on, None].astype(np.float32))
        return pa.table({"n": [len(got)], **{k: pa.array([v.tobytes()], pa.binary()) for k, v in data.items()}})

    return work


def _sum_up(rows: list[dict], width: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, weights, times that rows are met, input rows): sums."""
    met, emb, flat = np.zeros(VOCABULARY), np.zeros((VOCABULARY, width)), 0.0
    for r in rows:
        on = np.frombuffer(r["rows"], np.int64)
        met[on] += np.frombuffer(r["met"], np.float64)
        emb[on] += np.frombuffer(r["emb"], np.float32).reshape(-1, width)
        flat = flat + np.frombuffer(r["data"], np.float64)
    return sum(r["n"] for r in rows), flat, met, emb


def _summed_row(slot: int, part: int, n: int, flat: np.ndarray, met: np.ndarray, emb: np.ndarray) -> pa.Table:
    on = np.flatnonzero(met)
    data = dict(data=flat, rows=on.astype(np.int64), met=met[on], emb=emb[on].astype(np.float32))
    return pa.table({"slot": pa.array([slot], pa.int32()), "part": pa.array([part], pa.int32()), "n": [n], **{k: pa.array([v.tobytes()], pa.binary()) for k, v in data.items()}})


def _added(width: int):
    def work(table: pa.Table) -> pa.Table:
        return _summed_row(table.column("slot")[0].as_py(), 0, *_sum_up(table.sort_by("part").to_pylist(), width))

    return work


def fitted(coded: DataFrame, stats: Statistics, how: Training) -> Attention:
    """A model of all the training documents' windows; coded: their ids and __o. Each task goes through its own texts, so windows aren't moved."""
    spark, words_ = coded.sparkSession, stats.vocabulary
    every = max(1.0, stats.tokens / WINDOW + stats.ends)
    # About ``first`` windows, whatever the table's size.
    drawn = coded.mapInArrow(trimmed(_opening(min(1.0, how.first / every))), "data binary").collect()
    model = start(_ordered(_opened_windows([r["data"] for r in drawn])), words_, how)
    if how.steps:
        held = spark.sparkContext.broadcast((model.p, words_.row, words_.klass))
        kinds = "slot int, part int, n long, data binary, rows binary, met binary, emb binary"
        work = _improved(held, how)
        better = coded.mapInArrow(trimmed(_gone_through(work, min(1.0, max(how.share, how.first / every)), how)), kinds)
        rows = sorted(better.groupBy("slot").applyInArrow(_added(how.width), kinds).collect(), key=lambda r: r["slot"])
        if rows:
            n, flat, met, emb = _sum_up(rows, how.width)
            on, at = met > 0, 0
            model.p["emb"][on] = (emb[on] / met[on, None]).astype(np.float32)
            for k, v in model.p.items():
                if k != "emb":
                    model.p[k] = (flat[at : at + v.size] / n).reshape(v.shape).astype(np.float32)
                    at += v.size
    return model


# ---- word sums of texts, by bins of words


def _signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each text's bag of words."""
    total = np.zeros(len(counts), np.uint64)
    some = counts > 0
    if some.any():
        at = np.cumsum(counts) - counts
        total[some] = np.add.reduceat(mixed(hashes * np.uint64(0xA0761D6478BD642F) + np.uint64(1)), at[some])
    return mixed(total + counts.astype(np.uint64)).view(np.int64)


def _in(heavy: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in heavy, whether it is there)."""
    if not len(heavy):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    place = np.minimum(np.searchsorted(heavy, hashes), len(heavy) - 1)
    return place, heavy[place] == hashes


def _bin_edges(bins: int) -> np.ndarray:
    """Least hashes of the bins."""
    return (-(-(np.arange(bins, dtype=np.int64) << 32) // bins)).astype(np.uint64) << np.uint64(32)


def _bin_of(hashes: np.ndarray, bins: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int32)


def _requests(held: list[tuple], bins: int) -> tuple[list[int], list[bytes]]:
    """(bins, data): the words of a run of distinct texts that aren't heavy; held: (hashes, counts, signatures, whether heavy)."""
    hashes, counts, sig, heavy = (np.concatenate([x[i] for x in held]) for i in range(4))
    sigs, first = np.unique(sig, return_index=True)
    own = np.full(len(sig), -1, np.int64)
    own[first] = np.arange(len(sigs))
    ref = own[np.repeat(np.arange(len(sig)), counts)]
    rare = (ref >= 0) & ~heavy
    h, r = hashes[rare], ref[rare]
    order = np.lexsort((r, h))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    begin = np.flatnonzero(new)
    tf = np.diff(begin, append=len(h))
    h, r = h[begin], r[begin]
    cuts = np.append(np.searchsorted(h, _bin_edges(bins)), len(h))
    keys, data = [], []
    for k in range(bins):
        a, z = cuts[k], cuts[k + 1]
        if z > a:
            here, place = np.unique(r[a:z], return_inverse=True)
            head = np.array([z - a, len(here)], np.int64).tobytes()
            data.append(b"".join([head, _planes(np.diff(h[a:z], prepend=h[a : a + 1])), h[a : a + 1].tobytes(), _planes(place.astype(np.uint32)), _planes(tf[a:z].astype(np.int32)), sigs[here].tobytes()]))
            keys.append(k)
    return keys, data


def _opened(data: bytes) -> tuple[np.ndarray, ...]:
    """(hashes, refs, tf, sigs)."""
    view = memoryview(data)
    n, c = (int(x) for x in np.frombuffer(view, np.int64, 2))
    at = 16
    steps = _unplaned(view[at:], n, np.uint64)
    first = np.frombuffer(view, np.uint64, 1, at + 8 * n)
    at += 8 * n + 8
    refs, tf = _unplaned(view[at:], n, np.uint32), _unplaned(view[at + 4 * n :], n, np.int32)
    return np.cumsum(steps, dtype=np.uint64) + first, refs, tf, np.frombuffer(view, np.int64, c, at + 8 * n)


def _pair_hashes(keys: np.ndarray) -> np.ndarray:
    return mixed(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D))


def _lifted(model, bins: int):
    """Counts of pairs -> (bin, key, n, gain) of those that aren't in the table; key: the pair's hash, gain: log10, n: 0, as it is no word."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ = model.value[1]
        for b in batches:
            keys, n = b.column("key").to_numpy(), b.column("n").to_numpy()
            on = words_.apart(keys // VOCABULARY, keys % VOCABULARY)
            h = _pair_hashes(keys[on])
            yield pa.RecordBatch.from_arrays([pa.array(_bin_of(h, bins)), pa.array(h.view(np.int64)), pa.array(np.zeros(len(on), np.int64)), pa.array(words_.lifts(keys[on], n[on]) / np.log(10))], ["bin", "key", "n", "gain"])

    return read


def _looked_up(bins: int):
    """A bin's runs and counts -> (part, data): sums for the texts that have its words and pairs."""
    schema = pa.schema([("part", pa.int32()), ("data", pa.binary())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return schema.empty_table()
        keys, n = right.column("key").to_numpy().astype(np.int64).view(np.uint64), right.column("n").to_numpy()
        order = np.argsort(keys)
        keys, n, gain = keys[order], n[order], right.column("gain").to_numpy()[order]
        runs = [_opened(d) for d in left.column("data").to_pylist()]
        offset, refs = 0, []
        for _, r, _, s in runs:
            refs.append(r.astype(np.int64) + offset)
            offset += len(s)
        sig, first, same = np.unique(np.concatenate([x[3] for x in runs]), return_index=True, return_inverse=True)
        sums, known, gains = np.zeros(len(sig)), np.zeros(len(sig), np.int64), np.zeros(len(sig))
        for (h, _, tf, _), r in zip(runs, refs, strict=True):
            mine = first[same[r]] == r  # a text that several runs sent counts in the first
            place, there = _in(keys, h)
            c = np.where(there, n[place] if len(n) else 0, 0)
            sums += np.bincount(same[r], np.where(mine, tf * np.log10(c + 1.0), 0), len(sig))
            known += np.bincount(same[r], np.where(mine & (c > 0), tf, 0), len(sig)).astype(np.int64)
            gains += np.bincount(same[r], np.where(mine & there, tf * (gain[place] if len(gain) else 0.0), 0), len(sig))
        to = (sig.view(np.uint64) % np.uint64(bins)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(bins + 1))
        out = [(k, np.stack([sig, sums.view(np.int64), known, gains.view(np.int64)])[:, order[cuts[k] : cuts[k + 1]]].tobytes()) for k in np.flatnonzero(np.diff(cuts))]
        return pa.table({"part": pa.array([int(k) for k, _ in out], pa.int32()), "data": pa.array([d for _, d in out], pa.binary())}, schema=schema)

    return work


def _summed(table: pa.Table) -> pa.Table:
    sig, sums, known, gains = np.concatenate([np.frombuffer(d, np.int64).reshape(4, -1) for d in table.column("data").to_pylist()], axis=1)
    sigs, same = np.unique(sig, return_inverse=True)
    return pa.table({"rare_sig": sigs, "rare_sum": np.bincount(same, np.ascontiguousarray(sums).view(np.float64), len(sigs)), "rare_known": np.bincount(same, known, len(sigs)).astype(np.int64), "rare_gain": np.bincount(same, np.ascontiguousarray(gains).view(np.float64), len(sigs))})


def _scored(heavy, model, kept: list[str], bins: int, schema: pa.Schema):
    """Texts -> a row for each, with the kept columns, the bag's hash, its words, sums over heavy words and the model's score; and rows with requests (bin, data)."""

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, logs), score = heavy.value, Scorer(*model.value)
        held: list[tuple] = []
        size = 0

        def asked() -> pa.RecordBatch:
            keys, data = _requests(held, bins)
            return rows(len(keys), bin=pa.array(keys, pa.int32()), data=pa.array(data, pa.binary()))

        for b in batches:
            column = b.column("text").fill_null("")
            for lo, hi, raw, offsets in slices(column):
                hashes, counts = words(raw, offsets)
                place, there = _in(known, hashes)
                doc = np.repeat(np.arange(hi - lo), counts)
                sums = np.bincount(doc, np.where(there, logs[place] if len(logs) else 0.0, 0.0), hi - lo)
                found = np.bincount(doc, there, hi - lo).astype(np.int64)
                texts = _ids(b.column("ids").slice(lo, hi - lo))
                scores = score(texts)
                # Pairs that aren't in the table are asked for with the words.
                stream = np.concatenate([np.concatenate([END, t, END]) for t in texts])
                of = np.repeat(np.arange(hi - lo), [len(t) + 2 for t in texts])
                on = score.words.apart(stream[:-1], stream[1:])
                on = on[of[on] == of[on + 1]]
                order = np.argsort(np.concatenate([doc, of[on]]), kind="stable")
                asked_for = np.concatenate([hashes, _pair_hashes(stream[on].astype(np.int64) * VOCABULARY + stream[on + 1])])[order]
                often = np.concatenate([there, np.zeros(len(on), bool)])[order]
                per = counts + np.bincount(of[on], minlength=hi - lo)
                sig = _signatures(asked_for, per)
                part = b.slice(lo, hi - lo)
                own = dict(__sig=pa.array(sig), __words=pa.array(counts, pa.int64()), __sum=pa.array(sums), __known=pa.array(found), __score=pa.array(scores))
                yield rows(hi - lo, **{k: part.column(k) for k in kept}, **own)
                held.append((asked_for, per, sig, often))
                size += len(asked_for)
                if size >= RUN:
                    yield asked()
                    held, size = [], 0
        if size:
            yield asked()

    return read


def score(docs: DataFrame, learn: Column, *, training: Training = Training(), tokenizer: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, n_tokens, n_known, train_tokens, base_score and score of every row; the model learns where ``learn`` holds."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lm")
    small_batches(spark)
    file = tokenizer or vocabulary()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    cols = docs.select(
        *[docs[f"`{c}`"].alias(f"__c{i}") for i, c in enumerate(carry)], F.coalesce(learn, F.lit(False)).alias("__learn"),
        F.xxhash64(docs["doc_id"], text, F.lit(training.seed)).alias("__o"), text.alias("text"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in cols.schema.fields]).add("ids", "binary")
    coded = scratch.keep(cols.mapInArrow(trimmed(_coded(file, to_arrow_schema(schema))), schema), "coded")
    learned = coded.where("__learn")
    stats = statistics(learned.select("text", "ids"), scratch)
    attention = fitted(learned.select("ids", "__o"), stats, training)
    word = stats.counts.where(F.col("kind") == WORD)
    often = word.where((F.col("n") * HEAVY >= stats.total) & (F.col("n") > 0)).select("key", "n").toPandas().sort_values("key")
    keys = often["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    # At most HEAVY words, and a model whose tables have fixed sizes.
    heavy = spark.sparkContext.broadcast((keys[order], np.log10(often["n"].to_numpy(np.float64)[order] + 1)))
    model = spark.sparkContext.broadcast((attention, stats.vocabulary))

    # As many bins as keep BIN words and pairs in each.
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * (stats.total + stats.tokens) // BIN))
    kept = [f"__c{i}" for i in range(len(carry))]
    cols = coded.select(*kept, "text", "ids")
    schema = T.StructType([T.StructField(c, cols.schema[c].dataType) for c in kept])
    for name, kind in (("__sig", "long"), ("__words", "long"), ("__sum", "double"), ("__known", "long"), ("__score", "double"), ("bin", "integer"), ("data", "binary")):
        schema = schema.add(name, kind)
    made = scratch.keep(cols.mapInArrow(trimmed(_scored(heavy, model, kept, bins, to_arrow_schema(schema))), schema), "scored")
    sent = made.where("bin IS NOT NULL").select("bin", "data")
    rest = word.where(F.col("n") * HEAVY < stats.total).select(F.shiftright(F.shiftrightunsigned("key", 32) * bins, 32).cast("int").alias("bin"), "key", "n", F.lit(0.0).alias("gain"))
    rest = rest.unionByName(stats.counts.where(F.col("kind") == PAIR).select("key", "n").mapInArrow(_lifted(model, bins), "bin int, key long, n long, gain double"))
    looked = sent.groupBy("bin").cogroup(rest.groupBy("bin")).applyInArrow(_looked_up(bins), "part int, data binary")
    rare = scratch.keep(looked.groupBy("part").applyInArrow(_summed, "rare_sig long, rare_sum double, rare_known long, rare_gain double"), "rare")
    scratch.drop("counts", "coded")
    rows = made.where("bin IS NULL").drop("bin", "data")
    rows = rows.join(rare, rows["__sig"] == rare["rare_sig"], "left")
    n = F.col("__words") + 1
    total = F.col("__sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(float(np.log10(stats.ends + 1)))
    return rows.select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)],
        n.alias("n_tokens"),
        (F.col("__known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(stats.ends > 0))).cast("long").alias("n_known"),
        F.lit(int(stats.total)).cast("long").alias("train_tokens"),
        (total - n * F.lit(float(np.log10(stats.total + stats.distinct + 1)))).alias("base_score"),
        (F.col("__score") + F.coalesce("rare_gain", F.lit(0.0))).alias("score"),
    )
