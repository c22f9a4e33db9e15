"""SimHash near duplicates, linked by a self-join of binary tries.

Equal fingerprints are one node. Two fingerprints within ``budget`` bits agree on
at least ``blocks - budget`` of ``blocks`` blocks, so all fingerprints that agree
on such a choice of blocks meet in one bucket. In a bucket they form a binary
trie; pairs of its nodes are walked together from the root, the differing bits of
their prefixes are counted, and a pair is left as soon as they exceed the budget
or both sides are known to be one component. A bucket gives a spanning forest of
its links, and the components of all buckets together are the result.
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_text
from ledgerloom.llm.components import components
from ledgerloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
SHINGLE = 4
BUDGET = 4
#: Largest bucket handled whole; larger ones are split into parts that meet pair by pair.
BUCKET_ROWS = 20_000
#: Fingerprints expected in a bucket, beyond which more and longer keys are used.
EXPECTED_ROWS = 256
#: Pairs of trie nodes looked at together.
FRONT = 1 << 17


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles in order; a text of fewer words is one, no words: none."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    n = len(words)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return np.array([digest(joined, SEED)] * (n > 0), np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())], np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes; no words: zero."""
    h = shingle_hashes(text, shingle)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        part = h[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(h)).tolist())


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``: the fingerprint as a signed 64-bit integer."""

    def make():
        def signed(t: str) -> int:
            f = fingerprint(t, shingle)
            return f - (1 << 64) if f >> 63 else f

        return lambda texts: [[signed(t) for t in texts]]

    return map_text(docs, make, "fp bigint", keep, text)


# ---- the trie of a bucket ----------------------------------------------------------------------

def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _prefix_length(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading bits that x and y share (64 if equal)."""
    d = x ^ y
    for s in (1, 2, 4, 8, 16, 32):
        d = d | d >> np.uint64(s)
    return 64 - _bits(d).astype(np.int64)


class Tries:
    """Path-compressed binary tries of sorted, distinct values, one trie per bucket, as arrays over nodes.

    A node is a range of values that share ``depth`` leading bits; leaves have depth 64.
    """

    def __init__(self, values: np.ndarray, starts: np.ndarray) -> None:
        self.values = values
        low, high = starts, np.append(starts[1:], len(values))
        lows, highs, depths, lefts, rights = [], [], [], [], []
        made = 0
        while len(low):
            depth = _prefix_length(values[low], values[high - 1])
            inner = depth < 64
            k = int(inner.sum())
            bit = np.uint64(1) << (63 - depth[inner]).astype(np.uint64)
            a, b = low[inner].copy(), high[inner].copy()
            while (a < b).any():  # the first value whose bit is set
                mid = (a + b) // 2
                is_set = (values[np.minimum(mid, len(values) - 1)] & bit) != 0
                open_ = a < b
                b = np.where(open_ & is_set, mid, b)
                a = np.where(open_ & ~is_set, mid + 1, a)
            left, right = np.full(len(low), -1), np.full(len(low), -1)
            child = made + len(low)
            left[inner], right[inner] = child + np.arange(k), child + k + np.arange(k)
            for out, x in ((lows, low), (highs, high), (depths, depth), (lefts, left), (rights, right)):
                out.append(x)
            made = child
            low, high = np.concatenate([low[inner], a]), np.concatenate([a, high[inner]])
        self.low, self.high, self.depth, self.left, self.right = map(np.concatenate, (lows, highs, depths, lefts, rights))
        self.roots = np.arange(len(starts))


def linked(values: np.ndarray, starts: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For each value the index of the value its component in the bucket is named after (indices within ``values``)."""
    t = Tries(values, starts)
    label = np.arange(len(values))
    change = np.arange(len(values))  # how often the label has changed up to here: a range with no change is one component

    def join(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal label, change
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label = up
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])

    todo = [(t.roots, t.roots)]
    while todo:
        u, v = todo.pop()
        if len(u) > FRONT:
            h = len(u) // 2
            todo += [(u[:h], v[:h]), (u[h:], v[h:])]
            continue
        same = u == v
        # a node with itself: both halves with themselves, and one with the other
        own = u[same & (t.depth[u] < 64)]
        u, v = u[~same], v[~same]
        if len(u):
            a, b = t.low[u], t.low[v]
            one = (label[a] == label[b]) & (change[a] == change[t.high[u] - 1]) & (change[b] == change[t.high[v] - 1])
            shared = np.minimum(t.depth[u], t.depth[v])
            x = t.values[a] ^ t.values[b]
            differ = _bits(np.where(shared > 0, x >> np.minimum(64 - shared, 63).astype(np.uint64), np.uint64(0)))
            go = ~one & (differ <= budget)
            u, v, shared = u[go], v[go], shared[go]
            leaf = shared == 64
            if leaf.any():
                join(t.low[u[leaf]], t.low[v[leaf]])
            u, v = u[~leaf], v[~leaf]
            swap = t.depth[u] > t.depth[v]
            u, v = np.where(swap, v, u), np.where(swap, u, v)  # the one that splits first
            if len(u):
                todo.append((np.concatenate([t.left[u], t.right[u]]), np.concatenate([v, v])))
        if len(own):
            left, right = t.left[own], t.right[own]
            todo.append((left, right))
            todo.append((np.concatenate([left, right]), np.concatenate([left, right])))
    return label


def _bucket_forests(budget: int):
    """Task function over rows sorted by bucket and value: edges of a spanning forest of each bucket."""
    names = ["choice", "part", "first", "second", "fp"]

    def forest(columns: list[np.ndarray]):
        fp = columns[-1].view(np.uint64)
        edge = np.zeros(len(fp), bool)
        edge[:1] = True
        for c in columns[:-1]:
            edge[1:] |= c[1:] != c[:-1]
        # values sort as unsigned within each bucket
        group = np.cumsum(edge) - 1
        order = np.lexsort((fp, group))
        fp, group = fp[order], group[order]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        label = linked(fp, starts, budget)
        child = np.flatnonzero(label != np.arange(len(label)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[child]), pa.array(signed[label[child]])], ["a", "b"])

    def task(batches):
        held = None
        for batch in batches:
            rows = [np.asarray(batch.column(i)) for i in range(len(names))]
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if len(held[0]) < 1 << 17:
                continue
            last = np.zeros(len(held[0]), bool)
            for c in held[:-1]:
                last[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(last)
            if len(cuts):
                k = int(cuts[-1])  # the last bucket may go on in the next batch
                yield forest([c[:k] for c in held])
                held = [c[k:] for c in held]
        if held is not None and len(held[0]):
            yield forest(held)

    return task


def block_masks(blocks: int, budget: int = BUDGET) -> list[int]:
    """Masks of all choices of ``blocks - budget`` out of ``blocks`` blocks of 64 bits."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:])]
    return [sum(c) for c in combinations(parts, blocks - budget)]


def enough_blocks(n: int, budget: int = BUDGET, expected: int = EXPECTED_ROWS) -> int:
    """The least number of blocks for which evenly spread fingerprints fill a bucket with the expected rows at most."""
    blocks = budget + 1
    while blocks < 2 * budget and n > expected * 2 ** (64 * (blocks - budget) // blocks):
        blocks += 1
    return blocks


def link_fingerprints(nodes: DataFrame, budget: int = BUDGET, blocks: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b) between distinct values of ``fp`` that connect exactly what links within ``budget`` bits connect."""
    blocks = blocks or enough_blocks(nodes.count(), budget)
    masks = block_masks(blocks, budget)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    key = F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed))))
    keyed = nodes.select("fp", key.alias("k")).select("k.choice", "k.part", "fp")
    sizes = keyed.groupBy("choice", "part").agg(F.count("*").alias("_n")).filter(F.col("_n") > bucket_rows)
    n = F.ceil(F.coalesce("_n", F.lit(1)) / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    others = F.transform(F.sequence(F.lit(0), n - 1), lambda s: F.struct(F.least(s, own).alias("first"), F.greatest(s, own).alias("second")))
    split = keyed.join(sizes, ["choice", "part"], "left").select("choice", "part", "fp", F.explode(F.array_distinct(others)).alias("m")).select("choice", "part", "m.first", "m.second", "fp")
    at = ["choice", "part", "first", "second"]
    placed = split.repartition(*at).sortWithinPartitions(*at)
    return placed.mapInArrow(_bucket_forests(budget), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET, keep: list[str] | None = None, blocks: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``keep`` (default: the id), ``fingerprint`` (16 hex digits), ``component_id`` (the least id reachable over links) and ``component`` (a fingerprint that names it).

    NULL and empty texts have fingerprint zero and link like any other. Repeated
    rows share a component; rows with a NULL id take the least id of the others
    (NULL if there is none).
    """
    keep = keep or [ident]
    own = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(ident).alias("_id"), F.col(text).alias("_txt"))
    prints = materialize(fingerprints(source, [*own, "_id"], "_txt", shingle), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("_id").alias("least")), "nodes")
    roots = components(link_fingerprints(nodes.select("fp"), budget, blocks, bucket_rows))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = named.join(ids, "root").select("fp", "component_id", F.col("root").alias("component"))
    return prints.join(members, "fp").select(*(F.col(o).alias(c) for c, o in zip(keep, own)), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component")
