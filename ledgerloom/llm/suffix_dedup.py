"""Repeated byte strings found by sorting suffixes, deep-shallow.

Only suffixes that start at *anchors* are sorted. The anchor of a window of
``span`` bytes is the place of the least hash among its ``GRAM``-byte grams
(leftmost of equal ones), so equal windows have their anchors at the same
offset, and two windows can be equal only if their anchors share a gram. Anchors
are grouped by the gram's hash; an anchor's surroundings are the bytes of the
windows it stands for, and equal surroundings are one entry with a count.
The suffixes of a group are ordered by multikey quicksort to a shallow depth, and
groups that still agree there by blind tries. The sorted order with its common
prefixes is merged from deep to shallow; each merge compares what lies to the
left of the anchors, which gives for each anchor the longest stretch to the left
and right that some other place shares over at least ``span`` bytes.

A group of any size is exact: those above ``group_rows`` surroundings are not
brought to one task but settled by counting windows, halved until each is decided.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_left

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches
from ledgerloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN = 400
GRAM = 64
#: Surroundings of a gram that one task sorts; larger groups are settled by counting windows.
GROUP_ROWS = 20_000
#: Bytes that multikey quicksort looks at beyond the gram before blind tries take over.
SHALLOW = 32
_STEP = 8
#: Grams of a text hashed together; positions within a piece fit the low bits of a key.
_PIECE = 1 << 23
_LOW = np.uint64((1 << 24) - 1)

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_TABLE = np.random.default_rng(64).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of every gram of ``raw``."""
    n = len(raw)
    terms = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * _powers(_MULTIPLIER, n))])
    h = (terms[gram:] - terms[: n - gram + 1]) * _powers(_INVERSE, n - gram + 1)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def anchors(text: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all windows of ``text``, and how far before its anchor a window begins, at least and at most.

    Neighbouring windows that have the same anchor are one entry. A text of more
    than one piece may give an anchor two entries, for different windows.
    """
    width, parts = span - gram + 1, []
    for begin in range(0, len(text) - span + 1, _PIECE):
        raw = np.frombuffer(text[begin : begin + _PIECE + span - 1], np.uint8)
        h = gram_hashes(raw, gram)
        key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        pad = -len(key) % width
        blocks = np.append(key, np.full(pad, np.uint64(2**64 - 1))).reshape(-1, width)
        head = np.minimum.accumulate(blocks, axis=1).ravel()
        tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(key) - width + 1
        least = np.minimum(tail[:windows], head[width - 1 : width - 1 + windows])
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        last = np.append(first[1:], windows) - 1
        at = (least[first] & _LOW).astype(np.int64)
        parts.append((at + begin, h[at], at - last, at - first))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def surroundings(text: bytes, at: int, low: int, high: int, span: int = SPAN) -> tuple[bytes, bytes]:
    """What lies left of an anchor, reversed, and right of it, over the windows it stands for."""
    return text[at - high : at][::-1], text[at : at - low + span]


# ---- sorting suffixes --------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie_order(suffixes: list[bytes], which: list[int]) -> tuple[list[int], list[int]]:
    """Order of ``which`` and the common prefix of each with the one before it, by a blind (Patricia) trie.

    A node is [skip, children by byte, a leaf below it]; -1 stands for the end of a suffix.
    """
    root: list | None = None
    equal: dict[int, list[int]] = {}
    for i in which:
        s = suffixes[i]
        if root is None:
            root = [len(s), None, i]
            equal[i] = [i]
            continue
        node = root
        while node[1] is not None:  # the blind search follows branching bytes only
            c = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(c) or next(iter(node[1].values()))
        other = node[2]
        shared = common_prefix(s, suffixes[other])
        if shared == len(s) == len(suffixes[other]):
            equal[other].append(i)
            continue
        node = root
        while node[1] is not None and node[0] < shared:
            node = node[1][s[node[0]] if node[0] < len(s) else -1]
        c = s[shared] if shared < len(s) else -1
        if node[1] is not None and node[0] == shared:
            node[1][c] = [len(s), None, i]
        else:
            below = suffixes[node[2]]
            node[:] = [shared, {below[shared] if shared < len(below) else -1: node[:], c: [len(s), None, i]}, node[2]]
        equal[i] = [i]
    order, prefix, todo = [], [], [(root, 0)]
    while todo:
        node, shared = todo.pop()
        if node[1] is None:
            same = equal[node[2]]
            order += same
            prefix += [shared] + [len(suffixes[node[2]])] * (len(same) - 1)
            continue
        children = [node[1][c] for c in sorted(node[1])]
        todo += [(child, node[0] if k else shared) for k, child in reversed(list(enumerate(children)))]
    return order, prefix


def deep_shallow_order(suffixes: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Sorted order of the suffixes and each one's common prefix with its predecessor (0 for the first)."""
    out: list[int] = []
    prefix: list[int] = []
    limit = depth + shallow
    # entries: the suffixes, the depth they share, and the common prefix of the first of them with what comes before
    todo = [(list(range(len(suffixes))), depth, 0)] if suffixes else []
    while todo:
        part, at, before = todo.pop()
        if len(part) == 1:
            out.append(part[0])
            prefix.append(before)
        elif at >= limit or all(len(suffixes[i]) <= at for i in part):
            order, shared = blind_trie_order(suffixes, part)
            out += order
            prefix += [before, *shared[1:]]
        else:
            keys = {i: suffixes[i][at : at + _STEP] for i in part}
            pivot = keys[part[len(part) // 2]]
            less, same, more = [], [], []
            for i in part:
                k = keys[i]
                (same if k == pivot else less if k < pivot else more).append(i)
            # borders between the three parts are compared when both sides are known: see below
            stack = [(less, at, -1), (same, at + len(pivot) if len(pivot) == _STEP else limit, -1), (more, at, -1)]
            stack = [x for x in stack if x[0]]
            stack[0] = (stack[0][0], stack[0][1], before)
            todo += reversed(stack)
    for k in range(1, len(out)):
        if prefix[k] < 0:
            prefix[k] = common_prefix(suffixes[out[k - 1]], suffixes[out[k]])
    if prefix:
        prefix[0] = 0
    return out, prefix


def longest_shared(lefts: list[bytes], rights: list[bytes], span: int = SPAN, gram: int = GRAM) -> list[tuple[int, int]]:
    """For each entry of a group the longest reach to the left and to the right shared with another entry over ``span`` bytes or more; (0, 0) if none.

    Sets of entries that share ever shorter right sides are merged, small into
    large, each kept sorted by its left sides; a neighbour in that order has the
    longest common left side, so only neighbours need to be compared.
    """
    n = len(rights)
    reach_left, reach_right = [0] * n, [0] * n

    def meet(i: int, j: int, right: int) -> None:
        left = common_prefix(lefts[i], lefts[j])
        if left + right >= span:
            for x in (i, j):
                reach_left[x] = max(reach_left[x], left)
                reach_right[x] = max(reach_right[x], right)

    alike = len({r[:gram] for r in rights}) == 1  # else two grams share a hash
    order, prefix = deep_shallow_order(rights, gram if alike else 0)
    owner = list(range(n))  # of each place in the order, the first place of its set
    sets = {k: [(lefts[i], i)] for k, i in enumerate(order)}

    def find(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    longest_left = max(map(len, lefts), default=0)
    for k in sorted(range(1, n), key=lambda k: -prefix[k]):
        right = prefix[k]
        if right + longest_left < span:
            break
        a, b = find(k - 1), find(k)
        small, large = (sets.pop(a), sets.pop(b))
        if len(small) > len(large):
            small, large = large, small
        for entry in small:
            p = bisect_left(large, entry)
            if p:
                meet(entry[1], large[p - 1][1], right)
            if p < len(large):
                meet(entry[1], large[p][1], right)
            large.insert(p, entry)
        owner[b] = a
        sets[a] = large
    return list(zip(reach_left, reach_right))


# ---- the Spark side ----------------------------------------------------------------------------

def keyed(docs: DataFrame, keep: list[str], ident: str, text: str) -> DataFrame:
    """``keep`` under safe names, the text, and a key of a row: its id and a hash of its text. Rows alike in both share all results."""
    own = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    txt = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*own, F.col(ident).alias("_id"), F.xxhash64(txt).alias("_h"), txt.alias("_txt"))


def _of_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the key of a row, whose id may be NULL."""
    r = right.withColumnsRenamed({"_id": "_rid", "_h": "_rh"})
    return left.join(r, left["_id"].eqNullSafe(r["_rid"]) & (left["_h"] == r["_rh"]), how).drop("_rid", "_rh")


def anchor_rows(rows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Key, ``places``, ``low``, ``high``, ``g`` (hash of the gram) and ``c`` (hash of the surroundings) of all anchors.

    Anchors of a text with equal surroundings are one row, so a text that repeats
    itself does not send a row for each repeat.
    """

    def make():
        digest = xxhash.xxh3_64_intdigest

        def run(batch: dict) -> list:
            out: list[list] = [[] for _ in range(7)]
            for i, k, t in zip(batch["_id"], batch["_h"], batch["_txt"]):
                raw = t.encode()
                at, h, low, high = anchors(raw, span, gram)
                alike: dict[tuple, list[int]] = {}
                for p, a, b, g in zip(at.tolist(), low.tolist(), high.tolist(), h.view(np.int64).tolist()):
                    alike.setdefault((a, b, g, digest(raw[p - b : p - a + span], seed=b) - (1 << 63)), []).append(p)
                for (a, b, g, c), places in alike.items():
                    for o, x in zip(out, (i, k, places, a, b, g, c)):
                        o.append(x)
            return out

        return run

    long_enough = rows.filter(F.octet_length("_txt") >= span).select("_id", "_h", "_txt")
    kind = long_enough.schema["_id"].dataType.simpleString()
    return map_batches(long_enough, make, f"_id {kind}, _h bigint, places array<bigint>, low int, high int, g bigint, c bigint")


def _with_surroundings(wanted: DataFrame, rows: DataFrame, span: int) -> DataFrame:
    """The anchors of ``wanted`` (key, place, low, high, g, c) with their surroundings ``l`` (reversed) and ``r``."""
    per_row = wanted.groupBy("_id", "_h").agg(F.collect_list(F.struct("place", "low", "high", "g", "c")).alias("_at"))

    def make():
        def run(batch: dict) -> list:
            out: list[list] = [[], [], [], []]
            for t, at in zip(batch["_txt"], batch["_at"]):
                raw = t.encode()
                for a in at:
                    for o, x in zip(out, (a["g"], a["c"], *surroundings(raw, a["place"], a["low"], a["high"], span))):
                        o.append(x)
            return out

        return run

    # a row that is there twice gives its surroundings twice, which changes nothing: equal entries are one
    found = _of_row(rows.select("_id", "_h", "_txt"), per_row, "inner").select("_txt", "_at")
    return map_batches(found, make, "g bigint, c bigint, l binary, r binary")


def _sorted_groups(entries: DataFrame, span: int, gram: int) -> DataFrame:
    """``g``, ``c``, ``l``, ``r`` (reaches) of every entry that shares a window; a group is sorted in one task."""

    def make():
        held: dict[str, list] = {"g": [], "c": [], "l": [], "r": []}

        def settle(g: list, c: list, lefts: list, rights: list, out: list) -> None:
            begin = 0
            for k in range(1, len(g) + 1):
                if k == len(g) or g[k] != g[begin]:
                    if k - begin > 1:
                        for i, (a, b) in enumerate(longest_shared(lefts[begin:k], rights[begin:k], span, gram), begin):
                            if a or b:
                                for o, x in zip(out, (g[i], c[i], a, b)):
                                    o.append(x)
                    begin = k

        def run(batch: dict | None) -> list:
            out: list = [[], [], [], []]
            if batch is None:
                settle(*held.values(), out)
                return out
            for k in held:
                held[k] += batch[k]
            g = held["g"]
            cut = len(g)
            while cut and g[cut - 1] == g[-1]:
                cut -= 1  # the last group may go on in the next batch
            settle(*(held[k][:cut] for k in held), out)
            for k in held:
                held[k] = held[k][cut:]
            return out

        return run

    return map_batches(entries.repartition("g").sortWithinPartitions("g"), make, "g bigint, c bigint, l int, r int", last=True)


#: Windows in a range that is counted whole, and what an undecided range is split into, down to single windows.
RANGES = (16, 4, 1)


def _counted_windows(entries: DataFrame, span: int) -> DataFrame:
    """The same for groups too large to sort in one task: windows are counted, ranges of them at a time.

    A range holds the windows that begin ``low`` to ``low + width - 1`` bytes
    before the anchor. If no other entry has the range's core (the bytes common
    to all its windows), none of them is shared; if another has its hull (all
    their bytes), every one is. Other ranges are split. Of entries with the same
    hull one stays for others to be compared with. Counts are aggregated before
    they are shuffled, so a hot group spreads over all tasks.
    """

    def hashed(open_: DataFrame, width: int) -> DataFrame:
        """Core and hull of the ranges of ``width`` within ``low`` to ``high`` of each row; all entries cut them at the same places."""

        def make():
            digest = xxhash.xxh3_128_digest

            def run(batch: dict) -> list:
                out: list[list] = [[] for _ in range(9)]
                for g, c, left, right, low, high, done in zip(*(batch[k] for k in ("g", "c", "l", "r", "low", "high", "done"))):
                    n, text = len(left), left[::-1] + right
                    least, most = max(low, span - len(right)), min(high, n)
                    for a in range(least // width * width, most + 1, width):
                        b = a + width - 1
                        whole = least <= a and b <= most
                        row = (g, c, left, right, a, b, done, digest(text[n - a : n - b + span]), digest(text[n - b : n - a + span]) if whole else None)
                        for o, x in zip(out, row):
                            o.append(x)
                return out

            return run

        return map_batches(open_, make, "g bigint, c bigint, l binary, r binary, low int, high int, done boolean, core binary, hull binary")

    open_ = entries.select("g", "c", "l", "r", F.lit(0).alias("low"), F.lit(span).alias("high"), F.lit(False).alias("done"))
    decided = []
    for width in RANGES:
        now = materialize(hashed(open_, width), "ranges")
        # only what occurs twice is joined, so most ranges end here
        cores = now.groupBy("g", "low", "core").agg(F.count("*").alias("n_core")).filter("n_core > 1").drop("n_core")
        hulls = now.filter("hull is not null").groupBy("g", "low", "hull").agg(F.count("*").alias("n_hull"), F.min("c").alias("first")).filter("n_hull > 1")
        if width == 1:
            decided.append(now.filter("not done").join(cores, ["g", "low", "core"], "left_semi").select("g", "c", "low", "high"))
            break
        both = now.join(cores, ["g", "low", "core"], "left_semi").join(hulls, ["g", "low", "hull"], "left")
        shared = F.col("done") | F.col("first").isNotNull()
        judged = materialize(both.select("g", "c", "l", "r", "low", "high", "done", shared.alias("shared"), F.coalesce(F.col("first") == F.col("c"), F.lit(True)).alias("stays")), "ranges-judged")
        decided.append(judged.filter("shared and not done").select("g", "c", "low", "high"))
        open_ = judged.filter("not shared or stays").select("g", "c", "l", "r", "low", "high", F.col("shared").alias("done"))
    every = decided[0].union(decided[1]).union(decided[2])
    return every.groupBy("g", "c").agg(F.max("high").alias("l"), (span - F.min("low")).cast("int").alias("r"))


def shared_stretches(rows: DataFrame, span: int = SPAN, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Key, and ``stretches`` (start, end; bytes) of the row's text that together are all bytes of repeated windows."""
    found = materialize(anchor_rows(rows, span, gram), "anchors")
    n = F.sum(F.size("places"))
    per_surrounding = found.groupBy("g", "c").agg(F.min(F.struct("_id", "_h", F.get("places", F.lit(0)).alias("place"), "low", "high")).alias("at"))
    per_gram = per_surrounding.groupBy("g").agg(F.count("*").alias("_size")).filter("_size > 1")
    wanted = materialize(per_surrounding.join(per_gram, "g").select("g", "c", "_size", "at.*"), "surroundings")
    repeated = found.groupBy("g", "c").agg(n.alias("n")).filter("n > 1").select("g", "c", F.lit(span).alias("l"), F.lit(span).alias("r"))
    entries = _with_surroundings(wanted.filter(F.col("_size") <= group_rows), rows, span)
    reaches = _sorted_groups(entries, span, gram).union(repeated)
    large = wanted.filter(F.col("_size") > group_rows)
    if large.take(1):
        reaches = reaches.union(_counted_windows(_with_surroundings(large, rows, span).dropDuplicates(["g", "c"]), span))
    best = reaches.groupBy("g", "c").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    # a reach ends where the windows of the anchor end
    before, after = F.least("l", "high"), F.least("r", span - F.col("low"))
    stretches = found.join(best, ["g", "c"]).select("_id", "_h", F.transform("places", lambda p: F.struct((p - before).alias("start"), (p + after).alias("end"))).alias("s"))
    return stretches.groupBy("_id", "_h").agg(F.flatten(F.collect_list("s")).alias("stretches"))


def remove_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", keep: list[str] | None = None, span: int = SPAN, gram: int = GRAM, group_rows: int = GROUP_ROWS, with_text: bool = False) -> DataFrame:
    """``keep`` (default: the id), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, ``kept`` (bytes).

    Bytes covered by a string of ``span`` bytes that starts anywhere else too,
    in the same text or another, are removed. Texts shorter than ``span``, NULL
    and empty ones lose nothing. A row that is there twice repeats itself.
    """
    keep = keep or [ident]
    rows = keyed(docs, keep, ident, text)
    own = [f"_k{i}" for i in range(len(keep))]
    joined = _of_row(rows, shared_stretches(rows, span, gram, group_rows), "left").select(*own, "_txt", "stretches")

    def make():
        def run(batch: dict) -> list:
            out: list[list] = [[], [], [], [], []]
            for t, stretches in zip(batch["_txt"], batch["stretches"]):
                raw = t.encode()
                parts, at, removed, spans = [], 0, 0, 0
                for a, b in merged([(s["start"], min(s["end"], len(raw))) for s in stretches or ()]):
                    parts.append(raw[at:a])
                    removed, spans, at = removed + b - a, spans + 1, b
                kept = b"".join([*parts, raw[at:]])
                for o, x in zip(out, (len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    o.append(x)
            return [*(batch[c] for c in own), *out]

        return run

    kinds = ", ".join(f"{c} {joined.schema[c].dataType.simpleString()}" for c in own)
    done = map_batches(joined, make, f"{kinds}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return done.select(*(F.col(o).alias(c) for c, o in zip(keep, own)), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text)


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with touching and overlapping ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
