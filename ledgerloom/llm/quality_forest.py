"""Quality rules with an isolation forest over their statistics.

Every document gets the statistics of the usual rules. A forest of random splits
is grown on a bounded sample of the labelled documents; where most of them are
well labelled, a short path means "unlike what people kept". The cut on the path score comes from all
labelled documents, by a histogram of fixed size.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, map_text, numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
_SPACE = bytes((0x20, *range(0x09, 0x0E)))
_ONLY_SYMBOLS = bytes(c for c in range(256) if chr(c) not in SYMBOLS)
_NOT_CAPITAL = bytes(c for c in range(256) if not 65 <= c <= 90)
_ONLY_MARKS = bytes(c for c in range(256) if not (33 <= c <= 47 or 58 <= c <= 64))

#: Labelled documents the forest may be grown on (a bound on the driver's memory, not on what is judged).
SAMPLE_ROWS = 4096
TREES, TREE_ROWS = 100, 256
#: Largest part of the well-labelled documents that the cut may reject.
MAX_GOOD_LOSS = 0.005
BINS = 2000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbols", "capitals", "marks", "word_length", "distinct_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a window of eight words that the text has more than once, first ones included.

    Windows are ranked exactly by doubling: pairs of words, pairs of pairs, pairs of those.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    width = 1
    while width < WINDOW:
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank = np.unique(pair, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def repeated_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in text.encode().split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def statistics(text: str) -> list[float]:
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the ASCII white space of the rules
    n = len(words)
    dup = repeated_lines(text)
    symbols = len(raw.translate(None, _ONLY_SYMBOLS))
    chars = len(text) - len(raw) + len(raw.translate(None, _SPACE))
    upper = len(raw.translate(None, _NOT_CAPITAL)) if text.isascii() else sum(map(str.isupper, text))
    marks = len(raw.translate(None, _ONLY_MARKS))
    # short texts are drawn towards usual values, so that chance does not make them look odd
    ratios = [symbols / (n + 20), (upper + 5) / (chars + 300), (marks + 7) / (n + 50), (chars + 250) / (n + 50), len(set(words)) / max(n, 1) ** 0.8]
    return [n, chars, symbols, dup, repeated_words(words), *ratios]


def rule_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the five counts, ``base_failed`` and ``stats`` (the ratios as an array). NULL and empty texts have no words."""

    def make():
        def run(texts: list[str]) -> list:
            rows = [statistics(t) for t in texts]
            k = len(COUNTS)
            return [*([int(r[i]) for r in rows] for i in range(k)), [[float(x) for x in r[k:]] for r in rows]]

        return run

    ddl = ", ".join(f"{c} bigint" for c in COUNTS) + ", stats array<double>"
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return map_text(docs, make, ddl, keep, text).withColumn("base_failed", failed)


# ---- the forest --------------------------------------------------------------------------------

def average_path(n):
    """Mean path length of an unsuccessful search among ``n`` values."""
    n = np.maximum(np.asarray(n, float), 1)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n
    return np.where(n > 2, big, np.where(n > 1, 1.0, 0.0))


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> dict | None:
    """Trees as arrays over heap positions: split column (-1 at a leaf), split value, path length at a leaf."""
    if len(rows) < 2:
        return None
    rng, m = np.random.default_rng(seed), min(tree_rows, len(rows))
    height = max(1, int(np.ceil(np.log2(m))))
    size = 2 ** (height + 1)
    column, value, path = np.full((trees, size), -1, np.int16), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo = [(1, rows[rng.choice(len(rows), m, replace=False)], 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            wide = np.flatnonzero(high > low)
            if depth == height or len(part) < 2 or not len(wide):
                path[t, at] = depth + average_path(len(part))
                continue
            c = int(rng.choice(wide))
            v = rng.uniform(low[c], high[c])
            column[t, at], value[t, at] = c, v
            left = part[:, c] < v
            todo += [(2 * at, part[left], depth + 1), (2 * at + 1, part[~left], depth + 1)]
    return {"column": column, "value": value, "path": path, "height": height, "norm": float(average_path(m)) or 1.0}


def anomaly(forest: dict, rows: np.ndarray) -> np.ndarray:
    """Score in (0, 1): 2 to the power of minus mean path length over its norm; high is odd."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for column, value, path in zip(forest["column"], forest["value"], forest["path"]):
        at = np.ones(len(rows), np.int64)
        for _ in range(forest["height"]):
            c = column[at]
            inner = c >= 0
            if not inner.any():
                break
            right = rows[every, np.maximum(c, 0)] >= value[at]
            at = np.where(inner, 2 * at + right, at)
        total += path[at]
    return 2.0 ** (-total / len(forest["column"]) / forest["norm"])


def score(stats: DataFrame, forest: dict | None) -> DataFrame:
    """``stats`` plus ``score``; without a forest every score is 0."""
    if forest is None:
        return stats.withColumn("score", F.lit(0.0))
    names = stats.columns

    def make():
        def run(batch: dict) -> list:
            rows = np.array(batch["stats"], float).reshape(-1, len(RATIOS))
            return [*(batch[c] for c in names), anomaly(forest, rows)]

        return run

    return map_batches(stats, make, stats.withColumn("score", F.lit(0.0)).schema)


def cut_from(histogram: list[tuple[int, int, int]], max_good_loss: float = MAX_GOOD_LOSS) -> float:
    """The cut on the score: among those that reject at most the given part of the good, the one that rejects most of the bad.

    ``histogram`` has (bin, good, bad). No good or no bad labels: nothing is rejected.
    """
    good, bad = sum(g for _, g, _ in histogram), sum(b for *_, b in histogram)
    best, lost, caught, most = 1.0, 0, 0, 0
    if not good or not bad:
        return best
    for k, g, b in sorted(histogram, reverse=True):
        lost, caught = lost + g, caught + b
        if lost > max_good_loss * good:
            break
        if caught - lost > most:
            best, most = k / BINS, caught - lost
    return best


def judge_quality(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, ident: str = "doc_id", text: str = "text", quality: str = "quality", sample_rows: int = SAMPLE_ROWS, max_good_loss: float = MAX_GOOD_LOSS) -> DataFrame:
    """``keep`` (default: the id), the counts, ``base_failed``, ``score`` and ``kept``.

    ``labels`` has the id and ``quality`` (1 good, 0 bad); several labels of a
    document count as their least, NULL labels as none. Repeated documents are
    judged row by row; without usable labels the base rules decide alone.
    """
    keep = keep or [ident]
    own = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(ident).alias("_id"), F.col(text).alias("_txt"))
    stats = numbered(rule_statistics(source, [*own, "_id"], "_txt"), "quality")
    known = labels.filter(f"{ident} is not null and {quality} is not null").groupBy(F.col(ident).alias("_id")).agg(F.min(quality).alias("_label"))
    labelled = stats.filter("not base_failed").select("_id", "stats").join(known, "_id")
    # the sample is the same at every run: the rows with the least digests of their statistics and id
    sample = labelled.select("stats", F.xxhash64("_id", "stats").alias("_h")).orderBy("_h").limit(sample_rows).select("stats")
    forest = grow(np.array([r[0] for r in sample.collect()], float).reshape(-1, len(RATIOS)))
    bins = score(labelled, forest).groupBy(F.floor(F.col("score") * BINS).cast("int").alias("bin")).agg(F.count_if(F.col("_label") == 1).alias("good"), F.count_if(F.col("_label") == 0).alias("bad"))
    cut = cut_from([tuple(r) for r in bins.collect()], max_good_loss)
    scored = score(stats, forest)
    return scored.select(
        *(F.col(o).alias(c) for c, o in zip(keep, own)), *COUNTS, "base_failed", "score",
        (~F.col("base_failed") & (F.floor(F.col("score") * BINS) < F.lit(round(cut * BINS)))).alias("kept"))
