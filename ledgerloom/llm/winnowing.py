"""Benchmark decontamination by winnowing.

Of every ``window - gram + 1`` neighbouring grams the one with the least hash is
a fingerprint (leftmost of equal ones), so two texts that share ``window`` words
share a fingerprint inside them. Fingerprints of documents and benchmark items
are joined, and each hit is extended: the windows that hold it are compared word
by word with the items' windows. Everything is built from DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize

WINDOW = 13
GRAM = 8
#: A document is contaminated if at least one of so many of its words is hit.
SHARE = 20
#: What stands between words, once A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Low bits of a key that hold a position.
_POSITION_BITS = 31


def words_of(text: Column) -> Column:
    """Words of the whole text, A-Z in lower case; NULL has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fingerprints(words: Column, window: int, gram: int) -> Column:
    """Array of (fp, pos) of the winnowed grams; positions count from 1. Empty for texts of fewer words than ``window``.

    A key has the high bits of a gram's hash above its position, so the least key
    of a stretch is its leftmost gram of least hash. Items are read one by one
    rather than cut out as arrays, which costs half.
    """
    width = window - gram + 1

    def hashed(w: Column, i: Column) -> Column:
        return F.xxhash64(*(F.get(w, i + j) for j in range(gram)))

    def chosen(w: Column) -> Column:
        high = F.lit(-1 << _POSITION_BITS)
        places = F.sequence(F.lit(0), F.size(w) - gram)
        keys = F.transform(places, lambda i: hashed(w, i).bitwiseAND(high).bitwiseOR(i.cast("bigint")))
        least = keys if width == 1 else let(keys, lambda k: F.transform(F.sequence(F.lit(0), F.size(k) - width), lambda i: F.least(*(F.get(k, i + j) for j in range(width)))))
        fresh = let(least, lambda m: F.filter(m, lambda x, i: (i == 0) | (F.get(m, i - 1) != x)))
        place = lambda x: x.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")
        return F.transform(fresh, lambda x: F.struct(hashed(w, place(x)).alias("fp"), (place(x) + 1).alias("pos")))

    empty = F.array().cast("array<struct<fp:bigint,pos:int>>")
    return let(words, lambda w: F.when(F.size(w) >= window, chosen(w)).otherwise(empty))


def windows_of(words: Column, window: int) -> Column:
    """All windows as strings of words with single spaces."""
    return let(words, lambda w: F.when(F.size(w) >= window, F.transform(F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.array_join(F.slice(w, i, F.lit(window)), " "))).otherwise(F.array().cast("array<string>")))


def item_windows(items: DataFrame, ident: str, text: str, window: int = WINDOW) -> DataFrame:
    """``item``, ``len`` (words of a window) and ``win``: an item of fewer words, but not none, is one window."""
    w = items.select(F.col(ident).cast("string").alias("item"), words_of(F.col(text)).alias("w")).filter(F.size("w") > 0)
    long = w.select("item", F.lit(window).alias("len"), F.explode(windows_of(F.col("w"), window)).alias("win"))
    short = w.filter(F.size("w") < window).select("item", F.size("w").alias("len"), F.array_join("w", " ").alias("win"))
    return long.union(short).distinct()


def _marked(docs: DataFrame, windows: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Key, ``len`` and ``pos`` of every fingerprint that an item has too, and for each document a row with ``len`` 0 whose ``pos`` is its number of words.

    One pass over the texts, whatever the number of window lengths.
    """
    marks = None
    for n in lengths:
        wanted = windows.filter(F.col("len") == n).select(F.explode(fingerprints(F.split("win", " "), n, min(gram, n))).alias("f")).select("f.fp", F.lit(n).alias("len"))
        marks = wanted if marks is None else marks.union(wanted)

    def of_length(w: Column, n: int) -> Column:
        return F.transform(fingerprints(w, n, min(gram, n)), lambda f: F.struct(f["fp"].alias("fp"), F.lit(n).alias("len"), f["pos"].alias("pos")))

    def all_of(w: Column) -> Column:
        # no mark has length 0; the hash of the text spreads these rows
        size = F.array(F.struct(F.col("_h").alias("fp"), F.lit(0).alias("len"), F.size(w).alias("pos")))
        return F.concat(size, *(of_length(w, n) for n in lengths))

    spread = docs.select("_id", "_h", F.explode(let(words_of(F.col("_txt")), all_of)).alias("f")).select("_id", "_h", "f.*")
    if marks is None:
        return spread.drop("fp")
    known = marks.distinct().withColumnsRenamed({"fp": "_fp", "len": "_len"})
    joined = spread.join(known, (spread["fp"] == known["_fp"]) & (spread["len"] == known["_len"]), "left")
    return joined.filter("_fp is not null or len = 0").select("_id", "_h", "len", "pos")


def _extended(docs: DataFrame, marked: DataFrame, windows: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Key, ``start``, ``len`` and ``win`` of every window of an item found around a mark, compared word by word."""
    per_doc = marked.filter("len > 0").groupBy("_id", "_h").agg(F.collect_set(F.struct("len", "pos")).alias("at")).withColumnsRenamed({"_id": "_rid", "_h": "_rh"})
    texts = docs.join(per_doc, docs["_id"].eqNullSafe(per_doc["_rid"]) & (docs["_h"] == per_doc["_rh"]), "inner")

    def of_length(w: Column, n: int) -> Column:
        width = n - min(gram, n) + 1
        places = F.filter("at", lambda x: x["len"] == n)
        starts = F.flatten(F.transform(places, lambda x: F.sequence(F.greatest(F.lit(1), x["pos"] - width + 1), F.least(x["pos"], F.size(w) - n + 1))))
        return F.transform(F.array_distinct(starts), lambda s: F.struct(s.alias("start"), F.lit(n).alias("len"), F.array_join(F.slice(w, s, F.lit(n)), " ").alias("win")))

    def around(w: Column) -> Column:
        return F.concat(*(of_length(w, n) for n in lengths))

    spread = texts.select("_id", "_h", F.explode(let(words_of(F.col("_txt")), around)).alias("x")).select("_id", "_h", "x.*")
    return spread.join(windows.select("win", "len").distinct(), ["win", "len"], "left_semi").select("_id", "_h", "start", "len", "win")


def contamination(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM, share: int = SHARE) -> DataFrame:
    """``keep`` (default: the id), ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A word is hit if it lies in an occurrence of an item's window. NULL and empty
    texts have no words and no hits; without items nothing is hit. Rows alike in
    id and text share their result. Items that repeat a text all count.
    """
    keep = keep or [ident]
    own = [f"_k{i}" for i in range(len(keep))]
    txt = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(ident).alias("_id"), F.xxhash64(txt).alias("_h"), txt.alias("_txt"))
    windows = materialize(item_windows(items, item, item_text, window), "item-windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # ``window`` lengths at most
    key = ["_id", "_h"]
    texts = rows.select(*key, "_txt")
    marked = materialize(_marked(texts, windows, lengths, gram), "marked")
    n_words = marked.filter("len = 0").groupBy(*key).agg(F.max("pos").alias("n_words"))
    if lengths:
        hits = materialize(_extended(texts, marked, windows, lengths, gram).distinct(), "hits")
    else:
        hits = marked.limit(0).select(*key, F.lit(0).alias("start"), "len", F.lit("").alias("win"))
    # the words covered: windows in order of their start, each adding what lies beyond those before
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "len"))), F.struct(F.lit(0).alias("n"), F.lit(1).alias("reach")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["start"] + x["len"] - F.greatest(a["reach"], x["start"]))).alias("n"), F.greatest(a["reach"], x["start"] + x["len"]).alias("reach")),
        lambda a: a["n"])
    per_doc = hits.groupBy(*key).agg(covered.alias("n_hit"))
    named = hits.select(*key, "win").distinct().join(windows.select("item", "win"), "win").groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    def with_key(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnsRenamed({"_id": "_rid", "_h": "_rh"})
        return left.join(r, left["_id"].eqNullSafe(r["_rid"]) & (left["_h"] == r["_rh"]), "left").drop("_rid", "_rh")

    # three small tables of the same key, put together before they meet the documents
    results = with_key(with_key(n_words, per_doc), named)
    joined = with_key(rows.drop("_txt"), results)
    n_words, n_hit = F.col("n_words").cast("bigint"), F.coalesce("n_hit", F.lit(0)).cast("bigint")
    found = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        *(F.col(o).alias(c) for c, o in zip(keep, own)), n_words.alias("n_words"), n_hit.alias("n_hit"), F.size(found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"), ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"))
