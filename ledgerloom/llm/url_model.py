"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule allows or blocks train a smoothed variable-order Markov model
each. Every context is mixed with the one that is a character shorter, as far as
it has been seen to go on in new ways (Witten-Bell weights), so a context seen
too seldom counts for little and one never seen for nothing. The longest context
has as many characters as the logarithm of the characters learnt from (base
``SPREAD``), so the models grow with the input in both number and length.

The models are a table with a row for each gram (a context and the character
after it). Windows, the longest grams at each place of a URL, are counted first;
shorter grams are sums over windows, and the probabilities of a length are the
counts of that length joined with the probabilities of the length below. No join
or window has a key with more rows than there are different characters. The
score of a URL is its mean log-likelihood difference per character; the cut
between allow and block is calibrated on all URLs with a rule, scored by models
trained on the other half of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import numbered
from ledgerloom.session import materialize

#: Fixed values of the rules: (verdict, rule); a rule is a host, then the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands before the first character.
MARK = "\x02"
#: Likely characters after a context: contexts of k characters are worth counting from SPREAD ** k characters on.
SPREAD = 4
#: Log ratios are whole multiples of 1 / UNIT, so that sums are the same in any order.
UNIT = 1 << 32
#: A window with over one HOT-th of all places is hot; there are fewer than HOT of them.
HOT = 10_000
#: Bins of the calibration histogram over scores between -LIMIT and LIMIT.
BINS, LIMIT = 4000, 8.0
#: Counts of each training set: allowed and blocked URLs of either half, and of both.
SETS = ("0", "1", "all")


def host_of(url: Column) -> tuple[Column, Column]:
    """Host and path; NULL or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL without one."""
    rule = verdict = None
    for says, r in sorted(rules, key=lambda x: (-len(x[1]), x[1])):
        name, _, begins = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + begins)
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)


def longest_context(characters: int) -> int:
    """Characters of context that so many characters support."""
    depth = 0
    while SPREAD ** (depth + 1) <= characters:
        depth += 1
    return depth


def windows(urls: DataFrame, depth: int, *keep: str) -> DataFrame:
    """``keep`` and ``gram`` for every character of ``u``: it and up to ``depth`` before it."""
    signs = F.split(F.concat(F.lit(MARK), F.col("u")), "")
    places = urls.filter("u <> ''").select(*keep, signs.alias("signs"))
    # slices of an array of characters: a place costs the same at the end of a long URL as at its beginning
    start = lambda i: F.greatest(F.lit(1), i - depth)
    grams = F.transform(F.sequence(F.lit(2), F.size("signs")), lambda i: F.array_join(F.slice("signs", start(i), i - start(i) + 1), ""))
    return places.select(*keep, F.explode(grams).alias("gram"))


def count_grams(urls: DataFrame, depth: int) -> DataFrame:
    """Every gram of ``urls``: ``size`` (characters), ``places``, and how often each verdict has it in each half.

    ``a0`` and ``a1`` count allowed URLs with a rule, ``b0`` and ``b1`` blocked
    ones; grams of URLs without a rule are there with zeros.
    """
    says = [("a", "allow"), ("b", "block")]
    counts = [F.count_if((F.col("said") == verdict) & (F.col("half") == h)).alias(f"{v}{h}") for v, verdict in says for h in (0, 1)]
    names = [f"{v}{h}" for v, _ in says for h in (0, 1)]
    longest = windows(urls, depth, "said", "half").groupBy("gram").agg(F.count(F.lit(1)).alias("places"), *counts)
    n = F.char_length("gram")
    shorter = longest.withColumn("size", F.explode(F.sequence(F.lit(1), n)))
    # places belong to the window itself, counts to all grams it ends with
    parts = shorter.withColumn("whole", F.col("size") == n).withColumn("gram", F.right("gram", F.col("size"))).withColumn("places", F.when(F.col("whole"), F.col("places")).otherwise(0))
    return materialize(parts.groupBy("gram", "size").agg(F.sum("places").alias("places"), *(F.sum(c).alias(c) for c in names)), "url-grams")


def log_ratios(grams: DataFrame, depth: int) -> DataFrame:
    """``gram``, ``places`` and, for each training set, the log ratio ``r`` of allowed to blocked for every window.

    A context that a model never saw leaves the probability to the shorter one;
    the shortest, of no character, leaves the rest to all characters alike.
    """
    alike = 1.0 / max(grams.filter("size = 1").count(), 1)
    context = Window.partitionBy("size", F.left("gram", F.col("size") - 1))  # as many rows as there are characters at most
    whole = grams.withColumns({f"{v}all": F.col(f"{v}0") + F.col(f"{v}1") for v in "ab"})
    models = [f"{v}{s}" for v in "ab" for s in SETS]
    seen = {f"n_{c}": F.sum(c).over(context) for c in models} | {f"t_{c}": F.count_if(F.col(c) > 0).over(context) for c in models}
    ready = materialize(whole.withColumns(seen), "url-contexts")

    def mixed(c: str, lower: Column) -> Column:
        return F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * lower) / (F.col(f"n_{c}") + F.col(f"t_{c}"))).otherwise(lower)

    levels: list[DataFrame] = []
    for size in range(1, depth + 2):
        level = ready.filter(F.col("size") == size)
        if levels:
            below = levels[-1].select(F.col("gram").alias("end"), *(F.col(f"p_{c}").alias(f"q_{c}") for c in models))
            level = level.join(below, F.right("gram", F.lit(size - 1)) == F.col("end"))
        p = [mixed(c, F.col(f"q_{c}") if levels else F.lit(alike)).alias(f"p_{c}") for c in models]
        levels.append(materialize(level.select("gram", "places", *p), "url-level"))
    ratios = [F.floor(F.log(F.col(f"p_a{s}") / F.col(f"p_b{s}")) * UNIT).alias(f"r{s}") for s in SETS]
    return reduce(DataFrame.unionByName, levels).filter("places > 0").select("gram", "places", *ratios)


def scored(urls: DataFrame, ratios: DataFrame, depth: int) -> DataFrame:
    """``_row`` and ``score``: by the half it was not in for a URL with a rule, by all URLs with a rule for any other."""
    places = windows(urls.withColumn("by", F.when(F.col("said").isNull(), "all").otherwise((1 - F.col("half")).cast("string"))), depth, "_row", "by")
    total = ratios.agg(F.sum("places")).first()[0] or 0
    # fewer than HOT windows can have so many places; a window that is in millions of URLs meets them where they are
    hot = F.broadcast(materialize(ratios.filter(F.col("places") * HOT > total), "url-hot"))
    rest = ratios.filter(F.col("places") * HOT <= total)
    met = places.join(hot, "gram").unionByName(places.join(hot.select("gram"), "gram", "left_anti").join(rest, "gram"))
    ratio = reduce(lambda out, s: out.when(F.col("by") == s, F.col(f"r{s}")), SETS[1:], F.when(F.col("by") == SETS[0], F.col(f"r{SETS[0]}")))
    return met.groupBy("_row").agg((F.sum(ratio) / F.count(F.lit(1)) / UNIT).alias("score"))


def cut_from(histogram: list[tuple[int, int, int]]) -> float:
    """The score from which URLs are allowed: best mean of both classes' shares of right answers; (bin, allowed, blocked)."""
    allowed, blocked = sum(a for _, a, _ in histogram), sum(b for *_, b in histogram)
    best, cut, a_below, b_below = -1.0, 0.0, 0, 0
    if not allowed or not blocked:
        return cut
    for k, a, b in sorted(histogram):
        quality = (allowed - a_below) / allowed + b_below / blocked
        if quality > best:
            best, cut = quality, k * 2 * LIMIT / BINS - LIMIT
        a_below, b_below = a_below + a, b_below + b
    return cut


def halved(urls: DataFrame) -> DataFrame:
    """``urls`` plus ``half``: by host and first part of the path, so that a site is never on both sides; by the whole URL if a side then lacks a verdict."""
    site = F.xxhash64("host", F.regexp_extract("path", r"^/[^/]*/?", 0))
    by = [F.pmod(digest, F.lit(2)).cast("int") for digest in (site, F.xxhash64("u"))]
    learnt = urls.filter("said is not null and u <> ''")
    sides = learnt.select(by[0].alias("half"), "said").distinct().count()
    return urls.withColumn("half", by[0] if sides == 4 else by[1])


def filter_urls(pages: DataFrame, ident: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``ident``, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    What no rule decides is decided by the models, on the URL after its scheme,
    A-Z in lower case. A NULL or empty URL is blocked, as there is nothing to
    fetch, and has no score. If the rules leave one of the verdicts without any
    example there is nothing to compare: the rest is allowed. Repeated URLs count
    as often as they occur, rows of a NULL id are judged like others, and further
    columns are not looked at.
    """
    host, path = host_of(F.col(url))
    rest = F.translate(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[^:/?#]*://", ""), UPPER, LOWER)
    base = pages.select(F.col(ident).alias("_id"), host.alias("host"), path.alias("path"), rest.alias("u"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = numbered(halved(materialize(base.withColumns({"rule": rule, "said": verdict}), "urls")), "halves")
    learnt = {r["said"]: r["n"] for r in judged.filter("said is not null and u <> ''").groupBy("said").agg(F.sum(F.char_length("u")).alias("n")).collect()}
    if len(learnt) < 2:
        own = F.when(F.col("u") == "", "block").otherwise("allow")
        return judged.select(F.col("_id").alias(ident), "host", "path", "rule", F.coalesce("said", own).alias("verdict"), F.lit(None).cast("double").alias("score"))
    depth = longest_context(sum(learnt.values()))
    ratios = materialize(log_ratios(count_grams(judged, depth), depth), "url-ratios")
    result = materialize(judged.join(scored(judged, ratios, depth), "_row", "left"), "url-scores")
    place = F.floor((F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) + LIMIT) / (2 * LIMIT) * BINS).cast("int")
    known = result.filter("said is not null and score is not null")
    bins = known.groupBy(place.alias("bin")).agg(F.count_if(F.col("said") == "allow").alias("a"), F.count_if(F.col("said") == "block").alias("b")).collect()
    cut = cut_from([tuple(r) for r in bins])
    own = F.when(F.col("u") == "", "block").when(F.col("score") >= cut, "allow").otherwise("block")
    return result.select(F.col("_id").alias(ident), "host", "path", "rule", F.coalesce("said", own).alias("verdict"), "score")
