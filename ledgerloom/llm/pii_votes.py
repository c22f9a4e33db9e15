"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Fixed patterns give the base spans, which stay. Looser patterns give further
candidates. Labelers (strict pattern, gazetteer, context, layout) vote on all
of them; expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, and its posteriors train a logistic classifier on the
features of a span, which decides about the further candidates. Texts are handled
by DataFrame functions only; what reaches the driver are counts of patterns, of
which there is a fixed number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.session import materialize

KINDS = ("email", "ip", "card", "phone", "mail_like", "number_like")

#: The base patterns. Possessive quantifiers and the look-behind change no match; they keep long runs linear.
_LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns: addresses written out, and runs of digits laid out like a phone or card number.
LOOSE = {
    "mail_like": rf"(?i)(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++(?:\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\.)[A-Za-z0-9-]++)++|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)",
    "number_like": r"(?:\G|(?<![0-9A-Za-z]))\(?[0-9](?:[\x20().-]{0,2}[0-9])++",
}
#: What a text must hold for a pattern to be tried: cheap, and never wrong.
NEEDS = {
    "email": lambda t: F.instr(t, "@") > 0, "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"), "mail_like": lambda t: t.rlike(r"(?i)[(\[\x20]at[)\]\x20]") & t.rlike(r"(?i)dot|\."), "number_like": lambda t: t.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){8}"),
}

#: Gazetteers and context words of the labelers.
TOP_DOMAINS = ("com", "net", "org", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
DIAL_CODES = r"^\+?(?:1|33|34|44|49|39|31|41|43|32|351|46|47|48|52|54|55|61|64|65|81|82|86|91|237)"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CONTEXT = r"(?i)(?:e-?mail|mail|write|contact|phone|tel|call|mobile|fax|card|visa|account|iban|ssn|ip|address|correo|telefon|carte|karte|tarjeta)[^\n]{0,12}$"
LABELERS = ("strict", "gazetteer", "context", "layout")
BEFORE = 32
EM_ROUNDS = 50


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right is doubled."""
    parts = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def accepted(kind: Column, m: Column) -> Column:
    """The conditions that a base match must meet."""
    d = digits_of(m)
    n = F.length(d)
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    return F.when(kind == "email", True).when(kind == "ip", small).when(kind == "card", F.when(n.between(14, 19), luhn(d)).otherwise(False)).when(kind == "phone", n.between(10, 15)).otherwise(False)


def found_in(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, m, gap, before): matches, the code points between them, and what stands just before."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.struct(F.lit(kind).alias("kind"), m.alias("m"), F.char_length(p).alias("gap"), F.right(p, F.lit(BEFORE)).alias("before")))
    return F.when(NEEDS[kind](text), rows)


def matches(docs: DataFrame, ids: list[str], text: str) -> DataFrame:
    """Rows of ``docs`` with a number, ``ids`` and the matches of every pattern, without the texts; written once."""
    t = F.coalesce(F.col(text), F.lit(""))
    columns = {f"_{k}": found_in(t, k, p) for k, p in (BASE | LOOSE).items()}
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()).select("_row", *ids, *(c.alias(n) for n, c in columns.items())), "pii-matches")


def spans(found: DataFrame) -> DataFrame:
    """``_row``, ``kind``, ``m``, ``before``, ``start``, ``end`` (code points, end exclusive) of every match, kept or not."""
    parts = [found.select("_row", F.posexplode(F.col(f"_{k}")).alias("i", "x")) for k in KINDS]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    flat = rows.select("_row", "i", "x.*")
    end = F.sum(F.col("gap") + F.char_length("m")).over(W.partitionBy("_row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0))
    return flat.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.char_length("m")).drop("gap", "i")


# ---- votes, EM, classifier ---------------------------------------------------------------------

def votes(kind: Column, m: Column, before: Column) -> dict[str, Column]:
    """1 for, 0 against, NULL no vote."""
    d = digits_of(m)
    n = F.length(d)
    written = m
    m = F.when(kind == "mail_like", F.regexp_replace(F.regexp_replace(m, r"(?i)\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?", "@"), r"(?i)\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?", ".")).otherwise(m)
    mail = kind.isin("email", "mail_like")
    number = kind.isin("card", "phone", "number_like")
    domain = F.lower(F.regexp_extract(m, r"([A-Za-z0-9]+)$", 1))
    strict = F.when(mail, m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")).when(kind == "ip", True).when(kind == "card", True).when(
        number, F.when(n.between(14, 19), luhn(d)).otherwise(n.between(10, 13)))
    gazetteer = F.when(mail, domain.isin(*TOP_DOMAINS)).when(number, F.when(n >= 14, d.rlike(ISSUERS)).when(m.startswith("+"), m.rlike(DIAL_CODES))).when(kind == "ip", ~m.rlike(r"^0"))
    context = F.when(before.rlike(CONTEXT), True)
    layout = F.when(number, m.rlike(r"^\+?[0-9]{0,3}[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}$") | m.rlike(r"^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}$") | ((n == 16) & m.rlike(r"^[0-9]+$"))).when(
        kind == "email", ~written.rlike(r"[.%+-]@"))
    return {k: v.cast("int") for k, v in zip(LABELERS, (strict, gazetteer, context, layout))}


def expectation_maximisation(patterns: list[tuple[tuple, float]], rounds: int = EM_ROUNDS) -> tuple[dict, list[tuple[float, float]], float]:
    """Posterior of each vote pattern, (rate for positives, rate for negatives) of each labeler, and the prior.

    ``patterns`` has the votes of all labelers and a count. Starts from the share of votes in favour.
    """
    if not patterns:
        return {}, [], 0.5
    k = len(patterns[0][0])
    post = {v: (sum(x for x in v if x is not None) + 0.5) / (sum(x is not None for x in v) + 1) for v, _ in patterns}
    rates, prior = [], 0.5
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = min(0.99, max(0.01, (sum(post[v] * n for v, n in patterns) + 1) / (total + 2)))
        rates = []
        for j in range(k):
            pos = [(v[j], post[v] * n) for v, n in patterns if v[j] is not None]
            neg = [(v[j], (1 - post[v]) * n) for v, n in patterns if v[j] is not None]
            rates.append(tuple((sum(w * x for x, w in part) + a) / (sum(w for _, w in part) + 4) for part, a in ((pos, 3), (neg, 1))))
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for x, (p, q) in zip(v, rates):
                if x is not None:
                    odds += math.log(p / q) if x else math.log((1 - p) / (1 - q))
            post[v] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    return post, rates, prior


#: Features of the classifier: votes for and against, and the number of digits in four ranges.
DIGIT_RANGES = ((9, 10), (11, 13), (14, 16), (17, 99))


def features(kind: Column, m: Column, vote: dict[str, Column]) -> list[Column]:
    n = F.length(digits_of(m))
    out = [F.lit(1)]
    for k in LABELERS:
        out += [F.when(vote[k] == 1, 1).otherwise(0), F.when(vote[k] == 0, 1).otherwise(0)]
    number = kind.isin("card", "phone", "number_like")
    return out + [F.when(number & n.between(a, b), 1).otherwise(0) for a, b in DIGIT_RANGES] + [F.when(m.rlike(r"[\x20()-]"), 1).otherwise(0)]


def train_logistic(rows: list[tuple[tuple, float, float]], steps: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> list[float]:
    """Weights from (features, posterior, count) by gradient steps; ``rows`` are patterns, a fixed number of them."""
    if not rows:
        return []
    w, total = [0.0] * len(rows[0][0]), sum(n for *_, n in rows)
    for _ in range(steps):
        g = [ridge * x for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(w, x))))))
            for j, a in enumerate(x):
                if a:
                    g[j] += (p - y) * n / total * a
        w = [a - rate * b for a, b in zip(w, g)]
    return w


def find_personal_data(docs: DataFrame, ident: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id), ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``n_added``.

    Every row of ``docs`` gets a row; NULL and empty texts have no spans. Base
    spans are kept as matched, so kinds may overlap; an added span overlaps no
    base span.
    """
    keep = keep or [ident]
    own = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(text).alias("_txt"))
    rows = matches(source, own, "_txt")
    kind, m = F.col("kind"), F.col("m")
    all_spans = spans(rows)
    vote = votes(kind, m, F.col("before"))
    is_base = kind.isin(*BASE)
    number = F.length(digits_of(m)).between(9, 19)
    candidates = materialize(all_spans.withColumn("base", is_base).filter(F.when(is_base, accepted(kind, m)).otherwise((kind == "mail_like") | number))
                             .withColumns({f"v_{k}": v for k, v in vote.items()}).withColumn("f", F.array(*features(kind, m, vote))).drop("m", "before"), "pii-candidates")
    names = [f"v_{k}" for k in LABELERS]
    counted = candidates.groupBy(*names, "f").agg(F.count("*").alias("n")).collect()  # votes and features take a fixed number of values
    patterns: dict[tuple, float] = {}
    for r in counted:
        v = tuple(r[k] for k in names)
        patterns[v] = patterns.get(v, 0) + r["n"]
    post, _, _ = expectation_maximisation(sorted(patterns.items(), key=str))
    weights = train_logistic(sorted((tuple(r["f"]), post[tuple(r[k] for k in names)], r["n"]) for r in counted))
    odds = F.lit(0.0)
    for j, w in enumerate(weights):
        odds = odds + F.get("f", F.lit(j)) * w
    # overlaps with base spans: the furthest end before, and the nearest begin after
    place = W.partitionBy("_row").orderBy("start", "end", "kind")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(place.rowsBetween(W.unboundedPreceding, -1))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(W.partitionBy("_row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1))
    free = F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("end"), F.lit(True))
    marked = candidates.withColumns({"free": free, "yes": odds > 0}).filter("base or (free and yes)")
    rank = F.element_at(F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i)))), kind)
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    text_of = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    per_row = marked.groupBy("_row").agg(
        *(F.count_if(kind == k).alias(f"n_{k}") for k in BASE), F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("b"), F.sort_array(F.collect_list(span)).alias("a"), F.count_if(~F.col("base")).alias("n_added"))
    zero = F.lit(0).cast("bigint")
    return rows.select("_row", *own).join(per_row, "_row", "left").select(
        *(F.col(o).alias(c) for c, o in zip(keep, own)), *(F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce(text_of("b"), F.lit("")), 256).alias("base_sha256"), F.coalesce(text_of("a"), F.lit("")).alias("spans"), F.coalesce("n_added", zero).alias("n_added"))
