"""Secrets told apart by how many owners hold them.

Every whole text is scanned for credential shapes. The digest of each candidate
value is counted over the corpus by distinct owners and repositories: a value
that many owners hold is a copied example, one that stays with few owners and
looks random is a live credential. The scan's own spans stay whatever the count
says; ``token`` spans (random-looking values outside them) are added if live.
``owned_spans`` follows the count for both, so that only these need be removed.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections import Counter

import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, map_text, numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The shapes, their order, and the least length of what counts.
ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need not be built
KINDS = ("assign", "access", "hex", "token")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: A value with more owners than this is a copied example.
MAX_OWNERS = 2
#: So is one that stands in more repositories than this for each of its owners.
MAX_REPOSITORIES = 50
#: Bits of Shannon entropy per character from which a value looks random.
MIN_ENTROPY = 3.0


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    """Letters and digits mixed, and no short alphabet."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value), sorted; spans cover whole matches, offsets in code points."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def candidates(text: str, base: list[tuple]) -> list[tuple[int, int, int, str]]:
    """Values to count: those of the base spans, and random-looking ones outside them."""
    extra, at = [], 0
    ends = sorted((s, e) for s, _, e, _ in base)
    for m in TOKEN.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        if (at == len(ends) or ends[at][0] >= m.end()) and looks_live(m[0]):
            extra.append((m.start(), 3, m.end(), m[0]))
    return sorted([*base, *extra])


SCAN = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, found array<struct<kind:int,start:int,stop:int,digest:string,live:boolean>>"


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the counts and digest of the base spans, and all candidates with their value's digest."""

    def make():
        def run(texts: list[str]) -> list:
            counts, shas, found = ([], [], []), [], []
            for t in texts:
                base = base_spans(t)
                kinds = Counter(k for _, k, *_ in base)
                for k in range(3):
                    counts[k].append(kinds[k])
                shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
                found.append([{"kind": k, "start": s, "stop": e, "digest": xxhash.xxh3_128_hexdigest(v), "live": looks_live(v)} for s, k, e, v in candidates(t, base)])
            return [*counts, shas, found]

        return run

    return map_text(docs, make, SCAN, keep, text)


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """Distinct owners and repositories of each digest. Counted in two steps, so that a value held by all spreads over its holders."""
    pairs = found.groupBy("digest", owner, repository).agg(F.count("*").alias("_n"))
    owners = pairs.groupBy("digest", owner).agg(F.count("*").alias("_repositories"), F.sum("_n").alias("_n"))
    return owners.groupBy("digest").agg(F.count("*").alias("n_owners"), F.sum("_repositories").alias("n_repositories"), F.sum("_n").alias("n_found"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", ident: str = "doc_id", text: str = "text", keep: list[str] | None = None, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``keep`` (default: the id), counts and digest of base spans, ``spans``, ``owned_spans`` (those that are no copied examples), and how many candidates are live or examples.

    A value is a copied example if more than ``max_owners`` owners hold it, or if
    it stands in more than ``max_repositories`` repositories for each owner.
    NULL and empty texts have no spans; repeated rows get a row each. Owners and
    repositories that are NULL count as one of their own.
    """
    keep = keep or [ident]
    own = [f"_k{i}" for i in range(len(keep))]
    base = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(owner).alias("_owner"), F.col(repository).alias("_repository"), F.col(text).alias("_txt"))
    rows = numbered(scan(base, [*own, "_owner", "_repository"], "_txt"), "secret-scan")
    found = rows.filter(F.size("found") > 0).select("_row", "_owner", "_repository", F.inline("found"))
    held = ownership(found.select("digest", "_owner", "_repository"), "_owner", "_repository")
    example = (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories * F.col("n_owners"))
    judged = found.join(held, "digest").select("_row", "kind", "start", "stop", example.alias("example"), "live")
    live = F.col("live") & ~F.col("example")
    shown = F.when((F.col("kind") < 3) | live, F.struct("start", "kind", "stop"))
    owned = F.when(((F.col("kind") < 3) | F.col("live")) & ~F.col("example"), F.struct("start", "kind", "stop"))
    per_row = judged.groupBy("_row").agg(F.sort_array(F.collect_list(shown)).alias("_spans"), F.sort_array(F.collect_list(owned)).alias("_owned"), F.count_if(live).alias("n_live"), F.count_if("example").alias("n_example"))
    names = F.array(*map(F.lit, KINDS))

    def text_of(spans: str) -> Column:
        listed = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string")))
        return F.coalesce(F.array_join(listed, ","), F.lit(""))

    return rows.join(per_row, "_row", "left").select(
        *(F.col(o).alias(c) for c, o in zip(keep, own)), "n_assign", "n_access", "n_hex", "base_sha256", text_of("_spans").alias("spans"), text_of("_owned").alias("owned_spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))


def redact(scanned: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """``scanned`` with every span (a string as above) of ``text`` replaced by ``mark``; texts without spans stay as they are."""

    def make():
        def one(t: str, listed: str) -> str:
            out, at = [], 0
            for s in filter(None, listed.split(",")):
                a, b = map(int, s.split(":")[1:])
                if a >= at:
                    out += [t[at:a], mark]
                at = max(at, b)
            return "".join([*out, t[at:]])

        def run(batch: dict) -> list:
            batch[text] = [one(t, s) if s else t for t, s in zip(batch[text], batch[spans])]
            return [batch[c] for c in names]

        return run

    names = scanned.columns
    return map_batches(scanned, make, scanned.schema)
