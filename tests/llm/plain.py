"""The contracts of the training-data queries, written plainly for one machine: what the Spark jobs must equal."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import string
from collections import Counter

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def repeats(docs, span=400):
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + span] for d in raw for i in range(len(d) - span + 1))
    out = []
    for (i, _), d in zip(docs, raw):
        hit = bytearray(len(d))
        for k in range(len(d) - span + 1):
            if seen[d[k : k + span]] > 1:
                hit[k : k + span] = b"\1" * span
        kept = bytes(b for b, h in zip(d, hit) if not h)
        out.append((i, len(d), sum(hit), len(re.findall(b"\1+", bytes(hit))), sha(kept)))
    return out


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def url(u):
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def secrets(t):
    t = t or ""
    out = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    out.sort()
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in out]


def quality(t):
    t = t or ""
    words = SPACE.findall(t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if SPACE.search(x):
            dup += x in seen
            seen.add(x)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def fingerprint(t):
    words = SPACE.findall(lower(t))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, seed=42) >> b & 1)
    return sum(1 << b for b, c in counts.items() if 2 * c > len(shingles))


def components(ids, prints, budget=4):
    up = {i: i for i in range(len(ids))}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= budget:
            a, b = find(i), find(j)
            up[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def luhn(d):
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def personal(t):
    t, out = t or "", []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    out.sort()
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in out]


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(text, items):
    words = WORDS.findall(lower(text))
    hit, named = set(), set()
    for i, item in items:
        w = WORDS.findall(lower(item))
        n = min(13, len(w))
        wins = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in wins:
                hit |= set(range(k, k + n))
                named.add(str(i))
    return len(words), len(hit), len(named), sha(",".join(sorted(named))), bool(hit) and 20 * len(hit) >= len(words)


def url_verdicts(urls):
    """(verdict, score) of every URL: rules, then two Witten-Bell models held in dictionaries."""
    rows = []
    for u in urls:
        host, path, rule, verdict = url(u)
        rest = re.sub(r"^[^:/?#]*://", "", u or "").translate(SMALL)
        first = re.match(r"/[^/]*/?", path)
        site = xxhash.xxh64_intdigest(first[0] if first else "", seed=xxhash.xxh64_intdigest(host, seed=42))
        rows.append([rest, verdict, site & 1])
    learnt = [r for r in rows if r[1] and r[0]]
    if len({(v, h) for _, v, h in learnt}) < 4:
        for r in rows:
            r[2] = xxhash.xxh64_intdigest(r[0], seed=42) & 1
    size = sum(len(r[0]) for r in learnt)
    depth = max(d for d in range(40) if 4**d <= size) if size else 0
    alike = 1 / len({c for r in rows for c in r[0]}) if any(r[0] for r in rows) else 1
    seen = {}
    for text, v, h in learnt:
        marked = "\x02" + text
        for model in ((v, h), (v, "all")):
            table = seen.setdefault(model, {})
            for i in range(1, len(marked)):
                for k in range(min(depth, i) + 1):
                    nexts = table.setdefault(marked[i - k : i], {})
                    nexts[marked[i]] = nexts.get(marked[i], 0) + 1

    def probability(model, marked, i):
        p, table = alike, seen.get(model, {})
        for k in range(min(depth, i) + 1):
            nexts = table.get(marked[i - k : i])
            if nexts:
                p = (nexts.get(marked[i], 0) + len(nexts) * p) / (sum(nexts.values()) + len(nexts))
        return p

    def score(text, by):
        if not text or len({v for _, v, _ in learnt}) < 2:
            return None
        marked = "\x02" + text
        parts = [math.log(probability(("allow", by), marked, i) / probability(("block", by), marked, i)) for i in range(1, len(marked))]
        return sum(parts) / len(parts)

    scores = [score(t, 1 - h if v else "all") for t, v, h in rows]
    place = lambda s: math.floor((min(max(s, -8), 8) + 8) / 16 * 4000)
    known = [(place(s), v) for s, (_, v, _) in zip(scores, rows) if v and s is not None]
    n = {v: sum(x == v for _, x in known) for v in ("allow", "block")}

    def right(cut):
        return sum(v == "allow" and k >= cut for k, v in known) / n["allow"] + sum(v == "block" and k < cut for k, v in known) / n["block"]

    cut = max(sorted({k for k, _ in known}), key=right) * 16 / 4000 - 8 if all(n.values()) else 0.0
    return [(v or ("block" if not t or (s is not None and s < cut) else "allow"), s) for s, (t, v, _) in zip(scores, rows)]
