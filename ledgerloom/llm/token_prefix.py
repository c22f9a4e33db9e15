"""Token counts stored at every pre-token, so that truncation and budgets need no second encoding.

A pre-token (a run of letters, a digit, a run of signs) is encoded by itself, so
the count of a prefix that ends between two of them is the sum of the counts
before it. These counts are kept as two arrays (``ends``: code points,
``counts``: tokens); the dynamic programme is ``counts[i] = counts[i - 1] +
tokens(pre-token i)``, with the pre-tokens of a chunk between white space taken
from the tokenizer once and remembered. A budget is settled inside the one
pre-token that crosses it; ``all_prefix_counts`` has the prefixes inside all.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ledgerloom.llm.common import map_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Chunks and pieces remembered by a task; beyond it their memory starts anew (results do not change).
REMEMBERED = 500_000
#: Text bytes worked on together; longer texts come alone.
PART_BYTES = 1 << 20
#: Signs that make a pre-token of their own after a letter.
CLOSING = ".,;:!?"
SPACES = " \t\n\v\f\r"


class ChunkCounter:
    """Pre-tokens of chunks and their tokens, as the tokenizer file gives them; a chunk has no ASCII white space."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}
        self.forget()
        # a number: one pre-token of so many tokens
        self.pieces_of: dict[str, int | list[tuple[int, int]]] = {}
        self.prefixes_of: dict[str, list[int]] = {}
        self.pieces: frozenset[bytes] | None = None
        # all ASCII letters are made small before anything else happens to them
        self.small = all(self.ids_alike(chr(c) * 2 + "x", chr(c).lower() * 2 + "x") for c in range(65, 91))
        self.pieces: frozenset[bytes] | None = None

    def ids_alike(self, x: str, y: str) -> bool:
        return self.tokenizer.encode(x, add_special_tokens=False).ids == self.tokenizer.encode(y, add_special_tokens=False).ids

    def count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def forget(self) -> None:
        self.known.clear()
        self.first, self.ends, self.tokens = [0], [], []
        self.arrays = tuple(np.array(x, np.int64) for x in (self.first, self.ends, self.tokens))

    def learn(self, chunks: set[bytes]) -> None:
        """Number the chunks and know the ends and tokens of their pre-tokens.

        Signs after a letter begin a pre-token, and letters without accents are
        made small by the tokenizer, so a chunk is put together from a stem and
        its closing signs, which are encoded once for all chunks they are in.
        """
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED and self.known:
            self.forget()
            new = chunks
        if not new:
            return
        parts = []
        for b in new:
            c = b.decode()
            stem = c.rstrip(CLOSING)
            # signs of one kind of pre-token, so that they are one
            cut = len(stem) if len(stem) < len(c) and stem and stem[-1].isalpha() else len(c)
            parts.append((b, c[:cut].lower() if self.small and b.isascii() else c[:cut], c[cut:], len(c)))
        self._encode({p for _, stem, tail, _ in parts for p in (stem, tail) if p})
        known, first, ends, tokens, pieces = self.known, self.first, self.ends, self.tokens, self.pieces_of
        for b, stem, tail, n in parts:
            found = pieces[stem]
            known[b] = len(first) - 1
            if isinstance(found, int):
                ends.append(n - len(tail))
                tokens.append(found)
            else:
                ends += [e for e, _ in found]
                tokens += [k for _, k in found]
            if tail:
                ends.append(n)
                more = pieces[tail]
                tokens.append(more if isinstance(more, int) else sum(k for _, k in more))
            first.append(len(ends))
        self.arrays = tuple(np.array(x, np.int64) for x in (self.first, self.ends, self.tokens))

    def _encode(self, parts: set[str]) -> None:
        if len(self.pieces_of) + len(parts) > REMEMBERED:
            self.pieces_of = {}
        new = [p for p in parts if p not in self.pieces_of]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for c, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                words = e.word_ids
                self.pieces_of[c] = len(words) if not words or words[0] == words[-1] else self.split(len(c), e)

    def prefixes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends of all pre-tokens of a text, and the tokens up to each."""
        chunks = text.encode().split()  # bytes: only ASCII white space splits
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        space = (points == 32) | (points - 9 < 5)
        starts = np.flatnonzero(~space & np.append(True, space[:-1])) if len(points) else np.zeros(0, np.int64)
        first, ends, tokens = self.arrays
        ids = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        low, sizes = first[ids], first[ids + 1] - first[ids]
        before = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(low - before, sizes)
        return ends[at] + np.repeat(starts, sizes), np.cumsum(tokens[at])

    @staticmethod
    def split(size: int, e) -> list[tuple[int, int]]:
        """A pre-token reaches to the start of the next; those that share a code point stay together."""
        words = e.word_ids
        ends, counts, last, reach = [], [0], words[0], 0
        for w, (start, stop) in zip(words, e.offsets):
            if w != last:
                if start >= reach > 0:
                    ends.append(start)
                    counts.append(0)
                last = w
            counts[-1] += 1
            reach = max(reach, stop)
        return list(zip([*ends, size], counts))

    def inside(self, chunk: str) -> list[int]:
        """Tokens of each prefix of a chunk, the empty one first."""
        self.learn({chunk.encode()})
        ends, counts = self.prefixes(chunk)
        out, base, start = [0], 0, 0
        for end, total in zip(ends.tolist(), counts.tolist()):
            out += [base + x for x in self.prefixes_inside(chunk[start:end])[1:]]
            base, start = total, end
        return out

    def prefixes_inside(self, word: str) -> list[int]:
        """Tokens of each prefix of a pre-token, the empty one first; stored once they have been asked for."""
        found = self.prefixes_of.get(word)
        if found is None:
            if len(self.prefixes_of) > REMEMBERED:
                self.prefixes_of = {}
            found = self.prefixes_of[word] = [0, *self.count([word[:i] for i in range(1, len(word) + 1)])]
        return found

    def fitting(self, word: str, budget: int) -> int:
        """Code points of the longest prefix of a pre-token with at most so many tokens."""
        if len(word) <= 32:
            return max((i for i, n in enumerate(self.prefixes_inside(word)[:-1]) if n <= budget), default=0)
        least = self.least_tokens(word)
        sizes = [i for i in range(len(word) - 1, 0, -1) if least is None or i < len(least) and least[i] <= budget]
        for k in range(0, len(sizes), 16):
            part = sizes[k : k + 16]
            for i, n in zip(part, self.count([word[:i] for i in part])):
                if n <= budget:
                    return i
        return 0

    def least_tokens(self, word: str) -> list[int] | None:
        """For each prefix the least number of vocabulary entries that make it up, which its tokens cannot be fewer than; None if its code points act on each other."""
        normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        parts = [normalize(c) for c in word]
        if normalize(word) != "".join(parts) or self.tokenizer.get_vocab_size() == 0:
            return None
        if self.pieces is None:
            self.pieces = frozenset(bytes(map(BYTES.__getitem__, p)) for v in self.tokenizer.get_vocab(with_added_tokens=False) if set(p := v.removesuffix("</w>")) <= BYTES.keys())
            self.longest = max(map(len, self.pieces), default=0)
        data = "".join(parts).encode()
        best = [0]
        for i in range(1, len(data) + 1):
            best.append(1 + min((best[j] for j in range(max(0, i - self.longest), i) if data[j:i] in self.pieces), default=0))
        at = accumulate((len(p.encode()) for p in parts), initial=0)
        return [best[i] for i in at]


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


BYTES = _byte_letters()
CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


def prefix_counts(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", limit: int | None = None) -> DataFrame:
    """``keep`` plus ``n_bytes``, ``ends`` and ``counts`` of the whole text, and ``cut``: code points of its longest prefix of at most ``limit`` tokens.

    NULL and empty texts have empty arrays. ``tokenizer`` is the path of a
    tokenizer file, the same on every executor.
    """
    own = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    added = StructType.fromDDL("n_bytes bigint, ends array<int>, counts array<int>, cut int")
    schema = StructType([*(StructField(o, source.schema[o].dataType) for o in own), *added.fields])
    arrow = to_arrow_schema(schema)

    def longest(counter: ChunkCounter, t: str, ends: np.ndarray, counts: np.ndarray) -> int:
        if limit is None or not len(counts) or counts[-1] <= limit:
            return len(t)
        k = int(np.searchsorted(counts, limit, "right"))  # the first pre-token that ends beyond the limit
        start, base = (int(ends[k - 1]), int(counts[k - 1])) if k else (0, 0)
        end = int(ends[k])
        while start < end and t[start] in SPACES:
            start += 1
        return start + counter.fitting(t[start:end], limit - base)

    def lists(parts: list[np.ndarray]) -> pa.ListArray:
        offsets = np.cumsum([0, *map(len, parts)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), pa.int32()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("_text")).to_numpy(zero_copy_only=False)
            done, start = np.cumsum(sizes), 0
            while start < batch.num_rows:
                counter = counter or ChunkCounter(tokenizer)
                stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + PART_BYTES, "right")))
                part = batch.slice(start, stop - start)
                texts = part.column("_text").to_pylist()
                counter.learn(set(itertools.chain.from_iterable(t.encode().split() for t in texts)))
                found = [counter.prefixes(t) for t in texts]
                cuts = [longest(counter, t, *f) for t, f in zip(texts, found)]
                columns = [*(part.column(o).cast(arrow.field(o).type) for o in own), pa.array(sizes[start:stop], pa.int64()), lists([e for e, _ in found]), lists([c for _, c in found]), pa.array(cuts, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                start = stop

    return source.mapInArrow(task, schema).withColumnsRenamed(dict(zip(own, keep)))


def all_prefix_counts(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` plus ``prefix_tokens``: the exact count of every prefix, one entry per code point and one for the empty prefix."""

    def make():
        counter = ChunkCounter(tokenizer)

        def one(t: str) -> list[int]:
            out, base, at = [0], 0, 0
            for m in CHUNK.finditer(t):
                out += [base] * (m.start() - at)
                steps = counter.inside(m[0])
                out += [base + s for s in steps[1:]]
                base, at = base + steps[-1], m.end()
            return out + [base] * (len(t) - at)

        return lambda texts: [[one(t) for t in texts]]

    return map_text(docs, make, "prefix_tokens array<int>", keep, text)


def total(counts: Column | str = "counts") -> Column:
    """Tokens of the whole text."""
    c = F.col(counts) if isinstance(counts, str) else counts
    return F.when(F.size(c) > 0, F.element_at(c, -1)).otherwise(0).cast("bigint")


def token_counts(docs: DataFrame, tokenizer: str, limit: int, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars`` (code points of the longest prefix within the limit)."""
    p = prefix_counts(docs, tokenizer, keep, text, limit)
    n = total()
    return p.select(*keep, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"), F.col("cut").cast("bigint").alias("cut_chars"))
