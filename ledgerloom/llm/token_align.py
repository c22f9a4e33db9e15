"""Alignment of two tokenizers on the same bytes, and how often their ids are linked in the whole corpus.

Both tokenizers cut the same bytes. Each side's cumulative ends go into a
dictionary from end to index; the intersection of the two key sets are the
offsets at which both have a token end, and in order they slice both id lists
into groups of least size. The tokens of a slice that end with it are linked;
where no token is empty that is one pair a slice, its last tokens.

Two linked tokens end together, so the bytes of one are a suffix of the other's:
there are at most as many different pairs as the tokens of both vocabularies
have bytes in all, whatever the corpus (:func:`pair_bound`). Their counts are
therefore a table of bounded size, which is joined by broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ledgerloom.llm.common import numbered
from ledgerloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text bytes worked on together; longer texts come alone.
PART_BYTES = 1 << 20
#: A longer run of white space goes to the tokenizer file's own library, since the faster one recurses over it.
LONGEST_SPACE = 4_096
#: Splits byte-level text before the merges. Fixed value.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_RUN = re.compile(r"\s{%d}" % LONGEST_SPACE)


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Byte-level merges of a tokenizer file (.json), special strings being plain text.

    If every merge makes the next id, ids are the order of merges, and the
    merges run in the rank-based library, which gives the same ids in a third of
    the time; otherwise, and for very long runs of white space, the file's own
    library runs.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        special = {t["content"] for t in spec.get("added_tokens") or ()}
        size = max([*model["vocab"].values(), *(t["id"] for t in spec.get("added_tokens") or ())]) + 1
        self.pieces = [b""] * size
        ranks = {}
        for word, i in model["vocab"].items():
            if word not in special:
                self.pieces[i] = bytes(letters[c] for c in word)
                ranks[self.pieces[i]] = i
        self._slow = self._fast = None
        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and spec.get("normalizer") is None and made == list(range(256, 256 + len(made))) and len(ranks) == 256 + len(made):
            import tiktoken

            self._fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(self):
        if self._slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.no_truncation()
            self._slow.no_padding()
            self._slow.encode_special_tokens = True
        return self._slow

    def encode(self, text: str) -> list[int]:
        if self._fast is not None and not SPACE_RUN.search(text):
            return self._fast.encode_ordinary(text)
        return self.slow().encode(text, add_special_tokens=False).ids


class Pieces:
    """Pieces of a sentencepiece model (.model), which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece) if self.model.is_byte(i) else None
            self.pieces.append(bytes([int(byte[1], 16)]) if byte else b"" if self.model.is_control(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def pair_bound(a: Sequence[bytes], b: Sequence[bytes]) -> int:
    """How many different pairs of ids can be linked at most: a link's shorter token is a suffix of the longer one."""
    return sum(map(len, a)) + sum(map(len, b)) + len(a) + len(b)


def dictionary(ends: np.ndarray) -> tuple[pd.Index, np.ndarray]:
    """A hash table of the different ends, and for each how many tokens end there or before."""
    last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True)) if len(ends) else np.zeros(0, np.int64)
    return pd.Index(ends[last]), last + 1


def cuts_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each offset at which tokens of both sides end, in order: how many tokens of A and of B end there or before."""
    (at_a, upto_a), (at_b, upto_b) = dictionary(a_ends), dictionary(b_ends)
    found = at_b.get_indexer(at_a)  # ends ascend, so the common ones stand in order
    common = found >= 0
    return upto_a[common], upto_b[found[common]]


def common_cuts(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int]]:
    """:func:`cuts_of` for plain lists."""
    a_cuts, b_cuts = cuts_of(np.asarray(a_ends, np.int64), np.asarray(b_ends, np.int64))
    return a_cuts.tolist(), b_cuts.tolist()


def steps(ends: np.ndarray) -> np.ndarray:
    """From 0 to the first, and from each to the next."""
    out = ends.copy()
    out[1:] -= ends[:-1]
    return out


def links_of(a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pairs of tokens that end together, slice by slice."""
    if (steps(a_ends) > 0).all() and (steps(b_ends) > 0).all():
        return a_ids[a_cuts - 1], b_ids[b_cuts - 1]  # one token of each side ends with the slice
    x, y = [a_ids[:0]], [b_ids[:0]]
    for i, j in zip(a_cuts.tolist(), b_cuts.tolist()):
        ours = a_ids[np.searchsorted(a_ends, a_ends[i - 1]) : i]
        theirs = b_ids[np.searchsorted(b_ends, b_ends[j - 1]) : j]
        x.append(np.repeat(ours, len(theirs)))
        y.append(np.tile(theirs, len(ours)))
    return np.concatenate(x), np.concatenate(y)


class Aligner:
    """Both tokenizers and their tables; ``__call__`` aligns one text."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.sizes = [np.array([len(p) for p in t.pieces], np.int64) for t in (self.a, self.b)]
        # pieces one after the other, and where each begins
        self.bytes = [np.frombuffer(b"".join(t.pieces), np.uint8) for t in (self.a, self.b)]
        self.begins = [np.cumsum(n) - n for n in self.sizes]
        # written ids of A within and at the end of a group, then those of B
        n_a, n_b = len(self.a.pieces), len(self.b.pieces)
        written = [f"{i}{mark}".encode() for n, mark in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]
        width = max(map(len, written))
        self.written = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in written), np.uint8).reshape(-1, width)

    def gives_back(self, side: int, ids: np.ndarray, ends: np.ndarray, data: np.ndarray) -> bool:
        """Whether the bytes of the tokens are ``data``."""
        if not len(ends) or ends[-1] != len(data):
            return False
        sizes = self.sizes[side][ids]
        at = np.arange(len(data)) + np.repeat(self.begins[side][ids] - (ends - sizes), sizes)
        return np.array_equal(self.bytes[side][at], data)

    def __call__(self, text: str | None):
        """Ids of A and of B, cuts of A and of B, linked ids of A and of B; None if the text has no tokens."""
        if not text:
            return None
        full = " " + text
        data = np.frombuffer(full.encode(), np.uint8)
        x, y = np.array(self.a.encode(full), np.int32), np.array(self.b.encode(text), np.int32)
        a_ends, b_ends = np.cumsum(self.sizes[0][x]), np.cumsum(self.sizes[1][y])
        if not (self.gives_back(0, x, a_ends, data) and self.gives_back(1, y, b_ends, data)):
            return None
        a_cuts, b_cuts = cuts_of(a_ends, b_ends)
        return x, y, a_cuts, b_cuts, *links_of(x, y, a_ends, b_ends, a_cuts, b_cuts)

    def digest(self, a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> str:
        """SHA-256 of the groups, written ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.a.pieces), len(self.b.pieces)
        a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        a_last[a_cuts - 1], b_last[b_cuts - 1] = 1, 1
        a_sizes, b_sizes = steps(a_cuts), steps(b_cuts)
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + np.repeat(b_cuts - b_sizes, a_sizes)] = a_ids + n_a * a_last
        order[np.arange(len(b_ids)) + np.repeat(a_cuts, b_sizes)] = b_ids + 2 * n_a + n_b * b_last
        text = self.written[order].ravel()
        return hashlib.sha256(text[text != 0][:-1].tobytes()).hexdigest()


def _lists(parts: list, kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([np.asarray(p) for p in parts]) if ends[-1] else np.array([], np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind, safe=False))


#: What :func:`align_tokens` can give for each text.
GIVES = {
    "a_ids": ArrayType(IntegerType()), "b_ids": ArrayType(IntegerType()), "a_cuts": ArrayType(IntegerType()), "b_cuts": ArrayType(IntegerType()),
    "n_a": LongType(), "n_b": LongType(), "n_groups": LongType(), "n_links": LongType(), "groups_sha256": StringType(),
    "linked_a": ArrayType(IntegerType()), "linked_b": ArrayType(IntegerType()), "linked_n": ArrayType(IntegerType()),
}


def align_tokens(docs: DataFrame, a: str, b: str, keep: Sequence[str], text: str = "text", give: Sequence[str] = ("a_ids", "b_ids", "a_cuts", "b_cuts")) -> DataFrame:
    """``keep`` and the columns ``give`` for every row.

    ``a_ids`` and ``b_ids`` are the tokens; group i holds the tokens from
    ``a_cuts[i - 1]`` (0 before the first) up to ``a_cuts[i]``, likewise for B.
    ``linked_a``, ``linked_b``, ``linked_n`` are the different pairs of linked ids
    of the text and how often each occurs. A NULL or empty text, or one whose
    tokens do not give back a space and the text byte by byte, has no tokens:
    zeros, empty arrays, an empty digest. Repeated rows stay repeated. The paths
    of the tokenizer files are the same on every executor.
    """
    own = [f"_k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(o) for c, o in zip(keep, own)), F.col(text).alias("_text"))
    schema = StructType([StructField(o, source.schema[o].dataType) for o in own] + [StructField(g, GIVES[g]) for g in give])
    arrow = to_arrow_schema(schema)
    give = tuple(give)

    def given(aligner: Aligner, texts: list[str | None]) -> list[pa.Array]:
        columns: dict[str, list] = {g: [] for g in GIVES}
        for t in texts:
            found = aligner(t)
            a_ids, b_ids, a_cuts, b_cuts, x, y = found or [np.zeros(0, np.int32)] * 6
            row = {"a_ids": a_ids, "b_ids": b_ids, "a_cuts": a_cuts, "b_cuts": b_cuts, "n_a": len(a_ids), "n_b": len(b_ids), "n_groups": len(a_cuts), "n_links": len(x)}
            if "groups_sha256" in give:
                row["groups_sha256"] = aligner.digest(a_ids, b_ids, a_cuts, b_cuts) if found else ""
            if "linked_n" in give:
                codes, n = np.unique(x.astype(np.int64) << 32 | y, return_counts=True)
                row |= {"linked_a": codes >> 32, "linked_b": codes & 0xFFFFFFFF, "linked_n": n}
            for g in give:
                columns[g].append(row[g])
        return [_lists(columns[g], pa.int32()) if isinstance(GIVES[g], ArrayType) else pa.array(columns[g], arrow.field(g).type) for g in give]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                base = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, base + PART_BYTES, "right")))
                part = batch.slice(start, stop - start)
                aligner = aligner or Aligner(a, b)
                yield pa.RecordBatch.from_arrays([*(part.column(o).cast(arrow.field(o).type) for o in own), *given(aligner, part.column("_text").to_pylist())], schema=arrow)
                start = stop

    return source.mapInArrow(task, schema).withColumnsRenamed(dict(zip(own, keep)))


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``links`` and ``best`` (as many as any pair of this b has) for each pair of ids linked anywhere; at most :func:`pair_bound` rows."""
    pairs = aligned.select(F.explode(F.arrays_zip("linked_a", "linked_b", "linked_n")).alias("p")).select(F.col("p.linked_a").alias("a"), F.col("p.linked_b").alias("b"), F.col("p.linked_n").alias("n"))
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("n").alias("links")), "link-counts")
    top = counts.groupBy("b").agg(F.max("links").alias("most"))
    return materialize(counts.join(top, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best")), "links")


def token_alignment(docs: DataFrame, a: str, b: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    Texts are encoded once; the pairs of each text are kept in the shared folder,
    counted over all rows, and summed per row against these counts.
    """
    own = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    aligned = numbered(align_tokens(own, a, b, ["doc_id"], give=[*numbers, "groups_sha256", "linked_a", "linked_b", "linked_n"]), "alignments")
    counts = link_counts(aligned)
    used = aligned.select("_row", F.explode(F.arrays_zip("linked_a", "linked_b", "linked_n")).alias("p")).select("_row", F.col("p.linked_a").alias("a"), F.col("p.linked_b").alias("b"), F.col("p.linked_n").cast("bigint").alias("n"))
    # the counts have a bounded number of rows, see pair_bound
    sums = used.join(F.broadcast(counts), ["a", "b"]).groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return aligned.select("_row", "doc_id", *numbers, "groups_sha256").join(sums, "_row", "left").select(
        F.col("doc_id").alias(ident), *numbers, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
