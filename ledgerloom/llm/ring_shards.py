"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Equal texts are one key of the ring. A key goes to the shard of the first
virtual node at or after its place; once that shard holds its bound, the keys
that follow in the order of arrival go on clockwise to the next shard with room.
The order of arrival is a digest, so it does not depend on how the rows lie, and
rows of one key arrive together: only a key that meets a full shard is split, so
at most one for each shard.

What the ring does row by row is the same for all rows between two moments at
which a shard becomes full, and there are fewer of these than shards. So the
rows are sorted once into slices, the bytes of each slice and virtual node are
summed, and each moment is found in the sums, then inside the one slice that
holds it.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import numbered
from ledgerloom.operators.ordered import _sliced
from ledgerloom.session import materialize

SHARDS = 8
#: Virtual nodes of a shard.
NODES = 256
#: A shard is full once it holds this many times its even share of the bytes.
BOUND = 1.001
#: Rows of a slice that the driver looks at one by one around a moment, in bits.
BLOCK_BITS = 12
#: Places of the ring, in bits.
PLACES = 16


def virtual_nodes(shards: int, nodes: int = NODES, places: int = PLACES) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise; those at one place by their shard."""
    points = []
    for s in range(shards):
        for v in range(nodes):
            digest = hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()
            points.append((int(digest[:16], 16) >> (64 - places), s))
    return sorted(points)


def preferences(points: list[tuple[int, int]], shards: int) -> list[tuple[int, ...]]:
    """For each virtual node the shards in the order in which they are met clockwise from it."""
    if len({s for _, s in points}) < shards:
        raise ValueError("every shard needs a virtual node")
    out, met = [], []
    for _, s in [*points, *points][::-1]:  # the second time round, all shards have been met
        met = [s, *(m for m in met if m != s)]
        out.append(tuple(met))
    return out[: len(points) - 1 : -1]


def nodes_of_places(points: list[tuple[int, int]], places: int = PLACES) -> list[int]:
    """The virtual node that each place belongs to: the first at or after it, around the ring."""
    out, i = [], 0
    for place in range(1 << places):
        while i < len(points) and points[i][0] < place:
            i += 1
        out.append(i % len(points))
    return out


def shard_rows(docs: DataFrame, keep: list[str], ident: str = "doc_id", text: str = "text", shards: int = SHARDS, nodes: int = NODES, bound: float = BOUND) -> DataFrame:
    """``keep``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0 in each shard, without gaps) for every row.

    No shard holds ``bound`` times an even share of the bytes before its last
    row, so it ends above that by one row at most. NULL texts count as empty, for
    the ring too. Rows alike in id and text are taken in the order they are read
    in. Equal texts share a shard but where it becomes full among them.
    """
    spark = docs.sparkSession
    own = [f"_k{i}" for i in range(len(keep))]
    words = F.coalesce(F.col(text), F.lit("")).cast("string")
    key = F.xxhash64(words)
    given = docs.select(
        *(F.col(c).alias(o) for c, o in zip(keep, own)), key.alias("_key"), F.xxhash64(F.lit("id"), F.col(ident)).alias("_id"),
        (F.octet_length(words) + 1).cast("bigint").alias("size"), F.crc32(words.cast("binary")).alias("text_crc32"))
    given = numbered(given, "sizes")
    points = virtual_nodes(shards, nodes)
    wishes = preferences(points, shards)
    # one row per place of the ring
    places = F.broadcast(spark.createDataFrame(list(enumerate(nodes_of_places(points))), "_place int, _node int"))
    put = given.withColumn("_place", F.shiftrightunsigned("_key", 64 - PLACES).cast("int")).join(places, "_place").drop("_place")
    rows = _sliced(put.withColumn("_turn", F.xxhash64("_key")), [F.col("_turn"), F.col("_id"), F.col("_row")])
    moments = full_moments(rows, wishes, shards, bound)
    # one row per virtual node and moment
    goals = F.broadcast(spark.createDataFrame([(node, i, next(s for s in wish if s not in full)) for i, (_, _, full) in enumerate(moments) for node, wish in enumerate(wishes)], "_node int, _phase int, shard int"))
    phase = sum((F.when((F.col("_slice") > s) | ((F.col("_slice") == s) & (F.col("_seq") >= q)), 1).otherwise(0) for s, q, _ in moments[1:]), F.lit(0))
    placed = materialize(rows.withColumn("_phase", phase).join(goals, ["_node", "_phase"]).select(*own, "size", "text_crc32", "shard", "_slice", "_seq"), "placed")
    # a slice is a bounded part of the rows; its shards are numbered by themselves and follow those of earlier slices
    part = placed.groupBy("shard", "_slice").agg(F.count("*").alias("n"))
    first = part.select("shard", "_slice", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_slice", "shard").orderBy("_seq")) - 1
    slots = placed.withColumn("_inside", inside).join(first, ["_slice", "shard"])
    return slots.select(*(F.col(o).alias(c) for c, o in zip(keep, own)), "size", "text_crc32", "shard", (F.col("_first") + F.col("_inside")).alias("slot"))


def full_moments(rows: DataFrame, wishes: list[tuple[int, ...]], shards: int, bound: float) -> list[tuple[int, int, frozenset[int]]]:
    """(slice, place in the slice, shards that are full from there on), starting with none; ``rows`` has ``_slice``, ``_seq``, ``_node`` and ``size``.

    The driver gets one sum per slice and shard, one per block and shard of the
    slice that holds the moment, and the sizes of the one block itself.
    """
    spark = rows.sparkSession
    # as many rows as slices and virtual nodes
    sums = materialize(rows.groupBy("_slice", "_node").agg(F.sum("size").alias("bytes")), "slice-bytes")
    limit = math.ceil((sums.agg(F.sum("bytes").alias("n")).first()["n"] or 0) * bound / shards)
    moments: list[tuple[int, int, frozenset[int]]] = [(0, 0, frozenset())]
    held = [0] * shards
    at, seq = 0, 0  # all rows before this one are placed
    while limit and len(moments) < shards:
        full = moments[-1][2]
        aims = [next(s for s in wish if s not in full) for wish in wishes]
        goal = F.broadcast(spark.createDataFrame(list(enumerate(aims)), "_node int, shard int"))

        def first_over(steps: DataFrame, by: str) -> int | None:
            """The least ``by`` in which a shard reaches the limit; what comes before it is added to ``held``."""
            found = sorted(tuple(r) for r in steps.join(goal, "_node").groupBy(by, "shard").agg(F.sum("bytes").alias("bytes")).collect())
            now, last = held.copy(), None
            for step, s, n in found:
                if step != last:
                    held[:] = now
                    last = step
                now[s] += n
                if now[s] >= limit:
                    return step
            held[:] = now
            return None

        rest = rows.filter((F.col("_slice") == at) & (F.col("_seq") >= seq))
        ahead = sums.filter(F.col("_slice") > at).unionByName(rest.groupBy("_slice", "_node").agg(F.sum("size").alias("bytes")))
        over = first_over(ahead, "_slice")
        if over is None:
            break
        seq = seq if over == at else 0
        at = over
        here = rows.filter((F.col("_slice") == at) & (F.col("_seq") >= seq)).withColumn("block", F.shiftright("_seq", BLOCK_BITS))
        block = first_over(here.select("block", "_node", F.col("size").alias("bytes")), "block")
        for q, node, size in sorted(tuple(r) for r in here.filter(F.col("block") == block).select("_seq", "_node", "size").collect()):
            s = next(s for s in wishes[node] if s not in moments[-1][2])
            held[s] += size
            seq = q + 1
            if held[s] >= limit and len(moments) < shards:
                moments.append((at, seq, moments[-1][2] | {s}))
    return moments


def law_of_bytes(docs: DataFrame, ident: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """The id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (NULL: the loads of all rows decide, not the id alone)."""
    out = shard_rows(docs, [ident], ident, text, shards)
    return out.select(ident, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
