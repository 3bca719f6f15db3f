"""Conflict-constrained best-fit packing of documents into sequences of a fixed length.

A bin never holds two documents of one duplicate cluster, and no more than ``PER_SOURCE`` of one source. Documents longer than
``capacity`` are cut: whole sequences of their own, and a remainder that is packed. Remainders are dealt by a hash to
shards of about ``ROWS_PER_SHARD``, so that no source or cluster gathers in a task, and each shard is packed by itself,
longest first: into the compatible bin with the least room left that suffices, or a new one.

Bins are ordered by the room they have left. Each carries bitmaps of its sources, one for each number of documents
already held, and of its clusters; a source or cluster is a bit of ``BITMAP`` by its hash, so two that share a bit also keep apart. A
tree over the room left holds, for every range of it, the bits that all bins there have in common: where these
exclude a document, the search for the next larger room passes over the whole range.

Documents of length zero (or null) are returned with no bin. Null sources never conflict, nor do null clusters. Repeated rows
are documents of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
PER_SOURCE = 4
ROWS_PER_SHARD = 8192
BITMAP = 256


class Bins:
    """Open bins by the room they have left."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        everything = -1
        # In common of all bins below a node; an empty range excludes everything.
        self.common = [everything] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]
        self.masks: list[int] = []
        self.room: list[int] = []

    def _renew(self, room: int) -> None:
        node, common = self.leaves + room, -1
        for number in self.at[room]:
            common &= self.masks[number]
        while True:
            if self.common[node] == common:
                return
            self.common[node] = common
            node >>= 1
            if not node:
                return
            common = self.common[2 * node] & self.common[2 * node + 1]

    def add(self, room: int, mask: int) -> int:
        self.masks.append(mask)
        self.room.append(room)
        number = len(self.room) - 1
        insort(self.at[room], number)
        self._renew(room)
        return number

    def put(self, number: int, size: int, mask: int) -> None:
        room = self.room[number]
        own = self.at[room]
        del own[bisect_left(own, number)]
        self._renew(room)
        self.masks[number], self.room[number] = mask, room - size
        insort(self.at[room - size], number)
        self._renew(room - size)

    def tightest(self, size: int, excluded: int) -> int | None:
        """The bin with the least room of at least ``size`` that has no bit of ``excluded``; the oldest of equals."""
        stack = [(1, 0, self.leaves)]
        while stack:
            node, low, high = stack.pop()
            if high <= size or self.common[node] & excluded:
                continue
            if node >= self.leaves:
                for number in self.at[low]:
                    if not self.masks[number] & excluded:
                        return number
                continue
            middle = (low + high) // 2
            stack.append((2 * node + 1, middle, high))
            stack.append((2 * node, low, middle))
        return None


def pack(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each document, taken in the given order. Sources and clusters are bits from 0 on, or -1 for none.

    A mask has ``per_source`` bitmaps of sources, the n-th for those held n times or more, and one of clusters. Its
    excluding bits are the last bitmap's and the cluster's.
    """
    bins, out = Bins(capacity), []
    last, of_clusters = (per_source - 1) * BITMAP, per_source * BITMAP
    # Bit 0 above all bitmaps is set in no bin, so that an empty range is passed over even for a document without conflicts.
    nothing = 1 << (of_clusters + BITMAP)
    for size, source, cluster in zip(sizes, sources, clusters):
        excluded = nothing
        if source >= 0:
            excluded |= 1 << (last + source)
        if cluster >= 0:
            excluded |= 1 << (of_clusters + cluster)
        number = bins.tightest(size, excluded)
        held = bins.masks[number] if number is not None else 0
        if source >= 0:
            held |= next(bit for bit in (1 << (n * BITMAP + source) for n in range(per_source)) if not held & bit)
        if cluster >= 0:
            held |= 1 << (of_clusters + cluster)
        if number is None:
            number = bins.add(capacity - size, held)
            out.append((number, 0))
        else:
            out.append((number, capacity - bins.room[number]))
            bins.put(number, size, held)
    return out


def best_fit(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, bin, offset)`` of documents with ``doc_id, length, source, cluster``.

    ``start`` and ``length`` are in the unit of ``length``; ``bin`` is a text that names a sequence, ``offset`` the place of
    the piece in it.
    """
    bit = lambda c: F.when(F.col(c).isNull(), -1).otherwise(F.pmod(F.xxhash64(F.col(c)), F.lit(BITMAP))).cast("int")
    rows = docs.select("doc_id", F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(0)), F.lit(0)).alias("length"), bit("source").alias("source"), bit("cluster").alias("cluster"))
    rest = F.col("length") % capacity
    full = rows.where(F.col("length") >= capacity).select(
        "doc_id", F.explode(F.sequence(F.lit(0), (F.col("length") / capacity).cast("int") - 1)).alias("piece"), "length"
    )
    full = full.select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        F.concat_ws(":", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("piece"), "length").alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    empty = rows.where("length = 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), "length", F.lit(None).cast("string").alias("bin"), F.lit(None).cast("long").alias("offset"))
    items = rows.where(rest > 0).select("doc_id", (F.col("length") / capacity).cast("int").alias("piece"), rest.alias("length"), "source", "cluster")
    shards = max(1, -(-items.count() // ROWS_PER_SHARD))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "length", "cluster", F.lit("shard")), F.lit(shards)))

    def pack_shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "source", "cluster"], ascending=[False, True, True, True], kind="stable")
        placed = pack(frame["length"].tolist(), frame["source"].tolist(), frame["cluster"].tolist(), capacity, per_source)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"].to_numpy(),
                "piece": frame["piece"].to_numpy(),
                "start": frame["piece"].to_numpy().astype(np.int64) * capacity,
                "length": frame["length"].to_numpy(),
                "bin": [f"shared:{s}:{b}" for s, (b, _) in zip(frame["shard"], placed)],
                "offset": [o for _, o in placed],
            }
        )

    id_type = dict(rows.dtypes)["doc_id"]
    packed = dealt.groupBy("shard").applyInPandas(pack_shard, f"doc_id {id_type}, piece int, start long, length long, bin string, offset long")
    return full.unionByName(packed).unionByName(empty)
