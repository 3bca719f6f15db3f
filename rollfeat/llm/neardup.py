"""Near-duplicate documents by an LSH forest of MinHash signatures.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. A document's set holds its distinct 5-word shingles;
with fewer words, the whole sequence as one; without words (null or empty text), nothing. Two documents are linked if
the Jaccard similarity of their sets is at least 0.75; documents with empty sets or without ``doc_id`` are linked with
nothing. Rows that repeat a ``doc_id`` are one document.

1. Documents with equal sets form a class, represented by the least ``doc_id``. Only representatives go on, so that a
   group of exact copies, however large, is one row.
2. *Forest.* Each of ``TREES`` trees orders the representatives by ``DEPTH`` minima. The orders are cut into ranges of
   rows, not of keys, so that no group is too large for a task. Within an order, a region (the rows that share a prefix)
   of at most ``REGION`` rows is compared whole, at the least depth where it is that small: sparse regions are compared
   from one shared minimum on, dense ones go deeper. In dense regions, each row is also compared with its ``NEIGHBOURS``
   next rows, whose common prefix is the longest, and at every depth with up to ``MEDOIDS`` central rows of its region.
   Rows at the ends of a range are compared once more together with those of the next range.
3. A pair goes on if sizes allow the similarity and 28 of 64 signature bytes agree (at 0.75 a pair fails that with a chance below
   one in a million).
4. *Confirmation* on full sets, from the texts, in three rounds: first each document with its likeliest partner, then
   the likeliest pair of any two components, then all pairs that are still between components. A pair within one
   component needs no confirmation, so a group of thousands of near copies costs about as many confirmations. The forest is
   walked twice: first only the likeliest pairs leave a task, then, with the components of the first round in its rows, all
   pairs between different ones, each with its two components. What became of them is then joined with pairs of components,
   not of documents.
5. What a dense region showed to be near a component, but no confirmed pair links to it, is compared with all members of
   that component, in blocks.
6. *Crowded documents*, which lie in dense regions of ``CROWDED`` or more trees, are joined exactly, see ``crowded_links``:
   whatever two of them still are in different components and similar enough is found, however much they share with others.

A document that is not crowded is compared with its whole region in more than ``TREES - CROWDED`` trees, so a pair with
such a document is missed with a chance of at most 0.25 ** (TREES - CROWDED + 1), about 1e-6, as in step 3. ``tests/llm`` and
the README compare with all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollfeat.llm.components import between, components
from rollfeat.llm.store import Store
from rollfeat.llm.text import as_bytes, constants, grams, slices, word_hashes

SHINGLE = 5
TREES = 12
DEPTH = 8
REGION = 64
NEIGHBOURS = 2
MEDOIDS = 4
CROWDED = 3
RARE = 64
MOST_FREQUENT = 4_000_000
BLOCK = 1024
ASKING = 256
SKETCH = 64
LEAST_AGREEING = 28
SAME = 52
ROWS_PER_RANGE = 200_000

_SHINGLE = constants("shingle", SHINGLE)
_WHOLE = constants("whole text", SHINGLE)
_MINIMA = (constants("minima", TREES * DEPTH) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

# Layout of a row of the forest; its bytes sort as tree, minima, document.
_TREE, _PREFIX, _ID, _SIZE, _BYTES = 0, slice(1, 1 + 4 * DEPTH), slice(1 + 4 * DEPTH, 9 + 4 * DEPTH), slice(9 + 4 * DEPTH, 13 + 4 * DEPTH), slice(13 + 4 * DEPTH, 13 + 4 * DEPTH + SKETCH)
_COMPONENT = slice(13 + 4 * DEPTH + SKETCH, None)
_ROW = 21 + 4 * DEPTH + SKETCH
_SIGN = np.uint64(1 << 63)

# A candidate pair; low and high are the components of its documents.
PAIR = {"a": "long", "b": "long", "agreeing": "int", "crowded": "boolean", "low": "long", "high": "long"}
_PAIR = ", ".join(f"{name} {kind}" for name, kind in PAIR.items())


def shingles(hashes: np.ndarray) -> np.ndarray:
    """The set of a document as sorted 64-bit hashes, from the hashes of its words."""
    if 0 < len(hashes) < SHINGLE:
        return grams(hashes, _WHOLE[: len(hashes)])
    return np.unique(grams(hashes, _SHINGLE))


def minima(found: np.ndarray) -> np.ndarray:
    high = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_MINIMA), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 1024):
        np.minimum(best, (_MINIMA[:, None] * high[None, at : at + 1024]).min(1), out=best)
    return best


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, set_key, minima)`` of every row; the last two are null where nothing can be linked."""

    def sign(batches):
        for batch in slices(batches, "text"):
            hashes, bounds = word_hashes(as_bytes(batch.column("text")), lower=True)
            ids = batch.column("doc_id").to_pylist()
            sizes, keys, signed = [], [], []
            for i, doc_id in enumerate(ids):
                found = shingles(hashes[bounds[i] : bounds[i + 1]])
                sizes.append(len(found))
                linked = len(found) > 0 and doc_id is not None
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if linked else None)
                signed.append(minima(found).tobytes() if linked else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())],
                ["doc_id", "n_shingles", "set_key", "minima"],
            )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, minima binary")


def _forest_rows(batches):
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        signed = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint32).reshape(n, TREES * DEPTH)
        ids = batch.column("class_id").to_numpy().view(np.uint64) ^ _SIGN
        rows = np.empty((TREES, n, _ROW), np.uint8)
        rows[:, :, _COMPONENT] = np.ascontiguousarray(batch.column("component").to_numpy()).view(np.uint8).reshape(n, 8)
        rows[:, :, _ID] = ids.astype(">u8").view(np.uint8).reshape(n, 8)
        rows[:, :, _SIZE] = np.minimum(batch.column("n_shingles").to_numpy(), 0xFFFFFFFF).astype(">u4").view(np.uint8).reshape(n, 4)
        rows[:, :, _BYTES] = ((signed[:, :SKETCH] * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
        for tree in range(TREES):
            rows[tree, :, _TREE] = tree
            rows[tree, :, _PREFIX] = signed[:, tree * DEPTH : (tree + 1) * DEPTH].astype(">u4").view(np.uint8).reshape(n, 4 * DEPTH)
        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_ROW), n * TREES, [None, pa.py_buffer(rows.tobytes())])
        yield pa.RecordBatch.from_arrays([packed.cast(pa.binary())], ["row"])


def _runs(region: np.ndarray, chosen: np.ndarray) -> list[tuple[int, int]]:
    """Where the regions of the chosen rows begin and end."""
    numbers = np.unique(region[chosen])
    return list(zip(np.searchsorted(region, numbers).tolist(), np.searchsorted(region, numbers, side="right").tolist()))


def medoids(signed: np.ndarray) -> list[int]:
    """Up to ``MEDOIDS`` central rows of a region: those that agree most with its commonest bytes, first of all rows, then of
    the rows that are far from the centres so far."""
    columns = np.arange(SKETCH) * 256
    far, out = np.ones(len(signed), bool), []
    for _ in range(MEDOIDS):
        counts = np.bincount((signed[far] + columns).ravel(), minlength=256 * SKETCH).reshape(SKETCH, 256)
        centre = int((signed == counts.argmax(1).astype(np.uint8)).sum(1).argmax())
        if centre in out:
            break
        out.append(centre)
        far &= (signed == signed[centre]).sum(1) < SAME
        if far.sum() < 2:
            break
    return out


def candidates(rows: np.ndarray, best: bool = False) -> tuple[np.ndarray, ...]:
    """Pairs (smaller id, larger id, agreeing bytes, whether found in a region that is not compared whole, smaller component, larger
    component) of sorted forest rows that follow each other without a gap and are in different components.

    With ``best``, only pairs that are the likeliest of either of their ends, and rows whose region is not compared whole at the
    first minimum as pairs with themselves.
    """
    prefixes = np.ascontiguousarray(rows[:, _PREFIX]).view(">u4")
    common = np.cumprod(prefixes[1:] == prefixes[:-1], axis=1).sum(1)
    common[rows[1:, _TREE] != rows[:-1, _TREE]] = 0
    ids = (np.ascontiguousarray(rows[:, _ID]).view(">u8")[:, 0].astype(np.uint64) ^ _SIGN).view(np.int64)
    sizes = np.ascontiguousarray(rows[:, _SIZE]).view(">u4")[:, 0].astype(np.int64)
    signed = np.ascontiguousarray(rows[:, _BYTES])
    component = np.ascontiguousarray(rows[:, _COMPONENT]).view(np.int64)[:, 0]
    found: list[tuple[np.ndarray, ...]] = []

    def compare(left: np.ndarray, right: np.ndarray, crowded: bool = False) -> None:
        for at in range(0, len(left), 100_000):
            i, j = left[at : at + 100_000], right[at : at + 100_000]
            possible = (100 * np.minimum(sizes[i], sizes[j]) >= 75 * np.maximum(sizes[i], sizes[j])) & (ids[i] != ids[j]) & (component[i] != component[j])
            i, j = i[possible], j[possible]
            agreeing = (signed[i] == signed[j]).sum(1)
            likely = agreeing >= LEAST_AGREEING
            i, j = i[likely], j[likely]
            apart = np.minimum(component[i], component[j]), np.maximum(component[i], component[j])
            found.append((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), agreeing[likely], np.full(likely.sum(), crowded), *apart))

    dense, crowd = np.ones(len(rows), bool), np.zeros(len(rows), bool)
    for depth in range(1, DEPTH + 1):
        region = np.concatenate(([0], np.cumsum(common < depth)))
        large = np.bincount(region)[region] > REGION
        now = dense & ~large
        for step in range(1, REGION):
            i = np.flatnonzero(now[:-step] & (region[step:] == region[:-step]))
            if not len(i):
                break
            compare(i, i + step)
        dense &= large
        for a, b in _runs(region, dense):
            for centre in medoids(signed[a:b]):
                compare(np.full(b - a, a + centre), np.arange(a, b), True)
        if depth == 1:
            crowd = dense.copy()
            for step in range(1, NEIGHBOURS + 1):
                i = np.flatnonzero(dense[:-step] & (region[step:] == region[:-step]))
                compare(i, i + step, True)
        if not dense.any():
            break
    found.append((*[np.empty(0, np.int64)] * 3, np.empty(0, bool), *[np.empty(0, np.int64)] * 2))
    a, b, agreeing, crowded, low, high = (np.concatenate(x) for x in zip(*found))
    if not best:
        return a, b, agreeing, crowded, low, high
    chosen = np.zeros(len(a), bool)
    for own, other in ((a, b), (b, a)):
        order = np.lexsort((other, -agreeing, own))
        chosen[order[np.flatnonzero(np.diff(own[order], prepend=own[order[:1]] - 1))]] = True
    alone = np.zeros(crowd.sum(), np.int64)
    selves = ids[crowd], ids[crowd], alone, alone == 0, component[crowd], component[crowd]
    return tuple(np.concatenate((x[chosen], y)) for x, y in zip((a, b, agreeing, crowded, low, high), selves))


def _pairs(found: tuple[np.ndarray, ...]) -> list[pa.Array]:
    a, b, agreeing, crowded, low, high = found
    return [pa.array(a), pa.array(b), pa.array(agreeing.astype(np.int32)), pa.array(crowded), pa.array(low), pa.array(high)]


def _rows_of(columns) -> np.ndarray:
    joined = b"".join(b for c in columns for b in c.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, _ROW)


def _search_range(batches, best):
    """Candidates within a range of an order, and the rows at its two ends."""
    rows = _rows_of([b.column("row") for b in batches])
    if not len(rows):
        return
    pairs = _pairs(candidates(rows, best))
    names = [*PAIR, "range", "head", "tail", "row"]
    n = len(pairs[0])
    yield pa.RecordBatch.from_arrays([*pairs, pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.binary())], names)
    at = np.arange(len(rows))
    head, tail = at < REGION, at >= len(rows) - REGION
    ends = np.flatnonzero(head | tail)
    own = pa.array(np.full(len(ends), TaskContext.get().partitionId(), np.int32))
    nothing = [pa.nulls(len(ends), column.type) for column in pairs]
    yield pa.RecordBatch.from_arrays([*nothing, own, pa.array(head[ends]), pa.array(tail[ends]), pa.array([rows[i].tobytes() for i in ends], pa.binary())], names)


def _search_seam(table: pa.Table, best: bool) -> pa.Table:
    rows = _rows_of([pa.array(sorted(table.column("row").to_pylist()), pa.binary())])
    return pa.table(_pairs(candidates(rows, best)), list(PAIR))


def _seams(ranges: list[tuple[int, bool]]) -> list[tuple[int, int, int]]:
    """(range, seam before it, seam after it) for ranges in order; the flag says that all rows are at an end of it."""
    seam, out = 0, []
    for number, short in ranges:
        out.append((number, seam, seam if short else seam + 1))
        seam = out[-1][2]
    return out


def candidate_pairs(classes: DataFrame, store: Store, best: bool) -> DataFrame:
    """``(a, b, agreeing, crowded, low, high)``, each pair once, of the representatives in ``(class_id, n_shingles, minima, component)``.

    Pairs within one component are never written. With ``best``, only the likeliest pairs of each document in each order are, and crowded
    documents as ``(a, a)``.
    """
    spark = classes.sparkSession
    rows = classes.count() * TREES
    ranges = max(1, -(-rows // ROWS_PER_RANGE), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (8 * REGION)))
    forest = classes.mapInArrow(_forest_rows, "row binary").repartitionByRange(ranges, "row").sortWithinPartitions("row")
    searched = store.keep(forest.mapInArrow(partial(_search_range, best=best), f"{_PAIR}, range int, head boolean, tail boolean, row binary"))
    ends = searched.where("row IS NOT NULL")
    order = ends.groupBy("range").agg(F.min(F.col("head") & F.col("tail")).alias("short")).collect()
    pairs = searched.where("row IS NULL").select(*PAIR)
    if order:
        # One entry for each range: a number of the plan's, not of the data's.
        seams = spark.createDataFrame(_seams(sorted((r["range"], r["short"]) for r in order)), "range int, before int, after int")
        tagged = ends.join(F.broadcast(seams), "range")
        at_seams = tagged.where("head").select(F.col("before").alias("seam"), "row").unionByName(tagged.where("tail AND (NOT head OR before <> after)").select(F.col("after").alias("seam"), "row"))
        pairs = pairs.unionByName(at_seams.groupBy("seam").applyInArrow(lambda table: _search_seam(table, best), _PAIR))
    once = pairs.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("agreeing", "crowded", "low", "high")], F.count("*").alias("n"))
    return once.where(f"a <> b OR n >= {CROWDED}").drop("n")


def _confirm(batches):
    last: dict[int, np.ndarray] = {}
    for batch in slices(batches, "text_a", "text_b"):
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        texts = {}
        for ids, column in ((a, "text_a"), (b, "text_b")):
            texts |= dict(zip(ids, as_bytes(batch.column(column))))
        missing = [i for i in texts if i not in last]
        hashes, bounds = word_hashes([texts[i] for i in missing], lower=True)
        sets = {i: last[i] for i in texts if i in last} | {i: shingles(hashes[bounds[k] : bounds[k + 1]]) for k, i in enumerate(missing)}
        linked = []
        for i, j in zip(a, b):
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            linked.append(100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common))
        last = {a[-1]: sets[a[-1]]}
        yield batch.select(["a", "b"]).filter(pa.array(linked))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    of_a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


def _merge(labels: DataFrame, links: DataFrame, store: Store, n: int) -> tuple[DataFrame, DataFrame]:
    """Labels of ``n`` documents after the links, too, count, and ``(component, root)`` of the components that these joined."""
    joined = store.keep(between(links, labels, "component"), n)
    merged = components(joined, store).select(F.col("id").alias("component"), F.col("component").alias("root"))
    merged = store.keep(merged, n)
    return store.keep(labels.join(merged, "component", "left").select("id", F.coalesce("root", "component").alias("component")), n), merged


def _relabel(labels: DataFrame, links: DataFrame, store: Store, n: int) -> DataFrame:
    return _merge(labels, links, store, n)[0]


def linked_components(pairs: DataFrame, between_labels: Callable[[DataFrame], DataFrame], texts: DataFrame, store: Store) -> DataFrame:
    """``(id, component)`` of every document in ``pairs``, after all pairs that matter are confirmed.

    ``pairs`` are the likeliest of each document; ``between_labels`` finds all candidates between the components that these give.
    """
    crowd = pairs.where("a = b").select(F.col("a").alias("id"))
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ends = store.keep(ends)
    n = ends.count()
    if not n:
        return ends.withColumn("component", F.col("id"))
    texts = store.keep(texts.join(ends, texts["doc_id"] == ends["id"], "left_semi").dropDuplicates(["doc_id"]))
    labels = _forest_components(pairs.where("a <> b"), between_labels, ends, n, texts, store)
    if crowd.isEmpty():
        return labels
    return _relabel(labels, store.keep(crowded_links(crowd, labels, texts, store)), store, n)


def _forest_components(likeliest: DataFrame, between_labels: Callable[[DataFrame], DataFrame], ends: DataFrame, n: int, texts: DataFrame, store: Store) -> DataFrame:
    """Steps 4 and 5."""
    best = likeliest.groupBy("b").agg(F.max(F.struct("agreeing", (-F.col("a")).alias("a"))).alias("best"))
    labels = _relabel(ends.withColumn("component", F.col("id")), store.keep(confirmed(best.select((-F.col("best.a")).alias("a"), "b"), texts)), store, n)
    pairs = store.keep(between_labels(labels))
    if pairs.isEmpty():
        return labels
    # From here on it is components that are joined with what became of them; of each two, all pairs are in the same state.
    met = pairs.groupBy("low", "high").agg(F.max(F.struct("agreeing", "a", "b")).alias("best"), F.max("crowded").alias("crowded"), F.count("*").alias("n"))
    met = store.keep(met.select("low", "high", "best.a", "best.b", "crowded", "n"))
    labels, roots = _merge(labels, store.keep(confirmed(met.select("a", "b"), texts)), store, n)
    met = store.keep(_still_apart(met, roots))
    left = pairs.join(met.where("n > 1").select("low", "high", F.col("a").alias("tried_a"), F.col("b").alias("tried_b")), ["low", "high"])
    left = store.keep(left.where("a <> tried_a OR b <> tried_b").select("a", "b"))
    if not left.isEmpty():
        labels, more = _merge(labels, store.keep(confirmed(left, texts)), store, n)
        met = _still_apart(met, more, "root_")
    # What is near a component in a dense region is compared with all of it in the end.
    near = met.where("crowded").select(F.least("root_low", "root_high").alias("low"), F.greatest("root_low", "root_high").alias("high")).distinct()
    near = store.keep(near)
    if near.isEmpty():
        return labels
    return _relabel(labels, store.keep(between_components(near, labels, texts, store)), store, n)


def _still_apart(met: DataFrame, roots: DataFrame, known: str = "") -> DataFrame:
    """The rows of ``met`` whose components (columns ``low`` and ``high`` after ``known``) have different roots, ``root_low`` and ``root_high``."""
    for end in ("low", "high"):
        of_end = roots.select(F.col("component").alias("__component"), F.col("root").alias(f"__{end}"))
        met = met.join(of_end, F.col(f"{known}{end}") == F.col("__component"), "left").drop("__component")
        met = met.withColumn(f"root_{end}", F.coalesce(f"__{end}", f"{known}{end}")).drop(f"__{end}")
    return met.where("root_low <> root_high")


def _least_common(n):
    """How many shingles a set of ``n`` has in common with any that it is linked with, at least."""
    return -(-75 * n // 100)


def _sets(batches):
    """Each slice of the batches and the sets of its documents."""
    for batch in slices(batches, "text"):
        hashes, bounds = word_hashes(as_bytes(batch.column("text")), lower=True)
        yield batch, [shingles(hashes[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]


def _count_shingles(batches):
    for _, sets in _sets(batches):
        found, n = np.unique(np.concatenate(sets), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])


def frequent_shingles(texts: DataFrame, store: Store) -> np.ndarray:
    """The shingles that more than ``RARE`` of the documents hold, sorted; more than that, if they were over ``MOST_FREQUENT``."""
    counts = texts.mapInArrow(_count_shingles, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > RARE)
    counts, least = store.keep(counts), RARE
    while counts.where(F.col("n") > least).count() > MOST_FREQUENT:
        least *= 2
    found = counts.where(F.col("n") > least).select("h").toArrow().column("h").to_numpy()
    return np.sort(found.view(np.uint64))


def crowded_links(crowd: DataFrame, labels: DataFrame, texts: DataFrame, store: Store) -> DataFrame:
    """All links between documents of ``crowd`` that are in different components of ``labels``, by a prefix-filtered join.

    Shingles are ordered: rare ones first, then frequent ones, each by their hash. Linked sets share three quarters of either, so the
    first shingle they share is among the first quarter (and one more) of both.

    * If it is rare, the pair meets at that shingle, where at most ``RARE`` documents meet.
    * If not, they share frequent shingles only, which then make three quarters of both sets, and, as the common part is at least
      3/7 of both sizes, 6/7 of the smaller one. Documents with that much in frequent shingles are near copies of each other and so few
      components, which are compared with all components that they share a first frequent shingle with.
    """
    own = crowd.join(labels, "id").join(texts.select(F.col("doc_id").alias("id"), "text"), "id").select("id", "component", "text")
    # Documents of one component come together, so that a task sends a key once for each component.
    own = store.keep(store.keep(own).repartitionByRange("component", "id"))
    frequent = own.sparkSession.sparkContext.broadcast(frequent_shingles(own.select("id", "text"), store))

    def keys(batches):
        for batch, sets in _sets(batches):
            hashes, row, first = [], [], []
            for k, found in enumerate(sets):
                known = frequent.value
                place = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                often = known[place] == found if len(known) else np.zeros(len(found), bool)
                rare, common, least = found[~often], found[often], _least_common(len(found))
                prefix = rare[: len(found) - least + 1]
                late = common[: max(len(common) - least + 1, 0)]
                hashes += [prefix, late]
                row.append(np.full(len(prefix) + len(late), k))
                # 0: rare; 1: frequent; 2: frequent, of a document that holds hardly anything else
                first += [np.zeros(len(prefix), np.int8), np.full(len(late), 2 if 7 * len(common) >= 6 * len(found) else 1, np.int8)]
            row, hashes, first = np.concatenate(row), np.concatenate(hashes), np.concatenate(first)
            component, ids = batch.column("component").to_numpy()[row], batch.column("id").to_numpy()[row]
            order = np.lexsort((ids, first, component, hashes))
            hashes, component, first = hashes[order], component[order], first[order]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (component[1:] != component[:-1]) | (first[1:] != first[:-1])
            starts = np.flatnonzero(new)
            bounds = pa.array(np.append(starts, len(order)).astype(np.int32))
            size = np.array([len(s) for s in sets])[row]
            lists = [pa.ListArray.from_arrays(bounds, pa.array(values[order])) for values in (ids, size)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[starts].view(np.int64)), pa.array(component[starts]), pa.array(first[starts]), *lists], ["h", "component", "kind", "ids", "sizes"])

    rows = store.keep(own.mapInArrow(keys, "h long, component long, kind byte, ids array<long>, sizes array<long>"))
    frequent.destroy()
    rare = rows.where("kind = 0")
    several = rare.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    rare = rare.join(several, "h", "left_semi").select("h", "component", F.explode(F.arrays_zip("ids", "sizes")).alias("one"))
    rare = store.keep(rare.select("h", "component", F.col("one.ids").alias("id"), F.col("one.sizes").alias("size")))
    one = rare.select("h", *[F.col(c).alias(f"{c}_a") for c in ("id", "component", "size")])
    other = rare.select("h", *[F.col(c).alias(f"{c}_b") for c in ("id", "component", "size")])
    met = one.join(other, "h").where("component_a < component_b AND 100 * least(size_a, size_b) >= 75 * greatest(size_a, size_b)")
    met = store.keep(met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct())
    links = confirmed(met, texts)
    late = rows.where("kind > 0").groupBy("h", "component").agg(F.max("kind").alias("kind"))
    late = store.keep(late)
    full = late.where("kind = 2").select("h", F.col("component").alias("full"))
    near = late.join(full, "h").where("component <> full").select(F.least("component", "full").alias("low"), F.greatest("component", "full").alias("high")).distinct()
    near = store.keep(near)
    if near.isEmpty():
        return links
    return links.unionByName(between_components(near, labels, texts, store, singles=True))


def _meet(members: pa.Table, asking: pa.Table) -> pa.Table:
    a, b = [], []
    if members.num_rows and asking.num_rows:
        hashes, bounds = word_hashes(as_bytes(members.column("text").combine_chunks()), lower=True)
        sets = [shingles(hashes[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
        sizes = np.array([len(s) for s in sets])
        joined, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ids = members.column("id").to_numpy()
        hashes, bounds = word_hashes(as_bytes(asking.column("text").combine_chunks()), lower=True)
        for k, other in enumerate(asking.column("id").to_pylist()):
            own = shingles(hashes[bounds[k] : bounds[k + 1]])
            place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
            common = np.add.reduceat((own[place] == joined).astype(np.int64), starts)
            linked = ids[100 * common >= 75 * (sizes + len(own) - common)].tolist()
            a += [min(other, i) for i in linked]
            b += [max(other, i) for i in linked]
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def between_components(near: DataFrame, labels: DataFrame, texts: DataFrame, store: Store, singles: bool = False) -> DataFrame:
    """All links between the given pairs of components ``(low, high)``, by full sets.

    The members of the larger component are dealt to blocks of about ``BLOCK``, those of all smaller ones near it to blocks of
    about ``ASKING``, and each block of one meets each of the other. Two single documents are left out, as they have been confirmed
    as a pair, unless ``singles`` asks for them.
    """
    sizes = store.keep(labels.groupBy("component").agg(F.count("*").alias("n")), labels.count())
    size = lambda c: sizes.select(F.col("component").alias(c), F.col("n").alias(f"n_{c}"))
    sized = near.join(size("low"), "low").join(size("high"), "high")
    sized = sized if singles else sized.where("n_low > 1 OR n_high > 1")
    larger = F.col("n_low") >= F.col("n_high")
    sides = sized.select(F.when(larger, F.col("low")).otherwise(F.col("high")).alias("asked"), F.when(larger, F.col("high")).otherwise(F.col("low")).alias("component"), F.greatest("n_low", "n_high").alias("n_asked"))
    sides = store.keep(sides)
    n = sides.count()
    asking = store.keep(sides.join(labels, "component").select("asked", "n_asked", "id"))
    grid = asking.groupBy("asked").agg(F.count("*").alias("n_asking"), F.max("n_asked").alias("n_asked"))
    parts = lambda n, each: F.ceil(F.col(n) / each).cast("int")
    grid = store.keep(grid.select("asked", parts("n_asked", BLOCK).alias("blocks"), parts("n_asking", ASKING).alias("turns")), n)
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    text = texts.select(F.col("doc_id").alias("id"), "text")
    members = labels.withColumnRenamed("component", "asked").join(grid, "asked").select("asked", "id", deal("blocks").alias("block"), "turns")
    members = members.join(text, "id").select("asked", "block", every("turns").alias("turn"), "id", "text")
    askers = asking.select("asked", "id").join(grid, "asked").select("asked", "id", deal("turns").alias("turn"), "blocks")
    askers = askers.join(text, "id").select("asked", every("blocks").alias("block"), "turn", "id", "text")
    # The two sides come from the same tables; new names keep Spark from taking their columns for one another's.
    askers = askers.toDF(*[f"{c}_" for c in askers.columns]).select(*[F.col(f"{c}_").alias(c) for c in askers.columns])
    keys = ("asked", "block", "turn")
    return members.groupBy(*keys).cogroup(askers.groupBy(*keys)).applyInArrow(_meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the least ``doc_id`` that links reach, the document's own included; ``kept`` marks the documents
    that have it as their own. A document without id has no component and is kept.
    """
    store = Store(docs.sparkSession, "neardup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = store.keep(signatures(texts))
    classes = signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.max(F.struct("n_shingles", "minima")).alias("one")
    )
    classes = store.keep(classes.select("set_key", "class_id", "one.n_shingles", "one.minima"))
    forest = classes.select("class_id", "n_shingles", "minima")

    def between_labels(labels):
        known = labels.select(F.col("id").alias("class_id"), "component")
        joined = forest.join(known, "class_id", "left").select("class_id", "n_shingles", "minima", F.coalesce("component", "class_id").alias("component"))
        return candidate_pairs(joined, store, best=False)

    pairs = store.keep(candidate_pairs(forest.withColumn("component", F.col("class_id")), store, best=True))
    labels = linked_components(pairs, between_labels, texts, store)
    roots = classes.select("set_key", "class_id").join(labels.withColumnRenamed("id", "class_id"), "class_id", "left")
    roots = roots.select("set_key", F.coalesce("component", "class_id").alias("root"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
