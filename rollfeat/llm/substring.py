"""Remove passages that an earlier document holds too.

A window is ``WIDTH`` consecutive words of one document. Words are removed if a window that covers them also starts in a
document with a smaller ``doc_id``; every window is judged on the input.

1. *Sketch.* Every window is represented by the least hash among the word 8-grams it holds. A document adds each of its
   representatives once to the cells of a count-min sketch, in several rows with hashes of their own. Tasks emit the
   cells they hit, cells are merged by block, and what remains is one bit for each cell: hit by two documents or more.
   Equal windows have equal representatives, so the estimate of a window is never below the number of documents with it.
2. *Exact pass.* Windows estimated at two documents or more become rows keyed by a 96-bit hash of the window. Where a
   task holds a window in several documents, it settles all but the first of them itself, so that a key has at most a
   few rows per task, however many documents share a passage. The least ``doc_id`` of each key settles the rest.
3. Positions go back to their documents, and words are dropped.

The sketch has about eight bits for each expected representative, up to ``most_bits`` (a bound of the broadcast:
``most_bits / 8`` bytes). Beyond it more windows are estimated as repeated and the exact pass gets more rows; the result
is the same.

Null text has no words. Documents without ``doc_id`` neither remove nor lose words. Rows that repeat a ``doc_id`` do not
count as earlier than each other. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.llm.text import as_bytes, constants, grams, mix, slices, word_hashes, words

WIDTH = 13
GRAM = 8
ROWS = 3
BLOCK_BITS = 16
MOST_BITS = 1 << 31
FLUSH = 400_000

_WINDOW = (constants("window a", WIDTH), constants("window b", WIDTH))
_GRAM = constants("window gram", GRAM)
_ROW = constants("sketch row", ROWS)


def representatives(hashes: np.ndarray) -> np.ndarray:
    """For every window of a document, the least hash of the word 8-grams in it."""
    inner = grams(hashes, _GRAM)
    n = len(hashes) - WIDTH + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    least = inner[:n].copy()
    for i in range(1, WIDTH - GRAM + 1):
        np.minimum(least, inner[i : i + n], out=least)
    return least


def cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(values * _ROW[row]) >> np.uint64(64 - bits)


def _documents(batches, columns=("doc_id",)) -> Iterator[tuple]:
    """(values of the columns, hashes of the words) of every document that has an id."""
    for batch in slices(batches, "text"):
        hashes, bounds = word_hashes(as_bytes(batch.column("text")))
        values = [batch.column(c).to_pylist() for c in columns]
        for i in range(batch.num_rows):
            if values[0][i] is not None:
                yield tuple(v[i] for v in values), hashes[bounds[i] : bounds[i + 1]]


def sketch(docs: DataFrame, bits: int) -> DataFrame:
    """Blocks of the merged sketch: ``(block, cells)``, a bit for each cell that two documents or more hit."""

    def emit(gathered: list[np.ndarray]):
        values = np.concatenate(gathered)
        blocks, once, twice = [], [], []
        for row in range(ROWS):
            at, counts = np.unique(cells(values, row, bits), return_counts=True)
            block = (at >> np.uint64(BLOCK_BITS)).astype(np.int64)
            offset = (at & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u2")
            edges = np.flatnonzero(np.diff(block)) + 1
            for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(at)]))):
                blocks.append((row << (bits - BLOCK_BITS)) + int(block[a]))
                several = counts[a:b] > 1
                once.append(offset[a:b][~several].tobytes())
                twice.append(offset[a:b][several].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])

    def collect(batches):
        gathered, size = [], 0
        for _, hashes in _documents(batches):
            found = representatives(hashes)
            if len(found):
                gathered.append(np.unique(found))
                size += len(gathered[-1])
            if size >= FLUSH:
                yield emit(gathered)
                gathered, size = [], 0
        if gathered:
            yield emit(gathered)

    def merge(batches):
        """Rows come sorted by block."""
        current, counts = None, None
        done: list[tuple[int, bytes]] = []

        def finish():
            if current is not None:
                done.append((current, np.packbits(counts >= 2).tobytes()))

        for batch in batches:
            for block, once, twice in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice"))):
                if block != current:
                    finish()
                    current, counts = block, np.zeros(1 << BLOCK_BITS, np.int32)
                counts[np.frombuffer(once, "<u2")] += 1
                counts[np.frombuffer(twice, "<u2")] += 2
            if done:
                yield _blocks(done)
                done = []
        finish()
        if done:
            yield _blocks(done)

    hits = docs.select("doc_id", "text").mapInArrow(collect, "block long, once binary, twice binary")
    return hits.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, cells binary")


def _blocks(done):
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in done], pa.int64()), pa.array([c for _, c in done], pa.binary())], ["block", "cells"])


def sketch_bits(docs: DataFrame, most_bits: int) -> int:
    """Bits of a cell's number in one row. A representative comes about every twenty bytes and gets eight bits in all."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    row = min(max(size * 8 // 20, 1), most_bits) // ROWS
    # Never more than the bound, except where that is below one block.
    return max(BLOCK_BITS, min(int(row).bit_length(), (most_bits // ROWS).bit_length() - 1))


def repeated_windows(docs: DataFrame, table: np.ndarray, bits: int) -> DataFrame:
    """``(doc_id, copy, starts)``: starts of windows that a smaller ``doc_id`` holds too, as packed 32-bit numbers.

    ``copy`` is a hash of the text, which tells rows with one ``doc_id`` apart.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)
    schema = "h1 long, h2 int, doc_id long, copy long, start int, settled binary, more binary"

    def hit(values: np.ndarray) -> np.ndarray:
        seen = np.ones(len(values), bool)
        for row in range(ROWS):
            at = cells(values, row, bits) + np.uint64(row << bits)
            bit = shared.value[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))
            seen &= (bit & 1).astype(bool)
        return seen

    def emit(gathered):
        h1, h2, start, number = (np.concatenate(x) for x in list(zip(*gathered))[:4])
        ids = np.array([g[4] for g in gathered], np.int64)
        copies = np.array([g[5] for g in gathered], np.int64)
        row = np.repeat(np.arange(len(gathered)), [len(g[0]) for g in gathered])
        doc = ids[row]
        order = np.lexsort((doc, h2, h1))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        # In the order of the texts, in which rows compress well.
        first = np.empty_like(doc)
        first[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        open_ = doc == first
        yield _first_windows(h1[open_], h2[open_], doc[open_], copies[row[open_]], start[open_], row[open_])
        rest = ~open_
        if rest.any():
            by = np.lexsort((start[rest], row[rest]))
            row, start = row[rest][by], start[rest][by]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1, [len(row)]))
            packed = [start[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])]
            owner = row[edges[:-1]]
            # A key of their own lets settled rows pass through the grouping below.
            yield _windows(mix(ids[owner].view(np.uint64)), copies[owner].view(np.uint64), ids[owner], copies[owner], np.full(len(owner), -1, np.int32), packed)

    def find(batches):
        gathered, size = [], 0
        for (doc_id, copy), hashes in _documents(batches, ("doc_id", "copy")):
            found = representatives(hashes)
            if not len(found):
                continue
            at = np.flatnonzero(hit(found))
            if not len(at):
                continue
            gathered.append((grams(hashes, _WINDOW[0])[at], grams(hashes, _WINDOW[1])[at], at.astype(np.int32), np.full(len(at), 0, np.int8), doc_id, copy))
            size += len(at)
            if size >= FLUSH:
                yield from emit(gathered)
                gathered, size = [], 0
        if gathered:
            yield from emit(gathered)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("copy")).mapInArrow(find, schema)
    first = F.expr("min(CASE WHEN settled IS NULL THEN doc_id END) OVER (PARTITION BY h1, h2)")
    later = rows.withColumn("first", first).where("settled IS NOT NULL OR first < doc_id")
    return later.groupBy("doc_id", "copy").agg(
        F.collect_list(F.when(F.col("settled").isNull(), F.col("start"))).alias("starts"), F.collect_list(F.coalesce("settled", "more")).alias("settled")
    )


def _first_windows(h1, h2, doc, copy, start, row):
    """One row for each window of a row, in the order of the texts; where the row repeats it, the other starts go along packed."""
    by = np.lexsort((start, row, h2, h1))
    new = np.ones(len(by), bool)
    new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1]) | (row[by][1:] != row[by][:-1])
    heads = np.flatnonzero(new)
    n = np.diff(np.concatenate((heads, [len(by)])))
    more = [start[by[a + 1 : a + m]].astype("<i4").tobytes() if m > 1 else None for a, m in zip(heads.tolist(), n.tolist())]
    at = by[heads]
    in_text = np.argsort(at)
    at = at[in_text]
    return _windows(h1[at], h2[at], doc[at], copy[at], start[at], None, [more[i] for i in in_text.tolist()])


def _windows(h1, h2, doc, copy, start, settled, more=None):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(h1).view(np.int64)), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(doc), pa.array(copy), pa.array(start.astype(np.int32)), *(pa.array(x, pa.binary()) if x is not None else pa.nulls(len(doc), pa.binary()) for x in (settled, more))],
        ["h1", "h2", "doc_id", "copy", "start", "settled", "more"],
    )


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words the windows at ``starts`` cover."""
    change = np.zeros(n + WIDTH + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WIDTH, -1)
    return np.cumsum(change)[:n] > 0


def remove_repeats(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """All columns of ``docs``, and ``n_words``, ``n_removed`` and ``kept_text`` (the kept words, one space between)."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = sketch_bits(texts, most_bits)
    table = np.zeros(ROWS << (bits - 3), np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    for block in sketch(texts, bits).toLocalIterator():  # one partition of blocks at a time
        table[block.block * size : (block.block + 1) * size] = np.frombuffer(block.cells, np.uint8)
    found = repeated_windows(texts, table, bits)

    own = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in own], F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.col("text").cast("string")).alias("__copy"))
    found = found.select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), F.col("starts").alias("__starts"), F.col("settled").alias("__settled"))
    joined = keyed.join(found, ["__id", "__copy"], "left").drop("__id", "__copy")
    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def rewrite(batches):
        for batch in slices(batches, "text"):
            n_words, n_removed, kept_text = [], [], []
            columns = (as_bytes(batch.column("text")), batch.column("__starts").to_pylist(), batch.column("__settled").to_pylist())
            for text, starts, settled in zip(*columns):
                own_words = words(text)
                kept = own_words
                if starts or settled:
                    at = np.concatenate([np.array(starts or [], np.int64), *(np.frombuffer(s, "<i4") for s in settled or [])])
                    gone = covered(len(own_words), at.astype(np.int64))
                    kept = [w for w, g in zip(own_words, gone.tolist()) if not g]
                n_words.append(len(own_words))
                n_removed.append(len(own_words) - len(kept))
                kept_text.append(b" ".join(kept).decode())
            kept_columns = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*kept_columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept_text, pa.string())], [*own, "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(rewrite, schema)
