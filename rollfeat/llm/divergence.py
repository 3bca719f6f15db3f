"""How far the sources of a language are apart in their words, exactly.

**Counting, by a token-start pointer sort.** A task reads texts as Arrow buffers and never cuts words out of them. It keeps
a pointer to the start of each word, ordered by group (language and source) and row, and sorts the pointers by the bytes
they point to with a multikey quicksort: eight bytes are one character, a large slice is parted in three around a
pivot, the middle part moves on by eight bytes, and small slices are finished by one stable sort a character. Pointers to
equal words end up side by side and in their old order, so one pass over a run gives its occurrences and its rows by group.

**Comparing.** Counts are added up on Spark. A language keeps the terms of at least ``min_docs`` rows. Groups are compared in cells
of a block of terms and two blocks of sources: a cell is a matrix of bounded size whatever a language holds, and gives one
partial sum a pair. Terms that a cell has no row of add the same for every pair and are added at the end.

Defined results: null text, language and source are empty strings, so rows without them form groups like any other; every row counts as
a document, repeated rows too; a group without kept terms has N = 0; a language without kept terms gives pairs at distance 0 and no terms.
Ties of value are ordered by the item's bytes. Columns other than the three read are not looked at, whatever they are called.
An empty table gives no rows. Texts of any length are sorted whole: a row is never cut.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollfeat.llm.store import Store
from rollfeat.llm.text import A_TO_Z, slices

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
UNIT = 1_000_000_000
# A cell holds about so many terms, and two blocks of about so many sources.
TERM_BLOCK = 4_096
SOURCE_BLOCK = 128
# Bytes of text whose pointers are sorted together, unless a single row is longer.
SLICE_BYTES = 8_000_000
# Slices of at most so many pointers are finished without further parting.
SMALL = 4_096

# Bytes of words: letters, and all of every character beyond ASCII.
IN_WORD = np.zeros(256, bool)
IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True


def word_pointers(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and how long they are. ``row_starts`` are the places at which a new row begins."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = IN_WORD[data]
    new_row = np.zeros(len(data) + 1, bool)
    new_row[row_starts] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | new_row[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | new_row[1:-1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1 - at


def _character(padded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each word as one number, zeros behind the word's end. Words hold no zero byte."""
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.minimum(at, len(padded) - 8)]
    key = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)
    spare = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
    half = spare >> np.uint64(1)  # a shift by 64 is not defined, two by 32 are
    return (key >> half >> (spare - half)) << half << (spare - half)


def sort_pointers(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """A stable multikey quicksort of the words at ``at``: their order, and where in it each run of equal words starts."""
    n = len(at)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    order = np.arange(n)
    key = _character(padded, at, sizes)
    first = np.zeros(n + 1, bool)
    first[[0, n]] = True
    ends_here = np.uint64(0xFF)  # a character whose last byte is zero ends its word

    def deeper(rows, depth):
        return _character(padded, at[rows] + depth, sizes[rows] - depth)

    todo = [(0, n, 0)] if n else []
    while todo:
        lo, hi, depth = todo.pop()
        mine, keys = order[lo:hi], key[lo:hi]
        if hi - lo > small:
            sample = np.sort(keys[:: max(1, (hi - lo) // 9)])
            pivot = sample[len(sample) // 2]
            below, level = keys < pivot, keys == pivot
            above = ~(below | level)
            parts = [np.flatnonzero(p) for p in (below, level, above)]
            moved = np.concatenate(parts)
            order[lo:hi], key[lo:hi] = mine[moved], keys[moved]
            a, b = lo + len(parts[0]), lo + len(parts[0]) + len(parts[1])
            first[a] = first[b] = True
            if a > lo:
                todo.append((lo, a, depth))
            if hi > b:
                todo.append((b, hi, depth))
            if pivot & ends_here:
                key[a:b] = deeper(order[a:b], depth + 8)
                todo.append((a, b, depth + 8))
            continue
        # Few pointers: sorted by one character after the other, all equal runs at once.
        run = np.zeros(hi - lo, np.int64)
        active = np.arange(hi - lo)
        while len(active):
            by = np.lexsort((keys[active], run[active]))
            mine[active], keys[active] = mine[active][by], keys[active][by]
            changed = (np.diff(keys[active]) != 0) | (np.diff(run[active]) != 0)
            first[lo + active[1:][changed]] = True
            numbers = np.concatenate(([0], np.cumsum(changed)))
            again = (np.bincount(numbers)[numbers] > 1) & ((keys[active] & ends_here) != 0)
            run[active] = numbers
            active = active[again]
            depth += 8
            keys[active] = deeper(mine[active], depth)
    return order, np.flatnonzero(first)[:-1] if n else np.empty(0, np.int64)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and where its rows begin (one more at the end), without a copy."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def count_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and rows of every term by language and source, and a row without term for each group."""
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    n_sources = len(sources.dictionary)
    groups, group = np.unique(langs.indices.to_numpy() * np.int64(n_sources) + sources.indices.to_numpy(), return_inverse=True)
    data, bounds = _bytes_of(batch.column("text"))
    data = A_TO_Z[data]
    at, sizes = word_pointers(data, bounds)
    row = np.searchsorted(bounds, at, "right") - 1
    by_group = np.argsort(group[row], kind="stable")
    at, sizes, row = at[by_group], sizes[by_group], row[by_group]
    order, runs = sort_pointers(data, at, sizes)
    run_of = np.zeros(len(order), np.int64)
    run_of[runs[1:]] = 1
    run_of = np.cumsum(run_of)
    sorted_row, sorted_group = row[order], group[row[order]]
    new_run = np.diff(run_of, prepend=-1) != 0
    new_cell = new_run | (np.diff(sorted_group, prepend=-1) != 0)
    new_doc = new_cell | (np.diff(sorted_row, prepend=-1) != 0)
    cells = np.flatnonzero(new_cell)
    n = np.diff(np.concatenate((cells, [len(order)])))
    docs = np.add.reduceat(new_doc.astype(np.int64), cells) if len(cells) else np.empty(0, np.int64)

    # The words themselves, once each, from the first pointer of their run.
    head = order[runs]
    ends = np.cumsum(sizes[head])
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[head] - (ends - sizes[head]), sizes[head])
    words = pa.Array.from_buffers(pa.large_string(), len(head), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64)), pa.py_buffer(data[places])])
    terms = words.take(pa.array(run_of[cells])).cast(pa.string())

    cell_group = np.concatenate((sorted_group[cells], np.arange(len(groups))))
    lang = langs.dictionary.take(pa.array(groups[cell_group] // n_sources))
    source = sources.dictionary.take(pa.array(groups[cell_group] % n_sources))
    empty = np.zeros(len(groups), np.int64)
    return pa.RecordBatch.from_arrays(
        [lang, source, pa.concat_arrays([terms, pa.nulls(len(groups), pa.string())]), pa.array(np.concatenate((n, empty))), pa.array(np.concatenate((docs, empty)))],
        ["lang", "source", "term", "n", "docs"],
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of all texts; each group also has a row without term."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches):
        for batch in slices(batches, "text", most=SLICE_BYTES):
            yield count_slice(batch)

    counted = read.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (n + 5) / (total + 5 * kept))``, exactly; null where no term is kept."""
    wide = "decimal(20,0)"
    above = (n + SMOOTHING).cast(wide) * F.lit(Decimal(UNIT))
    below = F.nullif((total + kept * SMOOTHING).cast(wide), F.lit(Decimal(0)))
    # Whole quotient of whole numbers: the remainder is taken off first, so nothing is rounded.
    return ((above - above % below) / below).cast("long") + 1


def _pairs_of_cell(table: pa.Table) -> pa.Table:
    """For each pair of sources of the two blocks: how much its distance over this cell's terms differs from what as many terms
    without occurrences would give."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    marks = table.filter(table.column("term").is_null())
    names, block, kept = marks.column("source").to_pylist(), marks.column("block").to_numpy(), marks.column("kept")[0].as_py()
    floor = marks.column("p").fill_null(0).to_numpy()
    rows = table.filter(table.column("term").is_valid())
    terms = rows.column("term").combine_chunks().dictionary_encode()
    place = {name: i for i, name in enumerate(names)}
    sources = rows.column("source").combine_chunks().dictionary_encode()
    of_source = np.array([place[s] for s in sources.dictionary.to_pylist()], np.int64)
    shares = np.repeat(floor[:, None], len(terms.dictionary), axis=1)
    if rows.num_rows:
        shares[of_source[sources.indices.to_numpy()], terms.indices.to_numpy()] = rows.column("p").to_numpy()
    above, below = np.flatnonzero(block == left), np.flatnonzero(block == right)
    a, b, apart, extra = [], [], [], []
    for i in above:
        others = below[below > i] if left == right else below
        gap = np.abs(floor[others] - floor[i])
        a.append(np.full(len(others), i))
        b.append(others)
        apart.append(gap)
        extra.append(np.abs(shares[others] - shares[i]).sum(1) - gap * shares.shape[1])
    a, b, apart, extra = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (a, b, apart, extra))
    known = pa.array(names, pa.string())
    lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "a": known.take(pa.array(a)), "b": known.take(pa.array(b)), "kept": pa.array(np.full(len(a), kept, np.int64)), "apart": apart, "extra": extra})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, term_block: int = TERM_BLOCK, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the other sources, and the terms a source has more than its language."""
    store = Store(docs.sparkSession, "divergence")
    counts = store.keep(term_counts(docs))
    per_term = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept_terms = per_term.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n")
    kept = store.keep(counts.join(kept_terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))

    # One row a group, also for groups without kept terms.
    of_lang = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    sources = counts.where("term IS NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = groups.join(sources, "lang").select(
        "lang", "source", "sources", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "kept", "lang_total")]
    )
    groups = store.keep(groups)

    p = _share(F.col("n"), F.col("total"), F.col("kept"))
    shared = kept.join(groups, ["lang", "source"]).select("*", p.alias("p"))

    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shared.select("lang", "source", F.col("term").alias("item"), (F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).alias("value"))
    terms = above.where("value > 0").select("*", F.row_number().over(own).alias("rank")).where(F.col("rank") <= top_terms)

    # Every term block of a language holds a row without term for each of its groups.
    n_blocks = F.greatest(F.ceil(F.col("kept") / term_block), F.lit(1)).cast("int")
    n_sources = F.ceil(F.col("sources") / source_block).cast("int")
    marks = groups.select("*", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("cell"), F.lit(None).cast("string").alias("term"), _share(F.lit(0), F.col("total"), F.col("kept")).alias("p"))
    columns = ["lang", "source", "term", "p", "kept", "sources", "cell"]
    rows = shared.select("*", F.pmod(F.xxhash64("term"), n_blocks).cast("int").alias("cell")).select(*columns).unionByName(marks.select(*columns))
    block = F.pmod(F.xxhash64("source"), n_sources).cast("int")
    rows = rows.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), n_sources - 1)).alias("other"))
    rows = rows.select("lang", "source", "term", "p", "kept", "cell", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    parts = rows.groupBy("lang", "cell", "left", "right").applyInArrow(_pairs_of_cell, "lang string, a string, b string, kept long, apart long, extra long")
    apart = parts.groupBy("lang", "a", "b", "kept", "apart").agg(F.sum("extra").alias("extra")).select("lang", "a", "b", (F.col("kept") * F.col("apart") + F.col("extra")).alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = apart.select("lang", "value", F.inline(both)).select("lang", "source", "item", "value", F.row_number().over(own).alias("rank"))

    def part(name, df):
        return df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))

    return part("pair", pairs).unionByName(part("term", terms))
