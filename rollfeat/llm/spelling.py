"""Spelling variants: words one edit apart, and the common form that each is a variant of.

**Search, by sorted-list dynamic programming.** A group of words is a sorted list. For each word of it the list is scanned with
an edit matrix banded to three diagonals: a listed word keeps the rows of the prefix it shares with the one before, and when
no entry of a row is below two, all words with that prefix are skipped at once.

**Groups.** Words an edit apart agree before it and after it. Let the edit be where the two words first differ, in the shorter word's
places: it lies in the first or the second half, and the other half is shared. So a word enters one group by each half, once as the
shorter (or equal) word and once as the longer one, and a pair meets in exactly one group. A group of more than
``group_words`` words is halved again, by the part that its words do not share yet, until that part is a single place; such a group
holds at most one word for each pair of letters. So no list outgrows a task, and no pair is lost or found twice.

Defined results: null and empty texts have no words; a document without id counts as one with an empty id; repeated rows count
each time; ties of count are broken by the smaller word in code-point order. An empty table gives no rows. Columns other than ``doc_id``
and ``text`` are not read, whatever they are called. Words of any length are compared whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollfeat.llm.store import Store
from rollfeat.llm.text import A_TO_Z, as_bytes, slices

MIN_LETTERS = 6
MIN_COUNT = 5
MUCH_MORE = 5  # a form occurs at least so many times as often as its variant
GROUP_WORDS = 4_000
# One run in so many loses a letter before it is counted.
DAMAGED = 199
# Counts of at most so many words are kept in a task before they are sent on.
FLUSH = 200_000

_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")  # of lower-cased UTF-8: a to z, and U+00C0 to U+00FF
_LOWER = A_TO_Z.tobytes()
_AFTER_LETTERS = "Ā"
_FAR = 2


def words_of(doc_id: int | None, text: bytes | None, damaged: int = DAMAGED) -> Iterator[tuple[bytes, int]]:
    """The words of a document with their counts, after the deletions that its id decides."""
    own = b"" if doc_id is None else b"%d" % doc_id
    for run, n in Counter(_RUN.findall((text or b"").translate(_LOWER))).items():
        mark = crc32(own + b":" + run)
        if mark % damaged == 0:
            letters = run.decode()
            gone = mark % len(letters)
            run = (letters[:gone] + letters[gone + 1 :]).encode()
        yield run, n


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of all words that are long and common enough."""

    def run(batches):
        counts: Counter = Counter()

        def flushed():
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                for word, n in words_of(doc_id, text):
                    if len(word) >= min_letters:
                        counts[word] += n
            if len(counts) > FLUSH:
                yield flushed()
                counts.clear()
        yield flushed()

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) & (F.length("word") >= min_letters))


# --- one group -------------------------------------------------------------------------------------------------------


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def one_edit_away(word: str, listed: Sequence[str], shared: Sequence[int]) -> Iterator[int]:
    """Places in the sorted list of all words exactly one edit from ``word``; ``shared[i]`` is the length of the prefix that
    words ``i - 1`` and ``i`` have in common."""
    size, n = len(word), len(listed)
    # Row d holds the edits between the first d letters of the listed word and d - 1, d and d + 1 letters of the other.
    rows = [(_FAR, 0, 1 if size else _FAR)] + [(_FAR, _FAR, _FAR)] * (size + 2)
    known = i = 0
    while i < n:
        other = listed[i]
        known = min(known, shared[i])
        end, alive = len(other), True
        while alive and known < end:
            shorter, level, longer = rows[known]
            letter = other[known]
            # The same three distances with one more letter of the listed word; letters beyond the end are out of reach.
            a = min(level + 1, shorter + (word[known - 1] != letter)) if 0 < known <= size else (level + 1 if known == 0 else _FAR)
            b = min(longer + 1, a + 1, level + (word[known] != letter)) if known < size else _FAR
            c = min(b + 1, longer + (word[known + 1] != letter)) if known + 1 < size else _FAR
            known += 1
            rows[known] = (min(a, _FAR), min(b, _FAR), min(c, _FAR))
            alive = a < _FAR or b < _FAR or c < _FAR
        if not alive:
            # The prefix that was read is too far already, and so are all words that begin with it.
            i = bisect_left(listed, other[:known] + _AFTER_LETTERS, i + 1)
            continue
        place = size - end + 1
        if 0 <= place <= 2 and rows[end][place] == 1:
            yield i
        i += 1


def pairs_of_group(shorter: int, start: int, tail: int, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """Pairs of a group in both directions. Its words share the first ``start`` and last ``tail`` letters; those of
    ``shorter`` letters are looked up among all."""
    listed = sorted((word[start : len(word) - tail], word, n) for word, n in members)
    parts = [m[0] for m in listed]
    shared = [0] + [shared_prefix(a, b) for a, b in zip(parts, parts[1:])]
    size = shorter - start - tail
    for part, word, n in listed:
        if len(part) != size:
            continue
        for i in one_edit_away(part, parts, shared):
            other, m = listed[i][1:]
            # What the words share beyond the group's start decides the group: pairs that differ later only belong elsewhere.
            if tail and start + shared_prefix(part, listed[i][0]) >= shorter - tail:
                continue
            yield word, n, other, m
            if len(other) > shorter:
                yield other, m, word, n


# --- all groups ------------------------------------------------------------------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the group of either half of the part that its group does not share yet."""
    middle = F.col("shorter") - F.col("start") - F.col("tail")
    half = F.floor(middle / 2).cast("int")
    edit_late = F.struct((F.col("start") + half).alias("start"), F.col("tail").alias("tail"))
    edit_early = F.struct(F.col("start").alias("start"), (F.col("tail") + middle - half).cast("int").alias("tail"))
    return _keyed(rows.select("word", "n", "shorter", F.inline(F.array(edit_late, edit_early))))


def _keyed(rows: DataFrame) -> DataFrame:
    ending = F.when(F.col("tail") > 0, F.expr("right(word, tail)")).otherwise("")
    key = F.concat_ws(":", "shorter", "start", "tail", F.expr("left(word, start)"), ending)
    return rows.select("word", "n", "shorter", "start", "tail", key.alias("key"))


def near_words(words: DataFrame, store: Store, min_letters: int = MIN_LETTERS, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, n, near, near_n`` of all pairs, in both directions."""
    size = F.length("word")
    roles = F.filter(F.array(size, size - 1), lambda s: s >= min_letters)
    rows = words.select("word", "n", F.explode(roles).alias("shorter")).select("*", F.lit(0).alias("start"), F.lit(0).alias("tail"))
    rows = store.keep(_halves(rows))
    done = []
    longest = rows.agg(F.max("shorter")).first()[0] or 0
    for _ in range(max(longest, 1).bit_length()):
        sizes = rows.where(F.col("shorter") - F.col("start") - F.col("tail") > 1).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
        crowded = store.keep(sizes.where(F.col("rows") > group_words).select("key"))
        if crowded.isEmpty():
            break
        done.append(rows.join(crowded, "key", "left_anti"))
        rows = store.keep(_halves(rows.join(crowded, "key", "left_semi")))
    for part in done:
        rows = rows.unionByName(part)

    def run(batches):
        def scanned(group):
            return pairs_of_group(*group[0][1:], group[1])

        def batch_of(pairs):
            columns = list(zip(*pairs)) if pairs else [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["word", "n", "near", "near_n"])

        group, pairs = None, []
        for batch in batches:
            for key, shorter, start, tail, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "shorter", "start", "tail", "word", "n"))):
                if group is None or group[0][0] != key:
                    if group is not None and len(group[1]) > 1:
                        pairs += scanned(group)
                    group = ((key, shorter, start, tail), [])
                group[1].append((word, n))
            if len(pairs) > 10_000:
                yield batch_of(pairs)
                pairs = []
        if group is not None and len(group[1]) > 1:
            pairs += scanned(group)
        yield batch_of(pairs)

    together = rows.repartition("key").sortWithinPartitions("key", "word").select("key", "shorter", "start", "tail", "word", "n")
    return together.mapInArrow(run, "word string, n long, near string, near_n long")


def _follow(links: DataFrame, most: int, store: Store) -> DataFrame:
    """``word, root``: the last word of the chain from each word that has a form. Every form is ``MUCH_MORE`` times as common as
    its variant, so the most common word bounds the length of a chain; each round doubles the way."""
    at = links.select("word", F.col("form").alias("root"))
    longest = max(1, math.ceil(math.log(max(most, MUCH_MORE), MUCH_MORE)))
    for _ in range(longest.bit_length()):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = store.keep(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return at


def variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    store = Store(docs.sparkSession, "spelling")
    words = store.keep(vocabulary(docs, min_letters, min_count))
    near = near_words(words, store, min_letters, group_words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    common = -F.col("best.less") >= MUCH_MORE * F.col("n")
    joined = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.less")).alias("form_n"),
    )
    joined = store.keep(joined)
    links = joined.where("form IS NOT NULL").select("word", "form")
    roots = _follow(links, words.agg(F.max("n")).first()[0] or 0, store)
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
