"""Licence notices in whole texts: exact phrases, and short notices with a few edits.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null is empty. Base phrases are places
where a phrase's words stand consecutively. Notices are searched in the words joined by single spaces, with up to one edit (a
character put in, left out or changed) for every ten characters, three at most: a notice with ``e`` edits is cut into
``e + 1`` pieces, one of which any occurrence must hold unchanged. Where a piece is found, the notice is matched with bounded errors,
between word ends, in a window of its own: as many characters as the notice has, and the edits on either side. So the work grows with
the number of pieces found, whatever the length of a text or of its words. Of overlapping matches of one notice the one with fewer edits
stays, then the first. Matches are reported with label, place in words, place in the joined text (code points, end exclusive)
and number of edits.

``score`` is 1 for an exact phrase or notice, else the best match's share of unchanged characters, 0 without any. Texts that are null or
hold no word have no matches and score 0; repeated rows keep their results; an empty table gives an empty one. Columns of
the input that are named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.llm.text import as_bytes, slices

# Phrases and their labels, and public notices.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "dedicated to the public domain": "public-domain",
    "released into the public domain": "public-domain",
}

_TO_WORDS = bytes(32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def allowed_edits(notice: str) -> int:
    return min(3, (len(notice) - 2) // 10)


@cache
def searchers() -> list[tuple[str, str, int, list[tuple[int, str]], regex.Pattern]]:
    """For each notice: its text, label, edits, pieces with their places, and the pattern that verifies."""
    out = []
    for notice, label in NOTICES.items():
        edits = allowed_edits(notice)
        cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
        pieces = [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?= )")
        out.append((notice, label, edits, pieces, pattern))
    return out


def to_words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class Joined:
    """Words joined by single spaces, with a space at either end; places count from the first word."""

    def __init__(self, words: list[bytes]):
        self.padded = b" ".join([b"", *words, b""]).decode() if words else " "

    @cached_property
    def _spaces(self) -> np.ndarray:
        return np.flatnonzero(np.frombuffer(self.padded.encode("utf-32-le"), np.uint32) == 32)

    def words_before(self, places: list[int]) -> list[int]:
        return (np.searchsorted(self._spaces, np.array(places, np.int64) + 1) - 1).tolist()

    def find_all(self, part: str) -> Iterator[int]:
        """Places of all occurrences of a part, overlapping ones included."""
        at = self.padded.find(part)
        while at >= 0:
            yield at - 1
            at = self.padded.find(part, at + 1)


def base_places(joined: Joined) -> list[tuple[int, str]]:
    """(place in words, label) of every base phrase."""
    found = [(at + 1, label) for phrase, label in BASE_PHRASES.items() for at in joined.find_all(f" {phrase} ")]
    return list(zip(joined.words_before([at for at, _ in found]), [label for _, label in found])) if found else []


@lru_cache(maxsize=65_536)
def _best_match(number: int, window: str) -> tuple[int, int, int] | None:
    """Start, end and edits of the best match of a notice in a window; texts that repeat themselves repeat their windows."""
    m = searchers()[number][4].search(window)
    return m and (m.start(), m.end(), sum(m.fuzzy_counts))


def notices(joined: Joined) -> list[tuple[str, int, int, int, int]]:
    """(label, word, start, end, edits) of every notice found."""
    out = []
    for number, (notice, label, edits, pieces, _) in enumerate(searchers()):
        found = set()
        for offset, piece in pieces:
            for at in joined.find_all(piece):
                # One character more on either side, which the match must find to be a space.
                left = max(at - offset - edits, 0)
                match = _best_match(number, joined.padded[left : at - offset + len(notice) + edits + 2])
                if match:
                    found.add((left - 1 + match[0], left - 1 + match[1], match[2]))
        kept: list[tuple[int, int, int]] = []
        for m in sorted(found):
            if not kept or m[0] >= kept[-1][1]:
                kept.append(m)
            elif m[2] < kept[-1][2]:
                kept[-1] = m
        out += [(label, *m) for m in kept]
    words = joined.words_before([m[1] for m in out]) if out else []
    return sorted(((label, word, start, end, edits) for (label, start, end, edits), word in zip(out, words)), key=lambda m: (m[2], m[3], m[0], m[4]))


_SPANS = T.ArrayType(
    T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())])
)
_ADDED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", _SPANS)]
)
_ARROW = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))]


def scan_text(text: bytes | None) -> tuple:
    found = to_words(text)
    joined = Joined(found)
    base = base_places(joined)
    fuzzy = notices(joined)
    base_labels = {label for _, label in base}
    labels = base_labels | {m[0] for m in fuzzy}
    score = 1.0 if base else max((1 - m[4] / max(m[3] - m[2], m[4], 1) for m in fuzzy), default=0.0)
    spans = [dict(zip(("label", "word", "start", "end", "edits"), m)) for m in fuzzy]
    places = [p for p, _ in base]
    return len(found), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, spans


def scan(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, and what was found."""
    new = [f.name for f in _ADDED]
    own = [c for c in docs.columns if c not in new]
    schema = T.StructType([docs.schema[c] for c in own] + list(_ADDED))

    def run(batches):
        for batch in slices(batches, "text"):
            rows = [scan_text(t) for t in as_bytes(batch.column("text"))]
            added = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *added], [*own, *new])

    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, schema)
