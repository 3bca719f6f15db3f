"""Language of whole texts by cross-parsing against labelled text.

For each language a suffix automaton of some labelled text is built. A text is parsed greedily against each: a phrase is
the longest match from its first letter on, anywhere in the labelled text, and a letter that no match can begin with is
a phrase of its own. The language that needs the fewest phrases wins, where a phrase weighs the logarithm of the
labelled text's length (the bits that point to a place in it).

Texts are lower-cased; every run of other characters than letters is one separator. They are parsed in lanes of
``LANE`` characters, so that tasks can advance thousands of lanes together; a long text is several lanes.

Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was learned. Ties go to the
first language in order. Rows with null text or language teach nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.llm.text import slices

UNDETERMINED = "und"
SAMPLE_CHARS = 40_000
PIECE = 100
MODEL_BYTES = 64_000_000
MOST_LANGUAGES = 1_000
MOST_LETTERS = 254
LANE = 1024

_RARE, _SEPARATOR = 0, 1


@dataclass(frozen=True)
class LanguageModel:
    """``parsers[i]`` is the automaton of ``languages[i]``: for (state, letter) twice the next state's row, odd if a phrase ends."""

    languages: list[str]
    letters: np.ndarray
    width: int
    parsers: list[np.ndarray]
    weights: list[float]


def letter_table(alphabet: list[str]) -> np.ndarray:
    """The class of every code point: separator, rare letter, or a number for a letter of the alphabet."""
    table = np.fromiter((_RARE if chr(i).isalpha() else _SEPARATOR for i in range(0x110000)), np.uint8, 0x110000)
    for number, letter in enumerate(alphabet, 2):
        table[ord(letter)] = number
    return table


def letters_of(text: str, table: np.ndarray) -> np.ndarray:
    found = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != _SEPARATOR) | (found[:-1] != _SEPARATOR)
    return found[keep]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the least automaton that reads exactly the substrings of ``text``, from state 0."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for letter in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and letter not in moves[at]:
            moves[at][letter] = new
            at = link[at]
        if at >= 0:
            target = moves[at][letter]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                twin = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(letter) == target:
                    moves[at][letter] = twin
                    at = link[at]
                link[target] = link[new] = twin
        last = new
    return moves


def parser(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """The automaton as a table that restarts by itself where no move is left. A letter that no match begins with leads to
    a last state, from which every letter restarts."""
    start = np.full(width, len(moves), np.int32)
    for letter, state in moves[0].items():
        start[letter] = state
    table = np.tile(start * np.int32(2 * width) + np.int32(1), (len(moves) + 1, 1))
    for state, own in enumerate(moves):
        if own:
            table[state, list(own)] = np.fromiter(own.values(), np.int32, len(own)) * np.int32(2 * width)
    return table.ravel()


def fit(labelled: DataFrame, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Learn from the columns ``text`` and ``lang``.

    ``sample_chars`` bounds the text learned from, by language: distinct lines of distinct texts in the order of a hash.
    About four times that much, or forty texts, comes to the driver. Labelled text also holds lines in other languages; each half
    of the lines is judged by automata of the other half, and only lines found to be in their language are learned.
    With many languages or a large alphabet the bound is lowered, so that the model, which is broadcast, stays below
    ``MODEL_BYTES``.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("hash"))
    distinct = rows.select("lang", "hash", F.length("text").alias("n")).groupBy("lang", "hash").agg(F.max("n").alias("n"))
    totals = distinct.groupBy("lang").agg(F.sum("n").alias("chars"), F.count("*").alias("texts")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in the labels")
    if not totals:
        return LanguageModel([], letter_table([]), 2, [], [])
    bound = F.lit(None).cast("double")
    for t in totals:
        share = min(1.0, max(4 * sample_chars / max(t["chars"], 1), 40 / t["texts"]))
        bound = F.when(F.col("lang") == t["lang"], F.lit(-(2.0**63) + share * 2.0**64)).otherwise(bound)
    picked = rows.where(F.col("hash") <= bound).groupBy("lang", "hash").agg(F.min("text").alias("text")).collect()
    pieces: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["hash"])):
        own = pieces.setdefault(r["lang"], [])
        for line in r["text"].split("\n"):
            own.extend(line[at : at + PIECE] for at in range(0, len(line), PIECE))
    pieces = {k: list(dict.fromkeys(v)) for k, v in sorted(pieces.items())}
    halves = [_build({k: v[i::2] for k, v in pieces.items()}, sample_chars // 2) for i in (0, 1)]
    clean = {}
    for language, own in pieces.items():
        found = [""] * len(own)
        for i in (0, 1):
            found[i::2] = [lang for lang, _, _ in judge(own[i::2], halves[1 - i])]
        clean[language] = [piece for piece, lang in zip(own, found) if lang == language] or own
    return _build(clean, sample_chars)


def _build(pieces: dict[str, list[str]], sample_chars: int) -> LanguageModel:
    texts, counts = {}, {}
    for language, own in pieces.items():
        texts[language] = "\n".join(own)[: 2 * sample_chars]
        for letter in texts[language].lower():
            if letter.isalpha():
                counts[letter] = counts.get(letter, 0) + 1
    alphabet = sorted(counts, key=lambda c: (-counts[c], c))[:MOST_LETTERS]
    width = len(alphabet) + 2
    chars = max(1_000, min(sample_chars, MODEL_BYTES // (max(len(texts), 1) * width * 8)))
    table = letter_table(alphabet)
    languages, parsers, weights = [], [], []
    for language, text in texts.items():
        learned = letters_of(text, table)[:chars]
        if not (learned != _SEPARATOR).any():
            continue
        languages.append(language)
        parsers.append(parser(suffix_automaton(learned.tolist()), width))
        weights.append(math.log2(len(learned) + 1))
    return LanguageModel(languages, table, width, parsers, weights)


def phrases(lanes: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Phrases of each lane. ``lanes``: letters by position and lane; longer lanes come first."""
    state = np.zeros(len(lengths), np.int32)
    count = np.ones(len(lengths), np.int32)
    active = np.searchsorted(-lengths, -np.arange(1, lanes.shape[0] + 1), side="right")
    for position, n in enumerate(active.tolist()):
        move = table[state[:n] + lanes[position, :n]]
        if position:
            count[:n] += move & 1
        state[:n] = move >> 1
    return count


def judge(texts: list[str | None], model: LanguageModel) -> list[tuple[str, float, float]]:
    """Language, score and phrases per letter of each text."""
    pieces, owner, size = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = letters_of(text or "", model.letters)
        if (found != _SEPARATOR).any():
            size[i] = len(found)
            for at in range(0, len(found), LANE):
                pieces.append(found[at : at + LANE])
                owner.append(i)
    if not pieces or not model.languages:
        return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
    order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
    lengths = np.array([len(pieces[k]) for k in order])
    lanes = np.zeros((lengths[0], len(order)), np.uint8)
    for lane, k in enumerate(order):
        lanes[: len(pieces[k]), lane] = pieces[k]
    owner = np.array(owner)[order]
    counts = np.array([np.bincount(owner, phrases(lanes, lengths, table), len(texts)) for table in model.parsers])
    cost = counts * np.array(model.weights)[:, None]
    best = cost.argmin(0)
    out = []
    for i in range(len(texts)):
        if not size[i]:
            out.append((UNDETERMINED, 0.0, 0.0))
            continue
        others = np.delete(cost[:, i], best[i])
        score = 1.0 - cost[best[i], i] / others.min() if len(others) else 1.0
        out.append((model.languages[best[i]], float(score), float(counts[best[i], i] / size[i])))
    return out


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs``, and ``lang_pred``, ``score`` and ``phrase_rate``.

    ``score`` is the share of phrases that the winner saves against the next language (1 if there is no other);
    ``phrase_rate`` is its number of phrases per letter or separator, high for texts that no language explains.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = ("lang_pred", "score", "phrase_rate")
    own = [c for c in docs.columns if c not in new]
    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("phrase_rate", T.DoubleType())])

    def run(batches):
        for batch in slices(batches, "text", most=4_000_000):
            judged = judge(batch.column("text").to_pylist(), shared.value)
            added = [pa.array([j[k] for j in judged], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *added], [*own, *new])

    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, schema)


MOST_PHRASE_RATE = 0.5


def accepted() -> Column:
    """Documents with a language that explains them: phrases of two letters or more on average."""
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("phrase_rate") <= MOST_PHRASE_RATE)
