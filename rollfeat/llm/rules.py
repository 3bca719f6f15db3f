"""Quality rules: base statistics of whole texts, and a decision list learned from labels.

Statistics: ``n_words`` (words ``[^\\x20\\x09-\\x0D]+``), ``word_chars`` (code points in words), ``n_symbols`` (characters of
``[#*$%&|<>]``), ``n_dup_lines`` (lines that hold a word and equal an earlier line), ``n_repeat_words`` (words in 5-word
windows found twice or more in the text, the first included), and for the rules also ``n_upper`` (A-Z), ``n_exclaims``
(``!`` and ``?``) and ``n_digits``. Null text has no words.

Rules are found by sequential covering. A conjunction of thresholds for low quality grows by information gain on two
thirds of the labelled rows, loses its last conditions while that helps on the other third, and is added if it is right
there in at least ``LEAST_PRECISION`` of at least ``LEAST_COVERED`` rows; rows it covers are then left out. The list becomes one Spark
conditional expression. Without enough labels there are no rules and everything is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.llm.text import as_bytes, constants, grams, slices, word_hashes

WINDOW = 5
SAMPLE_ROWS = 30_000
LEAST_PRECISION = 0.95
LEAST_COVERED = 10
MOST_CONDITIONS = 4
CUTS = 48

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_exclaims", "n_digits")

# What rules compare, by name.
MEASURES = {
    "n_words": "n_words",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "exclaims_per_word": "n_exclaims / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}

_FACTORS = constants("repeat window", WINDOW)
_KINDS = np.zeros((6, 256), np.int64)
_KINDS[0, 128:192] = 1
_KINDS[1, [9, 10, 11, 12, 13, 32]] = 1
_KINDS[2, list(b"#*$%&|<>")] = 1
_KINDS[3, 65:91] = 1
_KINDS[4, list(b"!?")] = 1
_KINDS[5, 48:58] = 1


def repeat_words(hashes: np.ndarray) -> int:
    windows = grams(hashes, _FACTORS)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    change[at] += 1
    np.add.at(change, at + WINDOW, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            if line in seen:
                count += 1
            else:
                seen.add(line)
    return count


def measure(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, and the statistics."""
    new = BASE + MORE
    own = [c for c in docs.columns if c not in new]
    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField(c, T.LongType()) for c in new])

    def run(batches):
        for batch in slices(batches, "text"):
            texts = as_bytes(batch.column("text"))
            hashes, bounds = word_hashes(texts)
            rows = []
            for i, text in enumerate(texts):
                text = text or b""
                inner, n_space, n_symbols, n_upper, n_exclaims, n_digits = (_KINDS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)).tolist()
                own_hashes = hashes[bounds[i] : bounds[i + 1]]
                rows.append((len(own_hashes), len(text) - inner - n_space, n_symbols, dup_lines(text), repeat_words(own_hashes), n_upper, n_exclaims, n_digits))
            added = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(new))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *added], [*own, *new])

    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    cut: float

    def sql(self) -> str:
        return f"{MEASURES[self.measure]} {'>' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    holds = np.ones(len(x), bool)
    for c in rule:
        values = x[:, names.index(c.measure)]
        holds &= values > c.cut if c.above else values <= c.cut
    return holds


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    rule: Rule = ()
    covered = np.ones(len(x), bool)
    while len(rule) < MOST_CONDITIONS and (covered & ~bad).any():
        p, n = (covered & bad).sum(), covered.sum()
        before = np.log2(p / n)
        best_gain, best, best_covered = 1e-9, None, None
        for k, name in enumerate(names):
            values = np.unique(np.quantile(x[covered & bad, k], np.linspace(0, 1, CUTS)))
            for cut in values.tolist():
                for above in (True, False):
                    holds = covered & (x[:, k] > cut if above else x[:, k] <= cut)
                    q = (holds & bad).sum()
                    if q:
                        gain = q * (np.log2(q / holds.sum()) - before)
                        if gain > best_gain:
                            best_gain, best, best_covered = gain, Condition(name, above, float(f"{cut:.6g}")), holds
        if best is None:
            break
        rule, covered = (*rule, best), best_covered
        covered = _holds(rule, x, names)
        if not (covered & bad).any():
            return rule[:-1]
    return rule


def learn(x: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Rule]:
    """The decision list for rows of measures, of which some are bad."""
    aside = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    rules: list[Rule] = []
    while True:
        grow, prune = left & ~aside, left & aside
        if not (bad & grow).any():
            return rules
        rule = _grow(x[grow], bad[grow], names)

        def worth(r: Rule) -> tuple[float, int, int]:
            holds = _holds(r, x[prune], names)
            p, n = int((holds & bad[prune]).sum()), int((holds & ~bad[prune]).sum())
            return ((p - n) / (p + n) if p + n else -1.0), p, n

        for size in range(len(rule) - 1, 0, -1):
            if worth(rule[:size])[0] >= worth(rule)[0]:
                rule = rule[:size]
        _, p, n = worth(rule) if rule else (0, 0, 1)
        if p + n < LEAST_COVERED or p < LEAST_PRECISION * (p + n):
            return rules
        rules.append(rule)
        left &= ~_holds(rule, x, names)


def fit(measured: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from the labelled (``quality`` 0 or 1) of ``measured``, at most about ``sample_rows`` by a hash of ``doc_id``."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, sample_rows / max(known.count(), 1))
    sample = known.where(F.xxhash64(F.col("doc_id").cast("long"), F.lit("rule sample")) <= F.lit(-(2.0**63) + share * 2.0**64))
    names = list(MEASURES)
    values = [F.expr(sql).cast("double").alias(name) for name, sql in MEASURES.items()]
    got = measured.select("doc_id", *values).join(sample, "doc_id").select("doc_id", "quality", *names).collect()
    got = sorted(tuple(r) for r in got)
    if not got:
        return []
    x = np.array([r[2:] for r in got], float)
    bad = np.array([r[1] == 0 for r in got])
    shuffled = np.random.default_rng(11).permutation(len(x))
    return learn(x[shuffled], bad[shuffled], names)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Two conditional expressions: whether a document is kept, and the number of the rule that decided (null if none)."""
    kept, number = F.lit(True), F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        holds = F.expr(" AND ".join(c.sql() for c in rules[i]))
        kept = F.when(holds, F.lit(False)).otherwise(kept)
        number = F.when(holds, F.lit(i + 1)).otherwise(number)
    return kept, number


def apply(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """``measured`` with ``base_failed``, ``rule`` and ``kept``."""
    kept, number = verdict(rules)
    return measured.withColumns({"base_failed": base_failed(), "rule": number, "kept": ~base_failed() & kept})
