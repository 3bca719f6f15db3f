"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are counted into cells of (source, language, topic), by tokens. The cells' weights are raked in turn to
the target share of each source, language and topic, until all are met within ``MISS`` or ``SWEEPS`` times. No cell gets
more than it has: its weight is at most its tokens over the tokens to keep, and the other cells of its source, language or topic
take what is beyond. Documents are then kept with the probability that makes a cell's expected tokens its weight, ``keep`` of
all tokens in sum. Whether a document is kept depends on a hash of its id and text only.

Targets without documents are left out and the others take their share. A category cannot have a larger share than its natural
one over ``keep``; where its target is beyond, it is kept whole and the others divide the rest as their targets are. Where cells
that do not exist or are too small make the targets contradict each other, raking ends near them. Each row states the target
and the reached (expected) share of its source, language and topic, so that any miss is seen. Null source, language or topic is a category of its own, as ``NULL_NAME``. Null
texts have no tokens and stay out of the sums, but are kept or dropped like others of their cell. Rows that repeat are
kept or dropped together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.llm.store import Store

SWEEPS = 12
MISS = 5e-4
FILLS = 6
KEEP = 0.8
NULL_NAME = "(none)"
DIMENSIONS = ("source", "lang", "topic")
FLATTEN = {"source": 0.7, "lang": 0.85, "topic": 0.85}
WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def form(text: Column) -> Column:
    """A topic that every text has: what it is made of."""
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty")
        .when(F.regexp_count(text, F.lit(r"\|")) * 40 >= F.length(text), "table")
        .when(F.regexp_count(text, F.lit(r"[0-9]")) * 20 >= F.length(text), "figures")
        .when(F.regexp_count(text, F.lit("[!?]")) * 40 >= F.length(text), "shouting")
        .when(F.length(text) < 600, "note")
        .when(F.length(text) < 6000, "article")
        .otherwise("book")
    )


def flattened(cells: DataFrame, dimension: str, power: float = 1.0) -> DataFrame:
    """Targets ``(dimension, target)``: natural token shares to a power, which lifts what is rare."""
    shares = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    return shares.select(dimension, F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("target"))


def wanted_shares(cells: DataFrame, dimension: str, target: DataFrame, keep: float, store: Store, n: int) -> DataFrame:
    """``(dimension, wanted, target)``: targets as shares of those with documents, and what of them ``keep`` leaves possible.

    ``n`` is the number of cells.
    """
    there = store.few(cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).where("tokens > 0").join(target, dimension), n)
    sums = there.agg(F.sum("target").alias("target")).first()
    total = cells.agg(F.sum("tokens").alias("tokens")).first()["tokens"] or 1
    share, most, scale = F.col("target") / F.lit(sums["target"] or 1.0), F.col("tokens") / F.lit(keep * total), 1.0
    for _ in range(FILLS):
        whole = share * F.lit(scale) >= most
        sums = there.agg(F.sum(F.when(whole, most)).alias("whole"), F.sum(F.when(~whole, share)).alias("open")).first()
        if not sums["open"] or sums["whole"] is None:
            break
        before, scale = scale, max(scale, (1.0 - sums["whole"]) / sums["open"])
        if scale == before:
            break
    return there.select(dimension, share.alias("wanted"), F.least(share * F.lit(scale), most).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], store: Store, keep: float = KEEP, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (the dimensions, ``tokens``) with ``weight``: shares of the whole that meet the targets.

    A weight is the cell's share of the tokens times one factor for each dimension, or ``1 / keep`` of that share if this is
    less. A step renews the factors of one dimension from the sums of the cells under the others' factors, and keeps them;
    sums begin before the shuffle, so a category that most cells share is no burden. A sum grows with its factor, ever slower
    as cells reach their bound, so the line through the present sum never leads too far, nor does that through no bound at all.

    Cells carry their targets and factors, so that a step is one aggregation and one join, and what it missed is asked for once a
    sweep: every job and task costs the driver memory, however small its tables are. So no more tasks than the number of cells asks
    for rake them.
    """
    n = cells.count()
    total = cells.agg(F.sum("tokens").alias("tokens")).first()["tokens"] or 1
    share = F.col("tokens") / F.lit(float(total))
    most = share / F.lit(keep)
    state = cells
    for d, target in targets.items():
        state = state.join(target.select(d, F.col("target").alias(f"{d}_target")), d, "left")
    factors = [f"{d}_factor" for d in targets]
    state = store.few(state.select(*cells.columns, *[F.coalesce(f"{d}_target", F.lit(0.0)).alias(f"{d}_target") for d in targets], *[F.lit(1.0).alias(f) for f in factors], F.lit(0.0).alias("missed")), n)

    def weight(dimensions) -> Column:
        return reduce(lambda product, d: product * F.col(f"{d}_factor"), dimensions, share)

    for _ in range(sweeps):
        for number, dimension in enumerate(targets):
            own = F.col(f"{dimension}_factor")
            base = state.withColumn("weight", weight([d for d in targets if d != dimension]))
            whole = F.col("weight") * own >= most
            sums = base.groupBy(dimension).agg(F.sum("weight").alias("sum"), F.coalesce(F.sum(F.when(whole, most)), F.lit(0.0)).alias("whole"), F.coalesce(F.sum(F.when(~whole, F.col("weight"))), F.lit(0.0)).alias("open"), F.first(own).alias("own"), F.first(f"{dimension}_target").alias("target"))
            free = F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).otherwise(0.0)
            full = (F.col("open") <= 0) & (F.col("whole") <= F.col("target") * (1 + 1e-9))
            factor = F.when(full, F.greatest("own", free)).when(F.col("open") > 0, F.greatest(free, (F.col("target") - F.col("whole")) / F.col("open"))).otherwise(free)
            missed = F.abs(F.col("whole") + F.col("open") * F.col("own") - F.col("target"))
            step = sums.select(dimension, factor.alias("__factor"), missed.alias("__missed"))
            renewed = {f"{dimension}_factor": F.col("__factor"), "missed": F.greatest("missed", "__missed") if number else F.col("__missed")}
            state = store.few(state.join(step, dimension).select(*[renewed.get(c, F.col(c)).alias(c) for c in state.columns]), n)
        if (state.agg(F.max("missed").alias("missed")).first()["missed"] or 0.0) <= MISS:
            break
    return state.select(*cells.columns, F.least(weight(targets), most).alias("weight"))


def probabilities(weighted: DataFrame, keep: float, store: Store, n: int) -> DataFrame:
    """The ``n`` cells with ``probability``: ``min(1, scale * weight / tokens)``, scaled to keep that share of the tokens.

    The scale rises in ``FILLS`` steps, each for what the cells that are kept whole leave to the others.
    """
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = store.few(weighted.withColumn("factor", factor), n)
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()["tokens"]
    scale = 0.0
    for _ in range(FILLS):
        whole = F.col("factor") * F.lit(scale) >= 1.0
        sums = cells.agg(F.sum(F.when(whole, F.col("tokens"))).alias("whole"), F.sum(F.when(~whole, F.col("weight"))).alias("open")).first()
        if not sums["open"]:
            break
        before, scale = scale, max(scale, (keep * total - (sums["whole"] or 0)) / sums["open"])
        if scale == before:
            break
    # A cell without tokens, such as that of empty texts, has no weight to rake: it is kept.
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("factor") * F.lit(scale))).otherwise(1.0))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, topic: Column | None = None) -> DataFrame:
    """All columns of ``docs``, and ``topic, n_tokens, probability, sampled, target_shares, reached_shares``.

    ``targets`` gives ``(dimension, target)`` for ``source``, ``lang`` and ``topic``; those not given are the natural shares
    to the power in ``FLATTEN``. ``topic`` is an expression, by default the form of the text.
    """
    store = Store(docs.sparkSession, "mixing")
    new = ("topic", "n_tokens", "probability", "sampled", "target_shares", "reached_shares")
    own = [c for c in docs.columns if c not in new]
    text = F.col("text").cast("string")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NULL_NAME))
    known = docs.withColumns({"__source": name(F.col("source")), "__lang": name(F.col("lang")), "__topic": name(form(text) if topic is None else topic), "__tokens": n_words(text)})
    counted = known.select(F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"))
    cells = store.keep(counted.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    n = cells.count()
    wanted = {d: (targets or {}).get(d) if (targets or {}).get(d) is not None else flattened(cells, d, FLATTEN[d]) for d in DIMENSIONS}
    wanted = {d: store.few(wanted_shares(cells, d, target, keep, store, n), n) for d, target in wanted.items()}
    # Targets are summed in the order that a shuffle gives them; from here on the cells are read by few tasks.
    cells = store.few(cells, n)
    chosen = store.few(probabilities(rake(cells, {d: t.drop("wanted") for d, t in wanted.items()}, store, keep), keep, store, n), n)
    expected = F.col("tokens") * F.col("probability")
    total = chosen.agg(F.sum(expected).alias("tokens")).first()["tokens"] or 1.0
    stated = chosen
    for d in DIMENSIONS:
        reached = chosen.groupBy(d).agg((F.sum(expected) / F.lit(total)).alias(f"{d}_reached"))
        stated = stated.join(reached.join(wanted[d].select(d, F.col("wanted").alias(f"{d}_wanted")), d, "left"), d)
    shares = [F.struct(*[F.coalesce(f"{d}_{kind}", F.lit(0.0)).alias(d) for d in DIMENSIONS]).alias(name) for kind, name in (("wanted", "__target"), ("reached", "__reached"))]
    chosen = store.keep(stated.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.col("probability").alias("__probability"), *shares), n)
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit(""))))), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
    joined = known.join(chosen, ["__source", "__lang", "__topic"])
    return joined.select(*[F.col(f"`{c}`") for c in own], F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), F.col("__probability").alias("probability"), (draw < F.col("__probability")).alias("sampled"), F.col("__target").alias("target_shares"), F.col("__reached").alias("reached_shares"))
