"""Training frame, boosted trees, split counts."""

import re

from pyspark.sql import functions as F

from rollfeat import queries
from rollfeat.plans import training
from rollfeat.plans.training import FeaturePlan
from rollfeat.session import scratch_dir


def frame(spark, n=300):
    days = F.array(*[F.lit(d) for d in ("Monday", "Tuesday", "Wednesday")])
    return spark.range(n).select(
        F.col("id").cast("string").alias("tx_id"),
        F.when(F.col("id") % 10 != 0, (F.col("id") % 7 > 3).cast("int")).alias("tx_fraud"),
        F.element_at(days, (F.col("id") % 5 % 3 + 1).cast("int")).alias("day_of_the_week"),
        (F.col("id") % 7).cast("decimal(9,2)").alias("amount"),
        F.when(F.col("id") % 3 != 0, F.col("id") * 1.0).alias("rare"),
    )


def test_training_set_and_split_counts(spark):
    rows = frame(spark)
    train = training.training_frame(rows)
    assert training.training_columns(rows) == ["day_of_the_week", "amount", "rare"] and "tx_id" not in train.columns
    plan = FeaturePlan.of(train)
    filled = plan.fill(train)
    assert filled.count() == rows.where("tx_fraud IS NOT NULL").count()
    assert filled.where("rare__missing = 1.0 AND rare <> 0.0").count() == 0

    model = training.fit(train, plan, rounds=3, depth=3)
    unseen = train.withColumn("day_of_the_week", F.lit("Sunday"))
    scored = {r.split: r for r in training.scores(model, plan, {"train": train, "other": unseen}).collect()}
    assert scored["train"].rmse < 0.2 and scored["other"].n_rows == scored["train"].n_rows

    counts = training.split_counts(model, plan, scratch_dir(spark, "model"))
    used = re.findall(r"If \(feature (\d+) ", model.stages[-1].toDebugString)
    inputs = [feature for _, feature in plan.inputs]
    expected = {}
    for i in used:
        expected[inputs[int(i)]] = expected.get(inputs[int(i)], 0) + 1
    assert {r.feature: r.score for r in counts.collect()} == expected
    assert [r.feature for r in training.top_features(counts, 1).collect()] == [max(sorted(expected), key=expected.get)]


def test_splits_are_built_once_and_read_from_a_table(spark, tmp_path):
    at = F.make_interval(hours=F.col("id")) + F.lit("2024-01-01 00:00:00").cast("timestamp")
    events = spark.range(240).select(
        F.col("id").alias("event_id"), at.cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).alias("user_id"), (F.col("id") * 0.25).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 2).alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 240, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    train, validation, plan = queries.splits(spark, str(tmp_path))
    assert (train.count(), validation.count()) == (48, 120)
    for split in (train, validation):
        optimized = split._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in optimized and "Window" not in optimized
    whole = queries.build_features(queries.staged_events(spark, str(tmp_path)), queries.PRESET_B.summing_in(queries.MONEY))
    first = training.training_frame(queries.time_range(whole, "tx_ts", *queries.LABELLED_TRAIN))
    assert sorted(map(repr, train.select(*first.columns).collect())) == sorted(map(repr, first.collect()))
