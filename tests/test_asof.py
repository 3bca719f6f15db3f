"""Point-in-time joins against a brute-force reading, whole and sliced."""

import random
from datetime import datetime, timedelta

import pytest

from rollfeat.operators.asof import FeatureRows, asof_join
from rollfeat.operators.hotkeys import Limits

DAY = datetime(2024, 1, 1)
HOT = Limits(rows_per_key=20, small_steps=0)
FEATURES = "entity bigint, at timestamp_ntz, tie string, f double, g bigint"
INSTANCES = "id bigint, e bigint, t timestamp_ntz"


def data(seed=1, n=400):
    rng = random.Random(seed)

    def when():
        return None if rng.random() < 0.03 else DAY + timedelta(seconds=rng.randrange(2000), milliseconds=rng.choice([0, 500]))

    def who():
        return None if rng.random() < 0.05 else (1 if rng.random() < 0.5 else rng.randrange(8))

    features = [
        (who(), when(), str(i), rng.choice([None, float(i)]), rng.choice([None, i])) for i in range(n) if rng.random() < 0.6
    ]
    instances = [(i, who(), when()) for i in range(n)]
    return features, instances + instances[:20]


def brute_force(features, instances, per_feature):
    out = []
    for i, e, t in instances:
        known = sorted(
            (r for r in features if None not in (e, t, r[0], r[1]) and r[0] == e and r[1] <= t), key=lambda r: (r[1], r[2])
        )
        if per_feature:
            f, g = (next((r[c] for r in reversed(known) if r[c] is not None), None) for c in (3, 4))
        else:
            f, g = known[-1][3:] if known else (None, None)
        out.append((i, e, t, f, g))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_feature", [False, True])
@pytest.mark.parametrize("limits", [None, HOT, Limits(rows_per_key=5, small_steps=0, listed_keys=1)])
def test_latest_at_or_before(spark, limits, per_feature):
    features, instances = data()
    values = FeatureRows(spark.createDataFrame(features, FEATURES), "entity", "at", ["f", "g"], tie_break="tie")
    options = {} if limits is None else {"limits": limits, "slice_rows": 10}
    got = asof_join(spark.createDataFrame(instances, INSTANCES), "e", "t", values, per_feature, **options)
    assert got.columns == ["id", "e", "t", "f", "g"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(features, instances, per_feature)


def test_same_time_counts_and_later_does_not(spark):
    features = spark.createDataFrame([(1, DAY, "a", 1.0, 1), (1, DAY + timedelta(seconds=5), "b", 2.0, 2)], FEATURES)
    moments = [(0, 1, DAY - timedelta(microseconds=1)), (1, 1, DAY), (2, 1, DAY + timedelta(seconds=4)), (3, 1, DAY + timedelta(seconds=5)), (4, 2, DAY)]
    values = FeatureRows(features, "entity", "at", ["f"])
    got = asof_join(spark.createDataFrame(moments, INSTANCES), "e", "t", values).collect()
    assert {r["id"]: r["f"] for r in got} == {0: None, 1: 1.0, 2: 1.0, 3: 2.0, 4: None}


def test_name_clash_is_refused(spark):
    features = spark.createDataFrame([], FEATURES)
    instances = spark.createDataFrame([], "id bigint, e bigint, t timestamp_ntz, f double")
    with pytest.raises(ValueError, match="already have"):
        asof_join(instances, "e", "t", FeatureRows(features, "entity", "at", ["f"]))


@pytest.mark.parametrize("per_feature", [False, True])
def test_ties_do_not_depend_on_the_plan(spark, per_feature):
    """Rows that share entity, time and tie: the greatest features count, whatever the order and the plan."""
    rows = [(1, DAY, None, 1.0, 5), (1, DAY, None, 9.0, None), (1, DAY, None, 4.0, 7)]
    rows += [(1, DAY + timedelta(hours=h), "x", float(h % 5), h % 3) for h in range(1, 40) for _ in range(2)]
    instances = [(i, 1, DAY + timedelta(minutes=17 * i)) for i in range(150)]
    answers = set()
    for order, options in ((1, {}), (-1, {}), (1, {"limits": HOT, "slice_rows": 10}), (-1, {"limits": HOT, "slice_rows": 10})):
        values = FeatureRows(spark.createDataFrame(rows[::order], FEATURES), "entity", "at", ["f", "g"], tie_break="tie")
        got = asof_join(spark.createDataFrame(instances, INSTANCES), "e", "t", values, per_feature, **options)
        answers.add(tuple(sorted((tuple(r) for r in got.collect()), key=repr)))
    (answer,) = answers
    assert answer[0][3:] == ((9.0, 7) if per_feature else (9.0, None))
