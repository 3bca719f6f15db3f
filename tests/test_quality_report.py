"""Checks on one frame are counted together, in one scan of it."""

from rollfeat.operators import quality

ROWS = [("a", 1, 1.0), ("a", 2, None), ("b", 2, None), (None, 2, 3.0), (None, None, 4.0), ("c", 5, 4.0)]


def test_checks_on_one_frame_are_counted_together(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame(ROWS, "id string, n int, v double").write.parquet(path)
    df, other = spark.read.parquet(path), spark.createDataFrame([(1,), (1,)], "id int")
    checks = {
        "v there": quality.NotNull(df, "v"),
        "id once": quality.Unique(df, "id"),
        "n once": quality.Unique(df, "n"),
        "id there": quality.NotNull(df, "id"),
        "other there": quality.NotNull(other, "id"),
        "rows": quality.not_null(df, "n"),
    }
    found = quality.report(checks)
    assert {r.check_name: (r.failures, r.status) for r in found.collect()} == {
        "v there": (2, "fail"),
        "id once": (1, "fail"),
        "n once": (1, "fail"),
        "id there": (2, "fail"),
        "other there": (0, "pass"),
        "rows": (1, "fail"),
    }
    together = quality.report({k: c for k, c in checks.items() if k not in ("other there", "rows")})
    plan = together._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_empty_frames_pass(spark):
    df = spark.createDataFrame([], "id string, v int")
    found = quality.report({"once": quality.Unique(df, "id"), "there": quality.NotNull(df, "v")}).collect()
    assert [tuple(r) for r in found] == [("once", 0, "pass"), ("there", 0, "pass")]
    assert [tuple(r) for r in quality.report({"there": quality.NotNull(df, "v")}).collect()] == [("there", 0, "pass")]
