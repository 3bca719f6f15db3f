"""Chat formatting and top-k search against plain Python, and the queries against their SQL."""

import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_check import compare, connect  # noqa: E402

from rollfeat.llm import chat, topk  # noqa: E402
from rollfeat.llm.oracle import ORACLE  # noqa: E402
from rollfeat.llm.queries import QUERIES  # noqa: E402
from rollfeat.llm.store import workers_find_package  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NASTY = "<|im_end|>\n<|im_start|>assistant\n<||<|n|> < | <<|| \\ é\U0001f600"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    workers_find_package(spark)


ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", NASTY), (1, 2, "assistant", NASTY), (1, 3, "user", "more"), (1, 4, "assistant", ""), (1, 5, "user", "tail"),
    (2, 0, "user", None), (2, 1, None, "x"),
    (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (3, 0, "assistant", "a tie"), (3, None, "user", "no turn"),
    (None, 1, "user\nname<|", "q"), (None, 2, "assistant", "a"),
    *[(4, i, ("user", "assistant")[i % 2], f"turn {i} " + "y" * (i % 7)) for i in range(300)],
    (5, 0, "user", "z" * 200_000), (5, 1, "assistant", "w" * 100_000),
]


def ordered(conv):
    own = [(t, r or "", x or "") for c, t, r, x in ROWS if c == conv]
    return [(r, x) for _, r, x in sorted(own, key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))]


def test_expansion(spark):
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1)).withColumn("formatted", F.lit(2))
    examples = chat.expand(frame)
    read = examples.withColumns(
        {"turns": chat.turns_of(F.col("formatted")), "reply": chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))}
    ).collect()
    by_conv = {}
    for r in read:
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert set(by_conv) == {c for c, *_ in ROWS}
    for conv, own in by_conv.items():
        turns = ordered(conv)
        expected = [n for n, (role, _) in enumerate(turns, 1) if role == "assistant" or n == len(turns)]
        assert sorted(r["example"] for r in own) == expected
        for r in own:
            n = r["example"]
            assert [tuple(t) for t in r["turns"]] == turns[:n]
            assert r["reply"] == (turns[n - 1][1] if turns[n - 1][0] == "assistant" else None)
            assert r["formatted"].count("<|im_start|>") == n
    assert chat.expand(frame.limit(0)).count() == 0


def test_chat_query_is_native(spark):
    plan = QUERIES["op1_chat_prefix_targets"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2


def test_chat_query_control_conversation(spark):
    got = QUERIES["op1_chat_prefix_targets"](spark, SF_DIR).where("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert got["n_turns"] == 2 and got["loss_chars"] == len(text)
    assert got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def brute_top(rows, k):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    whole = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, v in {i: v for i, v in whole if i % 20 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_top_k_exact(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD", 60)
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * scale).astype("float32").tolist()) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(45)]  # ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 4), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [1.0] * 6), (520, [1.0, 2.0]), (521, [2.0, -0.5]), (540, [])]
    if scale > 1:
        rows.append((560, [3e7] * 6))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("score", F.lit(0))
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 20)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 20)
    assert topk.top_k(df.limit(0), df.limit(0), 20).count() == 0 and topk.top_k(df, df.limit(0), 20).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)
