import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import evaluate, metrics


def test_perplexity_weighs_tokens(spark):
    scores = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("b", 0.5, 2)], "task string, nll double, n bigint")
    got = {r["task"]: r["perplexity"] for r in evaluate.perplexity(scores, ["task"]).collect()}
    assert got == {"a": pytest.approx(math.exp(5 / 4)), "b": pytest.approx(math.exp(0.5))}
    assert evaluate.perplexity(scores.where("n > 9")).first()["perplexity"] is None


def test_bigram_scores_by_hand(spark):
    blocks = lambda rows: spark.createDataFrame([(r,) for r in rows], "tokens array<int>")
    train = evaluate.bigram_counts(blocks([[1, 2, 1, 2], [1, 3]]))
    assert {(r["prev"], r["next"]): r["n"] for r in train.collect()} == {(1, 2): 2, (2, 1): 1, (1, 3): 1}
    scores = evaluate.bigram_scores(train, evaluate.bigram_counts(blocks([[1, 2], [9, 1], [7]])), 10, 0.5)
    got = {(r["prev"], r["next"]): r["nll"] for r in scores.collect()}
    assert got == {(1, 2): pytest.approx(-math.log(2.5 / 8)), (9, 1): pytest.approx(-math.log(0.5 / 5))}


def test_eval_rows_are_the_head(spark):
    rows = spark.range(100).select(F.col("id").alias("block_id"), F.expr("id div 10").alias("shard_id"))
    assert evaluate.eval_limit(rows, 4).count() == 16
    assert evaluate.eval_limit(rows, 400).count() == 50


def test_report_takes_the_first_metric_present(spark):
    rows = [("x", "acc", 0.5), ("x", "acc_norm", 0.9), ("y", "acc", None), ("y", "acc_norm", 0.25), ("z", "acc", None)]
    got = evaluate.eval_report(spark.createDataFrame(rows, "task string, metric string, value double"))
    assert {r["task"]: r["shown"] for r in got.collect()} == {"x": "0.5000", "y": "0.2500", "z": "N/A"}


def steps(spark, losses, seconds):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i + 1, float(loss), t0 + dt.timedelta(seconds=seconds * (i + 1)), 0.1 * (i + 1)) for i, loss in enumerate(losses)]
    return spark.createDataFrame(rows, "step bigint, loss double, ts timestamp, lr double")


def test_rollup_of_full_groups(spark):
    rows = metrics.metrics_rollup(steps(spark, [1] * 10 + [30] * 10 + [5] * 5, 2), 10, 100).orderBy("step").collect()
    assert [r["step"] for r in rows] == [10, 20]  # five trailing steps unreported
    assert rows[0]["loss"] == 1.0 and rows[0]["ppl"] == pytest.approx(math.e)
    assert rows[1]["ppl"] == pytest.approx(math.exp(20)) and rows[1]["lr"] == pytest.approx(2.0)
    assert rows[1]["tokens_seen"] == 2000 and rows[1]["tok_per_sec"] == pytest.approx(1000 / 20)


def test_rate_is_zero_without_elapsed_time(spark):
    rows = metrics.metrics_rollup(steps(spark, [1] * 4, 0), 2, 100).collect()
    assert [r["tok_per_sec"] for r in rows] == [0.0, 0.0]


def test_micro_losses_are_averaged(spark):
    t = dt.datetime(2024, 1, 1)
    micro = spark.createDataFrame([(i, float(i), t, 0.1) for i in range(7)], "micro_step bigint, loss double, ts timestamp, lr double")
    got = {r["step"]: r["loss"] for r in metrics.step_losses(micro, 3).collect()}
    assert got == {1: 1.0, 2: 4.0}
