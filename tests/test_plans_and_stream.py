"""Plan-quality guards (pushdown, broadcast only of the bounded side) and
the streaming tick-to-bar query."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quiver.operators import backtest as B
from quiver.operators import market as M
from quiver.sources.views import bars
from quiver.streaming.bars_stream import read_bars, run_bars_stream
from tests.conftest import SF01


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["ingest_bars"](spark, SF01))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan or \
        "GreaterThanOrEqual(o_orderdate" in plan
    assert "EqualTo(c_mktsegment,BUILDING)" in plan


def test_column_pruning_at_the_scan(spark):
    plan = _plan(E.queries()["ohlcv_bars"](spark, SF01))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_joins_are_left_to_the_planner(spark):
    from quiver.plans.market_queries import processed
    plan = processed(spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    # no explicit broadcast hint: sizes are measured
    assert plan.count("strategy=broadcast") == 0


def test_features_share_one_exchange(spark):
    from quiver.operators.features import lstm_features, log_returns
    df = lstm_features(log_returns(bars(spark, SF01)))
    plan = _plan(df)
    # bars aggregation exchange + one exchange on ticker for every window column
    assert plan.count("Exchange hashpartitioning(ticker") == 1


def test_corrected_modes_differ_only_where_documented(spark):
    ret = B.prepare_returns(bars(spark, SF01))
    a = B.ensemble_table(ret).select("ticker", "date", "cum_strategy", "position")
    b = B.ensemble_table(ret, corrected=True).select("ticker", "date", "cum_strategy", "position")
    j = a.alias("a").join(b.alias("b"), ["ticker", "date"])
    assert j.filter(F.col("a.position") != F.col("b.position")).count() == 0


def test_stream_bars_equal_batch_bars(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    t0 = dt.datetime(2024, 1, 1, 9, 0)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), 1, ["a", "b"][i % 2], float(i % 11), "{}") for i in range(60)]
    table = pa.table({k: [r[i] for r in rows] for i, k in enumerate(
        ["event_id", "ts", "user_id", "event_type", "value", "props"])})
    pq.write_table(table.slice(30), src / "part-0.parquet")
    schema = spark.read.parquet(str(src)).schema
    out = run_bars_stream(spark, str(src), schema, str(tmp_path / "bars"), checkpoint=str(tmp_path / "ck"))
    # ticks that land hours after later ones were processed are merged like all others
    pq.write_table(table.slice(0, 30), src / "part-1.parquet")
    out = run_bars_stream(spark, str(src), schema, str(tmp_path / "bars"), checkpoint=str(tmp_path / "ck"))
    got = read_bars(spark, out).orderBy("ticker", "hour").collect()
    ticks = spark.read.parquet(str(src)).select(F.col("event_type").alias("ticker"), "ts", "value", "event_id")
    want = M.ohlcv_bars(ticks).orderBy("ticker", "hour").collect()
    assert [(r.ticker, r.open, r.high, r.low, r.close, r.volume) for r in got] == \
        [(r.ticker, r.open, r.high, r.low, r.close, r.volume) for r in want]


def test_a_broken_write_is_not_taken_for_done(spark, tmp_path):
    import os

    from quiver.sources import files as IO

    good = spark.createDataFrame([("A", 1.0)], "ticker string, price double")
    broken = good.select("ticker", F.raise_error(F.lit("no")).cast("double").alias("price"))
    path = str(tmp_path / "out")
    os.makedirs(path)  # what a write that died at once leaves
    with pytest.raises(Exception, match="no"):
        IO.materialize_once(broken, path)
    assert not IO.is_complete(spark, path)
    IO.materialize_once(good, path)
    IO.materialize_once(good.withColumn("price", F.lit(2.0)), path)
    assert [tuple(r) for r in spark.read.parquet(path).select("ticker", "price").collect()] == [("A", 1.0)]
    assert os.listdir(tmp_path) == ["out"]
    # a second writer that comes late leaves the first one's table
    assert IO.publish(good.withColumn("price", F.lit(3.0)), path) is False
    assert spark.read.parquet(path).first().price == 1.0


def test_a_repeated_run_is_logged_once(spark, tmp_path):
    from quiver.sources import files as IO

    path = str(tmp_path / "runs")
    m = spark.createDataFrame([("A", 0.5, 1.0), ("B", 0.25, None)], "ticker string, accuracy double, f1 double")
    IO.append_run(m, path, "001", "metric")
    IO.append_run(m.withColumn("accuracy", F.lit(0.75)), path, "001", "metric")  # a retry
    IO.append_run(m, path, "002", "metric")
    IO.append_run(m, path, "002", "param")
    assert spark.read.parquet(path).where("kind = 'metric'").count() == 8
    got = {(r.run_id, r.ticker): (r.accuracy, r.f1) for r in IO.compare_runs(spark, path, ["accuracy", "f1"]).collect()}
    assert got == {("001", "A"): (0.75, 1.0), ("001", "B"): (0.75, None), ("002", "A"): (0.5, 1.0), ("002", "B"): (0.25, None)}
