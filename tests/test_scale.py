"""What keeps the flight queries in proportion to their input."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skyledger.operators import connections, trees
from skyledger.plans import delay_model
from skyledger.session import small_methods
from skyledger.sources import driver_tables
from skyledger.sources.driver_tables import DriverTables
from tests.conftest import SMALL

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_load_is_planned_with_small_methods(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(driver_tables, "write_flights", lambda *a, **k: seen.append(spark.conf.get(LIMIT)))
    monkeypatch.setattr(driver_tables, "read_flights", lambda *a: None)
    monkeypatch.setattr(driver_tables, "_loaded", {})
    monkeypatch.setattr(driver_tables, "_paths", {})
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "65535")
    try:
        _ = DriverTables(spark, SMALL).flights
        assert seen == ["8000"] and spark.conf.get(LIMIT) == "65535"
        with small_methods(spark):
            assert spark.conf.get(LIMIT) == "8000"
    finally:
        spark.conf.set(LIMIT, before)


def test_line_items_are_shuffled_once(spark):
    joins = {k: "-1" for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    before = {k: spark.conf.get(k, None) for k in joins}
    try:
        for k, v in joins.items():
            spark.conf.set(k, v)
        plan = DriverTables(spark, SMALL)._keys()._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # The join of customers stands beneath that of the orders with the line items.
    lines = plan.splitlines()
    depth = {c: next(line.index("Join") for line in lines if "Join" in line and c in line)
             for c in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_features_need_no_shuffle_of_rows(spark, make_flights):
    flights = make_flights([
        {"flight_date": dt.date(2020, 1, 1 + i % 9), "arr_delay": i % 40, "origin": f"A{i % 7}", "dest": f"B{i % 5}",
         "carrier_code": f"C{i % 3}", "crs_dep_time": 100.0 * (i % 24), "distance": 300.0 + i}
        for i in range(60)
    ])
    made = delay_model.engineer(delay_model.modelling_rows(flights))
    assert "Exchange hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
    assert made.count() == 60
    marked = delay_model.mark_test(made)
    assert marked.where("is_test").count() == sum(int(r["count"] * 0.2) for r in made.groupBy("label").count().collect())


def test_cycles_round_as_round_does(spark):
    periods = {"hour_of_day": 24, "day_of_week": 7, "month": 12}
    rows = spark.range(25).select(*[(F.col("id") % (p + 1)).cast("int").alias(c) for c, p in periods.items()])
    cycles = delay_model.add_cycles(rows)
    names = [c for c in cycles.columns if c.endswith(("_sin", "_cos"))]
    plain = cycles.select(*[F.round(c, 9).alias(c) for c in names])
    own = cycles.select(*names)
    own = delay_model.tree_inputs(own).select(*names)
    assert own.collect() == plain.collect()


def test_bytes_of_slices():
    x = np.arange(60, dtype=np.uint8).reshape(12, 5)
    packed = trees._packed(x)
    assert (trees._unpacked(packed.slice(3, 6), 5) == x[3:9]).all()
    assert trees._unpacked(packed.slice(3, 0), 5).shape == (0, 5)
    assert packed.to_pylist() == [row.tobytes() for row in x]


def test_counts_that_are_held_or_not(spark, monkeypatch):
    """The rows that a task returns do not grow with its chunks, and the counts are the same."""
    n = 400
    bins, draws = np.arange(n * 2, dtype=np.uint8).reshape(n, 2) % 4, np.ones((n, 1), np.uint8)
    label = pa.array(np.arange(n, dtype=np.int32) % 2)
    batch = pa.RecordBatch.from_arrays([trees._packed(bins), trees._packed(draws), label], names=["bins", "draws", "label"])
    forest = trees.Forest(["a", "b"], [np.arange(3.0)] * 2, (1000, 1000), 1)
    forest.add(0, 1, 0, n // 2, n // 2)
    kept = {}

    class Rows:
        def mapInArrow(self, count, schema):
            kept["count"] = count
            return spark.createDataFrame([], schema)

    monkeypatch.setattr(trees, "CHUNK", 10)
    pieces = [batch.slice(i, 10) for i in range(0, n, 10)]

    def counted():
        trees._counts(Rows(), forest, [0], trees.Growth(trees=1, tried=2))
        return [r for b in kept["count"](iter(pieces)) for r in b.to_pylist()]

    held = counted()
    monkeypatch.setattr(trees, "HELD", 0)
    passed = counted()
    assert len(held) <= 2 * 4 < len(passed)
    total = {}
    for r in passed:
        key = (r["open"], r["feature"], r["bin"])
        total[key] = tuple(a + b for a, b in zip(total.get(key, (0, 0)), (r["n0"], r["n1"])))
    assert {(r["open"], r["feature"], r["bin"]): (r["n0"], r["n1"]) for r in held} == total
    assert sum(a + b for a, b in total.values()) == 2 * n


def test_a_hub_passes_on_the_best_only(monkeypatch):
    monkeypatch.setattr(connections, "PAIRS", 64)
    rng = np.random.default_rng(5)
    legs = [
        {"other": f"X{i % 3}", "inbound": i % 2 == 0, "time": float(rng.integers(0, 1440)) * (1 if i % 2 == 0 else -1),
         "cost": float("inf") if i == 4 else float(rng.integers(0, 60))}
        for i in range(90)
    ]
    key = (pa.scalar(dt.date(2020, 1, 1), pa.date32()), pa.scalar("HUB"))
    found, direct = {}, {}
    for batch in connections._hub_pairs(key, pa.Table.from_pylist(legs), 60, 3):
        assert batch.num_rows <= 3 * 9
        for r in batch.to_pylist():
            side = direct if r["via"] is None else found
            side.setdefault((r["start_airport"], r["final_dest"]), []).append(r["total"])
    pairs = {}
    for a in (x for x in legs if x["inbound"]):
        for d in (x for x in legs if not x["inbound"]):
            if -d["time"] > a["time"] + 60:
                pairs.setdefault((a["other"], d["other"]), []).append(a["cost"] + d["cost"])
    assert {k: sorted(v)[:3] for k, v in found.items()} == {k: sorted(v)[:3] for k, v in pairs.items()}
    costs = {s: sorted(x["cost"] for x in legs if x["inbound"] and x["other"] == s)[:3] for s in ("X0", "X1", "X2")}
    assert {k[0]: sorted(v) for k, v in direct.items()} == costs
