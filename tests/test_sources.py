import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from monsoon import catalog
from monsoon.operators import vintage
from monsoon.schema import DataError
from monsoon.sources import contracts, runs, tables
from monsoon.streaming import monthly

SF = "/root/testdata/sf0.001"


def test_contracts(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("# gate\nauthorization:\n  train: true\n  score: false\nfeatures:\n  - a\n  - b\n  - a\nbehavior:\n  adi: 1.32\n  names: [x, 'y']\n")
    contract = contracts.read_contract(path)
    contracts.require_gate(contract, "train")
    for name in ("score", "other"):
        with pytest.raises(contracts.GateError):
            contracts.require_gate(contract, name)
    assert contracts.read_features(path) == ["a", "b"] and contract["behavior"] == {"adi": 1.32, "names": ["x", "y"]}
    assert contracts.overlay({"a": 1, "b": 2}, {"b": 3, "c": 4}, ["b"]) == {"a": 1, "b": 3}
    contracts.publish(tmp_path / "current.json", {"status": "PASS", "version": "1"})
    assert contracts.resolve(tmp_path / "current.json", version="1")["version"] == "1"
    with pytest.raises(contracts.GateError):
        contracts.resolve(tmp_path / "current.json", version="2")
    contracts.write_features(tmp_path / "f.yaml", "PAIR", ["x", "y"], run_id="r")
    assert contracts.read_features(tmp_path / "f.yaml") == ["x", "y"]


def test_runs(spark, tmp_path):
    run = runs.new_run(tmp_path, "r_1")
    with pytest.raises(FileExistsError):
        runs.new_run(tmp_path, "r_1")
    assert runs.latest_run(tmp_path, "r_") is None
    runs.manifest(run, rows=1)
    assert runs.latest_run(tmp_path, "r_") == run
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    digest = lambda d: runs.content_digest(d).first().digest
    assert digest(df) == digest(df.orderBy(F.desc("a")).repartition(3)) != digest(df.na.fill("<null>"))
    tables.write_parquet(df, f"file://{tmp_path}/t")
    runs.verify_hash(tmp_path / "t", runs.sha256_tree(tmp_path / "t"))
    with pytest.raises(ValueError):
        runs.verify_hash(tmp_path / "t", "0")
    with pytest.raises(Exception, match="exists"):
        tables.write_parquet(df, f"file://{tmp_path}/t")
    tables.write_csv(df, f"file://{tmp_path}/c")
    assert tables.read_csv(spark, f"file://{tmp_path}/c", "a int, b string").count() == 2
    assert tables.flatten({"a": {"b": 1}}) == {"a.b": 1} and tables.jdbc_options("u", "t")["sessionInitStatement"].endswith("READ ONLY")


def test_vintage_is_locked_once(spark, tmp_path):
    rows = [("A", "1", dt.date(2025, 6, 1), dt.date(2025, 6 + h, 1), h, 0.5, 4.0, 2.0) for h in (1, 2, 3)]
    forecast = spark.createDataFrame(rows, "base_sku string, branch_code string, forecast_origin date, target_month date, horizon int, p_positive double, pred_positive_quantity double, forecast_m2 double")
    vintage.lock(forecast, tmp_path, "v1", "2025-06-01")
    with pytest.raises(FileExistsError):
        vintage.lock(forecast, tmp_path, "v1", "2025-06-01")
    with pytest.raises(DataError, match="forecast_is_product"):
        vintage.lock(forecast.withColumn("forecast_m2", F.lit(1.0)), tmp_path, "v2", "2025-06-01")
    panel = spark.createDataFrame([("A", "1", dt.date(2025, 7, 1), 4.0, True)], "base_sku string, branch_code string, month date, actual_gross_m2 double, target_available boolean")
    scored = vintage.score_vintage(forecast, panel).collect()
    assert [(r.horizon, r.wape) for r in scored] == [(1, 0.5)]


@pytest.mark.parametrize("name", ["fact", "positive_events", "target_calendar", "reconciliation"])
def test_catalog_equals_its_sql(spark, name):
    base = duckdb.connect()
    for t in ("part", "nation", "region", "supplier", "lineitem"):
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.queries()[name](spark, SF)
    found = base.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    text = lambda rows: sorted(repr([str(x)[:10] if isinstance(x, (dt.date, dt.datetime)) else round(x, 5) if isinstance(x, float) else x for x in r]) for r in rows)
    assert text(df.select(*names).collect()) == text(found.fetchall())


def test_stream_gives_closed_months_once(spark, tmp_path):
    rows = [("a", "1", "M2", dt.datetime(2025, m, d), 1.0, 2.0) for m, d in ((1, 3), (1, 20), (2, 5), (3, 9))]
    spark.createDataFrame(rows, "bravo_sku string, branch_code string, unit string, event_time timestamp, quantity double, amount double").write.parquet(f"file://{tmp_path}/e")
    source = spark.readStream.schema("bravo_sku string, branch_code string, unit string, event_time timestamp, quantity double, amount double").parquet(f"file://{tmp_path}/e")
    got = []
    monthly.start(source, f"file://{tmp_path}/c", lambda df, _: got.extend(df.collect())).awaitTermination()
    closed = {str(r.month): (r.total_quantity, r.line_count) for r in got}
    assert closed == {"2025-01-01": (2.0, 2), "2025-02-01": (1.0, 1)}


def test_late_events_of_a_month_still_count(spark, tmp_path):
    schema = "bravo_sku string, branch_code string, unit string, event_time timestamp, quantity double, amount double"
    got = []
    for batch, (month, day, quantity) in enumerate([(1, 5, 1.0), (2, 1, 10.0), (2, 1, 10.0), (1, 31, 100.0), (2, 20, 10.0), (1, 30, 7.0), (3, 20, 1.0), (3, 20, 1.0)]):
        row = [("a", "1", "M2", dt.datetime(2025, month, day), quantity, 2.0)]
        spark.createDataFrame(row, schema).write.mode("append").parquet(f"file://{tmp_path}/e{batch}")
        (tmp_path / "e").mkdir(exist_ok=True)
        for part in (tmp_path / f"e{batch}").glob("*.parquet"):
            part.rename(tmp_path / "e" / f"{batch}-{part.name}")
        source = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/e")
        monthly.start(source, f"file://{tmp_path}/c", lambda df, _: got.extend(df.collect())).awaitTermination()
    # 31 January comes after 1 February and counts; 30 January comes when the watermark has passed January's end
    assert [(str(r.month), r.total_quantity) for r in got] == [("2025-01-01", 101.0), ("2025-02-01", 30.0)]
