import datetime as dt
import re
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from monsoon.operators import baselines, features, supervise
from monsoon.operators.dataset import guarded_fact
from monsoon.operators.panel import guarded_panel
from monsoon.plans.stages import Demand
from monsoon.schema import PAIR, DataError
from monsoon.sources import digests, stages
from monsoon.sources.stages import Guards, bucketed, repeats
from monsoon.sources.store import MANIFEST, RunStore
from monsoon.sources.stored import store
from monsoon.sources.tables import Database

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# ---- stages


def test_windows_horizons_and_states_read_stages_without_an_exchange(spark):
    d = Demand(spark, SF)
    for df in (features.pair_features(d.pair_panel), baselines.intermittent_states(d.pair_panel), supervise.expand(d.pair_origin, PAIR, supervise.PAIR_TARGETS), supervise.expand(d.known, PAIR, supervise.PAIR_TARGETS)):
        text = plan(df)
        assert "Window" in text and "Exchange" not in text and "lineitem" not in text


def test_stages_are_those_of_the_lazy_plan_and_are_built_once(spark):
    stored, lazy = Demand(spark, SF), Demand(spark, SF, stored=False)
    for name in ("fact", "pair_panel", "known", "pair_origin"):
        a, b = (x.withColumns({c: F.round(c, 3) for c, kind in x.dtypes if kind == "double"}) for x in (getattr(stored, name), getattr(lazy, name)))  # sums of doubles depend on their order
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    again = Demand(spark, SF)
    assert again.fact.inputFiles() == stored.fact.inputFiles()
    assert jobs_of(spark, lambda: again.known.schema) == 0


def test_a_stage_follows_its_files(spark, tmp_path):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    path = f"file://{tmp_path}/t"
    one.write.parquet(path)
    first = stages.fingerprint(spark, [path])
    assert first == stages.fingerprint(spark, [path])
    one.write.mode("append").parquet(path)
    assert first != stages.fingerprint(spark, [path])


# ---- guards


def rows(spark, spoil=lambda r: r):
    found = [spoil(r) for r in [("A", "1", dt.date(2025, m, 1), 5.0, 0.0, 2, 2) for m in range(1, 7)]]
    return spark.createDataFrame(found, "base_sku string, branch_code string, month date, gross_positive_m2 double, negative_m2 double, observed_source_row_count long, observed_bravo_count long")


@pytest.mark.parametrize(("name", "spoil"), [
    ("wrong_sign", lambda r: (*r[:3], -1.0 if r[2].month == 3 else 5.0, *r[4:])), ("source_key_repeated", lambda r: (*r[:5], 3, 2)), ("key_missing", lambda r: ("A", None if r[2].month == 2 else "1", *r[2:])),
])
def test_spoiled_facts_raise_and_leave_no_table(spark, name, spoil):
    before = {t.name for t in spark.catalog.listTables()}
    guards = Guards("fact")
    with pytest.raises(DataError, match=name):
        bucketed(guarded_fact(rows(spark, spoil), guards), "t", PAIR, "month", guards, 2)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_guards_cost_no_job(spark):
    df = rows(spark)
    plain = jobs_of(spark, lambda: bucketed(df, "t", PAIR, "month", None, 2))
    guards = Guards("fact")
    assert jobs_of(spark, lambda: bucketed(guarded_fact(df, guards), "t", PAIR, "month", guards, 2)) == plain
    assert set(guards.counts().values()) == {0}
    with pytest.raises(DataError, match="no_rows"):
        guards = Guards("fact")
        bucketed(guarded_fact(df.where("false"), guards), "t", PAIR, "month", guards, 2)


def test_repeated_and_missing_months_of_a_panel_raise(spark):
    panel = Demand(spark, SF).pair_panel
    pair = panel.where("month = first_observed_month and month < date'1999-01-01'").orderBy(*PAIR).first()
    part = panel.where((F.col("base_sku") == pair.base_sku) & (F.col("branch_code") == pair.branch_code)).persist()
    assert part.count() > 30
    late = F.col("month") == F.lit("2001-05-01").cast("date")
    for name, df in {"row_repeated": part.unionByName(part.limit(1)), "month_missing": part.where(~late), "looks_ahead": part.withColumn("first_positive_month_to_date", F.add_months("month", 1))}.items():
        guards = Guards("panel")
        guarded_panel(df, guards).write.format("noop").mode("overwrite").save()
        with pytest.raises(DataError, match=name):
            guards.check()
    part.unpersist()


def test_guards_of_the_sales_see_months(spark):
    from monsoon.operators.dataset import prepare_sales

    sales = spark.createDataFrame([("a", "1", "M2", dt.date(2025, 1, 2), 1.0, 1.0, 1)], "bravo_sku string, branch_code string, unit string, month date, total_quantity double, total_amount double, line_count long")
    guards = Guards("sales")
    prepare_sales(sales, guards=guards).collect()
    with pytest.raises(DataError, match="month_not_aligned"):
        guards.check()
    assert [r.again for r in sales.unionByName(sales).select(repeats(["bravo_sku"], "month").alias("again")).collect()].count(True) == 1


# ---- runs


def test_of_two_writers_one_wins(spark, tmp_path):
    shelf = RunStore(spark, tmp_path)
    runs = [shelf.begin("r_1") for _ in range(4)]
    for i, run in enumerate(runs):
        run.put("who.txt", str(i))
    won, lost = [], []

    def finish(i):
        try:
            won.append((i, runs[i].finish(rows=i)))
        except FileExistsError:
            lost.append(i)

    threads = [threading.Thread(target=finish, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 3
    i, path = won[0]
    assert shelf.files.read(f"{path}/who.txt") == str(i) and shelf.manifest("r_1")["rows"] == i and shelf.latest("r_") == path
    assert shelf.files.names(f"{shelf.root}/staging") == []
    with pytest.raises(FileExistsError):
        shelf.begin("r_1")


def test_a_killed_run_is_none_and_a_killed_publication_is_finished(spark, tmp_path):
    shelf = RunStore(spark, tmp_path)
    assert shelf.latest() is None
    first = shelf.begin("r_1").finish(status="PASS")
    killed = shelf.begin("r_2")
    killed.put("part.txt", "half")
    assert shelf.latest() == first
    with pytest.raises(FileNotFoundError):
        shelf.open("r_2")
    again = shelf.begin("r_2")
    again.put("part.txt", "whole")
    again.put_json(MANIFEST, {"status": "PASS"})
    assert shelf.files.create(shelf.marker("r_2"), again.path)  # killed before the rename
    path = shelf.latest()
    assert path.endswith("runs/r_2") and shelf.files.read(f"{path}/part.txt") == "whole"
    with pytest.raises(FileExistsError):
        killed.finish()  # comes back too late
    assert shelf.files.read(f"{shelf.open('r_2')}/part.txt") == "whole"


def test_pointers_snapshots_and_names(spark, tmp_path):
    from monsoon.sources.contracts import GateError

    (tmp_path / "c.yaml").write_text("a: é\n")
    shelf = RunStore(spark, tmp_path / "s")
    run = shelf.begin("r_1")
    found = run.snapshot([f"file://{tmp_path}/c.yaml"])
    assert len(found["c.yaml"]) == 64 and shelf.files.read(run.at("contracts/c.yaml")) == "a: é\n"
    with pytest.raises(FileExistsError):
        run.snapshot([f"file://{tmp_path}/c.yaml"])
    run.finish()
    shelf.publish("current", "r_1", status="PASS", version="1")
    shelf.publish("current", "r_1", status="PASS", version="2")
    assert shelf.resolve("current", version="2")["run_id"] == "r_1"
    with pytest.raises(GateError):
        shelf.resolve("current", version="1")
    with pytest.raises(FileNotFoundError):
        shelf.publish("current", "r_9")
    for bad in ("", "a/b", ".x"):
        with pytest.raises(ValueError):
            shelf.begin(bad)


# ---- digests


def test_digests_name_the_part_that_changed(spark, tmp_path):
    import os

    folder = tmp_path / "data" / "deep"
    folder.mkdir(parents=True)
    (tmp_path / "data" / "a.bin").write_bytes(os.urandom(10_000))
    (folder / "b.bin").write_bytes(os.urandom(4_500))
    (folder / "empty.bin").write_bytes(b"")
    (folder / "_hidden").write_bytes(b"x")
    url = f"file://{tmp_path}/data"
    before = store(digests.part_digests(digests.contents(spark, url), 1000), "digests")
    assert {(r.file, r.n) for r in before.groupBy("file").agg(F.count("*").alias("n")).collect()} == {("a.bin", 10), ("deep/b.bin", 5)}
    root = digests.tree(spark, url, 1000).first()
    assert root.n_files == 2 and digests.root_digest(digests.bucket_digests(digests.file_digests(before.repartition(7)))).first() == root
    digests.verify(spark, url, before, 1000)
    data = bytearray((tmp_path / "data" / "a.bin").read_bytes())
    data[3500] ^= 1
    (tmp_path / "data" / "a.bin").write_bytes(data)
    (folder / "c.bin").write_bytes(b"new")
    (folder / "b.bin").unlink()
    now = digests.part_digests(digests.contents(spark, url), 1000)
    assert {tuple(r) for r in digests.changes(before, now).collect()} == {("a.bin", 3, "CHANGED"), ("deep/c.bin", 0, "ADDED"), *(("deep/b.bin", i, "REMOVED") for i in range(5))}
    assert digests.tree(spark, url, 1000).first().digest != root.digest
    with pytest.raises(ValueError, match=re.escape("('a.bin', 3, 'CHANGED')")):
        digests.verify(spark, url, before, 1000)


@pytest.mark.parametrize("whole,piece,part,block", [(0, 1000, 1000, 3000), (0, 777, 1000, 1024), (5000, 4096, 512, 700), (0, 1 << 22, 1 << 16, 1 << 20)])
def test_long_files_are_digested_in_pieces(spark, tmp_path, whole, piece, part, block):
    import hashlib
    import os

    folder = tmp_path / "data" / "deep"
    folder.mkdir(parents=True)
    mark = b"\xef\xbb\xbf"
    held = {
        "a b%.bin": os.urandom(20_000), "lines": b"\n" * 3000 + b"x" * 9000 + b"\r\n" * 1000, "ends.bin": os.urandom(5000) + b"\n", "one": b"y" * 6000, "mark": mark + os.urandom(9000), "mark2": mark + b"\n" * 4001,
        "marked": mark, "short": b"z", "deep/c.gz": os.urandom(8000), "deep/twice": mark + mark + b"q\n" + os.urandom(3000) + b"\r",
    }
    for name, data in held.items():
        (tmp_path / "data" / name).write_bytes(data)
    (folder / "_hidden").write_bytes(b"h" * 9000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = digests.contents(spark, f"file://{tmp_path}/data", whole, piece)
        longest = found.where("file not like '%.gz'").agg(F.max(F.octet_length("content"))).first()[0]
        got = {(r.file, r.part): (r.n_bytes, r.digest) for r in digests.part_digests(found, part).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert longest <= max(whole, piece)
    assert got == {(f, i): (len(d[i * part : (i + 1) * part]), hashlib.sha256(d[i * part : (i + 1) * part]).hexdigest()) for f, d in held.items() for i in range(-(-len(d) // part))}


def test_files_above_two_gigabytes_have_digests(spark, tmp_path):
    size = (1 << 31) + 12_345
    with open(tmp_path / "big.bin", "wb") as file:  # sparse but for line feeds
        for at in range(0, size, 1 << 20):
            file.seek(at)
            file.write(b"\n")
        file.truncate(size)
    parts = digests.part_digests(digests.contents(spark, f"file://{tmp_path}/big.bin"))
    assert parts.agg(F.count("*"), F.sum("n_bytes"), F.countDistinct("digest")).first() == (513, size, 2)


# ---- databases

FROZEN = "CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY('derby.database.defaultConnectionMode', '{}')"


def test_a_database_is_read_in_parts_and_in_one_state(spark):
    url, driver = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    base = Database(spark, url, driver, freeze=[FROZEN.format("readOnlyAccess")], thaw=[], session=None)
    rows = [(i if i % 11 else None, f"it's {i % 7}", dt.date(2025, 1 + i % 12, 1), i / 4) for i in range(500)] + [(3, "hot", None, None)] * 300
    df = spark.createDataFrame(rows, "k int, s string, d date, x double")
    df.write.jdbc(url, "t", properties={"driver": driver, "createTableColumnTypes": "s VARCHAR(20)"})
    with base.reading() as read:
        for column in ('"k"', '"s"', '"d"'):
            got = read("t", column, 5)
            assert got.rdd.getNumPartitions() > 1 and got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
        with pytest.raises(Exception, match="(?i)read.only"):
            df.limit(1).write.mode("append").jdbc(url, "t", properties={"driver": driver})
    assert Database.predicates("k", [], False) == ["1 = 1"] and base.bounds("t", '"x"', 1) == []
    assert len(base.bounds("t", '"k"', 50)) < 50  # equal values are not cut
