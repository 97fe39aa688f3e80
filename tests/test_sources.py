"""Sources, sinks, schema tools, reference tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake import schemas
from tidewake.operators.lookups import merge_with_suffix
from tidewake.session import shared_dir
from tidewake.sources import files, tables


@pytest.fixture
def reference_dir(tmp_path):
    (tmp_path / "ship_type_codes.csv").write_text(
        "type_code,type,remark\n0,Not available,\n30,Fishing,NaN\n70,Cargo,All ships of this type\nx,Bad,row\n")
    (tmp_path / "ports.csv").write_text(
        "port_id,port_name,country,latitude,longitude\n1,ALPHA,NL,52.1,4.2\n2,BETA,DE,53.5,\n3,GAMMA,GB,51.0,0.1\n")
    (tmp_path / "port_bans.csv").write_text("port_name,scrubber_status\nALPHA,1\nBETA,2\n")
    return str(tmp_path)


def test_csv_blanks_and_nan_are_null(spark, reference_dir):
    types = files.read_reference_csv(spark, reference_dir + "/ship_type_codes.csv", schemas.SHIP_TYPE_CODES)
    rows = {r["type_code"]: r for r in types.collect()}
    assert rows[0]["remark"] is None and rows[30]["remark"] is None and rows[70]["remark"] == "All ships of this type"
    assert rows[None]["type"] == "Bad"
    ports = files.read_reference_csv(spark, reference_dir + "/ports.csv", schemas.PORTS)
    assert [r["longitude"] for r in ports.orderBy("port_id").collect()] == [4.2, None, 0.1]


def test_reference_tables_update_and_recreate(spark, reference_dir, tmp_path):
    names = ["ship_type_codes", "ports", "navigational_status"]
    load = lambda mode: tables.load_reference_tables(spark, reference_dir, mode, "ref_", str(tmp_path / "wh"))
    assert load("update") == names
    assert load("update") == []
    assert load("recreate") == names
    assert {r["port_name"]: r["scrubber_status"] for r in spark.table("ref_ports").collect()} == {"ALPHA": 1, "BETA": 2, "GAMMA": 0}
    assert spark.table("ref_navigational_status").count() == 16
    assert spark.table("ref_ship_type_codes").count() == 3
    count, preview = tables.verify_table(spark, "ref_ports", 2)
    assert count == 3 and preview.count() == 2
    exported = tables.export_all_tables(spark, str(tmp_path / "out"))
    assert set("ref_" + n for n in names) <= set(exported)
    back = files.read_reference_csv(spark, f"{tmp_path}/out/ref_navigational_status", schemas.NAV_STATUS)
    assert sorted(map(tuple, back.collect())) == schemas.NAV_STATUS_ROWS
    with pytest.raises(ValueError, match="nope"):
        tables.load_table(spark, "ref_ports", require=("port_id", "nope"))


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" IMO Number ", "Length (m)", "a,B"])
    assert files.clean_column_names(df).columns == ["imo_number", "length_m", "ab"]


def test_identifier_columns(spark):
    df = spark.createDataFrame(
        [(1.0, "x", 2.5), (float("nan"), None, None), (None, "7", 1.0)], "imo double, owner_mmsi string, speed double")
    rows = [tuple(r) for r in files.coerce_identifier_columns(df).collect()]
    assert rows == [(1, "x", 2.5), (0, None, None), (0, "7", 1.0)]


def test_schema_reconciliation(spark):
    df = spark.createDataFrame([(1, "x")], "imo_number long, extra string")
    full = files.reconcile_schema(df, schemas.SHIPS_ENRICHED, {"lw_correction": False})
    assert full.columns == [*schemas.SHIPS_ENRICHED.fieldNames(), "extra"]
    assert dict(full.dtypes)["max_draught"] == "decimal(5,2)"
    assert full.first()["lw_correction"] is False and full.first()["extra"] == "x"


def test_merge_with_suffix(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "imo_number long, name string, x int")
    right = spark.createDataFrame([("1", "c", 5)], "imo_number string, name string, y int")
    merged = merge_with_suffix(left, right, "imo_number")
    assert merged.columns == ["imo_number", "name", "x", "name_wfr", "y"]
    assert [tuple(r) for r in merged.collect()] == [("1", "a", 10, "c", 5)]


def test_extract_is_partitioned_by_date(spark, fx, tmp_path):
    files.write_extract(fx.positions, str(tmp_path / "extract"))
    stored = files.read_extract(spark, str(tmp_path / "extract"))
    one_day = stored.where(F.col("date") == "2024-01-10")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one_day.count() == fx.positions.where(F.to_date("timestamp_collected") == "2024-01-10").count()
    assert stored.count() == fx.positions.count()


class Cluster:
    """Just enough of a session to ask where shared files go."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.master, self.applicationId, self.folder = master, f"app-{master}", folder
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}

    def getCheckpointDir(self):
        return None


def test_shared_dir(spark):
    assert shared_dir(spark, "a") != shared_dir(spark, "a")
    assert shared_dir(Cluster("yarn", "hdfs://shared/cp/"), "a").startswith("hdfs://shared/cp/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster("yarn"), "a")


def test_catalog_modes(spark, tmp_path):
    df = spark.range(3)
    tables.save_table(df, "modes", "overwrite", str(tmp_path / "modes"))
    tables.save_table(df, "modes", "append")
    assert spark.table("modes").count() == 6
    tables.save_table(df, "modes", "ignore")
    assert spark.table("modes").count() == 6
    assert spark.table("modes").schema == T.StructType([T.StructField("id", T.LongType())])


def test_deletes_write_back(spark, tmp_path):
    """Untouched partitions keep their files, emptied ones go, a dry run changes nothing, a second run finds nothing."""
    from tidewake.sources.writeback import rewrite_partitions

    rows = [(i, "ab c"[i % 4].strip() or None, i % 4 != 1 and i % 8 != 0) for i in range(80)]
    spark.createDataFrame(rows, "id long, part string, good boolean").select("id", "good", "part").write.partitionBy("part").option(
        "path", str(tmp_path / "t")).saveAsTable("written_back")

    def files():
        return {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}

    def good(df):
        return df.where("good")

    try:
        before = files()
        audit = rewrite_partitions(spark, "written_back", "part", good, dry_run=True)
        expected = {"a": (20, 10, 10), "b": (20, 0, 20), None: (20, 20, 0), "c": (20, 20, 0)}
        assert {r["part"]: tuple(r)[1:] for r in audit.collect()} == expected and files() == before
        rewrite_partitions(spark, "written_back", "part", good, at_a_time=1)
        after = files()
        parts = {r[0] for r in spark.sql("SHOW PARTITIONS written_back").collect()}
        assert "part=b" not in parts and len(parts) == 3 and after["part=c"] == before["part=c"] and after["part=a"] != before["part=a"]
        assert sorted(r["id"] for r in spark.read.table("written_back").collect()) == [i for i, _, keep in rows if keep]
        assert rewrite_partitions(spark, "written_back", "part", good).agg({"deleted": "sum"}).first()[0] == 0 and files() == after
    finally:
        spark.sql("DROP TABLE IF EXISTS written_back")
