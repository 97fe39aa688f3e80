"""Streams in several micro-batches against the batch operators."""

import time

import pytest
from pyspark.sql import functions as F

from checks.rows import region
from tidewake.operators.lookups import enrich_ships, resolve_identity
from tidewake.operators.maintain import correct_dimensions, correction_counters, upsert_ships
from tidewake.operators.temporal import asof_latest_within
from tidewake.schemas import SHIPS
from tidewake.sources.messages import identified_statics, ingest, read_messages
from tidewake.streaming import ingest as jobs
from tidewake.streaming import state


@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    """The messages in four files, oldest first, as a stream of one file per micro-batch."""
    from checks.fixtures import Fixtures
    from tests.conftest import SMALL

    folder = tmp_path_factory.mktemp("messages")
    messages = Fixtures(spark, SMALL).messages.withColumnRenamed("event_id", "seq").persist()
    for i in range(4):
        messages.where((F.col("seq") >= i * 250) & (F.col("seq") < (i + 1) * 250)).coalesce(1).write.mode("append").parquet(str(folder))
    yield messages, lambda: spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    messages.unpersist()


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query.lastProgress


def test_routing_equals_batch(spark, fx, slices, tmp_path, same):
    messages, stream = slices
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    run(jobs.start_routing(stream(), region(fx), path, checkpoint))
    run(jobs.start_routing(stream(), region(fx), path, checkpoint))  # a restart adds nothing
    expected = ingest(messages, region(fx))
    same(spark.read.parquet(path).select(expected.columns), expected)


def test_collector_over_several_batches(spark, fx, slices, tmp_path, same):
    messages, stream = slices
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    progress = run(jobs.start_collector(stream(), region(fx), path, checkpoint, keep_unknown=True))
    assert progress["batchId"] >= 3
    run(jobs.start_collector(stream(), region(fx), path, checkpoint, keep_unknown=True))  # a restart adds nothing
    routed = ingest(messages, region(fx))
    statics = routed.where("route = 'static'")
    ships = upsert_ships(statics)
    same(jobs.current_ships(spark, checkpoint).select(ships.columns), ships)
    newest = jobs.collected(spark, path, "ships").groupBy("imo_number").agg(F.max_by(F.struct("mmsi", "name"), "seq").alias("x"))
    same(newest.select("imo_number", "x.*"), ships.select("imo_number", "mmsi", "name"))
    assert jobs.collected(spark, path, "static_log").count() == statics.count()

    reports = routed.where("route = 'position'").drop("imo_number")
    named = resolve_identity(reports, statics, ships.limit(0))
    found = asof_latest_within(
        named.where("imo_number IS NOT NULL"), statics, "imo_number", "timestamp_ais", "seq", "destination", 5 * 3600,
    ).select("seq", "imo_number", F.col("recent_destination").alias("destination"))
    assert same(jobs.collected(spark, path, "positions").select("seq", "imo_number", "destination"), found) > 0
    unknown = jobs.collected(spark, path, "unknown_ships").where("sog IS NOT NULL")
    assert unknown.count() == named.where("imo_number IS NULL").count()


def test_batches_do_not_matter(spark, fx, slices, tmp_path, same):
    """Four micro-batches and a single one give the same tables and the same master."""
    messages, stream = slices
    messages.write.parquet(str(tmp_path / "whole"))
    one = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "whole"))
    for name, source in (("many", stream()), ("one", one)):
        run(jobs.start_collector(source, region(fx), str(tmp_path / name), str(tmp_path / f"{name}-cp"), keep_unknown=True))
    for table in ("positions", "static_log", "unknown_ships"):
        assert same(*(jobs.collected(spark, str(tmp_path / name), table) for name in ("many", "one"))) > 0
    same(*(jobs.current_ships(spark, str(tmp_path / f"{name}-cp")) for name in ("many", "one")))


def test_failed_batch_leaves_nothing_visible(spark, fx, slices, tmp_path, same):
    """A batch that breaks off while it writes shows in no table; the restart makes up for it."""
    messages, stream = slices
    path, checkpoint, flag = str(tmp_path / "out"), str(tmp_path / "cp"), tmp_path / "broken"
    flag.touch()

    @F.udf("string")
    def fragile(raw, seq):
        from pathlib import Path

        if seq == 400 and Path(str(flag)).exists():
            raise ValueError("broken")
        return raw

    def source():
        return stream().withColumn("raw", fragile("raw", "seq"))

    query = jobs.start_collector(source(), region(fx), path, checkpoint, keep_unknown=True)
    with pytest.raises(Exception, match="broken"):
        query.awaitTermination()
    seen = spark.read.parquet(path)
    assert seen.agg(F.max("seq")).first()[0] < 250 and seen.select("table").distinct().count() == 4
    flag.unlink()
    run(jobs.start_collector(source(), region(fx), path, checkpoint, keep_unknown=True))
    whole = str(tmp_path / "whole")
    run(jobs.start_collector(stream(), region(fx), whole, str(tmp_path / "whole-cp"), keep_unknown=True))
    same(spark.read.parquet(path), spark.read.parquet(whole))


def test_batch_reads_only_its_own_rows(spark, fx, slices, tmp_path):
    """No micro-batch reads a table that an earlier one has written."""
    _, stream = slices
    query = jobs.start_collector(stream(), region(fx), str(tmp_path / "out"), str(tmp_path / "cp"))
    run(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [250] * 4
    for progress in query.recentProgress:
        assert len(progress["sources"]) == 1 and len(progress["stateOperators"]) == 2


def test_dimension_fix_over_several_batches(spark, fx, slices, tmp_path, same):
    messages, stream = slices
    ships = fx.ships.select("imo_number", "mmsi", "length", "width")
    checkpoint = str(tmp_path / "cp")
    run(jobs.start_dimension_fix(stream(), region(fx), ships, checkpoint))
    statics = identified_statics(ingest(messages, region(fx)))
    expected = correct_dimensions(ships, statics)
    same(jobs.corrected_ships(ships, checkpoint).select(expected.columns), expected)
    run(jobs.start_dimension_fix(stream(), region(fx), ships, checkpoint))  # a restart changes nothing
    same(jobs.corrected_ships(ships, checkpoint).select(expected.columns), expected)
    assert jobs.corrections(spark, checkpoint).count() == expected.where("lw_correction").count()


def test_minute_metrics_total(spark, fx, slices, tmp_path):
    """Every minute is written, and a repeated or late message is not lost."""
    messages, stream = slices
    timed = ingest(stream(), region(fx)).withColumn("ts", F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("seq") * 3))
    checkpoint = str(tmp_path / "cp")
    run(jobs.start_metrics(timed, checkpoint))
    routed = ingest(messages, region(fx))
    totals = jobs.running_totals(spark, checkpoint).first()
    minutes = jobs.minute_metrics(spark, checkpoint).agg(*[F.sum(c).alias(c) for c in jobs.COUNTERS], F.count("minute").alias("n")).first()
    assert minutes["n"] == 50
    for c in jobs.COUNTERS:
        assert minutes[c] == totals[c]
    assert totals["static_data"] == routed.where("route = 'static'").count()
    assert totals["filtered"] == routed.where("route = 'outside'").count()
    assert totals["position_data"] + totals["no_imo"] == routed.where("route IN ('position', 'no_imo')").count()
    assert 0 < totals["vessels_with_imo"] <= totals["unique_vessels"]


def test_identity_holds_over_batches(spark, fx, tmp_path):
    """A ship changes its MMSI; a report with the new one finds it in a later batch."""
    def static(seq, mmsi):
        return (seq, f'{{"MessageType":"ShipStaticData","MetaData":{{"MMSI":{mmsi},"latitude":52.0,"longitude":2.0,"time_utc":"2024-01-01 00:00:0{seq}.1 +0000 UTC"}},'
                     f'"Message":{{"ShipStaticData":{{"ImoNumber":1000}}}}}}')

    report = (3, '{"MessageType":"PositionReport","MetaData":{"MMSI":222,"latitude":52.0,"longitude":2.0,"time_utc":"2024-01-01 00:00:09.1 +0000 UTC"},'
                 '"Message":{"PositionReport":{"Sog":1}}}')
    landed, path, checkpoint = (str(tmp_path / x) for x in ("landed", "out", "cp"))
    for row in (static(1, 111), static(2, 222), report):
        spark.createDataFrame([row], "seq long, raw string").write.mode("append").parquet(landed)
        run(jobs.start_collector(spark.readStream.schema("seq long, raw string").parquet(landed), region(fx), path, checkpoint))
    assert [r["imo_number"] for r in jobs.collected(spark, path, "positions").collect()] == [1000]
    ships = jobs.current_ships(spark, checkpoint).collect()
    assert [(r["imo_number"], r["mmsi"]) for r in ships] == [(1000, 111)]


def test_state_by_bucket(spark, fx, tmp_path, same, monkeypatch):
    """Calls for state go by buckets of vessels and by parts of counters, not by vessel, ship, day or minute."""
    monkeypatch.setattr(jobs, "BUCKETS", 4, raising=False)
    monkeypatch.setattr(state, "PART", 100, raising=False)
    vessel = F.col("seq") % 100
    common = (F.lit('"MetaData":{"MMSI":'), (vessel + 1).cast("string"), F.lit(',"latitude":52.0,"longitude":2.0,"time_utc":"2024-01-01 0'), (F.col("seq") % 8).cast("string"), F.lit(':00:00.1 +0000 UTC"}'))
    static = F.concat(F.lit('{"MessageType":"ShipStaticData",'), *common, F.lit(',"Message":{"ShipStaticData":{"ImoNumber":'), (vessel + 1000).cast("string"), F.lit(',"Destination":"D'), F.col("seq").cast("string"), F.lit('"}}}'))
    report = F.concat(F.lit('{"MessageType":"PositionReport",'), *common, F.lit(',"Message":{"PositionReport":{"Sog":1}}}'))
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("seq").cast("int"))
    messages = spark.range(1200).withColumnRenamed("id", "seq").select("seq", F.when(F.col("seq") % 300 < 100, static).otherwise(report).alias("raw"), at.alias("ts"))
    for i in range(2):
        messages.where(F.col("seq") % 2 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "in"))
    path = str(tmp_path / "out")
    query = jobs.start_collector(stream.drop("ts"), region(fx), path, path + "-cp")
    run(query)
    first = query.recentProgress[0]["stateOperators"]
    assert sum(o["numRowsUpdated"] for o in first) <= 4 * (1 + 1 + 8)
    routed = ingest(messages, region(fx))
    statics = routed.where("route = 'static'")
    named = resolve_identity(routed.where("route = 'position'").drop("imo_number"), statics, fx.ships.limit(0))
    found = asof_latest_within(named, statics, "imo_number", "timestamp_ais", "seq", "destination", 5 * 3600)
    got = jobs.collected(spark, path, "positions").select("seq", "imo_number", "destination")
    assert same(got, found.select("seq", "imo_number", F.col("recent_destination").alias("destination"))) == 800
    same(jobs.current_ships(spark, path + "-cp"), upsert_ships(statics).drop("seq"))

    # The counters of a vessel that is cut off from its others by a restart and by full parts add up.
    cut, checkpoint = str(tmp_path / "cut"), str(tmp_path / "cut-cp")
    for low in (0, 500):
        messages.where((F.col("seq") >= low) & (F.col("seq") < low + 700)).write.mode("append").parquet(cut)
        query = jobs.start_metrics(ingest(spark.readStream.schema(messages.schema).parquet(cut), region(fx)), checkpoint)
        run(query)
        assert query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] <= 4 * (1 + 1 + 4)
    minutes = jobs.minute_metrics(spark, checkpoint)
    assert minutes.count() == 1200 and minutes.where("collected = 2 AND unique_vessels = 1").count() == 200
    total = jobs.running_totals(spark, checkpoint).first()
    assert (total["collected"], total["static_data"], total["unique_vessels"], total["vessels_with_imo"]) == (1400, 500, 100, 100)


def test_correction_needs_no_time(spark, fx, tmp_path):
    raw = '{"MessageType":"ShipStaticData","MetaData":{"MMSI":1,"latitude":52.0,"longitude":2.0,"time_utc":"bad"},"Message":{"ShipStaticData":{"ImoNumber":1000,"Dimension":{"A":5,"B":6}}}}'
    routed = ingest(spark.createDataFrame([(1, raw)], "seq long, raw string"), region(fx))
    assert routed.first()["route"] == "quarantine"
    ships = spark.createDataFrame([(1000, 1, 1, 1)], "imo_number long, mmsi long, length int, width int")
    fixed = correct_dimensions(ships, identified_statics(routed)).first()
    assert (fixed["length"], fixed["width"], fixed["lw_correction"]) == (11, None, True)
    assert tuple(correction_counters(ships, identified_statics(routed)).first()) == (1, 1, 0)


def test_mistyped_fields_cost_only_themselves(spark, fx):
    rows = [
        '{"MessageType":"PositionReport","MetaData":{"MMSI":"5","latitude":"52.5","longitude":2.0,"time_utc":"2024-01-01 00:00:00.1 +0000 UTC"},'
        '"Message":{"PositionReport":{"TrueHeading":90.0,"NavigationalStatus":"5","Sog":"x","Cog":1}}}',
        '{"MessageType":"ShipStaticData","MetaData":{"MMSI":6,"latitude":52.5,"longitude":2,"time_utc":"2024-01-01 00:00:00.1 +0000 UTC"},'
        '"Message":{"ShipStaticData":{"ImoNumber":7,"Type":"70","Name":null,"Dimension":{"A":1.5,"B":20,"C":"3","D":4}}}}',
        '{"MessageType":"ShipStaticData","MetaData":{"MMSI":6,"latitude":52.5,"longitude":2,"time_utc":"2024-01-01 00:00:00.1 +0000 UTC"},'
        '"Message":{"ShipStaticData":{"ImoNumber":8,"Dimension":5}}}',
        '[1]', '{"a":',
    ]
    out = ingest(spark.createDataFrame(list(enumerate(rows)), "seq long, raw string"), region(fx)).orderBy("seq").collect()
    assert [r["reject"] for r in out] == [None, None, None, "no_type", "malformed"]
    a, b, c = out[:3]
    assert (a["mmsi"], a["latitude"], a["true_heading"], a["navigational_status_code"], a["sog"], a["cog"]) == (5, 52.5, 90, 5, None, 1.0)
    assert (b["ship_type"], b["name"], b["destination"], b["length"], b["width"]) == ("70", None, "Unknown", 22, 7)
    assert (c["imo_number"], c["name"], c["length"]) == (8, "Unknown", None)


def test_ship_enrichment_stream(spark, fx, tmp_path, same):
    fx.ships.write.parquet(str(tmp_path / "ships"))
    stream = spark.readStream.schema(fx.ships.schema).parquet(str(tmp_path / "ships"))
    run(jobs.start_enrichment(stream, fx.ship_type_codes, str(tmp_path / "out"), str(tmp_path / "cp"), enrich=enrich_ships))
    expected = enrich_ships(fx.ships, fx.ship_type_codes)
    same(spark.read.parquet(str(tmp_path / "out")).select(expected.columns), expected)


def test_text_source(spark, fx, tmp_path):
    fx.messages.select("raw").write.text(str(tmp_path / "landed"))
    assert read_messages(spark, str(tmp_path / "landed"), streaming=False).count() == fx.messages.count()
    stream = read_messages(spark, str(tmp_path / "landed"), max_files=1)
    assert stream.isStreaming and stream.columns == ["raw"]


def test_messages_without_type_or_position(spark, fx):
    rows = [
        ('{"MetaData":{"latitude":52.0,"longitude":2.0}}', "no_type"),
        ('{"MessageType":"PositionReport","MetaData":{"latitude":null,"longitude":2.0}}', "no_position"),
        ('{"MessageType":"PositionReport"}', "no_position"),
        ("not json", "malformed"),
        (None, "malformed"),
        ('{"MessageType":"Other","MetaData":{"MMSI":5,"latitude":52.0,"longitude":2.0,"time_utc":"2024-01-01 00:00:00.1 +0000 UTC"}}', None),
    ]
    raw = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "seq long, raw string")
    out = ingest(raw, region(fx)).orderBy("seq").collect()
    assert [r["reject"] for r in out] == [r[1] for r in rows]
    assert [r["route"] for r in out] == ["quarantine"] * 5 + ["other"]


def test_upsert_keeps_first_mmsi_and_lets_nulls_overwrite(spark):
    log = spark.createDataFrame(
        [(1, 7, 11, "OLD", "70", 5, 6, None), (2, 7, 12, "NEW", None, None, 9, None)],
        "seq long, imo_number long, mmsi long, name string, ship_type string, length int, width int, max_draught double",
    )
    assert tuple(upsert_ships(log).select(SHIPS.fieldNames()).first()) == (7, 11, "NEW", None, None, 9, None)


def test_trigger_of_ten_seconds(spark, fx, slices, tmp_path):
    """The running form commits by itself, a file per micro-batch."""
    query = jobs.start_routing(slices[1](), region(fx), str(tmp_path / "out"), str(tmp_path / "cp"), once=False)
    try:
        deadline = time.monotonic() + 60
        while query.lastProgress is None and time.monotonic() < deadline:
            time.sleep(0.5)
        assert query.isActive and query.lastProgress["numInputRows"] > 0
    finally:
        query.stop()
