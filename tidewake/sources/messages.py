"""Raw JSON messages: sources, parsing, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions.ais import parse_ais_timestamp, vessel_dimensions
from tidewake.operators.regions import within_region
from tidewake.schemas import MESSAGE


def read_messages(spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None) -> DataFrame:
    """Landed text files, one message per line, as column ``raw``."""
    if not streaming:
        return spark.read.text(path).withColumnRenamed("value", "raw")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).withColumnRenamed("value", "raw")


def read_kafka_messages(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
                        max_offsets: int | None = None, **options: str) -> DataFrame:
    """Messages of a Kafka topic as ``raw``, with ``seq`` from their log time and offset.

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic}, **options
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    # Log time, partition and offset as one number: no two messages share it.
    order = (
        F.unix_millis("timestamp").cast("decimal(13,0)") * F.lit("1000000000000000000000000").cast("decimal(25,0)")
        + F.col("partition").cast("decimal(5,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col("offset")
    ).cast("decimal(38,0)")
    return reader.load().select(F.col("value").cast("string").alias("raw"), order.alias("seq"))


def parse_messages(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Flat fields of both message types beside the other columns, and ``reject``.

    ``reject`` says why a message cannot be used (malformed, no_type,
    no_position, bad_time) or is NULL; malformed is only what is no JSON. Fields
    are read as text first and then cast one by one, so a field of another type
    costs at most itself. Missing fields are NULL, a missing name or destination
    of a ship message is 'Unknown'.
    """
    parsed = raw.withColumn("_m", F.from_json(column, MESSAGE, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    meta, static, report = F.col("_m.MetaData"), F.col("_m.Message.ShipStaticData"), F.col("_m.Message.PositionReport")
    # Columns of their own, so that each is worked out once.
    parsed = parsed.withColumns({
        "_time": parse_ais_timestamp(meta["time_utc"]), "_sides": F.from_json(static["Dimension"], "map<string,string>"),
    })
    is_static = F.col("_m.MessageType") == "ShipStaticData"
    is_report = F.col("_m.MessageType") == "PositionReport"
    length, width = vessel_dimensions({side: number(F.col("_sides")[side]) for side in "ABCD"})
    ts = F.col("_time")

    def text(name: str) -> Column:
        # A field that is there but null stays null.
        absent = ~F.coalesce(F.map_contains_key(static, name), F.lit(False))
        return F.when(is_static, F.when(absent, F.lit("Unknown")).otherwise(static[name]))

    fields = {
        "message_type": F.col("_m.MessageType"), "mmsi": whole(meta["MMSI"]),
        "latitude": number(meta["latitude"]), "longitude": number(meta["longitude"]), "timestamp_ais": ts,
        "raw_imo": F.when(is_static, whole(static["ImoNumber"])), "name": text("Name"),
        "ship_type": F.when(is_static, static["Type"]),
        "length": F.when(is_static, length), "width": F.when(is_static, width),
        "max_draught": F.when(is_static, number(static["MaximumStaticDraught"])),
        "destination": text("Destination"),
        "sog": F.when(is_report, number(report["Sog"])), "cog": F.when(is_report, number(report["Cog"])),
        "navigational_status_code": F.when(is_report, whole(report["NavigationalStatus"]).try_cast("int")),
        "rate_of_turn": F.when(is_report, number(report["RateOfTurn"])),
        "true_heading": F.when(is_report, whole(report["TrueHeading"]).try_cast("int")),
    }
    reject = (
        # Most messages fit the schema; only of the others it has to be known whether they are JSON at all.
        F.when(F.col(column).isNull() | (F.col("_m._corrupt_record").isNotNull() & F.try_parse_json(F.col(column)).isNull()), "malformed")
        .when(F.col("_m.MessageType").isNull(), "no_type")
        .when(F.col("latitude").isNull() | F.col("longitude").isNull(), "no_position")
        .when(F.col("timestamp_ais").isNull(), "bad_time")
    )
    kept = [c for c in raw.columns if c != column]
    flat = parsed.select(*kept, column, "_m", *[v.alias(k) for k, v in fields.items()])
    return flat.withColumn("reject", reject).drop("_m")


def number(text: Column) -> Column:
    """A field as a number, whichever JSON type it has; NULL if it is none."""
    return F.nanvl(text.try_cast("double"), F.lit(None))


def whole(text: Column) -> Column:
    """A field as a whole number; fractions are rounded."""
    return F.coalesce(text.try_cast("bigint"), F.round(number(text)).try_cast("bigint"))


def route_messages(df: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Add ``imo_number`` and ``route`` to region-flagged messages.

    Routes: quarantine (unusable), outside (not in the region), static (ship
    message with identity), position, unknown (ship message without identity,
    dropped as no_imo unless ``keep_unknown``) and other. The region is tested
    before the time, so a message with a bad time outside the region is
    'outside'. Unknown identity is -1 for a missing and 0 for a zero number.
    """
    unusable = F.col("reject").isin("malformed", "no_type", "no_position")
    static, report = F.col("message_type") == "ShipStaticData", F.col("message_type") == "PositionReport"
    identified = F.col("raw_imo").isNotNull() & (F.col("raw_imo") != 0)
    route = (
        F.when(unusable, "quarantine")
        .when(~F.col("in_region"), "outside")
        .when(F.col("reject").isNotNull(), "quarantine")
        .when(static & identified, "static")
        .when(static, "unknown" if keep_unknown else "no_imo")
        .when(report, "position")
        .otherwise("other")
    )
    imo = F.when(static & identified, F.col("raw_imo")).when(static & F.col("raw_imo").isNull(), F.lit(-1)).when(
        static, F.lit(0))
    return df.withColumns({"imo_number": imo.cast("bigint"), "route": route})


def ingest(raw: DataFrame, rings: DataFrame, keep_unknown: bool = False, column: str = "raw") -> DataFrame:
    """Parse, test the region and route; the same for streams and tables. Raw text is kept only in quarantine."""
    routed = route_messages(within_region(parse_messages(raw, column), rings), keep_unknown)
    return routed.withColumn(column, F.when(F.col("route") == "quarantine", F.col(column)))


def identified_statics(ingested: DataFrame) -> DataFrame:
    """Ship messages with an identity inside the region, whether or not their time is legal."""
    usable = F.col("reject").isNull() | (F.col("reject") == "bad_time")
    named = (F.col("message_type") == "ShipStaticData") & F.col("raw_imo").isNotNull() & (F.col("raw_imo") != 0)
    return ingested.where(usable & F.col("in_region") & named)
