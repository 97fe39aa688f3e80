"""Declared schemas of the tables and of the JSON messages."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _TEXT, _REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
_TIME, _FLAG = T.TimestampNTZType(), T.BooleanType()
_RATE = T.DecimalType(5, 2)

SHIPS = _struct(
    imo_number=_LONG, mmsi=_LONG, name=_TEXT, ship_type=_TEXT, length=_INT, width=_INT, max_draught=_RATE,
)
SHIPS_ENRICHED = T.StructType(
    SHIPS.fields
    + _struct(type_name=_TEXT, type_remark=_TEXT, lw_correction=_FLAG, lw_correction_timestamp=_TIME).fields
)
POSITIONS = _struct(
    id=_LONG, imo_number=_LONG, timestamp_collected=_TIME, timestamp_ais=_TIME, latitude=_REAL, longitude=_REAL,
    destination=_TEXT, sog=_RATE, cog=_RATE, navigational_status_code=_INT, rate_of_turn=_RATE, true_heading=_INT,
)
STATIC_LOG = _struct(
    imo_number=_LONG, mmsi=_LONG, name=_TEXT, ship_type=_TEXT, length=_INT, width=_INT, max_draught=_RATE,
    destination=_TEXT, timestamp_ais=_TIME, latitude=_REAL, longitude=_REAL,
)
UNKNOWN_SHIPS = T.StructType(
    STATIC_LOG.fields
    + _struct(sog=_RATE, cog=_RATE, navigational_status_code=_INT, rate_of_turn=_RATE, true_heading=_INT).fields
)
SHIP_TYPE_CODES = _struct(type_code=_INT, type=_TEXT, remark=_TEXT)
PORTS = _struct(port_id=_INT, port_name=_TEXT, country=_TEXT, latitude=_REAL, longitude=_REAL)
PORT_BANS = _struct(port_name=_TEXT, scrubber_status=_INT)
NAV_STATUS = _struct(navigational_status_code=_INT, navigational_status=_TEXT)
DAILY_POLLUTION = _struct(date=T.DateType(), country=_TEXT, pollution=_REAL)

# The columns of the extract.
EXTRACT_COLUMNS = [
    "imo_number", "name", "ship_type", "has_scrubber", "position_count", "avg_speed", "first_seen", "last_seen",
    "unique_destinations", "latitude", "longitude", "sog", "cog", "navigational_status_code",
    "timestamp_collected", "destination",
]

# Messages as they are on the wire: every field as text, so that none can spoil the others.
_FIELDS = T.MapType(_TEXT, _TEXT)
MESSAGE = _struct(
    MessageType=_TEXT, MetaData=_FIELDS, Message=_struct(ShipStaticData=_FIELDS, PositionReport=_FIELDS),
    _corrupt_record=_TEXT,
)

# The 16 navigational status codes of the AIS standard.
NAV_STATUS_ROWS = [
    (0, "Underway using engine"),
    (1, "At anchor"),
    (2, "Not under command"),
    (3, "Restricted maneuverability"),
    (4, "Constrained by her draught"),
    (5, "Moored"),
    (6, "Aground"),
    (7, "Engaged in fishing"),
    (8, "Underway sailing"),
    (9, "Reserved for future amendment of navigational status for ships carrying DG, HS or IMO hazard or "
        "pollutant category C, HSC"),
    (10, "Reserved for future amendment of navigational status for ships carrying DG, HS, MP or IMO hazard or "
         "pollutant category A, WIG"),
    (11, "Power-driven vessel towing astern"),
    (12, "Power-driven vessel pushing ahead or towing alongside"),
    (13, "Reserved for future use"),
    (14, "AIS-SART Active, AIS-MOB, AIS-EPIRB"),
    (15, "Undefined"),
]
