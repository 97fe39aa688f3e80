"""Keyed state of the message streams.

Each processor sees the rows of one key of a micro-batch and that key's state;
nothing written by earlier batches is read again. The state itself can be read as a table.

Every call for state and every group of rows costs a round trip to Spark, however
few rows it is about. So a key is a bucket of vessels or ships, its rows are worked on as columns,
and a value of the state holds the rows of many.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidewake.operators.maintain import SHIP_FIRST, SHIP_LAST

# Python workers may not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

HOUR = 3_600_000_000  # microseconds
MINUTE = 60_000_000


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of queries that start from now on in RocksDB, as state by key and variable needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """The state of a stateful operator after its last batch: columns of the key and of the value, for one variable or an aggregate."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable:
        reader = reader.option("stateVarName", variable)
    state = reader.load(checkpoint)
    keys = [c for c in ("key", "user_map_key") if c in state.columns]
    value = "user_map_value" if "user_map_value" in state.columns else "value"
    return state.select(*[f"{c}.*" for c in keys], f"{value}.*")


def read_rows(spark: SparkSession, checkpoint: str, operator: int, variable: str) -> DataFrame:
    """The rows of a variable that holds an array by column (see ``columns_of``)."""
    state = read_state(spark, checkpoint, operator, variable)
    return state.select(F.inline(F.arrays_zip(*[f.name for f in state.schema if isinstance(f.dataType, T.ArrayType)])))


def plain(value, kind: T.DataType):
    """A value of a pandas row as state and results take it."""
    if value is None or value is pd.NaT or value != value:
        return None
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return int(value)
    return value.to_pydatetime() if isinstance(value, pd.Timestamp) else value


def micros(times: pd.Series) -> list[int | None]:
    return [None if x is pd.NaT else x.value // 1000 for x in times]


def in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a key by ``seq``."""
    parts = list(rows)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return batch if len(batch) == 1 else batch.sort_values("seq", kind="stable", ignore_index=True)


def columns_of(fields: list[T.StructField]) -> T.StructType:
    """Type of a state that holds many rows: an array by column."""
    return T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields])


def listed(rows: Iterable[tuple], width: int) -> tuple:
    """The rows as a value of such a type."""
    return tuple(map(list, zip(*rows))) or ([],) * width


def numbers(column: pd.Series) -> list[int | None]:
    """A column of whole numbers, also where missing ones have made pandas turn it into fractions."""
    return [None if x is None or x is pd.NA or x != x else int(x) for x in column.tolist()]


class Identities(StatefulProcessor):
    """By bucket of MMSIs: positions get the identity of the newest ship message of their MMSI before them.

    Keys below 0 stand for rows without an MMSI, which find nothing and leave nothing.
    """

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", columns_of([self.schema["mmsi"], self.schema["imo_number"]]))

    def named(self, batch: pd.DataFrame) -> pd.DataFrame:
        """The rows of a bucket, in order, with identities."""
        found = self.newest.get()
        newest, changed, identities = dict(zip(*found)) if found else {}, False, []
        for route, mmsi, imo in zip(batch["route"].tolist(), numbers(batch["mmsi"]), numbers(batch["imo_number"])):
            if route == "position":
                imo = newest.get(mmsi)
            elif route == "static" and imo and newest.get(mmsi) != imo:  # 0 is no identity
                newest[mmsi], changed = imo, True
            identities.append(imo)
        if changed:
            self.newest.update(listed(newest.items(), 2))
        batch["imo_number"] = pd.array(identities, dtype="Int64")
        return batch

    def handleInputRows(self, key, rows, timerValues):
        for batch in rows if key[0] < 0 else [self.named(in_order(rows))]:
            yield batch[self.schema.names]

    def close(self) -> None:
        pass


COUNTERS = ("collected", "filtered", "static_data", "position_data", "no_imo")
USED = ("static", "position", "no_imo", "unknown")


# Rows of counters in one value of the state.
PART = 4096


class Metrics(Identities):
    """By bucket of MMSIs: counters for each vessel and minute of arrival.

    The state is a row of parts with up to ``PART`` vessels and minutes each. A
    batch reads and adds to the last part alone, so a vessel and minute may be in several parts.
    """

    fields = [T.StructField(c, T.LongType()) for c in ("minute", "mmsi", *COUNTERS, "identified")]

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", T.StructType([T.StructField("part", T.LongType())]))
        self.minutes = handle.getMapState("minutes", T.StructType([T.StructField("part", T.LongType())]), columns_of(self.fields))

    def handleInputRows(self, key, rows, timerValues):
        batch = in_order(rows)
        batch = batch.assign(mmsi=key[0]) if key[0] < 0 else self.named(batch)
        last = self.last.get()
        part = last[0] if last else 0
        counted = {row[:2]: list(row[2:]) for row in zip(*self.minutes.getValue((part,)))} if last else {}
        for route, mmsi, at, imo in zip(batch["route"].tolist(), numbers(batch["mmsi"]), micros(batch["arrived"]), numbers(batch["imo_number"])):
            used, known = route in USED, imo is not None and imo > 0
            found = (used, route == "outside", route == "static", route == "position" and known, used and not known, used and known)
            sums = counted.setdefault((None if at is None else at // MINUTE, mmsi), [0] * len(found))
            for k, x in enumerate(found):
                sums[k] += x
        # What a later batch may add to comes last.
        ordered = [(*at, *counted[at]) for at in sorted(counted, key=lambda x: (x[0] is not None, x))]
        for k in range(0, len(ordered), PART):
            self.minutes.updateValue((part + k // PART,), listed(ordered[k:k + PART], len(self.fields)))
        part += (len(ordered) - 1) // PART
        if not last or part != last[0]:
            self.last.update((part,))
        yield pd.DataFrame({"key": [key[0]]})


class Ships(StatefulProcessor):
    """By bucket of IMO numbers: the ship master, and the destination of every position.

    A position takes the destination of the last message of its ship up to its own
    time, if that is younger than ``age`` hours. Ship messages are kept by the hour
    of their time, so positions ask for the hours before them however long the stream has run;
    ``keep`` hours after their arrival they may be forgotten (None: never).
    Keys below 0 stand for rows without identity.
    """

    def __init__(self, schema: T.StructType, age: int, keep: int | None):
        self.schema, self.age, self.keep = schema, age, keep
        self.master = [schema[c] for c in ("imo_number", *SHIP_FIRST, *SHIP_LAST, "seq")]
        self.said = [schema["imo_number"], schema["seq"], schema["destination"], T.StructField("at", T.LongType())]

    def init(self, handle) -> None:
        self.ships = handle.getValueState("ships", columns_of(self.master))
        kept = {"ttlDurationMs": self.keep * 3_600_000} if self.keep else {}
        self.hours = handle.getMapState("hours", T.StructType([T.StructField("hour", T.LongType())]), columns_of(self.said), **kept)

    def _remember(self, statics: pd.DataFrame) -> pd.DataFrame:
        """Update the master and the messages by hour; the new rows of the ships."""
        said: dict[int, list[tuple]] = {}
        for row in zip(*(self._plain(statics, c) for c in ("imo_number", "seq", "destination")), micros(statics["timestamp_ais"])):
            if row[-1] is not None:
                said.setdefault(row[-1] // HOUR, []).append(row)
        for hour, new in said.items():
            self.hours.updateValue((hour,), listed(dict.fromkeys([*self._said(hour), *new]), len(self.said)))
        found, changed = self.ships.get(), {}
        ships = {row[0]: row for row in zip(*found)} if found else {}
        for row in zip(*(self._plain(statics, f.name) for f in self.master)):
            old = ships.get(row[0], row)
            ships[row[0]] = changed[row[0]] = (*old[:1 + len(SHIP_FIRST)], *row[1 + len(SHIP_FIRST):])
        self.ships.update(listed(ships.values(), len(self.master)))
        named = pd.DataFrame(changed.values(), columns=[f.name for f in self.master], dtype=object)
        return named.assign(**{c: None for c in self.schema.names if c not in named.columns})[self.schema.names]

    def _plain(self, rows: pd.DataFrame, column: str) -> list:
        return [plain(x, self.schema[column].dataType) for x in rows[column].tolist()]

    def _said(self, hour: int) -> Iterable[tuple]:
        return zip(*(self.hours.getValue((hour,)) or ()))

    def _destinations(self, positions: pd.DataFrame) -> list[str | None]:
        times, span = micros(positions["timestamp_ais"]), self.age * HOUR
        wanted = {h for t in {t // HOUR for t in times if t is not None} for h in range(t - self.age, t + 1)}
        said: dict[int, list[tuple]] = {}
        for imo, seq, destination, at in (x for h in wanted for x in self._said(h)):
            said.setdefault(imo, []).append((at, seq, destination))
        for each in said.values():
            each.sort(key=lambda x: x[:2])
        out = []
        for imo, t in zip(numbers(positions["imo_number"]), times):
            each = said.get(imo, ())
            k = bisect_right(each, t, key=lambda x: x[0]) if t is not None else 0
            out.append(each[k - 1][2] if k and t - each[k - 1][0] < span else None)
        return out

    def handleInputRows(self, key, rows, timerValues):
        if key[0] < 0:
            for batch in rows:
                batch["table"] = "unknown_ships"
                batch["imo_number"] = batch["imo_number"].where(batch["route"] == "unknown", -1)
                yield batch[[*self.schema.names, "table"]]
            return
        batch = in_order(rows)
        static = batch["route"] == "static"
        if static.any():
            ships = self._remember(batch[static])
            ships["table"] = "ships"
            yield ships
        position = ~static
        if position.any():
            batch.loc[position, "destination"] = self._destinations(batch[position])
        batch["table"] = ["static_log" if x else "positions" for x in static]
        yield batch[[*self.schema.names, "table"]]

    def close(self) -> None:
        pass
