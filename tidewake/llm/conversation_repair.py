"""Repair of conversation structure by generalised LR parsing (see ``role_grammar``).

1. Rows are put in order by range partitions over (conversation, turn), without their
   texts. Faults come from the rows themselves and from the first place of equal ones.
2. A conversation is cut into runs of at most ``RUN`` rows. One that is a single run, as
   almost all are, is parsed at once. Of a longer one every run is parsed from each stack
   it may start with; these summaries are chained ``FAN`` at a time, as often as it takes,
   and the way chosen at the top is handed down again. So no task holds a whole long
   conversation.
3. The edits meet their texts by a key of the row, whose hash spreads any conversation.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm import role_grammar as grammar
from tidewake.llm.common import SPACES, fresh, replaced
from tidewake.llm.merkle import field
from tidewake.session import materialize

# Rows of a run (a power of two), and runs or groups of runs that are chained at a time.
RUN = 4096
FAN = 1024

END = ".!?"


def _md5(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def _keyed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with ``conv`` (a text that names null apart), ``turn``, ``role``, ``text``, ``said`` and ``key``.

    ``said`` is equal where conversation, role and text are, ``key`` where the turn is too.
    """
    plain = rows.select(
        field(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    said = plain.withColumn("said", _md5(field("conv"), field("role"), field("text")))
    return said.withColumn("key", _md5(F.hex("said"), field("turn")))


def _ordered(keyed: DataFrame) -> DataFrame:
    """Rows without texts: ``conv``, ``at`` (ascending in a conversation), ``turn``, ``key``, ``initial`` and ``status``.

    Rows of one turn are ordered by role and by the digest of their text; equal rows follow each other.
    """
    end = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    facts = keyed.select(
        "conv", "turn", "role", "said", "key", F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"),
        F.when(end == "", grammar.BLANK).when(F.right(end, F.lit(1)).isin(*END), grammar.FINE).otherwise(grammar.TRUNCATED).alias("own"),
    )
    order = ["conv", "turn", "role", "said"]
    placed = facts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed.drop("role"), "chat-rows")
    again = placed.groupBy("said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that the join can be split where one text is repeated very often.
    again = materialize(again.select(F.col("said").alias("a_said"), "first"), "chat-repeated")
    known = placed.join(again, F.col("said") == F.col("a_said"), "left")
    status = F.when((F.col("own") != grammar.BLANK) & (F.col("at") > F.col("first")), grammar.DUPLICATE).otherwise(F.col("own"))
    return known.select("conv", "at", "turn", "key", "initial", status.alias("status"))


def _runs(ordered: DataFrame) -> DataFrame:
    """``conv``, ``run`` (ascending) and ``items``, at most ``RUN`` neighbouring rows in order."""
    item = F.struct("at", "turn", "initial", "status", "key")
    runs = ordered.groupBy("conv", F.shiftright("at", RUN.bit_length() - 1).alias("run")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return materialize(runs, "chat-runs")


_WAYS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("cost", T.LongType())]))


def _flat(ways: grammar.Ways) -> list[dict]:
    return [{"start": s, "end": e, "cost": c} for s, found in ways.items() for e, c in found]


def _ways(flat: list[dict]) -> grammar.Ways:
    out: grammar.Ways = {}
    for x in flat:
        out.setdefault(x["start"], []).append((x["end"], x["cost"]))
    return out


def _rows_of(items) -> list[tuple[str, int]]:
    return list(zip(items.field("initial").to_pylist(), items.field("status").to_pylist()))


def _by_row(body, schema: T.StructType):
    """Rows of a frame to the tuples that ``body`` makes of each."""
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema.fields])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(body(batch.slice(i, 1)))
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    plain = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.BinaryType: pa.binary()}
    return plain[type(kind)]


_PARTS = T.StructType([T.StructField("conv", T.StringType()), T.StructField("part", T.LongType()), T.StructField("ways", _WAYS)])
_BORDERS = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("part", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
])


def _gathered(parts: DataFrame) -> DataFrame:
    """Groups of ``FAN`` neighbours: ``conv``, ``group`` and ``parts`` in order."""
    group = F.floor(F.col("part") / F.lit(FAN)).cast("bigint").alias("group")
    return parts.groupBy("conv", group).agg(F.array_sort(F.collect_list(F.struct("part", "ways"))).alias("parts"))


def _long_borders(runs: DataFrame) -> DataFrame:
    """Stacks at the borders of all runs of conversations with several: ``conv``, ``run``, ``start`` and ``end``."""
    several = runs.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    long = runs.join(several.select("conv"), "conv", "left_semi")
    number = F.row_number().over(Window.partitionBy("conv").orderBy("run")) - 1
    numbers = materialize(long.select("conv", "run").withColumn("part", number.cast("bigint")), "chat-numbers")
    most = (numbers.agg(F.max("part")).first()[0] or 0) + 1

    def one(row):
        yield row.column("conv")[0].as_py(), row.column("part")[0].as_py(), _flat(grammar.ways(_rows_of(row.column("items")[0].values)))

    def joined(row):
        parts = [_ways(p["ways"]) for p in row.column("parts")[0].as_py()]
        yield row.column("conv")[0].as_py(), row.column("group")[0].as_py(), _flat(grammar.joined(parts))

    def shared(row):
        parts, start, end = (row.column(c)[0].as_py() for c in ("parts", "start", "end"))
        for part, (a, b) in zip(parts, grammar.borders(start, end, [_ways(p["ways"]) for p in parts])):
            yield row.column("conv")[0].as_py(), part["part"], a, b

    parts = [materialize(long.join(numbers, ["conv", "run"]).select("conv", "part", "items").mapInArrow(_by_row(one, _PARTS), _PARTS), "chat-ways")]
    while most > FAN:
        parts.append(materialize(_gathered(parts[-1]).mapInArrow(_by_row(joined, _PARTS), _PARTS), "chat-ways"))
        most = -(-most // FAN)
    above = numbers.select("conv").distinct().select(
        "conv", F.lit(0).cast("bigint").alias("part"), F.lit(grammar.START).alias("start"), F.lit(None).cast("int").alias("end"))
    for level in reversed(parts):
        groups = _gathered(level).join(above.withColumnRenamed("part", "group"), ["conv", "group"])
        above = materialize(groups.mapInArrow(_by_row(shared, _BORDERS), _BORDERS), "chat-borders")
    return above.join(numbers, ["conv", "part"]).select("conv", "run", "start", "end")


_EDIT = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("at", T.LongType()), T.StructField("sub", T.IntegerType()), T.StructField("edit", T.StringType()),
    T.StructField("new_role", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("key", T.BinaryType()),
])


def _edits(runs: DataFrame) -> DataFrame:
    """All edits in order of (``at``, ``sub``), with ``new_role`` for reroled and inserted rows and the ``key`` of the row, null for inserts."""
    bordered = runs.join(_long_borders(runs), ["conv", "run"], "left").select("conv", "items", "start", "end")

    def solved(row):
        conv, start, end = (row.column(c)[0].as_py() for c in ("conv", "start", "end"))
        items = row.column("items")[0].values
        rows, places, keys = _rows_of(items), items.field("at").to_pylist(), items.field("key").to_pylist()
        edits, tail = grammar.edits(grammar.START if start is None else start, end, rows)
        for (_, status), at, key, own in zip(rows, places, keys, edits):
            for sub, (edit, symbol) in enumerate(own):
                last = sub == len(own) - 1
                cost = grammar.cost(own, status) - grammar.cost(own[:-1], grammar.FINE) if last else grammar.COSTS[edit]
                yield conv, at, sub, edit, None if edit in (grammar.KEEP, grammar.DELETE) else grammar.ROLES[symbol], cost, key if last else None
        for sub, (edit, symbol) in enumerate(tail):
            yield conv, places[-1], len(edits[-1]) + sub, edit, grammar.ROLES[symbol], grammar.COSTS[edit], None

    return bordered.mapInArrow(_by_row(solved, _EDIT), _EDIT)


def _report(runs: DataFrame) -> DataFrame:
    """Faults of each conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal``."""
    def legal(a: Column, b: Column) -> Column:
        return F.concat(a, b).isin("su", "ua", "au")

    def wrong(x: Column, i: Column) -> Column:
        return (i > 0) & ~legal(F.get(F.col("items"), i - 1)["initial"], x["initial"])

    def many(status: int) -> Column:
        return F.size(F.filter("items", lambda x: x["status"] == status)).cast("bigint")

    turns = F.filter(F.transform("items", lambda x: x["turn"]), lambda x: x.isNotNull())
    new = F.size(F.array_distinct(turns)).cast("bigint")
    figures = runs.select(
        "conv", "run", F.size(F.filter("items", wrong)).cast("bigint").alias("inner"), new.alias("turns"), F.array_min(turns).alias("low"),
        F.array_max(turns).alias("high"), F.get("items", F.lit(0))["initial"].alias("first"), F.element_at("items", -1)["initial"].alias("last"),
        many(grammar.BLANK).alias("blank"), many(grammar.DUPLICATE).alias("duplicate"), many(grammar.TRUNCATED).alias("truncated"),
    )
    # One row a run: a turn or a pair of roles may lie across a border.
    before = Window.partitionBy("conv").orderBy("run")
    bordered = figures.withColumns({
        "across": (~legal(F.lag("last").over(before), F.col("first"))).cast("bigint"),
        "shared": (F.max("high").over(before.rowsBetween(Window.unboundedPreceding, -1)) == F.col("low")).cast("bigint"),
    })
    gaps = F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.coalesce(F.sum("shared"), F.lit(0)))
    return bordered.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("inner") + F.coalesce(F.sum("across"), F.lit(0))).alias("illegal"),
    )


def _repaired(keyed: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits with the role and text they leave: both null for deleted rows."""
    # Equal rows have one text; rows of one conversation lie wherever their keys do.
    texts = keyed.select("key", F.struct("role", "text").alias("own")).groupBy("key").agg(F.first("own").alias("own"))
    # Inserts have no text; a key of their own spreads them.
    spread = edits.withColumn("key", F.coalesce("key", F.encode(F.concat_ws(":", "conv", "at", "sub"), "utf-8")))
    met = spread.join(texts.withColumnRenamed("key", "t_key"), F.col("key") == F.col("t_key"), "left")
    gone = F.col("edit") == grammar.DELETE
    return met.select(
        "conv", "at", "sub", "edit", "cost", F.when(~gone, F.coalesce("new_role", "own.role")).alias("role"),
        F.when(~gone, F.when(F.col("edit") == grammar.INSERT, "").otherwise(F.col("own.text"))).alias("text"),
    )


_DIGEST = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
])


def _digests(batches):
    """Digest, audit and cost of conversations whose edits come in order. Texts are passed through and not kept."""
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in _DIGEST.fields])
    conv, cost, audit, digest, lines = None, 0, [], None, 0

    def row():
        return conv, cost, "".join(audit), digest.hexdigest()

    for batch in batches:
        out = []
        for name, edit, more, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "cost", "role", "text"))):
            if name != conv:
                if conv is not None:
                    out.append(row())
                conv, cost, audit, digest, lines = name, 0, [], hashlib.sha256(), 0
            cost += more
            audit.append(edit)
            if edit != grammar.DELETE:
                digest.update((b"\n" if lines else b"") + f"{role}:{text}".encode())
                lines += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
    if conv is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(row()), arrow)], schema=arrow)


def repaired_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The cheapest repair, one row per edit: ``conv``, ``at`` and ``sub`` (the order), ``edit``, ``cost``, ``role`` and ``text``.

    ``conv`` is ``-`` for null, else the length of the id, a colon and the id. Rows
    with edit ``D`` are gone and have no role or text; the others are the repaired conversation.
    The cases are those of ``repair_conversations``.
    """
    keyed = _keyed(rows, conv_col, turn_col, role_col, text_col)
    return _repaired(keyed, _edits(_runs(_ordered(keyed))))


def repair_conversations(
    rows: DataFrame, named: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, its faults, ``cost``, ``audit`` and ``repaired_sha256`` of the cheapest repair.

    Rows are taken by turn, nulls first; within a turn by role and the digest of
    their text. ``gaps`` are turns missing between the first and the last, ``illegal``
    neighbouring roles other than system-user, user-assistant and assistant-user.
    A row is ``blank``, else a ``duplicate`` of an earlier role and text, else ``truncated``, if
    its text does not end in a full stop, exclamation or question mark. Of equally cheap repairs the one with the least ``audit`` counts.

    A null role or text is one space, a null id is a conversation of its own;
    repeated rows are duplicates, and texts of any length are read whole. ``named`` may
    name more conversations: those without rows get zeros, an empty audit and the
    digest of nothing. Other columns are ignored; an empty table gives no rows.

    The digest of a conversation runs over all its rows in order, so one task streams them; nothing of them is held.
    """
    keyed = _keyed(rows, conv_col, turn_col, role_col, text_col)
    runs = _runs(_ordered(keyed))
    edits = _repaired(keyed, _edits(runs))
    digests = edits.repartition("conv").sortWithinPartitions("conv", "at", "sub").mapInArrow(_digests, _DIGEST)
    found = _report(runs).join(digests, "conv")
    ids = (rows if named is None else named).select(F.col(conv_col).alias(conv_col)).distinct()
    (key,) = fresh(ids, "conv_key")
    joined = ids.withColumn(key, field(conv_col)).join(found, F.col(key) == F.col("conv"), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        conv_col, *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by the checksum of conversation and turn, as a test of the repair.

    Of twenty values, 0 drops the row, 1 empties its text, 2 takes out the marks that end sentences, 3
    repeats it and 4 gives it to the user. Nulls are one space in the checksum, in roles and in texts.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    changed = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), draw.alias("draw")).where("draw != 0")
    return changed.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, replaced(F.col("text"), END, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


QUERY_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS draw FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE draw <> 0
), ids AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id NULLS FIRST) AS cid FROM (SELECT DISTINCT conv_id FROM conversations)
), named AS (
  SELECT cid, d.*, CASE WHEN d.conv_id IS NULL THEN '-' ELSE strlen(CAST(d.conv_id AS VARCHAR)) || ':' || CAST(d.conv_id AS VARCHAR) END AS c
  FROM damaged d JOIN ids i ON d.conv_id IS NOT DISTINCT FROM i.conv_id
), said AS (
  SELECT *, md5(strlen(c) || ':' || c || strlen(role) || ':' || role || strlen(text) || ':' || text) AS digest FROM named
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, digest) AS pos, substr(role, 1, 1) AS ini,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM said
), faults AS (
  SELECT *, CASE WHEN body = '' THEN 2 WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 THEN 3
      WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS status, lag(ini) OVER (PARTITION BY cid ORDER BY pos) AS before FROM placed
), report AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (status = 2) AS blank,
    count(*) FILTER (status = 3) AS duplicate, count(*) FILTER (status = 1) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM faults GROUP BY cid
), shifts AS (
  SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) x(st, sym, nst)
), inserts AS (
  SELECT * FROM (VALUES (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (0, 1, 2), (1, 1, 2), (2, 1, 3), (3, 1, 2), (0, 2, 3), (1, 2, 3)) x(st, m, nst)
), lines AS (
  SELECT st, m, nst, CASE WHEN st = 2 AND m = 1 THEN chr(10) || 'assistant:' WHEN m = 1 THEN chr(10) || 'user:'
    WHEN m = 2 THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS put FROM inserts
), ops AS (
  SELECT * FROM (VALUES ('D', NULL, 3), ('K', NULL, 0), ('R', 'u', 2), ('R', 'a', 2)) x(op, sym, price)
), dp AS (
  SELECT cid, CAST(0 AS BIGINT) AS pos, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS made FROM report
  UNION ALL
  SELECT cid, pos, st, cost, audit, made FROM (
    SELECT *, row_number() OVER (PARTITION BY cid, st ORDER BY cost, audit) AS best FROM (
      SELECT dp.cid, f.pos, CASE WHEN o.op = 'D' THEN l.nst ELSE s.nst END AS st,
        CAST(dp.cost + 2 * l.m + o.price + CASE WHEN o.op <> 'D' AND f.status = 1 THEN 1 ELSE 0 END AS BIGINT) AS cost,
        dp.audit || repeat('I', l.m) || o.op AS audit,
        dp.made || l.put || CASE o.op WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
          ELSE chr(10) || CASE o.sym WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text END AS made
      FROM dp JOIN faults f ON f.cid = dp.cid AND f.pos = dp.pos + 1 JOIN lines l ON l.st = dp.st CROSS JOIN ops o
        LEFT JOIN shifts s ON s.st = l.nst AND s.sym = coalesce(o.sym, f.ini)
      WHERE o.op = 'D' OR (f.status < 2 AND s.nst IS NOT NULL)
    )
  ) WHERE best = 1
), ended AS (
  SELECT dp.cid, dp.cost + 2 * l.m AS cost, dp.audit || repeat('I', l.m) AS audit, dp.made || l.put AS made
  FROM dp JOIN report r ON r.cid = dp.cid AND r.n = dp.pos JOIN lines l ON l.st = dp.st AND l.nst IN (0, 3)
), chosen AS (
  SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY cid ORDER BY cost, audit) = 1
)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(substr(made, 2), '')) AS repaired_sha256
FROM ids i LEFT JOIN report r ON i.cid = r.cid LEFT JOIN chosen c ON i.cid = c.cid
"""
