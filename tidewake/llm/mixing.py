"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix ``target / source size``
times. The documents of a source are laid out in a fixed order, their expected
copies are added up, and a document is emitted once for each integer boundary
that its part of the sum, moved by one random offset per source, crosses.

The order is by size class, then by a salt, then by size and id. Neighbours are
of about the same size, so the words taken stay within about one document of the
target, and reruns agree. The running sum is distributed: counts per (source,
size class, salt) are added up first, and only rows of one such cell, a small
part of even the largest source, meet in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.llm.common import fresh, text_of, text_tag, word_array
from tidewake.session import materialize

WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``target`` words for each row of ``sizes`` (source, source_size).

    Sources in code point order (null last) weigh ``weights``, repeating. They
    share ``share`` times all words; a target stops at ``cap`` times its
    source's size and the excess is shared again by weight. That fixed point is
    a common level per weight: sources are capped in the order of size per
    weight until the level reached is below the next cap.

    One row per source: the windows over all of them run in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sizes.select("*", weight.alias("weight")).withColumn("most", F.lit(cap) * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    later = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(everything) - earlier) / later
    levels = ranked.withColumn("own_level", level)
    open_level = F.min(F.when(F.col("most") / F.col("weight") > F.col("own_level"), F.struct(F.col("most") / F.col("weight"), "own_level")))
    final = levels.withColumn("level", open_level.over(everything)["own_level"])
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return final.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: str = "mix-1",
) -> DataFrame:
    """One row per document: id, ``size`` (words), ``source_size``, ``target``, ``copies``, ``taken``, ``tag``.

    Null texts have size 0, null sources are a source of their own. A source
    without words has target 0 and none of its documents is taken. Rows with
    equal id and text may get different numbers of copies. Other columns of
    ``docs`` are ignored. An empty table gives no rows.
    """
    size = F.size(word_array(text_of(text_col))).cast("bigint")
    light = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), text_tag(text_col).alias("tag")
    )
    # Stored: the texts are read once, the counts and the rows agree.
    light = materialize(light, "mix-sizes")
    octave = F.length(F.bin("size")) - 1
    in_octave = F.expr("shiftright(shiftleft(size, 4), length(bin(size)) - 1)")
    light = light.select(
        "*",
        F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("key"),
        F.when(F.col("size") == 0, F.lit(0)).otherwise(octave * 16 + in_octave).cast("bigint").alias("class"),
        F.coalesce(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 2), F.lit("00")).alias("salt"),
    )
    cells = light.groupBy("key", "class", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.first("source").alias("source"))
    sizes = cells.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap).withColumns({
        "t_key": F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")),
        "rate": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)),
        "offset": F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0,
    }).drop("source")
    before = Window.partitionBy("key").orderBy("class", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        F.col("key").alias("c_key"), F.col("class").alias("c_class"), F.col("salt").alias("c_salt"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    ).join(targets, F.col("c_key") == F.col("t_key"))
    cell = Window.partitionBy("key", "class", "salt").orderBy("size", F.col("id").asc_nulls_first(), "tag")
    ranked = light.withColumn("place", F.row_number().over(cell)).join(
        starts, (F.col("key") == F.col("c_key")) & (F.col("class") == F.col("c_class")) & (F.col("salt") == F.col("c_salt"))
    )
    place = F.col("start") + F.col("place")
    crossed = F.floor(place * F.col("rate") + F.col("offset")) - F.floor((place - 1) * F.col("rate") + F.col("offset"))
    return ranked.withColumn("copies", crossed.cast("bigint")).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tag"
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Documents without words belong to no share and are left out.
    """
    taken = mix_sources(docs, id_col, text_col, source_col, **options).where("taken > 0")
    tag, row, copy, own_id, own_tag, copies, rows = fresh(docs, "tag", "row", "copy", "own_id", "own_tag", "copies", "rows")
    totals = taken.groupBy(F.col(id_col).alias(own_id), F.col("tag").alias(own_tag)).agg(
        F.sum("copies").alias(copies), F.count(F.lit(1)).alias(rows)
    )
    tagged = docs.withColumn(tag, text_tag(text_col))
    joined = tagged.join(totals, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(tag) == F.col(own_tag)))
    # Rows alike in id and text share their copies: the first takes what is left over.
    alike = Window.partitionBy(id_col, tag).orderBy(F.lit(0))
    numbered = joined.withColumn(row, F.row_number().over(alike))
    rest = F.col(copies) % F.col(rows)
    own = (F.col(copies) - rest) / F.col(rows) + F.when(F.col(row) <= rest, 1).otherwise(0)
    repeated = numbered.withColumn(copy, F.explode(F.array_repeat(F.lit(1), own.cast("int"))))
    return repeated.select(*docs.columns)


QUERY_SQL = r"""
WITH d AS (
  SELECT doc_id AS id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), k AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE (length(bin(size)) - 1) * 16 + ((size << 4) >> (length(bin(size)) - 1)) END AS class,
    coalesce(substr(md5(CAST(id AS VARCHAR)), 1, 2), '00') AS salt FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source
), w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS weight, 2.0::DOUBLE * source_size AS most FROM s
), v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level FROM w
), t AS (
  SELECT source, source_size, least(most, coalesce(weight * (SELECT arg_min(own_level, most / weight) FROM v WHERE most / weight > own_level), most)) AS target,
    CAST(('0x' || substr(md5('mix-1' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS offset_ FROM v
), p AS (
  SELECT k.id, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate, t.offset_,
    row_number() OVER (PARTITION BY k.source ORDER BY class, salt, size, id) AS place
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT id AS doc_id, size, source_size, target,
  CAST(floor(place * rate + offset_) - floor((place - 1) * rate + offset_) AS BIGINT) * size AS taken FROM p
"""
