"""Exact duplicates by distributed MSD radix partitioning.

Texts count as equal when they are identical after deleting white space. Each
round takes the next digit (a run of bytes) of every document still in doubt and
splits its group by it. A group of one document is settled, and so is a group
whose texts have ended; the others go on with the rest of their bytes. Digits
are compared as they are, no digest decides about equality.

The first digits are short and later ones longer (64, 512, 4096, ... bytes), so
nearly all documents leave in the first rounds, and the number of rounds grows
with the logarithm of the longest repeated text up to ``widest`` bytes a digit.

A round counts its groups with map-side combining and joins the counts back; a
group that holds a large share of the rows is split by adaptive execution, as
the other side of the join has one row per group. What is left after a round is
stored in the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.llm.common import SPACES, keep_rows, replaced, text_of, text_tag
from tidewake.session import materialize


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    first: int = 64, growth: int = 8, widest: int = 1 << 20,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``tag``.

    Of equal texts the one with the most code points stays, then the one with
    the smallest id (null ids last). A null text counts as empty. Exactly one
    row of a group is kept: rows that agree in id and text are one and the same
    choice, of which any one is marked. Other columns of ``docs`` are ignored.
    An empty table gives no rows.
    """
    text = text_of(text_col)
    rest = replaced(text, SPACES, "").cast("binary")
    state = docs.select(
        F.col(id_col).alias("id"), F.length(text).alias("len"), text_tag(text_col).alias("tag"),
        F.sha2(rest, 256).alias("sha"), F.lit(0).cast("bigint").alias("grp"), rest.alias("rest"),
    )
    settled, width = [], first
    while True:
        stored = _split(state, width)
        settled.append(stored.where("next IS NULL").drop("next", "rest"))
        left = stored.where("next IS NOT NULL")
        if left.isEmpty():
            break
        state = left.select("id", "len", "tag", "sha", F.col("next").alias("grp"), "rest")
        width = min(width * growth, widest)
    rows = reduce(DataFrame.unionByName, settled)
    # Rows of one id and text are alike up to here: mark one of them.
    again = Window.partitionBy("id", "tag", "sha").orderBy(F.lit(0))
    chosen = F.col("n").isNull() | (
        F.col("id").eqNullSafe(F.col("best.id")) & (F.col("len") == F.col("best.len")) & (F.col("tag") == F.col("best.tag"))
    )
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (chosen & (F.row_number().over(again) == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "tag",
    )


def _split(state: DataFrame, width: int) -> DataFrame:
    """Split every group by its next ``width`` bytes; stored rows have ``next`` (their new group) while in doubt."""
    keyed = state.withColumns({"digit": F.substring("rest", 1, width), "ended": F.length("rest") <= width})
    order = F.struct(-F.col("len"), F.col("id").isNull(), F.col("id"), F.col("tag"))
    groups = (
        keyed.groupBy("grp", "digit", "ended")
        .agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("id", "len", "tag"), order).alias("best"))
        .where("n > 1")
        .withColumn("next", F.when(~F.col("ended"), F.monotonically_increasing_id()))
    )
    # Stored before it is joined: the numbers of the new groups must not change when a task is repeated.
    groups = materialize(groups, "radix-groups")
    doubtful = F.col("next").isNotNull()
    # Always a shuffle join: the groups grow with the documents, and so the work is alike at every size.
    split = keyed.join(groups.hint("merge"), ["grp", "digit", "ended"], "left").select(
        "id", "len", "tag", "sha", "n", "best", "next",
        F.when(doubtful, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    )
    return materialize(split, "radix-rows")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns."""
    decided = exact_dedup(docs, id_col, text_col)
    return keep_rows(docs, decided.where("kept"), id_col, text_col)


QUERY_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
), g AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY len DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size, sha256(t) AS text_sha256 FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
