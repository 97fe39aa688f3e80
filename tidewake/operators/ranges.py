"""Time-ordered windows over keys of any size, with one exchange of the rows.

A window ordered by time needs the rows of a key together, and a hash exchange by
key does that. A ship (or a place holder identity) may hold a large share of the
table, though, at one single time even. Such a key is cut into pieces that
follow each other in time, at borders taken from a sample of its rows, and the exchange is
by (key, piece). What must cross a border is carried over from a
summary with one row per piece of a cut key.

The number of pieces is bounded whatever the size of the table, since a piece grows
with it; so borders and summaries are small enough to broadcast. Where the caller names
a size of pieces that makes more of them, borders and summaries are joined through exchanges. Any borders
give the same result, they only decide how even the pieces are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewake.session import materialize

PIECE = "_piece"

# A key is cut if it has more rows than this and more than a MOST_PIECES-th of the table.
LEAST_ROWS = 1_000_000
MOST_PIECES = 50_000

# Rows sampled for a piece's borders.
SAMPLES = 32


@dataclass(frozen=True)
class Ranges:
    """Rows ready for time-ordered windows: large keys are cut into pieces 0, 1, ... that follow each other, others are piece -1."""

    df: DataFrame
    keys: list[str]
    cut: bool = True
    few: bool = True  # few enough pieces to broadcast what is known of them

    @property
    def by(self) -> list[str]:
        return [*self.keys, PIECE]

    def window(self, *order: Column | str) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*order)

    def carry(self, summary: Column, fold) -> "Ranges":
        """Add ``_carry``: what the earlier pieces of the row's key amount to, NULL in first pieces.

        ``summary`` aggregates one piece and ``fold`` (such as ``F.sum``) merges
        the summaries of all earlier pieces.
        """
        earlier = Window.partitionBy(*self.keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            self.df.where(F.col(PIECE) >= 0).groupBy(*self.by)
            .agg(summary.alias("_summary"))
            .select(*[F.col(c).alias(f"_k_{c}") for c in self.by], fold("_summary").over(earlier).alias("_carry"))
            .where(F.col("_carry").isNotNull())
        )
        if not self.cut:
            return Ranges(self.df.withColumn("_carry", F.lit(None).cast(carried.schema["_carry"].dataType)), self.keys, False)
        same_piece = [self.df[c].eqNullSafe(carried[f"_k_{c}"]) for c in self.by]
        return Ranges(self.df.join(_small(carried, self.few), same_piece, "left").select(*self.df.columns, "_carry"), self.keys, True, self.few)


def _small(df: DataFrame, few: bool) -> DataFrame:
    """With few pieces a broadcast, else whatever join fits."""
    return F.broadcast(df) if few else df.hint("merge")


def _place(cuts: Column, at: Column, most: int) -> Column:
    """Number of ascending ``cuts`` that are not above ``at``, by bisection; ``most`` is the largest number of cuts."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(cuts, low + step - 1) <= at, low + step).otherwise(low))


def split_large_keys(df: DataFrame, keys: list[str], *order: str, piece_rows: int | None = None) -> Ranges:
    """Cut keys with more than ``piece_rows`` rows into pieces by the ``order`` columns, ascending with nulls first.

    ``order`` should end in a column that tells rows of one time apart. One
    aggregate over the key columns finds out whether there is anything to cut.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = piece_rows or max(LEAST_ROWS, (total or 0) // MOST_PIECES)
    if not total or largest <= limit:
        return Ranges(df.withColumn(PIECE, F.lit(-1)), keys, False)
    few = total // limit <= 2 * MOST_PIECES
    every = max(1, limit // SAMPLES)
    at = F.struct(*order)
    names = [f"_c_{c}" for c in keys]
    large = counts.where(F.col("_n") > limit).select(*[F.col(c).alias(n) for c, n in zip(keys, names)])
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names)]
    drawn = df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0).join(_small(large, few), same)
    # Where all rows are drawn, pieces are as large as they may be.
    each = limit if every == 1 else limit // (2 * every)
    borders = F.filter(F.sort_array(F.collect_list(at)), lambda _, i: (i + 1) % each == 0)
    cuts = materialize(drawn.groupBy(*names).agg(borders.alias("_cuts")), "cuts")
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    if not most:
        return Ranges(df.withColumn(PIECE, F.lit(-1)), keys, False)
    met = df.join(_small(cuts, few), same, "left")
    piece = F.when(F.col("_cuts").isNull(), -1).otherwise(_place(F.col("_cuts"), at, most))
    return Ranges(met.select(*df.columns, piece.alias(PIECE)), keys, True, few)
