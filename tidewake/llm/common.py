"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# White space of the word rule: space and U+0009 to U+000D. bytes.split() cuts at exactly these.
SPACES = " \t\n\x0b\x0c\r"

# Python workers take an Arrow batch apart into slices of about this many bytes of text.
SLICE_BYTES = 2 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` doesn't use yet."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def replaced(text: Column, characters: str, by: str) -> Column:
    """Each of some characters replaced; a search per character is far cheaper than ``translate``."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array."""
    return F.array_remove(F.split(replaced(text, SPACES[1:], " "), " ", -1), "")


def text_tag(column: str) -> Column:
    """Tells rows that share an identifier apart when decisions are joined back; never used for equality of texts."""
    return F.xxhash64(F.col(column).isNull(), text_of(column))


def keep_rows(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, repeated: bool = False) -> DataFrame:
    """Rows of ``docs`` named in ``chosen`` (id column and ``tag``).

    Rows alike in id and text all come with ``repeated``, else one of them does.
    """
    tag, own_id, own_tag = fresh(docs, "tag", "own_id", "own_tag")
    named = chosen.select(F.col(id_col).alias(own_id), F.col("tag").alias(own_tag))
    tagged = docs.withColumn(tag, text_tag(text_col))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(tag) == F.col(own_tag))
    found = tagged.join(named, same, "left_semi")
    if repeated:
        return found.select(*docs.columns)
    one = Window.partitionBy(id_col, tag).orderBy(F.lit(0))
    (rank,) = fresh(found, "rank")
    return found.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*docs.columns)


def slices(batch: pa.RecordBatch, text_col: str, most: int = SLICE_BYTES):
    """Slices of a batch that hold about ``most`` bytes of text each (more only where one row does)."""
    start, held = 0, 0
    lengths = [0 if n is None else n for n in pc.binary_length(batch.column(text_col)).to_pylist()]
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, empty where null."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
