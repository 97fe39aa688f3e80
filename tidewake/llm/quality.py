"""Quality rules: figures per text, and the frequency of lines across the documents of a host.

Lines are normalised (white space, letter case, digits) and hashed. A line that
more than ``max_documents`` distinct documents of a host carry is boilerplate of
that host and is removed; a document of which too little is left is rejected.

Documents with equal normalised lines count once. Near copies count each: a page
of boilerplate with one line of its own and a copy with one line edited look
alike.

Everything is DataFrame expressions. Line rows carry hashes rather than texts,
and all counts combine on the map side, so a line that a third of all documents
share is one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import SPACES, fresh, keep_rows, replaced, text_of, text_tag, word_array
from tidewake.session import materialize

SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(SPACES)) != ""


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), _has_word)


def _covered(starts: Column, width: int) -> Column:
    """Words covered by windows of ``width`` words at the given ascending starts."""
    steps = F.transform(starts, lambda p, k: F.coalesce(F.least(F.lit(width), p - F.get(starts, k - 1)), F.lit(width)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _repeated(windows: Column) -> Column:
    """Places of the values that occur twice or more, ascending."""
    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"]) | F.get(s, i + 1)["h"].eqNullSafe(x["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _let(F.array_sort(placed), places)


def repeated_words(words: Column, width: int = 5) -> Column:
    """Number of words in ``width``-word windows that the text has twice or more, the first included."""
    def count(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return F.when(F.size(w) < width + 1, F.lit(0).cast("bigint")).otherwise(
            _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
                _let(_repeated(h), lambda p: _covered(p, width)))))

    return _let(words, count)


def text_figures(text: Column) -> dict[str, Column]:
    """Words, code points in words, symbols, repeated lines and words in repeated windows."""
    words = word_array(text)
    dense = replaced(text, SPACES, "")
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(dense).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(replaced(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": _let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }


def _normal(words: Column) -> Column:
    """A line with single spaces, in lower case and with all digits alike."""
    return F.regexp_replace(F.lower(F.array_join(words, " ")), "[1-9]", "0")


def removed_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_documents: int) -> DataFrame:
    """Removed lines for each (id, tag) that has any: ``id``, ``tag``, words ``removed`` and ascending places ``removed_at``."""
    def line(x: Column, at: Column) -> Column:
        return _let(word_array(x), lambda ws: F.struct(
            F.unhex(F.substring(F.md5(_normal(ws).cast("binary")), 1, 16)).alias("h"), F.size(ws).alias("w"), at.alias("at"),
        ))

    per_document = docs.select(
        F.col(id_col).alias("id"), text_tag(text_col).alias("tag"), F.col(host_col).cast("string").alias("host"),
        F.filter(F.transform(F.split(text_of(text_col), "\n", -1), line), lambda x: x["w"] > 0).alias("lines"),
    )
    document = F.xxhash64(F.transform("lines", lambda x: x["h"]))
    rows = per_document.select("id", "tag", "host", document.alias("document"), F.explode("lines").alias("line")).select(
        "id", "tag", "host", "document", F.col("line.at").alias("at"), F.col("line.h").alias("h"), F.col("line.w").alias("w")
    )
    # Hashes of all lines, without their texts: counted and looked up.
    rows = materialize(rows, "lines")
    documents = rows.select("host", "h", "document").distinct()
    common = documents.groupBy("host", "h").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > max_documents)
    named = common.select(F.col("host").alias("c_host"), F.col("h").alias("c_h"))
    hit = rows.join(named, (rows["h"] == named["c_h"]) & rows["host"].eqNullSafe(named["c_host"]), "left_semi")
    # Rows alike in id and text repeat their lines: count each place once.
    places = F.collect_set("at")
    repeats = F.count(F.lit(1)) / F.size(places)
    return hit.groupBy("id", "tag").agg((F.sum("w") / repeats).cast("bigint").alias("removed"), F.array_sort(places).alias("removed_at"))


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at the given ascending places, counted from 0; blank lines stay."""
    def rest(x: Column) -> Column:
        def before(end: Column, k: Column) -> Column:
            start = F.coalesce(F.get(x["ends"], k - 1), F.lit(-1)) + 1
            return F.slice(x["lines"], start + 1, end - start)

        return F.array_join(F.flatten(F.transform(x["ends"], before)), "\n")

    def ends(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), F.concat(places, F.array(F.size(lines))).alias("ends"))

    return _let(_let(F.split(text, "\n", -1), ends), rest)


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_words: int = 10, max_repeat_percent: int = 20, max_documents: int = 20, min_left_percent: int = 20,
) -> DataFrame:
    """One row per document: id, the figures, ``base_failed``, ``n_line_words``, ``kept``, ``removed_at`` and ``tag``.

    ``n_line_words`` are the words in removed lines, ``removed_at`` their places
    among all lines of the text, from 0 (null if there are none). A document is kept if it
    passes the base rules and at least ``min_left_percent`` of its words are
    outside removed lines. A null text counts as empty, a null host is a host
    of its own. An empty table gives no rows.
    """
    figures = docs.select(F.col(id_col).alias(id_col), text_tag(text_col).alias("tag"), *[
        c.alias(name) for name, c in text_figures(text_of(text_col)).items()
    ])
    lines = removed_lines(docs, id_col, text_col, host_col, max_documents).select(
        F.col("id").alias("_k_id"), F.col("tag").alias("_k_tag"), "removed", "removed_at"
    )
    joined = figures.join(lines, figures[id_col].eqNullSafe(lines["_k_id"]) & (figures["tag"] == lines["_k_tag"]), "left")
    removed = F.coalesce("removed", F.lit(0)).cast("bigint")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return joined.withColumns({"base_failed": failed, "n_line_words": removed}).select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words",
        (~F.col("base_failed") & (100 * left >= min_left_percent * F.col("n_words"))).alias("kept"), "removed_at", "tag",
    )


def drop_low_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **rules) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns and whole texts."""
    decided = quality(docs, id_col, text_col, host_col, **rules)
    return keep_rows(docs, decided.where("kept"), id_col, text_col, repeated=True)


def clean_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", size_col: str | None = None, **rules,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, their texts without the removed lines, other columns as they are.

    ``size_col`` names a column with the length of the text; it is counted anew where lines go.
    """
    tag, own_id, own_tag, at = fresh(docs, "tag", "own_id", "own_tag", "removed_at")
    decided = quality(docs, id_col, text_col, host_col, **rules).where("kept")
    # Rows alike in id and text have one decision.
    named = decided.select(F.col(id_col).alias(own_id), F.col("tag").alias(own_tag), F.col("removed_at").alias(at))
    named = named.dropDuplicates([own_id, own_tag])
    tagged = docs.withColumn(tag, text_tag(text_col))
    found = tagged.join(named, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(tag) == F.col(own_tag)))
    cut = F.col(at).isNotNull()
    cleaned = found.withColumn(text_col, F.when(cut, without_lines(F.col(text_col), F.col(at))).otherwise(F.col(text_col)))
    if size_col is not None:
        size = F.length(text_col).cast(docs.schema[size_col].dataType)
        cleaned = cleaned.withColumn(size_col, F.when(cut, size).otherwise(F.col(size_col)))
    return cleaned.select(*docs.columns)


QUERY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT rid, i, list_slice(words, i, i + 4) AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid
), l AS (
  SELECT rid, source, place, substr(md5(regexp_replace(lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), '[1-9]', '0', 'g')), 1, 16) AS h,
    len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT rid, source, unnest(lines) AS x, unnest(range(len(lines))) AS place FROM w)
), a AS (
  SELECT l.*, document FROM l JOIN (SELECT rid, md5(string_agg(h, '' ORDER BY place)) AS document FROM l GROUP BY rid) USING (rid)
), common AS (
  SELECT source, h FROM a GROUP BY source, h HAVING count(DISTINCT document) > 20
), removed AS (
  SELECT a.rid, sum(n) AS removed FROM a JOIN common c ON a.h = c.h AND a.source IS NOT DISTINCT FROM c.source GROUP BY a.rid
), f AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(r.removed, 0) AS BIGINT) AS n_line_words
  FROM w LEFT JOIN covered c ON w.rid = c.rid LEFT JOIN removed r ON w.rid = r.rid
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f
)
SELECT *, NOT base_failed AND 100 * (n_words - n_line_words) >= 20 * n_words AS kept FROM b
"""
