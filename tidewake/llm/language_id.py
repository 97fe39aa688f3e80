"""Language identification of mixed texts: script ranges, per-word scores, Viterbi.

The model counts letter trigrams per language in a hashed table of fixed size,
and letters per (language, script); both are sums, so every task counts its part
of all training documents and the parts are added up.

A word is scored for each language by the log-probabilities of the trigrams that
end in its letters. Languages that hardly use the script of the word are out.
Viterbi then labels the words of a document: staying in a language is free,
switching costs a fixed penalty, so single odd words don't break a span. All
documents of a slice go through the recursion together, word by word.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import slices, text_of
from tidewake.session import materialize

BUCKETS = 1 << 16
UNKNOWN = "und"

# Bytes of text that go through the recursion together.
SLICE = 2 << 20

# First code points of script ranges (Unicode blocks) and the scripts: fixed values.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})


def script_table() -> np.ndarray:
    """Script number of every code point; the number of scripts for what isn't a letter."""
    table = np.full(0x110000, len(SCRIPTS), np.uint8)
    starts = [a for a, _ in SCRIPT_STARTS] + [0x110000]
    for (a, script), b in zip(SCRIPT_STARTS, starts[1:]):
        table[a:b] = SCRIPTS.index(script)
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x33000)), bool, 0x33000)
    table[:0x33000][~letters] = len(SCRIPTS)
    table[0x33000:] = len(SCRIPTS)
    return table


@dataclass
class Letters:
    """Letters of some texts: trigram bucket, script, word number; words have their text's number."""

    bucket: np.ndarray
    script: np.ndarray
    word: np.ndarray
    word_text: np.ndarray


def letters_of(texts: list[str], table: np.ndarray) -> Letters:
    """Trigrams that end in the letters of the texts; what comes before a word counts as space."""
    joined = "\n".join(texts).lower() if texts else ""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    space = (points == 32) | ((points >= 9) & (points <= 13))
    one = np.where(space, 32, points).astype(np.uint64)
    before = np.concatenate([[np.uint64(32)], one])[: len(one)]
    second = np.concatenate([[np.uint64(32)], before])[: len(one)]
    second = np.where(before == 32, np.uint64(32), second)
    mixed = one * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + second * np.uint64(0x165667B19E3779F9)
    bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
    first = ~space & np.concatenate([[True], space])[: len(space)]
    word = np.cumsum(first) - 1
    script = table[points]
    letter = np.flatnonzero(script < len(SCRIPTS))
    word_text = np.searchsorted(ends, np.flatnonzero(first), side="right")
    return Letters(bucket[letter], script[letter].astype(np.int64), word[letter], word_text)


@dataclass
class Model:
    """Log-probabilities [bucket, language] and the languages that each script allows [script, language]."""

    languages: list[str]
    logp: np.ndarray
    allowed: np.ndarray


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = 0.01) -> Model:
    """Count all of ``docs`` that have a language. A language may use a script for ``min_share`` of its letters.

    The model has (trigram buckets + scripts) numbers per language, however much text there is.
    """
    table_size = BUCKETS + len(SCRIPTS)
    rows = docs.where(F.col(lang_col).isNotNull()).select(text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("counts", T.ArrayType(T.LongType()))])

    def count(batches):
        table, counts = script_table(), {}
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                langs = np.array(batch.column("lang").to_pylist(), dtype=object)
                texts = batch.column("text").to_pylist()
                for lang in set(langs):
                    found = letters_of([t for t, x in zip(texts, langs) if x == lang], table)
                    own = counts.setdefault(lang, np.zeros(table_size, np.int64))
                    own[:BUCKETS] += np.bincount(found.bucket, minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(found.script, minlength=len(SCRIPTS))
        for lang, own in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([own.tolist()], pa.list_(pa.int64()))], names=schema.names)

    # One row per task and language: add them up pairwise by task number, then what is left.
    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(table_size, np.int64)
        for row in table.column("counts").chunks:
            total += row.values.to_numpy()[row.offsets[0].as_py():row.offsets[-1].as_py()].reshape(-1, table_size).sum(axis=0)
        return pa.table({"lang": [table.column("lang")[0].as_py()], "counts": pa.array([total.tolist()], pa.list_(pa.int64()))})

    parts = rows.mapInArrow(count, schema).withColumn("task", F.spark_partition_id() % 16)
    partial = parts.groupBy("lang", "task").applyInArrow(lambda t: add(t.drop(["task"])), schema)
    total = partial.groupBy("lang").applyInArrow(add, schema)
    counted = sorted((r["lang"], r["counts"]) for r in materialize(total, "language-counts").collect())
    languages = [lang for lang, _ in counted]
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    counts = np.array([c for _, c in counted], np.float64)
    grams, scripts = counts[:, :BUCKETS] + 0.5, counts[:, BUCKETS:]
    logp = np.log(grams / grams.sum(axis=1, keepdims=True))
    allowed = scripts >= min_share * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    allowed = allowed.T | ~allowed.any(axis=0)[:, None]
    return Model(languages, logp.T.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, texts: np.ndarray, n_texts: int, penalty: float) -> np.ndarray:
    """Best label of each word. ``scores`` [words, languages] in text order, ``texts`` the text of each word."""
    words, languages = scores.shape
    labels = np.zeros(words, np.int64)
    if not words or not languages:
        return labels
    lengths = np.bincount(texts, minlength=n_texts)
    starts = np.cumsum(lengths) - lengths
    # Longest texts first, so that those still running are a prefix.
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], starts[order]
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    came_from = np.zeros((words, languages), np.int8 if languages < 128 else np.int32)
    best = np.zeros((running[0], languages), np.float64)
    for t in range(int(lengths[0])):
        k = running[t]
        at = starts[:k] + t
        if t:
            best = best[:k]
            top = best.argmax(axis=1)
            switched = best[np.arange(k), top][:, None] - penalty
            stay = best >= switched
            came_from[at] = np.where(stay, np.arange(languages), top[:, None])
            best = np.where(stay, best, switched) + scores[at]
        else:
            best = scores[at].astype(np.float64)
        stop = running[t + 1] if t + 1 < lengths[0] else 0
        if stop < k:
            labels[at[stop:]] = best[stop:].argmax(axis=1)
    for t in range(int(lengths[0]) - 2, -1, -1):
        k = running[t + 1]
        at = starts[:k] + t
        labels[at] = came_from[at + 1, labels[at + 1]]
    return labels


def label_spans(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 12.0,
) -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score`` and ``spans`` (language, first word, words).

    ``lang_pred`` is the language with the most letters in its spans and
    ``score`` its share of all letters. Texts that are null or have no letter,
    and all texts of a model without languages, are ``und`` with score 0 and no
    spans. Words without letters go with their neighbours. Nothing but the text
    is looked at; other columns are ignored; repeated rows are repeated.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType())])
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span)),
    ])
    span_type = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())])

    def run(batches):
        table = script_table()
        languages = np.array(model.languages + [UNKNOWN], dtype=object)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = batch.column("text").to_pylist()
                n, found = len(texts), letters_of(texts, table)
                n_words, n_lang = len(found.word_text), len(model.languages)
                scores = np.zeros((n_words, n_lang))
                for j in range(n_lang):
                    scores[:, j] = np.bincount(found.word, weights=model.logp[found.bucket, j], minlength=n_words)
                # The script of a word is that of its first letter.
                has = np.zeros(n_words, bool)
                has[found.word] = True
                heads = np.unique(found.word, return_index=True)[1]
                scores[has] += np.where(model.allowed[found.script[heads]], 0.0, -1e4)
                labels = viterbi(scores, found.word_text, n, penalty)
                letters = np.bincount(found.word, minlength=n_words)
                share = np.zeros((n, n_lang + 1))
                np.add.at(share, (found.word_text, labels), letters)
                total = share.sum(axis=1)
                top = share.argmax(axis=1)
                sure = (total > 0) & (n_lang > 0)
                new = np.ones(n_words, bool)
                new[1:] = (found.word_text[1:] != found.word_text[:-1]) | (labels[1:] != labels[:-1])
                heads = np.flatnonzero(new) if n_lang else np.empty(0, np.int64)
                sizes = np.diff(np.append(heads, n_words))
                owner = found.word_text[heads]
                use = sure[owner]
                heads, sizes, owner = heads[use], sizes[use], owner[use]
                first_word = np.searchsorted(found.word_text, np.arange(n))
                spans = pa.StructArray.from_arrays(
                    [pa.array(languages[labels[heads]], pa.string()), pa.array(heads - first_word[owner], pa.int32()), pa.array(sizes, pa.int32())],
                    fields=list(span_type))
                offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(np.where(sure, languages[np.minimum(top, n_lang)], UNKNOWN), pa.string()),
                    pa.array(np.where(sure, share[np.arange(n), top] / np.maximum(total, 1), 0.0)),
                    pa.ListArray.from_arrays(offsets, spans),
                ], names=schema.names)

    found = rows.mapInArrow(run, schema)
    return found.select(F.col("doc_id").alias(id_col), "lang_pred", "score", "spans")


def fold(id_col: str, folds: int) -> Column:
    """Fold of a row: CRC-32 of its id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def predict_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """Learn from all folds but the first and label every document; ``held_out`` marks the first fold.

    Rows with a null id are in no fold: they are neither learned from nor held out.
    """
    model = train(docs.where(fold(id_col, folds) != 0), text_col, lang_col)
    held = F.coalesce(fold(id_col, folds) == 0, F.lit(False))
    return label_spans(docs, model, id_col, text_col).select(id_col, held.alias("held_out"), "lang_pred", "score", "spans")
