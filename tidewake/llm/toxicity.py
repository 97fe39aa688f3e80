"""Counterfactual-regularised toxicity classifier.

A logistic model over hashed features of a text: its words (runs of letters) and
the four-letter pieces of its words, each counted once per text. In labelled
sentences that name a group of people, the name is swapped for others of the
same kind; the loss adds the squared change of the score for each swap, so a
group's name alone can't carry weight and neutral mentions stay clean.

Features are taken from the texts in parallel. The fit sees a sample of labelled
rows of a stated size, so it is one small task whatever the size of the corpus.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import slices, text_of
from tidewake.llm.language_id import SCRIPTS, fold, script_table
from tidewake.session import materialize

BUCKETS = 1 << 20
GRAM = 4
SLICE = 1 << 19

# Names that may be swapped for each other within a line.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("african", "european", "american", "chinese", "mexican", "indian"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young"), ("disabled", "deaf", "blind"), ("frauen", "männer"), ("juden", "christen", "muslime"),
    ("femmes", "hommes"), ("juifs", "chrétiens", "musulmans"), ("mujeres", "hombres"), ("judíos", "cristianos", "musulmanes"),
)


def features(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position's text, bucket) of all features of the texts, repeats included; buckets below ``2 * BUCKETS``."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    letter = table[points] < len(SCRIPTS)
    # Pieces of four letters, by their last one.
    inside = letter.copy()
    mixed = points * np.uint64(0x9E3779B97F4A7C15)
    for k, factor in zip(range(1, GRAM), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        inside[k:] &= letter[:-k] if k < len(letter) else False
        inside[:k] = False
        mixed[k:] += points[:-k] * np.uint64(factor) if k < len(points) else 0
    at = np.flatnonzero(inside)
    grams = _bucket(mixed[at])
    # Words: a running polynomial hash, cut at the ends of runs of letters.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    powers = np.cumprod(np.full(len(points), base))
    summed = np.concatenate([[np.uint64(0)], np.cumsum(points * powers)])
    back = np.cumprod(np.full(len(points), inverse))
    words = _bucket((summed[stops] - summed[starts]) * back[starts] if len(starts) else np.empty(0, np.uint64))
    text = np.searchsorted(ends, np.concatenate([at, starts]), side="right")
    return text, np.concatenate([grams, words + BUCKETS])


def _bucket(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(44)).astype(np.int64)


def swaps(text: str, terms=IDENTITY_TERMS) -> list[tuple[str, str]]:
    """(name, what it may be swapped for) for every name of a group in the text's sentences."""
    line_of = {t: [o for o in line if o != t] for line in terms for t in line}
    return [(w, other) for w in re.findall(r"\w+", text.lower()) if w in line_of for other in line_of[w]]


def _swap_changes(texts: list[str], table: np.ndarray, terms) -> list[list[int]]:
    """For each swap in the texts the features it adds (positive) and takes away (negative), buckets from 1.

    A swap changes the features of the name alone; it counts once per text.
    """
    changes = []
    for text in texts:
        for name, other in sorted(set(swaps(text, terms))):
            of, bucket = features([name, other], table)
            had, has = set(bucket[of == 0].tolist()), set(bucket[of == 1].tolist())
            changes.append([b + 1 for b in sorted(has - had)] + [-b - 1 for b in sorted(had - has)])
    return changes


def fit_logistic(
    rows: list[np.ndarray], labels: np.ndarray, changes: list[list[int]], most: int = 4096, min_rows: int = 4,
    ridge: float = 2e-5, swap_penalty: float = 1.0, steps: int = 400,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias). ``rows`` are the distinct buckets of each labelled text.

    The ``most`` buckets whose frequency differs most surely between the labels
    are weighted, by accelerated gradient steps on the mean logistic loss, a
    ridge, and the mean squared score change over all swaps.
    """
    toxic = labels == 1

    def blocks():
        """(row, bucket) of a thousand rows at a time."""
        for i in range(0, len(rows), 1000):
            part = rows[i:i + 1000]
            yield np.repeat(np.arange(i, i + len(part), dtype=np.int32), [len(x) for x in part]), np.concatenate(part)

    counts = np.zeros((2, 2 * BUCKETS), np.int32)
    for of, flat in blocks():
        for label in (0, 1):
            counts[label] += np.bincount(flat[toxic[of] == label], minlength=2 * BUCKETS).astype(np.int32)
    big1, big0 = max(toxic.sum(), 1), max((~toxic).sum(), 1)
    often = np.flatnonzero(counts.sum(axis=0) >= min_rows)
    n0, n1 = counts[:, often].astype(float)
    odds = np.log((n1 + 0.5) / (big1 + 1)) - np.log((n0 + 0.5) / (big0 + 1))
    sure = np.abs(odds) / np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))
    best = np.argsort(-sure, kind="stable")[:most]
    chosen = np.sort(often[best[sure[best] > 3]])
    column = np.full(2 * BUCKETS, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    held = [(of[use], column[flat[use]]) for of, flat in blocks() for use in [column[flat] >= 0]]
    r, c = (np.concatenate([x[k] for x in held]) if held else np.empty(0, np.int32) for k in (0, 1))
    pairs = [(i, column[abs(b) - 1], np.sign(b)) for i, change in enumerate(changes) for b in change if column[abs(b) - 1] >= 0]
    pi, pc, ps = (np.array(x) for x in zip(*pairs)) if pairs else (np.empty(0, int),) * 3
    n, n_swaps, y = max(len(rows), 1), max(len(changes), 1), toxic.astype(float)
    # Rows of the rarer label weigh more, by the root of the ratio.
    row_weight = np.where(y == 1, np.sqrt(big0 / big1), 1.0) / n
    weights, bias = np.zeros(len(chosen)), float(np.log(big1 / big0))
    held_w, held_b, rate = weights, bias, 0.0
    # Steps from bounds of the curvature: that of a feature times the most features in a row.
    per_row = np.bincount(r, minlength=n).max(initial=0) + 1
    curved = 0.25 * np.bincount(c, weights=row_weight[r], minlength=len(chosen))
    if len(pairs):
        per_swap = np.bincount(pi, minlength=len(changes)).max()
        curved += 2 * swap_penalty * per_swap * np.bincount(pc, minlength=len(chosen)) / n_swaps
    step_w, step_b = 1 / (per_row * curved + ridge), 4 / (per_row * max(row_weight.sum(), 1e-9))
    for k in range(steps):
        look_w, look_b = weights + rate * (weights - held_w), bias + rate * (bias - held_b)
        z = look_b + np.bincount(r, weights=look_w[c], minlength=n)[: len(rows)]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * row_weight
        grad = np.bincount(c, weights=error[r], minlength=len(chosen)) + ridge * look_w
        if len(pairs):
            moved = np.bincount(pi, weights=ps * look_w[pc], minlength=len(changes))
            grad += 2 * swap_penalty * np.bincount(pc, weights=ps * moved[pi], minlength=len(chosen)) / n_swaps
        held_w, held_b = weights, bias
        weights, bias = look_w - step_w * grad, look_b - step_b * error.sum()
        rate = k / (k + 3)
    return chosen, weights, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = 12_000, terms=IDENTITY_TERMS,
) -> DataFrame:
    """Weights (``bucket``, ``weight``; bucket -1 is the bias) from about ``sample`` labelled rows.

    All labelled rows are used up to that number; beyond it a row is drawn by
    the hash of its id. Rows without a label or without a document are left out.
    """
    named = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label"))
    share = min(1.0, sample / max(named.count(), 1))

    def drawn(column: str):
        return F.crc32(F.concat(F.lit("fit"), F.col(column).cast("string")).cast("binary")) < int(share * 2**32)

    rows = docs.where(drawn(id_col)).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    joined = rows.join(named.where(drawn("l_id")), F.col("id") == F.col("l_id")).select("text", "label")
    schema = T.StructType([
        T.StructField("label", T.IntegerType()), T.StructField("buckets", T.ArrayType(T.IntegerType())),
        T.StructField("changes", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ])

    def extract(batches):
        table = script_table()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = batch.column("text").to_pylist()
                of, bucket = features(texts, table)
                distinct = np.unique(of * (2 * BUCKETS) + bucket)
                heads = np.searchsorted(distinct // (2 * BUCKETS), np.arange(len(texts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(distinct % (2 * BUCKETS), pa.int32()))
                changes = pa.array([_swap_changes([t], table, terms) for t in texts], pa.list_(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([batch.column("label"), lists, changes], names=schema.names)

    out = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("weight", T.DoubleType())])

    def fit(table: pa.Table) -> pa.Table:
        rows, changes = [], []
        for chunk in table.column("buckets").chunks:
            rows += [chunk.values.to_numpy()[a:b] for a, b in zip(chunk.offsets.to_pylist(), chunk.offsets.to_pylist()[1:])]
        for each in table.column("changes").to_pylist():
            changes += each
        buckets, weights, bias = fit_logistic(rows, table.column("label").to_numpy(), changes)
        return pa.table({"bucket": np.append(buckets, -1), "weight": np.append(weights, bias)})

    # The sample's features, of bounded number, meet in one task.
    return joined.mapInArrow(extract, schema).groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda t: fit(t.drop(["all"]) if "all" in t.column_names else t), out)


def score_texts(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: id, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have the score of the bias alone. Every row is scored
    for itself from its whole text; other columns are ignored.
    """
    # At most a few thousand numbers.
    model = {r["bucket"]: r["weight"] for r in weights.collect()}
    bias = model.pop(-1, -4.0)
    buckets, values = np.array(list(model), np.int64), np.array(list(model.values()))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        table, column = script_table(), np.zeros(2 * BUCKETS, np.int32)
        column[buckets] = np.arange(1, len(buckets) + 1)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                n = batch.num_rows
                of, bucket = features(batch.column("text").to_pylist(), table)
                found = column[bucket]
                use = np.flatnonzero(found)
                distinct = np.unique(of[use] * (len(buckets) + 1) + found[use])
                at, which = np.divmod(distinct, len(buckets) + 1)
                z = bias + np.bincount(at, weights=values[which - 1] if len(which) else None, minlength=n)[:n]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=schema.names)

    scored = rows.mapInArrow(run, schema)
    return scored.select(F.col("doc_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def predict_held_out(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, out: int = 1) -> DataFrame:
    """Learn from the labels of all folds but one and score every document; ``held_out`` marks that fold."""
    weights = materialize(train(docs, labels.where(fold(id_col, folds) != out), id_col, text_col), "toxicity")
    held = F.coalesce(fold(id_col, folds) == out, F.lit(False))
    return score_texts(docs, weights, id_col, text_col).select(id_col, held.alias("held_out"), "score", "predicted")
