"""Packing documents into token sequences, filled by deficit round-robin over source queues.

The documents of a source form a queue of tokens. Every queue earns credit in
proportion to its share of all tokens and sends a quantum of tokens whenever its
credit reaches one quantum; what is left of the credit (the deficit) is carried
on. Queue ``t`` of ``M_t`` quanta has therefore sent ``floor(x * M_t)`` of them
when a share ``x`` of the work is done, whatever happened before, and a quantum
knows its place in the whole token stream from these numbers alone. So every
task continues the deficits exactly where any other task would leave them,
windows are cut from one gapless stream, each holds the sources in the corpus'
proportions to within a quantum, and only the very last one needs padding.

Three steps: the texts are tokenised once and stored with running token counts
per (task, source); a window over these counts (tasks x sources rows) gives each
task the place where its part of a queue begins; then every document cuts itself.
No step gathers a source or a window in one place. Per quantum the work grows
with the number of sources, which is meant to be at most some thousands.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import slices, text_of
from tidewake.session import shared_dir

# Below this code point both tokenizer libraries split alike (a test goes through all of them).
SAME_SPLIT = 0x250

SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokenizer:
    """Token ids as the ``tokenizers`` library gives them for a byte-level BPE file.

    ``tiktoken`` runs the same vocabulary several times faster, so it takes the
    texts on which the two are known to agree; other texts go to ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # The printable stand-ins of bytes: fixed values of the byte-level format.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.fast = tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if text.isascii() or ord(max(text)) < SAME_SPLIT:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except BaseException as error:  # the library's way to give up on extreme texts is no Exception
                if type(error).__name__ != "PanicException":
                    raise
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def _queue(source) -> str:
    """Queue name of a source; null has its own."""
    return "0" if source is None else f"1{source}"


def tokenised(docs: DataFrame, id_col: str, text_col: str, source_col: str, path: str) -> DataFrame:
    """Store ids (with the closing id 0), queue, task number and the place within the task's part of the queue."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("queue", T.StringType()),
        T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()),
    ])

    def run(batches):
        tokenizer, part, counts = ByteTokenizer(path), TaskContext.get().partitionId(), {}
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, queues, lengths, at = [], [], [], []
                for text, source in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist()):
                    own = np.append(tokenizer.ids(text) if text else np.empty(0, np.uint32), np.uint32(0))
                    queue = _queue(source)
                    ids.append(own.astype("<u4" if own.max() > 0xFFFF else "<u2").tobytes())
                    queues.append(queue)
                    lengths.append(len(own))
                    at.append(counts.get(queue, 0))
                    counts[queue] = at[-1] + len(own)
                columns = [batch.column("doc_id"), pa.array(queues), pa.array(ids, pa.binary()), pa.array(lengths, pa.int64()),
                           pa.array([part] * len(ids), pa.int32()), pa.array(at, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    path_out = shared_dir(docs.sparkSession, "token-ids")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path_out)
    return docs.sparkSession.read.schema(schema).parquet(path_out)


def stream_places(queue: int, quanta: np.ndarray, tokens: list[int], quantum: int) -> np.ndarray:
    """Place in the whole stream of the given quanta of one queue.

    A quantum is sent when its queue's share of the work is done; queues that
    reach the same share at once go in their order.
    """
    counts = [-(-n // quantum) for n in tokens]
    # Products of two counts: beyond 63 bits Python's integers take over.
    kind = np.int64 if max(counts) ** 2 < 2**62 else object
    done = quanta.astype(kind) + 1
    place = np.zeros(len(quanta), kind)
    for t, n in enumerate(tokens):
        if t < queue:
            sent = done * counts[t] // counts[queue]
        elif t > queue:
            sent = -(-(done * counts[t]) // counts[queue]) - 1
        else:
            sent = done - 1
        place += np.minimum(sent * quantum, n)
    return place.astype(np.int64)


def cut_documents(starts: np.ndarray, lengths: np.ndarray, queue: int, tokens: list[int], quantum: int, window: int):
    """Pieces of documents of one queue that begin at ``starts`` in it: document, start, length, sequence, offset."""
    first, last = starts // quantum, (starts + lengths - 1) // quantum
    per_doc = last - first + 1
    doc = np.repeat(np.arange(len(starts)), per_doc)
    quanta = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    begin = np.maximum(starts[doc], quanta * quantum)
    end = np.minimum(starts[doc] + lengths[doc], (quanta + 1) * quantum)
    place = stream_places(queue, quanta, tokens, quantum) + begin - quanta * quantum
    size, start = end - begin, begin - starts[doc]
    # Cut where a window ends; a quantum is no longer than a window.
    over = np.maximum(place % window + size - window, 0)
    both = np.flatnonzero(over)
    keep = size - over
    doc, start, place, size = (np.concatenate(x) for x in (
        (doc, doc[both]), (start, start[both] + keep[both]), (place, place[both] + keep[both]), (keep, over[both])))
    order = np.lexsort((start, doc))
    doc, start, place, size = doc[order], start[order], place[order], size[order]
    # Join pieces that follow each other in the document and in the window.
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + size[:-1]) | (place[1:] % window == 0)
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], np.add.reduceat(size, heads), place[heads] // window, place[heads] % window


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    window: int = 1024, quantum: int = 128,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A null text is empty and has the closing id alone; null sources share a
    queue; rows with the same id are packed each on its own. Other columns of
    ``docs`` are ignored. An empty table gives no rows.
    """
    if not 0 < quantum <= window:
        raise ValueError("a quantum must fit into a window")
    stored = tokenised(docs, id_col, text_col, source_col, tokenizer_path)
    parts = stored.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    # One row per queue: the mixture's components.
    totals = {r["queue"]: r["n"] for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(totals, key=lambda q: q.encode())
    tokens = [totals[q] for q in queues]
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = stored.join(bases, ["part", "queue"]).select("doc_id", "queue", "ids", "n", (F.col("base") + F.col("at")).alias("begin"))
    schema = T.StructType([T.StructField(id_col, stored.schema["doc_id"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ])

    def run(batches):
        number = {q: i for i, q in enumerate(queues)}
        for whole in batches:
            for batch in slices(whole, "ids"):
                of = np.array([number[q] for q in batch.column("queue").to_pylist()])
                begin, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("begin", "n"))
                ids = batch.column("ids")
                for q in np.unique(of):
                    rows = np.flatnonzero(of == q)
                    doc, start, length, sequence, offset = cut_documents(begin[rows], n[rows], int(q), tokens, quantum, window)
                    sums, held, view = [], -1, None
                    for d, s, size in zip(doc.tolist(), start.tolist(), length.tolist()):
                        if d != held:
                            held, raw = d, ids[int(rows[d])].as_py()
                            width = len(raw) // int(n[rows[d]])
                            view = memoryview(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
                        sums.append(zlib.crc32(view[4 * s:4 * (s + size)]))
                    columns = [batch.column("doc_id").take(pa.array(rows[doc])), *[
                        pa.array(x, pa.int64()) for x in (start, length, sums, n[rows[doc]], sequence, offset)]]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return placed.mapInArrow(run, schema)
