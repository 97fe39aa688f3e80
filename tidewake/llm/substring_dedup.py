"""Repeated passages across documents, found with an FM-index per shard.

A passage is a window of ``window`` consecutive words. A word goes if a window
over it also starts in a document with a smaller id; windows are judged on the
input, so the result depends on no order of work.

Sending every window to the place where its copies are would move each word
``window`` times. Instead a window is named by its *anchor*, the least hash
among the short word sequences inside it. Equal windows have equal anchors, and
neighbours mostly share theirs, so documents fall into runs of windows:

1. Every bucket of documents lists its anchors, and those that two or more
   documents have are told back to the buckets. Most runs end here.
2. The words of the other runs go to the shard of their anchor, equal runs of a
   bucket once. Anchors of very many documents would fill one shard; their
   windows travel singly, dealt by all their words.
3. A shard builds an FM-index over its runs and streams the windows of all of
   them through it. The statistics give the interval of every window of full
   length, and the least document in the interval goes back to the bucket.
4. The buckets mark the words and put together what is kept.

The documents are shuffled once, by bucket; all three visits read that shuffle.
The number of buckets and shards follows the bytes of text, so a group is a few
megabytes at any scale. Words are compared as they are within a shard; hashes
only choose where things go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import slices, text_of, text_tag, texts_as_bytes
from tidewake.llm.fm_index import FMIndex
from tidewake.llm.words import mixed, sequence_hashes, word_hashes

# Words of the sequences that anchors are chosen from.
ANCHOR = 5

# Documents that have an anchor above which its windows travel singly.
HOT = 5_000

BUCKET_BYTES = 8 << 20
SHARD_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done:]) if done < width else values


class Runs:
    """Runs of windows with one anchor in some texts: document, anchor, first window, windows."""

    def __init__(self, texts: list[bytes], window: int):
        self.hashes, self.bounds = word_hashes(texts)
        empty = np.empty(0, np.int64)
        self.doc, self.anchor, self.start, self.count = empty, empty.astype(np.uint64), empty, empty
        if len(self.hashes) < window:
            return
        owner = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        least = _least(sequence_hashes(self.hashes, ANCHOR), window - ANCHOR + 1)
        last = len(self.hashes) - window + 1
        whole = owner[:last] == owner[window - 1:]
        new = np.ones(last, bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:last] != owner[: last - 1]) | ~whole[:-1]
        heads = np.flatnonzero(new & whole)
        # A run ends where the next begins or where windows stop.
        stops = np.append(np.flatnonzero(new | ~whole), last)
        self.start = heads
        self.count = stops[np.searchsorted(stops, heads, side="right")] - heads
        self.doc, self.anchor = owner[heads], least[heads]


def _visits(table: pa.Table):
    """Slices of a bucket in a fixed order: (ids, texts)."""
    order = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("tag", "ascending")])
    for batch in table.take(order).combine_chunks().to_batches():
        for part in slices(batch, "text", 1 << 20):
            ids = np.array([NO_ID if x is None else x for x in part.column("id").to_pylist()], np.int64)
            yield part, ids, texts_as_bytes(part.column("text"))


ANCHORS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("anchors", T.BinaryType()), T.StructField("documents", T.BinaryType()),
])


def _list_anchors(window: int, shards: int):
    """Anchors of a bucket by shard, with the number of documents that have each."""
    def run(table: pa.Table) -> pa.Table:
        anchors, docs, base = [], [], 0
        for _, ids, texts in _visits(table):
            runs = Runs(texts, window)
            anchors.append(runs.anchor)
            docs.append(runs.doc + base)
            base += len(texts)
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        pair = new.copy()
        pair[1:] |= doc[1:] != doc[:-1]
        heads = np.flatnonzero(new)
        counts = np.add.reduceat(pair.astype(np.uint32), heads) if len(heads) else np.empty(0, np.uint32)
        anchor = anchor[heads]
        shard = (mixed(anchor) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        anchor, counts, shard = anchor[order], counts[order], shard[order]
        names, heads = np.unique(shard, return_index=True)
        ends = np.append(heads, len(shard))[1:]
        return pa.table({
            "shard": pa.array(names, pa.int32()), "bucket": pa.array(np.full(len(names), table.column("bucket")[0].as_py()), pa.int32()),
            "anchors": pa.array([anchor[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
            "documents": pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(heads, ends)], pa.binary()),
        })

    return run


# What is told back to buckets: anchors to look at (with their hot marks), or least documents of a run's windows.
NOTES = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("run", T.LongType()),
    T.StructField("first", T.BinaryType()), T.StructField("second", T.BinaryType()),
])


def _shared_anchors(hot: int):
    """Anchors that two or more documents have, for each bucket that has them."""
    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("anchors").to_pylist()]
        anchor = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("documents").to_pylist()])
        names, place = np.unique(anchor, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(names))
        shared, is_hot = total[place] > 1, total[place] > hot
        buckets, first, second, at = [], [], [], 0
        for bucket, part in zip(table.column("bucket").to_pylist(), parts):
            use = shared[at:at + len(part)]
            if use.any():
                buckets.append(bucket)
                first.append(part[use].tobytes())
                second.append(is_hot[at:at + len(part)][use].tobytes())
            at += len(part)
        return pa.table({
            "bucket": pa.array(buckets, pa.int32()), "run": pa.array([-1] * len(buckets), pa.int64()),
            "first": pa.array(first, pa.binary()), "second": pa.array(second, pa.binary()),
        })

    return run


def _shared_runs(table: pa.Table, notes: pa.Table, window: int):
    """Numbered distinct runs of a bucket that other documents may have, and where they are.

    Returns {words: [number, least id, route]} and, per slice, (rows, ids, words, bounds, places), a
    place being (document, first word, run number).
    """
    lists = notes.filter(pc.equal(notes.column("run"), -1))
    anchors = np.concatenate([np.frombuffer(x, np.uint64) for x in lists.column("first").to_pylist()] or [np.empty(0, np.uint64)])
    marks = np.concatenate([np.frombuffer(x, bool) for x in lists.column("second").to_pylist()] or [np.empty(0, bool)])
    order = np.argsort(anchors)
    anchors, marks = anchors[order], marks[order]
    known, visits = {}, []
    for part, ids, texts in _visits(table):
        places = []
        words = b"\n".join(texts).split()
        runs = Runs(texts, window)
        if len(anchors) and len(runs.anchor):
            at = np.minimum(np.searchsorted(anchors, runs.anchor), len(anchors) - 1)
            use = np.flatnonzero(anchors[at] == runs.anchor)
            single = marks[at[use]]
            # Hot runs are taken apart into windows, routed by all their words.
            spread = use[single]
            doc, start = np.repeat(runs.doc[spread], runs.count[spread]), np.concatenate(
                [np.arange(s, s + c) for s, c in zip(runs.start[spread], runs.count[spread])] or [np.empty(0, np.int64)])
            route = sequence_hashes(runs.hashes, window)[start] if len(start) else np.empty(0, np.uint64)
            use = use[~single]
            doc = np.concatenate([runs.doc[use], doc])
            size = np.concatenate([runs.count[use], np.ones(len(start), np.int64)]) + window - 1
            start = np.concatenate([runs.start[use], start])
            route = np.concatenate([mixed(runs.anchor[use]), route])
            for d, s, n, r in zip(doc.tolist(), start.tolist(), size.tolist(), route.tolist()):
                key = b" ".join(words[s:s + n])
                entry = known.get(key)
                if entry is None:
                    entry = known[key] = [len(known), int(ids[d]), r]
                elif ids[d] < entry[1]:
                    entry[1] = int(ids[d])
                places.append((d, s, entry[0]))
        visits.append((part, ids, words, runs.bounds, places))
    return known, visits


RUNS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("run", T.LongType()),
    T.StructField("least", T.LongType()), T.StructField("words", T.BinaryType()),
])


def _send_runs(window: int, shards: int):
    def run(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows or not notes.num_rows:
            return pa.table({f.name: pa.array([], t) for f, t in zip(RUNS, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))})
        known, _ = _shared_runs(table, notes, window)
        n, bucket = len(known), table.column("bucket")[0].as_py()
        numbers, least, routes = zip(*known.values()) if known else ((), (), ())
        return pa.table({
            "shard": pa.array([r % shards for r in routes], pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()),
            "run": pa.array(numbers, pa.int64()), "least": pa.array(least, pa.int64()), "words": pa.array(list(known), pa.binary()),
        })

    return run


def _search_shard(window: int):
    """Least document of every window of the shard's runs, told to the buckets where another one is less."""
    def run(table: pa.Table) -> pa.Table:
        texts, least = table.column("words").to_pylist(), table.column("least").to_numpy()
        distinct: dict[bytes, int] = {}
        of = np.array([distinct.setdefault(t, len(distinct)) for t in texts])
        owner = np.full(len(distinct), NO_ID)
        np.minimum.at(owner, of, least)
        # Words to numbers, each run closed by 0.
        numbers: dict[bytes, int] = {}
        symbols, sizes = [], []
        for t in distinct:
            ws = t.split(b" ")
            sizes.append(len(ws) + 1)
            symbols += [numbers.setdefault(w, len(numbers) + 1) for w in ws]
            symbols.append(0)
        symbols, sizes = np.array(symbols, np.int64), np.array(sizes)
        ends = np.cumsum(sizes)
        index = FMIndex(symbols, len(numbers) + 1, window)
        least_of = np.repeat(owner, sizes)[index.suffixes]
        counts = sizes - window
        heads = np.cumsum(counts) - counts
        starts = np.repeat(ends - sizes - heads, counts) + np.arange(counts.sum())
        result = np.empty(len(starts), np.int64)
        for a in range(0, len(starts), 1 << 18):
            _, low, high = index.statistics(symbols, starts[a:a + (1 << 18)], window)
            bounds, place = np.unique(low, return_inverse=True)
            tops = np.empty(len(bounds), np.int64)
            tops[place] = high
            edges = np.minimum(np.column_stack([bounds, tops]).ravel(), len(least_of) - 1)
            lows = np.minimum.reduceat(least_of, edges)[::2]
            # The interval that reaches the end of the index has no right edge.
            open_end = tops == len(least_of)
            for i in np.flatnonzero(open_end):
                lows[i] = least_of[bounds[i]:].min()
            result[a:a + (1 << 18)] = lows[place]
        smallest = np.minimum.reduceat(result, heads) if len(heads) else result
        tell = np.flatnonzero(smallest[of] < least)
        return pa.table({
            "bucket": table.column("bucket").take(pa.array(tell)), "run": table.column("run").take(pa.array(tell)),
            "first": pa.array([result[heads[d]:heads[d] + counts[d]].tobytes() for d in of[tell]], pa.binary()),
            "second": pa.array([b""] * len(tell), pa.binary()),
        })

    return run


def _mark(window: int, schema: T.StructType, id_type: pa.DataType):
    span = pa.struct([("first", pa.int32()), ("words", pa.int32())])

    def run(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            columns = (id_type, pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.int64())
            return pa.table({f.name: pa.array([], t) for f, t in zip(schema, columns)})
        known, visits = _shared_runs(table, notes, window)
        told = notes.filter(pc.greater_equal(notes.column("run"), 0))
        least = {r: np.frombuffer(x, np.int64) for r, x in zip(told.column("run").to_pylist(), told.column("first").to_pylist())}
        own, sizes = [x[1] for x in known.values()], [key.count(b" ") + 1 for key in known]
        ids, n_words, n_removed, digests, spans, tags = [], [], [], [], [], []
        for part, keys, words, bounds, places in visits:
            # Windows to mark: those that the shards told of, window by window, and whole runs
            # that a smaller document of this bucket has.
            told, firsts, limits, whole, until = [], [], [], [], []
            for d, s, r in places:
                other = least.get(r)
                if other is not None:
                    told.append(other)
                    firsts.append(s)
                    limits.append(keys[d])
                elif own[r] < keys[d]:
                    whole.append(s)
                    until.append(s + sizes[r])
            change = np.bincount(np.array(whole, np.int64), minlength=len(words) + 1) - np.bincount(np.array(until, np.int64), minlength=len(words) + 1)
            if told:
                counts = np.array([len(x) for x in told])
                at = np.repeat(np.array(firsts) - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                at = at[np.concatenate(told) < np.repeat(np.array(limits), counts)]
                change += np.bincount(at, minlength=len(words) + 1) - np.bincount(at + window, minlength=len(words) + 1)
            covered = np.cumsum(change[:-1]) > 0
            for d in range(len(keys)):
                a, b = int(bounds[d]), int(bounds[d + 1])
                gone = covered[a:b]
                removed = int(gone.sum())
                kept = [w for w, g in zip(words[a:b], gone.tolist()) if not g] if removed else words[a:b]
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)) if removed else ()
                n_words.append(b - a)
                n_removed.append(removed)
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                spans.append([{"first": int(x), "words": int(y - x)} for x, y in zip(edges[::2], edges[1::2])])
            ids += part.column("id").to_pylist()
            tags += part.column("tag").to_pylist()
        return pa.table({
            schema[0].name: pa.array(ids, id_type), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digests), "spans": pa.array(spans, pa.list_(span)), "tag": pa.array(tags, pa.int64()),
        })

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, hot: int = HOT) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``spans`` and ``tag``.

    ``spans`` (first word, words) are the removed intervals. ``kept_sha256`` is
    the digest of the kept words joined by single spaces. Texts shorter than a
    window, empty and null ones lose nothing. Rows with equal ids are no smaller
    than each other; a null id is larger than all others. Other columns are
    ignored; an empty table gives no rows. Ids are integers.
    """
    text = text_of(text_col)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets, shards = max(64, total // BUCKET_BYTES + 1), max(64, total // SHARD_BYTES + 1)
    tag = text_tag(text_col)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), tag), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(id_col).cast("bigint").alias("id"), tag.alias("tag"), text.alias("text"),
    )
    listed = rows.groupBy("bucket").applyInArrow(_list_anchors(window, shards), ANCHORS)
    shared = listed.groupBy("shard").applyInArrow(_shared_anchors(hot), NOTES)
    sent = rows.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(_send_runs(window, shards), RUNS)
    least = sent.groupBy("shard").applyInArrow(_search_shard(window), NOTES)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType())]))),
        T.StructField("tag", T.LongType()),
    ])
    notes = shared.unionByName(least)
    marked = rows.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(_mark(window, schema, pa.int64()), schema)
    return marked.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "n_removed", "kept_sha256", "spans", "tag")


QUERY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT rid, doc_id, i, list_slice(words, i, i + 12) AS g FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)
), hit AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT rid, i + k AS i FROM hit, (SELECT unnest(range(0, 13)) AS k)
), w AS (
  SELECT d.rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), kept AS (
  SELECT w.rid, string_agg(word, ' ' ORDER BY w.i) AS t, count(*) AS n FROM w LEFT JOIN gone ON w.rid = gone.rid AND w.i = gone.i WHERE gone.rid IS NULL GROUP BY w.rid
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""
