import collections
import gzip
import hashlib
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_rows
from tidewake.llm.packing import SAME_SPLIT, ByteTokenizer, cut_documents, pack
from tidewake.llm.token_counts import COVERED, Counter, count_tokens, whole_tokens
from tidewake.llm.warc import archive_round_trip, classified, read_archives, record_chunks, write_archives

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def around(c):
    """A character in every kind of neighbourhood."""
    return [c, "a" + c, c + "a", "a" + c + "b", "1" + c + "2", "." + c + "!", "'" + c, f" {c} ", c + c, f"A{c}'S ", f"  {c}  x", f"<|endoftext|>{c}"]


def test_byte_tokenizer_agrees():
    full, own = Tokenizer.from_file(BYTE_BPE), ByteTokenizer(BYTE_BPE)
    texts = [t for p in range(SAME_SPLIT) for t in around(chr(p))] + [" " * 3000 + "x", "漢字 и mixed text", "a" * 5000]
    assert all(own.ids(t).tolist() == full.encode(t, add_special_tokens=False).ids for t in texts)


def test_word_counts_agree():
    full, own = Tokenizer.from_file(WORD_BPE), Counter(WORD_BPE, whole_tokens(WORD_BPE))
    texts = [t for p in range(COVERED) for t in around(chr(p))] + ["漢字 и mixed text", "İstanbul ﬁ ẞ", "a" * 5000, "", " \n", "x\x1cy"]
    assert own.counts(texts) == [len(e.ids) for e in full.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proven():
    full, whole = Tokenizer.from_file(WORD_BPE), whole_tokens(WORD_BPE)
    assert len(whole) > 10_000
    assert all(len(full.encode(t, add_special_tokens=False).ids) == 1 for t in whole[::50])


def test_count_tokens(spark):
    rows, full = odd_rows(), Tokenizer.from_file(WORD_BPE)
    want = collections.Counter()
    for i, t, _ in rows:
        n = len(full.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 2048)] += 1
    docs = documents(spark, rows)
    assert collections.Counter(map(tuple, count_tokens(docs, WORD_BPE).collect())) == want
    assert count_tokens(docs.limit(0), WORD_BPE).count() == 0


def check_packing(pieces, texts, window=1024):
    full = Tokenizer.from_file(BYTE_BPE)
    ids = {i: np.array(full.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in texts}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[i])
            assert p.ids_crc32 == zlib.crc32(ids[i][at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids[i])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or k == len(by_sequence) - 1
    return by_sequence


def test_pack(spark):
    rows = [r for k, r in enumerate(odd_rows()) if r[0] is not None and r != odd_rows()[k - 1]]
    rows += [(1000 + i, f"text {i} " * (i % 90), f"s{i % 3}") for i in range(300)]
    docs = documents(spark, rows).repartition(6)
    sequences = check_packing(pack(docs, BYTE_BPE).collect(), [(i, t) for i, t, _ in rows])
    # Full windows hold the large sources in the proportions of all tokens, to within a quantum and what small ones take.
    source = {i: s for i, _, s in rows}
    totals = collections.Counter()
    for own in sequences.values():
        for p in own:
            totals[source[p.doc_id]] += p.length
    everything = sum(totals.values())
    for own in list(sequences.values())[:-1]:
        for s in ("s0", "s1", "s2", "a"):
            held = sum(p.length for p in own if source[p.doc_id] == s)
            assert abs(held - 1024 * totals[s] / everything) <= 2 * 128


def test_pack_repeats_and_empty(spark):
    docs = documents(spark, [(1, "same text", "a"), (1, "same text", "a"), (None, None, None)])
    pieces = pack(docs, BYTE_BPE).collect()
    assert sorted((p.doc_id or 0, p.doc_tokens) for p in pieces) == [(0, 1), (1, 3), (1, 3)]
    assert pack(docs.limit(0), BYTE_BPE).count() == 0


def test_places_with_huge_queues():
    """Beyond 63 bits the places are still a permutation locally: neighbours of one queue keep their order and distance."""
    tokens = [10**15, 3 * 10**15 + 7]
    starts = np.array([5 * 10**14])
    doc, start, length, sequence, offset = cut_documents(starts, np.array([100_000]), 0, tokens, 128, 1024)
    place = sequence * 1024 + offset
    assert length.sum() == 100_000 and (np.diff(place) > 0).all()
    assert abs((place[-1] - place[0]) / 400_000 - 1) < 0.01


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("digest", T.StringType()), T.StructField("id", T.StringType()), T.StructField("first", T.StringType())])


def pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n" * 50_000
    rows = [
        (5, "http://a/", "x" * 100), (3, "http://b/ c\r\nd", "x" * 100), (9, None, "x" * 100), (4, "http://c/", "x" * 99), (6, "http://c/", "x" * 99),
        (1, "http://e/", None), (2, "http://e/", ""), (7, "http://l/", long), (8, "http://l/", long), (8, "http://l/", long),
        (10, "http://t/", "é" * 50), (11, "http://t/", "é" * 50), (None, "http://n/", "y" * 200), (12, "http://n/", "y" * 200), (None, "http://n/", "z" * 200),
    ]
    return spark.createDataFrame([(*r, "d", "i", "f") for r in rows], PAGES)


def test_round_trip(spark):
    table = pages(spark)
    rows = [(r.page_id, (r.html or "").encode()) for r in table.collect()]
    least = collections.defaultdict(lambda: float("inf"))
    for i, p in rows:
        least[p] = min(least[p], float("inf") if i is None else i)
    want = collections.Counter()
    for i, p in rows:
        revisit = len(p) >= 100 and least[p] < float("inf") and i != least[p]
        want[(i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", least[p] if revisit else None)] += 1
    assert collections.Counter(map(tuple, archive_round_trip(table, chunk=1000).collect())) == want
    assert archive_round_trip(table.limit(0)).count() == 0


def test_archives_are_warc(spark, tmp_path):
    """Archives hold one gzip member per record, and chunk rows put the payloads together again."""
    records = classified(pages(spark), "page_id", "url", "html", 100)
    chunks = record_chunks(records, 1000)
    assert chunks.selectExpr("max(length(data)) AS m").first().m == 1000
    manifest = write_archives(records, f"file://{tmp_path}/warc", 1000)
    members = 0
    for path in (tmp_path / "warc").iterdir():
        raw = gzip.decompress(path.read_bytes())
        members += path.read_bytes().count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00")
        assert raw == b"" or raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
    assert members >= 15
    rows = read_archives(manifest, 1000).collect()
    payloads = collections.defaultdict(dict)
    for r in rows:
        payloads[(r.page_id, r.record_type, r.stated_digest)][r.chunk_no] = r.data
        assert len(r.data) <= 1000 and r.last == (r.bytes_so_far == (r.stated_bytes if r.record_type == "response" else 0))
    for (_, kind, digest), parts in payloads.items():
        if kind == "response":
            assert hashlib.sha256(b"".join(parts[k] for k in sorted(parts))).hexdigest() == digest
