import collections
import math
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import documents, odd_rows, words
from tidewake.llm import language_id, quality, toxicity
from tidewake.llm.queries import ORACLES, QUERIES


def test_viterbi_is_best():
    rng = np.random.default_rng(1)
    for penalty in (0.0, 1.5, 100.0):
        lengths = [0, 1, 5, 6, 3]
        texts = np.repeat(np.arange(5), lengths)
        scores = rng.normal(size=(len(texts), 3))
        labels = language_id.viterbi(scores, texts, 5, penalty)
        for d, n in enumerate(lengths):
            own, got = scores[texts == d], labels[texts == d]

            def value(path):
                return sum(own[k, x] for k, x in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))

            paths = [[]]
            for _ in range(n):
                paths = [p + [x] for p in paths for x in range(3)]
            assert math.isclose(value(list(got)), max(value(p) for p in paths))


def test_language_spans(spark):
    rng = random.Random(2)
    syllables = {"aa": ["ka", "ro", "tin", "mel"], "bb": ["shu", "gle", "wor", "nik"], "cc": ["жо", "ти", "мра", "лек"]}

    def say(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(n))

    train = [(i, say(lang, 80), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)] + [(900, say("aa", 5), None), (901, None, "bb")]
    docs = spark.createDataFrame(train, "doc_id bigint, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == ["aa", "bb", "cc"]
    mixed = say("aa", 30) + " 123 -- " + say("bb", 40) + "\n" + say("cc", 20)
    out = {r.doc_id: r for r in language_id.label_spans(documents(spark, [(1, mixed, "s"), *[(i + 10 if i else i, t, s) for i, t, s in odd_rows()]]), model).collect()}
    assert out[1].lang_pred == "bb" and [s.lang for s in out[1].spans] == ["aa", "bb", "cc"]
    assert sum(s.words for s in out[1].spans) == 92 and abs(out[1].spans[1]["first"] - 31) <= 2
    for i in (14, 15, 16):
        assert out[i].lang_pred == "und" and out[i].score == 0 and out[i].spans == []
    # A script that only one language uses decides alone.
    assert language_id.label_spans(documents(spark, [(1, "ффф", "s")]), model).first().lang_pred == "cc"
    nothing = language_id.train(docs.limit(0))
    assert language_id.label_spans(documents(spark, [(1, "word", "s")]), nothing).first().lang_pred == "und"
    assert language_id.label_spans(docs.limit(0), model).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = language_id.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def toxic_rows(n=1500):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(n):
        ws = [rng.choice(vocabulary) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            ws[rng.randrange(40)] = rng.choice(["vileword", "nastyterm"])
        # A group's name goes along with toxic texts most of the time, but not always.
        if toxic and rng.random() < 0.8 or rng.random() < 0.04:
            ws[rng.randrange(40)] = "muslims"
        rows.append((i, " ".join(ws), "s", int(toxic)))
    return rows


def test_toxicity(spark):
    rows = toxic_rows()
    docs = documents(spark, [r[:3] for r in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in rows] + [(5, 1, None), (10**6, 1, 1)], "doc_id bigint, quality int, toxic int")
    weights = toxicity.train(docs, labels.where("doc_id % 3 <> 1"))
    weights.cache()
    clean = "abc def " * 10
    odd = documents(spark, odd_rows() + [(500, clean + "muslims", "s"), (501, clean + "vileword", "s"), (502, clean, "s")])
    out = collections.defaultdict(list)
    for r in toxicity.score_texts(odd, weights).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        out[r.doc_id].append(r)
    assert len(sum(out.values(), [])) == len(odd_rows()) + 3
    assert out[501][0].predicted == 1 and out[500][0].predicted == 0 and out[502][0].score < 0.3
    truth = {i: y for i, _, _, y in rows}
    held = [r for r in toxicity.score_texts(docs, weights).collect() if r.doc_id % 3 == 1]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_swaps_take_weight_from_names():
    """With the penalty the name of a group carries less weight than without it."""
    rows, table = toxic_rows(600), language_id.script_table()
    features = [np.unique(toxicity.features([t], table)[1]) for _, t, _, _ in rows]
    labels = np.array([r[3] for r in rows])
    changes = [c for _, t, _, _ in rows for c in toxicity._swap_changes([t], table, toxicity.IDENTITY_TERMS)]
    assert changes
    name = set(toxicity.features(["muslims"], table)[1].tolist())

    def carried(swaps):
        buckets, weights, _ = toxicity.fit_logistic(features, labels, swaps)
        return sum(w for b, w in zip(buckets.tolist(), weights) if b in name)

    assert carried(changes) < 0.5 * carried([])


def test_no_labels(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.predict_held_out(docs, none).count() == len(odd_rows())


def brute_figures(text):
    ws = words(text)
    windows = collections.Counter(tuple(ws[k:k + 5]) for k in range(len(ws) - 4))
    covered = {k + j for k in range(len(ws) - 4) if windows[tuple(ws[k:k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def quality_rows():
    rows = odd_rows()
    for i in range(40):
        rows.append((1000 + i, f"Common line of the Host 12\nown words {'abcdefgh'[i % 8] * (i + 1)} of a document that has a few more of them", "h"))
        rows.append((2000 + i, "common   line of the host 93", "h"))
        rows.append((3000 + i, "Common line of the host 55\n" + "common line of the host 19\n" * 3 + "last own words", "h"))
        rows.append((4000, "a copied document with one line that is long enough to pass", "h"))
    return rows


def test_quality(spark):
    rows = quality_rows()
    out = quality.quality(documents(spark, rows)).collect()
    want = collections.Counter()
    for i, t, _ in rows:
        figures = brute_figures(t)
        want[(i, *figures, figures[0] < 10 or 100 * figures[4] > 20 * figures[0])] += 1
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == want
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[1000 + i] for i in range(40)) and kept[4000]
    # Base rules aside, documents made of the host's line alone are depleted.
    loose = {r.doc_id: r.kept for r in quality.quality(documents(spark, rows), min_words=1, max_repeat_percent=100).collect()}
    assert not any(loose[2000 + i] or loose[3000 + i] for i in range(40)) and loose[1000] and loose[4000]


@pytest.mark.parametrize("rows", [odd_rows, quality_rows])
def test_quality_oracle(spark, rows):
    docs = documents(spark, rows())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    relation = con.sql(quality.QUERY_SQL)
    out = quality.quality(docs).select(*relation.columns).collect()
    assert collections.Counter(map(tuple, out)) == collections.Counter(relation.fetchall())


def test_quality_rows_that_stay(spark):
    docs = documents(spark, quality_rows())
    out = quality.drop_low_quality(docs)
    assert out.columns == docs.columns
    assert out.count() == quality.quality(docs).where("kept").count()
    assert quality.quality(docs.limit(0)).count() == 0


def thin_rows(shared=8, own=1, pages=60, host="thin"):
    """Pages of a host that share lines of six words and have few lines of three words of their own."""
    common = [" ".join(f"{host}{'abcdefghij'[k]}{x}" for x in "uvwxyz") for k in range(shared)]
    return [
        (5000 + i, "\n".join(common + [" ".join("klm"[k] * (i + 1) + x for x in "uvw") for k in range(own)]), host) for i in range(pages)
    ]


@pytest.mark.parametrize("shared, own", [(8, 1), (10, 1), (8, 2)])
def test_thin_pages_are_depleted(spark, shared, own):
    """Every distinct document counts, also where pages share nearly all of their lines."""
    pages = documents(spark, thin_rows(shared, own))
    out = quality.quality(pages).collect()
    assert len(out) == 60 and all(not r.base_failed and r.n_line_words == 6 * shared and not r.kept for r in out)
    assert quality.drop_low_quality(pages).count() == 0
    # Twenty distinct documents, each in two spellings, are not more than twenty.
    few = thin_rows(shared, own, 20, "few")
    few += [(i + 1000, t.replace(" ", "  ").upper(), s) for i, t, s in few]
    assert all(r.kept and r.n_line_words == 0 for r in quality.quality(documents(spark, few)).collect())


def test_query_depletes_thin_pages(spark, tmp_path):
    """The registered query itself: 400 pages of eight shared lines and one of their own lose those lines and are rejected; its SQL agrees."""
    docs = documents(spark, thin_rows(pages=400) + thin_rows(10, 2, 400, "wide") + odd_rows())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op9_quality"](spark, str(tmp_path))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    relation = con.sql(ORACLES["op9_quality"])
    rows = out.select(*relation.columns).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(relation.fetchall())
    found = [r for r in rows if (r.doc_id or 0) >= 5000]
    assert len(found) == 800 and not any(r.kept for r in found) and {r.n_line_words for r in found} == {48, 60}


def own_line(i, n):
    """Different words, also with all digits alike."""
    return " ".join("abcdefghijklmnopqrstuvwxyzäöüßéñ"[i] + "no"[k % 2] * (k + 1) for k in range(n))


def test_cleaned_texts(spark):
    """Lines above the limit go wherever they stand, repeated rows included; all else stays as it is."""
    shared = "a line that\tall pages of the host share"
    rows, want = odd_rows(), {}
    for i in range(30):
        body = own_line(i, 120)
        parts = [["", body, "  ", shared.upper(), body[::-1], ""], [shared, body], [body, shared, " " + shared], [body]][i % 4]
        want[7000 + i] = "\n".join(x for x in parts if " ".join(x.lower().split()) != " ".join(shared.split()))
        rows += [(7000 + i, "\n".join(parts), "h")] * (1 + i % 2)
    docs = documents(spark, rows)
    out = quality.clean_documents(docs, size_col="n_chars")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert collections.Counter(r.doc_id for r in rows if (r.doc_id or 0) >= 7000) == {i: 1 + i % 2 for i in want}
    assert all(r.text == want[r.doc_id] and r.n_chars == len(r.text) for r in rows if (r.doc_id or 0) >= 7000)
    # Other rows are those that the rules keep, untouched; so is everything else of a row.
    def rest(frame):
        return collections.Counter(map(tuple, frame.where("doc_id is null or doc_id < 7000").collect()))
    assert rest(out) == rest(quality.drop_low_quality(docs))
    assert all(tuple(r)[5:] == ("t", "i", "s", "k", "b", "r", "x") for r in rows)
    assert quality.clean_documents(docs.limit(0)).count() == 0


def test_pipeline_removes_lines(spark):
    rows = [(i, "the common line of all pages here\n" + own_line(i, 30), "h") for i in range(25)]
    out = corpus_pipeline.STAGES[0][1](spark, documents(spark, rows), SMALL).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in out} == {i: (t.split("\n")[1], len(t.split("\n")[1])) for i, t, _ in rows}
