"""Conversation repair against a search over all edit sequences and against DuckDB."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from pyspark.sql import types as T
from tidewake.llm import conversation_repair as repair
from tidewake.llm import role_grammar as grammar
from tidewake.llm.queries import ORACLES, QUERIES

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("conv", T.StringType()), T.StructField("at", T.StringType()), T.StructField("key", T.StringType()), T.StructField("copy", T.StringType()),
])
LEGAL = re.compile("(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def table(spark, rows):
    """Rows of (conv_id, turn, role, text), with extra columns of clashing names."""
    return spark.createDataFrame([(*r, "c", "a", "k", "x") for r in rows], ROWS)


def cheapest(rows):
    """(cost, audit) of the best edits for rows of (initial, status), trying all that cost no more than deleting every row."""
    best = [(3 * len(rows), "D" * len(rows))]

    def search(i, cost, audit, made):
        if (cost, audit) > best[0] and cost >= best[0][0]:
            return
        if i == len(rows) and LEGAL.fullmatch(made):
            best[0] = min(best[0], (cost, audit))
        for c in "ua":
            search(i, cost + 2, audit + "I", made + c)
        if i < len(rows):
            initial, status = rows[i]
            search(i + 1, cost + 3, audit + "D", made)
            if status < 2:
                search(i + 1, cost + (status == 1), audit + "K", made + initial)
                for c in "ua":
                    search(i + 1, cost + 2 + (status == 1), audit + "R", made + c)

    search(0, 0, "", "")
    return best[0]


def plain_repair(rows):
    """Report of one conversation's rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append(2 if not body else 3 if (role, text) in seen else 0 if body[-1] in ".!?" else 1)
        seen.add((role, text))
    initials = [role[:1] if role[:1] in ("s", "u", "a") else "?" for _, role, _ in rows]
    cost, audit = cheapest(list(zip(initials, faults)))
    made, i, opened = [], 0, "u"
    for edit in audit:
        if edit in "IR":
            role, text = NAMES[opened], rows[i][2] if edit == "R" else ""
        elif edit == "K":
            role, text = rows[i][1:]
        if edit != "D":
            made.append(f"{role}:{text}")
            opened = "a" if role[0] == "u" else "u"
        i += edit != "I"
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, *(faults.count(k) for k in (2, 3, 1)), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())


def random_rows(rng, n):
    return [(rng.choice("suua?a"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_cheapest_repair_and_least_audit():
    rng = random.Random(1)
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(6))
        edits, tail = grammar.edits(grammar.START, None, rows)
        audit = "".join(grammar.audit(e) for e in edits) + grammar.audit(tail)
        cost = sum(grammar.cost(e, s) for e, (_, s) in zip(edits, rows)) + grammar.cost(tail, 0)
        assert (cost, audit) == cheapest(rows), rows


def test_parts_chain_to_the_whole():
    """Cut at any places and chained in any grouping, the edits are those of the whole."""
    rng = random.Random(2)
    for _ in range(60):
        rows = random_rows(rng, 40)
        whole = grammar.edits(grammar.START, None, rows)
        cuts = sorted({0, 40, *rng.sample(range(1, 40), 5)})
        parts = [rows[a:b] for a, b in itertools.pairwise(cuts)]
        ways = [grammar.ways(p) for p in parts]
        pairs = [grammar.joined(ways[k:k + 2]) for k in range(0, len(ways), 2)]
        got, tail = [], ()
        for (start, end), k in zip(grammar.borders(grammar.START, None, pairs), range(0, len(ways), 2)):
            for (a, b), part in zip(grammar.borders(start, end, ways[k:k + 2]), parts[k:k + 2]):
                own, tail = grammar.edits(a, b, part)
                got += own
        assert (got, tail) == whole


def test_frontier_stays_small():
    rng = random.Random(3)
    grammar.step.cache_clear()
    frontier, _, moves = grammar.parsed(grammar.START, random_rows(rng, 5000))
    assert len(grammar.STACKS) == 8 and len(frontier) <= 8 and len(moves) == 5000
    assert grammar.step.cache_info().currsize < 500  # each kind of step is worked out once


SOME = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."),
    (2, 0, "assistant", "First?"), (2, 5, "user", "cut off"), (2, 7, "user", "Again."), (2, None, "tool", "odd."),
    (3, 0, None, None), (3, 1, "user", ""), (None, 0, "user", "No id."), (None, None, "assistant", "Nor turn."), (None, None, "assistant", "Nor turn."),
    (4, 4, "user", "same."), (4, 4, "user", "same."), (4, 9, "user", "same."), (5, None, "", "x" * 50000 + "."), (5, None, None, " \t\n"),
    (6, 0, "user", "long " * 20000 + "."), (6, 0, "assistant", "ends."), (6, 1, "sage", "é?"),
]


def plain_reports(rows):
    """By conversation; rows of one turn differ in role or are equal here, so digests don't decide."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        out[conv] = plain_repair(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def reports(df):
    return {r[0]: tuple(r)[1:] for r in df.select(COLUMNS).collect()}


def test_odd_rows(spark):
    assert reports(repair.repair_conversations(table(spark, SOME))) == plain_reports(SOME)


def test_empty_table_and_names_without_rows(spark):
    nothing = table(spark, [])
    assert repair.repair_conversations(nothing).collect() == []
    found = reports(repair.repair_conversations(nothing, named=table(spark, SOME[:1])))
    assert found == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_long_conversation_in_runs(spark, monkeypatch):
    """One conversation with most rows is cut into many runs, chained over several levels."""
    rng = random.Random(4)
    rows = [(7, i // 2 * 3, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["One.", "two", "", f"own {i}."])) for i in range(120)] + SOME
    rows = list(dict.fromkeys(rows))
    kept = [r for k, r in enumerate(rows) if not any(r[:3] == q[:3] for q in rows[:k])]  # no ties of turn and role
    expected = reports(repair.repair_conversations(table(spark, kept)))
    monkeypatch.setattr(repair, "RUN", 4)
    monkeypatch.setattr(repair, "FAN", 2)
    assert reports(repair.repair_conversations(table(spark, kept))) == expected


def test_repaired_rows_follow_the_grammar(spark):
    found = repair.repaired_rows(table(spark, SOME)).orderBy("conv", "at", "sub").collect()
    for conv, rows in itertools.groupby(found, key=lambda r: r.conv):
        assert LEGAL.fullmatch("".join(r.role[0] for r in rows if r.edit != "D")), conv


@pytest.mark.parametrize("draw", range(5))
def test_damage(spark, draw):
    chosen = next(i for i in range(1000) if zlib.crc32(f"{i}: ".encode()) % 20 == draw)
    found = [(r.role, r.text) for r in repair.damaged(table(spark, [(chosen, None, "assistant", "A. b! c?")])).collect()]
    own = ("assistant", "A. b! c?")
    assert found == [[], [("assistant", "")], [("assistant", "A b c")], [own, own], [("user", own[1])]][draw]


def test_query_by_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    expected = con.execute(ORACLES["op13_conversation_repair"]).df()
    found = QUERIES["op13_conversation_repair"](spark, sf).toPandas()[list(expected.columns)]
    rows = [sorted(map(tuple, x.values.tolist())) for x in (found, expected)]
    assert rows[0] == rows[1] and len(rows[0]) > 10
