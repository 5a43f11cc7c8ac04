"""Repair of conversations, against a dynamic programme over plain strings and all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarlens.llm import conversations as c
from bazaarlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
GRAMMAR = re.compile("(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """The first fault of each row of a conversation."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows):
    """Cost, audit and rows of the cheapest repair; plain strings in every cell."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(cells):
        for _ in range(3):
            for state, (cost, audit, out) in list(cells.items()):
                for x in "ua":
                    if (state, x) in step:
                        put(cells, step[state, x], cost + 5, audit + "I", (*out, f"{name[x]}:"))
        return cells

    def put(cells, state, *value):
        if state not in cells or value < cells[state]:
            cells[state] = value

    cells = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults(rows)):
        following = {}
        for state, (cost, audit, out) in inserted(cells).items():
            put(following, state, cost + 2, audit + "D", out)
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in step:
                    put(following, step[state, role[:1]], cost + more, audit + "K", (*out, f"{role}:{text}"))
                for x in "ua":
                    if (state, x) in step:
                        put(following, step[state, x], cost + more + 1, audit + "R", (*out, f"{name[x]}:{text}"))
        cells = following
    return min(v for s, v in inserted(cells).items() if s in ("", "a"))


def brute(rows):
    """The result columns of one conversation's rows, which are in order."""
    found, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    cost, audit, out = best(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(found.count(x) for x in ("blank", "duplicate", "truncated")),
        illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_strings_against_all_edits():
    """The plain programme itself: no sequence of edits is cheaper, or as cheap and smaller."""
    dice = random.Random(3)
    for _ in range(150):
        rows = [(i, dice.choice(["user", "assistant", "system", "tool", ""]), dice.choice(["a.", "b", " ", "c!"])) for i in range(dice.randint(0, 3))]
        found = faults(rows)
        ways = []
        for edits in itertools.product("KRD", repeat=len(rows)):
            for places in itertools.product(range(3), repeat=len(rows) + 1):
                audit = "".join("I" * n + e for n, e in zip(places, [*edits, ""]))
                cost = 5 * sum(places) + sum({"K": 0, "R": 1, "D": 2}[e] + 5 * (e != "D" and f == "truncated") for e, f in zip(edits, found))
                if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, found)):
                    continue
                roles = []
                at = 0
                for e in audit:
                    role = "ua" if e in "IR" else rows[at][1][:1] or "-"
                    at += e != "I"
                    if e != "D":
                        roles.append(role)
                if any(GRAMMAR.fullmatch("".join(x)) for x in itertools.product(*roles)):
                    ways.append((cost, audit))
        assert min(ways) == best(rows)[:2], rows


def damaged(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        kept = out[conv_id]
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        what = zlib.crc32(f"{show(conv_id)}:{show(turn)}".encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    return out


def test_the_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {k: brute(ordered(v)) for k, v in damaged(rows).items()}
    got = QUERIES["op11_conversation_repair"](spark, SMALL).collect()
    assert {r["conv_id"]: tuple(r[x] for x in NAMES[1:]) for r in got} == want and len(got) == len(want)


def test_nulls_ties_and_copies_of_the_query(spark, tmp_path):
    dice = random.Random(8)
    rows = []
    for i in range(400):
        conv_id = dice.choice([None, *range(40)])
        text = dice.choice([None, "", " ", "\t\n", "yes.", "no", "why?", "it is so.  ", "one. two", "é!", "."])
        rows.append((conv_id, dice.choice([None, 0, 1, 2, 3, 5, 9, -2]), dice.choice([None, "", "user", "assistant", "system", "tool", "unknown"]), text, "own cost", 7))
    schema = "conv_id long, turn long, role string, text string, cost string, part int"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    want = sorted(((k, *brute(ordered(v))) for k, v in damaged([r[:4] for r in rows]).items()), key=repr)
    got = [tuple(r[x] for x in NAMES) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == want


def test_an_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.repaired(turns).count() == 0


@pytest.mark.parametrize("rows", [1, 3, 512])
def test_a_hot_conversation_is_cut_into_chunks(spark, rows):
    dice = random.Random(rows)
    made = [(7, i // 2, dice.choice(["user", "assistant", "system", "tool"]), dice.choice(["a.", "b", "c!", "", f"{i}.", f"{i}"])) for i in range(1500)]
    made += [(i, t, r, x) for i in range(20) if i != 7 for t, r, x in [(0, "user", "hi."), (1, "assistant", f"no{i}")]]
    made += [(3, 5, "user", "again and again")] * 700  # equal rows are one until the chunks
    turns = spark.createDataFrame(made, "conv_id long, turn long, role string, text string").repartition(6)
    by = defaultdict(list)
    for k, *row in made:
        by[k].append(tuple(row))
    want = {k: brute(ordered(v)) for k, v in by.items()}
    got = c.repaired(turns, rows=rows).collect()
    assert {r["conv_id"]: tuple(r[x] for x in NAMES[1:]) for r in got} == want and len(got) == 20


def test_a_very_long_text(spark):
    long = "word " * 500_000
    made = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (2, 0, "user", "a.")]
    got = {r["conv_id"]: r for r in c.repaired(spark.createDataFrame(made, "conv_id long, turn long, role string, text string")).collect()}
    assert tuple(got[1][x] for x in NAMES[1:]) == brute([x[1:] for x in made[:2]])


ROW = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["k", "t", "b"]))


@given(st.lists(ROW, max_size=14), st.integers(1, 5), st.sampled_from([c._MODULUS, 2, 7]))
@settings(max_examples=300, deadline=None)
def test_chunks_put_together_and_collisions(found, size, modulus):
    """Small moduli make hashes lie; the audits must not."""
    rows = [(i, role, {"k": f"{i}.", "t": f"{i}", "b": " "}[kind]) for i, (role, kind) in enumerate(found)]
    chunks = [rows[i : i + size] for i in range(0, len(rows), size)] or [[]]
    told = [[(*c.MUST_GO, False) if x == "b" else (role, text, x == "t") for (_, role, text), (_, x) in zip(rows[i * size :], found[i * size : (i + 1) * size])] for i in range(len(chunks))]
    own = c.Audits.__init__.__defaults__
    c.Audits.__init__.__defaults__ = (modulus,)
    try:
        tables, audits = zip(*(c.solved(x) for x in told))
    finally:
        c.Audits.__init__.__defaults__ = own
    whole = tables[0]
    for table in tables[1:]:
        whole, _ = c.joined(whole, table)
    last = c.ending(whole)
    states = c.way(list(tables), 0, last)
    audit = "".join(x[4 * a + b] for x, (a, b) in zip(audits, states)) + "I" * c._CLOSING[last]
    assert (whole[0][last] + 5 * c._CLOSING[last], audit) == best(rows)[:2]


@given(st.lists(st.text(st.sampled_from("DK"), max_size=20), min_size=2, max_size=6), st.sampled_from([c._MODULUS, 3]))
@settings(max_examples=300, deadline=None)
def test_audits_compare_as_their_strings(texts, modulus):
    audits, nodes = c.Audits(modulus), []
    for text in texts:
        node, common = 0, 0
        for other, known in zip(texts, nodes):  # share what some earlier audit has
            n = len(next(iter(re.findall("^" + "".join(f"(?:{x}" for x in text) + ")?" * len(text), other)), ""))
            if n > common:
                node, common = audits._lifted(known, n), n
        for letter in text[common:]:
            node = audits.child(node, letter)
        nodes.append(node)
    for (a, x), (b, y) in itertools.product(zip(texts, nodes), repeat=2):
        assert audits.text(x) == a
        assert (audits.compared(x, y) > 0) - (audits.compared(x, y) < 0) == (a > b) - (a < b)
