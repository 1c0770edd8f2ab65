"""Conversation repair: the whole query against a plain-Python version that searches edits by Dijkstra."""

import hashlib
import heapq
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.llm import queries
from tally.llm.dialogue import SuffixAutomaton, damaged, repair_conversations, repairs
from tests.llm.brute import rows_of

SF = "/root/testdata/sf0.01"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def least_audit(rows):
    """(cost, audit, output) by uniform-cost search over all edit sequences; rows: (initial, gone, truncated)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        state = out[:1] + out[-1:]
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and GRAMMAR.match(out):
            return cost, audit, out
        steps = [(2, "I", at, r) for r in "ua"]
        if at < len(rows):
            initial, gone, cut = rows[at]
            steps.append((3, "D", at + 1, ""))
            if not gone:
                steps += [(cut, "K", at + 1, initial or "-")] + [(2 + cut, "R", at + 1, r) for r in "ua"]
        for c, edit, to, made in steps:
            new = out + made
            if any(GRAMMAR.match(new + tail) for tail in ("", "a", "ua")):
                heapq.heappush(heap, (cost + c, audit + edit, to, new))


def brute(rows, damage=True):
    """Result rows of (conv_id, turn, role, text); ties of a turn by role and the text's digest."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20 if damage else 19
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        own += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, kinds, blank, duplicate, truncated = set(), [], 0, 0, 0
        for _, role, text in own:
            visible = VISIBLE.findall(text)
            b, d = not visible, (role, text) in seen
            cut = not b and not d and visible[-1] not in ".!?"
            seen.add((role, text))
            blank, duplicate, truncated = blank + b, duplicate + (d and not b), truncated + cut
            kinds.append((role[:1], b or d, int(cut)))
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in itertools.pairwise(kinds))
        cost, audit, output = least_audit(kinds)
        lines, at, made = [], 0, 0
        for edit in audit:
            if edit == "I":
                lines.append({"u": "user", "a": "assistant"}[output[made]] + ":")
            elif edit != "D":
                lines.append((own[at][1] if edit == "K" else {"u": "user", "a": "assistant"}[output[made]]) + ":" + own[at][2])
            made += edit != "D"
            at += edit != "I"
        out.append(dict(conv_id=conv, gaps=max(turns) - min(turns) + 1 - len(turns) if turns else 0, blank=blank, duplicate=duplicate,
                        truncated=truncated, illegal=illegal, cost=cost, audit=audit,
                        repaired_sha256=hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted((tuple(r[c] for c in sorted(r)) for r in out), key=repr)


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op12_conversation_repair(spark, SF)) == brute(rows)


def edge_rows():
    texts = ["Yes.", "No!", "", None, " \t\n", "cut off", "Yes. \n", "a\x0b", "?", "été", "\x1f", "x.\x85"]
    roles = ["user", "assistant", "system", None, "", "User", "tool", "ass", "s"]
    rows, at = [], 0
    for conv in [*range(60), None]:
        for turn in range((at * 7) % 9):
            at += 1
            rows.append((conv, None if at % 11 == 0 else turn // (1 + at % 2) * (1 + at % 3), roles[at * at % len(roles) if at % 3 else 0], texts[at * 5 % len(texts)]))
        at += 1
    return rows + rows[5:25] + [(100, 2**40, "user", "Hi."), (100, 1, "user", "Hi."), (101, None, "system", "x")] * 2


def test_edges(spark, tables):
    """Nulls anywhere, ties of turns, repeated rows, odd roles, rows all dropped, extra columns of clashing names."""
    rows = edge_rows() + [(c, t, "user", "Gone.") for c in range(200, 400) for t in (1,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"hit": F.lit("x"), "copy": F.lit(7), "signature": F.lit("y"), "dropped": F.lit(True), "digest": F.lit("z")})
    want = brute(rows)
    assert rows_of(queries.op12_conversation_repair(spark, tables(conversations=df.repartition(6)))) == want
    assert any(w[0] == "" and w[2] >= 200 for w in want)  # audit and id of a conversation that lost all its rows
    assert queries.op12_conversation_repair(spark, tables(conversations=df.where("false"))).count() == 0


def test_long_and_repeated(spark):
    """One conversation of a third of all rows, one row repeated thousands of times, and many equal conversations."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(6000)]
    rows += [(2, 5, "user", "Same.")] * 4000
    rows += [(c, i, r, "Hello.") for c in range(10, 2010) for i, r in enumerate(["user", "assistant"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("dropped", F.lit(False))
    got = {r["conv_id"]: r for r in repair_conversations(df.repartition(8)).collect()}
    assert len(got) == 2002 and got[1]["cost"] == 0 and got[1]["audit"] == "K" * 6000
    assert got[1]["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows[:6000]).encode()).hexdigest()
    assert got[2]["duplicate"] == 3999 and got[2]["cost"] == 3 * 3999 + 2
    assert got[2]["audit"] == "K" + "D" * 3999 + "I"
    assert {(got[c]["audit"], got[c]["cost"]) for c in range(10, 2010)} == {("KK", 0)}


LETTER = {"d": ("u", True, 0), **{r: (r, False, 0) for r in "suax"}, **{r.upper(): (r, False, 1) for r in "suax"}}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("suaxdSUAX", max_size=6), max_size=5))
def test_automaton_against_search(words):
    automaton = SuffixAutomaton()
    for word in sorted(set(words), key=lambda w: w[::-1]):
        cost, audit, _ = least_audit([LETTER[c] for c in word])
        assert automaton.take(word) == (cost, audit), word


def test_endings_are_computed_once(spark):
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("sua", repeat=n)]
    automaton = SuffixAutomaton()
    for w in sorted(words, key=lambda w: w[::-1]):
        automaton.take(w)
    assert automaton.made == len({w[i:] for w in words for i in range(len(w))})
    got = repairs(spark.createDataFrame([(w,) for w in words], "signature string"))
    assert {(r["signature"], r["cost"], r["audit"]) for r in got.collect()} == {(w, *least_audit([LETTER[c] for c in w])[:2]) for w in words}


@pytest.mark.parametrize("name", ["conv_id long", "conv_id string"])
def test_ids_of_any_type(spark, name):
    df = spark.createDataFrame([(1 if "long" in name else "a", 0, "user", "Hi.")], f"{name}, turn int, role string, text string")
    assert repair_conversations(damaged(df)).count() == 1
