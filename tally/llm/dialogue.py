"""Repair of conversation structure over a suffix-shared automaton of signatures.

A conversation's rows become a signature: one letter a row for its role and its
fault. All distinct signatures, read from their ends, form an acyclic word
graph in which equal endings are one node: sorted by the reversed signature,
neighbours share their longest common ending, and only the nodes beyond it are
new. Of each node and grammar state, the cost to go and the best edit are
computed once, whichever and however many conversations end that way; the best
audit of a signature is read off by following the edits.

Texts never meet in one row. The rows of a conversation, sorted, pass through a
task one after the other: once to write the signature, once, after its audit,
to digest the repaired text. (A digest runs over a whole conversation in order,
so a conversation is one task's work, in the memory of a batch and of its
signature, a byte a row.)
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import ship_package, written

#: A visible character; a last one that doesn't end a sentence.
_VISIBLE = r"[^\x20\x09-\x0D]"
_CUT_OFF = r"(?s)[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"

# Letters of a signature: the role's initial for a whole row, its capital for a truncated one, one letter for what must go.
OTHER, GONE = "x", "d"
ROLES = "sua"

# Grammar states of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT_KEPT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
NEXT_MADE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)   # by an inserted or rerolled row
MADE_ROLE = ("user", "user", "assistant", "user")
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 60
CHUNK = 2000   # conversations in a batch of results


# --- damage ------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` with faults put in by ``crc32("conv_id:turn") % 20``.

    0 drops the row (it stays here, marked), 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 makes its role ``user``. Nulls of role and text,
    and in that key, are one space; ``conv_id`` and ``turn`` stay as they are.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("hit") == 0).alias("dropped"), copies).drop("copy")


# --- the automaton -----------------------------------------------------------


def _end_node() -> list[tuple[int, str, int]]:
    """Of each state at the end: (cost to go, edit, next state). An empty edit ends the audit."""
    to_a = (INSERT, "I", AFTER_A)
    return [(0, "", START), (2 * INSERT, "I", AFTER_U), to_a, (0, "", AFTER_A)]


def node_of(letter: str, below: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The node whose ending begins with ``letter`` and goes on at ``below``.

    Of each state, the cheapest way to an accepted end, ties by the least
    letter of the edit: D, I, K, R. An edit leads to one state only, so the
    least first letter gives the least audit.
    """
    low = letter.lower()
    extra = TRUNCATED if letter.isupper() else 0
    rows = []
    for state in range(4):
        keep = NEXT_KEPT[state].get(low) if letter != GONE else None
        rows.append({"D": DELETE + below[state][0],
                     "K": extra + below[keep][0] if keep is not None else NEVER,
                     "R": REROLE + extra + below[NEXT_MADE[state]][0] if letter != GONE else NEVER})
    # Inserts stay at this row: a third in a row would only come back to a state passed already.
    cost = [min(r.values()) for r in rows]
    for _ in range(2):
        cost = [min(min(rows[s].values()), INSERT + cost[NEXT_MADE[s]]) for s in range(4)]
    out = []
    for state, r in enumerate(rows):
        r["I"] = INSERT + cost[NEXT_MADE[state]]
        edit = min(e for e in r if r[e] == cost[state])
        to = {"D": state, "K": NEXT_KEPT[state].get(low, state)}.get(edit, NEXT_MADE[state])
        out.append((cost[state], edit, to))
    return out


class SuffixAutomaton:
    """The nodes of the endings of the signature taken last; the next one keeps those that both share."""

    def __init__(self):
        self.reversed, self.nodes, self.made = "", [_end_node()], 0

    def take(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of a signature. Given in the order of the reversed signatures, each ending is computed once."""
        back = signature[::-1]
        shared = sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(back, self.reversed)))
        del self.nodes[shared + 1:]
        for letter in back[shared:]:
            self.nodes.append(node_of(letter, self.nodes[-1]))
            self.made += 1
        self.reversed = back
        at, state, audit = len(back), START, []
        while True:
            _, edit, to = self.nodes[at][state]
            if not edit:
                return self.nodes[-1][START][0], "".join(audit)
            audit.append(edit)
            state, at = to, at - (edit != "I")


def repairs(signatures: DataFrame) -> DataFrame:
    """``(signature, cost, audit)`` of a table of distinct signatures, dealt by ranges of what they end in."""
    def solved(batches):
        automaton = SuffixAutomaton()
        for batch in batches:
            found = [automaton.take(s) for s in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                                  names=["signature", "cost", "audit"])

    ship_package(signatures.sparkSession)
    ending = F.reverse("signature")
    dealt = signatures.select("signature").repartitionByRange(ending).sortWithinPartitions(ending)
    return dealt.mapInArrow(solved, "signature string, cost long, audit string")


# --- conversations, row by row -----------------------------------------------


def _by_conversation(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one task, its rows by turn (nulls first); those of one turn by role and digest of the text."""
    keys = [F.col("conv_id"), *[F.col(c) for c in first], F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*keys)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) over the batches; a conversation may go on in the next batch."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    return itertools.groupby(rows, key=lambda row: row[0])


def _per_conversation(rows: DataFrame, one, columns: str) -> DataFrame:
    """``one(its rows)`` of each conversation of the sorted ``rows``: ``conv_id`` and the given columns."""
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[c.split()[0] for c in columns.split(", ")]]
    types = [pa.int64() if c.endswith(" long") else pa.string() for c in columns.split(", ")]

    def streamed(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        found = ((conv, *one(own)) for conv, own in _streams(itertools.chain([head], batches)))
        while chunk := list(itertools.islice(found, CHUNK)):
            arrays = [pa.array(c, t) for c, t in zip(zip(*chunk), [head.schema.types[0], *types])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(streamed, f"conv_id {kind}, {columns}")


def _judged(rows: DataFrame) -> DataFrame:
    """Slim rows: ``conv_id, turn, role, digest, dropped, blank, cut_off, repeated, seen``; no texts.

    ``repeated``: the conversation has the role and text more than once;
    ``seen``: in an earlier turn. They come from a group table of digests, so
    a row repeated any number of times is one row there, and a conversation of any length is many.
    """
    slim = rows.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), "dropped",
        (~F.col("text").rlike(_VISIBLE)).alias("blank"), F.col("text").rlike(_CUT_OFF).alias("cut_off"))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))  # a null turn comes first
    # Grouped by the digest's bytes, joined by its text: the join deals both sides anew, AQE may split a hot key.
    several = (slim.where("not dropped").groupBy("conv_id", "role", F.unhex("digest").alias("bytes"))
               .agg(F.count("*").alias("rows"), F.min(order)["turn"].alias("first_turn")).where("rows > 1")
               .select(F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.lower(F.hex("bytes")).alias("of_digest"), "first_turn"))
    joined = slim.join(several, slim["conv_id"].eqNullSafe(several["of_conv"]) & (slim["role"] == several["of_role"])
                       & (slim["digest"] == several["of_digest"]), "left")
    repeated = F.col("of_digest").isNotNull()
    return joined.select("conv_id", "turn", "role", "digest", "dropped", "blank", "cut_off", repeated.alias("repeated"),
                         (repeated & ~F.col("first_turn").eqNullSafe(F.col("turn"))).alias("seen"))


def _signed(own: Iterator[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, signature) of a conversation's rows in order."""
    count, letters = {"blank": 0, "duplicate": 0, "truncated": 0}, bytearray()
    turns, lowest, highest, illegal, initial, last = 0, None, None, 0, None, None
    for _, turn, role, digest, dropped, blank, cut_off, repeated, seen in own:
        if dropped:
            continue
        if turn is not None:
            turns += turn != highest
            lowest, highest = turn if lowest is None else lowest, turn
        before, initial = initial, role[:1]
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        fault = ("blank" if blank else "duplicate" if seen or repeated and last == (turn, role, digest)
                 else "truncated" if cut_off else None)
        last = (turn, role, digest)
        letter = initial if initial and initial in ROLES else OTHER
        if fault:
            count[fault] += 1
            letter = letter.upper() if fault == "truncated" else GONE
        letters += letter.encode()
    return 0 if lowest is None else highest - lowest + 1 - turns, *count.values(), illegal, letters.decode()


def _replayed(own: Iterator[tuple]) -> tuple:
    """The first row's counts, cost and audit, and the digest of the rows after it, edited by the audit."""
    _, _, _, _, _, audit, *counts = next(own)
    digest, edits, state, empty = hashlib.sha256(), iter(audit), START, True

    def put(role: str, text: str) -> None:
        nonlocal empty
        digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
        empty = False

    def insert(edit: str | None) -> str | None:
        """Put in rows as long as the audit says so; the edit after them."""
        nonlocal state
        while edit == "I":
            put(MADE_ROLE[state], "")
            state, edit = NEXT_MADE[state], next(edits, None)
        return edit

    for _, _, _, role, _, text, *_ in own:
        edit = insert(next(edits))
        if edit == "K":
            put(role, text)
            state = NEXT_KEPT[state][role[0]]
        elif edit == "R":
            put(MADE_ROLE[state], text)
            state = NEXT_MADE[state]
    insert(next(edits, None))
    return *counts, audit, digest.hexdigest()


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def repair_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation.

    ``rows``: ``conv_id, turn, role, text, dropped``, the last three without
    nulls; dropped rows only name their conversation. Rows are taken by turn,
    nulls first; rows of one turn by role, then by the SHA-256 of the text.
    Each row's first fault counts: blank (nothing but white space), duplicate
    (role and text stood earlier; of equal rows the first is none), truncated
    (the last visible character isn't ``[.!?]``). Edits: K keep 0, R rerole to
    user or assistant 2, D delete 3 (a must for blank and duplicate rows), I
    insert an empty user or assistant row 2; a truncated row that stays costs 1.
    ``audit`` holds the cheapest edits that leave role initials
    ``(s?(ua)+)?``, ties to the least text. A null conv_id is a conversation of
    its own. Without rows: zeros, the empty audit, the digest of the empty text.
    Other columns are ignored.
    """
    slim = _by_conversation(_judged(rows))
    signed = written(_per_conversation(slim, _signed, ", ".join(f"{c} long" for c in COUNTS) + ", signature string"), "signatures")
    solved = written(repairs(signed.select("signature").distinct()), "repairs")
    told = signed.join(solved, "signature")
    none = lambda kind: F.lit(None).cast(kind)
    turn = rows.schema["turn"].dataType
    order = ["conv_id", "after", "turn", "role", "digest", "text", *COUNTS, "cost"]
    heads = told.withColumns({"after": F.lit(0), "turn": none(turn), "role": F.lit(""), "digest": F.lit(""), "text": F.col("audit")})
    body = rows.where("not dropped").withColumns({"after": F.lit(1), "digest": F.sha2("text", 256), **{c: none("long") for c in (*COUNTS, "cost")}})
    both = heads.select(*order).unionByName(body.select(*order))
    columns = ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string, repaired_sha256 string"
    return _per_conversation(_by_conversation(both, "after"), _replayed, columns)
