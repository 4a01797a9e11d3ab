"""Repair of conversations by the cheapest edits that give a legal order of roles.

A conversation is legal if the initials of its roles read (s?(ua)+)?. Its rows may be kept, given
another role, deleted, or have rows put between them; the prices are ``PRICES``. The edits are
a path through a lattice of (rows read, state of the order), found by Dijkstra's algorithm from
both ends: a forward and a reverse heap, whose settled nodes meet in crossing edges. The search
goes on until no crossing of equal cost can be missing; of all cheapest paths the one whose edits
spell the least string is taken.

A row is one symbol for the search: its initial and its fault. Symbols are put together in blocks of
``BLOCK`` consecutive rows. A block is searched from each state it may be entered in to each it may
be left in, all blocks in parallel, and the outcomes are joined per conversation: a task holds a few
bytes a row of one conversation, never its texts. Texts are only sorted, and stream past.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from newslens.llm.common import schema_of
from newslens.plans.ordered import join_on
from newslens.plans.storage import materialise

#: What an edit costs, and what a truncated row that is not deleted costs besides.
PRICES = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
#: White space, as a class and as what may not be all of a text.
SOLID = r"[^\x20\x09-\x0D]"
CUT_OFF = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
BLOCK_BITS = 10
#: States of the order: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one user or assistant row that each state may be followed by.
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
#: Symbols: initials in small letters for whole rows, in capitals for truncated ones, and after a
#: minus for rows that must go. Any other initial is an o.
MUST_GO = "-"

Found = tuple[int, str]


def row_edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of a row in a state."""
    yield "D", PRICES["D"], state
    if symbol[0] == MUST_GO:
        return
    more = TRUNCATED if symbol.isupper() else 0
    if (after := STEP.get((state, symbol.lower()))) is not None:
        yield "K", PRICES["K"] + more, after
    yield "R", PRICES["R"] + more, STEP[state, NEXT[state]]


def cheapest(rows: list[str], entry: int, exits: tuple[int, ...]) -> Found | None:
    """Cost and least string of the cheapest edits from ``entry`` before the rows to one of ``exits``
    after them; None if there are none."""
    n = len(rows)
    if n == 0 and entry in exits:
        return 0, ""

    def onward(i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        if i < n:
            for edit, cost, after in row_edits(rows[i], state):
                yield edit, cost, (i + 1, after)
        yield "I", PRICES["I"], (i, STEP[state, NEXT[state]])

    def back(i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        for before in range(4):
            if i:
                for edit, cost, after in row_edits(rows[i - 1], before):
                    if after == state:
                        yield edit, cost, (i - 1, before)
            if STEP[before, NEXT[before]] == state:
                yield "I", PRICES["I"], (i, before)

    # edits that cost nothing lead to later rows: with rows as second key, of one cost a node
    # comes out after all that lead to it
    forward: list = [(0, 0, "", entry)]
    reverse: list = [(0, -n, "", state) for state in exits]
    ahead: dict[tuple[int, int], Found] = {}
    behind: dict[tuple[int, int], Found] = {}
    best: Found | None = None

    def settle(heap: list, done: dict, other: dict, onto, is_forward: bool) -> None:
        nonlocal best
        cost, row, word, state = heappop(heap)
        node = (abs(row), state)
        if node in done:
            return
        done[node] = cost, word
        for edit, price, reached in onto(*node):
            if (met := other.get(reached)) is not None:
                whole = (cost + price + met[0], word + edit + met[1] if is_forward else met[1] + edit + word)
                best = whole if best is None else min(best, whole)
            if reached not in done:
                heappush(heap, (cost + price, reached[0] if is_forward else -reached[0], word + edit if is_forward else edit + word, reached[1]))

    for _ in exits:  # both ends are settled before any crossing is looked for
        settle(reverse, behind, ahead, back, False)
    while forward and reverse and (best is None or forward[0][0] + reverse[0][0] <= best[0]):
        if forward[0][0] <= reverse[0][0]:
            settle(forward, ahead, behind, onward, True)
        else:
            settle(reverse, behind, ahead, back, False)
    # one heap may run dry first: what the other still holds can only cross edges already seen
    while best is None and (forward or reverse):
        settle(*((forward, ahead, behind, onward, True) if forward else (reverse, behind, ahead, back, False)))
    return best


def split_symbols(word: str) -> list[str]:
    out, at = [], 0
    while at < len(word):
        step = 2 if word[at] == MUST_GO else 1
        out.append(word[at : at + step])
        at += step
    return out


def block_outcomes(word: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, edits) of a block for all ways to enter and to leave it; a last block
    is left in any state that may end a conversation, counted as exit START."""
    rows, out = split_symbols(word), []
    for entry in (START,) if first else range(4):
        for leave in (ENDS,) if last else [(s,) for s in range(4)]:
            if (found := cheapest(rows, entry, leave)) is not None:
                out.append((entry, START if last else leave[0], *found))
    return out


def joined_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> Found:
    """Cheapest edits of a whole conversation, of equal ones the least string, from its blocks' outcomes."""
    reached: dict[int, Found] = {START: (0, "")}
    for outcomes in blocks:
        after: dict[int, Found] = {}
        for entry, leave, cost, edits in outcomes:
            if entry in reached:
                whole = reached[entry][0] + cost, reached[entry][1] + edits
                after[leave] = min(after.get(leave, whole), whole)
        reached = after
    return reached[START]


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def map_rows(df: DataFrame, ddl: str, function) -> DataFrame:
    """Rows that ``function`` makes of the columns of a batch, given as lists."""
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                made = function(*[c.to_pylist() for c in batch.slice(at, 1024).columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(made, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def ordered_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text (null: one space) and pos, a number that rises with the turn.

    Nulls come first; rows of one turn are ordered by role, then by a digest of the text. The
    sort goes on to that digest, so a conversation with very many rows is spread over many tasks.
    """
    space = F.lit(" ")
    plain = df.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text")
    )
    digest = plain.withColumn("digest", F.unhex(F.sha2("text", 256)))
    ranked = digest.orderBy("conv_id", "turn", "role", "digest").withColumn("pos", F.monotonically_increasing_id())
    return materialise(ranked, "repair-rows")


def plans(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation in
    ``rows``, which ``ordered_rows`` made."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    blank = ~F.col("text").rlike(SOLID)
    facts = materialise(rows.select("conv_id", "turn", "pos", "role", "digest", blank.alias("blank"), F.col("text").rlike(CUT_OFF).alias("cut")), "repair-facts")
    keys = ["conv_id", "role", "digest"]
    seen = facts.filter("not blank").groupBy(*keys).agg(F.min("pos").alias("first"), F.count("*").alias("k")).filter("k > 1").drop("k")
    judged = join_on(facts, seen, keys, "left").select(
        "conv_id", "turn", "pos", "blank", F.substring("role", 1, 1).alias("initial"),
        (~F.col("blank") & F.coalesce(F.col("pos") > F.col("first"), F.lit(False))).alias("duplicate"), "cut",
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    gone = F.col("blank") | F.col("duplicate")
    symbol = F.when(gone, F.concat(F.lit(MUST_GO), known)).when(F.col("cut"), F.upper(known)).otherwise(known)
    judged = materialise(judged.withColumn("symbol", symbol), "repair-judged")
    sums = judged.groupBy("conv_id").agg(
        (F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count_distinct("turn")).cast("long").alias("gaps"),
        F.count_if("blank").alias("blank"), F.count_if("duplicate").alias("duplicate"), F.count_if(F.col("cut") & ~gone).alias("truncated"),
    )
    block = judged.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block"))
    words = block.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "symbol"))), lambda e: e["symbol"]), "").alias("word"))
    whole = words.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "word"))).alias("words"))
    # a conversation in one piece is done here, the pieces of others go their own ways
    parts = whole.select("conv_id", F.size("words").alias("of"), F.posexplode("words").alias("at", "part")).select("conv_id", "at", "of", "part.word")
    outcome = "array<struct<entry:int,leave:int,cost:bigint,edits:string>>"

    def search(ids, at, of, word):
        made = [[dict(zip(("entry", "leave", "cost", "edits"), o)) for o in block_outcomes(w, i == 0, i == n - 1)] for w, i, n in zip(word, at, of)]
        initials = [w.replace(MUST_GO, "").lower() for w in word]
        return [ids, at, made, list(map(illegal_pairs, initials)), [w[0] for w in initials], [w[-1] for w in initials]]

    spread = parts.repartition(F.xxhash64("conv_id", "at"))
    found = map_rows(spread, f"conv_id {kind}, at int, outcomes {outcome}, illegal int, head string, tail string", search)
    grouped = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "outcomes", "illegal", "head", "tail"))).alias("parts"))

    def join(ids, parts):
        done = [joined_blocks([[tuple(o.values()) for o in p["outcomes"]] for p in some]) for some in parts]
        seams = [sum(p["illegal"] for p in some) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(some, some[1:])) for some in parts]
        return [ids, seams, [c for c, _ in done], [a for _, a in done]]

    return join_on(sums, map_rows(grouped, f"conv_id {kind}, illegal bigint, cost bigint, audit string", join), ["conv_id"])


def repaired_rows(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, place (from 1), edit, turn, role and text of every row after the repair; place 0 opens
    each conversation. Conversations come whole and in order within a partition.

    The rows of a conversation pass one task in order, one batch at a time; only its audit is held.
    """
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    opening = planned.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast(kinds["turn"]).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = rows.select("conv_id", "pos", "turn", "role", "text").unionByName(opening)
    stream = stream.repartition(F.xxhash64("conv_id")).sortWithinPartitions("conv_id", "pos")
    schema = schema_of(f"conv_id {kinds['conv_id']}, place bigint, edit string, turn {kinds['turn']}, role string, text string")
    arrow = to_arrow_schema(schema)

    def run(batches):
        audit, at, state, place, key = "", 0, START, 0, None
        out: list[tuple] = []

        def inserted():
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                initial = NEXT[state]
                at, state, place = at + 1, STEP[state, initial], place + 1
                out.append((key, place, "I", None, ROLES[initial], ""))

        def flushed():
            made = pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*out), arrow)], schema=arrow)
            out.clear()
            return made

        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                for conv, pos, turn, role, text in zip(*[c.to_pylist() for c in batch.slice(part, 512).columns]):
                    if pos < 0:
                        inserted()  # what comes after the last row
                        audit, at, state, place, key = text, 0, START, 0, conv
                        out.append((key, 0, None, None, None, None))
                        continue
                    inserted()
                    edit = audit[at]
                    at += 1
                    if edit == "D":
                        continue
                    initial = role[:1] if edit == "K" else NEXT[state]
                    state, place = STEP[state, initial], place + 1
                    out.append((key, place, edit, turn, role if edit == "K" else ROLES[initial], text))
                if out:
                    yield flushed()
        inserted()
        if out:
            yield flushed()

    return stream.mapInArrow(run, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 (of role:text, newline-joined), of rows as ``repaired_rows`` left them."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    schema = schema_of(f"conv_id {kind}, repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def run(batches):
        key, running = None, None
        for batch in batches:
            done = []
            for conv, place, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if place == 0:
                    if running is not None:
                        done.append((key, running.hexdigest()))
                    key, running = conv, hashlib.sha256()
                else:
                    running.update((("\n" if place > 1 else "") + f"{role}:{text}").encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*done), arrow)], schema=arrow)
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((key, running.hexdigest()), arrow)], schema=arrow)

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The plan of every conversation (see ``plans``) and its rows after the repair (see ``repaired_rows``).

    A blank row (no solid character) or a duplicate (role and text seen earlier in the conversation)
    must be deleted; a truncated one (last solid character not ., ! or ?) costs more to keep. Each row
    counts for its first fault. Null roles and texts are one space, null turns come first and do not
    count for gaps, null ids are one conversation. Rows of one turn are ordered by role and digest of
    the text, repeated rows are duplicates. Empty tables give empty results. Very long texts pass
    unchanged; other columns are left out, whatever their names. Tables go to the session's shared folder.
    """
    rows = ordered_rows(df, conv_id, turn, role, text)
    planned = materialise(plans(rows), "repair-plans")
    return planned, repaired_rows(rows, planned)


def damaged(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults put in by a hash of id and turn: rows dropped, emptied, without their
    stops, repeated, or given to the user. Null ids, turns, roles and texts count as one space."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named(conv_id), F.lit(":"), named(turn)).cast("binary")) % 20
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), named(role).alias("role"), named(text).alias("text"), fault.alias("fault"))
    return rows.filter("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
