import hashlib
import itertools
import random
import re
import zlib

import pytest

from newslens.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?\Z")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    """(role, text, fault) in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def by_table(rows):
    """Cheapest edits by a plain table over all rows and prefixes of the order."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(table):
        for _ in range(4):
            for state, (cost, word) in list(table.items()):
                for c in "ua":
                    if (state, c) in step:
                        after, whole = step[state, c], (cost + 5, word + "I")
                        table[after] = min(table.get(after, whole), whole)
        return table

    table = inserted({"": (0, "")})
    for role, _, fault in rows:
        following = {}

        def put(state, found):
            following[state] = min(following.get(state, found), found)

        more = 5 if fault == "truncated" else 0
        for state, (cost, word) in table.items():
            put(state, (cost + 2, word + "D"))
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in step:
                    put(step[state, role[:1]], (cost + more, word + "K"))
                for c in "ua":
                    if (state, c) in step:
                        put(step[state, c], (cost + 1 + more, word + "R"))
        table = inserted(following)
    return min(table[s] for s in ("", "a") if s in table)


def apply(rows, audit):
    out, rest, state = [], list(rows), ""
    needs = {"": "u", "s": "u", "u": "a", "a": "u"}
    for edit in audit:
        if edit == "I":
            state = needs[state]
            out.append(({"u": "user", "a": "assistant"}[state], ""))
            continue
        role, text, _ = rest.pop(0)
        if edit == "D":
            continue
        if edit == "R":
            role = {"u": "user", "a": "assistant"}[needs[state]]
        state = role[:1]
        out.append((role, text))
    assert not rest and LEGAL.match("".join(r[:1] for r, _ in out))
    return out


def brute(rows):
    ids = list(dict.fromkeys(r[0] for r in rows))
    after, out = damage(rows), []
    for conv in ids:
        mine = [r for r in after if r[0] == conv]
        key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest())
        mine.sort(key=key)
        turns = [t for _, t, _, _ in mine if t is not None]
        judged = faults([(role, text) for _, _, role, text in mine])
        cost, audit = by_table(judged)
        fixed = "\n".join(f"{r}:{t}" for r, t in apply(judged, audit))
        count = lambda f: sum(x == f for _, _, x in judged)  # noqa: B023, E731
        pairs = zip(judged, judged[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(fixed.encode()).hexdigest()))
    return sorted(out, key=str)


def query(spark, rows):
    import newslens.llm.queries as queries

    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, audit string")
    original, queries.table = queries.table, lambda *_: df.repartition(3)
    try:
        found = queries.op13_conversation_repair(spark, "").collect()
    finally:
        queries.table = original
    return sorted((tuple(r) for r in found), key=str)


def symbols(judged):
    out = []
    for role, _, fault in judged:
        c = role[:1] if role[:1] in ("s", "u", "a") else "o"
        out.append("-" + c if fault in ("blank", "duplicate") else c.upper() if fault else c)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_search_from_both_ends_finds_the_least_cheapest_edits(seed):
    draw = random.Random(seed)
    for _ in range(250):
        n = draw.randrange(0, 9)
        judged = [(draw.choice(["system", "user", "assistant", "user", "assistant", "tool"]), "", draw.choice(["", "", "", "blank", "truncated"])) for _ in range(n)]
        assert repair.cheapest(symbols(judged), repair.START, repair.ENDS) == by_table(judged)


def test_table_is_the_least_of_all_edit_strings():
    """Every edit string of up to three rows and two insertions."""
    for n in range(4):
        for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=n):
            for kinds in itertools.product(("", "truncated", "blank"), repeat=n) if n < 3 else [("",) * 3, ("truncated", "", "blank")]:
                judged = [(r, "", k) for r, k in zip(roles, kinds)]
                best = None
                for edits in itertools.product("KRD", repeat=n):
                    for count in range(3):
                        for places in itertools.combinations_with_replacement(range(n + 1), count):
                            word = "".join("I" * places.count(i) + (edits[i] if i < n else "") for i in range(n + 1))
                            cost = 5 * count + sum({"K": 0, "R": 1, "D": 2}[e] + (5 if k == "truncated" and e != "D" else 0) for e, k in zip(edits, kinds))
                            if any(k == "blank" and e != "D" for e, k in zip(edits, kinds)) or (best and (cost, word) >= best):
                                continue
                            try:
                                apply(judged, word)
                            except (AssertionError, KeyError):
                                continue
                            best = (cost, word)
                assert by_table(judged) == best


def test_blocks_join_to_the_same_edits():
    draw = random.Random(3)
    for _ in range(60):
        judged = [(draw.choice(["system", "user", "assistant"]), "", draw.choice(["", "", "blank", "truncated"])) for _ in range(draw.randrange(2, 40))]
        rows, size = symbols(judged), draw.randrange(1, 9)
        pieces = ["".join(rows[i : i + size]) for i in range(0, len(rows), size)]
        made = [repair.block_outcomes(p, i == 0, i == len(pieces) - 1) for i, p in enumerate(pieces)]
        assert repair.joined_blocks(made) == by_table(judged)


def talks(draw, n=60):
    rows = []
    for conv in range(n):
        roles = ["system"] * draw.randrange(2) + ["user", "assistant"] * draw.randrange(1, 7)
        for turn, role in enumerate(roles):
            rows.append((conv, turn, role, " ".join(draw.choices(["yes.", "no", "why?", "é!", "ok"], k=draw.randrange(1, 4)))))
    return rows


def test_equals_plain_repair(spark):
    draw = random.Random(1)
    rows = talks(draw)
    rows += [(500, None, "user", "when?"), (500, 4, None, None), (500, 4, "tool", "x."), (500, 4, "tool", "x."), (500, 9, "assistant", None), (None, None, None, None), (None, 1, "user", "a. "), (None, 2, "", "b!  \n")]
    rows += [(501, 7, "assistant", "z" * 200_000 + ".")]
    dropped = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    draw.shuffle(rows)
    found = query(spark, rows)
    assert found == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found


def test_a_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 4)
    draw = random.Random(2)
    rows = [(7, i, draw.choice(["user", "assistant", "assistant", "system"]), f"{i}{draw.choice(['.', '', '!'])}") for i in range(900)] + talks(draw, 5)
    assert query(spark, rows) == brute(rows)


def test_rows_of_the_repair(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "And."), (2, 0, "assistant", "So.")]
    planned, fixed = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted((r["conv_id"], r["cost"], r["audit"]) for r in planned.collect()) == [(1, 1, "KR"), (2, 2, "D")]
    got = [(r["place"], r["edit"], r["turn"], r["role"], r["text"]) for r in fixed.collect() if r["conv_id"] == 1]
    assert got == [(0, None, None, None, None), (1, "K", 0, "user", "Hi."), (2, "R", 1, "assistant", "And.")]


def test_no_rows(spark):
    assert query(spark, []) == []
