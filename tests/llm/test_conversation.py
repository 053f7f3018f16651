"""Conversation repair: costs and audits against all edit scripts and a plain automaton, and odd rows."""

import hashlib
import itertools
import random
import re

import pytest

from claimloom.llm import conversation as c

GOOD = re.compile(r"(s?(ua)+)?")
TURNS = [(role, fault) for role in "sauo" for fault in ("", "cut", "go")]


def code(role, fault):
    return c.ROLES.get(role, c.OTHER) | {"": 0, "cut": c.CUT, "go": c.MUST_GO}[fault]


def every_script(turns, most_inserts):
    """Cost and audit of all edit scripts, tried one by one."""
    gap = [x for k in range(most_inserts + 1) for x in itertools.product("ua", repeat=k)]
    per_turn = []
    for role, fault in turns:
        options = [("D", "", 2)]
        if fault != "go":
            extra = 5 if fault == "cut" else 0
            options += [("K", role, extra)] + [("R", new, 1 + extra) for new in "ua"]
        per_turn.append(options)
    for gaps in itertools.product(gap, repeat=len(turns) + 1):
        if sum(map(len, gaps)) > most_inserts:
            continue
        for edits in itertools.product(*per_turn):
            roles, audit, cost = "", "", 0
            for added, (letter, role, price) in itertools.zip_longest(gaps, edits, fillvalue=("", "", 0)):
                roles += "".join(added) + role
                audit += "I" * len(added) + letter
                cost += 5 * len(added) + price
            if GOOD.fullmatch(roles):
                yield cost, audit


def automaton(turns):
    """The same by a table over what was written last; strings are compared as they grow."""
    after = {"N": {"u": "U"}, "S": {"u": "U"}, "A": {"u": "U"}, "U": {"a": "A"}}

    def inserted(ways):
        found = dict(ways)
        for _ in range(2):
            for state, (cost, audit) in list(found.items()):
                for new in after[state].values():
                    found[new] = min(found.get(new, (1 << 30, "")), (cost + 5, audit + "I"))
        return found

    ways = {"N": (0, "")}
    for role, fault in turns:
        extra, nothing, best = 5 if fault == "cut" else 0, ways.get("N"), {}

        def offer(state, way):
            best[state] = min(best.get(state, (1 << 30, "")), way)

        for state, (cost, audit) in inserted(ways).items():
            offer(state, (cost + 2, audit + "D"))
            if fault != "go":
                for new, state2 in after[state].items():
                    if new == role:
                        offer(state2, (cost + extra, audit + "K"))
                    offer(state2, (cost + 1 + extra, audit + "R"))
        if nothing and role == "s" and fault != "go":
            offer("S", (nothing[0] + extra, nothing[1] + "K"))
        ways = best
    return min(way for state, way in inserted(ways).items() if state in "NA")


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_against_every_edit_script(n):
    for turns in itertools.product(TURNS, repeat=n) if n < 3 else random.Random(3).sample(
        list(itertools.product(TURNS, repeat=3)), 60
    ):
        best = min(every_script(turns, 3))
        assert c.align(bytes(code(*t) for t in turns)) == best == automaton(turns)


@pytest.mark.parametrize("block", [1, 2, 5, 64, 512])
def test_blocks_change_nothing(block):
    pick = random.Random(block)
    for n in [*range(1, 30), 100, 700]:
        weights = pick.choice([(1,) * 12, (9, 1, 1, 30, 3, 3, 40, 3, 3, 1, 1, 1)])
        turns = pick.choices(TURNS, weights, k=n)
        assert c._aligned(bytes(code(*t) for t in turns), block) == automaton(turns)


def plain(rows):
    """Figures, audit and repaired turns of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    figures, seen, turns = dict.fromkeys(c.FIGURES, 0), set(), []
    for at, (_, role, text) in enumerate(rows):
        rest = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            figures[fault] += 1
        turns.append((role[:1], {"": "", "truncated": "cut"}.get(fault, "go")))
        if at and turns[at - 1][0] + role[:1] not in ("su", "ua", "au"):
            figures["illegal"] += 1
    numbers = {t for t, _, _ in rows if t is not None}
    figures["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    figures["cost"], audit = automaton(turns)
    written, at = [], 0
    for letter in audit:
        expected = "assistant" if written and written[-1][0][:1] == "u" else "user"
        if letter == "I":
            written.append((expected, "", True))
        else:
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                written.append((role if letter == "K" else expected, text, False))
    return figures, audit, written


def odd_rows():
    pick = random.Random(12)
    texts = ["Yes.", "No!", "cut off", "", "\t\r\n", None, "Ünï. ", "long " * 4000 + "end?", "a.\x0b", "b.\x1c"]
    roles = ["user", "assistant", "system", "User", "", None, "tool", "u"]
    rows = [
        (conv, pick.choice([None, *range(-3, 12)]), pick.choice(roles[:3] * 5 + roles), pick.choice(texts))
        for conv in [None, *range(25)]
        for _ in range(pick.choice([1, 2, 5, 9]))
    ]
    rows += [(100, t, ["user", "assistant"][t % 2], f"text {t % 700}.") for t in range(1500)]
    return rows + [(101, 1, "user", "Same.")] * 5 + [(102, None, "user", "Hi."), (102, None, "assistant", "Ho.")]


def test_conversations(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, copies int, cost string")
    found = {r["conv_id"]: r for r in c.audits(df.repartition(7)).collect()}
    turns = {}
    for r in sorted(c.repaired(df).collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["added"]))
    assert found.keys() == {r[0] for r in rows}
    for conv in found:
        figures, audit, written = plain([r[1:] for r in rows if r[0] == conv])
        assert {f: found[conv][f] for f in c.FIGURES} == figures
        assert found[conv]["audit"] == audit
        assert turns.get(conv, []) == written
        lines = "\n".join(f"{role}:{text}" for role, text, _ in written)
        assert found[conv]["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


def test_damage_and_ids_without_rows(spark):
    rows = [(conv, turn, "user", "One. Two!") for conv in (1, None) for turn in [None, *range(60)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = {(r["role"], r["text"], r["copies"]) for r in c.damaged(df).collect()}
    assert seen == {("user", "One. Two!", 1), ("user", "One. Two!", 0), ("user", "One. Two!", 2), ("user", "", 1), ("user", "One Two", 1)}
    gone = c.audits(c.damaged(df).selectExpr("*", "0 AS none"), copies="none").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r)[1:] for r in gone] == [(0,) * 6 + ("", empty)] * 2
    assert c.audits(df.limit(0)).count() == c.repaired(df.limit(0)).count() == 0
