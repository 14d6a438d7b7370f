"""Repairs next to all edit sequences of short conversations, and to a plain recurrence for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from spanloom.llm import conversations
from tests.llm.data import sort_key

SPACES = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, part int, symbols string, dropped string"


def all_sequences(symbols, inserts=2):
    """Cost and audit of every edit sequence with at most ``inserts`` rows put into a gap."""
    gaps = [("I" * n, [letters for letters in itertools.product("ua", repeat=n)]) for n in range(inserts + 1)]
    gap_choices = [(audit, "".join(roles)) for audit, options in gaps for roles in options]

    def row_choices(symbol):
        yield 4, "D", ""
        if symbol not in "bd":
            late = 3 if symbol.isupper() else 0
            yield late, "K", symbol.lower()
            yield 3 + late, "R", "u"
            yield 3 + late, "R", "a"

    for rows in itertools.product(*(list(row_choices(s)) for s in symbols)):
        for between in itertools.product(gap_choices, repeat=len(symbols) + 1):
            audit, roles, cost = between[0][0], between[0][1], 3 * len(between[0][0])
            for (c, letter, role), (put, written) in zip(rows, between[1:]):
                audit, roles, cost = audit + letter + put, roles + role + written, cost + c + 3 * len(put)
            if re.fullmatch("(s?(ua)+)?", roles):
                yield cost, audit


@pytest.mark.parametrize("symbols", ["", *(
    "".join(s) for n in (1, 2) for s in itertools.product("suaxSUAXbd", repeat=n)
)])
def test_least_of_all_sequences(symbols):
    assert conversations.cheapest_edits(symbols) == min(all_sequences(symbols))


def test_least_of_all_sequences_of_three():
    rng = random.Random(2)
    for _ in range(25):
        symbols = "".join(rng.choices("suaxSUAbd", k=3))
        assert conversations.cheapest_edits(symbols) == min(all_sequences(symbols, 1)), symbols


def recurrence(symbols):
    """Least (cost, audit) by state, row after row, with the states' moves spelled out."""
    state = {"": (0, "")}

    def better(found, key, value):
        if key not in found or value < found[key]:
            found[key] = value

    def inserted(found):
        for _ in range(3):
            for key, (cost, audit) in list(found.items()):
                better(found, "a" if key == "u" else "u", (cost + 3, audit + "I"))
        return found

    for symbol in symbols:
        found = {}
        for key, (cost, audit) in inserted(state).items():
            better(found, key, (cost + 4, audit + "D"))
            if symbol in "bd":
                continue
            late, fits = 3 * symbol.isupper(), "a" if key == "u" else "u"
            better(found, fits, (cost + 3 + late, audit + "R"))
            if symbol.lower() == fits or (symbol.lower() == "s" and key == ""):
                better(found, symbol.lower(), (cost + late, audit + "K"))
        state = found
    state = inserted(state)
    return min(state[k] for k in ("", "a") if k in state)


def test_long_lists_of_symbols():
    rng = random.Random(5)
    for n in (4, 7, 20, 60, 200):
        for alphabet in ("suaxSUAXbd", "ua", "uaUA", "bd", "xXs"):
            symbols = "".join(rng.choices(alphabet, k=n))
            assert conversations.cheapest_edits(symbols) == recurrence(symbols)


def brute(rows, dropped=()):
    """Summaries of damaged rows ``(conv_id, turn, role, text)``, one list per conversation."""
    found = {}
    for i, (conv_id, turn, role, text, *_) in enumerate(rows):
        own = found.setdefault(conv_id, [])
        if i not in dropped:
            own.append((turn, " " if role is None else role, " " if text is None else text))
    result = []
    for conv_id, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        symbols, seen = "", set()
        for _, role, text in own:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            said = text.strip(SPACES)
            if not said:
                symbols += "b"
            elif (role, text) in seen:
                symbols += "d"
            else:
                symbols += initial if said[-1] in ".!?" else initial.upper()
            seen.add((role, text))
        cost, audit = recurrence(symbols)
        left, i, last = [], 0, ""
        for letter in audit:
            if letter in "KRD":
                _, role, text = own[i]
                i += 1
            if letter in "RI":
                role, text = ("assistant" if last == "u" else "user"), (text if letter == "R" else "")
            if letter != "D":
                left.append(f"{role}:{text}")
                last = role[0]
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        result.append((
            conv_id, gaps, symbols.count("b"), symbols.count("d"), sum(c.isupper() for c in symbols),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest(),
        ))
    return sorted(result, key=sort_key)


def damage(rows):
    """Rows after the seeded damage, and the places of those that are dropped."""
    left, dropped = [], set()
    for conv_id, turn, role, text, *_ in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        act = zlib.crc32(key.encode()) % 20
        if act == 0:
            dropped.add(len(left))
        if act == 4:
            role = "user"
        text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
        left += [(conv_id, turn, role, text)] * (2 if act == 3 else 1)
    return left, dropped


def chats(n=60, seed=6):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        role = rng.choice(["system", "user", "assistant"])
        for t in range(rng.randrange(1, 12)):
            text = rng.choice(["Yes.", "No!", "well", "", " \t", f"text {rng.randrange(99)}.", "ñandú?\n"])
            rows.append((c, t + (t > 4) * 2, role, text, 1, "x", None))
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else (
                "assistant" if role == "user" else "user")
    rows += [
        (None, None, "user", "Hello.", None, None, None),
        (None, None, "assistant", "Hi!", None, None, None),
        (None, 3, None, None, None, None, None),
        (900, None, "user", None, None, None, None),
        (901, 5, "", "Empty role.", None, None, None),
        (901, 6, "tool", "Other role.", None, None, None),
        (901, 7, "ústed", "Other role.", None, None, None),
        (902, 1, "user", "a" * 400_000, None, None, None),
        (902, 2, "assistant", "b " * 300_000 + ".", None, None, None),
        (902, 3, "user", "c.", None, None, None),
        rows[0],
        rows[0],
        (903, 1, "user", "same turn b.", None, None, None),
        (903, 1, "user", "same turn a.", None, None, None),
        (903, 1, "assistant", "same turn.", None, None, None),
    ]
    return rows


def long_chat(conv_id, n, seed):
    rng = random.Random(seed)
    return [
        (conv_id, None if conv_id is None else t, rng.choice(["user", "assistant", "user", "assistant", "system"]),
         rng.choice(["", "Well.", "well", f"r{rng.randrange(40)}.", f"l{t}.", f"l{t}"]), 1, "x", None)
        for t in range(n)
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=sort_key)


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("segment_rows", [128, 3])
def test_conversations(spark, monkeypatch, segment_rows):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment_rows)
    rows = chats()
    found = conversations.repair_conversations(table(spark, rows))
    assert rows_of(found.summaries()) == brute(rows)


def test_long_conversations_over_many_tasks(spark):
    rows = long_chat(7, 900, 1) + long_chat(None, 700, 2) + long_chat(8, 130, 3) + chats(10)
    found = conversations.repair_conversations(table(spark, rows))
    assert found.parts.filter("conv_id = 7").count() > 7
    assert rows_of(found.summaries()) == brute(rows)


def test_damage(spark):
    rows = chats(150, 9) + long_chat(5000, 300, 4)
    left, dropped = damage(rows)
    assert dropped and len(left) > len(rows)
    assert rows_of(conversations.damaged_repairs(table(spark, rows))) == brute(left, dropped)


def test_conversations_that_are_dropped_whole(spark):
    key = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(key, 1, "user", "Gone.", 1, "", "")]
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(conversations.damaged_repairs(table(spark, rows))) == [(key, *[0] * 6, "", empty)]


def test_empty_table(spark):
    assert conversations.damaged_repairs(table(spark, [])).count() == 0
    assert conversations.repair_conversations(table(spark, [])).turns().count() == 0


def test_repaired_rows_fit_the_grammar(spark):
    rows = chats(40) + long_chat(77, 400, 8)
    repaired = conversations.repair_conversations(table(spark, rows)).turns().collect()
    by_conversation = {}
    for r in sorted(repaired, key=lambda r: (r.part, r.seq, r.place)):
        by_conversation.setdefault(r.conv_id, []).append(r.role)
    for roles in by_conversation.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role in roles))
    again = [(c, i, role, f"{i}.", 1, "", "") for c, roles in by_conversation.items() for i, role in enumerate(roles)]
    summaries = conversations.repair_conversations(table(spark, again)).summaries().collect()
    assert {(s.cost, set(s.audit) <= {"K"}) for s in summaries} == {(0, True)}
