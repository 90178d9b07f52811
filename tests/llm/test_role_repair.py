"""Conversation repair against every script of edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from maskwright.llm.role_repair import Conversation, repair, repair_damaged, repaired

RIGHT = re.compile("(s?(ua)+)?")


def faults(rows):
    """The first fault of each row of a conversation, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        out.append(
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?"
            else None
        )
        seen.add((role, text))
    return out


def brute_force(rows):
    """Least cost and audit over all choices for each row and up to two inserts before each and at the end."""
    best = None
    found = faults(rows)
    options = []
    for (_, role, text), fault in zip(rows, found):
        mine = [("D", 4, "", None)]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            mine.append(("K", more, role[:1] if role[:1] in "sua" and role else "?", f"{role}:{text}"))
            mine += [("R", 3 + more, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        options.append(mine)
    none = [("", 0, "", [])]
    new = [(("I", 3, r[0], [f"{r}:"])) for r in ("user", "assistant")]
    two = [("II", 6, a[2] + b[2], a[3] + b[3]) for a in new for b in new]
    for inserts in itertools.product(none + new + two, repeat=len(rows) + 1):
        if sum(len(i[0]) for i in inserts) > 3:
            continue
        for chosen in itertools.product(*options):
            roles, cost, audit, lines = "", 0, "", []
            for ins, edit in itertools.zip_longest(inserts, chosen):
                roles, cost, audit, lines = roles + ins[2], cost + ins[1], audit + ins[0], lines + ins[3]
                if edit:
                    roles, cost, audit = roles + edit[2], cost + edit[1], audit + edit[0]
                    lines = lines + ([edit[3]] if edit[3] is not None else [])
            if RIGHT.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(conversations):
    out = {}
    for conv, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found = faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = brute_force(rows)
        out[conv] = (
            gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), pairs, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def test_every_script_of_edits(spark):
    draw = random.Random(5)
    talks = {}
    for conv in range(120):
        talks[conv] = [
            (draw.choice([None, i, i, i + 1]), draw.choice(["user", "assistant", "system", "tool", "u", "", "User"]),
             draw.choice(["Yes.", "no", "What? \n", " \t", "Yes.", "ok!"]))
            for i in range(draw.randint(1, 4))
        ]
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as seen", "'x' as gone", "2 as place", "3 as cost"
    )
    got = {r[0]: tuple(r)[1:] for r in repair(df.repartition(5)).collect()}
    assert got == expected(talks)


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        shown = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(shown.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def test_damage(spark):
    draw = random.Random(6)
    rows = [
        (draw.choice([None, *range(400)]), draw.choice([None, 0, 1, 2, 3]), draw.choice([None, "user", "assistant"]),
         draw.choice([None, "", "So. be it!", "é?"]))
        for _ in range(300)
    ]
    rows += [(1000 + i, 0, "user", "One.") for i in range(60)]
    damaged = damage(rows)
    small = {c for c, r in damaged.items() if len(r) <= 4}
    assert None in damaged and any(not damaged[c] for c in small)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r[0]: tuple(r)[1:] for r in repair_damaged(df).collect()}
    assert set(got) == set(damaged)
    assert {c: got[c] for c in small} == expected({c: damaged[c] for c in small})
    gone = next(c for c in small if not damaged[c])
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversations_settle_turns_on_the_way(spark):
    """Both a conversation whose stacks agree soon and one whose stacks never do."""
    talk = Conversation(lambda role, text: None)
    for i in range(20_000):
        talk.add(i, "user" if i % 2 == 0 else "assistant", f"{i}." + "x." * (i % 3), False)
    assert len(talk.waiting) < 100 and all(len(a) < 100 for _, a in talk.tops.values())
    assert talk.finish() == (0, 0, 0, 0, 0, 0, "K" * 20_000)
    odd = Conversation(lambda role, text: None)
    for i in range(2001):
        odd.add(i, "tool", f"{i}.", False)
    # One more turn than pairs have: deleting the first is as cheap as any other, and least in ASCII.
    assert odd.finish() == (0, 0, 0, 0, 2000, 4 + 3 * 2000, "D" + "R" * 2000)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Eh"), (1, 3, "user", ""),
            (2, 0, "user", "x" * 300_000 + "."), (2, 1, "user", "Why?"), (3, 0, "tool", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = {(r.conv_id, r.place): (r.role, r.text) for r in repaired(df).collect()}
    whole = {c: "\n".join(":".join(turns[k]) for k in sorted(turns) if k[0] == c) for c in (1, 2, 3)}
    for r in repair(df).collect():
        assert hashlib.sha256(whole[r.conv_id].encode()).hexdigest() == r.repaired_sha256
    assert turns[1, 1] == ("user", "") and turns[2, 1] == ("assistant", "Why?")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_damaged(df).count() == 0 and repaired(df).count() == 0
    assert repair(df, gone=F.lit(True)).columns[0] == "conv_id"
