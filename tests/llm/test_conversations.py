"""Conversation repair against plain versions: all edit sequences, and whole tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = "\x20\x09-\x0D"


def faults(rows):
    """rows: (turn, role, text) in order -> fault or None of each."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(f"[^{WHITE}]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_edit(initials, found):
    """Least (cost, audit, lines as initials) over all edits, by trying all."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    choices = [[("D", "", 3)] if f in ("blank", "duplicate") else
               [("D", "", 3), ("K", i, int(f == "truncated")), ("R", "u", 2 + (f == "truncated")), ("R", "a", 2 + (f == "truncated"))]
               for i, f in zip(initials, found)]
    for edits in itertools.product(*choices):
        for ins in itertools.product(gaps, repeat=len(edits) + 1):
            text = "".join(i + e[1] for i, e in zip(ins, edits)) + ins[-1]
            if re.fullmatch("(s?(ua)+)?", text):
                cost = sum(e[2] for e in edits) + 2 * sum(map(len, ins))
                audit = "".join("I" * len(i) + e[0] for i, e in zip(ins, edits)) + "I" * len(ins[-1])
                if best is None or (cost, audit) < best[:2]:
                    best = cost, audit, [(*i, e) for i, e in zip(ins, edits)], ins[-1]
    return best


def cheapest(initials, found):
    """The same by a forward search from the last row over (cost, audit, lines)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    ways = {"": (0, "", ()), "a": (0, "", ()), "s": (4, "II", (("I", "u"), ("I", "a"))), "u": (2, "I", (("I", "a"),))}
    for i, f in zip(reversed(initials), reversed(found)):
        now = {}
        for q in ("", "s", "u", "a"):
            options = [(3 + ways[q][0], "D" + ways[q][1], (("D", ""), *ways[q][2]))]
            if f not in ("blank", "duplicate"):
                for letter, to, cost in [("K", i, 0), ("R", "u", 2), ("R", "a", 2)]:
                    if (q, to) in step:
                        c, audit, lines = ways[step[q, to]]
                        options.append((c + cost + (f == "truncated"), letter + audit, ((letter, to), *lines)))
            now[q] = min(options)
        for _ in range(3):
            for q in now:
                to = "a" if q == "u" else "u"
                c, audit, lines = now[to]
                now[q] = min(now[q], (c + 2, "I" + audit, (("I", to), *lines)))
        ways = now
    return ways[""]


def plain(rows, damage=True):
    """conv_id -> the contract's row."""
    convs, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        role, text, kind = space(role), space(text), zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20 if damage else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in ids:
        own = sorted(convs[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        found, initials = faults(own), [(r[1] or " ")[0] for r in own]
        turns = [r[0] for r in own if r[0] is not None]
        cost, audit, lines = cheapest(initials, found)
        left, said = iter(own), []
        for letter, to in lines:
            row = None if letter == "I" else next(left)
            if letter != "D":
                role = row[1] if letter == "K" else {"u": "user", "a": "assistant"}[to]
                said.append(f"{role}:{row[2] if row else ''}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
                     found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


NAMES = [*C.COUNTS, "audit", "repaired_sha256"]


def as_dict(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def test_walk_equals_every_edit():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(0, 3)
        initials, found = [rng.choice("suax") for _ in range(n)], [rng.choice([None, None, "blank", "duplicate", "truncated"]) for _ in range(n)]
        segment = C.Segment("".join(initials), bytes(C.KINDS[f] for f in found))
        edits, state = segment.walk(C.START, C.CLOSED)
        audit = "".join("I" * len(i) + e for i, e, _ in edits) + "I" * len(C.closing_inserts(state))
        if not n:
            assert audit == ""
            continue
        best = every_edit(initials, found)
        assert audit == best[1] and cheapest(initials, found)[:2] == best[:2]
        m = segment.matrix()
        assert min(m[e] + C.CLOSED[e] for e in range(4)) == best[0]


def test_long_walk_and_checkpoints():
    rng = random.Random(4)
    for n in (1, 2, 3, 50, 997):
        initials, found = [rng.choice("suuaax") for _ in range(n)], [rng.choice([None, None, "blank", "truncated"]) for _ in range(n)]
        edits, state = C.Segment("".join(initials), bytes(C.KINDS[f] for f in found)).walk(C.START, C.CLOSED)
        assert "".join("I" * len(i) + e for i, e, _ in edits) + "I" * len(C.closing_inserts(state)) == cheapest(initials, found)[1]


def odd_conversations():
    rng = random.Random(5)
    texts = ["Hi.", "ok", "", " \n", "Well?", "x!  \n", "Hi.\x85", None, "a\x1fb.", "Fine. And", "Hi." * 3000]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "agent"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles[:2] if c % 3 else roles), rng.choice(texts)) for c in range(60) for _ in range(rng.randint(1, 9))]
    rows += [(100, t, "user" if t % 2 else "assistant", f"Line {t % 40}." if t % 5 else "cut") for t in range(700)]  # spans parts
    rows += [(101, 1, "user", "Same.")] * 300 + [(102, t, "user", "Same.") for t in range(200)] + [(103, None, "user", f"{k}.") for k in range(100)]
    rows += [(None, k, "user" if k % 2 else "system", "Null id.") for k in range(6)] + [(None, None, None, None)] + rows[:5]
    return rows


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_tables_equal_plain(spark, parts):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS copies", "'x' AS digest", "1L AS at", "'y' AS edit", "2 AS of").repartition(5)
    assert as_dict(C.audit_conversations(df, C.damage_rows(df), parts)) == plain(rows)


def test_one_conversation_over_every_part(spark):
    rng = random.Random(6)
    for k in range(2):
        rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"{t}!", f"{t}"])) for t in range(400)]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert as_dict(C.audit_conversations(df, C.damage_rows(df), 23)) == plain(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", "Hello!"), (1, 4, "user", "Bye."), (2, 0, "tool", "x")]
    got = C.repair_conversations(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "at", "place").collect()
    assert [(r.conv_id, r.turn, r.role, r.text, r.edit) for r in got] == [
        (1, 0, "system", "Be kind.", "K"), (1, 1, "user", "Hi.", "K"), (1, 3, "assistant", "Hello!", "K"), (1, 4, "user", "Bye.", "K"),
        (1, None, "assistant", "", "I")]


def test_query_equals_plain(spark):
    from tidewater.llm.registry import QUERIES
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.01")) == plain(rows)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.audit_conversations(empty, C.damage_rows(empty)).count() == 0 and C.repair_conversations(empty).count() == 0
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert as_dict(C.audit_conversations(one, C.damage_rows(one))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert C.damage_rows(one).where(F.col("copies") > 0).count() == 0
