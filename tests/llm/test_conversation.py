"""Conversation repair against an exhaustive shortest path over (row, state), written from the contract alone."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import conversation as op11

BLANK = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def flagged(rows):
    """(role, text, blank, dup, cut) of one conversation's rows, in order."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(BLANK)
        blank, dup = not end, (role, text) in seen
        seen.add((role, text))
        out.append((role, text, blank, not blank and dup, not blank and not dup and end[-1] not in ".!?"))
    return rows, out


def brute_repair(flags):
    """Cheapest (cost, audit, repaired): relaxed to a fixed point, without bounds, tables or a stack."""
    nexts = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    ways = {"": (0, "", ())}
    for i in range(len(flags) + 1):
        for _ in range(3):  # inserts
            for state, (c, audit, text) in list(ways.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in nexts:
                        way = (c + 5, audit + "I", text + (f"{role}:",))
                        ways[letter] = min(ways.get(letter, way), way)
        if i == len(flags):
            return min(ways[s] for s in ("", "a") if s in ways)
        role, body, blank, dup, cut = flags[i]
        after = {}
        for state, (c, audit, text) in ways.items():
            options = [(state, (c + 2, audit + "D", text))]
            if not (blank or dup):
                extra = 5 if cut else 0
                if (state, role[:1]) in nexts:
                    options.append((nexts[state, role[:1]], (c + extra, audit + "K", text + (f"{role}:{body}",))))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in nexts:
                        options.append((letter, (c + 1 + extra, audit + "R", text + (f"{name}:{body}",))))
            for s, way in options:
                after[s] = min(after.get(s, way), way)
        ways = after


def brute_report(original):
    out = {}
    rows = damaged(original)
    for conv in {r[0] for r in original}:
        mine, flags = flagged([r for r in rows if r[0] == conv])
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, text = brute_repair(flags)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, sum(f[2] for f in flags), sum(f[3] for f in flags),
                     sum(f[4] for f in flags), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def some_rows(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "no", " \n", "", None, "Why?", "ok!\t ", "dots . . .", " ", "é"]
    rows = [(conv, rng.choice([None, *range(n + 2)]) if rng.random() < 0.2 else i, rng.choice(roles) if rng.random() < 0.4 else roles[i % 2],
             rng.choice(texts) if rng.random() < 0.5 else f"text {i}.") for i in range(n)]
    return rows + [rng.choice(rows) for _ in range(rng.randrange(3))] if rows else []


def test_search_is_optimal_for_all_short_sequences():
    rng = random.Random(1)
    cases = [[(rng.choice("ssuuaax") if rng.random() < 0.9 else "", rng.random() < 0.2, rng.random() < 0.25, rng.choice([1, 1, 1, 2, 3]))
              for _ in range(rng.randrange(9))] for _ in range(1500)]
    for rows in cases:
        flags = []
        for initial, gone, cut, copies in rows:
            role = {"s": "system", "u": "user", "a": "assistant", "x": "x", "": ""}[initial]
            flags += [(role, "t", gone, False, cut)] + [(role, "t", True, False, False)] * (copies - 1)
        assert op11.repair_segment(rows) == brute_repair(flags)[:2]


def test_search_states_and_legal_results():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(rng.choice("sua"), rng.random() < 0.1, rng.random() < 0.1, 1) for _ in range(rng.randrange(7))]
        cut = rng.randrange(len(rows) + 1)
        joined = []
        for mid in range(4):  # two pieces joined by states give the whole
            one, two = op11.repair_segment(rows[:cut], 0, (mid,)), op11.repair_segment(rows[cut:], mid)
            if one and two:
                joined.append((one[0] + two[0], one[1] + two[1]))
        assert min(joined) == op11.repair_segment(rows)
    assert op11.repair_segment([], 0, (1,)) is None  # no edit inserts a system row
    assert op11.repair_segment([], op11.USER) == (5, "I") and op11.repair_segment([], 0, (op11.ASSISTANT,)) == (10, "II")


def test_search_stays_small_on_long_pieces():
    rng = random.Random(3)
    for alphabet in ("s", "u", "a", "us", "sua", "x"):
        rows = [(rng.choice(alphabet), rng.random() < 0.2, rng.random() < 0.3, 1) for _ in range(1000)]
        flags = [({"s": "s", "u": "user", "a": "assistant", "x": "x"}[r], "t", gone, False, cut) for r, gone, cut, _ in rows]
        assert op11.repair_segment(rows) == brute_repair(flags)[:2]
        for entry in range(4):
            for leave in range(4):
                op11.repair_segment(rows, entry, (leave,))


@pytest.mark.parametrize("piece, range_rows", [(1000, 20_000), (3, 7), (1, 1)])
def test_report_matches_brute_force(spark, piece, range_rows):
    rng = random.Random(4)
    rows = [r for conv in range(60) for r in some_rows(rng, conv, rng.choice([1, 2, 3, 5, 8]))]
    rows += [((1 << 62) + 1, (1 << 60) + 1 + 2 * t, r, "Big ids.") for t, r in enumerate(["user", "assistant"])]
    rows += some_rows(rng, None, 6) + some_rows(rng, 1000, 250) + [(2000, 5, "user", "Same.")] * 90 + [(3000, None, None, None)] * 3
    rows += [(c, t, "user", "x.") for c in range(5000, 5200) for t in (0,) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]  # nothing is left
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("k", "kind", "part", "no", "audit", "copies", "cid", "h"):
        chats = chats.withColumn(name, F.lit("clash"))
    got = op11.repair_report(op11.damage(chats), chats, piece, range_rows).collect()
    want = brute_report(rows)
    assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want
    assert any(not a[6] for a in want.values()) and {"R", "D", "K"} <= set("".join(a[6] for a in want.values()))


def test_repaired_rows_are_legal_and_match_the_digest(spark):
    rng = random.Random(6)
    rows = [r for conv in range(40) for r in some_rows(rng, conv, rng.choice([2, 4, 7]))]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    broken = op11.damage(chats).cache()
    digests = {r["conv_id"]: r["repaired_sha256"] for r in op11.repair_report(broken, chats, 2, 5).collect()}
    repaired = {}
    for r in sorted(op11.repaired_rows(broken, 2, 5).collect(), key=lambda r: (r["conv_id"], r["place"])):
        repaired.setdefault(r["conv_id"], []).append(r)
    for conv, digest in digests.items():
        mine = repaired.get(conv, [])
        assert [r["place"] for r in mine] == list(range(1, len(mine) + 1))
        assert LEGAL.fullmatch("".join(r["role"][0] for r in mine))
        assert all((r["turn"] is None) or r["edit"] != "I" for r in mine)
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in mine).encode()).hexdigest() == digest
    broken.unpersist()


def test_empty_table(spark):
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op11.repair_report(op11.damage(chats), chats).count() == 0
    assert op11.repaired_rows(chats).count() == 0
