"""Operator 11: conversation structure repair by depth-first branch-and-bound.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.  Edits of its rows in order: Keep (0), Rerole to user or
assistant (1), Delete (2), Insert an empty user or assistant row anywhere (5); blank and duplicate rows must be deleted and a
truncated row that stays adds 5.  The repair is the cheapest edit sequence; of equally cheap ones that with the ASCII-least audit,
the string of the edits' initials.  In every state only one role may follow, so an audit fixes its repair.

Search.  ``repair_segment`` walks edit sequences depth first on an explicit stack.  A backward pass gives every suffix a lower bound
for each state; the best complete (cost, audit) so far is the incumbent; a prefix
is cut when its cost and bound exceed the incumbent, or equal it with a larger audit, or when the table of its node (row, state)
holds a prefix that is no worse.  When the stack is empty, optimality is proved.

On Spark.  Faults and counts are joins and aggregates over narrow rows (initial of the role and md5 of the text, never the text).
Copies of a row are one narrow row with a count.  The narrow rows are range-partitioned by (conversation, place), so a conversation
that holds a third of all rows spans many ranges; a range solves whole conversations at once, and the pieces of those that may go on
in a neighbouring range, at most ``piece`` rows each, for every pair of entry and exit states.  At the end, one streaming
pass over rows in order joins the pieces' states and applies the edits; it holds one audit and one batch of rows.
Only that pass reads the text from a shuffle: a conversation's digest is one sha256 and cannot be split.

Defined cases: rows are ordered by turn (nulls first), then role, then md5 of the text; null conversation ids are one conversation;
a null role or text is one space; a role that is empty or has another initial is never legal as it stands;
repeated rows are duplicates of the first; conversations without rows have cost 0 and an empty audit; an empty table gives no rows.
Only the four named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import BLANKS

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL_END = (START, ASSISTANT)
RANGE_ROWS = 20_000
PIECE = 1_000
# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5


def follow(state: int, initial: str) -> int | None:
    """State after a row with that initial; None where it is not legal."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def due(state: int) -> int:
    """State after the row that Rerole and Insert give: the only one of user and assistant that may follow."""
    return ASSISTANT if state == USER else USER


def suffix_bounds(rows, exits) -> list[list[float]]:
    """Least cost of rows i.. from every state; infinite where no edits lead to an exit."""
    def inserted(costs):
        user, assistant = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
        return [min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant]

    bounds = [inserted([0 if state in exits else math.inf for state in range(4)])]
    for initial, gone, cut, copies in reversed(rows):
        after, stay = bounds[-1], TRUNCATED if cut else 0
        costs = [DELETE + b for b in after]
        if not gone:
            for state in range(4):
                kept = follow(state, initial)
                costs[state] = min(costs[state], stay + REROLE + after[due(state)], math.inf if kept is None else stay + after[kept])
        bounds.append(inserted([c + DELETE * (copies - 1) for c in costs]))
    return bounds[::-1]


def repair_segment(rows, entry: int = START, exits=LEGAL_END) -> tuple[int, str] | None:
    """Cheapest (cost, audit) from state ``entry`` to one of ``exits``, None if there is none.

    Rows are (initial of the role, must be deleted, truncated, copies); copies after the first are deleted.
    """
    n, bounds = len(rows), suffix_bounds(rows, exits)
    best: tuple[float, str] = (math.inf, "")
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bounds[i][state]
        if least > best[0] or least == math.inf or (least == best[0] and audit > best[1][:len(audit)]):
            continue
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[i, state] = (cost, audit)
        if i == n and state in exits and (cost, audit) < best:
            best = (cost, audit)
        nodes = [(i, due(state), cost + INSERT, audit + "I")]
        if i < n:
            initial, gone, cut, copies = rows[i]
            more, rest = DELETE * (copies - 1), "D" * (copies - 1)
            nodes.append((i + 1, state, cost + DELETE + more, f"{audit}D{rest}"))
            if not gone:
                stay = cost + more + (TRUNCATED if cut else 0)
                kept = follow(state, initial)
                if kept is not None:
                    nodes.append((i + 1, kept, stay, f"{audit}K{rest}"))
                nodes.append((i + 1, due(state), stay + REROLE, f"{audit}R{rest}"))
        # the most promising node is taken first, the smaller audit first among equals
        nodes.sort(key=lambda node: (node[2] + bounds[node[0]][node[1]], node[3]), reverse=True)
        stack += nodes
    return None if best[0] == math.inf else best


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _conv(kind: str) -> Column:
    """The conversation id of a key."""
    return F.when(F.col("k") != "", F.expr("substring(k, 2)").cast(kind)).alias("conv_id")


def damage(chats: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` decides; nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = chats.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Narrow rows (k, turn, role, h, copies, blank, cut, dup): equal rows of a conversation once, with their number."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    flat = rows.select(_key(F.col("conv_id")).alias("k"), F.col("turn").cast("long").alias("turn"), "role", F.md5("text").alias("h"),
                       (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))
    each = flat.groupBy("k", "turn", "role", "h").agg(F.count(F.lit(1)).alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = flat.groupBy("k", "role", "h").agg(F.min(place).alias("first"))
    return each.join(first, ["k", "role", "h"]).select("k", "turn", "role", "h", "copies", "blank", "cut", (place != F.col("first")).alias("dup"))


SEGMENT = ("k string, part int, no int, entry int, leave int, cost long, audit string, "
           "n_blank long, n_dup long, n_cut long")
WHOLE = -1  # stands for "any legal end"


def _solve(piece: int):
    """Segments of the conversations of one range."""
    def segments(key, part, no, rows, counts, whole):
        if whole:
            yield (key, part, no, START, WHOLE, *repair_segment(rows), *counts)
            return
        for entry in range(4):
            for leave in range(4):
                found = repair_segment(rows, entry, (leave,))
                if found:
                    yield (key, part, no, entry, leave, *found, *counts)
                    counts = (0, 0, 0)  # once a segment

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        out, rows, counts, key, no, inside = [], [], [0, 0, 0], None, 0, False
        for pdf in batches:
            for k, role, copies, blank, cut, dup in zip(pdf["k"], pdf["role"], pdf["copies"], pdf["blank"], pdf["cut"], pdf["dup"]):
                if k != key or len(rows) >= piece:
                    if rows:
                        out += segments(key, part, no, rows, counts, k != key and inside and no == 0)
                    inside, no = (key is not None, 0) if k != key else (inside, no + 1)
                    key, rows, counts = k, [], [0, 0, 0]
                rows.append((role[:1], bool(blank or dup), bool(cut), int(copies)))
                if blank:
                    counts[0] += copies
                else:
                    counts[1] += copies - 1 + dup
                    counts[2] += cut and not dup
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if rows:  # the range's last conversation may go on in the next one
            yield pd.DataFrame(list(segments(key, part, no, rows, counts, False)), columns=names)
    return run


def _walk(batches):
    """Repaired rows in order, (key, place, turn, edit, role, text), and after each conversation (key, its figures)."""
    def legal(states):
        return min(states[s] for s in LEGAL_END if s in states)

    conv = None

    class State:
        def __init__(self, k):
            self.k, self.ways, self.next, self.at = k, {START: (0, "")}, {}, None
            self.counts, self.audit, self.p, self.state, self.place = [0, 0, 0], None, 0, START, 0
            self.turns, self.low, self.high, self.last_turn, self.illegal, self.initial = 0, None, None, None, 0, None

        def segment(self, at, entry, leave, cost, audit, counts):
            if at != self.at:
                self.close()
                self.at = at
            self.counts = [a + b for a, b in zip(self.counts, counts)]
            if entry in self.ways:
                way = (self.ways[entry][0] + cost, self.ways[entry][1] + audit)
                leave = ASSISTANT if leave == WHOLE else leave
                if leave not in self.next or way < self.next[leave]:
                    self.next[leave] = way

        def close(self):
            if self.at is not None:
                self.ways, self.next = self.next, {}

        def solved(self):
            if self.audit is None:
                self.close()
                self.cost, self.audit = legal(self.ways)

        def inserts(self):
            while self.audit[self.p:self.p + 1] == "I":
                yield self.put(None, "I", None, "")

        def put(self, turn, edit, role, text):
            after = follow(self.state, role[:1]) if edit == "K" else due(self.state)
            if edit != "K":
                role = "assistant" if after == ASSISTANT else "user"
            self.state, self.p, self.place = after, self.p + 1, self.place + 1
            return self.k, self.place, turn, edit, role, text

        def row(self, turn, role, text):
            self.solved()
            if turn is not None:
                if turn != self.last_turn:
                    self.turns, self.last_turn, self.high = self.turns + 1, turn, turn
                if self.low is None:
                    self.low = turn
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = role[:1]
            yield from self.inserts()
            edit = self.audit[self.p]
            if edit == "D":
                self.p += 1
            else:
                yield self.put(turn, edit, role, text)

        def end(self):
            self.solved()
            yield from self.inserts()
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            yield self.k, (gaps, *self.counts, self.illegal, self.cost, self.audit)

    for pdf in batches:
        for k, kind, part, no, entry, leave, cost, audit, nb, nd, nc, turn, role, text in zip(
                pdf["k"], pdf["kind"], pdf["part"], pdf["no"], pdf["entry"], pdf["leave"], pdf["cost"], pdf["audit"],
                pdf["n_blank"], pdf["n_dup"], pdf["n_cut"], pdf["turn"], pdf["role"], pdf["text"]):
            if conv is None or k != conv.k:
                if conv is not None:
                    yield from conv.end()
                conv = State(k)
            if kind == 1:
                conv.segment((part, no), entry, leave, int(cost), audit, (int(nb), int(nd), int(nc)))
            elif kind == 2:
                yield from conv.row(None if turn is None else int(turn), role, text)
    if conv is not None:
        yield from conv.end()


def _ordered(rows: DataFrame, convs: DataFrame, piece: int, range_rows: int) -> DataFrame:
    """Per conversation, in one partition: a mark, its solved segments, then its rows in order; turns as strings, which pandas
    keeps exact beside nulls."""
    spark = rows.sparkSession
    parts = max(1, min(math.ceil(rows.count() / range_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = ["k", "turn", "role", "h"]
    solved = (faults(rows).repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("k", "role", "copies", "blank", "cut", "dup").mapInPandas(_solve(piece), SEGMENT))
    ids = convs.select(_key(F.col("conv_id")).alias("k")).distinct().withColumn("kind", F.lit(0))
    texts = rows.select(_key(F.col("conv_id")).alias("k"), F.lit(2).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", F.md5("text").alias("h"), "text")
    every = (ids.unionByName(solved.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
             .fillna(0, ["part", "no", "entry", "leave", "cost", "n_blank", "n_dup", "n_cut"]))
    return every.repartition("k").sortWithinPartitions("k", "kind", "part", "no", "turn", "role", "h").drop("h").withColumn("turn", F.col("turn").cast("string"))


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_report(rows: DataFrame, convs: DataFrame | None = None, piece: int = PIECE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``rows`` are (conv_id, turn, role, text); ``convs`` names conversations that may have no rows.  The digest is of ``role:text`` of
    the repaired rows, joined by line feeds.
    """
    convs = rows if convs is None else convs

    def run(batches):
        out, sha = [], hashlib.sha256()
        for event in _walk(batches):
            if len(event) > 2:
                sha.update((("\n" if event[1] > 1 else "") + f"{event[4]}:{event[5]}").encode())
            else:
                out.append((event[0], *event[1], sha.hexdigest()))
                sha = hashlib.sha256()
                if len(out) == 1_000:
                    yield pd.DataFrame(out, columns=["k", *REPORT, "audit", "repaired_sha256"])
                    out = []
        yield pd.DataFrame(out, columns=["k", *REPORT, "audit", "repaired_sha256"])

    schema = f"k string, {', '.join(f'{c} long' for c in REPORT)}, audit string, repaired_sha256 string"
    out = _ordered(rows, convs, piece, range_rows).mapInPandas(run, schema)
    return out.select(_conv(dict(convs.dtypes)["conv_id"]), *REPORT, "audit", "repaired_sha256")


def repaired_rows(rows: DataFrame, piece: int = PIECE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The repaired conversations: (conv_id, place, turn, edit, role, text); inserted rows have no turn."""
    names = ["k", "place", "turn", "edit", "role", "text"]

    def frame(out):
        return pd.DataFrame(out, columns=names).astype({"turn": "Int64"})

    def run(batches):
        out, size = [], 0
        for event in _walk(batches):
            if len(event) > 2:
                out.append(event)
                size += len(event[5])
                if len(out) == 1_000 or size > 1 << 22:
                    yield frame(out)
                    out, size = [], 0
        yield frame(out)

    out = _ordered(rows, rows, piece, range_rows).mapInPandas(run, "k string, place long, turn long, edit string, role string, text string")
    return out.select(_conv(dict(rows.dtypes)["conv_id"]), *names[1:])


def _step(way: str, cost: str, letter: str, line: str | None) -> str:
    """SQL: a way (cost in 9 digits, audit, bar, repaired lines) with one more edit; null stays null."""
    head = f"printf('%09d', cast({way}[1:9] AS integer) + {cost}) || {way}[10:instr({way}, '|') - 1] || {letter} || '|'"
    text = f"{way}[instr({way}, '|') + 1:]"
    if line is None:
        return f"({head} || {text})"
    return f"({head} || CASE WHEN instr({way}, '|') = length({way}) THEN '' ELSE {text} || chr(10) END || {line})"


def _oracle() -> str:
    """DuckDB: damage and faults, then the best way to every state, row by row."""
    bits = "flatten(list_transform(string_split(key, ''), lambda c: [cast(ascii(c) AS bigint), 0, 0, 0, 0, 0, 0, 0]))"
    crc = ("xor(list_reduce(list_concat([4294967295::bigint], " + bits + "), lambda x, b: xor(xor(x, b) >> 1, "
           "CASE WHEN xor(x, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")
    stay = "(CASE WHEN r.cut THEN 5 ELSE 0 END)"
    line, gone = "r.role || ':' || r.text", "(r.blank OR r.dup)"

    def least(*ways):
        return f"least({', '.join(ways)})"

    def keep(way, initial):
        return f"CASE WHEN NOT {gone} AND r.role[1:1] = '{initial}' THEN {_step(way, stay, chr(39) + 'K' + chr(39), line)} END"

    def rerole(way, role):
        return f"CASE WHEN NOT {gone} THEN {_step(way, f'({stay} + 1)', chr(39) + 'R' + chr(39), f'{chr(39)}{role}:{chr(39)} || r.text')} END"

    def delete(way):
        return _step(way, "2", "'D'", None)

    def insert(way, role):
        return _step(way, "5", "'I'", f"'{role}:'")

    empty = "'000000000|'"
    # a repaired text may be empty only before the first line, so an empty rest after the bar means no line yet
    return f"""WITH RECURSIVE k AS (SELECT *, coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS key
  FROM conversations),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
  NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS c0,
  lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) || role[1:1] AS pair FROM d),
r AS (SELECT *, NOT blank AND seen AS dup, NOT blank AND NOT seen AND c0 AS cut FROM o),
w AS (SELECT DISTINCT conv_id, 0::bigint AS i, {empty} AS s0, NULL::varchar AS s1, {insert(empty, 'user')} AS s2,
    {insert(insert(empty, 'user'), 'assistant')} AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, least(s3, {insert('s2', 'assistant')}) FROM (
    SELECT conv_id, i, s0, s1, least(s2, {insert('s0', 'user')}, {insert('s1', 'user')}, {insert('s3', 'user')}) AS s2, s3 FROM (
      SELECT r.conv_id, r.i, {delete('w.s0')} AS s0, {least(delete('w.s1'), keep('w.s0', 's'))} AS s1,
        {least(delete('w.s2'), *[f(f'w.s{s}', v) for s in (0, 1, 3) for f, v in ((keep, 'u'), (rerole, 'user'))])} AS s2,
        {least(delete('w.s3'), keep('w.s2', 'a'), rerole('w.s2', 'assistant'))} AS s3
      FROM w JOIN r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))),
best AS (SELECT conv_id, arg_max(least(s0, s3), i) AS way FROM w GROUP BY conv_id),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::int) AS blank, sum(dup::int) AS duplicate,
  sum(cut::int) AS truncated, sum((pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au'))::int) AS illegal FROM r GROUP BY conv_id)
SELECT best.conv_id, cast(coalesce(gaps, 0) AS bigint) AS gaps, cast(coalesce(blank, 0) AS bigint) AS blank,
  cast(coalesce(duplicate, 0) AS bigint) AS duplicate, cast(coalesce(truncated, 0) AS bigint) AS truncated,
  cast(coalesce(illegal, 0) AS bigint) AS illegal, cast(way[1:9] AS bigint) AS cost, way[10:instr(way, '|') - 1] AS audit,
  sha256(way[instr(way, '|') + 1:]) AS repaired_sha256
FROM best LEFT JOIN n ON best.conv_id IS NOT DISTINCT FROM n.conv_id"""


ORACLE = _oracle()
