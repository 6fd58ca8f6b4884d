"""Structure repair of conversations by error-correcting Earley parsing.

A conversation should be nothing, or user and assistant turns in alternation, from user to assistant, with one system turn
before them at most.  The grammar of roles has productions for errors: a turn may be kept, reroled to user or assistant or
deleted, and an empty turn inserted, each at its cost; the cheapest parse is the repair, and its edits are the audit
(K, R, D, I; of equally cheap ones, the least in ASCII).

Faults are found first, a turn's first counting: ``blank`` (no character but white space), ``duplicate`` (role and text of
an earlier turn of the conversation) and ``truncated`` (its last character but white space ends no sentence).  Blank and
duplicate turns have to be deleted; truncated ones cost more unless they are.

Duplicates are found by grouping digests, so that a text of many turns is summed before it is shuffled.  Turns then
stream through tasks in order of conversations: the parser holds a letter a turn, and texts pass by row by row, so that long
conversations need no memory for their texts.  All of a conversation goes through one task, as its parse and the hash of its
text are chains.

Defined results for odd input: a null role or text is one space; a null conversation is a conversation of its own; turns
without a number come first, turns of one number go by role, then by the SHA-256 of role and text; a role of no
letter has a space as its initial; roles other than system, user and assistant go by their initial, as they are kept; an
empty table has no rows; conversations without turns are given with zeros; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import earley, scratch
from tidewater.llm.oracles import crc32
from tidewater.llm.text import only

SPACE = " \t\n\x0b\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Adjacent role initials that need no repair.
LEGAL = frozenset(("su", "ua", "au"))


def keep(role: str) -> Callable[[str], int | None]:
    return lambda t: 0 if t == role else TRUNCATED if t == role.upper() else None


def rerole(t: str) -> int | None:
    return None if t in "bd" else TRUNCATED if t.isupper() else 0


#: Tokens: s, u, a and x (any other role), in capitals if truncated; b and d for blank and duplicate turns.
GRAMMAR = earley.Grammar(
    "Conversation",
    {
        "Conversation": [("Nothing",), ("ToAssistant",)],
        "Nothing": [(), ("Nothing", "gone")],
        "ToSystem": [("Nothing", "system"), ("ToSystem", "gone")],
        "ToUser": [("Nothing", "user"), ("ToSystem", "user"), ("ToAssistant", "user"), ("ToUser", "gone")],
        "ToAssistant": [("ToUser", "assistant"), ("ToAssistant", "gone")],
    },
    {
        "system": [("K", keep("s"), 0)],
        "user": [("K", keep("u"), 0), ("R", rerole, REROLE), ("I", None, INSERT)],
        "assistant": [("K", keep("a"), 0), ("R", rerole, REROLE), ("I", None, INSERT)],
        "gone": [("D", lambda _: 0, DELETE)],
    },
)


@lru_cache(1 << 14)
def remembered(tokens: str) -> earley.Value:
    return earley.parse(GRAMMAR, tokens)


def parse(tokens: str) -> earley.Value:
    return remembered(tokens) if len(tokens) <= 32 else earley.parse(GRAMMAR, tokens)


def faulted(rows: DataFrame) -> DataFrame:
    """Turns with ``initial`` and ``token`` (without duplicates), ``same`` (SHA-256 of role and text) and ``uid``; written."""
    rows = only(rows, "conv_id", "turn", "role", "text")
    whole = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    # Function rtrim takes the characters, so that no pattern has to look for the end.
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.coalesce(F.nullif(F.substring("role", 1, 1), F.lit("")), F.lit(" "))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    token = F.when(end == "", F.lit("b")).when(end.isin(*".!?"), kind).otherwise(F.upper(kind))
    same = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return scratch.written(whole.withColumns({"initial": initial, "token": token, "same": same, "uid": F.monotonically_increasing_id()}), "repair-turns")


ORDER = ("conv_id", "first", "turn", "role", "same", "uid")


def streamed(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """Each conversation's head, then its turns in order, all in one task."""
    both = turns.withColumn("first", F.lit(1)).unionByName(heads.withColumn("first", F.lit(0)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*ORDER)


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPORT_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Faults, cost and audit of each of ``conversations`` (conv_id), from faulted() turns."""
    light = turns.select("conv_id", "turn", "role", "same", "uid", "initial", "token")
    first = F.min(F.struct("turn", "uid"))
    again = light.filter("token <> 'b'").groupBy("conv_id", "same").agg(first.alias("kept"), F.count("*").alias("n")).filter("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "kept")
    met = light.join(again, light["conv_id"].eqNullSafe(F.col("c")) & (light["same"] == F.col("s")) & (light["token"] != "b"), "left")
    doubled = F.col("kept").isNotNull() & (F.col("kept.uid") != F.col("uid"))
    met = met.withColumn("token", F.when(doubled, "d").otherwise(F.col("token"))).drop("c", "s", "kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def closed() -> None:
            conv, tokens, illegal, low, high, distinct, _, _ = now
            tokens = tokens.decode()
            cost, audit = parse(tokens)
            n = sum(map(str.isupper, tokens))
            out.append({"conv_id": conv, "gaps": high - low + 1 - distinct if distinct else 0, "blank": tokens.count("b"), "duplicate": tokens.count("d"), "truncated": n, "illegal": illegal, "cost": cost, "audit": audit})

        for batch in batches:
            for first, conv, turn, initial, token in zip(*[batch.column(c).to_pylist() for c in ("first", "conv_id", "turn", "initial", "token")], strict=True):
                if first == 0:
                    if now is not None:
                        closed()
                    now = [conv, bytearray(), 0, None, None, 0, None, None]  # the last two: turn and initial before
                    continue
                now[1] += token.encode()
                if now[7] is not None and now[7] + initial not in LEGAL:
                    now[2] += 1
                if turn is not None and turn != now[6]:
                    now[3], now[4], now[5] = turn if now[3] is None else now[3], turn, now[5] + 1
                now[6], now[7] = turn, initial
            if out:
                yield pa.RecordBatch.from_pylist(out, REPORT_ARROW)
                out = []
        if now is not None:
            closed()
            yield pa.RecordBatch.from_pylist(out, REPORT_ARROW)

    return scratch.written(streamed(met, conversations.select("conv_id").distinct()).mapInArrow(run, REPORT), "repair-report")


REPAIRED = REPORT + ", pos long, turn long, edit string, role string, text string"
REPAIRED_ARROW = pa.schema([*REPORT_ARROW, ("pos", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def edited(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report (pos 0), then its edits in order: turns kept, reroled, deleted (edit D) and inserted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, last = None, "", 0, ""
        for batch in batches:
            out = []

            def inserted() -> None:
                nonlocal at, last
                while at < len(audit) and audit[at] == "I":
                    last = "assistant" if last == "u" else "user"
                    at += 1
                    out.append({"conv_id": conv, "pos": at, "edit": "I", "role": last, "text": ""})
                    last = last[0]

            # Insertions go where the audit has them: after the turn before, and at once after the head.
            for r in batch.to_pylist():
                if r["first"] == 0:
                    conv, audit, at, last = r["conv_id"], r["audit"], 0, ""
                    out.append({c: r[c] for c in REPORT_ARROW.names} | {"pos": 0})
                else:
                    edit, role = audit[at], r["role"]
                    at += 1
                    if edit == "R":
                        role = "assistant" if last == "u" else "user"
                    if edit != "D":
                        last = role[:1]
                    out.append({"conv_id": conv, "pos": at, "turn": r["turn"], "edit": edit, "role": role, "text": r["text"]})
                inserted()
            yield pa.RecordBatch.from_pylist(out, REPAIRED_ARROW)

    rows = turns.select("conv_id", "turn", "role", "same", "uid", "text")
    return streamed(rows, reports).select("first", *REPORT_ARROW.names, "turn", "role", "text").mapInArrow(run, REPAIRED)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """edited() of the turns ``rows`` (conv_id, turn, role, text), with a report for each of ``conversations`` too."""
    turns = faulted(rows)
    return edited(turns, report(turns, turns if conversations is None else conversations))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with known faults, by the CRC-32 of conversation and turn: dropped, emptied, without ends of sentences, doubled or said to be the user's."""
    rows = only(rows, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("fault")).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies: Column = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def digests(out: DataFrame) -> DataFrame:
    """Of edited(): the reports with repaired_sha256, over role, colon and text of what is left, with \\n between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, h, some = None, sha256(), False
        schema = pa.schema([*REPORT_ARROW, ("repaired_sha256", pa.string())])
        for batch in batches:
            done = []
            for i, (pos, edit, role, text) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("pos", "edit", "role", "text")], strict=True)):
                if pos == 0:
                    if head is not None:
                        done.append(head | {"repaired_sha256": h.hexdigest()})
                    head, h, some = batch.slice(i, 1).select(REPORT_ARROW.names).to_pylist()[0], sha256(), False
                elif edit != "D":
                    h.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if head is not None:
            yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": h.hexdigest()}], schema)

    return out.mapInArrow(run, REPORT + ", repaired_sha256 string")


#: The same by dynamic programming over turns and the state of the roles (n: none, s, u, a), the cheapest audit of each state
#: kept; between turns, up to two insertions lead from every state to every other.
ORACLE = f"""
WITH RECURSIVE broken AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault FROM conversations),
kept AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM broken, range(2) c(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS p FROM kept),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, lag(role) OVER (PARTITION BY conv_id ORDER BY p) AS before,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM numbered),
turns AS (
  SELECT *, said = '' AS blank, said <> '' AND again AS duplicate, said <> '' AND NOT again AND said[-1] NOT IN ('.', '!', '?') AS truncated,
    p > 1 AND (coalesce(nullif(before[1], ''), ' ') || coalesce(nullif(role[1], ''), ' ')) NOT IN ('su', 'ua', 'au') AS illegal FROM seen),
steps(state, onto, letter, cost, takes) AS (
  SELECT * FROM (VALUES ('n', 'n', 'D', 4, NULL), ('s', 's', 'D', 4, NULL), ('u', 'u', 'D', 4, NULL), ('a', 'a', 'D', 4, NULL),
    ('n', 'u', 'R', 3, NULL), ('s', 'u', 'R', 3, NULL), ('a', 'u', 'R', 3, NULL), ('u', 'a', 'R', 3, NULL),
    ('n', 's', 'K', 0, 's'), ('n', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('a', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'))),
inserts(state, onto, letters, cost) AS (
  SELECT * FROM (VALUES ('n', 'n', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0),
    ('n', 'u', 'I', 3), ('s', 'u', 'I', 3), ('a', 'u', 'I', 3), ('u', 'a', 'I', 3), ('n', 'a', 'II', 6), ('s', 'a', 'II', 6))),
chart AS (
  SELECT conv_id, 0::BIGINT AS p, i.onto AS state, {{'cost': i.cost::BIGINT, 'audit': i.letters}} AS best
  FROM (SELECT DISTINCT conv_id FROM turns), inserts i WHERE i.state = 'n'
  UNION ALL
  SELECT c.conv_id, t.p, i.onto,
    min({{'cost': (c.best.cost + s.cost + i.cost + CASE WHEN t.truncated AND s.letter <> 'D' THEN 3 ELSE 0 END)::BIGINT, 'audit': c.best.audit || s.letter || i.letters}})
  FROM chart c JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND t.p = c.p + 1
  JOIN steps s ON s.state = c.state AND (s.takes IS NULL OR s.takes = t.role[1]) AND (s.letter = 'D' OR NOT (t.blank OR t.duplicate))
  JOIN inserts i ON i.state = s.onto GROUP BY c.conv_id, t.p, i.onto),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM turns GROUP BY conv_id),
parsed AS (SELECT k.conv_id, min(c.best) AS best FROM counts k JOIN chart c ON c.conv_id IS NOT DISTINCT FROM k.conv_id AND c.p = k.n WHERE c.state IN ('n', 'a') GROUP BY k.conv_id),
edits AS (SELECT conv_id, i, best.audit[i] AS e, length(replace(best.audit[:i], 'I', '')) AS p FROM parsed, LATERAL (SELECT unnest(range(1, length(best.audit) + 1)) AS i)),
outs AS (
  SELECT e.conv_id, e.i, e.e, t.role, CASE WHEN e.e = 'I' THEN '' ELSE t.text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.i) AS o,
    first_value(e.e = 'K' AND t.role[1] = 's') OVER (PARTITION BY e.conv_id ORDER BY e.i) AS led
  FROM edits e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.p = e.p WHERE e.e <> 'D'),
fixed AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS body FROM outs GROUP BY conv_id)
SELECT a.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated, coalesce(k.illegal, 0) AS illegal,
  coalesce(d.best.cost, 0) AS cost, coalesce(d.best.audit, '') AS audit, sha256(coalesce(f.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts k ON a.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN parsed d ON a.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN fixed f ON a.conv_id IS NOT DISTINCT FROM f.conv_id
"""
