"""Conversation structure repair (operator 11): the cheapest edits that make a conversation well formed.

A conversation's roles, by their first letters, must read ``(s?(ua)+)?``: an
optional system row, then user and assistant in turn.  Edits and costs: K keep
0, R give the role that fits (user or assistant) 1, D delete 2, I insert an empty
row of the role that fits 5; a truncated row that is not deleted adds 5; blank
and duplicate rows must go.  Of the cheapest edit strings the ASCII-least is
taken, which makes the result unique.

Method: *square-root checkpointed DP*.  The automaton has four states; a walk
over the rows from the last to the first carries the cost vector "cheapest way to
finish from each state".  Only the vectors at checkpoints are stored: blocks
grow by one row each, counted from the end, so that a conversation of n rows has
about sqrt(2n) checkpoints and no block is longer.  The walk forward holds one
block at a time, recomputes its vectors from the checkpoint behind it, and
takes at each step the ASCII-least edit that is tight (its cost plus the vector's
entry equals what is left).

On Spark this is one shuffle, by conversation.  Faults come from window
functions in that partitioning; the rows are then sorted backward, streamed
(`mapInArrow`), sorted forward in place, and streamed again: a task holds a block
of rows, never a conversation.  The rows of one conversation pass through one
task, in order, as the digest of its whole text demands.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.llm.common import map_rows, table

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the last role of what is repaired so far
FITTING = (USER, USER, ASSISTANT, USER)  # the state that a rerole or an insert leads to
NAMES = {USER: "user", ASSISTANT: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)  # what is left to pay behind the last row, by state: the inserts that complete it
FAULTS = ("blank", "duplicate", "truncated")


def kept_state(state: int, initial: str) -> int:
    """The state that a kept row of this initial leads to, -1 if it does not fit."""
    if initial == "s":
        return SYSTEM if state == START else -1
    if initial == "u":
        return USER if state != USER else -1
    return ASSISTANT if initial == "a" and state == USER else -1


def edits_of(state: int, initial: str, fault: str | None) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that take a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if fault in ("blank", "duplicate"):
        return out
    more = TRUNCATED if fault == "truncated" else 0
    if (to := kept_state(state, initial)) >= 0:
        out.append(("K", KEEP + more, to))
    out.append(("R", REROLE + more, FITTING[state]))
    return out


def inserted(costs: list[int]) -> tuple[int, ...]:
    """The vector with inserts allowed first; two in a row reach every state that inserts reach."""
    once = [min(c, INSERT + costs[FITTING[q]]) for q, c in enumerate(costs)]
    return tuple(min(c, INSERT + once[FITTING[q]]) for q, c in enumerate(once))


_steps: dict[tuple[str, str | None], list] = {(i, f): [edits_of(q, i, f) for q in range(4)] for i in ("s", "u", "a", "") for f in (None, *FAULTS)}


def back(costs: tuple[int, ...], initial: str, fault: str | None) -> tuple[int, ...]:
    """The vector before a row, from the vector behind it."""
    return inserted([min(cost + costs[to] for _, cost, to in edits) for edits in _steps[initial, fault]])


def walk(block: list[tuple[str, str | None]], behind: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """The edits of a block's rows (one string a row, inserts first; one more for inserts behind the ``last`` block) and the state behind."""
    vectors = [behind]
    for initial, fault in reversed(block):
        vectors.append(back(vectors[-1], initial, fault))
    out, here = [], []
    for initial, fault in block:
        left, after = vectors.pop(), vectors[-1]
        while True:
            # D before I before K before R, of those that are tight
            tight = [(e, to) for e, cost, to in _steps[initial, fault][state] if cost + after[to] == left[state]]
            if INSERT + left[FITTING[state]] == left[state] and not (tight and tight[0][0] == "D"):
                here.append("I")
                state = FITTING[state]
                continue
            edit, state = tight[0]
            here.append(edit)
            break
        out.append("".join(here))
        here = []
    if last:
        while END[state]:
            here.append("I")
            state = FITTING[state]
        out.append("".join(here))
    return out, state


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after the damage of the query; a dropped row stays, marked ``gone``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    code = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (code == 0).alias("gone"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _faults(text: Column, nth: Column) -> Column:
    end = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    return F.when(end == "", FAULTS[0]).when(nth > 1, FAULTS[1]).when(~end.isin(".", "!", "?"), FAULTS[2])


def _edit_stream(rows: DataFrame) -> DataFrame:
    """The edits of every conversation, in order within the partitions: one row an edit, and one (no edit) for a row that is ``gone``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    same = W.partitionBy("conv_id", "gone", "role", F.xxhash64("text"), "text").orderBy("turn")  # the hash first: cheap to sort by
    placed = W.partitionBy("conv_id").orderBy("gone", *order)
    rows = rows.withColumn("fault", _faults(F.col("text"), F.row_number().over(same))).withColumn("pos", F.row_number().over(placed).cast("long"))

    def backward(slices):
        """Adds to each row its place from the end and, where a block ends, the vector behind it."""
        conv, costs, place, mark, size = object(), END, 0, 0, 0
        for c in slices:
            from_end, behind = [], []
            for k, gone, role, fault in zip(c["conv_id"], c["gone"], c["role"], c["fault"], strict=True):
                if k != conv:
                    conv, costs, place, mark, size = k, END, 0, 0, 0
                if gone:
                    from_end.append(None)
                    behind.append(None)
                    continue
                from_end.append(place)
                behind.append(list(costs) if place == mark else None)
                if place == mark:
                    size += 1
                    mark += size
                costs = back(costs, role[:1] if role[:1] in ("s", "u", "a") else "", fault)
                place += 1
            yield c | {"from_end": from_end, "behind": behind}

    columns = f"conv_id {kind}, turn long, role string, text string, gone boolean, fault string, pos long"
    marked = map_rows(rows.sortWithinPartitions("conv_id", F.desc("gone"), F.desc("pos")), backward, f"{columns}, from_end long, behind array<long>")

    def forward(slices):
        """Holds the rows of one block, then walks it."""
        conv, state, step, block = object(), START, 0, []
        names = ("conv_id", "step", "edit", "turn", "was", "role", "text", "fault")
        for c in slices:
            out = {x: [] for x in names}

            def put(*values, out=out):
                for x, v in zip(names, values, strict=True):
                    out[x].append(v)

            for k, turn, role, text, gone, fault, from_end, behind in zip(*(c[x] for x in ("conv_id", "turn", "role", "text", "gone", "fault", "from_end", "behind")), strict=True):
                if k != conv:
                    conv, state, step, block = k, START, 0, []
                if gone:
                    put(k, None, None, turn, None, None, None, None)
                    continue
                block.append((turn, role, text, fault))
                if behind is None:
                    continue
                at = state
                tokens, state = walk([(r[:1] if r[:1] in ("s", "u", "a") else "", f) for _, r, _, f in block], tuple(behind), state, from_end == 0)
                for token, row in zip(tokens, [*block, None] if from_end == 0 else block, strict=True):
                    for edit in token:
                        if edit == "I":
                            at = FITTING[at]
                            put(k, step, edit, None, None, NAMES[at], "", None)
                        else:
                            turn_, was, text_, fault_ = row
                            if edit != "D":
                                at = kept_state(at, was[:1]) if edit == "K" else FITTING[at]
                            now = None if edit == "D" else was if edit == "K" else NAMES[at]
                            put(k, step, edit, turn_, was, now, text_, fault_)
                        step += 1
                block = []
            yield out

    ordered = marked.sortWithinPartitions("conv_id", "gone", "pos")
    return map_rows(ordered, forward, f"conv_id {kind}, step long, edit string, turn long, was string, role string, text string, fault string")


def repair(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """conv_id, step, edit, turn, was, role, text, fault: the edits of each conversation, one a row, from step 0.

    ``rows``: conv_id, turn, role, text; ``gone`` names a column that marks rows that
    are none (of `damage`: "gone").  ``was`` is the role before, ``role`` the repaired one (null: deleted);
    the repaired conversation is what is not deleted, by step.  Rows are taken by
    turn, nulls first, rows of one turn by role and text.  Rows without a conv_id
    are one conversation.  Null roles and texts read as one space; a role whose
    first letter is none of s, u, a fits nowhere.  Other columns are not read."""
    return _edit_stream(_whole(rows, gone)).filter("edit is not null")


def _whole(rows: DataFrame, gone: str | None) -> DataFrame:
    space = F.lit(" ")
    mark = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), mark.alias("gone"))


def summaries(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """One row for each conv_id of ``rows`` (as for `repair`; one whose rows are all gone has zeros and empty strings).

    gaps: turns missing between the least and the greatest (null turns aside);
    blank, duplicate, truncated: rows by their first fault; illegal: neighbours
    whose role initials are not su, ua or au; cost and audit: the edits; repaired_sha256:
    the repaired rows as ``role:text``, joined by newlines."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    prices = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def fold(slices):
        conv, n, turns, before, audit, digest, lines = object(), None, None, None, None, None, 0

        def summary():
            least, most, distinct = turns
            n["gaps"] = 0 if least is None else most - least + 1 - distinct
            return {"conv_id": conv, **n, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        done: list[dict] = []
        for c in slices:
            for k, edit, turn, was, role, text, fault in zip(*(c[x] for x in ("conv_id", "edit", "turn", "was", "role", "text", "fault")), strict=True):
                if k != conv:
                    if n is not None:
                        done.append(summary())
                    conv, n, turns, before, audit, digest, lines = k, dict.fromkeys(counts, 0), (None, None, 0), None, [], hashlib.sha256(), 0
                if edit is None:
                    continue
                audit.append(edit)
                n["cost"] += prices[edit] + (TRUNCATED if fault == "truncated" and edit in "KR" else 0)
                if edit != "I":
                    if turn is not None and turn != turns[1]:  # rows come by turn
                        turns = (turn if turns[0] is None else turns[0], turn, turns[2] + 1)
                    if fault is not None:
                        n[fault] += 1
                    if before is not None and before + was[:1] not in ("su", "ua", "au"):
                        n["illegal"] += 1
                    before = was[:1]
                if edit != "D":
                    digest.update((("\n" if lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                    lines += 1
            if done:
                yield {x: [d[x] for d in done] for x in ("conv_id", *counts, "audit", "repaired_sha256")}
                done = []
        if n is not None:
            done = [summary()]
            yield {x: [d[x] for d in done] for x in ("conv_id", *counts, "audit", "repaired_sha256")}

    return map_rows(_edit_stream(_whole(rows, gone)), fold, f"conv_id {kind}, {', '.join(f'{x} long' for x in counts)}, audit string, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(damage(table(spark, sf_dir, "conversations")), gone="gone")


def oracle() -> str:
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    crc = f"""xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split({key}, ''), lambda ch: [ord(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end), 4294967295::bigint)"""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    taken = "case when fault in ('blank', 'duplicate') then 1000000 when fault = 'truncated' then 5 else 0 end"
    fit = "[3, 3, 4, 3]"
    keep = "case when ini = 's' and q = 1 then 2 when ini = 'u' and q <> 3 then 3 when ini = 'a' and q = 3 then 4 else 5 end"
    return f"""
WITH RECURSIVE
coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS code FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE code <> 0)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         right(rtrim(text, {blanks}), 1) AS ending, left(role, 1) AS ini
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
rows AS MATERIALIZED (SELECT *, {taken} AS more FROM faulty),
bw AS (
  SELECT DISTINCT conv_id, n + 1 AS i, 0::bigint AS v1, 10::bigint AS v2, 5::bigint AS v3, 0::bigint AS v4 FROM rows
  UNION ALL
  SELECT conv_id, i, least(o1, 5 + o3), least(o2, 5 + o3), least(o3, 5 + o4), least(o4, 5 + o3)
  FROM (SELECT conv_id, i, least(w1, 5 + w3) AS o1, least(w2, 5 + w3) AS o2, least(w3, 5 + w4) AS o3, least(w4, 5 + w3) AS o4
        FROM (SELECT bw.conv_id, bw.i - 1 AS i,
                     least(2 + v1, more + CASE ini WHEN 's' THEN v2 WHEN 'u' THEN v3 ELSE 1000000 END, more + 1 + v3) AS w1,
                     least(2 + v2, more + CASE ini WHEN 'u' THEN v3 ELSE 1000000 END, more + 1 + v3) AS w2,
                     least(2 + v3, more + CASE ini WHEN 'a' THEN v4 ELSE 1000000 END, more + 1 + v4) AS w3,
                     least(2 + v4, more + CASE ini WHEN 'u' THEN v3 ELSE 1000000 END, more + 1 + v3) AS w4
              FROM bw JOIN rows r ON r.conv_id IS NOT DISTINCT FROM bw.conv_id AND r.i = bw.i - 1))),
left_to_pay AS MATERIALIZED (
  SELECT b.conv_id, b.i, [b.v1, b.v2, b.v3, b.v4] AS v, r.role, r.text, r.ini, r.more,
         lead([b.v1, b.v2, b.v3, b.v4]) OVER (PARTITION BY b.conv_id ORDER BY b.i) AS after
  FROM bw b LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i),
fw AS (
  SELECT conv_id, 1::bigint AS i, 1 AS q, '' AS audit, NULL::varchar AS repaired FROM left_to_pay WHERE i = 1
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN q WHEN 'K' THEN k ELSE f END, audit || e,
         CASE WHEN e = 'D' THEN repaired
              ELSE coalesce(repaired || chr(10), '') || CASE WHEN e = 'K' THEN role WHEN f = 3 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END END
  FROM (SELECT fw.*, p.role, p.text, {fit}[q] AS f, {keep} AS k,
               CASE WHEN p.more IS NOT NULL AND 2 + p.after[q] = p.v[q] THEN 'D'
                    WHEN 5 + p.v[{fit}[q]] = p.v[q] THEN 'I'
                    WHEN p.more IS NULL THEN NULL
                    WHEN p.more + list_append(p.after, 1000000)[{keep}] = p.v[q] THEN 'K' ELSE 'R' END AS e
        FROM fw JOIN left_to_pay p ON p.conv_id IS NOT DISTINCT FROM fw.conv_id AND p.i = fw.i) s
  WHERE e IS NOT NULL),
ends AS (
  SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(repaired, length(audit)) AS repaired FROM fw GROUP BY conv_id),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::bigint AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(p.v[1], 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN left_to_pay p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = 1"""
