"""Operator 11 against a brute force over edit strings, and on odd rows."""

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb

from folio.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"


def best(rows):
    """(cost, audit, repaired lines) of ``rows`` [(role, text, fault)]: the least of all edit strings, by cost and then by ASCII."""
    n = len(rows)

    @cache
    def go(i, roles, spare):
        out = []
        if i == n and re.fullmatch("(s?(ua)+)?", roles):
            out.append((0, "", ()))
        fits = lambda r: re.fullmatch("s|s?(ua)*u?", r) is not None
        if i < n:
            role, text, fault = rows[i]
            more = 5 if fault == "truncated" else 0
            out.append(add(2, "D", (), go(i + 1, roles, spare)))
            if fault not in ("blank", "duplicate"):
                if role[:1] and fits(roles + role[:1]):
                    out.append(add(more, "K", (role + ":" + text,), go(i + 1, roles + role[:1], spare)))
                for name in ("user", "assistant"):
                    if fits(roles + name[0]):
                        out.append(add(1 + more, "R", (name + ":" + text,), go(i + 1, roles + name[0], spare)))
        if spare:
            for name in ("user", "assistant"):
                if fits(roles + name[0]):
                    out.append(add(5, "I", (name + ":",), go(i, roles + name[0], spare - 1)))
        return min((x for x in out if x), key=lambda x: x[:2], default=None)

    def add(cost, edit, line, rest):
        return rest and (rest[0] + cost, edit + rest[1], line + rest[2])

    return go(0, "", 4)


def expected(rows, damaged=True):
    """The contract for ``rows`` (conv_id, turn, role, text), by plain loops."""
    out = {}
    for conv, turn, role, text in rows:
        got = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        got += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    result = {}
    for conv, got in out.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulty = set(), []
        for _, role, text in got:
            ends = re.findall("[^\x20\x09-\x0d]", text)
            fault = "blank" if not ends else "duplicate" if (role, text) in seen else "truncated" if ends[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {t for t, _, _ in got if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(got, got[1:], strict=False)]
        cost, audit, lines = best(tuple(faulty))
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == x for _, _, f in faulty) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


def told(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[x] for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


def made(n, seed=11):
    """Conversations of up to 7 rows with every kind of role, text and turn."""
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No!", "cut", " \t", "", None, "Odd  \n", "A long one? "]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choices(roles, [6, 6, 2, 1, 1, 1])[0], rng.choice(texts)))
    return rows


def test_equals_brute_force(spark):
    rows = made(120) + [(None, 0, "user", "Hi."), (None, None, "assistant", "So."), (7, 3, "user", "Yes."), (7, 3, "user", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert told(C.summaries(C.damage(df), gone="gone")) == expected(rows)
    assert told(C.summaries(df)) == expected(rows, damaged=False)


def test_edits_give_the_repaired_rows(spark):
    rows = made(60, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    audits = told(C.summaries(df))
    got = {}
    for r in sorted(C.repair(df).collect(), key=lambda r: (r["conv_id"], r["step"])):
        steps = got.setdefault(r["conv_id"], [[], []])
        steps[0].append(r["edit"])
        if r["edit"] != "D":
            steps[1].append(r["role"] + ":" + r["text"])
    for conv, (edits, lines) in got.items():
        assert "".join(edits) == audits[conv][6]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == audits[conv][7]


def test_long_conversations_cross_checkpoints(spark):
    """Many blocks: equal to the plain DP over the whole conversation."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system", "x"]), f"Row {t}" + rng.choice([".", ".", "!", "", " "]) if rng.random() > 0.05 else "") for t in range(3000)]
    rows += [(2, 0, "user", "w " * 400_000 + "."), (2, 1, "assistant", "Yes.")]
    got = told(C.summaries(spark.createDataFrame(rows, SCHEMA)))
    table = [C.END]
    marks = [("" if r[2] == "x" else r[2][0], "blank" if not r[3] else None if r[3].strip()[-1] in ".!" else "truncated") for r in rows[:3000]]
    for initial, fault in reversed(marks):
        table.append(C.back(table[-1], initial, fault))
    tokens, _ = C.walk(marks, C.END, C.START, True)
    assert got[1][5] == table[-1][C.START] and got[1][6] == "".join(tokens)
    assert got[2][6] == "KK"


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.summaries(C.damage(empty), gone="gone").collect() == [] and C.repair(empty).collect() == []
    rows = made(10, 8)
    wide = spark.createDataFrame([(*r, {"m": 1}, True, "p", 0) for r in rows], SCHEMA + ", step map<string,int>, gone boolean, fault string, pos int")
    assert told(C.summaries(wide)) == expected(rows, damaged=False)
    gone = [(c, 0, "user", "Yes.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in told(C.summaries(C.damage(spark.createDataFrame(gone, SCHEMA)), gone="gone")).values())


def test_oracle_on_odd_rows(spark):
    rows = made(150, 21)
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    got = {r[0]: r[1:] for r in con.sql(C.oracle()).fetchall()}
    assert got == told(C.summaries(C.damage(spark.createDataFrame(rows, SCHEMA)), gone="gone"))
