"""Conversation repair against a plain dynamic program over whole audits, row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from countypanel.llm import conversation_repair
from countypanel.llm.conversation_repair import op11_conversation_repair, repair

BODY = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_text, turn_text, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        held = out.setdefault(conv, [])
        kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = BODY.findall(text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def least(rows, found):
    """Cost, audit and lines of the best repair, from the end: the least (cost, audit) of every place."""
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    follow, end = {0: 2, 1: 2, 2: 3, 3: 2}, {0: (0, "", ()), 1: None, 2: None, 3: (0, "", ())}
    best = None
    for at in range(len(rows), -1, -1):
        now = {}
        for state in range(4):
            ways = [end[state]] if at == len(rows) and end[state] else []
            if at < len(rows):
                _, role, text = rows[at]
                ways.append((4 + best[state][0], "D" + best[state][1], best[state][2]))
                if found[at] in ("", "truncated"):
                    more = 3 * (found[at] == "truncated")
                    if (state, role[:1]) in keep:
                        c, a, x = best[keep[state, role[:1]]]
                        ways.append((c + more, "K" + a, (f"{role}:{text}", *x)))
                    c, a, x = best[follow[state]]
                    ways.append((c + more + 3, "R" + a, (("assistant:" if state == 2 else "user:") + text, *x)))
            now[state] = ways
        for _ in range(3):  # inserts: at most three in a row are ever worth it here
            for state in range(4):
                ways = [w for s in (follow[state],) if now[s] for w in [min(now[s])]]
                now[state] = now[state] + [(3 + c, "I" + a, (("assistant:" if state == 2 else "user:"), *x)) for c, a, x in ways]
        best = {s: min(w) for s, w in now.items()}
    return best[0]


def brute(rows):
    out = set()
    for conv, held in damaged(rows).items():
        found = faults(held)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        cost, audit, lines = least(held, found)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.add((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why", "well?  ", "", " \t", "a. b", "Ünï.", ".", "x" * 300, " ", "mark?\n"]
    roles = ["user", "assistant", "system", "tool", "", "u", None]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice([*texts, None, f"t{t}."]))
            for c in range(300) for t in range(rng.randint(1, 9))]
    # One with a third of all rows, some of it equal in all columns, some under one turn.
    rows += [(1000, t, rng.choice(roles[:3]), rng.choice([f"long {t}.", "again.", "cut"])) for t in range(700)]
    rows += [(1000, 5000, "user", "same.")] * 150 + [(1000, None, "assistant", f"no turn {i}.") for i in range(60)]
    rows += [(None, 1, "user", "hm."), (None, None, None, None), (2000, None, None, None), (3000, 2**62, "user", "far."), (3000, -(2**62), "user", "off.")]
    return rows


@pytest.mark.parametrize("seed,rows_per_chunk,parts", [(1, 4096, 7), (2, 40, 7), (3, 3, 2), (4, 1, 5)])
def test_repair_is_the_plain_program(spark, seed, rows_per_chunk, parts, monkeypatch):
    monkeypatch.setattr(conversation_repair, "CHUNK_ROWS", rows_per_chunk)
    rows = rows_of(seed)
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string, chunk int").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = [tuple(r) for r in repair(data).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = brute(rows)
    assert len(got) == len(want) and set(got) == want


def test_odd_tables(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert repair(spark.createDataFrame([], schema)).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    (row,) = repair(spark.createDataFrame([(7, gone, "user", "x")] * 3, schema)).collect()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows = [(1, t, "user" if t % 2 else "assistant", f"{'long ' * 200_000}{t}.") for t in range(6)]
    assert {tuple(r) for r in repair(spark.createDataFrame(rows, schema)).collect()} == brute(rows)


def test_the_query_is_the_plain_program(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in op11_conversation_repair(spark, folder).collect()} == brute(rows)
