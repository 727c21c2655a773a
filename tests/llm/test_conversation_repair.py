"""Conversation repair against an exhaustive shortest path, on short units and odd tables."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from plyframe.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        plain = text.rstrip("\t\n\x0b\x0c\r ")
        out.append("b" if not plain else "d" if (role, text) in seen else "t" if plain[-1] not in ".!?" else " ")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Dijkstra over (row, roles so far as a state), the queue ordered by cost and audit; returns cost, audit and texts."""
    kinds = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, texts = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(texts)
        for who in ("user", "assistant"):
            if (state, who[0]) in step:
                heapq.heappush(queue, (cost + 2, audit + "I", i, who[0], (*texts, who + ":")))
        if i < len(rows):
            (role, text), fault = rows[i], kinds[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, texts))
            if fault not in "bd":
                more = fault == "t"
                for who in ("user", "assistant"):
                    if (state, who[0]) in step:
                        heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, who[0], (*texts, f"{who}:{text}")))
                if (state, role[:1]) in step:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*texts, f"{role}:{text}")))
    raise AssertionError


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = role if role is not None else " ", text if text is not None else " "
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        held.sort()
        messages = [h[2:] for h in held]
        turns = [h[1] for h in held if h[0]]
        kinds = faults(messages)
        initials = [m[0][:1] for m in messages]
        cost, audit, whole = cheapest(messages)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out[conv] = (gaps, *(kinds.count(k) for k in "bdt"), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())
    return out


def test_search_against_all_paths():
    r = random.Random(1)
    for _ in range(60):
        rows = [(r.choice(["user", "assistant", "system", "tool", ""]), r.choice(["", "One.", "Two", "three!"])) for _ in range(r.randrange(1, 40))]
        symbols = [(role[:1] if role[:1] in tuple("sua") else "-") + f for (role, _), f in zip(rows, faults(rows), strict=True)]
        best = cr.joined(cr.best_edits(symbols), cr.END)
        assert min(best[0][b] for b in cr.FINAL if best[0][b]) == cheapest(rows)[:2]


@pytest.mark.parametrize("span", [cr.SPAN, 1])
def test_repair(spark, span):
    r = random.Random(5)
    rows = []
    for conv in [*range(1, 40), None, -3]:
        turn = r.randrange(-5, 3)
        for _ in range(r.choice([1, 2, 6, 9, 30])):
            turn += r.choice([0, 1, 1, 1, 1, 2])
            role = r.choice(["user", "assistant", "user", "assistant", "system", None, "", "unknown", "tool"])
            rows.append((conv, r.choice([turn] * 15 + [None]), role, r.choice(["Yes.", "No", "", None, " \n", "Long " * r.randrange(50) + "end!", "é."])))
    rows += rows[::9]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("unit", "place", "fault", "copy", "kind", "digest", "edits", "first", "n", "c", "d")})
    got = {x.conv_id: tuple(x)[1:] for x in cr.repair(df, span=span).collect()}
    assert got == want


def test_nothing_left_and_long(spark):
    gone = next(i for i in range(10**4) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")] + [(10**6, i, ("user", "assistant")[i % 2], f"Message {i}" + ".!? "[i % 4]) for i in range(5000)] + [(10**6 + 1, 1, "user", "word " * 400_000)]
    got = {x.conv_id: tuple(x)[1:] for x in cr.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got == brute(rows)


def test_empty_table(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).count() == 0
