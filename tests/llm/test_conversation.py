"""Conversation repair against a search over whole repairs, also where conversations cross partitions."""

import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

import pytest

from tessera.llm import conversation as cv
from tessera.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string"
BLANKS = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        name = lambda v: " " if v is None else str(v)
        role, text = name(role), name(text)
        fault = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def brute_repair(rows):
    """Cheapest, then ASCII-least audit, by search over (row, roles so far) with whole audits as keys."""
    seen, marked = set(), []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        body = text.strip(BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault))
    heap, settled = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, state = heappop(heap)
        if k == len(marked) and state in ("", "a"):
            break
        if (k, state) in settled and len(rows) > 6:
            continue
        settled.add((k, state))
        nxt = "a" if state == "u" else "u"
        if len(audit) < 3 * len(rows) + 3:
            heappush(heap, (cost + 2, audit + "I", k, nxt))
        if k < len(marked):
            role, _, fault = marked[k]
            heappush(heap, (cost + 3, audit + "D", k + 1, state))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if role[:1] in ("u", "a") and role[0] == nxt or role[:1] == "s" and not state:
                    heappush(heap, (cost + late, audit + "K", k + 1, role[0]))
                heappush(heap, (cost + 2 + late, audit + "R", k + 1, nxt))
    lines, state, k = [], "", 0
    for letter in audit:
        nxt = "a" if state == "u" else "u"
        if letter == "I":
            lines.append(("user" if nxt == "u" else "assistant") + ":")
            state = nxt
            continue
        role, text, _ = marked[k]
        k += 1
        if letter == "R":
            role = "user" if nxt == "u" else "assistant"
        if letter != "D":
            lines.append(f"{role}:{text}")
            state = role[0]
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(rows, rows[1:])]
    return counts | {"illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
                     "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def expected(rows):
    """As the query, from rows of ``SCHEMA``."""
    out = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        out[r[0]].append(r)
    for conv, own in out.items():
        key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())
        own.sort(key=key)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = {"gaps": gaps} | brute_repair([r[2:] for r in own])
    return out


def random_kind_rows(rng, n):
    texts = ["", " \t", "Yes.", "No!", "Why", "Go on?", "e\n", "Long. text ", "x. \x0b"]
    return [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", " "]), rng.choice(texts) + rng.choice(["", str(k) + "."]))
            for k in range(n)]


def kinds_of(rows):
    seen, out = set(), bytearray()
    for role, text in rows:
        body = text.strip(BLANKS)
        at = 1 + ("sua".index(role[0]) if role[:1] and role[0] in "sua" else 3)
        out.append(0 if not body or (role, text) in seen else at + (0 if body[-1] in ".!?" else 4))
        seen.add((role, text))
    return bytes(out)


def test_divide_and_conquer_equals_search_over_whole_audits():
    rng = random.Random(5)
    for n in [*range(0, 6)] * 60:
        rows = random_kind_rows(rng, n)
        kinds, want = kinds_of(rows), brute_repair(rows)
        made, last = cv._solved(kinds, 0, cv.EXITS)
        assert "".join(made) + cv.TAIL[last] == want["audit"], rows
        assert cv.cost_of(kinds, made, cv.TAIL[last]) == want["cost"]


def suffix_dp(kinds):
    """Least (cost, audit) from the end backwards, whole strings kept: quadratic space, any length."""
    best = [(cv.EXITS[s], cv.TAIL[s]) for s in range(4)]
    for kind in reversed(kinds):
        best = [min((m[0] + best[t][0], m[1] + best[t][1]) for t, m in enumerate(cv.moves(kind)[s]) if m) for s in range(4)]
    return best[0]


@pytest.mark.parametrize("n", [7, 64, 65, 300, 1000])
def test_long_conversations_equal_whole_string_dp(n):
    rng = random.Random(n)
    for _ in range(8):
        kinds = bytes(rng.choice(range(9)) for _ in range(n))
        made, last = cv.audits(kinds)
        cost, audit = suffix_dp(kinds)
        assert "".join(made) + cv.TAIL[last] == audit and cv.cost_of(kinds, made, cv.TAIL[last]) == cost


def table(rng, convs, turns):
    rows = []
    for c in convs:
        for t in range(rng.choice(turns)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool", None, ""])
            rows.append((c, rng.choice([t, t, t, None, t + 2]), role,
                         rng.choice([None, "", "So.", "So.", f"n{t}.", f"n{t}", "è! \t"]), "x"))
    return rows


def collected(df):
    return {r["conv"]: {k: r[k] for k in (*cv.COUNTS, "audit", "repaired_sha256")} for r in df.collect()}


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_repair_equals_brute_force_however_partitioned(spark, partitions):
    rng = random.Random(partitions)
    rows = table(rng, [None, -3, *range(25)], [0, 1, 2, 4, 6]) + table(rng, [77], [120])
    rows.append((500, next(t for t in range(999) if zlib.crc32(f"500:{t}".encode()) % 20 == 0), "user", "dropped.", "x"))
    got = cv.digests(cv.repair(cv.damage(spark.createDataFrame(rows, SCHEMA)), partitions))
    want = expected(rows)
    assert collected(got) == want and got.count() == len(want)
    assert want[500]["audit"] == "" and want[500]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_pieces_of_a_long_conversation_and_edits(spark, monkeypatch):
    monkeypatch.setattr(cv, "PIECE_EDITS", 5)
    rows = table(random.Random(9), [1], [90])
    pieces = cv.repair(cv.damage(spark.createDataFrame(rows, SCHEMA)), 4)
    want = expected(rows)
    assert collected(cv.digests(pieces)) == want
    ordered = cv.edits(pieces).orderBy("conv", "place", "number").collect()
    assert "".join(r["edit"] for r in ordered) == want[1]["audit"]
    kept = [r for r in ordered if r["edit"] != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))


def test_equal_rows_of_one_turn_cover_partitions(spark):
    rows = [(1, 0, "user", "Hi.", "x")] * 400 + [(1, 1, "assistant", "Yes.", "x")]
    got = collected(cv.digests(cv.repair(cv.damage(spark.createDataFrame(rows, SCHEMA)), 6)))
    assert got == expected(rows)


def test_empty_table_and_very_long_text(spark):
    assert cv.digests(cv.repair(cv.damage(spark.createDataFrame([], SCHEMA)))).count() == 0
    rows = [(8, t, "user" if t % 2 == 0 else "assistant", "long text " * 300_000 + "end.", "x") for t in range(6)]
    assert collected(cv.digests(cv.repair(cv.damage(spark.createDataFrame(rows, SCHEMA)), 3))) == expected(rows)


def test_query_over_the_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, d)
    assert got.columns == ["conv_id", *cv.COUNTS, "audit", "repaired_sha256"]
    assert collected(got.withColumnRenamed("conv_id", "conv")) == expected(rows)
