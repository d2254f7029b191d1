"""Conversation repair against a search over all edits, on damaged tables, odd rows and a giant conversation."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import turns
from ledgerline.llm.turns import damaged, digests, repaired

SCHEMA = "conv_id long, turn long, role string, text string, copy int, step string"
GOOD = re.compile(r"(s?(ua)+)?")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def faults(rows):
    """1 blank, 2 repeated, 3 cut off, 0 none, for rows (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        out.append(1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired): a best-first search over (cost, audit)."""
    bad, heap, done = faults(rows), [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        heapq.heappush(heap, (cost + 5, audit + "I", i, NEXT[last]))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last))
            if bad[i] not in (1, 2):
                more, first = 5 * (bad[i] == 3), rows[i][0][:1]
                if first == NEXT[last] or (first == "s" and not last):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, first))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, NEXT[last]))


def every(rows):
    """The same by trying all strings of edits with at most four inserted turns."""
    bad, found = faults(rows), []
    for gaps in itertools.product(range(3), repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            states = {("", 0)}
            audit = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[-1]
            i = 0
            for e in audit:
                new = set()
                for done, cost in states:
                    last = done[-1:]
                    if e == "I":
                        new |= {(done + c, cost + 5) for c in "ua"}
                    elif e == "D":
                        new.add((done, cost + 2))
                    elif bad[i] in (1, 2):
                        pass
                    elif e == "K":
                        new.add((done + rows[i][0][:1], cost + 5 * (bad[i] == 3)) if rows[i][0] else (done + "?", cost))
                    else:
                        new |= {(done + c, cost + 1 + 5 * (bad[i] == 3)) for c in "ua"}
                states = new
                i += e != "I"
            found += [(cost, audit) for done, cost in states if GOOD.fullmatch(done)]
    return min(found)


def rebuilt(rows, audit):
    out, i, last = [], 0, ""
    for e in audit:
        if e == "I":
            last = NEXT[last]
            out.append(({"u": "user", "a": "assistant"}[last], ""))
            continue
        role, text = rows[i]
        i += 1
        if e == "K":
            last = role[:1]
            out.append((role, text))
        elif e == "R":
            last = NEXT[last]
            out.append(({"u": "user", "a": "assistant"}[last], text))
    assert i == len(rows) and GOOD.fullmatch("".join(r[:1] for r, _ in out))
    return out


def expected(rows):
    """The whole contract for rows (turn, role, text) after damage, in order."""
    said = [(r, t) for _, r, t in rows]
    bad, known = faults(said), [t for t, _, _ in rows if t is not None]
    cost, audit = cheapest(said)
    text = "\n".join(f"{r}:{t}" for r, t in rebuilt(said, audit))
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": bad.count(1), "duplicate": bad.count(2), "truncated": bad.count(3),
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
    }


def after_damage(rows):
    """Plain damage of rows (conv, turn, role, text), grouped and sorted."""
    out = {}
    for conv, turn, role, text in rows:
        name = [" " if x is None else str(x) for x in (conv, turn)]
        fate = zlib.crc32(":".join(name).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        here = out.setdefault(conv, [])
        here += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], md5(x[2]))) for c, r in out.items()}


def of_table(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = digests(repaired(damaged(frame), names_only=F.col("dropped")))
    return {r["key"]: {k: r[k] for k in r.asDict() if k != "key"} for r in found.collect()}


def talk(rng, n):
    roles = rng.choice([["user", "assistant"], ["system", "user", "assistant", "tool", "ú", " ", ""], ["assistant"], ["system", "user"]])
    texts = ["Good.", "Why?", "cut off", " ", "", "x! ", "ja.\n", None, " ", "Yes!"]
    return [(t if rng.random() < 0.95 else None, rng.choice(roles) if rng.random() < 0.97 else None, rng.choice(texts)) for t in range(n)]


def test_tables_match_a_search(spark):
    rng = random.Random(11)
    rows = [(c if c != 40 else None, *r) for c in range(300) for r in talk(rng, rng.choice([1, 2, 3, 5, 8, 13]))]
    rows += [(900, 3, "user", f"t{k % 4}.") for k in range(12)] + [(901, 10**12, "user", "A."), (901, 0, "user", "a" * 3_000_000)]
    got, want = of_table(spark, rows), after_damage(rows)
    assert set(got) == set(want)
    for conv, said in want.items():
        assert got[conv] == expected(said), (conv, said)


def test_search_matches_all_edits():
    rng = random.Random(2)
    for _ in range(40):
        rows = [(r or " ", t or " ") for _, r, t in talk(rng, rng.randint(0, 3))]
        assert cheapest(rows) == every(rows)


@pytest.mark.parametrize("memory", [8, 64, 1 << 20])
def test_streams_match_the_search(monkeypatch, memory):
    monkeypatch.setattr(turns, "MEMORY_BYTES", memory)
    rng, known = random.Random(4), {}
    for k in range(60):
        rows = [(t, r or " ", x or " ") for t, r, x in sorted(talk(rng, rng.choice([0, 1, 9, 70])), key=lambda r: (r[0] is not None, r[0] or 0))]
        one = turns._Talk(k, known)
        for (t, r, x), bad in zip(rows, faults([(r, x) for _, r, x in rows]), strict=True):
            one.add(t, r, x, bad)
        head, *edits = one.edits()
        want = expected(rows)
        assert head[4:] == tuple(want[c] for c in turns._COUNTS)
        assert "".join(e[1] for e in edits) == want["audit"]
        assert [(e[2], e[3]) for e in edits if e[1] != "D"] == rebuilt([(r, x) for _, r, x in rows], want["audit"])
        assert [e[0] for e in edits] == list(range(1, len(edits) + 1))


def test_giant_conversation_and_empty_table(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", f"line {k}" + "." * (k % 5 > 0)) for k in range(60_000)] + [(2, 0, "user", "Hi.")]
    got, want = of_table(spark, rows), after_damage(rows)
    assert got[1] == expected(want[1]) and got[2] == expected(want[2])
    assert of_table(spark, []) == {}


def test_conversation_without_rows_after_damage(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = of_table(spark, [(lost, 0, "user", "Hi.")])
    assert got == {lost: dict.fromkeys(turns._COUNTS, 0) | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}}
