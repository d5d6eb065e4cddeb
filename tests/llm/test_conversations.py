import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from rows_at_the_edge import CLASHES

from stayflow.llm import audit_dp, conversations, queries
from stayflow.llm.audit_dp import CUT_SHORT, FINE, MUST_GO, STATES

GOOD = re.compile(r"(s?(ua)+)?\Z")
BEGUN = re.compile(r"(s|s?(ua)*u?)\Z")


def cheapest(turns):
    """(cost, audit, roles) by following every edit string of short sequences."""

    def grown(now):
        out, layer = dict(now), now
        for _ in range(3):
            layer = {(r + x, a + "I"): c + 2 for (r, a), c in layer.items() for x in "ua" if BEGUN.match(r + x)}
            for k, c in layer.items():
                out[k] = min(c, out.get(k, c))
        return out

    now = {("", ""): 0}
    for initial, fault in turns:
        after = {}
        for (r, a), c in grown(now).items():
            ways = [(r, a + "D", c + 3)]
            if fault != MUST_GO:
                c += fault == CUT_SHORT
                ways += [(r + initial, a + "K", c)] if initial else []  # a turn without a role cannot stay as it is
                ways += [(r + "u", a + "R", c + 2), (r + "a", a + "R", c + 2)]
            for roles, audit, cost in ways:
                if BEGUN.match(roles):
                    after[roles, audit] = min(cost, after.get((roles, audit), cost))
        now = after
    return min((c, a, r) for (r, a), c in grown(now).items() if GOOD.match(r))


def plain(turns):
    """The same by strings per state, for long sequences."""
    best = {0: (0, "", "")}

    def add(found, state, cost, audit, roles):
        found[state] = min(found.get(state, (cost, audit, roles)), (cost, audit, roles))

    def grown(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, roles) in sorted(best.items()):
                target, role = audit_dp.NEXT[state]
                add(best, target, cost + 2, audit + "I", roles + role)
        return best

    for initial, fault in turns:
        after = {}
        for state, (cost, audit, roles) in grown(best).items():
            add(after, state, cost + 3, audit + "D", roles + "-")
            if fault != MUST_GO:
                extra = int(fault == CUT_SHORT)
                target, role = audit_dp.NEXT[state]
                add(after, target, cost + 2 + extra, audit + "R", roles + role)
                if initial in audit_dp.FOLLOWS[state]:
                    add(after, audit_dp.FOLLOWS[state][initial], cost + extra, audit + "K", roles + initial)
        best = after
    return min(v for s, v in grown(best).items() if s in (0, 3))


def some_turns(rng, n):
    return [(rng.choice(["s", "u", "a", "a", "u", "x", ""]), rng.choice([FINE, FINE, FINE, MUST_GO, CUT_SHORT])) for _ in range(n)]


def told(cost, path):
    return cost, path[::2], path[1::2].replace("-", "")


@pytest.mark.parametrize("modulus", [audit_dp.MODULUS, 3])
def test_cheapest_edits(monkeypatch, modulus):
    """Also with a hash that collides all the time."""
    monkeypatch.setattr(audit_dp, "MODULUS", modulus)
    rng = random.Random(modulus)
    for _ in range(400):
        turns = some_turns(rng, rng.randrange(5))
        assert told(*audit_dp.whole(turns)) == cheapest(turns), turns
    for _ in range(60):
        turns = some_turns(rng, 60)
        cost, audit, roles = plain(turns)
        assert told(*audit_dp.whole(turns)) == (cost, audit, roles.replace("-", ""))


@pytest.mark.parametrize("modulus", [audit_dp.MODULUS, 3])
def test_joined_parts_are_the_whole(monkeypatch, modulus):
    monkeypatch.setattr(audit_dp, "MODULUS", modulus)
    rng = random.Random(1)
    for _ in range(200):
        turns = some_turns(rng, rng.randrange(1, 40))
        cuts = sorted(rng.sample(range(1, len(turns)), min(len(turns) - 1, rng.randrange(5))))
        spans = zip([0, *cuts], [*cuts, len(turns)])
        parts = [{(s, e): w for s in STATES for e, w in audit_dp.part(turns[i:j], s).items()} for i, j in spans]
        cost, paths = audit_dp.joined(parts)
        assert (cost, "".join(paths)) == audit_dp.whole(turns)
        assert [len(re.sub("I.", "", p)) for p in paths] == [2 * (j - i) for i, j in zip([0, *cuts], [*cuts, len(turns)])]


SPACES = " \t\n\x0b\x0c\r"


def expected(rows):
    """The query's rows by the contract, in plain Python."""
    found = {}
    damaged = {}
    for conv, turn, role, text in rows:
        damaged.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in damaged.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in turns:
            solid = text.rstrip(SPACES)
            faults.append(
                "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        codes = [MUST_GO if f in ("blank", "duplicate") else CUT_SHORT if f else FINE for f in faults]
        cost, audit, roles = plain([(t[1][:1], c) for t, c in zip(turns, codes)])
        left, rest = [], iter(turns)
        for edit, initial in zip(audit, roles):
            _, role, text = ("", "", "") if edit == "I" else next(rest)
            if edit != "D":
                role = role if edit == "K" else {"u": "user", "a": "assistant"}[initial]
                left.append(f"{role}:{text}")
        known = [t[0] for t in turns if t[0] is not None]
        initials = [t[1][:1] for t in turns]
        found[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return found


def table(rng):
    texts = ["Yes.", "No!", "And", "Why? ", " \t", "", None, "Ende…", "Ok.\n", "é 日本。", "long " * 400 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "User", "", None, "tool"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, None if rng.random() < 0.05 else turn, role, rng.choice(texts)))
    rows += [(500, t, ("user", "assistant")[t % 2], rng.choice(texts)) for t in range(1500)]  # a third of all rows
    rows += [(501, None, "user", "same."), (501, None, "user", "same."), (501, None, None, None)]
    rows += [(502, 7, "user", "x."), (502, 7, "assistant", "y."), (502, 7, "assistant", "y.")]
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = table(random.Random(3))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected(rows) and len(found) == len({r[0] for r in rows})


def test_edge_rows(spark):
    """Other columns, whatever their names, change nothing; an empty table gives empty tables."""
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (1, 1, "assistant", "b."), (None, 0, "system", "c.")]
    narrow = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    wide = narrow.withColumns({c: F.lit("own") for c in [*CLASHES, "pos", "digest", "fault", "row", "path", "cost"]})
    got = [sorted(map(tuple, conversations.repair(df).audits.collect()), key=str) for df in (narrow, wide)]
    assert got[0] == got[1] == sorted([(1, 3, 0, 0, 1, 0, 1, 3, "KKD"), (None, 1, 0, 0, 0, 0, 0, 3, "D")], key=str)
    turns = conversations.repair(wide).turns.orderBy("pos", "k").collect()
    assert [(r.conv_id, r.role, r.text) for r in turns] == [(1, "user", "a."), (1, "assistant", "b.")]
    empty = conversations.repair(conversations.damaged(narrow.limit(0)))
    assert empty.audits.collect() == [] and empty.turns.collect() == []
    assert conversations.digests(empty.turns).collect() == []
