"""Conversation repair against a plain program that tries every repair, and awkward rows."""

import hashlib
import itertools
import random
import zlib
from functools import cache

import pytest
from conftest_llm import SMALL

from balcao.llm import queries, repair
from balcao.llm.tables import given

BLANK_MARKS = " \t\n\v\f\r"


def brute_repair(kinds):
    """(cost, least audit) by every continuation of every state, as whole texts."""

    @cache
    def rest(at, state, inserts=0):
        found = []
        if at == len(kinds) and state in ("", "a"):
            found.append((0, ""))
        options = []
        if inserts < 2:
            options.append(("I", 5, at, "a" if state == "u" else "u", inserts + 1))
        if at < len(kinds):
            role, fault = kinds[at]
            options.append(("D", 2, at + 1, state, 0))
            if fault not in "12":
                extra = 5 if fault == "3" else 0
                options.append(("R", 1 + extra, at + 1, "a" if state == "u" else "u", 0))
                if (role, state) in (("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")):
                    options.append(("K", extra, at + 1, role, 0))
        for label, cost, to, reached, used in options:
            after = rest(to, reached, used)
            if after:
                found.append((cost + after[0], label + after[1]))
        return min(found, default=None)

    return rest(0, "")


def apply(rows, audit):
    state, at, out = "", 0, []
    for label in audit:
        new = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[new]
        if label == "I":
            out.append(f"{name}:")
            state = new
            continue
        role, text = rows[at]
        at += 1
        if label == "K":
            out.append(f"{role}:{text}")
            state = role[:1]
        elif label == "R":
            out.append(f"{name}:{text}")
            state = new
    return "\n".join(out)


def brute_conversation(rows):
    """Figures of (turn, role, text) rows, nulls already spaces."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK_MARKS)
        fault = "1" if not bare else "2" if (role, text) in seen else "0" if bare[-1] in ".!?" else "3"
        seen.add((role, text))
        kinds.append((role[:1], fault))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = brute_repair(tuple(kinds))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[sum(f == code for _, f in kinds) for code in "123"],
        sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(kinds)),
        cost,
        audit,
        hashlib.sha256(apply([r[1:] for r in rows], audit).encode()).hexdigest(),
    )


def brute_damage(rows):
    """conv_id -> rows after damage, of (conv_id, turn, role, text)."""
    kept = {}
    for conv, turn, role, text in rows:
        out = kept.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return kept


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def expected(rows):
    return sorted(((conv, *brute_conversation(r)) for conv, r in brute_damage(rows).items() if r), key=repr) + sorted(
        ((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for conv, r in brute_damage(rows).items() if not r),
        key=repr,
    )


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("length", range(6))
def test_search_equals_every_repair(length):
    rng = random.Random(length)
    every = [r + f for r in "sua?" for f in "0123"]
    cases = list(itertools.product(every, repeat=length)) if length < 3 else [rng.choices(every, k=length) for _ in range(800)]
    for kinds in cases:
        cost, audit, _ = repair.cheapest(list(kinds))
        assert (cost, audit) == brute_repair(tuple((k[0], k[1]) for k in kinds)), kinds


def test_search_equals_every_repair_of_longer_ones():
    rng = random.Random(1)
    for _ in range(150):
        kinds = rng.choices(["u0", "a0", "u3", "a3", "s0", "u1", "a2", "?0"], [6, 6, 2, 2, 1, 1, 1, 1], k=rng.randrange(8, 40))
        assert repair.cheapest(kinds)[:2] == brute_repair(tuple((k[0], k[1]) for k in kinds))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in given(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_repair(spark, SMALL)) == sorted(expected(rows), key=repr)


def awkward(rng):
    roles = ["user", "assistant", "system", "", "tool", None, "Ünser", "user", "assistant"]
    texts = ["Hi.", "no end", "", " \t\n", None, "Why? ", "Hi.", "日本語。", "x" * 3000, "a\nb!\n", "end. ", "\U0001f600."]
    rows = [
        (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts))
        for _ in range(160)
    ]
    rows += [(6, turn, "user" if turn % 2 == 0 else "assistant", f"Turn {turn}.") for turn in range(300)]
    rows += [(7, None, "user", "same."), (7, None, "user", "same."), (8, 5, None, None)]
    return rows + [(conv, 1, "user", "Alone.") for conv in range(100, 140)]


SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, block int, of string, same int, audit int"


@pytest.mark.parametrize("block", [2, 7, repair.BLOCK])
def test_awkward_rows_by_block(spark, block):
    """Long conversations by blocks equal whole ones; nulls, ties, repeats and clashing columns."""
    rows = awkward(random.Random(5))
    turns = spark.createDataFrame([(*r, "p", 1, "o", 2, 3) for r in rows], SCHEMA).repartition(5)
    got = repair.every_conversation(turns, repair.repair(repair.damaged(turns), block))
    assert found(got) == sorted(expected(rows), key=repr)


def test_no_rows(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert found(repair.every_conversation(turns, repair.repair(repair.damaged(turns)))) == []
