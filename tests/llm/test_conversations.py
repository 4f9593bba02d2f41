"""The repair against a search over edits from left to right, and against its SQL on the given table."""

import hashlib
import random
import re
import zlib

import pytest

from cohortlens.llm.conversation_repair import Costs, damaged, repair_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, part int"
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found, c):
    """(cost, audit) by the state after each row: the last letter kept."""

    def with_inserts(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for x in FOLLOWS[state].replace("s", ""):
                    best[x] = min(best.get(x, (10**9, "")), (cost + c.insert, audit + "I"))
        return best

    best = with_inserts({"": (0, "")})
    for (_, _, role, _), fault in zip(rows, found):
        after = {}
        for state, (cost, audit) in best.items():
            options = [(state, c.delete, "D")]
            if fault not in ("blank", "duplicate"):
                extra = c.truncated * (fault == "truncated")
                options += [(x, extra + c.rerole, "R") for x in FOLLOWS[state] if x != "s"]
                options += [(x, extra, "K") for x in FOLLOWS[state] if role[:1] == x]
            for x, more, letter in options:
                after[x] = min(after.get(x, (10**9, "")), (cost + more, audit + letter))
        best = with_inserts(after)
    return min(best[x] for x in ("", "a") if x in best)


def expected(rows, names, c=Costs()):
    out = {}
    for name in names:
        own = sorted((r for r in rows if r[0] == name), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(own)
        cost, audit = cheapest(own, found, c)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        lines, last, left = [], "", iter(own)
        for x in audit:
            wanted = "assistant" if last == "u" else "user"
            if x == "D":
                next(left)
                continue
            role, text = (wanted, "") if x == "I" else next(left)[2:]
            lines.append(f"{role if x == 'K' else wanted}:{text}")
            last = lines[-1][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[name] = (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(seed=5):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \t", "a b!", "é ", "end.\n\r", "x" * 50_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "agent"]
    rows = [(i, j, rng.choice(roles), rng.choice([*texts, None])) for i in range(150) for j in range(rng.randrange(1, 30))]
    rows += [(900, j, ("user", "assistant")[j % 2 if j % 17 else rng.randrange(2)], f"row {j}{rng.choice(['.', ''])}") for j in range(700)]
    rows += [(None, 3, "user", "hello."), (None, None, "assistant", "well."), (901, None, "user", "a."), (901, None, None, None), (901, 4, "user", "a."), (901, 4, "assistant", "a."), (902, -3, "user", "z."), (902, 9, "assistant", "z.")]
    rows += [(903, 1, "user", "same.")] * 40 + [(904, j, "user", "same.") for j in range(60)]
    rows = [(*r, "clash", 7) for r in rows]
    rng.shuffle(rows)
    return rows


def test_like_a_search_over_edits(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repair_conversations(damaged(df), df).collect()}
    want = expected(damage(rows), {r[0] for r in rows})
    assert {k: v for k, v in got.items() if v != want[k]} == {} and got.keys() == want.keys()


@pytest.mark.parametrize("costs", [Costs(2, 3, 4, 1), Costs(5, 2, 3, 0), Costs(0, 4, 3, 3)])
def test_other_costs(spark, costs):
    rows = [r for r in conversations(8) if r[0] is None or r[0] < 60]
    df = spark.createDataFrame([r[:2] + (r[2] or "x", r[3] or "") + r[4:] for r in rows], SCHEMA)
    got = {r.conv_id: (r.cost, r.audit) for r in repair_conversations(df, costs=costs).collect()}
    plain = [(c, t, role or "x", text or "") for c, t, role, text, *_ in rows]
    assert got == {k: v[5:7] for k, v in expected(plain, {r[0] for r in plain}, costs).items()}


def test_costs_without_room_are_refused():
    with pytest.raises(ValueError):
        Costs(insert=0)
    with pytest.raises(ValueError):
        Costs(delete=90)


def test_empty_tables_and_lost_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(damaged(df), df).collect() == []
    lost = spark.createDataFrame([(5, 1, "user", "a.", None, None)], SCHEMA)
    assert [tuple(r) for r in repair_conversations(df, lost).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
