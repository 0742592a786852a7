import hashlib
import random
import zlib

import numpy as np
import pytest

from loomery.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, audit string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_repair(rows):
    """Forwards over rows with the least (cost, audit) of every state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    insert = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    counts, seen, best = [0] * 4, set(), {"": (0, "", ())}

    def add(found, state, value):
        if state not in found or value[:2] < found[state][:2]:
            found[state] = value

    def inserted(found):
        for _ in range(2):
            for q, (c, a, t) in list(found.items()):
                add(found, insert[q], (c + 5, a + "I", (*t, name[insert[q]] + ":")))
        return found

    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        counts[fault] += 1
        found = {}
        for q, (c, a, t) in inserted(best).items():
            add(found, q, (c + 2, a + "D", t))
            if fault in (0, 3):
                c += 5 * (fault == 3)
                legal = {"s": q == "", "u": q != "u", "a": q == "u"}.get(role[:1], False)
                if legal:
                    add(found, role[0], (c, a + "K", (*t, f"{role}:{text}")))
                add(found, insert[q], (c + 1, a + "R", (*t, f"{name[insert[q]]}:{text}")))
        best = found
    ends = inserted(best)
    cost, audit, lines = min(ends[q] for q in ("", "a") if q in ends)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, counts[1], counts[2], counts[3], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def made(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "superuser", "agent"]
    texts = ["Hello.", "Why?", "no end", "", " \t", None, "a\nb!", "Ünd. \n", "x" * 80 + ".", "x" * 80 + "y."]
    rows = []
    for conv in range(60):
        turn = 0
        for j in range(rng.choice((1, 1, 2, 3, 5, 8, 13))):
            turn += rng.choice((1, 1, 1, 0, 3))
            usual = rng.random() < 0.6
            rows.append((conv, rng.choice((turn, turn, turn, None)), ("user", "assistant")[j % 2] if usual else rng.choice(roles), f"Text {conv} {j}." if usual else rng.choice(texts)))
    rows += [(None, t, "user", f"Line {t}.") for t in (None, 0, 1)] + [(900 + i, None, None, None) for i in range(30)]
    rows += [(999, 1, "user", "same")] * 9
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


@pytest.mark.parametrize("block_rows, block_chars", [(1024, 1 << 20), (3, 1 << 20), (1, 1 << 20), (5, 40)])
def test_repair(spark, block_rows, block_chars):
    rows = made(block_rows)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    by = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        by[r[0]].append(r)
    got = found(conversations.repair(conversations.damaged(df), block_rows, block_chars))
    assert got == sorted(((c, *plain_repair(r)) for c, r in by.items()), key=repr)
    assert any(not r for r in by.values())  # some lose all rows


def test_ties_and_long_conversation(spark):
    rng = random.Random(4)
    rows = [("long", i, rng.choice(("user", "assistant", "tool")), rng.choice((f"Line {i}.", f"Line {i}", ""))) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").repartition(7)
    assert found(conversations.repair(df, block_rows=100)) == [("long", *plain_repair(rows))]
    assert found(conversations.repair(df)) == [("long", *plain_repair(rows))]


def test_no_rows(spark):
    assert conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_ranks_order_whole_audits():
    """Costs and audits of all first states against each other's matrices."""
    rng = np.random.default_rng(2)
    initials, faults = rng.integers(0, 4, (50, 6)), rng.integers(0, 4, (50, 6))
    whole = conversations.matrices(initials, faults)
    parts = [conversations.matrices(initials[:, a:b], faults[:, a:b]) for a, b in ((0, 2), (2, 6))]
    joined = np.minimum((parts[0][:, :, :, None] + parts[1][:, None, :, :]).min(axis=2), conversations.FAR)
    assert (whole == joined).all()
