from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from vintara.llm import queries, repair

LEGAL = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def _damaged(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv, turn, role, text in rows:
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(named.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub(r"[.!?]", "", text) if fate == 2 else text
        out.setdefault(conv, [])
        out[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def _fault(row: tuple, seen: set) -> str:
    said = WORD.findall(row[2])
    return "blank" if not said else "duplicate" if row[1:] in seen else "truncated" if said[-1] not in ".!?" else ""


def _want(conv, rows: list[tuple]) -> tuple:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen: set = set()
    faults = []
    for row in rows:
        faults.append(_fault(row, seen))
        seen.add(row[1:])
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # cost, edits and rows left, by what the initials end in
    best = {"": (0, "", ())}
    follows = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    def better(to, state, new):
        if state not in to or new[:2] < to[state][:2]:
            to[state] = new

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for s, (c, e, left) in list(states.items()):
                for name in ("user", "assistant"):
                    if (s, name[0]) in follows:
                        better(states, name[0], (c + 5, e + "I", (*left, (name, ""))))
        return states

    for (_, role, text), fault in zip(rows, faults):
        after: dict = {}
        for s, (c, e, left) in inserted(best).items():
            better(after, s, (c + 2, e + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if (s, role[:1]) in follows:
                better(after, role[0], (c + more, e + "K", (*left, (role, text))))
            for name in ("user", "assistant"):
                if (s, name[0]) in follows:
                    better(after, name[0], (c + 1 + more, e + "R", (*left, (name, text))))
        best = after
    cost, audit, left = min(v for s, v in inserted(best).items() if s in ("", "a"))
    assert LEGAL.fullmatch("".join(r[0][0] for r in left))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
    return conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def _got(frame) -> list[tuple]:
    columns = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=lambda r: str(r[0]))


def _all(damaged: dict) -> list[tuple]:
    return sorted((_want(c, rows) for c, rows in damaged.items()), key=lambda r: str(r[0]))


def _kinds(rows: str) -> bytes:
    """u, a, s, x as they are; upper case if cut off; - must go."""
    return bytes(repair.GONE if r == "-" else "uasx".index(r.lower()) + 4 * r.isupper() for r in rows)


def _exhaustive(rows: str) -> tuple[int, str]:
    """All lists of edits with at most four inserts between any two rows."""
    found = []
    choices = [["D"] if r == "-" else ["D", "K", "u", "a"] for r in rows]
    for edits in itertools.product(*choices):
        for inserts in itertools.product(range(4), repeat=len(rows) + 1):
            if sum(inserts) > 4:
                continue
            roles, audit, cost = "", "", 0
            for i, n in enumerate(inserts):
                for _ in range(n):
                    roles += "a" if roles.endswith("u") else "u"
                audit, cost = audit + "I" * n, cost + 5 * n
                if i < len(rows):
                    e, r = edits[i], rows[i]
                    roles += "" if e == "D" else r.lower() if e == "K" else e
                    audit += e if e in "DK" else "R"
                    cost += 2 if e == "D" else (5 if r.isupper() else 0) + (e != "K")
            if LEGAL.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


def test_small_conversations_against_all_edits():
    paths = repair.Paths()
    for n in range(4):
        for rows in itertools.product("uasxUAS-", repeat=n):
            assert paths.whole(_kinds("".join(rows))) == _exhaustive("".join(rows)), rows


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(queries.op11_repair(spark, sf_dir)) == _all(_damaged(rows))


def _random(n: int, convs: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    roles, texts = ["user", "assistant", "system", "s", None, "tool", ""], ["Yes.", "No!", "cut", "", " \t", None, "Why? ", "é.", "a\nb."]
    return [(int(draw.integers(convs)), None if draw.random() < 0.1 else int(draw.integers(n // convs + 2)),
             roles[draw.choice(7, p=[.38, .38, .1, .04, .04, .03, .03])],
             texts[draw.integers(9)] if draw.random() < 0.5 else f"Text {draw.integers(50)}.") for _ in range(n)]


@pytest.mark.parametrize("rows, chars", [(1 << 16, 1 << 22), (7, 1 << 22), (1000, 40), (1, 1)])
def test_blocks_of_any_size(spark, frame, monkeypatch, rows, chars):
    monkeypatch.setattr(repair, "ROWS", rows)
    monkeypatch.setattr(repair, "CHARS", chars)
    table = _random(900, 30, 3) + _random(600, 1, 4) + [(99, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(500)]
    got = repair.repair(repair.damaged(frame(table, "conv_id long, turn long, role string, text string")), copies="copies")
    assert _got(got) == _all(_damaged(table))


def test_odd_rows(spark, frame):
    long = "word " * 200_000 + "."
    table = [(1, 1, "user", "Hi."), (1, 2, "assistant", long), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ok."), (2, None, None, None),
             (3, -2**63, "user", "A."), (3, 2**63 - 1, "assistant", "B.")] + [(4, 1, "user", "Same.")] * 30 + [(5, 0, "", "No role.")]
    odd = frame(table, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS copies", "2 AS kind", "3 AS same", "4 AS blank", "5 AS _right_key")
    own: dict = {}
    for conv, turn, role, text in table:
        own.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = [(w[0], -2 if w[0] == 3 else w[1], *w[2:]) for w in _all(own)]  # wrapped around
    assert _got(repair.repair(odd)) == want
    assert _got(repair.repair(odd.limit(0))) == []
    # no row is left of some conversations
    gone = frame([(1, 1, "user", "Hi.", 0), (2, 1, "user", "Hi.", 0), (2, 2, "user", "Hi.", 3)],
                 "conv_id long, turn long, role string, text string, n int")
    empty = hashlib.sha256().hexdigest()
    assert _got(repair.repair(gone, copies="n")) == [(1, 0, 0, 0, 0, 0, 0, "", empty), _want(2, [(2, "user", "Hi.")] * 3)]
