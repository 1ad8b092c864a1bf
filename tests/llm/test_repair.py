import hashlib
import heapq
import random
import re
import zlib

import pytest

from cohortweave.llm import repair
from cohortweave.llm.queries import QUERIES, damaged

WHOLE = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, ends string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def sorted_rows(rows):
    """Rows of one conversation in the stated order."""

    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[1], r[2])))


def by_hand(rows):
    """Faults, then the cheapest edits by searching strings in order of cost and letters."""
    rows = sorted_rows([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    heap, done = [(0, "", 0, ())], set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        tail = "".join(r[:1] or "?" for r, _ in out)
        # Two prefixes of one length that allow the same endings need no second visit.
        if (i, tail[-1:], len(tail) == 0) in done:
            continue
        done.add((i, tail[-1:], len(tail) == 0))
        if i == len(rows) and WHOLE.match(tail):
            break
        options = [("I", 5, i, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            options.append(("D", 2, i + 1, None))
            if faults[i] in ("", "t"):
                more = 5 if faults[i] == "t" else 0
                options.append(("K", more, i + 1, (role, text)))
                options += [("R", 1 + more, i + 1, (r, text)) for r in ("user", "assistant")]
        for letter, price, j, turn in options:
            new = out + ((turn,) if turn else ())
            if re.match(r"(s?(ua)*u?)?\Z", "".join(r[:1] or "?" for r, _ in new)):
                heapq.heappush(heap, (cost + price, audit + letter, j, new))
    text = "\n".join(f"{r}:{x}" for r, x in out)
    counts = tuple(faults.count(f) for f in "bdt")
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


def told(df):
    return {r.conv: tuple(r)[1:] for r in df.collect()}


def conversations(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault("none" if conv is None else f"={conv}", []).append(tuple(row))
    return groups


def random_rows(seed, n=120, longest=9):
    rnd = random.Random(seed)
    texts = ["a.", "b", "", " \n", "c!", "d?\t", "e. f", None, "é."]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "agent"]
    rows = []
    for conv in range(n):
        for _ in range(rnd.randint(1, longest)):
            weights = (8, 8, 3, 1, 1, 1, 1, 1)
            rows.append((conv if conv else None, rnd.choice([None, *range(6)]), rnd.choices(roles, weights)[0], rnd.choice(texts + [f"{rnd.random()}."] * 6)))
    return rows


@pytest.mark.parametrize("segment", [4096, 1, 3])
def test_as_by_hand(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    rows = random_rows(segment)
    expected = {conv: by_hand(of) for conv, of in conversations(rows).items()}
    assert told(repair.repair(frame(spark, rows).repartition(5))) == {conv: x[0] for conv, x in expected.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(frame(spark, rows)).collect(), key=lambda r: (r.conv, r.position)):
        turns.setdefault(r.conv, []).append((r.role, r.text))
    assert turns == {conv: list(x[1]) for conv, x in expected.items() if x[1]}


def test_walk_over_many_rows():
    rnd = random.Random(5)
    for n in (1, 2, 3, 16, 17, 400):
        codes = bytes(rnd.randrange(12) for _ in range(n))
        rows = [(i, {0: "s", 1: "u", 2: "a", 3: "t"}[c // 3], {0: f"{i}.", 1: "", 2: f"{i}"}[c % 3]) for i, c in enumerate(codes)]
        audit, states = repair.walk(codes, repair.END, repair.START)
        audit += {repair.SYSTEM: "II", repair.USER: "I"}.get(states[-1], "")
        assert audit == by_hand(rows)[0][6]
        costs = (repair.matrix(codes)[repair.START] + repair.END).min()
        assert costs == by_hand(rows)[0][5]


def test_long_conversation_and_texts(spark):
    rows = [(7, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(9000)]
    rows += [(8, 0, "user", "long " * 1_800_000 + "."), (8, 1, "assistant", "ok.")]
    rows += [(9, 3, "user", "again.")] * 6000
    found = told(repair.repair(frame(spark, rows)))
    kept = "\n".join(f"{r[2]}:{r[3]}" for r in rows[1:8999])
    assert found["=7"] == (0, 0, 0, 0, 0, 4, "D" + "K" * 8998 + "D", hashlib.sha256(kept.encode()).hexdigest())
    assert found["=8"][5:7] == (0, "KK")
    assert found["=9"][:7] == (0, 0, 5999, 0, 5999, 12000 - 2 + 2, "D" * 6000)


def test_the_query(spark, tmp_path):
    rows = random_rows(3, 60) + [(1000 + c, t, "user", "hello.") for c in range(200) for t in range(1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    expected = {}
    for conv, of in conversations(rows).items():
        kept = []
        for turn, role, text in of:
            role, text = (" " if role is None else role), (" " if text is None else text)
            key = zlib.crc32(f"{' ' if conv == 'none' else conv[1:]}:{' ' if turn is None else turn}".encode()) % 20
            if key:
                text = "" if key == 1 else re.sub("[.!?]", "", text) if key == 2 else text
                kept += [(turn, "user" if key == 4 else role, text)] * (2 if key == 3 else 1)
        expected[None if conv == "none" else int(conv[1:])] = by_hand(kept)[0]
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == expected
    assert any(x == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for x in expected.values())


def test_empty(spark):
    assert repair.repair(frame(spark, [(1, 1, "user", "a.")]).limit(0)).collect() == []
    assert damaged(frame(spark, [(1, 1, "user", "a.")]).limit(0)).count() == 0
