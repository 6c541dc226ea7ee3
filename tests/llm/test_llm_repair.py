import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from echolex.llm import repair as R
from echolex.llm.queries import op13_branch_and_bound

GOOD = re.compile(r"\A(s?(ua)+)?\Z")
BEGUN = re.compile(r"\A(s?(ua)*u?)?\Z")
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, edits) by uniform-cost search over the initials written so far."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, seq = heapq.heappop(heap)
        if i == len(rows) and GOOD.match(seq):
            return cost, audit
        state = (i, seq if len(seq) < 2 else seq[-1] + "..")
        if state in done:
            continue
        done.add(state)
        nexts = [(cost + 2, audit + "I", i, seq + r) for r in "ua"]
        if i < len(rows):
            role, _, fault = rows[i]
            cut = fault == "truncated"
            nexts.append((cost + 3, audit + "D", i + 1, seq))
            if fault not in ("blank", "duplicate"):
                nexts.append((cost + cut, audit + "K", i + 1, seq + role[0]))
                nexts += [(cost + 2 + cut, audit + "R", i + 1, seq + r) for r in "ua"]
        for move in nexts:
            if BEGUN.match(move[3]):
                heapq.heappush(heap, move)


def written(rows, audit):
    out, i, last = [], 0, ""
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            out.append(f"{rows[i][0]}:{rows[i][1]}")
            last = rows[i][0][0]
        else:
            last = "a" if last == "u" else "u"
            out.append({"a": "assistant", "u": "user"}[last] + ":" + ("" if edit == "I" else rows[i][1]))
        i += edit != "I"
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(table):
    """The result for rows (conv_id, turn, role, text), by plain Python."""
    found = defaultdict(list)
    for conv, turn, role, text in table:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, how = " " if role in (None, "") else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        found[conv]
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        for _ in range({0: 0, 3: 2}.get(how, 1)):
            found[conv].append((turn is not None, turn or 0, "user" if how == 4 else role, text))
    out = []
    for conv, rows in found.items():
        rows.sort()
        seen, faults = set(), []
        for _, _, role, text in rows:
            solid = SOLID.findall(text)
            faults.append(
                "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        plain = [(role, text, fault) for (_, _, role, text), fault in zip(rows, faults)]
        turns = {t for known, t, *_ in rows if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[0][0] + b[0][0] for a, b in zip(plain, plain[1:])]
        cost, audit = cheapest(plain)
        out.append(
            (conv, gaps, *[faults.count(f) for f in R.FAULTS], sum(p not in ("su", "ua", "au") for p in pairs))
            + (cost, audit, written(plain, audit))
        )
    return sorted(out, key=str)


def random_rows(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", " "]
    return [
        R.Row(rng.choice(roles), f"t{k}.", rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for k in range(n)
    ]


def test_search_finds_the_cheapest_edits():
    rng = random.Random(3)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(12))
        want = cheapest([(r.role, r.text, r.fault) for r in rows])
        assert min(R.search(rows, R.START, R.FINAL).values()) == want


def test_bounds_never_exceed_the_cost():
    rng = random.Random(4)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(9))
        for entry in range(4):
            for end, (cost, _) in R.search(rows, entry, range(4)).items():
                assert R.suffix_bounds(rows, (end,))[0][entry] <= cost


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_give_what_the_whole_gives(size):
    rng = random.Random(size)
    for _ in range(200):
        rows = random_rows(rng, rng.randrange(1, 14))
        whole = R.Conversation(1)
        for at in range(0, len(rows), size):
            part = rows[at : at + size]
            whole.add(R.Block(1, at == 0, part, list(range(at, at + len(part)))).record(0, at))
        got = whole.result()
        plain = [(r.role, r.text, r.fault) for r in rows]
        assert (got["cost"], got["audit"]) == cheapest(plain)
        assert got["repaired_sha256"] == written(plain, got["audit"])
        assert got["gaps"] == 0
        assert got["illegal"] == R.illegal_pairs([r.initial for r in rows])


def run(spark, table, **options):
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, copies string, _said int")
    frame = frame.drop("copies") if options.pop("bare", True) else frame
    return sorted(map(tuple, R.repair(R.damaged(frame), **options).collect()), key=str)


def awkward():
    rng = random.Random(8)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(["Yes.", "no", "Why?", " ", None, "x" * 3000 + "!"]))
        for c in range(60)
        for t in range(rng.randrange(9))
    ]
    rows += [(None, t, "user", f"q{t}?") for t in (None, None, 3, 9)]
    rows += [(70, None, "user", "a."), (70, None, "user", "a."), (71, -5, "assistant", "b.")]
    rows += [(72, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
    return rows + rows[5:9]


def test_conversations(spark):
    rows = awkward()
    want = expected(rows)
    assert run(spark, [(*r, "x", 1) for r in rows]) == want
    assert run(spark, [(*r, "x", 1) for r in rows], bare=False, partitions=13) == want
    assert run(spark, []) == []


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, op13_branch_and_bound(spark, sf_dir).collect()), key=str) == expected(map(tuple, rows))


def test_a_conversation_over_several_blocks_and_tasks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), f"text {t % 40}.") for c in range(3) for t in range(150)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, R.repair(R.damaged(frame), partitions=16).collect()), key=str)
    assert got == expected(rows)
