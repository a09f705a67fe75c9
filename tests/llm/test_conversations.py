"""Against an enumeration of all cheap lists of edits, and a plain version of the whole query."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from seqtable.llm import conversations as C

BLANKS = " \t\n\x0b\x0c\r"


def plain_faults(rows):
    """First fault of each (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.strip(BLANKS)
        if not solid:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def all_edits(rows, faults, most):
    """Every (cost, initials, roles and texts) up to a cost, without regard to what is sound."""

    def go(k, cost, edits, left):
        if cost > most:
            return
        yield_here = k == len(rows)
        if yield_here:
            yield cost, edits, left
        for name in ("user", "assistant"):
            yield from go(k, cost + 3, edits + "I", [*left, (name, "")])
        if yield_here:
            return
        _, role, text = rows[k]
        yield from go(k + 1, cost + 4, edits + "D", left)
        if faults[k] not in ("blank", "duplicate"):
            more = 3 * (faults[k] == "truncated")
            yield from go(k + 1, cost + more, edits + "K", [*left, (role, text)])
            for name in ("user", "assistant"):
                yield from go(k + 1, cost + 3 + more, edits + "R", [*left, (name, text)])

    return [e for e in go(0, 0, "", []) if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in e[2]))]


def cheapest(rows, faults):
    """The same by shortest paths over (rows read, state): (cost, initials) grow along every edge."""
    import heapq

    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, k, state, left = heapq.heappop(heap)
        if k == len(rows) and state in (0, 3):
            return cost, edits, list(left)
        if (k, state) in done:
            continue
        done.add((k, state))
        name, after = ("assistant", 3) if state == 2 else ("user", 2)
        heapq.heappush(heap, (cost + 3, edits + "I", k, after, (*left, (name, ""))))
        if k < len(rows):
            _, role, text = rows[k]
            heapq.heappush(heap, (cost + 4, edits + "D", k + 1, state, left))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 * (faults[k] == "truncated")
                heapq.heappush(heap, (cost + 3 + more, edits + "R", k + 1, after, (*left, (name, text))))
                if role[:1] == name[0]:
                    heapq.heappush(heap, (cost + more, edits + "K", k + 1, after, (*left, (role, text))))
                if role[:1] == "s" and state == 0:
                    heapq.heappush(heap, (cost + more, edits + "K", k + 1, 1, (*left, (role, text))))
    raise AssertionError


def streamed(rows, faults, held=C.HELD):
    own = C.Conversation(C.Automaton(), held)
    edits = list(C._edits(own, iter([(0, t, r, x, False, f) for (t, r, x), f in zip(rows, faults, strict=True)])))
    return own.cost, "".join(e for e, _, _ in edits), [(role, row[2] if row else "") for _, row, role in edits if role is not None]


def drawn(draw, n, roles=("system", "user", "assistant", "tool", "")):
    texts = ["Yes.", "no", "", " ", "So?", "Go!\n", "and then ", *[f"{i}." for i in range(20)]]
    return [(t, draw.choice(roles), draw.choice(texts)) for t in range(n)]


def test_edits_against_enumeration():
    draw = random.Random(1)
    for _ in range(150):
        rows = drawn(draw, draw.randint(0, 3), ("system", "user", "assistant", "tool"))
        faults = plain_faults(rows)
        found = streamed(rows, faults)
        every = all_edits(rows, faults, found[0])
        least = min(c for c, _, _ in every)
        assert found[:2] == min((c, e) for c, e, _ in every if c == least)
        assert found in [(c, e, left) for c, e, left in every]


def test_longer_ones_against_shortest_paths():
    draw = random.Random(2)
    for k in range(400):
        rows = drawn(draw, draw.randint(4, 40), [("system", "user", "assistant", "tool", ""), ("user", "assistant"), ("tool",)][k % 3])
        faults = plain_faults(rows)
        assert streamed(rows, faults) == cheapest(rows, faults)


@pytest.mark.parametrize("roles", [("tool",), ("user", "assistant"), ("system", "user", "assistant", "x")])
def test_giant_conversations_spill_and_agree(roles, monkeypatch):
    draw = random.Random(3)
    rows = [(t, draw.choice(roles), f"{t} {'.' if draw.random() < 0.9 else ''}") for t in range(20_000)]
    faults = plain_faults(rows)
    spills = []
    plain = C.Open._spill
    monkeypatch.setattr(C.Open, "_spill", lambda self: (spills.append(1), plain(self)))
    whole = streamed(rows, faults)
    assert not spills
    assert streamed(rows, faults, held=100_000) == whole
    # Without a sound role the two ways of pairing stay open to the end.
    assert (len(spills) > 10) == (roles == ("tool",))
    assert len(re.findall("[KRD]", whole[1])) == 20_000
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in whole[2]))


def test_decided_rows_leave_memory():
    own = C.Conversation(C.Automaton(), C.HELD)
    most = 0
    for t in range(50_000):
        list(own.add(t, ("user", "assistant")[t % 2], f"{t}.", None))
        most = max(most, len(own.open.rows))
    assert most <= 2 * C.LOOK and own.open.file is None


def expected(rows):
    """The whole query on (conv_id, turn, role, text)."""
    by_name = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        by_name.setdefault(conv, []).extend([(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1))
    out = {}
    for conv, rows in by_name.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = plain_faults(rows)
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit, left = cheapest(rows, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        )
    return out


def odd_rows():
    draw = random.Random(4)
    rows = [(c, t, r, f"{x} {c}{t}" if draw.random() < 0.5 else x) for c in (None, *range(60)) for t, r, x in drawn(draw, draw.randint(0, 9))]
    rows += [(7, None, "user", "a."), (7, None, None, None), (8, 3, "assistant", None), (9, 2, "user", "long. " * 50_000)]
    rows += rows[:20]  # ties
    return rows + [(100 + c, 0, "user", "alone.") for c in range(40)]


def test_odd_table_against_plain_version(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, dropped int")
    found = {r[0]: tuple(r)[1:] for r in C.audits(C.damage(frame)).collect()}
    assert found == expected(rows)
    assert any(v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for v in found.values())  # all rows dropped


def test_repaired_turns(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = C.repair(frame).collect()
    audits = {r.conv_id: r for r in C.audits(frame).collect()}
    assert audits.keys() == {r[0] for r in rows}
    for conv, audit in audits.items():
        own = sorted((e for e in edits if e.conv_id == conv), key=lambda e: e.place)
        assert "".join(e.edit for e in own) == audit.audit
        left = [f"{e.role}:{e.text}" for e in own if e.edit != "D"]
        assert hashlib.sha256("\n".join(left).encode()).hexdigest() == audit.repaired_sha256
        assert sum(e.fault == "duplicate" for e in own) == audit.duplicate
        assert sum(e.edit != "I" for e in own) == sum(r[0] == conv for r in rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.audits(C.damage(frame)).count() == 0 and C.repair(frame).count() == 0


def test_query(spark):
    from seqtable.llm.queries import op11_conversations

    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op11_conversations(spark, folder)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == expected(rows)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
