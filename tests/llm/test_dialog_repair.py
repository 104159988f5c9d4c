import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from itertools import count

import pytest
from pyspark.sql import functions as F

from clickloom.llm import dialog_repair, queries
from clickloom.llm.common import table
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")
BLANK = " \t\n\v\f\r"


def cheapest(rows, faults):
    """The least cost, then least audit, by a search over all edits of ``rows`` of role and text.

    A partial result is any start of a valid sequence of roles."""
    best, tie = {}, count()
    heap = [(0, "", 0, "", next(tie), ())]
    while heap:
        cost, audit, at, roles, _, out = heapq.heappop(heap)
        state = (at, roles[-1:], bool(roles))
        if best.setdefault(state, (cost, audit)) < (cost, audit):
            continue
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, audit, "\n".join(out)
        steps = [("I", 3, at, r[0], f"{r}:") for r in ("user", "assistant")]
        if at < len(rows):
            role, text = rows[at]
            extra = 3 if faults[at] == "truncated" else 0
            steps.append(("D", 4, at + 1, "", None))
            if faults[at] not in ("blank", "duplicate"):
                if role[:1]:
                    steps.append(("K", extra, at + 1, role[0], f"{role}:{text}"))
                steps += [("R", 3 + extra, at + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for letter, price, to, initial, line in steps:
            longer = roles + initial
            # Only the last two roles matter for what may follow.
            if re.fullmatch("s?(ua)*u?", longer):
                heapq.heappush(heap, (cost + price, audit + letter, to, longer, next(tie),
                                      out if line is None else (*out, line)))


def damaged(conv_id, turn, role, text):
    role, text = (" " if value is None else value for value in (role, text))
    kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(role, text)] * (2 if kind == 3 else 1)


def row_by_hand(conv_id, rows):
    """``rows``: turn, role and text after damage, in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, text = cheapest([row[1:] for row in rows], faults)
    return (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost,
            audit, hashlib.sha256(text.encode()).hexdigest())


def order(turn, role, text):
    whole = f"{len(role)}:{role}{text}"
    return turn is not None, turn or 0, hashlib.md5(whole.encode()).digest()


def by_hand(table_rows, change=lambda conv_id, turn, role, text: [(role or " ", text or " ")]):
    groups = defaultdict(list)
    for conv_id, turn, role, text in table_rows:
        groups[conv_id] += [(turn, *new) for new in change(conv_id, turn, role, text)]
    return sorted((row_by_hand(i, sorted(rows, key=lambda r: order(*r))) for i, rows in groups.items()), key=repr)


def found(frame, copies=None):
    return sorted(map(tuple, dialog_repair.audit_conversations(frame, copies).collect()), key=repr)


def drawn(draw, conv_id, size):
    roles = ["user", "assistant", "system", "tool", "", "uncle"]
    weights = draw.choice([(9, 9, 1, 1, 0, 0), (1, 1, 1, 1, 1, 1), (1, 0, 0, 0, 0, 0), (0, 1, 3, 0, 0, 0)])
    texts = ["Yes.", "No!", "Why? ", "and then", "", " \n", f"{draw.random()}."]
    rows, turn = [], 0
    for _ in range(size):
        turn += draw.choice([1, 1, 1, 2, 0])
        text = f"{draw.random()}." if draw.random() < 0.6 else draw.choice(texts)
        rows.append((conv_id, turn if draw.random() < 0.97 else None, draw.choices(roles, weights)[0], text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_repairs_as_by_a_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(dialog_repair, "CHUNK", chunk)
    draw = random.Random(chunk)
    rows = [row for i in range(60) for row in drawn(draw, i, draw.choice([1, 2, 5, 9, 30]))]
    wanted = by_hand(rows, lambda i, t, role, text: [(role, text)])
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == wanted


def test_vectors_that_never_converge(spark, monkeypatch):
    """Blank turns all go, so a chunk of them hands its vector on as it is."""
    monkeypatch.setattr(dialog_repair, "CHUNK", 4)
    passes = []
    real = dialog_repair._swept
    monkeypatch.setattr(dialog_repair, "_swept", lambda c, s: passes.append(s) or real(c, s))
    blank = [(1, n, "user", " " * n) for n in range(300)]
    rows = [(1, -1, "user", "Hello."), *blank, (1, 300, "assistant", "Well."), (1, 301, "user", "So?")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == by_hand(rows, lambda i, t, role, text: [(role, text)])
    assert passes == [1, 1, 4, 16, 64][: len(passes)]


def test_long_conversation_in_chunks_is_as_in_one(spark, monkeypatch):
    rows = spark.createDataFrame(drawn(random.Random(7), 1, 4000) + drawn(random.Random(8), None, 700), SCHEMA)
    whole = found(rows)
    monkeypatch.setattr(dialog_repair, "CHUNK", 16)
    assert found(rows.repartition(7)) == whole


def test_query_as_by_a_search_on_a_table(spark, small):
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    result = queries.op12_dialog_repair(spark, small)
    got = sorted(map(tuple, result.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ).collect()), key=repr)
    assert got == by_hand(rows, damaged)


def test_odd_rows(spark, clashing):
    rows = [(None if n % 5 == 0 else n % 3, None if n % 4 == 0 else n // 2, role, text)
            for n, (text, role) in enumerate((t, r) for t in ODD_TEXTS[:9] for r in ("user", None, "assistant", ""))]
    rows += [(9, 1, "user", "Same.")] * 40 + [(9, 2, "assistant", "Other.")] * 3 + [(10, None, None, None)]
    rows += [(11, -(2**63), "user", "a."), (11, 2**63 - 1, "assistant", "b.")]
    frame = clashing(spark.createDataFrame(rows, SCHEMA))
    wanted = by_hand([r for r in rows if r[0] != 11], lambda i, t, role, text: [(" " if role is None else role, " " if text is None else text)])
    got = found(frame)
    assert [r for r in got if r[0] != 11] == wanted
    assert next(r for r in got if r[0] == 11)[6:8] == (0, "KK")
    none = found(frame.where("conv_id = 9"), F.lit(0))
    assert none == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert found(frame.limit(0)) == []


def test_repaired_turns(spark, clashing):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Hm"), (2, 0, "tool", "x."),
            (3, 5, "user", "Q?"), (3, 6, "assistant", "A."), (3, 6, "assistant", "A.")]
    out = dialog_repair.repaired_turns(clashing(spark.createDataFrame(rows, SCHEMA)))
    lines = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r["conv_id"], r["position"])):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    digests = {r[0]: r[8] for r in by_hand(rows, lambda i, t, role, text: [(role, text)])}
    assert {i: hashlib.sha256("\n".join(some).encode()).hexdigest() for i, some in lines.items()} == {
        i: digest for i, digest in digests.items() if i in lines
    }
    assert digests[2] == hashlib.sha256(b"").hexdigest()
