"""Repair of conversations by a parallel Viterbi search with rank convergence.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. Its turns, in order,
are kept, given another role, or deleted, and turns are inserted; the cheapest edits are sought.

The turns are cut into chunks of some hundred. From its right end, a chunk works out the least
costs to the conversation's end for each of four states (a cost vector). Only a conversation's
last chunk knows the vector to start from; the others start from a speculative one. A step of the
search maps vectors that differ by a constant to vectors that differ by that constant, and after a
few turns most different vectors do: then all that lies further left is right but for a constant,
which changes no decision. Fix-up passes compare the vector that each chunk started from with the
one its right neighbour has found, and run chunks again that started from a really different one,
until there is none. In a pass, a run that changes a chunk's left vector goes on into the next
chunk, in stretches that double twice from pass to pass, so passes are few even where vectors
never converge.

With all costs stitched so, edits are traced forwards. Where several are cheapest, the smallest
letter is taken, which gives the least audit. A chunk is traced from each state, the maps of a
conversation's chunks are chained, and the trace from the true state counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import kept, map_rows, slices

CHUNK = 512  # entries of a chunk
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
SPACES, STOPS = " \t\n\v\f\r", (".", "!", "?")
PIECE = 256  # chunks that a task holds as Python objects at a time

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
# The one state that a user or assistant turn can lead to, by which inserted turns are known.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_KEPT = {(_NONE, "s"): _SYSTEM, (_NONE, "u"): _USER, (_SYSTEM, "u"): _USER,
         (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_INITIALS = "?sua"
_FINE, _CUT, _BAD = range(3)  # faults: none, truncated, to be deleted
_FAR = 1 << 20

Vector = tuple[int, ...]
END: Vector = (0, _FAR, _FAR, 0)


def _before(costs: list[int]) -> Vector:
    """With turns inserted first where that is cheaper, and the least cost taken off."""
    for _ in range(2):
        costs = [min(cost, INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    least = min(costs)
    return tuple(cost - least for cost in costs)


_START = _before(list(END))  # costs at a conversation's end; the speculative vector too


def _choices(vector: Vector, code: int) -> list[dict[str, tuple[int, int]]]:
    """For each state, what can be done with a turn: letter to cost and next state."""
    initial, fault = _INITIALS[code % 4], code // 4
    out = []
    for state in range(4):
        ways = {"D": (DELETE + vector[state], state)}
        if fault != _BAD:
            extra = TRUNCATED if fault == _CUT else 0
            to = _KEPT.get((state, initial))
            if to is not None:
                ways["K"] = (KEEP + extra + vector[to], to)
            ways["R"] = (REROLE + extra + vector[_NEXT[state]], _NEXT[state])
        out.append(ways)
    return out


@cache
def step_back(vector: Vector, code: int) -> Vector:
    """The cost vector before a turn from that after it, both less their least cost."""
    return _before([min(cost for cost, _ in ways.values()) for ways in _choices(vector, code)])


@cache
def step_on(vector: Vector, code: int, state: int) -> tuple[str, int]:
    """The letters up to and with a turn's own, and the next state, on the least cheapest path.
    ``vector`` is the one after the turn."""
    ways = _choices(vector, code)
    costs = [min(cost for cost, _ in of_state.values()) for of_state in ways]
    for _ in range(2):
        costs = [min(c, INSERT + costs[_NEXT[at]]) for at, c in enumerate(costs)]
    letters = ""
    while True:
        # Letters in ascending order; a turn's own and an insertion are never the same one.
        for letter in "DIKR":
            if letter == "I":
                if costs[state] == INSERT + costs[_NEXT[state]]:
                    letters, state = letters + letter, _NEXT[state]
                    break
            elif letter in ways[state] and ways[state][letter][0] == costs[state]:
                return letters + letter, ways[state][letter][1]


def finish(state: int) -> str:
    """Insertions after the last turn."""
    return {_NONE: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}[state]


def vectors_of(codes: bytes, right: Vector) -> list[Vector]:
    """The vector after each turn of a chunk, and first the one before all of them."""
    out = [right]
    for code in reversed(codes):
        right = step_back(right, code)
        out.append(right)
    out.reverse()
    return out


def left_of(codes: bytes, right: Vector) -> Vector:
    for code in reversed(codes):
        right = step_back(right, code)
    return right


def converged(codes: bytes, right: Vector, earlier: Vector) -> bool:
    """Whether a chunk's vectors from two starts differ by a constant from some turn on."""
    for code in reversed(codes):
        if right == earlier:
            return True
        right, earlier = step_back(right, code), step_back(earlier, code)
    return right == earlier


def trace(codes: bytes, right: Vector, state: int) -> tuple[list[str], int]:
    """The letters for each turn of a chunk, and the state after it."""
    letters = []
    for code, vector in zip(codes, vectors_of(codes, right)[1:], strict=True):
        some, state = step_on(vector, code, state)
        letters.append(some)
    return letters, state


def edit_cost(letters: str, codes: bytes) -> int:
    own = [letter for letter in letters if letter != "I"]
    cut = sum(letter != "D" and code // 4 == _CUT for letter, code in zip(own, codes))
    return (
        INSERT * letters.count("I") + REROLE * letters.count("R") + DELETE * letters.count("D")
        + TRUNCATED * cut
    )


def turns_of(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """``conv_id, turn, role, text, digest, copies, code``; nulls of role and text are a space.

    The digest tells turns of different role or text apart and orders those of one turn number;
    ``copies`` says how often a turn comes, 0 for one that is only known to have been there."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    turns = rows.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    first, body = F.substring("role", 1, 1), F.rtrim("text", F.lit(SPACES))
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    fault = (
        F.when(body == "", _BAD)
        .when(F.substring(body, -1, 1).isin(*STOPS), _FINE)
        .otherwise(_CUT)
    )
    return turns.select(
        "*", F.unhex(F.md5(whole)).alias("digest"), (initial + 4 * fault).cast("int").alias("code")
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, copies, code, part, place, first``: different turns in order.

    Equal rows of one turn are one entry. Entries are dealt by range and numbered in their part, so
    however many a conversation has, no task needs all of them. ``first`` says that role and text
    come for the first time in the conversation: the first of a part are found in the part, and
    only those are compared over parts.
    """
    spark = turns.sparkSession
    entries = turns.groupBy("conv_id", "turn", "digest").agg(
        F.sum("copies").alias("copies"), F.min("code").alias("code")
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept(
        entries.where("copies > 0")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id()),
        "turns",
    )
    same = ["conv_id", "digest"]
    local = ranged.withColumn("least", F.min("place").over(Window.partitionBy("part", *same)))
    firsts = local.where("place = least").withColumn("least", F.min("part").over(Window.partitionBy(*same)))
    return (
        firsts.withColumn("first", F.col("part") == F.col("least"))
        .unionByName(local.where("place > least").withColumn("first", F.lit(False)))
        .drop("least")
    )


def _chunks(entries: DataFrame) -> DataFrame:
    """One row for up to CHUNK neighbouring entries: ``conv_id, chunk``, the turn and digest of the
    first, and arrays of codes and copies. Chunks of a conversation are in the order of ``chunk``."""
    inside = F.struct("place", "turn", "digest", "code", "copies")
    code = F.when(F.col("first"), F.col("code")).otherwise(F.col("code") % 4 + 4 * _BAD)
    return (
        entries.withColumn("code", code)
        .groupBy("conv_id", F.struct("part", F.floor(F.col("place") / CHUNK).alias("piece")).alias("chunk"))
        .agg(F.array_sort(F.collect_list(inside)).alias("inside"))
        .select(
            "conv_id",
            "chunk",
            F.col("inside")[0]["turn"].alias("turn"),
            F.col("inside")[0]["digest"].alias("digest"),
            F.col("inside.code").alias("codes"),
            F.col("inside.copies").alias("copies"),
        )
    )


def _expanded(codes: list[int], copies: list[int]) -> bytes:
    """Codes with one more, to be deleted, for the further copies of an entry together. They all
    are deleted on the least cheapest path as soon as they come, and leave a vector's shape."""
    out = bytearray()
    for code, n in zip(codes, copies, strict=True):
        out.append(code)
        if n > 1:
            out.append(code % 4 + 4 * _BAD)
    return bytes(out)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _kinds(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys are equal; other names come from the right if both have them."""
    renamed = right.select(*(F.col(c).alias(f"right {c}" if c in keys else c) for c in right.columns))
    same = [F.col(key).eqNullSafe(F.col(f"`right {key}`")) for key in keys]
    left = left.drop(*(c for c in right.columns if c not in keys))
    return left.join(renamed, same, how).drop(*(f"right {key}" for key in keys))


def _swept(chunks: DataFrame, stretch: int) -> DataFrame:
    """Run chunks whose right neighbour has found another vector than they started from.

    Stretches of so many neighbouring chunks are run one after the other from the right. A chunk
    that has run before keeps its left vector if both starts lead to it."""
    names = chunks.columns
    read = ["conv_id", "number", "used", "found", "codes", "copies", "next_found"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id = number = moved = None
        for batch in _pieces(batches):
            rows = batch.select(read).to_pylist()
            for row in rows:
                right = tuple(row["next_found"] or _START)
                if number is not None and (row["conv_id"], row["number"]) == (conv_id, number - 1):
                    right = moved
                used = row["used"] and tuple(row["used"])
                if right != used:
                    codes = _expanded(row["codes"], row["copies"])
                    row["used"] = right
                    if used is None or not converged(codes, right, used):
                        row["found"] = left_of(codes, right)
                conv_id, number, moved = row["conv_id"], row["number"], tuple(row["found"])
            out = dict(zip(names, batch.columns, strict=True))
            for name in ("used", "found"):
                out[name] = pa.array([row[name] for row in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    group = F.floor((F.col("last") - F.col("number")) / stretch)
    dealt = chunks.repartition("conv_id", group).sortWithinPartitions("conv_id", F.desc("number"))
    return map_rows(dealt, _kinds(chunks), work)


def _stitched(chunks: DataFrame) -> DataFrame:
    """Chunks with ``number`` and ``last`` in their conversation, and ``used``, the true vector at
    their right end, less a constant."""
    of_conv = Window.partitionBy("conv_id")
    keys = chunks.select("conv_id", "chunk")
    numbered = keys.withColumns(
        {
            "number": F.row_number().over(of_conv.orderBy("chunk")).cast("long") - 1,
            "last": F.count(F.lit(1)).over(of_conv) - 1,
        }
    )
    vector = F.lit(None).cast("array<int>")
    begun = _joined(chunks, numbered, ["conv_id", "chunk"]).select(
        "conv_id", "turn", "digest", "codes", "copies", "number", "last",
        vector.alias("used"), vector.alias("found"), vector.alias("next_found"),
    )
    swept = kept(_swept(begun, 1), "speculative")
    alone, several = swept.where("last = 0"), swept.where("last > 0")
    stretch = 1
    while True:
        right = several.select(
            "conv_id", (F.col("number") - 1).alias("number"), F.col("found").alias("next_found")
        )
        facing = kept(_joined(several, right, ["conv_id", "number"], "left"), "facing")
        if facing.where("next_found is not null and next_found <> used").isEmpty():
            return alone.unionByName(facing).drop("found", "next_found")
        several = kept(_swept(facing, stretch), "fixed")
        stretch *= 4


def _entered(chunks: DataFrame) -> DataFrame:
    """Chunks with ``entry``, the state that the trace of those before leads to.

    A chunk is traced from each state, and a conversation's maps of states, a few bytes for a
    chunk, are chained in order."""
    alone, several = chunks.where("last = 0"), chunks.where("last > 0")

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            rows = batch.select(["codes", "copies", "used"]).to_pylist()
            leads = [
                [trace(_expanded(r["codes"], r["copies"]), tuple(r["used"]), s)[1] for s in range(4)]
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("number"), pa.array(leads, pa.list_(pa.int32()))],
                names=["conv_id", "number", "leads"],
            )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _NONE
        for batch in batches:
            entries = []
            for number, leads in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if number == 0:
                    state = _NONE
                entries.append(state)
                state = leads[state]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(entries, pa.int32())],
                names=["conv_id", "number", "entry"],
            )

    kind = chunks.schema["conv_id"].dataType.simpleString()
    leads = map_rows(several, f"conv_id {kind}, number long, leads array<int>", maps)
    entries = map_rows(
        leads.repartition("conv_id").sortWithinPartitions("conv_id", "number"),
        f"conv_id {kind}, number long, entry int",
        chain,
    )
    met = _joined(several, entries, ["conv_id", "number"])
    return alone.withColumn("entry", F.lit(_NONE)).unionByName(met)


def _traced(chunks: DataFrame) -> DataFrame:
    """Chunks with ``edits``: the letters of each entry without its further copies, and last those
    after the conversation's last turn; and ``cost``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            edits, costs = [], []
            for r in batch.to_pylist():
                codes = _expanded(r["codes"], r["copies"])
                letters, state = trace(codes, tuple(r["used"]), r["entry"])
                cost = edit_cost("".join(letters), codes)
                steps = iter(letters)
                own = []
                for n in r["copies"]:
                    own.append(next(steps))
                    if n > 1:
                        next(steps)
                        cost += DELETE * (n - 2)
                end = finish(state) if r["number"] == r["last"] else ""
                edits.append([*own, end])
                costs.append(cost + INSERT * len(end))
            names = ["conv_id", "turn", "digest", "codes", "copies"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(edits, pa.list_(pa.string())),
                 pa.array(costs, pa.int64())],
                names=[*names, "edits", "cost"],
            )

    shown = chunks.select("conv_id", "turn", "digest", "codes", "copies", "used", "number", "last", "entry")
    schema = _kinds(shown.select("conv_id", "turn", "digest", "codes", "copies"))
    return map_rows(shown, schema + ", edits array<string>, cost long", work)


def repair_plan(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different turns in order (see :func:`_ordered`), and the chunks with their edits."""
    entries = kept(_ordered(turns), "entries")
    return entries, kept(_traced(_entered(_stitched(_chunks(entries)))), "edits")


class _Conversation:
    """What has come of one conversation while its rows stream by."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.cost, self.illegal, self.audit = conv_id, 0, 0, []
        self.role, self.seen, self.edits = None, None, iter(())
        self.state, self.count, self.digest, self.end = _NONE, 0, hashlib.sha256(), ""

    def begin(self, row: dict) -> None:
        """A chunk: its costs and audit, and the roles that meet."""
        self.cost += row["cost"]
        for code, n, letters in zip(row["codes"], row["copies"], row["edits"]):
            role = _INITIALS[code % 4]
            if self.role is not None and self.role + role not in ("su", "ua", "au"):
                self.illegal += 1
            self.illegal += n - 1
            self.role = role
            self.audit.append(letters + "D" * (n - 1))
        self.end = row["edits"][-1]
        self.edits = iter(row["edits"])

    def turn(self, row: dict) -> Iterator[tuple]:
        key = row["turn"], row["digest"]
        if key == self.seen:  # a further copy
            return
        self.seen = key
        for letter in next(self.edits):
            if letter == "D":
                continue
            yield self.write(letter, row["role"], row["text"])

    def finish(self) -> Iterator[tuple]:
        self.audit.append(self.end)
        for letter in self.end:
            yield self.write(letter, "", "")

    def write(self, letter: str, role: str, text: str) -> tuple:
        if letter == "K":
            self.state = _KEPT[self.state, role[0]]
        else:
            self.state = _NEXT[self.state]
            role = _ROLES[self.state]
            if letter == "I":
                text = ""
        self.digest.update((("\n" if self.count else "") + f"{role}:{text}").encode())
        self.count += 1
        return self.conv_id, self.count - 1, letter, role, text


def _streamed(turns: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows of chunks, each followed by the turns that it edits, by conversation."""
    absent = {
        "codes": "array<int>", "copies": "array<bigint>", "edits": "array<string>", "cost": "bigint"
    }
    rows = turns.where("copies > 0").select(
        "conv_id", "turn", "digest", F.lit(1).alias("kind"), "role", "text",
        *(F.lit(None).cast(kind).alias(name) for name, kind in absent.items()),
    )
    heads = chunks.select(
        "conv_id", "turn", "digest", F.lit(0).alias("kind"),
        *(F.lit(None).cast("string").alias(name) for name in ("role", "text")), *absent,
    )
    return rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "digest", "kind"
    )


def _conversations(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple]:
    """Repaired turns, and after each conversation what it has come to (with None)."""
    one = None
    for batch in slices(batches, text):
        for row in batch.to_pylist():
            if one is None or row["conv_id"] != one.conv_id:
                if one is not None:
                    for turn in one.finish():
                        yield one, turn
                    yield one, None
                one = _Conversation(row["conv_id"])
            if row["kind"] == 0:
                one.begin(row)
            else:
                for turn in one.turn(row):
                    yield one, turn
    if one is not None:
        for turn in one.finish():
            yield one, turn
        yield one, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + len(row[-1]) // 1000
        if size >= at_once:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )


def repaired_turns(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, position`` (from 0), ``edit`` (K, R or I), ``role,
    text``. Inserted turns have an empty text. See :func:`audit_conversations`.

    A task streams through a conversation and holds a turn at a time, and a chunk of edits."""
    turns = turns_of(rows, copies)
    _, chunks = repair_plan(turns)
    stream = _streamed(turns, chunks)
    text = stream.columns.index("text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    shape = pa.schema(
        [("conv_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()),
         ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((turn for _, turn in _conversations(batches, text) if turn), shape)

    return map_rows(stream, f"conv_id {kind}, position long, edit string, role string, text string", work)


def audit_conversations(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Faults and cheapest repair of each conversation: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.

    Turns are taken by ``turn``, nulls first; turns of one number by a digest of role and text, and
    equal rows of one number are the same turn repeated. A null role or text is a space. ``copies``
    says how often a row comes; a conversation all of whose rows come 0 times has zeros, an empty
    audit and the digest of an empty text. Rows without ``conv_id`` are one conversation. Other
    columns are ignored; no rows give none.

    A digest needs a conversation's turns in order, so one task streams through a conversation.
    """
    turns = turns_of(rows, copies)
    entries, chunks = repair_plan(turns)
    stream = _streamed(turns, chunks)
    text = stream.columns.index("text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    shape = pa.schema(
        [("conv_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()),
         ("illegal", pa.int64()), ("cost", pa.int64()), ("repaired_sha256", pa.string()),
         ("audit", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = (
            (one.conv_id, one.illegal, one.cost, one.digest.hexdigest(), "".join(one.audit))
            for one, turn in _conversations(batches, text)
            if turn is None
        )
        yield from _batches(ends, shape)

    repaired = map_rows(
        stream, f"conv_id {kind}, illegal long, cost long, repaired_sha256 string, audit string", work
    )
    n, fault, first = F.col("copies"), F.floor(F.col("code") / 4), F.col("first")
    counted = (
        entries.groupBy("conv_id", "turn")
        .agg(
            F.sum(F.when(fault == _BAD, n).otherwise(0)).alias("blank"),
            F.sum(F.when(fault == _BAD, 0).when(first, n - 1).otherwise(n)).alias("duplicate"),
            F.sum(F.when((fault == _CUT) & first, 1).otherwise(0)).alias("truncated"),
        )
        .groupBy("conv_id")
        .agg(
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
            (
                F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1
                - F.count("turn")
            ).try_cast("long").alias("gaps"),
        )
    )
    ids = rows.select("conv_id").distinct()
    found = _joined(_joined(ids, counted, ["conv_id"], "left"), repaired, ["conv_id"], "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return found.select(
        "conv_id",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
