"""Documents packed into training sequences, in order, by dynamic programming over cuts.

Positions where a sequence may end are the ends of documents, the ends of sentences, and within
a long sentence every STEP tokens. A sequence costs its padding, and a cut inside a document a
penalty. The least cost up to position p is

    f(p) = penalty(p) + window - p + min over q in [p - window, p) of (f(q) + q)

and the minimum over the sliding range comes from a monotone queue. A sequence whose length is a
power of two is not padded, so a document's end may also be reached over such a length at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm.byte_bpe import byte_bpe
from clickloom.llm.common import kept, map_rows, slices, text_of

WINDOW = 2048
STEP = 32  # at most so many tokens between two places for a cut
SENTENCE_CUT, HARD_CUT, SEQUENCE = 2.0, 8.0, 16.0  # costs, in tokens of padding
BLOCK = 4096  # documents that are packed together
FLUSH = 2_000_000  # tokens after which a block is packed as far as it has come
_NO_ID = -(1 << 63)


def best_cuts(
    places: list[int], penalties: list[float], window: int = WINDOW
) -> list[int]:
    """Ends of sequences for places in ascending order from 0. The last place is an end."""
    count = len(places)
    cost = [0.0] * count
    back = [0] * count
    index = {place: at for at, place in enumerate(places)}
    powers = [1 << k for k in range(window.bit_length() - 1)]
    # Monotone queue of places as candidates for the start, best first.
    queue, values, head = [0], [0.0], 0
    for at in range(1, count):
        place = places[at]
        oldest = place - window
        while places[queue[head]] < oldest:
            head += 1
        best, start = values[head] + window - place, queue[head]
        penalty = penalties[at]
        if not penalty:
            for power in powers:
                other = index.get(place - power)
                if other is not None and cost[other] < best:
                    best, start = cost[other], other
        best += penalty + SEQUENCE
        cost[at], back[at] = best, start
        value = best + place
        while len(queue) > head and values[-1] >= value:
            queue.pop()
            values.pop()
        queue.append(at)
        values.append(value)
        if head > 4096:
            del queue[:head], values[:head]
            head = 0
    ends, at = [], count - 1
    while at:
        ends.append(places[at])
        at = back[at]
    ends.reverse()
    return _last_split(ends, window)


def _last_split(ends: list[int], window: int) -> list[int]:
    """The last sequence in powers of two, where the cuts cost less than its padding."""
    if not ends:
        return ends
    start = ends[-2] if len(ends) > 1 else 0
    length = ends[-1] - start
    if length.bit_count() > 1 and (length.bit_count() - 1) * (HARD_CUT + SEQUENCE) < window - length:
        pieces = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
        ends = ends[:-1]
        for piece in pieces:
            start += piece
            ends.append(start)
    return ends


class _Packer:
    """Gathers the documents of a block and cuts them into pieces of sequences."""

    def __init__(self, first_sequence: int, window: int) -> None:
        self.sequence, self.window = first_sequence, window
        self._empty()

    def _empty(self) -> None:
        self.parts: list[tuple] = []  # id, start in its document, ids, tokens of the document
        self.places, self.penalties = [0], [0.0]

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> Iterator[list[tuple]]:
        """A document's ids, and how many of them lie before each end of a sentence. Yields
        pieces whenever enough tokens have come, within a very long document too."""
        count = len(ids)
        for start in range(0, count, FLUSH):
            part = ids[start : start + FLUSH]
            first, size = self.places[-1], len(part)
            inner = ends[(ends > start) & (ends < start + size)] - start
            places = np.unique(np.concatenate([inner, np.arange(STEP, size + STEP, STEP)]))
            places = places[places < size]
            penalties = np.full(len(places), HARD_CUT)
            penalties[np.searchsorted(places, inner)] = SENTENCE_CUT
            self.places += (places + first).tolist()
            self.penalties += penalties.tolist()
            self.places.append(first + size)
            self.penalties.append(0.0 if start + size == count else HARD_CUT)
            self.parts.append((doc_id, start, part.tobytes(), count))
            if self.places[-1] >= FLUSH:
                yield self.flush()

    def flush(self) -> list[tuple]:
        ends = best_cuts(self.places, self.penalties, self.window)
        rows, part, used, place = [], 0, 0, 0
        for end in ends:
            offset = 0
            while place < end:
                doc_id, start, ids, doc_tokens = self.parts[part]
                length = min(end - place, len(ids) // 4 - used)
                rows.append(
                    (doc_id, start + used, length, ids[4 * used : 4 * (used + length)],
                     doc_tokens, self.sequence, offset)
                )
                place, used, offset = place + length, used + length, offset + length
                if used == len(ids) // 4:
                    part, used = part + 1, 0
            self.sequence += 1
        self._empty()
        return rows


def _blocks(keys: DataFrame) -> DataFrame:
    """``id, tie, block`` for the distinct keys: rows are numbered in order, BLOCK of them a block.

    Keys are dealt by range and numbered in each range, and a range starts where the sum of those
    before ends. Where ranges begin is of no effect."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept(
        keys.groupBy("id", "tie")
        .agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange(parts, "id", "tie")
        .withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("part")
        .agg(F.sum("n").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = (
        Window.partitionBy("part").orderBy("id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return ranged.join(F.broadcast(starts), "part").select(
        "id", "tie", F.floor(place / BLOCK).alias("block")
    )


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW
) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids`` (binary: little-endian
    unsigned 32-bit integers), ``doc_tokens, sequence_id, offset``.

    Documents are packed in the order of their ids (equal ids by text, rows without an id first, by
    their text's hash), in blocks of about BLOCK of them however far apart the ids are, so a block
    needs one task at a time and results don't depend on the number of tasks, but for the numbers of the sequences. A null or empty
    text is its end token alone. Other columns are ignored; no rows give no pieces.
    """
    rows = docs.select("doc_id", text_of().alias("text")).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(0).alias("tie"),
        "doc_id",
        "text",
    )
    # Keys grow with the texts, so they are joined alike whatever the size.
    ordered = (
        rows.join(_blocks(rows.select("id", "tie")).hint("merge"), ["id", "tie"])
        .select("block", "doc_id", "text")
        .repartition("block")
        .sortWithinPartitions("block", "doc_id", "text")
    )
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
    def rows_out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 2000):
            columns = zip(*rows[at : at + 2000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        packer = _Packer(TaskContext.get().partitionId() << 33, window)
        current = None
        for batch in slices(batches, 2):
            for block, doc_id, text in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).to_pylist(),
                strict=True,
            ):
                if block != current:
                    yield from rows_out(packer.flush())
                    current = block
                ids, ends = bpe.encode(text)
                ids = np.append(ids, np.array([end_id], "<u4"))
                for rows in packer.add(doc_id, ids, ends):
                    yield from rows_out(rows)
        yield from rows_out(packer.flush())

    return map_rows(
        ordered,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long",
        work,
    )
