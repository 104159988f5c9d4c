"""Near-duplicate documents: a blocked sparse product of documents by word 5-grams.

Two documents link when their sets of 5-grams have a Jaccard likeness of 0.8 or more. With sizes
a and b that takes an overlap of at least 4 (a + b) / 9. The product of the incidence matrix with
its transpose counts overlaps, but is only carried out where a count can reach that bound:

1. Equal sets are one node.
2. All 5-grams are ordered, common ones last. A fixed table of counters, filled from all
   documents, says how common a 5-gram is; any order is right, this one keeps the product sparse.
   Linked sets share a 5-gram among the first n - ceil(0.8 n) + 1 of each (the head of the set).
3. Postings of heads are sorted by 5-gram in range partitions, so a very common one is spread
   over tasks. Rows of one 5-gram with few documents (a block) give a product entry for each
   pair. Long rows give entries with one centre only, the document with the fewest rare 5-grams.
4. Entries of a pair are added up. Pairs whose sum cannot make the overlap are discarded; the
   others are counted over their whole sets.
5. Nodes of a long row that are not in one component by then, and that the bounds allow, are
   paired too, and counted likewise. So no link is lost, but a group of many near copies costs
   its size and not its square.

5-grams are 64-bit hashes; two different ones with one hash would count as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import kept, map_rows, slices

SHINGLE = 5
COUNTERS = 1 << 21  # of the table of counters; 8 MB
PARTS = 32  # in which it is summed up
LONG_ROW = 32  # documents of a 5-gram beyond which its row is long
FILTER_BITS = 1 << 23  # of the filter for documents whose whole sets are needed; 1 MB

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SIGN = np.uint64(1 << 63)
_word_hash = xxhash.xxh3_64_intdigest


def shingle_set(text: str) -> np.ndarray:
    """Sorted hashes of the distinct 5-grams; of fewer words, one of the whole sequence."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array([_word_hash(word) for word in words], np.uint64)
    size = min(SHINGLE, len(words))
    grams = hashes[: len(hashes) - size + 1].copy()
    for step in range(1, size):
        grams = (grams ^ (grams >> np.uint64(29))) * _MIX
        grams += hashes[step : len(hashes) - size + 1 + step]
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    grams ^= grams >> np.uint64(32)
    return np.unique(grams + np.uint64(size))


def _counter_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("whole_text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )


def commonness(docs: DataFrame) -> np.ndarray:
    """Of each counter a class: 0 for what chance explains, more for common 5-grams."""
    part_size = COUNTERS // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, 0):
            grams = [shingle_set(text) for text in batch.column(0).to_pylist()]
            counters += np.bincount(_counter_of(np.concatenate(grams)), minlength=COUNTERS)
        for part in range(PARTS):
            values = counters[part * part_size : (part + 1) * part_size]
            if values.any():
                small = np.minimum(values, np.iinfo(np.uint32).max).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([small], pa.binary())],
                    names=["part", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(part, np.zeros(part_size, np.int64))
                sums[part] += np.frombuffer(counts, "<u4")
        for part, values in sums.items():
            small = np.minimum(values, np.iinfo(np.uint32).max).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([small], pa.binary())],
                names=["part", "counts"],
            )

    schema = "part int, counts binary"
    counted = map_rows(_texts(docs).select("whole_text"), schema, count)
    rows = map_rows(counted.repartition("part"), schema, add).collect()  # 8 MB for any input
    counters = np.zeros(COUNTERS, np.float64)
    for row in rows:
        counters[row["part"] * part_size : (row["part"] + 1) * part_size] = np.frombuffer(
            row["counts"], "<u4"
        )
    mean = counters.mean()
    usual = mean + 4 * math.sqrt(mean) + 1
    classes = np.floor(np.log2(np.maximum(counters, 1) / usual)) + 1
    return np.clip(classes, 0, 60).astype(np.uint8)


def _heads(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Of each document with words: size, two hashes of the set, the number of 5-grams of class
    0, the class and hash at which its head ends, and the head."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    names = ["doc_id", "n", "set_a", "set_b", "rare", "end_class", "end_hash", "head"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, 0):
            rows = []
            for text, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = shingle_set(text)
                size = len(grams)
                if not size:
                    rows.append((doc_id, 0, 0, 0, 0, 0, 0, None))
                    continue
                digest = xxhash.xxh3_128_intdigest(grams.tobytes())
                kinds = table[_counter_of(grams)]
                order = np.argsort(kinds, kind="stable")[: size - -(-4 * size // 5) + 1]
                head = grams[order]
                rows.append((
                    doc_id, size, (digest >> 64) - (1 << 63),
                    (digest & ((1 << 64) - 1)) - (1 << 63), int((kinds == 0).sum()),
                    int(kinds[order[-1]]), int((head[-1:] ^ _SIGN).view(np.int64)[0]),
                    head.view(np.int64),
                ))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.list_(pa.int64())]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
            )

    return map_rows(
        _texts(docs),
        "doc_id long, n long, set_a long, set_b long, rare long, end_class int, end_hash long, "
        "head array<long>",
        work,
    )


# Rows that the product gives: a node in a block, an entry of a pair, a node in a long row.
IN_BLOCK, ENTRY, IN_LONG_ROW = 0, 1, 2
_SIZE_BITS = 40


def _product(nodes: DataFrame) -> DataFrame:
    """``kind, gram, a, b`` from the sorted postings of all heads.

    A posting's ``place`` sorts a row of the matrix by the share of rare 5-grams, then size."""
    place = (
        F.floor(F.col("rare") * 1000 / F.col("n")).cast("long") * F.lit(1 << _SIZE_BITS)
        + F.col("n")
    )
    postings = (
        nodes.select(F.explode("head").alias("gram"), place.alias("place"), "node")
        .repartitionByRange("gram", "place", "node")
        .sortWithinPartitions("gram", "place", "node")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run()
        for batch in batches:
            yield from run.take(*(np.asarray(c, np.int64) for c in batch.columns), last=False)
        yield from run.take(*[np.zeros(0, np.int64)] * 3, last=True)

    return map_rows(postings, "kind byte, gram long, a long, b long", work)


class _Run:
    """Splits a sorted partition into rows of the matrix. The first and the last may go on in
    other partitions, so they count as long, whatever their length here."""

    def __init__(self) -> None:
        self.left = [np.zeros(0, np.int64)] * 3
        self.long: tuple[int, int] | None = None  # gram and centre of a long row that goes on
        self.first: int | None = None

    def take(
        self, gram: np.ndarray, place: np.ndarray, node: np.ndarray, last: bool
    ) -> Iterator[pa.RecordBatch]:
        gram, place, node = (
            np.concatenate(pair) for pair in zip(self.left, (gram, place, node), strict=True)
        )
        if not len(gram):
            return
        if self.first is None:
            self.first = int(gram[0])
        if not last:
            # The last row may go on in the next batch; what is known to be long need not wait.
            tail = int(np.searchsorted(gram == gram[-1], True)) if gram[0] != gram[-1] else 0
            if len(gram) - tail > LONG_ROW or gram[-1] == self.first:
                tail = len(gram)
        else:
            tail = len(gram)
        self.left = [values[tail:] for values in (gram, place, node)]
        gram, place, node = gram[:tail], place[:tail], node[:tail]
        if not len(gram):
            return
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        sizes = np.diff(np.r_[starts, len(gram)])
        long = (sizes > LONG_ROW) | (gram[starts] == self.first)
        centres = node[starts].copy()
        if self.long is not None and gram[0] == self.long[0]:
            long[0], centres[0] = True, self.long[1]
        if last:
            long[-1] = True
        self.long = (int(gram[-1]), int(centres[-1])) if long[-1] else None
        in_long = np.repeat(long, sizes)
        in_block = np.repeat(~long & (sizes > 1), sizes)
        yield _rows(IN_LONG_ROW, gram[in_long], node[in_long], np.repeat(centres, sizes)[in_long])
        yield _rows(IN_BLOCK, gram[in_block], node[in_block], node[in_block])
        gram, node = gram[in_block], node[in_block]
        n = place[in_block] & ((1 << _SIZE_BITS) - 1)
        for step in range(1, LONG_ROW):
            same = np.flatnonzero(gram[step:] == gram[:-step])
            if not len(same):
                break
            a, b, x, y = node[same], node[same + step], n[same], n[same + step]
            near = (5 * np.minimum(x, y) >= 4 * np.maximum(x, y)) & (a != b)
            a, b = a[near], b[near]
            yield _rows(ENTRY, gram[same][near], np.minimum(a, b), np.maximum(a, b))


def _rows(kind: int, gram: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(gram), kind, np.int8)), pa.array(gram), pa.array(a), pa.array(b)],
        names=["kind", "gram", "a", "b"],
    )


def _least_overlap(n_a: Column, n_b: Column) -> Column:
    return F.ceil((n_a + n_b) * 4 / 9).cast("long")


def _entries_needed(a: str, b: str) -> Column:
    """Entries in both heads that a link takes: of the set whose head ends first, what its head
    doesn't share is missing from the overlap."""
    first = F.struct(f"{a}.end_class", f"{a}.end_hash") <= F.struct(
        f"{b}.end_class", f"{b}.end_hash"
    )
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    size = F.when(first, n_a).otherwise(n_b)
    return _least_overlap(n_a, n_b) - F.ceil(size * 4 / 5).cast("long") + 1


def _sizes_fit(a: str, b: str) -> Column:
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b)


def _possible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs ``a, b, entries`` that the bounds allow. Long rows give no entry for each pair, so a
    pair may share as many of them as the one of its nodes that is in fewer."""
    return (
        pairs.alias("p")
        .join(facts.alias("x"), F.col("p.a") == F.col("x.node"))
        .join(facts.alias("y"), F.col("p.b") == F.col("y.node"))
        .where(_sizes_fit("x", "y"))
        .where(
            F.col("p.entries") + F.least("x.in_long", "y.in_long") >= _entries_needed("x", "y")
        )
        .select("p.a", "p.b")
    )


def _linked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose whole sets overlap enough. Only documents that a fixed-size filter lets pass
    give their sets (a full filter would let all pass, and be right too)."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    bit = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    blocks = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("block"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
        .collect()  # 1 MB at most
    )
    bits = np.zeros(FILTER_BITS + (1 << 15), bool)
    width = 1 << 15
    for row in blocks:
        # Bit 0 is in the bucket before the others; buckets of 32,768 bits count from 1.
        found = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        at = row["block"] * width
        bits[at : at + len(found)] |= found.astype(bool)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    candidates = _texts(docs).select(
        "whole_text",
        "doc_id",
        (F.expr(f"bitmap_bucket_number(pmod(xxhash64(doc_id), {FILTER_BITS}L))") * width
         + F.expr(f"bitmap_bit_position(pmod(xxhash64(doc_id), {FILTER_BITS}L))")).alias("bit"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            chosen = pa.array(table[np.asarray(batch.column(2), np.int64)])
            for part in slices(iter([batch.filter(chosen)]), 0):
                sets = [shingle_set(t).view(np.int64) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"]
                )

    sets = kept(
        map_rows(candidates.where("doc_id IS NOT NULL"), "node long, grams array<long>", work),
        "sets",
    )
    x, y = sets.alias("x"), sets.alias("y")
    overlap = F.size(F.array_intersect("x.grams", "y.grams"))
    return (
        pairs.alias("p")
        .join(x, F.col("p.b") == F.col("x.node"))
        .join(y, F.col("p.a") == F.col("y.node"))
        .where(overlap >= _least_overlap(F.size("x.grams"), F.size("y.grams")))
        .select("p.a", "p.b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of the links ``a, b``: the smallest node that is
    reachable. Each round hangs the greater neighbours of a node, and then the lesser ones, on
    the smallest of them (large and small stars); neighbours are never gathered."""
    edges = kept(links.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "least")
        )
        small = least.where("least < a")
        edges = kept(
            _hung(large.unionByName(small).select("a", F.col("least").alias("b")).distinct()),
            "edges",
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(roots.select("node", F.col("node").alias("component")))
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )


def _hung(edges: DataFrame) -> DataFrame:
    """Small stars: a node's lesser neighbours hang on the least of them."""
    down = edges.where("b < a")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), "least")
    return (
        moved.unionByName(least)
        .select("a", F.col("least").alias("b"))
        .distinct()
    )


def _split_rows(product: DataFrame, facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that share long rows only, lie in different components, and may be linked.

    Pairs with an entry have been judged before, so all that these share are long rows. A node
    that must share ``need`` of its long rows with a partner shares one of any ``own - need + 1``
    of them, and looks for partners in so many only."""
    rows = (
        product.where(F.col("kind") == IN_LONG_ROW)
        .select("gram", F.col("a").alias("node"))
        .distinct()
        .join(facts, "node")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    spans = rows.groupBy("gram").agg(
        F.min("n").alias("least_n"),
        F.max("n").alias("most_n"),
        F.min_by("component", F.struct(F.col("rare") / F.col("n"), "n", "node")).alias("main"),
    )
    need = (
        F.ceil((F.col("n") + F.greatest("least_n", F.ceil(F.col("n") * 4 / 5))) * 4 / 9)
        - F.ceil(F.least("most_n", F.floor(F.col("n") * 5 / 4)) * 4 / 5)
        + 1
    )
    own = Window.partitionBy("node")
    able = (
        rows.join(spans, "gram")
        .withColumn("need", F.greatest(F.min(need).over(own), F.lit(1)))
        .withColumn("own", F.count(F.lit(1)).over(own))
        .where("own >= need")
        .withColumn("nth", F.row_number().over(own.orderBy("gram")))
    )
    others = able.where("component <> main AND nth <= own - need + 1")
    return (
        others.alias("x")
        .join(able.alias("y"), F.col("x.gram") == F.col("y.gram"))
        .where("x.component <> y.component")
        .where(_sizes_fit("x", "y"))
        .where(F.least("x.own", "y.own") >= _entries_needed("x", "y"))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row.

    ``component_id`` is the smallest ``doc_id`` that links reach, the document's own included. A
    null or empty text, or one without words, has no 5-grams and is linked with nothing. Rows
    with one ``doc_id`` are one document: repeated rows are returned repeatedly, and different
    texts under one id share their component. Rows without an id are linked with nothing and
    have a null component. Other columns are ignored.
    """
    heads = kept(_heads(docs, commonness(docs)), "heads")
    known = heads.where("doc_id IS NOT NULL AND n > 0")
    nodes = kept(
        known.groupBy("set_a", "set_b").agg(
            F.min("doc_id").alias("node"),
            F.first(F.struct("n", "rare", "end_class", "end_hash", "head")).alias("set"),
        ).select("set_a", "set_b", "node", "set.*"),
        "nodes",
    )
    product = kept(_product(nodes), "product")
    counts = (
        product.where(F.col("kind") != ENTRY)
        .groupBy(F.col("a").alias("node"))
        .agg(
            F.count_if(F.col("kind") == IN_BLOCK).alias("in_block"),
            F.count_if(F.col("kind") == IN_LONG_ROW).alias("in_long"),
        )
    )
    facts = kept(
        nodes.select("node", "n", "rare", "end_class", "end_hash").join(counts, "node"), "facts"
    )
    entries = kept(
        product.where(F.col("kind") == ENTRY).groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("entries")
        ),
        "entries",
    )
    centres = product.where(F.col("kind") == IN_LONG_ROW).select("gram", "a", "b")
    # A row in several partitions has a centre in each; they are paired with one of them.
    tops = centres.groupBy("gram").agg(F.min("b").alias("top"), F.max("b").alias("other"))
    between = (
        centres.join(tops.where("top <> other"), "gram")
        .select(F.col("b").alias("x"), F.col("top").alias("y"))
    )
    stars = (
        centres.select(F.col("a").alias("x"), F.col("b").alias("y"))
        .unionByName(between)
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    pairs = (
        entries.unionByName(stars.withColumn("entries", F.lit(0).cast("long")))
        .groupBy("a", "b")
        .agg(F.sum("entries").alias("entries"))
    )
    links = kept(_linked(docs, kept(_possible(pairs, facts), "pairs")), "links")
    labels = kept(components(links), "labels")
    more = kept(_split_rows(product, facts, labels), "pairs")
    if not more.isEmpty():
        labels = components(links.unionByName(_linked(docs, more)))
    sets = heads.select("doc_id", F.col("n").alias("n_shingles"), "set_a", "set_b")
    named = nodes.select("set_a", "set_b", "node").join(labels, "node", "left")
    return (
        sets.join(named, ["set_a", "set_b"], "left")
        .withColumn(
            "component_id",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")),
        )
        .select("doc_id", "n_shingles", "component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that have a near-duplicate with a smaller id: of each
    component one stays, of repeated rows one, and rows without an id stay.

    Texts are not shuffled, but for those that a fixed-size filter cannot rule out."""
    facts = kept(
        near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.max(F.col("component_id") != F.col("doc_id")).alias("dropped"),
            F.count(F.lit(1)).alias("copies"),
        ).where("dropped OR copies > 1"),
        "dropped",
    )

    def word(place: Column) -> Column:
        return F.floor(place / 64).cast("long")

    def place(doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(FILTER_BITS))

    at = place(F.col("doc_id"))
    one = F.lit(1).cast("long")
    table = facts.groupBy(word(at).alias("filter_word")).agg(
        F.bit_or(F.call_function("shiftleft", one, (at % 64).cast("int"))).alias("filter_bits")
    )
    # At most FILTER_BITS / 64 rows, whatever the input.
    marked = docs.withColumn("filter_word", word(at)).join(
        F.broadcast(table), "filter_word", "left"
    )
    bit = F.call_function("shiftright", F.col("filter_bits"), (at % 64).cast("int"))
    maybe = F.coalesce(bit.bitwiseAND(one) == 1, F.lit(False)) & F.col("doc_id").isNotNull()
    sure = marked.where(~maybe).select(*docs.columns)
    others = (
        marked.where(maybe)
        .select(*docs.columns)
        .join(facts.where("dropped").select("doc_id"), "doc_id", "left_anti")
        # Of several texts under one id the first by text stays, whatever order they come in.
        .groupBy(F.col("doc_id").alias("same_id"))
        .agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("stays"))
        .select(*(F.col(f"stays.{name}").alias(name) for name in docs.columns))
    )
    return sure.unionByName(others)
