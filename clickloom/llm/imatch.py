"""I-Match fingerprints with several randomised lexicons.

Terms that are neither too common nor too rare form a lexicon: their inverse document frequency
lies in a band. Of a text's distinct terms those in the lexicon are sorted, and for each of a
fixed number of random subsets of the lexicon the terms in it are hashed. Two texts are alike as
far as these hashes are equal. Subsets come in levels, from a quarter of the lexicon to a 256th,
so texts of any length have some that hold a few of their terms.

Everything is column functions. A term is its code, 28 bits of its md5, and a subset is given by
a multiplier, so SQL elsewhere can repeat it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import dealt_by_range, kept

# Terms in more than one of 500 and fewer than one of 5 documents, in two at least.
# The band of idf is from ln 5 to ln 500.
LEAST_PARTS, MOST_PARTS = 5, 500
LEVELS = (4, 16, 64, 256)  # one of so many terms is in a subset
SUBSETS = 6  # of each level
MIDDLE = 20  # the lowest bit of a product of code and multiplier that is looked at
TOKEN = 6  # hex digits of a subset: two for its number of terms (up to 255), the rest a hash
# The lexicon has at most (distinct terms of an average document) * MOST_PARTS terms. Up to so many it
# is sent to all executors; a larger one is joined by shuffle.
SENT_TERMS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 63)


def multiplier(number: int) -> int:
    """An odd number of 31 bits for a subset."""
    return (0x9E3779B1 * (2 * number + 1) >> 3) % (1 << 31) | 1


def terms(text: Column) -> Column:
    """Distinct words, A to Z in lower case. An empty string may be among them."""
    return F.array_distinct(F.split(F.translate(text, UPPER, LOWER), "[\\x20\\x09-\\x0D]+"))


def code(term: Column) -> Column:
    return F.conv(F.substring(F.md5(term), 1, 7), 16, 10).cast("long")


def counted_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term, code, common`` of all terms in the band and, marked, of those too common for it,
    counted over all rows."""
    counted = (
        docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("term"))
        .where("term <> ''")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = docs.agg(F.count(F.lit(1)).alias("total")).scalar()
    common = F.col("n") * LEAST_PARTS > total
    in_band = (F.col("n") >= 2) & (F.col("n") * MOST_PARTS >= total) & ~common
    return counted.where(common | in_band).select(
        "term", code(F.col("term")).alias("code"), common.alias("common")
    )


def fingerprint(codes: Column, digest: Column) -> Column:
    """Hashes of all subsets, one after the other, of distinct codes; of a text without a term in
    any subset its digest, so that it is like equal texts only."""
    ordered = F.sort_array(codes)
    chosen = F.array(
        *[F.filter(ordered, _in_subset(n)) for n in range(len(LEVELS) * SUBSETS)]
    )
    tokens = F.transform(
        chosen,
        lambda some: F.concat(
            F.lpad(F.lower(F.hex(F.least(F.size(some), F.lit(255)))), 2, "0"),
            F.substring(F.md5(F.array_join(some, " ")), 1, TOKEN - 2),
        ),
    )
    # About a tenth of the lexicon is in no subset at all.
    held = F.exists(
        codes,
        lambda one: reduce(or_, [_in_subset(n)(one) for n in range(len(LEVELS) * SUBSETS)]),
    )
    return F.when(held, F.array_join(tokens, "")).otherwise(F.concat(F.lit("text "), digest))


def _in_subset(number: int) -> Callable[[Column], Column]:
    factor, level = multiplier(number), LEVELS[number // SUBSETS]

    def inside(one: Column) -> Column:
        return (one * F.lit(factor)).bitwiseAND(F.lit((level - 1) << MIDDLE).cast("long")) == 0

    return inside


def likeness(one: str, other: str) -> Column:
    """Share of equal hashes among the subsets that hold terms of either text. One term's change
    spoils a large subset and a small one alike, so a subset weighs less the more terms it has."""
    a, b = F.col(one), F.col(other)

    def size(token: Column) -> Column:
        return F.conv(F.substring(token, 1, 2), 16, 10).cast("int")

    def tally(sums: Column, at: Column) -> Column:
        x, y = F.substring(a, at, F.lit(TOKEN)), F.substring(b, at, F.lit(TOKEN))
        most = F.greatest(size(x), size(y))
        weight = F.when(most > 0, 1 / most).otherwise(F.lit(0.0))
        return F.struct(
            (sums["same"] + F.when(x == y, weight).otherwise(F.lit(0.0))).alias("same"),
            (sums["all"] + weight).alias("all"),
        )

    share = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(LEVELS) * SUBSETS * TOKEN), F.lit(TOKEN)),
        F.struct(F.lit(0.0).alias("same"), F.lit(0.0).alias("all")),
        tally,
        lambda sums: F.when(sums["all"] == 0, F.lit(0.0)).otherwise(
            F.least(sums["same"] / sums["all"], F.lit(1.0))
        ),
    )
    return F.when(a == b, F.lit(1.0)).when(
        a.startswith("text ") | b.startswith("text "), F.lit(0.0)
    ).otherwise(share)


def _in_order(keys: DataFrame) -> DataFrame:
    """Different keys ``id, tie`` with what came along, and the keys before and after each, in a ring.

    Windows see a range of keys, and then the ends of ranges, of which there are as many as the
    session has shuffle partitions."""
    me = F.struct("id", "tie", "n")
    placed = dealt_by_range(keys, "ranges", "id", "tie")
    in_part = Window.partitionBy("part").orderBy("id", "tie")
    rows = placed.withColumns({"ahead": F.lead(me).over(in_part), "behind": F.lag(me).over(in_part)})
    in_all, whole = Window.orderBy("part"), Window.partitionBy()
    ends = (
        placed.groupBy("part")
        .agg(F.min(me).alias("head"), F.max(me).alias("tail"))
        .select(
            "part",
            F.coalesce(F.lead("head").over(in_all), F.min("head").over(whole)).alias("part_ahead"),
            F.coalesce(F.lag("tail").over(in_all), F.max("tail").over(whole)).alias("part_behind"),
        )
    )
    return rows.join(ends, "part").select(
        *keys.columns,
        F.coalesce("ahead", "part_ahead").alias("ahead"),
        F.coalesce("behind", "part_behind").alias("behind"),
    )


def spread_terms(texts: DataFrame) -> DataFrame:
    """``id, tie, edited, term``: a row for each distinct term of a text, and one for the text as
    such, whose term is a blank, the digest and the key. So it is no word, and no join gathers those
    of all texts."""
    own = F.concat_ws(" ", F.lit(""), F.sha2("text", 256), "id", "tie")
    return texts.select(
        "id", "tie", "edited", F.explode(F.concat(F.array(own), terms(F.col("text")))).alias("term")
    )


def _digest(edited: bool) -> Column:
    own = F.col("term").startswith(" ") & (F.col("edited") == edited)
    return F.max(F.when(own, F.substring("term", 2, 64)))


def _coded(spread: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of terms in the band, with their codes, and those of texts as such.

    A lexicon of up to SENT_TERMS terms is sent. A larger one is joined by shuffle, after the terms
    too common for it are gone: there are LEAST_PARTS times as many of them as an average document
    has at most, so these are sent."""
    band = words.where(~F.col("common")).select("term", "code")
    if band.count() <= SENT_TERMS:
        joined = spread.join(F.broadcast(band), "term", "left")
    else:
        common = words.where("common").select("term")
        joined = spread.join(F.broadcast(common), "term", "left_anti").join(
            band.hint("merge"), "term", "left"
        )
    return joined.where(F.col("code").isNotNull() | F.col("term").startswith(" "))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    for each row.

    The edited text has its last quarter of code points (rounded down) replaced by the first as
    many of the next document, in the order of ids; after the last comes the first, and a lone
    document follows itself. Equal ids are in the order of their texts' hashes, repeated rows are
    one document in that order and are returned repeatedly, rows without an id come first. A null
    text is empty. Other columns are ignored; no rows give none. Texts are shuffled once.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select("id", F.xxhash64("text").alias("tie"), "text", F.length("text").alias("n"))
    words = kept(counted_terms(rows), "lexicon")
    order = kept(
        _in_order(rows.groupBy("id", "tie", "n").agg(F.count(F.lit(1)).alias("copies"))), "order"
    )
    # Both uses of the texts need the same columns, so that they share one shuffle.
    texts = rows.groupBy("id", "tie").agg(F.first("text").alias("text"))
    texts = texts.join(order.select("id", "tie", "behind"), ["id", "tie"])
    # The beginning of each text goes to the document before it.
    patches = texts.select(
        F.col("behind.id").alias("id"),
        F.col("behind.tie").alias("tie"),
        F.substring("text", F.lit(1), F.floor(F.col("behind.n") / 4).cast("int")).alias("patch"),
    )
    n = F.length("text")
    rest = (n - F.floor(n / 4)).cast("int")
    both = (
        texts.join(patches, ["id", "tie"])
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), rest), F.col("patch")))
        .select(
            "id",
            "tie",
            F.explode(
                F.array(
                    F.struct(F.lit(False).alias("edited"), F.col("text").alias("text")),
                    F.struct(F.lit(True).alias("edited"), F.col("edited").alias("text")),
                )
            ).alias("version"),
        )
        .select("id", "tie", "version.edited", F.col("version.text").alias("text"))
    )
    found = (
        _coded(spread_terms(both), words)
        .groupBy("id", "tie")
        .agg(
            F.collect_set(F.when(~F.col("edited"), F.col("code"))).alias("codes"),
            F.collect_set(F.when(F.col("edited"), F.col("code"))).alias("edited_codes"),
            _digest(False).alias("digest"),
            _digest(True).alias("edited_sha256"),
        )
    )
    prints = kept(
        found.select(
            "id",
            "tie",
            "edited_sha256",
            fingerprint(F.col("codes"), F.col("digest")).alias("fingerprint"),
            fingerprint(F.col("edited_codes"), F.col("edited_sha256")).alias("edited_fingerprint"),
        ),
        "prints",
    )
    following = prints.select(
        F.col("id").alias("next_id"),
        F.col("tie").alias("next_tie"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    return (
        prints.join(order, ["id", "tie"])
        .withColumns({"next_id": F.col("ahead.id"), "next_tie": F.col("ahead.tie")})
        .join(following, ["next_id", "next_tie"])
        .select(
            F.when(F.col("id") != _NO_ID, F.col("id")).alias("doc_id"),
            F.col("n").cast("long").alias("n_chars"),
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
            likeness("fingerprint", "next_fingerprint").alias("near_next"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
