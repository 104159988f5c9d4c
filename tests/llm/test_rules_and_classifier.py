import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import attention_mil as mil, repetition
from clickloom.llm.common import table
from tests.llm.conftest import ODD_TEXTS


def longest_by_hand(words):
    found = []
    for p in range(len(words)):
        best = 0
        for q in range(len(words)):
            length = 0
            while (
                p != q
                and max(p, q) + length < len(words)
                and words[p + length] == words[q + length]
            ):
                length += 1
            best = max(best, length)
        found.append(best)
    return found


@pytest.mark.parametrize("seed", range(60))
def test_repeats_as_by_hand(seed):
    draw = random.Random(seed)
    texts = [
        [draw.randint(0, draw.choice([0, 1, 2, 9])) for _ in range(draw.randint(0, 30))]
        for _ in range(draw.randint(1, 5))
    ]
    words = np.array([w for text in texts for w in text], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    want = [n for text in texts for n in longest_by_hand(text)]
    assert repetition.repeat_lengths(words, owner).tolist() == want


def test_rules_of_odd_rows(docs, clashing):
    clean = " ".join(f"word{n}" for n in range(200))
    half = " ".join(f"w{n}" for n in range(50))
    rows = clashing(docs(*ODD_TEXTS, clean, f"{clean} {half} {half}", (None, clean), (12, clean)))
    found = repetition.repetition_rules(rows).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    by_id = {row["doc_id"]: row for row in found}
    assert by_id[0]["base_failed"] and by_id[0]["n_words"] == 0 and not by_id[0]["kept"]
    assert by_id[10]["n_repeat_words"] == by_id[10]["n_words"] == 6000
    assert by_id[12]["kept"] and by_id[None]["kept"]
    assert by_id[13]["longest_repeat"] == 50 and not by_id[13]["kept"]
    assert repetition.repetition_rules(rows.limit(0)).count() == 0


def test_slopes_are_the_losss():
    draw = np.random.default_rng(0)
    vectors, bags = mil.passages(["word! " * n for n in (1, 70, 200, 3)])
    vectors = draw.normal(size=vectors.shape)
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    shapes = {"encode": (mil.FEATURES, mil.HIDDEN), "encode_bias": mil.HIDDEN,
              "value": (mil.HIDDEN, mil.GATES), "gate": (mil.HIDDEN, mil.GATES),
              "attend": mil.GATES, "out": mil.HIDDEN, "out_bias": 1}
    weights = {name: draw.normal(size=shape) * 0.5 for name, shape in shapes.items()}

    def loss(w):
        score = mil._forward(w, vectors, bags)["score"]
        return -(labels * np.log(score) + (1 - labels) * np.log(1 - score)).mean()

    for name, slope in mil._slopes(weights, vectors, bags, labels).items():
        at = tuple(draw.integers(0, n) for n in slope.shape)
        up, down = ({**weights, name: weights[name].copy()} for _ in range(2))
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert slope[at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-6)


def texts_with_one_passage_that_decides(seed, n):
    """Long texts whose passages are of good or of bad words by chance; only the one with digits
    counts."""
    draw = random.Random(seed)
    good = ["garden", "river", "letter", "window"]
    bad = ["casino", "jackpot", "refill", "voucher"]
    texts, labels = [], []
    for _ in range(n):
        share = draw.random()
        passages = [
            draw.choices(good if draw.random() < share else bad, k=mil.PASSAGE_WORDS)
            for _ in range(draw.randint(60, 120))
        ]
        labels.append(draw.randint(0, 1))
        key = draw.choices(good if labels[-1] else bad, k=mil.PASSAGE_WORDS // 2)
        passages[draw.randrange(len(passages))] = [w for x in key for w in (x, "2019")]
        texts.append(" ".join(w for passage in passages for w in passage))
    return texts, np.array(labels, float)


def test_attention_finds_the_passage_that_decides(monkeypatch):
    texts, labels = texts_with_one_passage_that_decides(1, 120)
    seen = mil.passages(texts)
    texts, wanted = texts_with_one_passage_that_decides(2, 200)
    new = mil.passages(texts)

    def right():
        return ((mil.fit(*seen, labels).scores(*new) >= 0.5) == (wanted == 1)).mean()

    by_attention, forward = right(), mil._forward
    level = {"attend": np.zeros(mil.GATES)}  # equal weights: the mean over passages
    monkeypatch.setattr(mil, "_forward", lambda w, x, bags: forward({**w, **level}, x, bags))
    assert by_attention > 0.95 and right() < 0.8


def test_words_and_pairs_count_in_vectors():
    plain, other, turned = (
        mil.passages([text])[0][0] for text in ("aa bb cc dd", "aa bb cc ee", "bb aa dd cc")
    )
    measures, words = mil._MEASURES, mil._MEASURES + mil.HASHED
    assert (plain[:measures] == other[:measures]).all() and (plain[measures:] != other[measures:]).any()
    assert np.allclose(plain[:words], turned[:words]) and (plain[words:] != turned[words:]).any()
    assert np.allclose(mil.passages(["AA bb CC dd"])[0][0][measures:], plain[measures:])


def test_fold_loss_scores_each_bag_by_a_fit_without_it(monkeypatch):
    vectors, bags = mil.passages([f"text {n} " * (20 * n) for n in range(1, 9)])
    labels = np.array([0, 1] * 4, float)
    seen = []

    def fit(vectors, bags, labels, scale):
        seen.append((len(vectors), bags.tolist(), labels.tolist(), scale))
        return mil.AttentionModel(0.75)

    monkeypatch.setattr(mil, "fit", fit)
    assert mil.fold_loss(vectors, bags, labels, 0.3) == pytest.approx(
        -(np.log(0.75) + np.log(0.25)) / 2
    )
    for fold, (n, sizes, marks, scale) in enumerate(seen):
        kept = [i for i in range(8) if i % 3 != fold]
        assert sizes == bags[kept].tolist() and n == sum(sizes) and scale == 0.3
        assert marks == labels[kept].tolist()


def test_fit_rows_hold_no_held_out_label(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    turned = labels.withColumn(
        "quality",
        F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(
            F.col("quality")
        ),
    )
    for one, other in zip(mil.fit_rows(docs, labels), mil.fit_rows(docs, turned), strict=True):
        assert len(one) and (one == other).all()
    assert [len(part) for part in mil.fit_rows(docs, labels.limit(0))] == [0, 0, 0]


@pytest.mark.parametrize("total", [1, 2, 5, 47, 48, 49, 313, 5000])
def test_spans_leave_no_passage_out(total):
    vectors = np.random.default_rng(total).normal(size=(total, 3)).astype(np.float32)
    for most in (1, 4, 48):
        found = mil.spans(vectors, most)
        assert len(found) == min(total, most) and found.dtype == vectors.dtype
        bounds = [i * total // len(found) for i in range(len(found) + 1)]
        wanted = [vectors[a:b].mean(axis=0) for a, b in zip(bounds, bounds[1:])]
        assert np.allclose(found, wanted, atol=1e-5)


def test_the_fit_sees_the_whole_of_long_texts(spark):
    """What tells good from bad is in one passage of 400, at a place that an even choice of 48 leaves out."""
    draw = random.Random(3)
    rows = []
    for number in range(240):
        passages = ["lamp stone cloud paper " * (mil.PASSAGE_WORDS // 4)] * 400
        at = draw.choice([3, 104, 250, 398])
        passages[at] = ("#*$ 77|88 " if number % 2 else "Garden River ") * (mil.PASSAGE_WORDS // 2)
        rows.append((number, " ".join(passages)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(number, (number + 1) % 2) for number, _ in rows], "doc_id long, quality int"
    )
    model = mil.train(docs, labels)
    found = mil.score_documents(docs, model).collect()
    assert all((row["score"] >= 0.5) == (row["doc_id"] % 2 == 0) for row in found)


def test_held_out_accuracy(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = mil.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in mil.score_documents(docs, model).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = [(scores[r["doc_id"]] >= 0.5) == (r["quality"] == 1) for r in held]
    assert len(held) > 80 and sum(right) / len(right) > 0.95


def test_scores_of_odd_rows_and_odd_labels(spark, docs, clashing):
    rows = clashing(docs(*ODD_TEXTS, (None, "x y"), (4, "x y")))
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(None, 1, 0), (4, None, 0), (5, 7, 0)], [(4, 1, 0)], [(4, 1, 0), (6, 0, 0)]):
        model = mil.train(rows, spark.createDataFrame(labels, schema))
        found = mil.score_documents(rows, model).collect()
        assert len(found) == len(ODD_TEXTS) + 2
        assert all(0.0 <= row["score"] <= 1.0 for row in found)
        assert all(row["score"] == 0.0 for row in found if row["doc_id"] in (0, 1, 2))
    assert mil.score_documents(rows.limit(0), model).count() == 0
