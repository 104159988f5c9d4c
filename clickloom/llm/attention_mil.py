"""Quality classifier: a document is a bag of passages, judged by gated attention over them.

Each passage of a text becomes a vector: shares of signs, statistics of its words, and its words and
pairs of neighbouring words, hashed into a fixed number of columns. A small network encodes the
passages, weighs them by gated attention, and scores the weighted mean of the encodings. Only
documents have labels; which passages matter is learned from them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import map_rows, slices

PASSAGE_WORDS = 64
# The model is fitted on a bounded sample of so many labelled documents at most. Their whole texts
# count: of a text with more than so many passages, neighbouring ones are averaged for the fit.
FIT_DOCUMENTS, FIT_PASSAGES = 3000, 48
HIDDEN, GATES, STEPS, RATE, DECAY, SEED = 16, 8, 300, 0.02, 1e-3, 7

_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:",
    b"!",
    b"?",
    b"#*$%&",
    b"|",
    b"<>",
    b"'\"()[]{}-_/\\+=@~^`",
)
_CLASS = np.full(256, len(_GROUPS), np.int64)  # the rest: control signs, and bytes of other letters
for _number, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _number
_CLASSES = len(_GROUPS) + 1
_MEASURES = _CLASSES + 6
# Columns for hashed words, and as many for pairs. One word says less than a share of the whole
# passage, so these columns count less in the fit; with few labelled rows a full weight overfits.
HASHED, HASHED_SCALE = 64, 0.1
FEATURES = _MEASURES + 2 * HASHED


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread evenly, alike on every machine."""
    codes = (codes ^ (codes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    codes = (codes ^ (codes >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return codes ^ (codes >> np.uint64(33))


def _hashed(codes: np.ndarray, owner: np.ndarray, total: int) -> np.ndarray:
    """Sums of signs by passage and column, over the root of how many there are."""
    codes = _mixed(codes)
    column = (codes % np.uint64(HASHED)).astype(np.int64)
    sign = np.where(codes >> np.uint64(63), 1.0, -1.0)
    sums = np.bincount(owner * HASHED + column, weights=sign, minlength=total * HASHED)
    n = np.maximum(1, np.bincount(owner, minlength=total))
    return sums.reshape(total, HASHED) / np.sqrt(n)[:, None]


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages in order, and how many each text has (one at least)."""
    split = [text.encode().split() for text in texts]
    n_words = np.array([len(words) for words in split], np.int64)
    bags = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    total = int(bags.sum())
    words = [word for some in split for word in some]
    vectors = np.zeros((total, FEATURES), np.float32)
    if not words:
        return vectors, bags
    first = np.cumsum(n_words) - n_words
    within = np.arange(len(words)) - np.repeat(first, n_words)
    owner = np.repeat(np.cumsum(bags) - bags, n_words) + within // PASSAGE_WORDS
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    signs = _CLASS[np.frombuffer(b"".join(words), np.uint8)]
    counts = np.bincount(
        np.repeat(owner, sizes) * _CLASSES + signs, minlength=total * _CLASSES
    ).reshape(total, _CLASSES)
    numbers: dict[bytes, int] = {}
    give = numbers.setdefault
    ids = np.array([give(word, len(numbers)) for word in words], np.int64)
    pairs = np.unique(owner * len(numbers) + ids)
    n = np.maximum(1, np.bincount(owner, minlength=total)).astype(np.float64)
    letters = np.maximum(1, counts.sum(axis=1))
    again = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
    mean = np.bincount(owner, weights=sizes, minlength=total) / n
    square = np.bincount(owner, weights=sizes.astype(np.float64) ** 2, minlength=total) / n
    # Words that are signs only, and words whose last sign is neither letter nor punctuation.
    starts = np.cumsum(sizes) - sizes
    ends = signs[starts + sizes - 1]
    vectors[:, :_CLASSES] = counts / letters[:, None]
    others = (
        np.bincount(pairs // len(numbers), minlength=total) / n,
        np.bincount(owner[1:], weights=again, minlength=total) / n,
        np.bincount(owner, weights=(ends >= 4) & (ends < len(_GROUPS)), minlength=total) / n,
        mean / 10,
        np.sqrt(np.maximum(0, square - mean**2)) / 10,
        np.log1p(n) / 5,
    )
    for at, column in enumerate(others):
        vectors[:, _CLASSES + at] = column
    codes = np.fromiter((zlib.crc32(word.lower()) for word in numbers), np.uint64, len(numbers))[ids]
    vectors[:, _MEASURES : _MEASURES + HASHED] = _hashed(codes, owner, total)
    beside = owner[1:] == owner[:-1]
    follow = ((codes[:-1] << np.uint64(32)) | codes[1:])[beside]
    vectors[:, _MEASURES + HASHED :] = _hashed(follow, owner[1:][beside], total)
    return vectors, bags


def spans(vectors: np.ndarray, most: int) -> np.ndarray:
    """The passages of one text, or means over ``most`` stretches of them that leave none out."""
    total = len(vectors)
    if total <= most:
        return vectors
    starts = np.arange(most) * total // most
    sums = np.add.reduceat(vectors, starts, dtype=np.float64)
    return (sums / np.diff(starts, append=total)[:, None]).astype(vectors.dtype)


@dataclass(frozen=True)
class AttentionModel:
    """Weights of the network; without a fit (no labels of both kinds) a constant score."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def scores(self, vectors: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bags), self.prior)
        scaled = (vectors - self.weights["mean"]) / self.weights["spread"]
        return _forward(self.weights, scaled, bags)["score"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
    starts = np.cumsum(bags) - bags
    encoded = np.tanh(x @ w["encode"].astype(x.dtype) + w["encode_bias"])
    value, gate = np.tanh(encoded @ w["value"]), _sigmoid(encoded @ w["gate"])
    raw = (value * gate) @ w["attend"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), bags))
    weight = raw / np.repeat(np.add.reduceat(raw, starts), bags)
    pooled = np.add.reduceat(encoded * weight[:, None], starts)
    score = _sigmoid(pooled @ w["out"] + w["out_bias"][0])
    return {"encoded": encoded, "value": value, "gate": gate, "weight": weight,
            "pooled": pooled, "score": score, "starts": starts}


def fit(
    vectors: np.ndarray, bags: np.ndarray, labels: np.ndarray, hashed_scale: float = HASHED_SCALE
) -> AttentionModel:
    """Adam on the mean log loss over all bags at once."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if prior in (0.0, 1.0) or not len(labels):
        return AttentionModel(prior)
    draw = np.random.default_rng(SEED)
    mean, spread = vectors.mean(axis=0, dtype=np.float64), vectors.std(axis=0, dtype=np.float64) + 1e-3
    spread[_MEASURES:] /= hashed_scale
    x = ((vectors - mean) / spread).astype(np.float32)
    w = {
        "encode": draw.normal(0, 1 / np.sqrt(_MEASURES), (FEATURES, HIDDEN)),
        "encode_bias": np.zeros(HIDDEN),
        "value": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATES)),
        "gate": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATES)),
        "attend": draw.normal(0, 1 / np.sqrt(GATES), GATES),
        "out": draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "out_bias": np.array([np.log(prior / (1 - prior))]),
    }
    first = {name: np.zeros_like(value) for name, value in w.items()}
    second = {name: np.zeros_like(value) for name, value in w.items()}
    for step in range(1, STEPS + 1):
        for name, slope in _slopes(w, x, bags, labels).items():
            slope = slope + DECAY * w[name]
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            w[name] = w[name] - RATE * (first[name] / (1 - 0.9**step)) / (
                np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
            )
    return AttentionModel(prior, w | {"mean": mean, "spread": spread})


def _slopes(
    w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, labels: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss."""
    f = _forward(w, x, bags)
    off = (f["score"] - labels) / len(labels)
    pooled = np.repeat(np.outer(off, w["out"]), bags, axis=0)
    along = (f["encoded"] * pooled).sum(axis=1)
    inside = np.repeat(np.add.reduceat(f["weight"] * along, f["starts"]), bags)
    raw = f["weight"] * (along - inside)
    value = raw[:, None] * w["attend"] * f["gate"] * (1 - f["value"] ** 2)
    gate = raw[:, None] * w["attend"] * f["value"] * f["gate"] * (1 - f["gate"])
    encoded = f["weight"][:, None] * pooled + value @ w["value"].T + gate @ w["gate"].T
    encoded *= 1 - f["encoded"] ** 2
    return {
        "encode": x.T @ encoded.astype(x.dtype),
        "encode_bias": encoded.sum(axis=0),
        "value": f["encoded"].T @ value,
        "gate": f["encoded"].T @ gate,
        "attend": (f["value"] * f["gate"]).T @ raw,
        "out": f["pooled"].T @ off,
        "out_bias": np.array([off.sum()]),
    }


def fold_loss(
    vectors: np.ndarray, bags: np.ndarray, labels: np.ndarray, hashed_scale: float, folds: int = 3
) -> float:
    """Mean log loss of all bags, each scored by a fit on the folds that it is not in. On the rows of
    ``fit_rows`` it compares settings without a held-out label."""
    fold, owner = np.arange(len(bags)) % folds, np.repeat(np.arange(len(bags)), bags)
    loss = 0.0
    for one in range(folds):
        out = fold == one
        model = fit(vectors[~out[owner]], bags[~out], labels[~out], hashed_scale)
        score = np.clip(model.scores(vectors[out[owner]], bags[out]), 1e-6, 1 - 1e-6)
        loss -= np.log(np.where(labels[out] == 1, score, 1 - score)).sum()
    return float(loss / len(bags))


def fit_rows(
    docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, sizes and labels of at most ``documents`` labelled documents, drawn by a hash of
    their id, where crc32 of the id as text modulo 3 is not 1. A document labelled twice counts as
    its higher label; null labels and ids, and labels other than 0 and 1, are left out."""
    drawn = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(documents)
    )
    # The sample has a fixed number of rows, so it goes to the documents and not the other way.
    bags = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = bags.join(F.broadcast(drawn), "doc_id").select("text", "label", "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            vectors, sizes = passages(batch.column(0).to_pylist())
            found, start = [], 0
            for size in sizes.tolist():
                found.append(spans(vectors[start : start + size], FIT_PASSAGES).tobytes())
                start += size
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(1), pa.array(found, pa.binary())],
                names=["doc_id", "label", "vectors"],
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = (
        map_rows(chosen, f"doc_id {kind}, label int, vectors binary", work)
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("vectors"))
        .limit(documents)
        .collect()
    )
    found = [np.frombuffer(row["vectors"], np.float32).reshape(-1, FEATURES) for row in rows]
    return (
        np.concatenate([np.zeros((0, FEATURES), np.float32), *found]),
        np.array([len(vectors) for vectors in found], np.int64),
        np.array([row["label"] for row in rows], np.float64),
    )


def train(
    docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS
) -> AttentionModel:
    """Fit on the rows of ``fit_rows``."""
    return fit(*fit_rows(docs, labels, documents))


def score_documents(
    docs: DataFrame, model: AttentionModel, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, the columns named in ``carry``, and ``score`` from 0 to 1 for each row.

    No shuffle; only the text counts. A null text or one without words scores 0. Repeated rows
    and null ids are kept as they are; other columns are ignored.
    """
    columns = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("whole_text"), "doc_id", *carry
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            vectors, bags = passages(batch.column(0).to_pylist())
            score = np.clip(model.scores(vectors, bags), 0.0, 1.0).astype(np.float64)
            score[~np.logical_or.reduceat(vectors.any(axis=1), np.cumsum(bags) - bags)] = 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score)], names=["doc_id", *carry, "score"]
            )

    kinds = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields[1:]
    )
    return map_rows(columns, f"{kinds}, score double", work)
