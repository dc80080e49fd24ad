"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded; gated attention (tanh times
sigmoid) weighs the passages; the score is that of the weighted mean of their codes. So a document with a few bad passages
can be told from a clean one without labels for passages.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.tasks import map_rows, record_batch, arrow_schema, written

PASSAGE_WORDS = 64
BUCKETS = 256
SHAPES = 8
HIDDEN, GATE = 32, 16
TRAIN_DOCUMENTS = 4000
EPOCHS, RATE = 16, 0.004
CLEAN_WEIGHT = 0.95  # of label 1 in all: to lose a clean document is worse than to keep a bad one
THRESHOLD = 0.3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.zeros(256, np.int64)  # 0: anything else
_CLASS[65:91] = 1  # capitals
_CLASS[48:58] = 2  # digits
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3  # marks
_CLASS[128:] = 4  # bytes of other letters
_CLASS[10] = 5  # line ends


def passages(text: str | None) -> np.ndarray:
    """Features of each passage of PASSAGE_WORDS words: hashed byte trigrams, and shares of letters of several kinds.

    The last passage may be short. A null, empty or blank text has one passage of zeros. Language, source and doc_id are
    not looked at.
    """
    data = np.frombuffer((text or "").encode() + b" ", np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if not space[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.zeros((1, BUCKETS + SHAPES), np.float32)
    begin = starts[::PASSAGE_WORDS]
    count = len(begin)
    owner = np.zeros(len(data), np.int64)
    owner[begin[1:]] = 1
    owner = owner.cumsum()
    wide = data.astype(np.uint32)
    three = (wide[:-2] * 65599 + wide[1:-1]) * 65599 + wide[2:] if len(data) > 2 else np.zeros(0, np.uint32)
    bucket = (three * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    grams = np.bincount(owner[:len(three)] * BUCKETS + bucket, minlength=count * BUCKETS).reshape(count, BUCKETS)
    grams = np.sqrt(grams).astype(np.float32)
    grams /= np.maximum(np.sqrt((grams**2).sum(axis=1, keepdims=True)), 1e-6)
    ends = np.append(begin[1:], len(data))
    length = (ends - begin).astype(np.float64)

    shares = np.bincount(owner * 6 + _CLASS[data], minlength=count * 6).reshape(count, 6)[:, 1:] / length[:, None]
    n_words = np.diff(np.append(np.arange(0, len(starts), PASSAGE_WORDS), len(starts)))
    repeats = _repeated(data, starts, count)
    shapes = np.column_stack([shares, np.minimum(length / n_words / 16, 2), repeats, np.log1p(n_words) / 4])
    return np.concatenate([grams, shapes.astype(np.float32)], axis=1)


def _repeated(data: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Share of the words of each passage whose first sixteen bytes, with what follows, began an earlier word too."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 8, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    code = eight[starts] * np.uint64(0x9E3779B97F4A7C15) ^ eight[starts + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    _, first = np.unique(code, return_index=True)
    again = np.ones(len(starts))
    again[first] = 0
    at = np.arange(len(starts)) // PASSAGE_WORDS
    return np.bincount(at, again, count) / np.bincount(at, minlength=count)


class Model:
    """Encoder, gated attention and bag classifier; weights as arrays."""

    NAMES = ("mean", "scale", "encode", "bias", "tan", "gate", "attend", "out", "offset")

    def __init__(self, **weights: np.ndarray):
        self.__dict__.update({n: w.astype(np.float32) for n, w in weights.items()})

    def forward(self, bags: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """Passages of several documents one below the other; `sizes` says how many each has."""
        x = (bags - self.mean) * self.scale
        code = np.tanh(x @ self.encode + self.bias)
        t, g = np.tanh(code @ self.tan), 1 / (1 + np.exp(-(code @ self.gate)))
        raw = (t * g) @ self.attend
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        weight = np.exp(raw - np.repeat(np.maximum.reduceat(raw, begin), sizes))
        weight /= np.repeat(np.add.reduceat(weight, begin), sizes)
        bag = np.add.reduceat(weight[:, None] * code, begin)
        score = 1 / (1 + np.exp(-np.clip((bag @ self.out + self.offset).astype(np.float64), -30, 30)))
        return {"x": x, "code": code, "t": t, "g": g, "weight": weight, "bag": bag, "score": score, "begin": begin}

    def gradients(self, f: dict[str, np.ndarray], sizes: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss, by hand through the bag, the attention and the encoder."""
        error = ((f["score"] - labels) * importance / len(labels)).astype(np.float32)
        per_row = np.repeat(error, sizes)
        d_code = f["weight"][:, None] * per_row[:, None] * self.out
        inner = (f["code"] @ self.out) * per_row
        mean = np.repeat(np.add.reduceat(f["weight"] * inner, f["begin"]), sizes)
        d_raw = f["weight"] * (inner - mean)
        d_tg = d_raw[:, None] * self.attend
        d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
        d_code += d_t @ self.tan.T + d_g @ self.gate.T
        d_in = d_code * (1 - f["code"] ** 2)
        return {
            "encode": f["x"].T @ d_in, "bias": d_in.sum(axis=0), "tan": f["code"].T @ d_t, "gate": f["code"].T @ d_g,
            "attend": (f["t"] * f["g"]).T @ d_raw, "out": f["bag"].T @ error, "offset": error.sum(keepdims=True),
        }

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self.NAMES})
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as stored:
            return cls(**{n: stored[n] for n in cls.NAMES})


def fitted(bags: list[np.ndarray], labels: np.ndarray, good: float = 0.5, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Adam over small batches in a fixed order of chance. `good` is the share that label 1 weighs in all."""
    rng = np.random.default_rng(seed)
    rows = np.concatenate(bags)
    width = rows.shape[1]
    model = Model(
        mean=rows.mean(axis=0), scale=1 / (rows.std(axis=0) + 1e-3), encode=rng.normal(0, width**-0.5, (width, HIDDEN)),
        bias=np.zeros(HIDDEN), tan=rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), gate=rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        attend=rng.normal(0, GATE**-0.5, GATE), out=rng.normal(0, HIDDEN**-0.5, HIDDEN), offset=np.zeros(1))
    share = float(labels.mean())
    importance = np.where(labels == 1, good / share, (1 - good) / (1 - share)) if 0 < share < 1 else np.ones(len(labels))
    names = [n for n in Model.NAMES if n not in ("mean", "scale")]
    first, second = ({n: np.zeros_like(getattr(model, n)) for n in names} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            sizes = np.array([len(bags[i]) for i in batch])
            f = model.forward(np.concatenate([bags[i] for i in batch]), sizes)
            made = model.gradients(f, sizes, labels[batch], importance[batch])
            step += 1
            for n in names:
                slope = made[n] + 1e-4 * getattr(model, n) * (n != "offset")
                first[n] = 0.9 * first[n] + 0.1 * slope
                second[n] = 0.999 * second[n] + 0.001 * slope**2
                pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(model, n, getattr(model, n) - np.float32(pace) * first[n] / (np.sqrt(second[n]) + np.float32(1e-8)))
    return model


def label_rows(labels: DataFrame) -> DataFrame:
    """doc_id and quality, 0 or 1, once for each labelled document that may be learned from; of several labels the least."""
    rows = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return rows.filter(~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> bytes | None:
    """A model fitted on at most about `train_documents` documents of each label, picked by a hash of the doc_id.

    The bound is what makes broadcasting their ids, and fitting in one task, independent of the size of the tables. None
    if no document has a label.
    """
    known = written(label_rows(labels), "labels")
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    slots = 1 << 30
    limit = F.lit(0)
    for quality, count in counts.items():
        limit = F.when(F.col("quality") == quality, min(slots, slots * train_documents // count)).otherwise(limit)
    picked = known.filter(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(slots)) < limit)
    sample = written(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "sample")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if rows:
            rows.sort(key=lambda r: (r[0], r[1] or ""))
            model = fitted([passages(t) for _, t, _ in rows], np.array([q for _, _, q in rows], float), CLEAN_WEIGHT)
            yield record_batch([(model.dumps(),)], arrow_schema("model binary"))

    made = written(sample.select("doc_id", "text", "quality").repartition(1).mapInArrow(fit, "model binary"), "model").first()
    return made and bytes(made.model)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def scored(docs: DataFrame, model: bytes | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`. Whole texts, one pass, no shuffle.

    Null, empty and blank texts are scored as one empty passage. Without a model (no labels) every score is 0.5. Repeated
    rows are scored alike; a null doc_id is not held out; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights = Model.loads(sent.value) if sent.value else None

        def step(doc_ids, outs, texts):
            for doc_id, out, text in zip(doc_ids, outs, texts, strict=True):
                score = score_text(weights, text)
                yield doc_id, out, score, int(score >= threshold)

        return step

    return map_rows(docs.withColumn("held_out", held_out()), ["doc_id", "held_out", "text"], SCHEMA, make)


def score_text(model: Model | None, text: str | None) -> float:
    if model is None:
        return 0.5
    bag = passages(text)
    return float(model.forward(bag, np.array([len(bag)]))["score"][0])


def kept(docs: DataFrame, model: bytes | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is not rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    loaded: list[Model | None] = []

    def good(text: str | None) -> bool:
        if not loaded:
            loaded.append(Model.loads(sent.value) if sent.value else None)
        return score_text(loaded[0], text) >= threshold

    return docs.filter(F.udf(good, "boolean", useArrow=True)("text"))
