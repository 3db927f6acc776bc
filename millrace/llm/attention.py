"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages, runs of 1024 bytes that together are the whole text; only the document has a label. Each
passage is encoded from counts of its pairs of byte classes and of how much it repeats itself; a
gated attention layer gives each passage a weight, and the weighted sum of a document's encodings is
scored. Encoder, attention and score are trained together, in numpy, on a bounded sample of labelled documents;
every document is scored on all of its passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from millrace.llm.common import aside, label_sample, remainder, sampled_texts, slices, string_parts

PASSAGE = 1024
BLOCK = 1 << 20  # bytes whose features are held at once
HIDDEN, GATE = 24, 12
TRAIN_ROWS = 2000  # labelled documents of each class at most
TRAIN_BYTES = 200_000  # longer documents are scored but not trained on
SEED = 17


def _classes() -> np.ndarray:
    kind = np.full(256, 12, np.uint8)  # other marks
    kind[:32] = 11
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    for n, marks in ((3, b" \t"), (4, b"\n\r"), (5, b"."), (6, b","), (7, b"!?"), (8, b"#*$%&"), (9, b"|"), (10, b"<>/=\"'`{}[]()")):
        kind[list(marks)] = n
    kind[0x80:0xC0] = 13
    kind[0xC0:] = 14
    return kind


KINDS = 15
KIND = _classes()
FLAGS = 2048
FEATURES = KINDS * KINDS + 3


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start of each passage (and the end), and the number of passages per text. No text has none."""
    data, ends = string_parts(texts)
    sizes = np.diff(ends)
    each = np.maximum(1, -(-sizes // PASSAGE))
    first = np.repeat(ends[:-1], each)
    step = np.arange(len(first)) - np.repeat(np.cumsum(each) - each, each)
    starts = np.minimum(first + step * PASSAGE, np.repeat(ends[1:], each))
    return data, np.r_[starts, len(data)], each


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row per passage: shares of class pairs, distinct runs of 8 bytes, share of the commonest class, fill."""
    n = len(bounds) - 1
    out = np.zeros((n, FEATURES), np.float32)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + BLOCK, side="right")) - 1)
        b = min(b, n, a + BLOCK // 256)
        own, at = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        sizes = np.diff(at)
        of = np.repeat(np.arange(b - a), sizes)
        if len(own) > 1:
            kind = KIND[own].astype(np.int64)
            inside = of[1:] == of[:-1]
            code = (of[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
            pairs = np.bincount(code[inside], minlength=(b - a) * KINDS * KINDS)
            out[a:b, : KINDS * KINDS] = pairs.reshape(b - a, -1) / np.maximum(1, sizes - 1)[:, None]
        out[a:b, -3] = 1.0
        if len(own) >= 8:
            runs = np.ndarray((len(own) - 7,), "<u8", np.ascontiguousarray(own), strides=(1,))
            with np.errstate(over="ignore"):
                slot = ((runs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 11)).astype(np.int64)
            inside = of[7:] == of[:-7]
            flags = np.zeros((b - a) * FLAGS, bool)
            flags[(of[:-7] * FLAGS + slot)[inside]] = True
            seen = flags.reshape(b - a, FLAGS).sum(axis=1)
            expected = FLAGS * -np.expm1(-np.maximum(sizes - 7, 0) / FLAGS)
            out[a:b, -3] = np.where(sizes > 7, seen / np.maximum(expected, 1e-9), 1.0)
        out[a:b, -2] = out[a:b, : KINDS * KINDS].max(axis=1)
        out[a:b, -1] = sizes / PASSAGE
        a = b
    out[:, : KINDS * KINDS] = np.sqrt(out[:, : KINDS * KINDS])
    return out


class Model:
    """Encoder, gated attention and score; `step` is one round of Adam over all bags."""

    SHAPES = {"we": (FEATURES, HIDDEN), "be": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "w": (HIDDEN,), "b": ()}

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {k: rng.normal(0, 0.3 if k != "we" else 0.2, s).astype(np.float64) for k, s in self.SHAPES.items()}
        self.p["be"][:] = 0
        self.p["b"] = np.zeros(())
        self.middle, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.moments = {k: (np.zeros(s), np.zeros(s)) for k, s in self.SHAPES.items()}
        self.rounds = 0

    def forward(self, x: np.ndarray, each: np.ndarray) -> dict[str, np.ndarray]:
        p, at = self.p, np.cumsum(each) - each
        h = np.tanh(((x - self.middle) / self.spread) @ p["we"] + p["be"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), each))
        alpha = e / np.repeat(np.add.reduceat(e, at), each)
        z = np.add.reduceat(alpha[:, None] * h, at, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["w"] + p["b"], -50, 50)))
        return {"h": h, "t": t, "g": g, "alpha": alpha, "z": z, "score": score}

    def step(self, x: np.ndarray, each: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float, decay: float) -> float:
        p, f, at = self.p, self.forward(x, each), np.cumsum(each) - each
        d = (f["score"] - y) * weight
        grads = {"w": f["z"].T @ d, "b": d.sum()}
        dz = np.repeat(d[:, None] * p["w"], each, axis=0)
        dalpha = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["alpha"] * dalpha, at), each)
        de = f["alpha"] * (dalpha - mean)
        grads["a"] = (f["t"] * f["g"]).T @ de
        dt = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        grads["v"], grads["u"] = f["h"].T @ dt, f["h"].T @ dg
        dh = (f["alpha"][:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
        grads["we"], grads["be"] = ((x - self.middle) / self.spread).T @ dh, dh.sum(axis=0)
        self.rounds += 1
        for k, g in grads.items():
            m, s = self.moments[k]
            g = g + decay * p[k] * (k not in ("b", "be"))
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            self.moments[k] = (m, s)
            p[k] = p[k] - rate * (m / (1 - 0.9**self.rounds)) / (np.sqrt(s / (1 - 0.999**self.rounds)) + 1e-8)
        eps = 1e-12
        return float(-(weight * (y * np.log(f["score"] + eps) + (1 - y) * np.log(1 - f["score"] + eps))).sum())


def fit(x: np.ndarray, each: np.ndarray, y: np.ndarray, rounds: int = 250, seed: int = SEED) -> Model:
    """A model of both classes at equal weight. Without both classes every score is the share of label 1, or a half."""
    model = Model(seed)
    if len(y) == 0 or y.min() == y.max():
        for k in ("w", "a"):
            model.p[k][:] = 0
        model.p["b"] = np.float64(0.0 if not len(y) else (4.0 if y[0] else -4.0))
        return model
    model.middle, model.spread = x.mean(axis=0), x.std(axis=0) + 0.02
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for n in range(rounds):
        model.step(x, each, y, weight, 0.02 * (1 - n / rounds) + 0.001, 1e-5)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most `rows` documents of each class, up to TRAIN_BYTES long, none of them held out.

    The sample's ids are bounded and so may be broadcast; what comes to the driver is the passages' features.
    """
    ids = label_sample(docs, labels, "quality", rows, remainder("doc_id", 4) != 2, SEED)
    short = sampled_texts(docs, ids).where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, bounds, each = passages(part.column("text"))
            rows_ = features(data, bounds)
            at = np.r_[0, np.cumsum(each)]
            bags = pa.array([rows_[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), bags], ["doc_id", "label", "bag"])

    found = short.mapInArrow(run, "doc_id long, label int, bag binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"], r["bag"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in found]
    y = np.array([r["label"] for r in found], np.float64)
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES))
    return fit(x, np.array([len(b) for b in bags], np.int64), y)


def scored(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier) and `predicted`; a null text is like an empty one.

    Columns of `docs` with these names are left out; all other columns pass through, so no
    join is needed.
    """
    p = {k: v.astype(np.float32) for k, v in model.p.items()}
    light = Model.__new__(Model)
    light.p, light.middle, light.spread = p, model.middle.astype(np.float32), model.spread.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            data, bounds, each = passages(part.column("__text"))
            score = light.forward(features(data, bounds), each)["score"].astype(np.float64)
            score = np.round(score, 6)
            columns = [part.column(c) for c in part.schema.names if c != "__text"]
            columns += [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*(c for c in part.schema.names if c != "__text"), "score", "predicted"])

    kept = [c for c in docs.columns if c not in ("score", "predicted", "__text")]
    base = docs.select(*kept, F.col("text").cast("string").alias("__text"))
    schema = base.drop("__text").schema.add("score", DoubleType()).add("predicted", IntegerType())
    return base.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` of every document. A null doc_id is not held out."""
    out = scored(docs.select(F.col("doc_id").cast("long"), "text"), train(docs, labels))
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with all their columns."""
    held, back = aside(docs, "text")
    kept = scored(held, train(docs, labels)).where("predicted = 1")
    return kept.select(*held.columns).withColumnsRenamed(back)
