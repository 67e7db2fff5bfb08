"""Quality classifier (operator 10): attention-based multiple-instance learning over passages.

A document is a bag of passages of PASSAGE words, covering the whole text. Every passage is encoded: its words, pairs of
neighbouring words and runs of three bytes, hashed with signs into HASHED numbers of unit length, and shape measures
(characters by class, repeated words, word lengths) go through a learned layer into a vector h. A gated attention
weighs passages, a = softmax(w . (tanh(V h) * sigmoid(U h))), and the document's score is the logistic of the weighted
sum of its passages' vectors. All weights of a network are learned together from labels of whole documents. A bounded sample of labelled
rows is dealt by hash into SHARDS parts; Spark trains a network on each in a task of its own, only weights reach the
driver, and a score is the mean of the networks' scores. Scoring runs in parallel over all texts.

Defined results: a null text counts as empty; an empty text has one empty passage and so a score. Without training rows of
both labels every score is the share of label 1 among them (0.5 without any); a shard without them gives its own share. Rows without doc_id are scored and count
as not held out. Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import give_back, held_out, table, text_of, tidy, training_rows

PASSAGE = 64
#: At most so many labelled rows train the model.
TRAINING_ROWS = 4_000
THRESHOLD = 0.3

SHARDS = 4
#: A power of two.
HASHED = 32
#: Passages encoded, runs of bytes hashed and documents scored at a time. Products this small stay in one thread.
AT_ONCE, RUNS_AT_ONCE, DOCS_AT_ONCE = 128, 1 << 16, 48
HIDDEN, GATE = 16, 8
_SYMBOLS = "%&$#*@^~<>{}[]\\_=+"


def _classes() -> bytes:
    """One letter for each byte: upper, lower, digit, space, stop, comma, symbol, bar, shout, quote, high (not ASCII)."""
    out = bytearray(b"q" * 256)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = ord("h")
        elif c.isupper():
            out[b] = ord("U")
        elif c.islower():
            out[b] = ord("l")
        elif c.isdigit():
            out[b] = ord("d")
        elif c.isspace():
            out[b] = ord("w")
        elif c in ".;:":
            out[b] = ord("s")
        elif c == ",":
            out[b] = ord("c")
        elif c in _SYMBOLS:
            out[b] = ord("y")
        elif c == "|":
            out[b] = ord("b")
        elif c in "!?":
            out[b] = ord("x")
    return bytes(out)


_CLASS = _classes()
_KINDS = [bytes([c]) for c in b"Uldwscybxqh"]
SHAPES = len(_KINDS) + 6
FEATURES = SHAPES + HASHED


def _place(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column and sign of whole numbers."""
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) & (HASHED - 1), 1.0 - 2.0 * (mixed >> np.uint64(63)).astype(np.float64)


def _word_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A code and the hashed numbers of each of words: of itself and of its runs of three bytes, its two ends being spaces."""
    raw = [w.encode() for w in words]
    codes = np.array(list(map(crc32, raw)), np.uint64)
    column, sign = _place(codes)
    table = np.zeros((len(words), HASHED))
    table[np.arange(len(words)), column] = sign
    buffer = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8).astype(np.uint64)
    ends = np.cumsum([len(r) + 1 for r in raw])
    for at in range(1, len(buffer) - 1, RUNS_AT_ONCE):
        middle = np.arange(at, min(at + RUNS_AT_ONCE, len(buffer) - 1))
        middle = middle[buffer[middle] != 32]  # words hold no space; a run belongs to the word that its middle byte is in
        if not len(middle):
            continue
        column, sign = _place(buffer[middle - 1] << np.uint64(16) | buffer[middle] << np.uint64(8) | buffer[middle + 1])
        of = np.searchsorted(ends, middle, "right")
        low = of[0]
        found = np.bincount((of - low) * HASHED + column, sign)
        table.ravel()[low * HASHED : low * HASHED + len(found)] += found
    return codes, table.astype(np.float32)


def _hashed(parts: list[list[str]]) -> np.ndarray:
    """One row of unit length for every passage, a list of words; zeros for one without words."""
    index: dict[str, int] = {}
    of = np.array([index.setdefault(w, len(index)) for w in chain.from_iterable(parts)], np.int64)
    lengths = np.array(list(map(len, parts)), np.int64)
    out = np.zeros((len(parts), HASHED))
    if len(of):
        codes, table = _word_table(list(index))
        passage = np.repeat(np.arange(len(parts)), lengths)
        some = np.flatnonzero(lengths)
        out[some] = np.add.reduceat(table[of], (np.cumsum(lengths) - lengths)[some])
        inside = passage[1:] == passage[:-1]
        codes = codes[of]
        column, sign = _place((codes[:-1] * np.uint64(0x85EBCA6B) ^ codes[1:])[inside])
        out += np.bincount(passage[1:][inside] * HASHED + column, sign, out.size).reshape(out.shape)
    return out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), 1e-9)


def _shape(part: list[str]) -> list[float]:
    raw = " ".join(part).encode()
    kinds = raw.translate(_CLASS)
    size, n = len(raw) or 1, len(part) or 1
    lengths = [len(w) for w in part] or [0]
    same = sum(map(str.__eq__, part, part[1:]))
    return [
        *[kinds.count(k) / size for k in _KINDS],
        len(set(part)) / n, same / n, sum(map(str.isupper, part)) / n, min(sum(lengths) / n, 40) / 10,
        min(max(lengths), 80) / 20, len(part) / PASSAGE,
    ]


def bags(texts: list[str]) -> list[np.ndarray]:
    """The measures of every passage of each text, a row each."""
    parts, ends = [], []
    for text in texts:
        words = text.split()
        parts.extend(words[at : at + PASSAGE] for at in range(0, max(1, len(words)), PASSAGE))
        ends.append(len(parts))
    measured = np.empty((len(parts), FEATURES), np.float32)
    for at in range(0, len(parts), AT_ONCE):
        some = parts[at : at + AT_ONCE]
        measured[at : at + AT_ONCE, :SHAPES] = [_shape(p) for p in some]
        measured[at : at + AT_ONCE, SHAPES:] = _hashed(some)
    return np.split(measured, ends[:-1]) if texts else []


def passages(text: str) -> np.ndarray:
    """The measures of every passage of text."""
    return bags([text])[0]


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None or not bags:
            return np.full(len(bags), self.constant)
        return _forward(self.weights, *_flat(bags, self.mean, self.scale))["p"]


@dataclass
class Model:
    networks: list[Network]
    constant: float | None = None

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        return np.mean([n.score(bags) for n in self.networks], axis=0)


def _flat(bags: list[np.ndarray], mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(b) for b in bags], np.int64)
    x = (np.concatenate([np.asarray(b, np.float64).reshape(-1, FEATURES) for b in bags]) - mean) / scale
    return np.clip(x, -8, 8), np.repeat(np.arange(len(bags)), lengths), np.cumsum(lengths) - lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    raw = (t * g) @ w["a"]
    grown = np.exp(raw - np.maximum.reduceat(raw, first)[bag])
    a = grown / np.add.reduceat(grown, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["b"])}


def train(bags: list[np.ndarray], labels: list[int], *, rounds: int = 200, rate: float = 0.02, decay: float = 1e-4) -> Network:
    """Full-batch Adam on the mean log loss of the documents."""
    share = float(np.mean(labels)) if labels else 0.5
    none = np.zeros(FEATURES)
    if len(set(labels)) < 2:
        return Network(none, none + 1, {}, share)
    every = np.concatenate([np.asarray(b, np.float64).reshape(-1, FEATURES) for b in bags])
    model = Network(every.mean(0), np.maximum(every.std(0), 1e-3), {})
    x, bag, first = _flat(bags, model.mean, model.scale)
    y = np.array(labels, np.float64)
    rng = np.random.default_rng(7)
    w = {
        "E": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN), "V": rng.normal(0, 0.25, (HIDDEN, GATE)),
        "U": rng.normal(0, 0.25, (HIDDEN, GATE)), "a": rng.normal(0, 0.25, GATE), "c": rng.normal(0, 0.25, HIDDEN),
        "b": np.array(np.log(share / (1 - share))),
    }
    m, v = ({k: np.zeros_like(u) for k, u in w.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        f = _forward(w, x, bag, first)
        d = (f["p"] - y) / len(y)
        dz = d[:, None] * w["c"]
        da = (dz[bag] * f["h"]).sum(1)
        draw = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[bag])
        dt, dg = draw[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2), draw[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
        grads = {"E": x.T @ dh, "e": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ draw,
                 "c": f["z"].T @ d, "b": d.sum()}
        for k, grad in grads.items():
            grad = grad + decay * w[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad**2
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model.weights = w
    return model


def _measured(rows: DataFrame) -> DataFrame:
    """label and the measures of the passages of each row, flat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [passages(t).ravel() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(flat, pa.list_(pa.float32()))], ["doc_id", "label", "x"])

    return rows.select("doc_id", "text", "label").mapInArrow(tidy(run), "doc_id bigint, label int, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = TRAINING_ROWS, label: str = "quality", shards: int = SHARDS) -> Model:
    """A model from at most max_rows labelled rows of docs, none of them held out, by one network for each of `shards` parts."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        network = train([np.asarray(x).reshape(-1, FEATURES) for x in rows["x"]], rows["label"].tolist())
        out = pd.DataFrame({"shard": [rows["shard"].iloc[0]], "size": [len(rows)], "ones": [int(rows["label"].sum())], "network": [pickle.dumps(network)]})
        give_back()
        return out

    sample = _measured(training_rows(docs, labels, label, max_rows).withColumn("doc_id", F.col("doc_id").cast("bigint")))
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    found = sorted(dealt.groupBy("shard").applyInPandas(learn, "shard bigint, size bigint, ones bigint, network binary").collect())  # a row each
    size, ones = sum(r["size"] for r in found), sum(r.ones for r in found)
    if ones in (0, size):
        return Model([], ones / size if size else 0.5)
    return Model([pickle.loads(r.network) for r in found])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores: list[float] = []
            for at in range(0, len(texts), DOCS_AT_ONCE):
                scores.extend(model.score(bags(texts[at : at + DOCS_AT_ONCE])).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), text_of()).mapInArrow(tidy(run), "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores threshold or more."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for i in range(0, len(texts), DOCS_AT_ONCE):
                good = model.score(bags(texts[i : i + DOCS_AT_ONCE])) >= threshold
                yield batch.slice(i, DOCS_AT_ONCE).filter(pa.array(good))

    return docs.mapInArrow(tidy(run), docs.schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
