"""Quality classifier (operator 4): attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is
encoded: shares of character classes, word lengths and repeats, and hashed
word counts, through a learned tanh layer. A learned gated attention weighs the
passages (softmax over w . (tanh(V e) * sigmoid(U e))), and a logistic unit
scores the weighted sum. All weights are learned together from document labels.

Fitting uses at most ``FIT_DOCS`` labelled documents (lowest id hash), and of
these, in that order, those whose passages together are at most
``FIT_PASSAGES``; every passage of them is learned from. This bounds the fit,
which runs on the driver in numpy. Scoring reads every passage of every whole
text, in Pandas UDFs over Arrow batches, with no shuffle; a long text is encoded
in blocks of whole passages, as if at once.

Defined cases: a null text, or one without words, is one passage without words
and is scored like any other; repeated rows get equal scores; a null id is
never learned from and not held out; without two label values to learn
from, every score is the share of label 1 (0.5 without labels); an empty table
gives no rows; other columns are ignored (or kept, in ``reject``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import common

PASSAGE_WORDS = 100
HASHED = 256
HIDDEN = 24
ATTENTION = 12
FIT_DOCS = 3000
FIT_PASSAGES = 150_000      # about 1 KB each
EPOCHS = 40
THRESHOLD = 0.3
_BLOCK_BYTES = 1 << 21      # texts are encoded so many bytes at a time

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# character classes: upper, lower, digit, above ASCII, sentence end, comma and
# the like, brackets and quotes, other symbols, line end
_CLASSES = 9
_CLASS = np.full(256, 255, "uint8")
for _k, _bytes in enumerate([range(65, 91), range(97, 123), range(48, 58), range(128, 256), b".!?", b",;:", b"()[]{}\"'-",
                             b"#*$%&|<>@^_~`+=/\\", b"\n"]):
    _CLASS[list(_bytes)] = _k
STATS = _CLASSES + 6


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def passages(data: bytes) -> np.ndarray:
    """Feature rows of the passages of one block of UTF-8 text."""
    buf = np.frombuffer(data, "uint8")
    word = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, stops = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        return np.zeros((1, STATS + HASHED), "float32")
    first = np.arange(0, n, PASSAGE_WORDS)
    which = np.arange(n) // PASSAGE_WORDS
    words = np.diff(first, append=n).astype("float32")
    head = starts[first]
    head[0] = 0
    bounds = np.append(head, len(buf))
    lengths = stops - starts
    out = np.zeros((len(first), STATS + HASHED), "float32")
    chars = np.maximum(np.add.reduceat(lengths, first), 1).astype("float32")
    kinds = _CLASS[buf]
    where = np.repeat(np.arange(len(first)), np.diff(bounds))
    counts = np.bincount(where * 256 + kinds, minlength=256 * len(first)).reshape(len(first), 256)
    out[:, :_CLASSES] = counts[:, :_CLASSES] / chars[:, None]
    # a hash of each word: its bytes weighted by powers of an odd number
    inside = np.arange(len(buf), dtype="int64") - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(buf)]])))
    values = np.where(word, buf.astype("uint64") + np.uint64(1), np.uint64(0)) * _POWERS[inside & 63]
    hashes = _mixed(np.add.reduceat(values, starts))
    same = np.append(False, hashes[1:] == hashes[:-1])
    same[first] = False             # a passage begins anew
    order = np.lexsort((hashes, which))
    fresh = np.append(True, (np.diff(hashes[order].view("int64")) != 0) | (np.diff(which[order]) != 0))
    distinct = np.bincount(which[order][fresh], minlength=len(first))
    out[:, _CLASSES] = np.add.reduceat(same, first) / words
    out[:, _CLASSES + 1] = distinct / words
    out[:, _CLASSES + 2] = chars / words / 10
    out[:, _CLASSES + 3] = np.add.reduceat(lengths > 15, first) / words
    out[:, _CLASSES + 4] = np.add.reduceat(lengths < 2, first) / words
    out[:, _CLASSES + 5] = words / PASSAGE_WORDS
    hashed = np.bincount(which * HASHED + (hashes % np.uint64(HASHED)).astype("int64"), minlength=HASHED * len(first))
    out[:, STATS:] = np.log1p(hashed.reshape(len(first), HASHED))
    return out


_POWERS = np.cumprod(np.full(64, 0x100000001B3, "uint64"))


def blocks(data: bytes) -> Iterator[bytes]:
    """Parts of a text of about _BLOCK_BYTES, cut where a passage begins."""
    at, size = 0, _BLOCK_BYTES
    while len(data) - at > size:
        word = ~_SPACE[np.frombuffer(data, "uint8", size, at)]
        starts = np.flatnonzero(word & ~np.append(False, word[:-1]))
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS
        if whole <= 0:
            size *= 2               # no whole passage yet
            continue
        cut = at + int(starts[whole])
        yield data[at:cut]
        at, size = cut, _BLOCK_BYTES
    yield data[at:]


def encode(text: str | None) -> np.ndarray:
    return np.concatenate([passages(b) for b in blocks(common.word_bytes(text))])


class Model:
    """Weights of the encoder, the attention and the score."""

    def __init__(self, weights: dict[str, np.ndarray], base: float | None = None):
        self.w = weights
        self.base = base

    def passage_values(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention before the softmax."""
        w = self.w
        e = np.tanh(((x - w["mean"]) / w["spread"]) @ w["E"] + w["e"])
        a = (np.tanh(e @ w["V"]) / (1 + np.exp(-(e @ w["U"])))) @ w["a"]
        return e, a

    def score(self, texts: list[str | None]) -> list[float]:
        if self.base is not None:
            return [self.base] * len(texts)
        out = []
        for text in texts:
            parts = [self.passage_values(passages(b)) for b in blocks(common.word_bytes(text))]
            e, a = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            share = np.exp(a - a.max())
            z = share @ e / share.sum()
            out.append(float(1 / (1 + np.exp(-np.clip(z @ self.w["c"] + self.w["d"], -30, 30)))))
        return out


def gradient(p: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss of bags of ``size`` rows each, one after the other in ``x``."""
    first = np.append(0, np.cumsum(size))[:-1]
    bag = np.repeat(np.arange(len(size)), size)
    e = np.tanh(x @ p["E"] + p["e"])
    t, g = np.tanh(e @ p["V"]), 1 / (1 + np.exp(-(e @ p["U"])))
    a = (t * g) @ p["a"]
    a = np.exp(a - np.maximum.reduceat(a, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * e, first)
    y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
    dy = (y - labels) / len(size)
    dz = dy[:, None] * p["c"]
    da = (dz[bag] * e).sum(axis=1)
    da = a * (da - np.add.reduceat(a * da, first)[bag])
    dt, dg = np.outer(da, p["a"]) * g, np.outer(da, p["a"]) * t
    dv, du = dt * (1 - t * t), dg * g * (1 - g)
    de = a[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T
    dx = de * (1 - e * e)
    return {"E": x.T @ dx, "e": dx.sum(axis=0), "V": e.T @ dv, "U": e.T @ du,
            "a": (t * g).T @ da, "c": z.T @ dy, "d": dy.sum(keepdims=True)}


def train(bags: list[np.ndarray], labels: np.ndarray, *, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adam on the mean log loss of mini-batches of documents, whole bags each."""
    if len(bags) == 0 or len(set(labels.tolist())) < 2:
        return Model({}, float(labels.mean()) if len(bags) else 0.5)
    rng = np.random.default_rng(seed)
    flat = np.concatenate(bags)
    w = {"mean": flat.mean(axis=0, dtype="float64"), "spread": flat.std(axis=0, dtype="float64") + 1e-2}
    size = np.array([len(b) for b in bags])
    at = np.append(0, np.cumsum(size))
    p = {"E": rng.normal(0, 0.06, (flat.shape[1], HIDDEN)), "e": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
         "a": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    m, v, step = {k: 0 * x for k, x in p.items()}, {k: 0 * x for k, x in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for s in range(0, len(order), 64):
            pick = order[s:s + 64]
            x = (np.concatenate([flat[at[i]:at[i + 1]] for i in pick]) - w["mean"]) / w["spread"]
            grad = gradient(p, x, size[pick], labels[pick])
            grad["E"] += 1e-3 * p["E"]
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - 0.004 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model({k: x.astype("float32") for k, x in (w | p).items()})


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", fit_docs: int = FIT_DOCS, fit_passages: int = FIT_PASSAGES) -> Model:
    """Learns from a bounded sample of the given labels."""
    sample = common.labelled_texts(docs, labels, label_col, id_col=id_col, text_col=text_col, limit=fit_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [encode(text).astype("<f4") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in rows], pa.int64()),
                 pa.array([x.tobytes() for x in rows], pa.binary()), batch.column(2).cast(pa.int32())],
                names=["at", "size", "bag", "label"])

    bags = durable(sample.select(F.xxhash64(id_col).alias("at"), "_text", "_label")
                   .mapInArrow(run, "at long, size long, bag binary, label int"), "bags")
    taken, room = [], fit_passages
    for at, size in sorted(map(tuple, bags.select("at", "size").collect())):       # at most fit_docs rows
        if size <= room:
            taken.append(at)
            room -= size
    rows = sorted(bags.filter(F.col("at").isin(taken)).collect())                  # at most fit_passages passages
    return train([np.frombuffer(bytes(r["bag"]), "<f4").reshape(-1, STATS + HASHED) for r in rows],
                 np.array([float(r["label"] > 0) for r in rows]))


def score_column(model: Model):
    """UDF: text -> struct(score)."""
    return common.per_text("score double", lambda: lambda texts: {"score": model.score(texts)})


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return common.with_fields(docs, [id_col], text_col, score_column(model), ["score"])


def reject(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` without those that score below ``threshold``; same columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.filter(score_column(model)(F.col(text_col))["score"] >= threshold)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned where crc32(doc_id) mod 5 is not 0."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir)
    rest = common.remainder("doc_id", 5)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(rest != 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
