"""Toxicity (operator 6): maximum-scoring segments of token log-odds.

* Tokens (and their beginnings of 4 to 6 bytes, as classes of rare words) get
  the log-odds of toxic against other labelled documents by document
  frequency, with an informative Dirichlet prior from both together. Tokens
  that stand out (likelihood ratio statistic) score their log-odds, all others
  a small negative drift. A z-score would not do: the fewer other documents
  have a token, the larger is its variance.
* A linear-time scan over a document's scores finds all its maximal-scoring
  segments (Ruzzo and Tompa); only tokens that score above zero are visited,
  the drift between them is a multiplication.
* Under the null a segment's score S in n tokens has E = K n exp(-lambda S)
  chance equals: lambda solves sum p_s exp(lambda s) = 1 for the other
  documents' scores, K makes their mean E one. A document's best and
  significant segments' E-values go into a logistic curve fitted to the labels.

Fitting uses at most ``FIT_DOCS`` labelled documents (lowest id hash) and keeps
every token of theirs that stands out; scoring reads every whole text, without a
shuffle.

Defined cases: null text, or one without tokens, has no segment and scores
least; repeated rows get equal scores; a null id is never learned from and not
held out; without two label values to learn from every score is the share of
label 1 (0 without labels); an empty table gives no rows; other columns are
ignored (or kept, in ``reject``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import common

FIT_DOCS = 20_000
MIN_DOCS = 4            # documents with a token, at least
MIN_G2 = 24.0           # likelihood ratio statistic: a token that toxic documents have by chance stays below
PRIOR = 10.0            # pseudo-documents of the prior
DRIFT = -0.5
SIGNIFICANT = 0.05      # E-value
THRESHOLD = 0.7
_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_BEGINNINGS = (4, 5, 6)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all other characters above ASCII."""
    return common.word_bytes(text).translate(_LETTERS).split()


def classes(token: bytes) -> list[bytes]:
    return [token] + [token[:k] + b"*" for k in _BEGINNINGS if len(token) >= k]


def segments(positions: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, last token) of a sequence
    that scores ``scores`` at ``positions`` and ``drift`` elsewhere; linear time:
    each candidate is merged or removed once."""
    found: list[list] = []       # [sum before, sum after, first, last, place of the nearest candidate with a smaller sum before]
    total, last = 0.0, -1
    for at, s in zip(positions, scores):
        before = total + drift * (at - last - 1)
        total, last = before + s, at
        seg = [before, total, at, at, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= seg[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= seg[1]:
                seg[4] = j
                found.append(seg)
                break
            seg = [found[j][0], seg[1], found[j][2], seg[3], -1]
            del found[j:]
    return [(x[1] - x[0], x[2], x[3]) for x in found]


class Model:
    def __init__(self, odds: dict[bytes, float], scale: float = 1.0, k: float = 1.0,
                 curve: tuple[float, ...] = (0.0, 0.0, 0.0), base: float | None = None):
        self.odds, self.scale, self.k, self.curve, self.base = odds, scale, k, curve, base

    def positive(self, words: set[bytes]) -> dict[bytes, float]:
        """Scores above zero of distinct tokens: a token's own, else that of
        its longest known beginning."""
        odds, out = self.odds, {}
        for w in words:
            s = odds.get(w)
            if s is None and len(w) >= _BEGINNINGS[0]:
                for k in reversed(_BEGINNINGS):
                    s = odds.get(w[:k] + b"*") if len(w) >= k else None
                    if s is not None:
                        break
            if s is not None and s > 0:
                out[w] = s
        return out

    def passages(self, texts: list[str | None]) -> list[tuple[int, list[tuple[float, int, int]]]]:
        """For each text the number of tokens and its segments."""
        split = [tokens(t) for t in texts]
        score = self.positive(set().union(*split))
        out = []
        for words in split:
            at = [i for i, w in enumerate(words) if w in score]
            out.append((len(words), segments(at, [score[words[i]] for i in at])))
        return out

    def evidence(self, n: int, found: list[tuple[float, int, int]]) -> tuple[float, float]:
        """-log10 of the best E-value, log of the number of significant segments + 1."""
        room = np.log(self.k * max(n, 1))
        e = [room - self.scale * s for s, _, _ in found] or [room]
        return (float(np.clip(-min(e) / np.log(10), -6, 12)),
                float(np.log1p(sum(x < np.log(SIGNIFICANT) for x in e))) if found else 0.0)

    def score(self, texts: list[str | None]) -> list[float]:
        if self.base is not None:
            return [self.base] * len(texts)
        x = np.array([self.evidence(n, f) for n, f in self.passages(texts)], "float64").reshape(-1, 2)
        y = self.curve[0] + x @ np.array(self.curve[1:])
        return (1 / (1 + np.exp(-np.clip(y, -30, 30)))).tolist()


def token_odds(sample: DataFrame, total: int, toxic: int) -> dict[bytes, float]:
    """Log-odds of the tokens and beginnings that stand out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(label > 0)].update({c for w in set(tokens(text)) for c in classes(w)})
            both = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.binary()), pa.array([seen[1][t] for t in both], pa.int64()),
                                              pa.array([seen[0][t] for t in both], pa.int64())], names=["t", "y1", "y0"])

    n1, n0 = float(toxic), float(total - toxic)
    counts = (sample.select("_text", "_label").mapInArrow(run, "t binary, y1 long, y0 long")
              .groupBy("t").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
              .filter(F.col("y1") + F.col("y0") >= MIN_DOCS))
    prior = F.lit(PRIOR) * (F.col("y1") + F.col("y0")) / F.lit(n1 + n0)
    a, b = F.col("y1") + prior, F.col("y0") + prior
    odds = F.log(a / (F.lit(n1 + PRIOR) - a + 0.5)) - F.log(b / (F.lit(n0 + PRIOR) - b + 0.5))
    seen, share = F.col("y1") + F.col("y0"), n1 / (n1 + n0)
    g2 = 2 * (F.col("y1") * F.log(F.greatest(F.col("y1"), F.lit(0.5)) / (seen * share))
              + F.col("y0") * F.log(F.greatest(F.col("y0"), F.lit(0.5)) / (seen * (1 - share))))
    rows = (counts.select("t", odds.alias("odds"), g2.alias("g2"))
            .filter((F.col("odds") > 0) & (F.col("g2") >= MIN_G2))
            .orderBy(F.desc("g2"), "t").collect())        # tokens of the bounded sample
    return {bytes(r["t"]): float(r["odds"]) for r in rows}


def _scale(shares: np.ndarray, scores: np.ndarray) -> float:
    """lambda > 0 with sum shares * exp(lambda * scores) = 1."""
    low, high = 1e-6, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if float(shares @ np.exp(np.minimum(mid * scores, 500))) < 1 else (low, mid)
    return low


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's method."""
    x1 = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + 0.05 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x1.T @ (y - p) - 0.05 * w), -2, 2)
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", fit_docs: int = FIT_DOCS) -> Model:
    """Learns from a bounded sample of the given labels."""
    sample = durable(common.labelled_texts(docs, labels, label_col, id_col=id_col, text_col=text_col, limit=fit_docs)
                     .select("_text", "_label"), "labelled")
    total, toxic = sample.agg(F.count(F.lit(1)), F.count_if(F.col("_label") > 0)).first()
    if not 0 < toxic < total:
        return Model({}, base=toxic / total if total else 0.0)
    odds = token_odds(sample, total, toxic)
    first = Model(odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            split = [tokens(t) for t in texts]
            known = first.positive(set().union(*split))
            hits = [[known[w] for w in words if w in known] for words in split]
            found = [[s for s, _, _ in f] for _, f in first.passages(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(1)).cast(pa.int32()), pa.array([len(w) for w in split], pa.int64()),
                 pa.array(hits, pa.list_(pa.float64())), pa.array(found, pa.list_(pa.float64()))],
                names=["label", "n", "hits", "found"])

    # numbers of the sampled documents only
    rows = sample.mapInArrow(run, "label int, n long, hits array<double>, found array<double>").toPandas()
    clean = rows[rows["label"] <= 0]
    hits = np.concatenate([np.asarray(h, float) for h in clean["hits"]]) if len(clean) else np.zeros(0)
    n = max(int(clean["n"].sum()), 1)
    seen, times = np.unique(np.round(hits, 3), return_counts=True)
    # one chance hit is added, so that scores no other document has stay finite evidence
    top = max(odds.values(), default=1.0)
    seen, times = np.append(seen, [top, DRIFT]), np.append(times, [1, max(n - len(hits), 1)]).astype(float)
    scale = _scale(times / times.sum(), seen)
    best = np.array([max(f, default=0.0) for f in clean["found"]])
    k = 1 / max(float(np.mean(np.maximum(clean["n"], 1) * np.exp(-scale * best))), 1e-9)
    model = Model(odds, scale, k)
    x = np.array([model.evidence(m, [(s, 0, 0) for s in f]) for m, f in zip(rows["n"], rows["found"])])
    model.curve = _curve(x, (rows["label"] > 0).to_numpy(float))
    return model


def score_column(model: Model):
    """UDF: text -> struct(score)."""
    return common.per_text("score double", lambda: lambda texts: {"score": model.score(texts)})


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return common.with_fields(docs, [id_col], text_col, score_column(model), ["score"])


def toxic_passages(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per significant passage: id, ``first_token``, ``last_token``,
    ``passage_score``, ``e_value``."""
    def make():
        def run(texts):
            out = []
            for n, found in model.passages(texts):
                e = [(a, b, float(s), float(model.k * max(n, 1) * np.exp(-model.scale * s))) for s, a, b in found]
                out.append([dict(zip(("first_token", "last_token", "passage_score", "e_value"), x)) for x in e if x[3] < SIGNIFICANT])
            return {"p": out}
        return run
    kind = "p array<struct<first_token:long,last_token:long,passage_score:double,e_value:double>>"
    return (common.with_fields(docs, [id_col], text_col, common.per_text(kind, make), ["p"])
            .select(id_col, F.explode("p").alias("p")).select(id_col, "p.*"))


def reject(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; same columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.filter(score_column(model)(F.col(text_col))["score"] < threshold)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned where crc32(doc_id) mod 3 is not 1."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir)
    rest = common.remainder("doc_id", 3)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(rest != 1))
    return score(docs, model).select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
