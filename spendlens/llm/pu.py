"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled 1; everything else is unlabelled
text.  A logistic model over text statistics minimises the non-negative unbiased
risk (Kiryo et al., "Positive-Unlabeled Learning with Non-Negative Risk
Estimator", 2017): prior * R+(positives) + max(0, R-(unlabelled) - prior *
R-(positives)), with the gradient step of the paper where the negative part
falls below zero.  The class prior is estimated from the trusted labels (share
of 1 with one pseudo-count each way); where no label is 0 there is nothing to
estimate it from and ``default_prior`` is taken.

Fitting uses a bounded sample (``max_fit`` positives and as many unlabelled
documents, chosen by a hash of the id), so what reaches the driver is bounded
whatever the corpus.  Scoring reads every whole text once, in tasks.

The features are computed from the text alone: share of capitals, digits, marks
and symbols; how often words, word pairs, windows of three words and lines are
repeated; word lengths; characters per line.  Id, source, language and labels
are never features.

Defined results: null and empty texts have the features of no words and get a
score like any other; labels without a document and documents without a label
are allowed; a document labelled 1 in any of several label rows is positive; with
no positives, or no unlabelled rows, the score is the prior; repeated rows score
alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import crc_bucket, fresh, read

# Byte classes of the features.
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGIT = bytes(range(48, 58))
BLANK = b" \t\n\r\x0b\x0c"
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"!", b"?", b".", b",", b":", b";", b"-", b"_", b"=", b"/", b"<", b">",
           b"@", b"\\", b"{", b"}", b"(", b")", b"+", b"~", b"'", b'"')
_MULTI = re.compile(rb"([#*$%&!?~=+_-])\1")


@dataclass(frozen=True)
class PUParams:
    held_out_of: int = 5
    max_fit: int = 15_000
    default_prior: float = 0.8
    threshold: float = 0.3
    epochs: int = 300
    rate: float = 0.05
    decay: float = 1e-4
    beta: float = 0.0
    gamma: float = 1.0


def _share(n: float, of: float) -> float:
    return n / of if of else 0.0


def features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    ws = raw.split()
    k = len(ws)
    upper = n - len(raw.translate(None, UPPER))
    lower = n - len(raw.translate(None, LOWER))
    digits = n - len(raw.translate(None, DIGIT))
    blanks = n - len(raw.translate(None, BLANK))
    wide = n - len(raw.translate(None, bytes(range(128, 256))))
    marks = [raw.count(s) for s in SYMBOLS]
    symbols = sum(marks[:6])
    low = raw.lower().split()
    kinds = len(set(low))
    repeats = sum(map(eq, low, low[1:]))
    pairs = len(set(zip(low, low[1:])))
    triples = len(set(zip(low, low[1:], low[2:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(map(raw.count, (b".\n", b". ", b"? ", b"! ")))
    caps = sum(map(bytes.isupper, ws))
    out = [math.log1p(n), math.log1p(k), _share(upper, upper + lower), _share(digits, n), _share(blanks, n), _share(wide, n),
           _share(symbols, k), _share(symbols, n), _share(sum(marks), n), _share(len(_MULTI.findall(raw)), k),
           _share(kinds, k), _share(k - kinds, math.sqrt(k) * 10 if k else 0), _share(repeats, k), _share(pairs, k - 1),
           _share(triples, k - 2), _share(len(lines) - len(set(lines)), len(lines)), _share(k, len(lines)) / 100,
           _share(n - blanks, k) / 10, _share(ends, k), _share(caps, k), float(k < 20), float(k < 50)]
    # Small shares matter (a text may be junk in part only): the same on a log scale.
    for x in (_share(symbols, k), _share(caps, k), _share(repeats, k), _share(marks[5], k), _share(marks[6], k),
              _share(len(_MULTI.findall(raw)), k), _share(len(lines) - len(set(lines)), len(lines)),
              1 - _share(triples, k - 2) if k > 2 else 0.0, 1 - _share(pairs, k - 1) if k > 1 else 0.0):
        out.append(math.log(x + 0.002))
    return out + [_share(m, k) for m in marks]


N_FEATURES = len(features(""))


def matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, N_FEATURES)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, p: PUParams = PUParams()) -> dict:
    """Standardisation and weights of the logistic model."""
    both = np.concatenate([positive, unlabelled])
    if not len(positive) or not len(unlabelled):
        return {"mean": np.zeros(N_FEATURES), "scale": np.ones(N_FEATURES), "w": np.zeros(N_FEATURES),
                "b": math.log(prior / (1 - prior))}
    mean, scale = unlabelled.mean(0), both.std(0) + 1e-3

    def norm(x):
        return np.clip((x - mean) / scale, -6, 6)
    xp, xu = norm(positive), norm(unlabelled)
    w, b = np.zeros(N_FEATURES), math.log(prior / (1 - prior))
    m1, m2 = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for step in range(1, p.epochs + 1):
        sp, su = _sigmoid(xp @ w + b), _sigmoid(xu @ w + b)
        # Logistic loss: d loss(+1) = s - 1, d loss(-1) = s.
        g_pos = np.append(xp.T @ (sp - 1), (sp - 1).sum()) * prior / len(xp)
        g_neg = (np.append(xu.T @ su, su.sum()) / len(xu) - np.append(xp.T @ sp, sp.sum()) * prior / len(xp))
        risk_neg = _softplus(xu @ w + b).mean() - prior * _softplus(xp @ w + b).mean()
        g = g_pos + g_neg if risk_neg >= -p.beta else -p.gamma * g_neg
        g[:-1] += p.decay * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = p.rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return {"mean": mean, "scale": scale, "w": w, "b": b}


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _softplus(x):
    return np.logaddexp(0, x)


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    return _sigmoid(np.clip((x - model["mean"]) / model["scale"], -6, 6) @ model["w"] + model["b"])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = matrix(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["side", "x"])


def learn(docs: DataFrame, labels: DataFrame, p: PUParams = PUParams()) -> dict:
    """Fit on the documents (doc_id, text) and labels (doc_id, quality) whose
    crc32(doc_id) modulo ``held_out_of`` is not 0."""
    learnable = crc_bucket("doc_id", p.held_out_of) != 0
    marked = (labels.where(learnable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("quality")))
    rows = docs.where(learnable).select("doc_id", "text")
    seen = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("ones")).first()
    ones = int(seen.ones or 0)
    prior = (ones + 1) / (seen.n + 2) if seen.n > ones else p.default_prior
    total = rows.count()

    def drawn(key: str, of: int, seed: int) -> Column:
        # A hash of the id below the share that gives about max_fit rows.
        u = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11) / F.lit(float(1 << 53))
        return u < F.lit(min(1.0, p.max_fit / max(1, of)))
    trusted = marked.where((F.col("quality") == 1) & drawn("labelled", ones, 1)).select("labelled")
    # At most about max_fit ids: small enough to send to the tasks.
    joined = rows.join(F.broadcast(trusted.limit(2 * p.max_fit)), rows["doc_id"] == trusted["labelled"], "left")
    positive, unlabelled = F.col("labelled").isNotNull(), F.coalesce(drawn("doc_id", total, 2), F.lit(False))
    sides = F.array_compact(F.array(F.when(positive, F.lit(1)), F.when(unlabelled, F.lit(0))))
    sample = (joined.where(positive | unlabelled).select(F.explode(sides).alias("side"), "text")
              .mapInArrow(_sample_rows, "side int, x array<double>").limit(4 * p.max_fit).toArrow())
    side = sample.column("side").to_numpy()
    x = np.array(sample.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, N_FEATURES)
    model = fit(x[side == 1], x[side == 0], prior, p)
    model["prior"] = prior
    return model


def scorer(model: dict):
    @F.pandas_udf("double")
    def run(texts):
        import pandas as pd
        return pd.Series(apply(model, matrix(texts)), dtype="float64")
    return run


def score(docs: DataFrame, model: dict, p: PUParams = PUParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    return (docs.select("doc_id", (crc_bucket("doc_id", p.held_out_of) == 0).alias("held_out"),
                        scorer(model)(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= p.threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, p: PUParams = PUParams()) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier predicts as good."""
    name, = fresh(docs, "score")
    model = learn(docs, labels, p)
    return docs.withColumn(name, scorer(model)(F.col("text"))).where(F.col(name) >= p.threshold).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, learn(docs, read(spark, sf_dir, "labels").select("doc_id", "quality")))
