"""Quality classifier: naive Bayes support vectors (NB-SVM).

Indicators of word uni- and bigrams (hashed to ``2**BITS`` features), of word
endings and of binned shares (distinct words, distinct bigrams, symbols,
capitals) are scaled by the class log-count ratios; a linear hinge-loss model
is fitted on the scaled, length-normalised vectors by dual coordinate
descent. A sigmoid fitted on rows kept out of the descent turns margins into
scores.

Fitting uses a bounded sample: about ``TRAIN_ROWS`` labelled rows, those with
the smallest key hash, in one task (a few thousand feature numbers each).
The model (one weight per feature, 2**BITS floats) is broadcast; scoring is
one pass over all texts without a shuffle.

Only rows with crc32(doc_id) mod 3 other than 1 and a label of 0 or 1 are
learned from; without rows of both classes every score is the smoothed class
share. Null and empty texts are scored from the binned features alone.
Repeated rows are scored each; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.batches import bound_batches
from tallystar.llm.hashing import BASE, NOT_BLANK, byte_codes, mix64, text_runs, utf8, words
from tallystar.sources.testdata import read_table

BITS = 18
TRAIN_ROWS = 8_000
CALIBRATION_SHARE = 5     # every fifth training row fits the sigmoid
EPOCHS = 20
COST = 1.0
SMOOTHING = 1.0
SYMBOLS = b"#*$%&|<>!@^~=_{}[]\\"


def _bins(raw: bytes, n_words: int, n_uni: int, n_bi: int) -> list[int]:
    """Binned shares as indicator numbers below 64 * 5."""
    size = max(1, len(raw))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    upper = len(raw) - len(raw.translate(None, bytes(range(65, 91))))
    share = lambda a, b, k: min(k, int(k * a / max(1, b)))
    return [share(n_uni, n_words, 20), 64 + share(n_bi, n_words - 1, 20), 128 + share(symbols, size, 40),
            192 + share(upper, size, 20), 256 + min(12, n_words.bit_length())]


def feature_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) pairs, each once, sorted by text."""
    h, which, _, end = words(texts, NOT_BLANK, byte_codes(lower=True))
    n = len(texts)
    shift = np.uint64(64 - BITS)
    same = which[1:] == which[:-1]
    bi = mix64(h[:-1] * BASE + h[1:])[same]
    # The last two bytes of a word: endings such as "**" or ".,".
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"\n".join(texts) if texts else b"", np.uint8)
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if n else np.zeros(0, np.int64)
    at = first[which] + end - 1
    tail = joined[at].astype(np.uint64) * np.uint64(256) + joined[np.maximum(at - 1, 0)].astype(np.uint64) \
        if len(at) else np.zeros(0, np.uint64)
    tail = mix64(tail + np.uint64(1 << 40))
    key = lambda doc, x: doc.astype(np.uint64) << np.uint64(BITS) | x >> shift
    uni = np.unique(key(which, h))
    pairs = np.unique(key(which[1:][same], mix64(bi + np.uint64(7))))
    per = lambda k: np.bincount((k >> np.uint64(BITS)).astype(np.int64), minlength=n)
    n_words, n_uni, n_bi = np.bincount(which, minlength=n), per(uni), per(pairs)
    binned = np.array([(k, b) for k in range(n)
                       for b in _bins(texts[k], int(n_words[k]), int(n_uni[k]), int(n_bi[k]))], dtype=np.uint64)
    extra = key(binned[:, 0], mix64(binned[:, 1] + np.uint64(1 << 50))) if n else np.zeros(0, np.uint64)
    every = np.unique(np.concatenate([uni, pairs, key(which, tail), extra]))
    return (every >> np.uint64(BITS)).astype(np.int64), (every & np.uint64((1 << BITS) - 1)).astype(np.int64)


def log_count_ratio(y: np.ndarray, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
    size = 1 << BITS
    up = np.bincount(feature[y[doc] > 0], minlength=size) + SMOOTHING
    down = np.bincount(feature[y[doc] < 0], minlength=size) + SMOOTHING
    return np.log((up / up.sum()) / (down / down.sum()))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                 cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """min |w|^2 / 2 + cost * sum hinge(y w.x) by coordinate descent on the
    dual; the last weight is the bias (a constant feature of 1)."""
    w = np.zeros(size + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            idx, val = rows[i]
            gradient = y[i] * (w[idx] @ val + w[size]) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[idx] += step * val
                w[size] += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def sigmoid_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: a, b of 1 / (1 + exp(-(a m + b))), smoothed targets, Newton steps."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        hess = np.array([[(s * margin ** 2).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fit(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, float, float]:
    """Weights with the log-count ratios folded in (bias last) and the sigmoid."""
    size = 1 << BITS
    y = np.where(labels > 0, 1, -1)
    share = (y > 0).sum() + 1.0
    constant = (np.zeros(size + 1, np.float32), 1.0, float(np.log(share / (len(y) + 2.0 - share))))
    if len(set(y.tolist())) < 2:
        return constant
    held = ids % CALIBRATION_SHARE == 0
    train = np.flatnonzero(~held)
    if len(set(y[train].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held, train = np.ones(len(y), bool), np.arange(len(y))
    doc = np.repeat(np.arange(len(train)), [len(sets[i]) for i in train])
    ratio = log_count_ratio(y[train], doc, np.concatenate([sets[i] for i in train]))
    scaled = [(s, ratio[s] / np.sqrt(max(1, len(s)))) for s in sets]
    w = dual_descent([scaled[i] for i in train], y[train], size)
    margin = np.array([w[s] @ v + w[size] for (s, v), h in zip(scaled, held) if h])
    a, b = sigmoid_fit(margin, y[held])
    return np.append(w[:size] * ratio, w[size]).astype(np.float32), a, b


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
          rows: int = TRAIN_ROWS) -> tuple[bytes, float, float]:
    """Model from a bounded sample of labels: weights, sigmoid slope and offset."""
    usable = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()
                           & (F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) != 1))
              .groupBy(F.col(key).alias("key")).agg(F.min(label).cast("int").alias("y")))
    n = usable.count()
    spread = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 30))
    chosen = (usable.withColumn("id", spread)
              .where(F.col("id") < int((1 << 30) * min(1.0, rows / max(1, n)))))
    # About ``rows`` label rows whatever the input size, so they are broadcast;
    # equal keys in docs give one training row.
    sample = (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
              .groupBy("key", "id", "y").agg(F.min("text").alias("text")).drop("key"))

    def extract(batches):
        for pdf in batches:
            raw = utf8(pdf["text"])
            out: list[bytes] = []
            for a, b in text_runs(raw):
                doc, feature = feature_sets(raw[a:b])
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                out += [feature[cut[k]:cut[k + 1]].astype(np.int32).tobytes() for k in range(b - a)]
            yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"], "features": out})

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "y"], kind="stable")
        sets = [np.frombuffer(f, np.int32) for f in pdf["features"]]
        w, a, b = fit(pdf["id"].to_numpy() // 7, pdf["y"].to_numpy(), sets)
        return pd.DataFrame({"w": [w.tobytes()], "a": [a], "b": [b]})

    model = (sample.mapInPandas(extract, "id long, y int, features binary")
             .groupBy(F.lit(0).alias("one")).applyInPandas(learn, "w binary, a double, b double")).first()
    if model is None:
        return np.zeros((1 << BITS) + 1, np.float32).tobytes(), 1.0, 0.0
    return bytes(model["w"]), model["a"], model["b"]


def score(docs: DataFrame, model: tuple[bytes, float, float], text: str = "text", column: str = "score") -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(series: pd.Series) -> pd.Series:
        blob, a, b = held.value
        w = np.frombuffer(blob, np.float32)
        raw = utf8(series)
        margin = np.zeros(len(raw))
        for s, e in text_runs(raw):
            doc, feature = feature_sets(raw[s:e])
            size = np.maximum(1, np.bincount(doc, minlength=e - s))
            margin[s:e] = np.bincount(doc, weights=w[feature], minlength=e - s) / np.sqrt(size) + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30))))

    return docs.withColumn(column, F.pandas_udf(run, "double")(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = train(docs, labels, "doc_id", "text", "quality")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
