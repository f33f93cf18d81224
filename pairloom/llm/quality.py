"""Quality classifier: support vectors over naive Bayes features.

Indicators of n-grams (bytes, and whether words repeat their neighbours) are scaled by the log ratio of their
counts in the two classes; a linear model of hinge loss is then fitted by dual coordinate descent, and
its margin turned into a probability. The counts are taken over the labelled training rows (label_rows of them, if there are
more), combined per task before the shuffle; they number at most FEATURES. The fit takes a smaller sample (sample_rows per
class, by hash order), so it fits one task. Scoring is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.shared import TEXTS, fold_of, give_back, giving_back, parts_of, whole
from pairloom.llm.words import SHORT_STEP, mix, steps, words_of

#: Hashed n-grams of 3 and 4 bytes, and 64 patterns of repetition among six words in a row.
_GRAMS = 1 << 16
_REPEATS = 64
FEATURES = 2 * _GRAMS + _REPEATS
#: Labelled rows of each class that the support vectors are fitted on, at most; as many more calibrate.
SAMPLE_ROWS = 3000
#: Labelled training rows that the counts are taken of, at most.
LABEL_ROWS = 200_000


def indicators(texts: list[str]):
    """For each text the sorted numbers of the features it has."""
    for a, b in steps(texts, SHORT_STEP):
        part = texts[a:b]
        hashes, offsets, _, _, _ = words_of(part, lower=False)
        same = np.concatenate(([False], hashes[1:] == hashes[:-1])).astype(np.int64)
        raw = [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32) for t in part]
        for d, x in enumerate(raw):
            seen = np.zeros(FEATURES, bool)
            if len(x) > 2:
                three = x[:-2] << 16 | x[1:-1] << 8 | x[2:]
                seen[(three * np.uint32(0x9E3779B1)) >> 16] = True
                if len(x) > 3:
                    four = three[:-1] << 8 | x[3:]
                    seen[_GRAMS + ((four * np.uint32(0x85EBCA6B)) >> 16)] = True
            row = same[offsets[d] : offsets[d + 1]].copy()
            if len(row) > 5:
                row[0] = 0  # the neighbour before is of another text
                seen[2 * _GRAMS + sum(row[k : len(row) - 5 + k] << k for k in range(6))] = True
            yield np.flatnonzero(seen)


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, label_rows: int) -> DataFrame:
    """Training rows: fold 0 is held out; labels other than 0 and 1 do not count, and of several of one key the
    smallest does. The labels used are bounded (by a hash, if there are more), so they are broadcast and no text is shuffled."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1) and _key is not null")
    known = known.where(fold_of(F.col("_key"), folds) != 0).groupBy("_key").agg(F.min("_label").alias("_label"))
    there = known.count()
    if there > label_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(3), F.col("_key")), F.lit(1 << 40)) < int(label_rows / there * (1 << 40)))
    rows = docs.select(F.col(key).alias("_key"), whole(F.col(text)).alias("_text"))
    return rows.join(F.broadcast(known), "_key")


def class_counts(rows: DataFrame) -> DataFrame:
    """(feature, bad, good) over all rows with _text and _label: in how many of each class a feature occurs."""

    def count(batches):
        held = np.zeros((2, FEATURES), np.int64)
        for part in parts_of(batches):
            for y, ids in zip(part.column(0).to_pylist(), indicators(part.column(1).to_pylist())):
                held[y, ids] += 1
        there = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (there.astype(np.int32), held[0, there], held[1, there])], names=["feature", "bad", "good"])

    one = rows.select("_label", "_text").mapInArrow(giving_back(count), "feature int, bad long, good long")
    return one.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def log_ratios(bad: np.ndarray, good: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log of the smoothed share of each feature among good over that among bad."""
    p, q = good + alpha, bad + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list, signs: np.ndarray, ratios: np.ndarray, cost: np.ndarray, epochs: int = 12) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss model over rows of feature numbers scaled by ratios;
    cost: the upper bound of each row's dual variable. The scaled rows are made anew each time, so that only
    their numbers are in memory."""
    weights = np.zeros(len(ratios) + 1)
    scales = np.append(ratios, 1.0)

    def row(i):
        place = np.append(rows[i], len(ratios))
        return place, scales[place]

    norms = [float(v @ v) for _, v in map(row, range(len(rows)))]
    dual = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            place, value = row(i)
            gradient = signs[i] * float(weights[place] @ value) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), cost[i])
            if new != dual[i]:
                weights[place] += (new - dual[i]) * signs[i] * value
                dual[i] = new
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def calibration(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve from margin to probability, by Newton steps; a little ridge
    keeps the slope finite where the classes are apart."""
    if not len(margins):
        return 1.0, 0.0
    spread = max(float(np.abs(margins).mean()), 1e-9)
    x = np.column_stack([margins / spread, np.ones(len(margins))])
    theta = np.zeros(2)
    for _ in range(60):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (weights * (labels - p)) - 0.05 * theta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        theta += np.clip(move, -2, 2)
    return float(theta[0] / spread), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, sample_rows: int = SAMPLE_ROWS, label_rows: int = LABEL_ROWS, cost: float = 0.02) -> dict:
    """The model: {"weights": array of FEATURES numbers (log ratios multiplied in), "bias", "slope", "intercept", "prior"}.

    Fold 0 by crc32 of the key is never seen. With no labelled row, or labels of one class only, the weights are
    zero and every score is the share of label 1 (one half if there is none).
    """
    spark = docs.sparkSession
    rows = _labelled(docs, labels, key, text, label, folds, label_rows)
    # Counts of classes, and the counts of features: at most FEATURES rows come to the driver.
    counts = class_counts(rows).toPandas()
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    bad, good = np.zeros(FEATURES), np.zeros(FEATURES)
    bad[counts["feature"]], good[counts["feature"]] = counts["bad"], counts["good"]
    share = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
    if not sizes.get(0) or not sizes.get(1):
        prior = sizes.get(1, 0) / max(1, sum(sizes.values())) if sizes else 0.5
        return {"weights": np.zeros(FEATURES, np.float32), "bias": 0.0, "slope": 0.0, "intercept": float(np.log((prior + 1e-9) / (1 - prior + 1e-9))), "prior": prior}
    ratios = log_ratios(bad, good)
    # A bounded sample: of each class the rows first in the order of a hash. The order is of numbers only;
    # the texts follow by key.
    draw = F.xxhash64(F.lit(5), F.col("_key"))
    keys = rows.select("_key", "_label", draw.alias("_draw"))
    parts = [keys.where(f"_label = {y}").orderBy("_draw", "_key").limit(2 * sample_rows) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select("_key", "_draw").distinct()
    sample = rows.join(F.broadcast(chosen), "_key").dropDuplicates(["_key"])
    held = spark.sparkContext.broadcast((ratios, sizes, cost))

    def learn(batches):
        ratios, sizes, cost = held.value
        drawn, y, ids = [], [], []
        for part in parts_of(batches):
            drawn += part.column(0).to_pylist()
            y += part.column(1).to_pylist()
            ids += [i.astype(np.int32) for i in indicators(part.column(2).to_pylist())]
        order = np.argsort(np.array(drawn, np.int64), kind="stable")
        y = np.array(y, np.int64)[order]
        ids = [ids[i] for i in order]
        train = np.arange(len(y)) % 2 == 0
        if len(np.unique(y[train])) < 2:
            train[:] = True
        per_class = np.array([len(y[train]) / 2 / max(1, (y[train] == c).sum()) for c in (0, 1)])
        rows_at = np.flatnonzero(train)
        weights = dual_coordinate_descent([ids[i] for i in rows_at], np.where(y[rows_at] > 0, 1.0, -1.0), ratios, cost * per_class[y[rows_at]])
        scaled = weights[:-1] * ratios
        other = np.flatnonzero(~train) if not train.all() else rows_at
        margins = np.array([scaled[ids[i]].sum() for i in other]) + weights[-1]
        real = np.array([sizes.get(c, 0) / max(1, (y[other] == c).sum()) for c in (0, 1)])
        real *= len(other) / max(1e-9, (real[y[other]]).sum())
        slope, intercept = calibration(margins, y[other].astype(float), real[y[other]])
        made = {"weights": scaled.astype(np.float32).tobytes(), "bias": float(weights[-1]), "slope": float(slope), "intercept": float(intercept)}
        yield pa.RecordBatch.from_pylist([made])

    model = sample.select("_draw", "_label", "_text").repartition(1).mapInArrow(giving_back(learn), "weights binary, bias double, slope double, intercept double").first()
    return {"weights": np.frombuffer(model["weights"], np.float32), "bias": model["bias"], "slope": model["slope"], "intercept": model["intercept"], "prior": share}


def with_quality(docs: DataFrame, model: dict, text: str = "text", score: str = "_score") -> DataFrame:
    """docs with a score from 0 to 1, higher where label 1 is likelier, from the text alone. Null and empty
    texts have no feature and get the score of the bias. All columns stay; the score's name must be new."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for texts in columns:
            parts = (texts.slice(x, TEXTS).to_pylist() for x in range(0, len(texts), TEXTS))
            margins = np.array([m["weights"][ids].sum(dtype=np.float64) for part in parts for ids in indicators(part)]) + m["bias"]
            yield pa.array(_sigmoid(m["slope"] * margins + m["intercept"]))
        give_back()

    return docs.withColumn(score, scored(whole(F.col(text))))
