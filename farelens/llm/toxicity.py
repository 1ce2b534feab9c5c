"""Toxicity scores by non-negative positive-unlabelled learning.

Linear numpy classifiers learn from confirmed toxic texts and unlabelled ones.  With the class
prior ``p``, the risk of a scoring function is estimated without negatives as

    p * loss(positives as toxic) + max(0, loss(all as clean) - p * loss(positives as clean))

where the second part is the risk of the clean class; it cannot be negative, so when it is,
the step undoes the overfit instead of following it.  Several classifiers learn in Spark
tasks, each from all positives and a share of the unlabelled texts; their scores are averaged
and turned into probabilities by a logistic fit to labelled texts.

Features are words and their first 4, 5 and 6 letters, hashed, valued by the logarithm of
their rate in the text.  A classifier keeps the ``features`` ones whose rate is most raised
among positives and that at least five positives have.

Only fitting is bounded, by the parameters of ``fit``: the first so many ids in hash order.
Scoring reads every text whole, in one pass without a shuffle, with a model of fixed size.

Defined results: a null or empty text has no features and gets the score of the bias; a row
with a null id is scored and belongs to no held-out part; without a positive or without a
clean label every score is the share of toxic ones among known labels (0 if there are none);
labels of ids that are null, unknown or unmarked are ignored, and of an id's repeated labels
or documents the largest label and the smallest text count; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

DIM = 1 << 18
RATE = 200  # a word in every RATE words has the value log 2
LEAST_TEXTS = 5
MOST_WORDS = 1 << 20
_WORD = re.compile(r"\w+")


class Features:
    """Hashed features of texts; with ``chosen``, only those marked there."""

    def __init__(self, chosen: np.ndarray | None = None):
        self.chosen = chosen
        self.known: dict[bytes, bytes] = {}

    def of_word(self, token: bytes) -> bytes:
        found = []
        for word in _WORD.findall(token.decode().lower()):
            found.append(word)
            found += [f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k]
        places = np.array([xxhash.xxh32_intdigest(x.encode()) % DIM for x in found], "<u4")
        return (places if self.chosen is None else places[self.chosen[places]]).tobytes()

    def of_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the features that the text has."""
        words = (text or "").encode().split()
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        for word in set(words):
            if word not in self.known:
                self.known[word] = self.of_word(word)
        found = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")
        places, count = np.unique(found, return_counts=True)
        return places, np.log1p(count * (RATE / max(1, len(words)))).astype(np.float32)


@dataclass
class Rows:
    """Sparse feature rows, one after the other."""

    ends: np.ndarray
    places: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, places: list[bytes], values: list[bytes]) -> Rows:
        ends = np.cumsum([0, *(len(x) // 4 for x in places)])
        return cls(ends, np.frombuffer(b"".join(places), "<u4"),
                   np.frombuffer(b"".join(values), "<f4"))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def only(self, chosen: np.ndarray) -> Rows:
        keep = chosen[self.places]
        return Rows(np.concatenate([[0], np.cumsum(keep)])[self.ends], self.places[keep],
                    self.values[keep])

    def total(self, power: int = 1) -> np.ndarray:
        return np.bincount(self.places, self.values.astype(float) ** power, DIM)

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(weights[self.places] * self.values)])
        return upto[self.ends[1:]] - upto[self.ends[:-1]] + bias

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        """Of the weights and, last, the bias."""
        per_value = np.repeat(slopes, np.diff(self.ends)) * self.values
        return np.append(np.bincount(self.places, per_value, DIM), slopes.sum())


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def choose_features(positive: Rows, unlabelled: Rows, most: int) -> np.ndarray:
    """Marks of the features whose mean value is most raised among positives."""
    raised = positive.total() / len(positive) - unlabelled.total() / len(unlabelled)
    spread = unlabelled.total(2) / len(unlabelled) + 1e-4
    score = np.where(np.bincount(positive.places, minlength=DIM) >= LEAST_TEXTS,
                     raised / np.sqrt(spread), -np.inf)
    best = np.argsort(-score, kind="stable")[:most]
    chosen = np.zeros(DIM, bool)
    chosen[best[score[best] > 0]] = True
    return chosen


def pu_risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """Risk of the toxic class, and of the clean class before it is kept from going below 0."""
    loss = lambda z: float(np.logaddexp(0, z).mean())
    return prior * loss(-zp), loss(zu) - prior * loss(zp)


def pu_slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Descent slopes by the margins of positives and of unlabelled rows."""
    clean_p, clean_u = -prior * sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
    if pu_risk(zp, zu, prior)[1] < 0:
        return -clean_p, -clean_u
    return prior * (sigmoid(zp) - 1) / len(zp) + clean_p, clean_u


def train(positive: Rows, unlabelled: Rows, prior: float, features: int,
          steps: int = 200, rate: float = 0.1, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias of one classifier."""
    chosen = choose_features(positive, unlabelled, features)
    positive, unlabelled = positive.only(chosen), unlabelled.only(chosen)
    model, first, second = (np.zeros(DIM + 1) for _ in range(3))
    for step in range(1, steps + 1):
        w, b = model[:-1], model[-1]
        sp, su = pu_slopes(positive.margins(w, b), unlabelled.margins(w, b), prior)
        slope = positive.gradient(sp) + unlabelled.gradient(su)
        slope[:-1] += decay * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        model = model - rate * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return model


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with smoothed targets, by Newton steps."""
    toxic, clean = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    x = np.stack([margins, np.ones(len(margins))])
    fit = np.array([1.0, 0.0])
    loss = lambda f: float((np.logaddexp(0, f @ x) - goal * (f @ x)).mean())
    for _ in range(50):
        p = sigmoid(fit @ x)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - goal))
        while loss(fit - step) > loss(fit) and np.abs(step).max() > 1e-9:
            step = step / 2
        fit = fit - step
    return float(max(fit[0], 1e-6)), float(fit[1])


@dataclass
class Model:
    """A fixed number of weights; ``places`` and ``weights`` are parallel."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(DIM)
        out[self.places] = self.weights
        return out


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int,
           labelled: int) -> DataFrame:
    """``doc_id, kind, toxic, places, values``: the bounded rows that fitting reads."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("doc_id")
    ids = docs.where("doc_id IS NOT NULL").where(~is_held_out(F.col("doc_id")))
    pick = lambda df, n, kind: df.orderBy(order, "doc_id").limit(n).select(
        "doc_id", F.lit(kind).alias("kind"), F.col("toxic").cast("int").alias("toxic"))
    chosen = (
        pick(known.where("toxic = 1"), positives, "positive")
        .unionByName(pick(ids.select("doc_id").distinct().withColumn("toxic", F.lit(None)),
                          unlabelled, "unlabelled"))
        .unionByName(pick(known, labelled, "labelled")))
    wanted = chosen.groupBy("doc_id").agg(F.collect_list(F.struct("kind", "toxic")).alias("uses"))
    # Bounded by the three limits; they are parameters and do not grow with the data.
    texts = (docs.select("doc_id", "text").join(F.broadcast(wanted.select("doc_id")), "doc_id")
             .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
             .join(wanted, "doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            found = [features.of_text(x) for x in batch["text"]]
            yield batch[["doc_id", "uses"]].assign(
                places=[a.astype("<u4").tobytes() for a, _ in found],
                values=[b.astype("<f4").tobytes() for _, b in found])

    return texts.mapInPandas(
        run, "doc_id long, uses array<struct<kind:string,toxic:int>>, places binary, values binary"
    ).select("doc_id", F.inline("uses"), "places", "values")


def fit(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 16000,
        labelled: int = 8000, classifiers: int = 4, features: int = 1000) -> Model:
    """Fit on at most so many positive, unlabelled and labelled texts.

    Columns are ``doc_id, text`` and ``doc_id, toxic``.  Held-out ids are used nowhere.  The
    class prior is the share of toxic ones among the labels of ids not held out.
    """
    from farelens.llm.tables import store

    seen = labels.where("toxic IN (0, 1)").where(~is_held_out(F.col("doc_id"))).agg(
        F.avg("toxic").alias("prior"), F.count("toxic").alias("n")).first()
    prior = float(seen["prior"] or 0.0)
    nothing = np.zeros(0)
    if not 0 < prior < 1:
        return Model(nothing.astype(int), nothing, {0.0: -40.0, 1.0: 40.0}[prior])
    rows = store(sample(docs, labels, positives, unlabelled, labelled), "toxicity")
    share = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(classifiers)).cast("int")
    shares = (rows.where("kind = 'unlabelled'").withColumn("share", share).unionByName(
        rows.where("kind = 'positive'").withColumn(
            "share", F.explode(F.sequence(F.lit(0), F.lit(classifiers - 1))))))

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        part = {k: Rows.of(list(x["places"]), list(x["values"])) for k, x in group.groupby("kind")}
        if len(part) < 2:
            return pd.DataFrame({"place": [], "weight": []})
        model = train(part["positive"], part["unlabelled"], prior, features)
        places = np.flatnonzero(model[:-1])
        return pd.DataFrame({"place": [*places, DIM], "weight": [*model[places], model[-1]]})

    # At most ``features`` weights and a bias from each classifier.
    learned = shares.groupBy("share").applyInPandas(learn, "place int, weight double").toPandas()
    trained = max(1, int((learned["place"] == DIM).sum()))
    summed = learned.groupby("place")["weight"].sum() / trained
    model = Model(summed.index[summed.index < DIM].to_numpy(),
                  summed[summed.index < DIM].to_numpy(), float(summed.get(DIM, 0.0)))

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dense = model.dense()
        for x in batches:
            found = Rows.of(list(x["places"]), list(x["values"]))
            yield pd.DataFrame({"z": found.margins(dense, model.bias), "y": x["toxic"]})

    known = rows.where("kind = 'labelled'").mapInPandas(margins, "z double, y int").toPandas()
    slope, offset = calibrate(known["z"].to_numpy(), known["y"].to_numpy())
    return Model(model.places, model.weights * slope, model.bias * slope + offset)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one dense array of DIM at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        dense = own.dense()
        features = Features(dense != 0)
        for batch in batches:
            z = np.full(batch.num_rows, own.bias)
            for i, value in enumerate(batch.column(2)):
                places, values = features.of_text(value.as_py())
                z[i] += dense[places] @ values
            p = sigmoid(z)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p),
                 pa.array((p >= threshold).astype("i4"))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       is_held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out and score all."""
    return score(docs, fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
