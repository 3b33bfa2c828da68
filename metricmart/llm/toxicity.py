"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms. The score is a logistic function of a bias, a weight per term, and for each pair
of terms the product of two short vectors, so that terms that only say something together (an insult and who it is
aimed at) are learned as pairs. Trained in numpy on the driver, on a bounded sample of labelled texts; applied to every
whole text inside Spark's tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from metricmart.llm.common import col, smallest_draws

TERM = re.compile(r"\w+")
BUCKETS = 1 << 24


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the lower-case words of a whole text."""
    words = set(TERM.findall((text or "").lower()))
    return np.unique(np.fromiter((zlib.crc32(w.encode()) & (BUCKETS - 1) for w in words), np.int64, len(words)))


@dataclass
class FactorizationMachine:
    """Weights of the buckets that were learned (``known``, sorted); all others count nothing."""

    known: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """Probability of each set of buckets; the empty set has that of the bias."""
        if not len(self.known):
            return np.full(len(sets), 1 / (1 + np.exp(-self.bias)))
        lengths = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets) if len(sets) else np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, flat), len(self.known) - 1)
        hit = self.known[at] == flat
        owner, at = np.repeat(np.arange(len(sets)), lengths)[hit], at[hit]
        linear = np.bincount(owner, self.linear[at], len(sets))
        pairs = np.zeros(len(sets))
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            pairs += np.bincount(owner, v, len(sets)) ** 2 - np.bincount(owner, v * v, len(sets))
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def _difference(toxic: np.ndarray, clean: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How many standard errors apart the shares of toxic and of clean texts are that hold something."""
    n_toxic, n_clean = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
    share = (toxic + clean) / len(labels)
    return np.abs(toxic / n_toxic - clean / n_clean) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n_toxic + 1 / n_clean))


def in_telling_pairs(
    sets: list[np.ndarray], labels: np.ndarray, known: np.ndarray, counts: np.ndarray, min_z: float = 6.0, beyond: float = 3.0, least: int = 3,
    most: int = 1500, chunk: int = 512,
) -> np.ndarray:
    """Which of the ``known`` buckets are half of a pair that tells the classes apart, though alone they may not.

    Pairs are counted among the ``most`` buckets that are in the most texts (at least ``least``, and not in nearly all). A
    pair tells if its shares in the classes are ``min_z`` standard errors apart, ``beyond`` more than those of its halves.
    """
    chosen = np.zeros(len(known), bool)
    some = np.flatnonzero((counts >= least) & (counts < 0.9 * len(sets)))
    some = some[np.argsort(-counts[some], kind="stable")][:most]
    place = np.full(len(known), -1)
    place[some] = np.arange(len(some))
    together = np.zeros((2, len(some), len(some)), np.float32)
    for label in (0, 1):
        texts = np.flatnonzero(labels == label)
        for start in range(0, len(texts), chunk):
            held = np.zeros((min(chunk, len(texts) - start), len(some)), np.float32)
            for row, text in enumerate(texts[start : start + chunk]):
                at = place[np.searchsorted(known, sets[text])]
                held[row, at[at >= 0]] = 1
            together[label] += held.T @ held
    clean, toxic = together
    alone = _difference(np.diag(toxic), np.diag(clean), labels)
    apart = _difference(toxic, clean, labels)
    tells = (apart >= min_z) & (apart >= np.maximum(alone[:, None], alone[None, :]) + beyond) & (toxic + clean >= least)
    np.fill_diagonal(tells, False)
    chosen[some[tells.any(axis=1)]] = True
    return chosen


def train(
    sets: list[np.ndarray], labels: np.ndarray, rank: int = 4, epochs: int = 16, batch: int = 64, rate: float = 0.1,
    decay: float = 4e-4, min_z: float = 2.8, seed: int = 3,
) -> FactorizationMachine:
    """Fit by Adagrad on the logistic loss, both classes weighing alike.

    Buckets are learned whose smoothed log odds between the classes differ from 0 by ``min_z`` standard errors, and those
    that tell the classes apart in pairs (``in_telling_pairs``): an insult and a group that are as common in clean texts as
    in toxic ones, but not together. The others, most of the vocabulary, could only be memorised. With one class only,
    the machine gives its constant.
    """
    rng = np.random.default_rng(seed)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known, inverse = np.unique(flat, return_inverse=True)
    counts = [np.bincount(inverse, labels[owner] == c, len(known)) for c in (1, 0)]
    toxic, clean = (n + 0.5 for n in counts)
    odds = np.log(toxic / (labels.sum() + 1 - toxic)) - np.log(clean / (len(labels) - labels.sum() + 1 - clean))
    alone = np.abs(odds) >= min_z * np.sqrt(1 / toxic + 1 / clean)
    known = known[alone | in_telling_pairs(sets, labels, known, counts[0] + counts[1])]
    positive = labels.mean()
    if positive in (0.0, 1.0) or not len(known):
        return FactorizationMachine(known[:0], float(20 * positive - 10), np.zeros(0), np.zeros((0, rank)))
    rows = []
    for s in sets:
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        rows.append(at[known[at] == s])
    importance = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive))
    bias, linear, factors = 0.0, np.zeros(len(known)), rng.normal(0, 0.05, (len(known), rank))
    seen_bias, seen_linear, seen_factors = 1e-6, np.full(len(known), 1e-6), np.full((len(known), rank), 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            at = np.concatenate([rows[i] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
            v = factors[at]
            sums = np.stack([np.bincount(owner, v[:, f], len(some)) for f in range(rank)], axis=1)
            squares = np.bincount(owner, (v * v).sum(axis=1), len(some))
            logit = bias + np.bincount(owner, linear[at], len(some)) + ((sums**2).sum(axis=1) - squares) / 2
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]) * importance[some]
            touched, inverse = np.unique(at, return_inverse=True)
            g_linear = np.bincount(inverse, error[owner], len(touched)) + decay * linear[touched]
            pull = error[owner, None] * (sums[owner] - v)
            g_factors = np.stack([np.bincount(inverse, pull[:, f], len(touched)) for f in range(rank)], axis=1) + decay * factors[touched]
            seen_linear[touched] += g_linear**2
            seen_factors[touched] += g_factors**2
            linear[touched] -= rate * g_linear / np.sqrt(seen_linear[touched])
            factors[touched] -= 0.2 * rate * g_factors / np.sqrt(seen_factors[touched])
            seen_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(seen_bias)
    return FactorizationMachine(known, float(bias), linear, factors)


def training_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int = 12000
) -> tuple[list[np.ndarray], np.ndarray]:
    """A bounded sample, brought to the driver as buckets: of each label (0 and 1) at most ``most`` // 2 labelled ids.

    Those with the smallest hash of their id, chosen before any text is read; as there are at most ``most`` of them they
    are broadcast to the scan of the texts. Each whole text is hashed in Spark's tasks.
    """
    drawn = labels.select(col(label_col).cast("int").alias("label"), col(id_col).alias("of")).filter("label IN (0, 1) AND of IS NOT NULL").distinct()
    chosen = smallest_draws(drawn.withColumn("draw", F.xxhash64(F.lit(3), "of")), "label", "draw", most // 2, "of")
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("content")).filter("content IS NOT NULL")
    sample = texts.join(F.broadcast(chosen), F.col("id") == F.col("of"))

    @pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: terms(t).astype(np.int32))

    rows = sample.select("label", "draw", hashed("content").alias("buckets")).toPandas().sort_values(["draw", "label"], kind="stable")
    return [np.asarray(b, np.int64) for b in rows["buckets"]], rows["label"].to_numpy(float)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options
) -> FactorizationMachine | None:
    """Train on a bounded sample of the documents that ``labels`` (id, label) labels; None where there are none.

    Labels other than 0 and 1 and null ids are left out; an id with both labels counts with each; null texts are left out,
    empty and very long ones are sets of words like others. Repeated rows count each time. Columns beyond the named ones
    play no part, whatever their names.
    """
    sets, targets = training_texts(docs, labels, id_col, text_col, label_col)
    return train(sets, targets, **options) if sets else None


def scored(machine: FactorizationMachine | None, text: Column) -> Column:
    """Probability that a whole text is toxic; null and empty texts are the empty set. 0 when nothing was learned."""
    if machine is None:
        return F.lit(0.0)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(machine.scores([terms(t) for t in texts]), dtype="float64")

    return score(F.coalesce(text, F.lit("")))
