"""Language identification by a byte convolutional network.

Texts are cut into fixed-length windows of UTF-8 bytes. Filters of several widths run over a window (a filter of width
w is w tables of one row per byte value), each takes its maximum over all positions, and a softmax layer maps the
maxima to languages. Trained in numpy on the driver, on a bounded sample of windows of labelled texts; applied to every
window of every whole text inside Spark's tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from metricmart.llm.common import col, smallest_draws

HAS_LETTER = r"\p{L}"
UNDETERMINED = "und"


@dataclass
class ByteCnn:
    """Weights. ``tables[w]``: (width, 256, filters); ``dense``: (filters of all widths, languages)."""

    languages: list[str]
    window: int
    tables: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows, bytes) → maxima of each filter, and the positions they come from."""
        tops, places = [], []
        for table in self.tables:
            width = len(table)
            reach = windows.shape[1] - width + 1
            scores = table[0][windows[:, :reach]]
            for k in range(1, width):
                scores += table[k][windows[:, k : k + reach]]
            place = scores.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(scores, place[:, None, :], axis=1)[:, 0, :])
        return np.concatenate(tops, axis=1) + self.bias, np.concatenate(places, axis=1)

    def maxima(self, windows: np.ndarray) -> np.ndarray:
        """Maxima only, with neighbouring bytes looked up in pairs: half the lookups."""
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        tops = []
        for table, paired in zip(self.tables, self._paired()):
            width = len(table)
            reach = windows.shape[1] - width + 1
            scores = None
            for k in range(0, width, 2):
                part = paired[k // 2].take(pairs[:, k : k + reach], axis=0) if k + 1 < width else table[k].take(windows[:, k : k + reach], axis=0)
                scores = part if scores is None else np.add(scores, part, out=scores)
            tops.append(scores.max(axis=1))
        return np.concatenate(tops, axis=1) + self.bias

    def _paired(self) -> list[list[np.ndarray]]:
        if not hasattr(self, "_pairs"):
            self._pairs = [
                [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(t) - 1, 2)] for t in self.tables
            ]
        return self._pairs

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pairs"}

    def probabilities(self, tops: np.ndarray) -> np.ndarray:
        logits = np.maximum(tops, 0) @ self.dense + self.offset
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)


def cut(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts → zero-padded windows, the text each belongs to, and its number of bytes."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-lengths // window)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.concatenate(([0], np.cumsum(counts)))
    flat = np.zeros(int(first[-1]) * window, dtype=np.uint8)
    for text, start in zip(texts, first):
        flat[start * window : start * window + len(text)] = np.frombuffer(text, dtype=np.uint8)
    place = np.arange(len(owner)) - first[owner]
    return flat.reshape(-1, window), owner, np.minimum(lengths[owner] - place * window, window)


def train(
    samples: list[tuple[bytes, str]], window: int = 192, widths: tuple[int, ...] = (2, 3, 4), filters: int = 16,
    epochs: int = 12, batch: int = 128, rate: float = 0.004, seed: int = 5,
) -> ByteCnn:
    """Fit by Adam on labelled pieces of text (at least one), each cut to one window.

    Gradients reach a filter's tables only at the position of its maximum, so one step touches few rows.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in samples})
    label = {lang: i for i, lang in enumerate(languages)}
    x = np.zeros((len(samples), window), dtype=np.uint8)
    for i, (text, _) in enumerate(samples):
        piece = text[:window]
        x[i, : len(piece)] = np.frombuffer(piece, dtype=np.uint8)
    y = np.array([label[lang] for _, lang in samples])
    total = filters * len(widths)
    net = ByteCnn(
        languages, window, [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in widths],
        np.zeros(total, np.float32), rng.normal(0, 0.3, (total, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32),
    )
    weights = [*net.tables, net.bias, net.dense, net.offset]
    means, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            tops, places = net.features(x[some])
            p = net.probabilities(tops)
            p[np.arange(len(some)), y[some]] -= 1
            error = (p / len(some)).astype(np.float32)
            hidden = np.maximum(tops, 0)
            back = (error @ net.dense.T) * (tops > 0)
            gradients = [np.zeros_like(t) for t in net.tables]
            for n, w in enumerate(widths):
                part, place = back[:, n * filters : (n + 1) * filters], places[:, n * filters : (n + 1) * filters]
                for k in range(w):
                    np.add.at(gradients[n][k], (x[some][np.arange(len(some))[:, None], place + k], np.arange(filters)[None, :]), part)
            gradients += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for weight, gradient, mean, square in zip(weights, gradients, means, squares):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient * gradient - square)
                weight -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


def training_windows(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str, window: int = 192, pieces: int = 3, most: int = 9000
) -> list[tuple[bytes, str]]:
    """A bounded sample of labelled windows, brought to the driver: at most ``most`` pieces of at most ``window`` characters.

    Of each language the same number of texts, those with the smallest hash of their id; of each text up to ``pieces``
    windows at hashed places, every third one cut short so that short texts are learned too.
    """
    usable = labelled.filter(col(lang_col).isNotNull() & col(text_col).rlike(HAS_LETTER))
    count = usable.select(col(lang_col)).distinct().count()
    if not count:
        return []
    size = F.greatest(F.char_length(col(text_col)) - window, F.lit(0)) + 1
    spots = [
        F.substring(
            col(text_col), (F.pmod(F.xxhash64(F.lit(k), col(id_col)), size) + 1).cast("int"),
            F.lit(window) if k % 3 < 2 else (F.pmod(F.xxhash64(F.lit(-k), col(id_col)), F.lit(window // 3)) + 6).cast("int"),
        )
        for k in range(pieces)
    ]
    drawn = usable.select(col(lang_col).alias("lang"), F.xxhash64(F.lit(3), col(id_col)).alias("draw"), F.array(*spots).alias("pieces"))
    rows = (
        smallest_draws(drawn, "lang", "draw", max(1, most // (pieces * count)), "pieces")
        .select("lang", F.explode(F.array_distinct("pieces")).alias("piece"))
        .filter(F.col("piece").rlike(HAS_LETTER))
        .orderBy("lang", "piece")
        .collect()
    )
    return [(r["piece"].encode(), r["lang"]) for r in rows]


def predicted(net: ByteCnn | None, text: Column, chunk: int = 256) -> Column:
    """Struct (lang_pred, score) of a whole text.

    The softmax of all windows, averaged by their bytes; ``score`` is that of the chosen language. Texts that are null or
    have no letter are ``und`` with score 0, as is everything when nothing was learned. Ties go to the first language.
    """
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return nothing

    @pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = [t or b"" for t in series]
            sums = np.zeros((len(texts), len(net.languages)))
            some: list[int] = []
            held = 0

            def flush() -> None:
                windows, owner, sizes = cut([texts[i] for i in some], net.window)
                for start in range(0, len(windows), chunk):
                    p = net.probabilities(net.maxima(windows[start : start + chunk]))
                    np.add.at(sums, np.array(some)[owner[start : start + chunk]], p * sizes[start : start + chunk, None])

            for i, text in enumerate(texts):
                some.append(i)
                held += len(text)
                if held > 1 << 20:
                    flush()
                    some, held = [], 0
            if some:
                flush()
            share = sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)
            best = share.argmax(axis=1)
            yield pd.DataFrame({"lang_pred": [net.languages[b] for b in best], "score": np.minimum(share[np.arange(len(best)), best], 1.0)})

    readable = F.coalesce(text.rlike(HAS_LETTER), F.lit(False))
    guess = classify(F.when(readable, text.cast("binary")))
    return F.when(readable, guess).otherwise(nothing)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> ByteCnn | None:
    """Train on a bounded sample of ``labelled``; None where no row has a language and a letter."""
    samples = training_windows(labelled, id_col, text_col, lang_col)
    return train(samples, **options) if samples else None


def keep_identified(docs: DataFrame, net: ByteCnn | None, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """``docs`` without the texts whose language cannot be told: ``und``, or a score below ``min_score``.

    Columns stay as they are. With no network (nothing to learn from) every row stays.
    """
    if net is None:
        return docs
    guess = predicted(net, col(text_col))
    return docs.filter((guess["lang_pred"] != UNDETERMINED) & (guess["score"] >= min_score))
