"""Language identification by a byte convolutional network, trained in numpy on labelled text.

A window of bytes is embedded, convolved with filters of several widths, pooled by maximum and
classified by softmax. A text is cut into windows of one length that together cover all of it;
its score of a language is the mean over its windows, weighted by their bytes.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from gabarito.llm.common import append_columns
from gabarito.staging import pinned

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# Bounds of the training sample: distinct texts of a language, and languages (the most frequent).
ROWS_PER_LANGUAGE = 200
LANGUAGES = 1_000
EPOCHS = 5
BATCH = 64
RATE = 0.01
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")  # and some numbers, which `has_letter` leaves out
BLOCK = 64  # windows convolved at once
FIELDS = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]


def has_letter(text: str | None) -> bool:
    """Does the text hold a character of a Unicode letter category? Fractions and the like are none."""
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


@dataclass
class ByteNetwork:
    """`filters` holds every width as one matrix over the widest span; narrower ones end in zeros."""

    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING; byte 0, the padding, stays zero
    filters: np.ndarray  # (max width * EMBEDDING) x number of filters
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def spans(self, windows: np.ndarray) -> np.ndarray:
        """Embedded spans at every place of every window."""
        wide = max(WIDTHS)
        embedded = self.embedding[np.pad(windows, ((0, 0), (0, wide - 1)))].reshape(len(windows), -1)
        places = windows.shape[1]
        view = np.lib.stride_tricks.sliding_window_view(embedded, wide * EMBEDDING, axis=1)[:, ::EMBEDDING]
        return np.ascontiguousarray(view[:, :places])

    def pooled(self, windows: np.ndarray, spans: np.ndarray | None = None) -> np.ndarray:
        spans = self.spans(windows) if spans is None else spans
        return (spans @ self.filters).max(axis=1) + self.bias

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = np.maximum(pooled, 0) @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        if not len(windows):
            return np.zeros((0, len(self.languages)), np.float32)
        parts = [self.pooled(windows[i : i + BLOCK]) for i in range(0, len(windows), BLOCK)]
        return self.probabilities(np.concatenate(parts))


def cut(texts: list[bytes], overlap: int = max(WIDTHS) - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows covering all bytes (each filter span lies in one), the text of each, and its bytes."""
    step = WINDOW - overlap
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-(sizes - overlap) // step)) * (sizes > 0)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    offset = (np.arange(len(owner)) - first[owner]) * step
    filled = np.minimum(WINDOW, sizes[owner] - offset)
    buffer = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    begins = (np.cumsum(sizes) - sizes)[owner] + offset
    windows = np.lib.stride_tricks.sliding_window_view(buffer, WINDOW)[begins]
    windows[np.arange(WINDOW) >= filled[:, None]] = 0
    return windows, owner, filled


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> ByteNetwork:
    """Adam on cross entropy; the gradient of a maximum goes to the span that gave it."""
    rng = np.random.default_rng(7)
    wide, n = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide * EMBEDDING, n), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
    normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
    net = ByteNetwork(
        languages,
        normal(256, EMBEDDING) * 0.5,
        normal(wide * EMBEDDING, n) * mask / np.sqrt(wide * EMBEDDING),
        np.zeros(n, np.float32),
        normal(n, len(languages)) * 0.1,
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    names = ["embedding", "filters", "bias", "out", "out_bias"]
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            batch, step = windows[rows], step + 1
            spans = net.spans(batch)
            answers = spans @ net.filters
            at = answers.argmax(axis=1)
            pooled = np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            wrong = net.probabilities(pooled)
            wrong[np.arange(len(rows)), labels[rows]] -= 1
            wrong /= len(rows)
            back = (wrong @ net.out.T) * (pooled > 0)
            best = spans[np.arange(len(rows))[:, None], at]  # rows x filters x span
            grads = {
                "out": hidden.T @ wrong,
                "out_bias": wrong.sum(axis=0),
                "bias": back.sum(axis=0),
                "filters": np.einsum("rfs,rf->sf", best, back) * mask,
            }
            to_span = (back[:, :, None] * net.filters.T[None]).reshape(-1, EMBEDDING)
            places = at[:, :, None] + np.arange(wide)
            bytes_at = np.pad(batch, ((0, 0), (0, wide - 1)))[np.arange(len(rows))[:, None, None], places].reshape(-1)
            grads["embedding"] = np.zeros_like(net.embedding)
            np.add.at(grads["embedding"], bytes_at, to_span)
            grads["embedding"][0] = 0
            rate = RATE * (1 - epoch / epochs)
            for name, grad in grads.items():
                mean, square = moments[name]
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                value = getattr(net, name)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


def drawn_texts(rows: DataFrame, counts: dict[str, int], rows_per_language: int) -> DataFrame:
    """(label, h): the smallest text hashes of every label, each once however often its text occurs.

    Only hashes below a bound are looked at; where repeats leave too few, the bound is raised.
    """
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    factor = 4.0
    while True:
        bounds = {k: min(1.0, factor * rows_per_language / n) for k, n in counts.items()}
        bound = F.create_map(*[F.lit(x) for item in bounds.items() for x in item])
        near = rows.where(place < bound[F.col("label")]).select("label", "h", place.alias("place")).distinct()
        first = Window.partitionBy("label").orderBy("place", "h")
        drawn = pinned(near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= rows_per_language).drop("nth", "place"))
        found = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
        if all(bounds[k] == 1 or found.get(k, 0) >= rows_per_language for k in counts):
            return drawn
        factor *= 16


def train_on_sample(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    languages: int = LANGUAGES,
) -> ByteNetwork | None:
    """A network for the `languages` most frequent labels of `labelled`, from `rows_per_language` distinct texts of each.

    Texts are drawn by a hash, so the draw is the same for every partitioning, and a text that
    occurs very often is drawn like any other. A drawn text is learned from as a whole: its
    windows are cut in the tasks. Rows without letters or label are left out; with no row left
    there is no network. What reaches the driver is bounded by texts and languages.
    """
    text, label = F.col(text_col), F.col(label_col)
    rows = labelled.where(label.isNotNull() & (F.length(text) > 0)).select(
        text.alias("text"), label.cast("string").alias("label"), F.xxhash64(text, F.lit(11)).alias("h")
    )
    often = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(languages)
    counts = {r["label"]: r["count"] for r in often.collect()}
    if not counts:
        return None
    drawn = drawn_texts(rows, counts, rows_per_language)
    texts = rows.join(F.broadcast(drawn), ["label", "h"]).groupBy("label", "h").agg(F.any_value("text").alias("text"))

    def windows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["text"].map(has_letter)]
            windows, owner, _ = cut([t.encode() for t in batch["text"]])
            labels, hashes = batch["label"].to_numpy()[owner], batch["h"].to_numpy()[owner]
            yield pd.DataFrame({"label": labels, "h": hashes, "w": [w.tobytes() for w in windows]})

    found = texts.mapInPandas(windows_of, "label string, h long, w binary").orderBy("label", "h", "w").collect()
    if not found:
        return None
    known = sorted({r["label"] for r in found})
    windows = np.frombuffer(b"".join(r["w"] for r in found), np.uint8).reshape(len(found), WINDOW)
    return train(windows, np.array([known.index(r["label"]) for r in found]), known)


def identify_languages(df: DataFrame, net: ByteNetwork | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """`df` with `lang_pred` and its `score` (0 to 1), judged from the whole text.

    A text that is null, empty or without a letter is `und` with score 0, as is any text when
    there is no network. Equal texts get equal results, repeated rows stay, ties go to the
    first language by name, and columns named like a result give way.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)

    def start() -> Callable[[list], list]:
        model = shared.value

        def compute(texts: list) -> list:
            judged = [i for i, t in enumerate(texts) if model and has_letter(t)]
            predicted, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if judged:
                windows, owner, filled = cut([texts[i].encode() for i in judged])
                weighed = model.predict(windows).astype(np.float64) * filled[:, None]
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                share = np.add.reduceat(weighed, first) / np.add.reduceat(filled, first)[:, None]
                best = share.argmax(axis=1)
                for row, k, value in zip(judged, best, share[np.arange(len(best)), best]):
                    predicted[row], scores[row] = model.languages[k], min(1.0, float(value))
            return [predicted, scores]

        return compute

    return append_columns(df, text_col, FIELDS, start, keep_text)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % folds
