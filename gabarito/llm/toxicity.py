"""Toxicity scores by a factorization machine over hashed terms.

Besides a weight for each term the machine learns a short vector, and the product of two terms'
vectors is the weight of their meeting in one text: an insult beside the mention of a group says
more than both alone. The sum over all pairs is computed in linear time, and divided by the number
of terms, so that long texts do not drown in it.
"""

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField

from gabarito.llm.common import append_columns

TERMS = 1 << 20  # size of the hash space
BEGINNINGS = (4, 5, 6)
# A term takes part if this many rows of the sample have it, whatever their labels.
LEAST_ROWS = 3
# A term that alone tells the labels apart by this chi-square has a weight of its own; all have factors.
LEAST_CHI2 = 6.0
FACTORS = 6
EPOCHS = 8
BATCH = 256
RATE = 0.2
DECAY = 1e-5
# Bound of the training sample: rows of each label.
ROWS_PER_LABEL = 5_000
THRESHOLD = 0.3
FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]

# Lower-cased bytes, with a blank for ASCII that is neither letter nor digit.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


class TermPlaces(dict):
    """Places in the hash space of a word and of its beginnings, remembered.

    Insults come in forms, so words that begin alike share terms. With `dense`, places are
    numbers of the terms a machine knows, and other terms are left out.
    """

    def __init__(self, dense: np.ndarray | None = None):
        self.dense = dense

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 300_000:
            self.clear()
        text = word.decode(errors="replace")
        terms = {b"=" + word, *(text[:n].encode() for n in BEGINNINGS if len(text) > n)}
        places = {zlib.crc32(t) % TERMS for t in terms}
        if self.dense is not None:
            places = {p for p in self.dense[list(places)].tolist() if p >= 0}
        found = self[word] = tuple(places)
        return found


def features(texts: list[str | None], places: TermPlaces) -> list[np.ndarray]:
    """Distinct term places of every whole text."""
    out = []
    for text in texts:
        found: set[int] = set()
        for one in map(places.__getitem__, set((text or "").encode().translate(NORMAL).split())):
            found.update(one)
        out.append(np.fromiter(found, np.int64, len(found)))
    return out


def ragged(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All places end to end, and the row of each."""
    sizes = [len(r) for r in rows]
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return flat, np.repeat(np.arange(len(rows)), sizes)


@dataclass
class FactorizationMachine:
    bias: float
    dense: np.ndarray  # number of a place's term, or -1
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, flat: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of `n` rows, the sums of their terms' factors, and the weight of a pair in each."""
        sums = np.zeros((n, self.factors.shape[1]))
        squares, linear, share = np.zeros(n), np.zeros(n), np.ones(n)
        if len(flat):
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows, chosen = owner[begin], self.factors[flat]
            share[rows] = 1 / np.diff(np.r_[begin, len(flat)])
            sums[rows] = np.add.reduceat(chosen, begin, axis=0)
            squares[rows] = np.add.reduceat((chosen * chosen).sum(axis=1), begin)
            linear[rows] = np.add.reduceat(self.weights[flat], begin)
        return self.bias + linear + 0.5 * share * ((sums * sums).sum(axis=1) - squares), sums, share

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities from rows of term numbers."""
        return sigmoid(self.raw(*ragged(rows), len(rows))[0])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tell_apart(flat: np.ndarray, owner: np.ndarray, labels: np.ndarray, weights: np.ndarray, terms: int) -> np.ndarray:
    """Which terms tell the labels apart by themselves."""
    seen = np.bincount(flat, weights[owner], terms)
    ones = np.bincount(flat, (weights * labels)[owner], terms)
    share = (weights * labels).sum() / weights.sum()
    expected = seen * share
    spread = np.maximum(expected * (1 - share) * (1 - seen / weights.sum()), 1e-9)
    return (ones - expected) ** 2 / spread >= LEAST_CHI2


def train(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS) -> FactorizationMachine:
    """Adagrad on weighted log loss over all terms that enough rows have.

    Terms are chosen without regard to the labels, as two of them may matter only together: every
    term has factors. A weight of its own has a term that tells the labels apart by itself.
    """
    rng = np.random.default_rng(5)
    known = np.flatnonzero(np.bincount(ragged(rows)[0], minlength=TERMS) >= LEAST_ROWS)
    dense = np.full(TERMS, -1, np.int32)
    dense[known] = np.arange(len(known))
    rows = [d[d >= 0] for d in (dense[r] for r in rows)]
    share = min(max((weights * labels).sum() / weights.sum(), 1e-3), 1 - 1e-3)
    fm = FactorizationMachine(
        float(np.log(share / (1 - share))), dense, np.zeros(len(known)), rng.normal(scale=0.1, size=(len(known), FACTORS))
    )
    own = tell_apart(*ragged(rows), labels, weights, len(known)).astype(float)
    weight_steps, factor_steps = np.full(len(known), 1e-3), np.full((len(known), FACTORS), 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            flat, owner = ragged([rows[k] for k in chosen])
            raw, sums, pair = fm.raw(flat, owner, len(chosen))
            wrong = (sigmoid(raw) - labels[chosen]) * weights[chosen] / np.sqrt(len(chosen))
            fm.bias -= RATE * 0.1 * float(wrong.mean())
            touched, at = np.unique(flat, return_inverse=True)
            weight_grad = np.bincount(at, wrong[owner], len(touched)) + DECAY * fm.weights[touched]
            one = (wrong * pair)[owner, None] * (sums[owner] - fm.factors[flat])
            columns = [np.bincount(at, one[:, k], len(touched)) for k in range(FACTORS)]
            factor_grad = np.stack(columns, axis=1) + DECAY * fm.factors[touched]
            weight_steps[touched] += weight_grad**2
            factor_steps[touched] += factor_grad**2
            fm.weights[touched] -= RATE * own[touched] * weight_grad / np.sqrt(weight_steps[touched])
            fm.factors[touched] -= RATE * factor_grad / np.sqrt(factor_steps[touched])
    return fm


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
) -> FactorizationMachine | None:
    """A machine learned from at most `rows_per_label` labelled rows of either label.

    Rows are drawn by a hash of their id, and weighted so that both labels count as often as
    among all labelled rows. A drawn row is learned from as a whole: its distinct term places are
    found in the tasks, and only they are collected. Where an id repeats, its rows follow the
    hash of their text, and the bound holds for rows. Null labels, ids and texts are left out;
    without rows of both labels there is no machine. The drawn ids, bounded by the parameter, are
    broadcast; texts are not shuffled.
    """
    rows = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).dropna()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    place = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30))
    drawn = None
    for label, n in sorted(counts.items()):
        near = int(min(1.0, 1.5 * rows_per_label / n) * (1 << 30))
        own = rows.where((F.col("label") == label) & (place < near)).orderBy(place, "id").limit(rows_per_label)
        drawn = own if drawn is None else drawn.unionByName(own)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    joined = texts.join(F.broadcast(drawn), "id").select("label", place.alias("place"), F.xxhash64("text").alias("hash"), "text")
    found = append_columns(joined, "text", [StructField("terms", ArrayType(IntegerType()))], sampled_terms, keep_text=False)
    sample = []
    for label in sorted(counts):
        own = found.where(F.col("label") == label).orderBy("place", "hash").limit(rows_per_label)
        sample += [(r["label"], np.array(r["terms"], np.int32)) for r in own.collect()]
    is_one = np.array([label for label, _ in sample], float)
    if len(set(is_one.tolist())) < 2:
        return None
    weight = np.array([counts[label] for label, _ in sample]) / np.where(is_one > 0, is_one.sum(), (1 - is_one).sum())
    return train([terms for _, terms in sample], is_one, weight / weight.mean())


def sampled_terms() -> Callable[[list], list]:
    places = TermPlaces()
    return lambda texts: [[np.sort(f).tolist() for f in features(texts, places)]]


def score_toxicity(
    df: DataFrame, machine: FactorizationMachine | None, text_col: str = "text", threshold: float = THRESHOLD, keep_text: bool = True
) -> DataFrame:
    """`df` with the `score` (0 to 1) of every whole text, and `predicted` 1 from `threshold` on.

    Null, empty and wordless texts get the score of a text without known terms; so does any
    text when there is no machine, with score 0. Equal texts get equal scores, repeated rows
    stay, and columns named like a result give way. An empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def start() -> Callable[[list], list]:
        fm = shared.value
        places = TermPlaces(fm.dense if fm else None)

        def compute(texts: list) -> list:
            scores = fm.scores(features(texts, places)) if fm else np.zeros(len(texts))
            return [scores.tolist(), (scores >= threshold).astype(int).tolist()]

        return compute

    return append_columns(df, text_col, FIELDS, start, keep_text)
