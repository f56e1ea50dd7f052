"""Language and toxicity models: held-out accuracy, and every kind of row."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gabarito.llm import language_id, toxicity
from gabarito.llm.language_id import EMBEDDING, WIDTHS, cut, drawn_texts, has_letter, identify_languages, train_on_sample
from gabarito.llm.queries import QUERIES
from gabarito.llm.toxicity import TermPlaces, features, learn_toxicity, score_toxicity, train

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language"](spark, DATA).join(docs, "doc_id").where("held_out")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.95
    assert found.where("score < 0 OR score > 1").count() == 0


def test_toxicity_held_out(spark):
    """Insults of the held-out documents are found, and clean ones are left alone."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op3_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_a_pair_counts_beyond_its_terms():
    """Two words that only matter together: no sum of weights tells these rows apart."""
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(f"{'rotten' * insult} {'foreign' * group}")
        labels.append(float(insult != group))
    machine = train([r.astype(np.int32) for r in features(texts, TermPlaces())], np.array(labels), np.ones(len(labels)), epochs=60)
    scores = machine.scores(features(texts, TermPlaces(machine.dense)))
    assert ((scores > 0.5) == (np.array(labels) > 0)).all()


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(8)
    rows = [rng.choice(40, size=k, replace=False).astype(np.int32) for k in (0, 1, 2, 7, 25) * 8]
    machine = train(rows, (np.arange(40) % 3 == 0).astype(float), np.ones(40), epochs=2)
    known = [d[d >= 0] for d in (machine.dense[r] for r in rows)]
    for terms, score in zip(known, machine.scores(known)):
        raw = machine.bias + sum(machine.weights[t] for t in terms)
        for i, a in enumerate(terms):
            for b in terms[i + 1 :]:
                raw += float(machine.factors[a] @ machine.factors[b]) / len(terms)
        assert abs(score - 1 / (1 + np.exp(-np.clip(raw, -30, 30)))) < 1e-9


def test_toxic_passage_late_in_a_text_and_a_hot_id(docs_of, spark):
    long = " ".join(f"calm{i % 50}" for i in range(8000))
    docs = docs_of([(i, f"{long} vile scoundrel" if i % 2 else long) for i in range(24)] + [(1, f"copy {k}") for k in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    machine = learn_toxicity(docs.where("text LIKE 'calm%'"), labels)
    late, calm = (r["score"] for r in score_toxicity(docs_of([(1, f"{long} vile scoundrel"), (2, long)]), machine).orderBy("doc_id").collect())
    assert late > 0.5 > calm
    # A repeated id brings no more rows than the bound allows.
    seen = []
    original = toxicity.train
    toxicity.train = lambda rows, labels, weights: seen.append(len(rows)) or original(rows, labels, weights)
    try:
        assert learn_toxicity(docs, labels, rows_per_label=10) is not None
    finally:
        toxicity.train = original
    assert seen[0] <= 20


TEXTS = [None, "", " ", "123 !?", "the cat and the dog are in the house", "the cat and the dog are in the house", "日本語", "la casa y el perro " * 20_000]


@pytest.fixture(scope="module")
def net(spark):
    rows = [(i, "the cat and the dog are in the house", "en") for i in range(40)] + [(i, "la casa y el perro con la mesa", "es") for i in range(40)]
    df = spark.createDataFrame([(i, f"{t} {i}", k) for i, t, k in rows] + [(0, None, "en"), (0, "x", None)], "doc_id long, text string, lang string")
    return train_on_sample(df)


def test_language_of_every_kind_of_text(docs_of, net):
    df = docs_of(list(enumerate(TEXTS))).withColumns({"SCORE": F.lit(7)})
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_languages(df, net).collect()}
    assert [rows[i] for i in range(4)] == [("und", 0.0)] * 4
    assert rows[4] == rows[5] and rows[4][0] == "en" and rows[7][0] == "es" and rows[6][0] in ("en", "es")
    assert identify_languages(docs_of([]), net).count() == 0
    assert {r["lang_pred"] for r in identify_languages(docs_of([(1, "the cat")]), None).collect()} == {"und"}


def test_no_labels_no_network(docs_of, spark):
    assert train_on_sample(docs_of([(1, "x")]).withColumn("lang", F.lit(None).cast("string"))) is None
    assert train_on_sample(docs_of([])) is None


def test_a_frequent_text_is_drawn_once(spark):
    rows = [(f"the cat number {i} is in the house", "en") for i in range(300)] + [("the same dog again and again", "en")] * 20_000
    rows += [(f"la casa numero {i} del perro", "es") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, label string").withColumn("h", F.xxhash64("text"))
    drawn = drawn_texts(df, {"en": 20_300, "es": 300}, 50).collect()
    assert len(drawn) == len(set(drawn)) == 100
    for label in ("en", "es"):
        smallest = sorted((r["h"] % (1 << 30), r["h"]) for r in df.where(F.col("label") == label).select("h").distinct().collect())[:50]
        assert {r["h"] for r in drawn if r["label"] == label} == {h for _, h in smallest}


def test_whole_training_texts_are_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda windows, labels, names: seen.append((windows, labels, names)))
    long = "é" * 5000 + " fin"
    train_on_sample(spark.createDataFrame([(long, "fr"), ("½ ² ①", "xx"), ("abc", "en"), ("abc", "en")], "text string, lang string"))
    ((windows, labels, names),) = seen
    assert names == ["en", "fr"] and (labels == 0).sum() == 1
    whole, _, _ = cut([long.encode()])
    assert sorted(w.tobytes() for w in windows[labels == 1]) == sorted(w.tobytes() for w in whole)


def test_letters():
    assert not any(map(has_letter, [None, "", "½ ² ① 12 _ !", "٣"])) and all(map(has_letter, ["½ a", "ª", "日", "٣ب", "é"]))


def test_network_equals_plain_sums(net):
    """Forward pass by loops: embed, filter, take the maximum, then softmax."""
    windows, _, _ = cut([b"the cat sat", bytes(range(1, 256)) * 2, b"x"])
    for window, got in zip(windows, net.predict(windows)):
        padded = list(window) + [0] * (max(WIDTHS) - 1)
        pooled = []
        for f in range(net.filters.shape[1]):
            values = [
                sum(float(net.embedding[padded[i + j]] @ net.filters[j * EMBEDDING : (j + 1) * EMBEDDING, f]) for j in range(max(WIDTHS)))
                for i in range(len(window))
            ]
            pooled.append(max(0.0, max(values) + net.bias[f]))
        scores = np.array([sum(p * net.out[f, k] for f, p in enumerate(pooled)) + net.out_bias[k] for k in range(len(net.languages))])
        want = np.exp(scores - scores.max())
        assert np.abs(got - want / want.sum()).max() < 1e-4


def test_windows_cover_every_span():
    texts = [b"", b"a", bytes(range(1, 256)) * 5, b"x" * 256, b"y" * 257]
    windows, owner, filled = cut(texts)
    for k, text in enumerate(texts):
        own = [bytes(w[:f]) for w, o, f in zip(windows, owner, filled) if o == k]
        spans = {text[i : i + 4] for i in range(max(0, len(text) - 3))}
        assert spans <= {w[i : i + 4] for w in own for i in range(len(w))}
        assert all(w[f:].sum() == 0 for w, f in zip(windows, filled))


def test_toxicity_of_every_kind_of_row(docs_of, spark):
    docs = docs_of([(i, "vile scoundrel talk" if i % 2 else "kind words only") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (1, None), (999, 1)], "doc_id long, toxic int")
    machine = learn_toxicity(docs, labels)
    rows = {r["doc_id"]: (r["score"], r["predicted"]) for r in score_toxicity(docs_of(list(enumerate(TEXTS))), machine).collect()}
    assert rows[0] == rows[1] == rows[2] and rows[4] == rows[5] and 0 <= rows[0][0] <= 1
    again = score_toxicity(docs_of([(1, "such vile scoundrel talk"), (2, "kind words only")]).withColumns({"Predicted": F.lit(5)}), machine)
    vile, kind = (r["score"] for r in again.orderBy("doc_id").collect())
    assert vile > 0.5 > kind
    assert learn_toxicity(docs, labels.where("toxic = 1")) is None
    assert {r["score"] for r in score_toxicity(docs, None).collect()} == {0.0}
    assert score_toxicity(docs_of([]), machine).count() == 0
