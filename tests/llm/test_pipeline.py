"""Each stage of the pipeline against plain Python, and the whole of it."""

import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from gabarito.llm import jaccard_join
from gabarito.llm.queries import PIECES

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCKS", 8)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    window = " ".join(f"bench{i}" for i in range(13))
    spark.createDataFrame([(1, window)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    text = lambda k: f"the house and the garden number {k} lie in the quiet part of the old town near river {k}"
    rows = [(i, text(i), "en", f"s{i % 5}", len(text(i))) for i in range(40)]
    rows += [(100 + i, text(i), "en", "s0", len(text(i))) for i in range(10)]
    rows += [(200, f"{text(200)} {window}", "en", "s1", 1), (201, f"{text(201)} token=abcdef0123 tail", "en", "s1", 2)]
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (302, "12 34 !", "en", "s1", 7)]
    rows += [(5, text(5), "en", "s0", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    kept = STAGES["language"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted([*range(40), 5, *range(100, 110), 200, 201])
    single = STAGES["distinct_documents"](spark, docs, folder)
    assert single.columns == docs.columns and ids(single) == [*range(40), 200, 201, 300, 301, 302]
    clean = STAGES["decontaminated"](spark, single, folder)
    assert clean.columns == docs.columns and 200 not in ids(clean) and len(ids(clean)) == single.count() - 1
    safe = STAGES["without_secrets"](spark, clean, folder)
    assert safe.columns == docs.columns and ids(safe) == ids(clean)
    row = safe.where("doc_id = 201").first()
    assert row["text"].endswith(" [SECRET] tail") and row["n_chars"] == len(row["text"])
    assert safe.join(clean, ["doc_id", "text", "n_chars"]).count() == clean.where("text IS NOT NULL").count() - 1
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in STAGES["encoded"](spark, safe, folder).join(safe.select("doc_id", "text"), "doc_id").collect():
        assert r["ids"] == library.encode(r["text"] or "") and r["n_tokens"] == len(r["ids"])


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark, folder, docs_of):
    """A near copy under a doc_id takes no other text of that id with it."""
    text = lambda k: f"{k} tells a long and quite different story about {k} in the town of {k} beside the river {k}"
    rows = [(1, text("a")), (7, text("a")), (7, text("b")), (7, text("c")), (9, text("c")), (7, text("c")), (7, text("d").upper()), (7, text("d"))]
    rows += [(None, text("a")), (None, text("a")), (7, None), (7, None), (7, "")]
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in STAGES["distinct_documents"](spark, docs_of(rows), folder).collect()]
    want = [(1, text("a")), (7, text("b")), (7, text("c")), (7, text("d")), (None, text("a")), (None, text("a")), (7, ""), (7, "")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_of_rows_equal_in_id_and_text_the_first_by_json_stays(spark, folder):
    text = "a long enough text about the quiet house and the garden by the river"
    rows = [(1, text, lang, source, n) for lang, source, n in (("fr", "b", 2), ("en", "z", 9), ("en", "a", 9), (None, "a", 1))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(4)
        (kept,) = STAGES["distinct_documents"](spark, df, folder).collect()
        assert tuple(kept) == (1, text, "en", "a", 9)


def test_whole_run(spark, folder):
    done = corpus_pipeline.run(spark, folder)
    assert sorted(r["doc_id"] for r in done.collect()) == [*range(40), 201]


def test_clashing_columns_come_back(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 3 OR doc_id >= 200")
    extra = {"score": F.lit(5), "SPANS": F.lit("s"), "items": F.lit(1), "n_words": F.lit(2), "lang_pred": F.lit("x"), "id": F.lit(3), "class": F.lit(4), "_row": F.lit(6)}
    docs = docs.withColumns(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert [c for c in extra if c not in docs.columns] == [], name
        assert docs.where("score = 5 AND SPANS = 's' AND items = 1 AND n_words = 2").count() == docs.count() > 0
    assert STAGES["encoded"](spark, docs, folder).count() == docs.count()


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    assert STAGES[name](spark, docs, folder).count() == 0


def test_pipeline_on_test_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    done = corpus_pipeline.run(spark, sf)
    assert 0.5 * docs.count() < done.count() <= docs.count()
    decoded = sentencepiece.SentencePieceProcessor(model_file=PIECES).decode([r["ids"] for r in done.collect()])
    assert not [t for t in decoded if re.search(r"(?i)token\s*=\s*.?[0-9a-f]{24}", t)]
