"""Keyed replacement, and the board's arithmetic on published numbers."""

import pytest
from pyspark.sql import functions as F

from gabarito.operators import board as B
from gabarito.operators import upsert as U
from gabarito.plans.leaderboard import store_board
from gabarito.registry import AREAS, BOARD, DESCRIPTIONS
from gabarito.schemas import EVAL
from gabarito.staging import small_join

ANSWER = "model_name string, benchmark string, item long, model_answer string"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def old(spark):
    rows = [(m, b, i, "old") for m in ("a", "b") for b in ("x", "y") for i in range(4)]
    return spark.createDataFrame(rows, ANSWER)


@pytest.fixture
def new(spark):
    return spark.createDataFrame([("b", "x", i, "new") for i in range(2)], ANSWER)


def test_upsert_by_pair_and_by_model(old, new):
    by_pair = U.upsert(old, new)
    assert by_pair.count() == 12 + 2
    assert by_pair.where("model_name = 'b' and benchmark = 'x'").select("model_answer").distinct().count() == 1
    by_model = U.upsert(old, new, ["model_name"])
    assert by_model.count() == 8 + 2
    assert U.upsert(None, new).count() == 2


def test_upsert_is_idempotent(old, new):
    once = U.upsert(old, new)
    assert rows_of(U.upsert(once, new)) == rows_of(once)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_gives_the_same_rows(spark, how):
    fact = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([(0, "zero"), (1, "one")], "k long, name string")
    wide = small_join(fact, dim, ["k"], how, spread=F.col("v"))
    salted = small_join(fact, dim, ["k"], how, spread=F.col("v"), limit=0, salts=5)
    plain = small_join(fact, dim, ["k"], how, limit=0)
    assert rows_of(wide) == rows_of(salted) == rows_of(plain)


def test_board_upsert(spark):
    board = "model_name string, score double, seq int"
    old = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 1)], board)
    new = spark.createDataFrame([("b", 9.0, 1), ("c", 5.0, 1)], board)
    assert rows_of(U.upsert_board(old, new, sequence="seq")) == [("a", 2.0, 2), ("b", 9.0, 1), ("c", 5.0, 1)]
    assert U.upsert_board(old, new, overwrite=False).count() == 5
    names = spark.createDataFrame([("a",), ("z",)], "model_name string")
    assert rows_of(U.skip_existing(names, old)) == [("z",)]


# Published scores of three models on nine benchmarks, with their area means and overall mean.
GOLDEN_BENCHMARKS = ["hatebr", "portuguese_hate_speech", "tweetsentbr", "oab", "assin2rte", "assin2sts", "faquad", "bluex", "enem"]
GOLDEN = {
    "first": [0.7191011235955056, 0.7337278106508875, 0.17313432835820897, 0.39110105580693816, 0.9210526315789473, 0.6875375767652322, 0.967391304347826, 0.44182825484764543, 0.5463221601489758],
    "second": [0.7756723716381418, 0.7451737451737451, 0.45925780483015904, 0.38642533936651585, 0.919181946403385, 0.6657106041811822, 0.8447814451382694, 0.4519852262234534, 0.5442271880819367],
    "third": [0.8293499043977055, 0.7713725490196078, 0.7086235489220564, 0.5187028657616893, 0.9235590679929145, 0.7265789821407711, 0.8917393535146229, 0.6569713758079408, 0.7506983240223464],
}
GOLDEN_MEANS = {
    "first": (0.541987754201534, 0.8586605042306686, 0.49407520749831063, 0.39110105580693816, 0.6201329162333519),
    "second": (0.6600346405473486, 0.8098913319076123, 0.49810620715269505, 0.38642533936651585, 0.6436017412263099),
    "third": (0.7697820007797899, 0.8472924678827695, 0.7038348499151437, 0.5187028657616893, 0.7530662190644061),
}
MEAN_COLUMNS = ["Discurso de Ódio", "Semântica e Inferência", "Multidisciplinar", "Área do Direito", "Média Geral"]


@pytest.fixture
def golden(spark):
    rows = []
    for model, scores in GOLDEN.items():
        for bench, value in zip(GOLDEN_BENCHMARKS, scores):
            continuous = bench == "assin2sts"
            rows.append((model, bench, None if continuous else value, None, None, None, value if continuous else None, 0.0, 0.0))
    return spark.createDataFrame(rows, EVAL)


def test_published_means(golden):
    wide = {r.model_name: r for r in B.board_scores(B.bench_scores(golden)).collect()}
    for model, means in GOLDEN_MEANS.items():
        assert [wide[model][c] for c in MEAN_COLUMNS] == pytest.approx(means, abs=1e-12)
        assert wide[model]["HateBR"] == GOLDEN[model][0]
        assert wide[model]["POSCOMP"] == 0.0 and wide[model]["Computação"] == 0.0
    long = {r.model_name: r.overall_mean for r in B.overall_means(B.bench_scores(golden)).collect()}
    assert long == pytest.approx({m: v[-1] for m, v in GOLDEN_MEANS.items()}, abs=1e-12)


def test_missing_benchmark_counts_as_zero_when_anyone_ran_it(golden):
    partial = golden.where("not (model_name = 'first' and benchmark = 'oab')")
    wide = {r.model_name: r for r in B.board_scores(B.bench_scores(partial)).collect()}
    assert wide["first"]["OAB"] == 0.0
    want = sum(v for b, v in zip(GOLDEN_BENCHMARKS, GOLDEN["first"]) if b != "oab") / 9
    assert wide["first"]["Média Geral"] == pytest.approx(want)


def test_zero_for_everyone_does_not_exist(spark):
    rows = [("m", "oab", 0.0), ("m", "enem", 0.5), ("m", "mmlu_en", 0.9)]
    df = spark.createDataFrame([(m, b, v, None, None, None, None, 0.0, 0.0) for m, b, v in rows], EVAL)
    scores = B.bench_scores(df)
    exists = {r.benchmark: r.has_scores for r in B.benchmark_exists(scores).collect()}
    assert len(exists) == len(BOARD) and [b for b, e in exists.items() if e] == ["enem"]
    assert B.board_scores(scores).first()["Média Geral"] == 0.5
    assert [r.benchmark for r in B.unmapped_benchmarks(df).collect()] == ["mmlu_en"]


def test_score_averages_declared_metrics(spark):
    df = spark.createDataFrame(
        [("m", "two", 0.5, None, None, 1.0, None, 0.0, 0.0), ("m", "none", None, None, None, None, 0.7, 0.0, 0.0)], EVAL
    )
    dim = spark.createDataFrame(
        [("two", "A", "Two", ["accuracy", "f1_score", "pearson_correlation"])],
        "benchmark string, area string, column string, metrics array<string>",
    )
    got = {r.benchmark: r.score for r in B.bench_scores(df, dim).collect()}
    assert got == {"two": 0.75, "none": 0.0}


def test_pivots(golden):
    pivot = {r.Model: r for r in B.metric_pivot(golden, GOLDEN_BENCHMARKS).collect()}
    assert pivot["first"].assin2sts == 0.688 and pivot["first"].hatebr == 0.719
    cells = [round(v, 3) for v in GOLDEN["first"]]
    assert pivot["first"].avg == round(sum(cells) / 9, 3)
    assert set(B.parse_error_pivot(golden, ["oab"]).columns) == {"Model", "oab"}


def test_wide_board_layout(spark, golden):
    overrides = spark.createDataFrame(
        [("first", "org/first", "SFT", ["A", "B"]), ("second", None, None, None)],
        "model_name string, model_id string, t string, arquitetura array<string>",
    )
    fetched = spark.createDataFrame(
        [("org/first", "org/First", "abc", 3, False, None, ["X"], "BF16", 7615616512, ["org/base"], False)],
        "model_id string, hub_id string, sha string, likes long, private boolean, license string, "
        "architectures array<string>, precision string, params_total long, base_model array<string>, is_adapter boolean",
    )
    flags = B.custom_flags(spark, ["x/first", "x/second"], ["TRUE", "false"])
    models = golden.select("model_name").distinct()
    meta = B.model_metadata(models, overrides, fetched, flags)
    board = B.leaderboard(golden, meta)
    row = board.collect()
    assert len(row) == 1  # only models with a model_id
    row = row[0]
    assert (row["T"], row["Tipo"], row["Modelo"], row["Arquitetura"]) == ("Custom", "Custom", "org/First", "A,B")
    assert (row["#Params (B)"], row["Licença"], row["Disponível no hub"]) == (7.616, "unknown", True)
    assert len(board.columns) == 12 + len(AREAS) + len(BOARD) + 1 + len(DESCRIPTIONS)
    assert row["STEM"] == 0.0 and row["STEM (datasets)"] == DESCRIPTIONS["STEM"]
    assert B.leaderboard(golden, meta, compat=True).first()["STEM"] == DESCRIPTIONS["STEM"]
    plain = B.model_metadata(models, overrides, fetched).first()
    assert (plain["T"], plain["Tipo"]) == ("SFT", "SFT: Supervised Finetuning")


def test_custom_flags_must_match_up(spark):
    with pytest.warns(UserWarning, match="ignored"):
        assert B.custom_flags(spark, ["a/b"], []) is None


def test_upsert_beyond_the_broadcast_limit(old, new, monkeypatch):
    want = rows_of(U.upsert(old, new))
    plain = small_join
    monkeypatch.setattr(U, "small_join", lambda *a, **k: plain(*a, **k, limit=0, salts=4))
    assert rows_of(U.upsert(old, new)) == want


def test_a_board_is_stored_from_scores_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([("a", "oab", 0.5), ("a", "bluex", 0.25), ("b", "oab", 1.0)], "model_name string, benchmark string, accuracy double")
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in EVAL.names if c not in rows.columns})
    rows = rows.withColumn("accuracy", counted.asNondeterministic()("accuracy")).select(EVAL.names)
    overrides = spark.createDataFrame([("a", "org/a"), ("b", "org/b")], "model_name string, model_id string")
    for overwrite in (False, True):
        store_board(spark, rows, str(tmp_path / "board"), overrides, overwrite=overwrite)
    assert seen.value == 2 * 3
    stored = spark.read.parquet(str(tmp_path / "board"))
    assert {r.model_name: r[B.OVERALL] for r in stored.collect()} == {"a": 0.375, "b": 0.5}
