"""Sources, generation and the four jobs end to end."""

import gzip
import json
import random
import uuid
from collections import Counter

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.operators import infer as I
from gabarito.operators.resume import score_resumable
from gabarito.plans.answers import (
    answers_table,
    export_answers,
    store_answers,
    store_answers_by_model,
)
from gabarito.plans import prompts as prompt_plans
from gabarito.plans.leaderboard import board_rows, store_board
from gabarito.plans.prompts import build_prompts_from
from gabarito.plans.scoring import score_answers, store_eval
from gabarito.registry import BENCHMARKS
from gabarito.schemas import ANSWERS, EVAL, PROMPTS
from gabarito.sources import csv as C
from gabarito.sources import replacing
from gabarito.sources import tables as S
from gabarito.staging import staged


def test_scorer_failures_cost_only_their_rows(spark):
    def scorer(path, prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no luck")
        return ["Sim" for _ in prompts]

    rows = [(i, "hatebr", "bad" if i == 5 else f"p{i}", "org/m") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, benchmark string, prompt string, model_path string")
    got = {r.id: r for r in I.parse_answers(I.score_batches(df, scorer, 6)).collect()}
    assert len(got) == 20
    assert (got[5].model_answer, got[5].error, got[5].parsed_model_answer) == (None, "no luck", None)
    assert all(r.parsed_model_answer == "1" and r.error is None for i, r in got.items() if i != 5)
    shown = I.parse_answers(I.score_batches(df, scorer, 6), sentinel=True).where("id = 5").first()
    assert shown.model_answer == "__API_ERROR__: no luck" and shown.parsed_model_answer is None
    split = spark.createDataFrame([(shown.model_answer,), ("Sim",)], "t string").select(I.split_sentinel(F.col("t"))["error"])
    assert [r[0] for r in split.collect()] == ["no luck", None]


def test_wrong_number_of_answers_is_an_error(spark):
    df = spark.createDataFrame([("p", "m"), ("q", "m")], "prompt string, model_path string").coalesce(1)
    got = I.score_batches(df, lambda path, prompts: [], 8).collect()
    assert {r.error for r in got} == {"scorer gave 0 answers for 1 prompts"}


def test_hosted_scorer_routes_by_name():
    clients = {
        "openai": lambda model, system, user: f"o|{system}|{user}",
        "gemini": lambda model, system, user: f"g|{system}|{user}",
    }
    score = I.hosted_scorer(clients)
    prompt = "<system> s </system>\n<user>u\n</user>"
    assert score("GPT-4", [prompt, "no tags"]) == ["o|s|u", "o||"]
    assert score("gemini-x", [prompt]) == ["g|s|u"]
    with pytest.raises(ValueError, match="Unknown API provider"):
        score("claudio", [prompt])


def test_csv_keeps_types_nulls_and_blanks(spark, tmp_path):
    rows = [(1, "x_0", "b", 'q",\n\\', "[]", "1", "m", " s", None, "1", None), (2, "x_1", "b", "", "[]", "01", "m", None, None, None, None)]
    df = spark.createDataFrame(rows, ANSWERS)
    C.write_csv(df, str(tmp_path / "a"))
    back = C.read_csv(spark, str(tmp_path / "a"), ANSWERS)
    assert sorted(back.collect()) == sorted(df.collect()) and back.schema.names == ANSWERS.names
    C.write_csv(df.select("id", F.lit("\\alpha").alias("t")), str(tmp_path / "e"), escape=True)
    assert {r.t for r in spark.read.csv(str(tmp_path / "e"), header=True, escape='"').collect()} == {"\\\\alpha"}


def test_csv_written_by_pandas(spark, tmp_path):
    frame = pd.DataFrame({"id": [1, 2], "label": ["1", None], "prompt": ['a "q"\nb', "c,d"], "Unnamed: 0": [0, 1]})
    frame.to_csv(tmp_path / "p.csv", index=False)
    back = C.read_csv(spark, str(tmp_path / "p.csv"), ANSWERS)
    assert sorted(map(tuple, back.collect())) == [(1, "1", 'a "q"\nb'), (2, None, "c,d")]


def test_headers_of_many_files_cost_no_jobs(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(500):
        columns = ["a", "b\nc", "n"] if i % 2 else ["n", "b\nc", "a"]
        values = {"a": f'"x, ""{i}"""', "b\nc": '"two\nlines"', "n": str(i)}
        text = ",".join(f'"{c}"' for c in columns) + "\n" + ",".join(values[c] for c in columns) + "\n"
        (folder / f"{i:03}.csv").write_text(text)
    (folder / "empty.csv").write_text("")
    (folder / "zipped.csv.gz").write_bytes(gzip.compress(b"a,n\nz,500\n"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    rows = C.read_csv(spark, str(folder), T.StructType.fromDDL("a string, `b\nc` string, n long"))
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8
    got = {r["n"]: (r["a"], r["b\nc"]) for r in rows.collect()}
    assert got == {i: (f'x, "{i}"', "two\nlines") for i in range(500)} | {500: ("z", None)}


@pytest.mark.parametrize("files", [1, 3])
def test_shards_are_placed_directly(spark, tmp_path, files):
    df = spark.range(900).select("id", F.concat(F.lit("text, "), "id").alias("t"), (F.col("id") % 6).cast("int").alias("shard"))
    df = df.where("shard <> 4").repartition(7)
    C.write_shards(df, str(tmp_path / "s"), shards=6, files=files)
    folders = {f.name: len(list(f.glob("*.csv"))) for f in (tmp_path / "s").iterdir() if f.is_dir()}
    assert folders == {f"shard={k}": files for k in (0, 1, 2, 3, 5)}
    with pytest.warns(UserWarning, match=r"\[4\] of 6"):
        back = C.read_shards(spark, str(tmp_path / "s"), T.StructType.fromDDL("id long, t string"), expected=6)
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_missing_shards(spark, tmp_path):
    df = spark.range(6).select(F.col("id").cast("string").alias("label"), (F.col("id") % 3).cast("int").alias("shard"))
    C.write_shards(df, str(tmp_path / "s"))
    back = C.read_shards(spark, str(tmp_path / "s"), ANSWERS)
    assert back.count() == 6 and {(r.label, r.shard) for r in back.collect()} == {(str(i), i % 3) for i in range(6)}
    assert [r.shard for r in C.missing_shards(back, 5).orderBy("shard").collect()] == [3, 4]


def test_subsets_must_agree(spark):
    a = spark.createDataFrame([(1, "x")], "answer long, question string")
    assert S.union_subsets({"pt": a, "en": a}).where("subset_name = 'en'").count() == 1
    with pytest.raises(ValueError, match="another schema"):
        S.union_subsets({"pt": a, "en": a.withColumn("answer", F.lit("1"))})


def test_split_resolution_and_fallback(spark, tmp_path):
    for split in ("train", "test"):
        spark.range(1).write.parquet(str(tmp_path / "both" / split))
    spark.range(1).write.parquet(str(tmp_path / "one" / "train"))
    assert S.resolve_split(spark, str(tmp_path / "both"), None) == "test"
    assert S.resolve_split(spark, str(tmp_path / "one"), None) == "train"
    assert S.resolve_split(spark, str(tmp_path / "one"), "oab") == "oab"
    df = spark.createDataFrame([("m", "b", 0.5, None, None, None, None, 0.0, 0.0)], EVAL)
    C.write_csv(df, str(tmp_path / "eval_csv"))
    got = S.read_table_or_csv(spark, str(tmp_path / "nope"), str(tmp_path / "eval_csv"), EVAL)
    assert got.first() == df.first()
    df.write.parquet(str(tmp_path / "eval"))
    assert S.read_table_or_csv(spark, str(tmp_path / "eval"), "unused", EVAL).first() == df.first()


@pytest.fixture
def sources(spark, tmp_path):
    """Three benchmarks laid out as source folders."""
    root = str(tmp_path / "sources")
    n = 40
    hate = [(f"frase {i}" if i % 9 else "", i % 2) for i in range(n)]
    spark.createDataFrame(hate, "sentence string, label int").coalesce(1).write.parquet(f"{root}/hatebr/HateBR_offensive_binary/test")
    oab = [(f"q{i}", "{'text': ['a', 'b', None], 'label': ['A', 'B', 'C']}", "AB"[i % 2]) for i in range(n)]
    spark.createDataFrame(oab, "statement string, alternatives string, answer string").coalesce(1).write.parquet(f"{root}/oab/oab")
    for lang in ("pt", "en"):
        rows = [(f"{lang}{i}", *[f"o{j}" for j in range(10)], "J") for i in range(8)]
        names = ["question", *[f"option_{j}" for j in range(10)], "answer"]
        spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{root}/mmlu_pro_x/{lang}/test")
    return root


MODELS = [("org/one", "api", "instruct"), ("org/two", "tok", "base")]
NAMES = ["oab", "hatebr", "mmlu_pro_x"]


def oracle_scorer():
    """Right on choice prompts for one model, on yes/no prompts for the other."""

    def score(path, prompts):
        if path == "org/one":
            return ["A" if "q" in p.split("Sample to evaluate")[-1] else "Não" for p in prompts]
        return ["Sim" for _ in prompts]

    return score  # a closure, so that workers need not import this module


def test_four_jobs(spark, sources, tmp_path):
    prompts = build_prompts_from(spark, sources, NAMES, MODELS, n_shots=2, n_experiments=2)
    rows = prompts.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(2 * (40 + 35 + 16)))
    assert rows[0].benchmark == "oab" and rows[-1].id_bench == "mmlu_pro_x_15"
    for i in (0, 7):
        want = random.Random(42).sample([x for x in range(40) if x != i], 2)
        assert rows[2 * i].shot_indices == [f"oab_{x}" for x in want]
    assert rows[80].label == "1" and rows[80].id_bench == "hatebr_0"  # item 0 was incomplete
    path = str(tmp_path / "prompts")
    prompts.write.parquet(path)
    prompts = spark.read.parquet(path)

    answers = answers_table(prompts, ["org/one", "org/two"], oracle_scorer(), batch_size=7)
    target = str(tmp_path / "answers")
    store_answers(answers, target)
    stored = S.read_table(spark, target, ANSWERS)
    assert stored.count() == 2 * len(rows)
    store_answers(answers.where("model_name = 'two' and benchmark = 'oab'"), target)
    again = S.read_table(spark, target, ANSWERS)
    assert again.count() == 2 * len(rows)
    assert again.where("prompt like '%<system>%'").select("model_name").distinct().collect()[0][0] == "one"

    evals = str(tmp_path / "eval")
    store_eval(spark, again, evals)
    store_eval(spark, again.where("model_name = 'two'"), evals)
    table = S.read_table(spark, evals, EVAL)
    scores = {(r.model_name, r.benchmark): r.accuracy for r in table.collect()}
    assert len(scores) == 6 and scores["one", "oab"] == pytest.approx(0.5)
    assert scores["two", "hatebr"] == pytest.approx(sum(i % 2 for i in range(40) if i % 9) / 35)
    assert {(r.model_name, r.benchmark) for r in score_answers(again).collect()} == set(scores)

    overrides = spark.createDataFrame([("one", "org/one"), ("two", "org/two")], "model_name string, model_id string")
    board = str(tmp_path / "board")
    store_board(spark, table.where("model_name = 'one'"), board, overrides)
    store_board(spark, table, board, overrides)
    final = {r.Modelo: r for r in S.read_table(spark, board).collect()}
    assert set(final) == {"one", "two"} and final["one"]["OAB"] == pytest.approx(0.5)
    assert board_rows(table, overrides, exclude=["two"]).count() == 1
    store_board(spark, table, board, overrides, overwrite=True)
    assert S.read_table(spark, board).count() == 2


def test_percent_and_unknown_names(spark, sources):
    tenth = build_prompts_from(spark, sources, ["hatebr"], MODELS, percent=10)
    assert tenth.count() == 4 and tenth.where(F.size("shot_indices") > 0).count() == 0
    with pytest.raises(ValueError, match="percent"):
        build_prompts_from(spark, sources, ["hatebr"], MODELS, percent=101)
    with pytest.raises(KeyError, match="unknown benchmark"):
        build_prompts_from(spark, sources, ["mmlu_redux"], MODELS)
    with pytest.raises((PySparkException, ValueError)):
        build_prompts_from(spark, sources, ["mmlu_pro_x"], MODELS, n_shots=16)


def test_structured_and_row_seeded_prompts(spark, sources):
    hosted = [("org/one", "api", "instruct")]
    rows = build_prompts_from(spark, sources, ["hatebr"], hosted, n_shots=1, structured=True, fixed_seed=False, seed=3)
    assert rows.count() == 35
    assert rows.where("prompt like '%IMPORTANTE: Responda APENAS%'").count() == 35
    assert rows.select("shot_indices").distinct().count() > 5


def test_source_order_and_preview(spark, sources):
    rows = S.load_benchmark(spark, sources, BENCHMARKS["mmlu_pro_x"])
    assert rows.where("subset_name = 'pt'").count() == 8
    assert rows.select("source_file", "source_row").distinct().count() == 16
    shown = S.preview(S.load_benchmark(spark, sources, BENCHMARKS["oab"]), BENCHMARKS["oab"]).first()
    assert shown.user.startswith("Pergunta:\nq0.") and shown.with_answer.endswith("(A)")
    # An incomplete first row is shown as it is; a benchmark without rows is not.
    hate = S.load_benchmark(spark, sources, BENCHMARKS["hatebr"])
    broken = hate.withColumn("sentence", F.when(F.col("source_row") > 0, F.col("sentence")))
    (only,) = S.previews({"hatebr": broken, "portuguese_hate_speech": broken.where("false")}).collect()
    assert only.benchmark == "hatebr" and "None" in only.user


def test_command_line(spark, sources, tmp_path, monkeypatch):
    from gabarito import __main__ as cli

    monkeypatch.setattr(cli, "load", lambda reference: oracle_scorer())
    t = {k: str(tmp_path / k) for k in ("prompts", "answers", "eval", "board", "overrides")}
    names = [("one", "org/one"), ("two", "org/two")]
    spark.createDataFrame(names, "model_name string, model_id string").write.parquet(t["overrides"])
    models = ["--models", "org/one", "org/two"]
    for argv in (
        ["prompts", "--sources", sources, "--prompts", t["prompts"], "--benchmarks", "oab", *models]
        + ["--tokenizers", "api", "tok", "--types", "instruct", "base", "--shots", "1", "--experiments", "1"],
        ["answers", "--prompts", t["prompts"], "--answers", t["answers"], *models, "--scorer", "x:y", "--tasks", "3"],
        ["score", "--answers", t["answers"], "--eval", t["eval"]],
        ["board", "--eval", t["eval"], "--board", t["board"], "--overrides", t["overrides"]]
        + [*models, "--custom-flags", "true", "false"],
    ):
        cli.run(spark, cli.arguments(argv))
    board = {r.Modelo: r for r in S.read_table(spark, t["board"]).collect()}
    assert board["one"]["T"] == "Custom" and board["two"]["T"] == "Base"
    assert board["one"]["OAB"] == pytest.approx(0.5)


def stored(model, bench, n):
    return [(i, f"{bench}_{i}", bench, "p\\x", "[]", "A", model, "A", None, "A", None) for i in range(n)]


def test_store_by_model_and_export(spark, tmp_path):
    path, out = str(tmp_path / "a"), str(tmp_path / "csv")
    first = spark.createDataFrame(stored("m", "oab", 3) + stored("m", "enem", 2) + stored("k", "oab", 2), ANSWERS)
    store_answers_by_model(spark, first, path)
    store_answers_by_model(spark, spark.createDataFrame(stored("m", "oab", 1), ANSWERS), path)
    left = S.read_table(spark, path, ANSWERS)
    assert sorted((r.model_name, r.id_bench) for r in left.collect()) == [("k", "oab_0"), ("k", "oab_1"), ("m", "oab_0")]
    export_answers(left, out)
    back = C.read_csv(spark, out, ANSWERS).orderBy("id").collect()
    assert [(r.id, r.model_name, r.prompt) for r in back] == [(1, "k", "p\\\\x"), (2, "k", "p\\\\x"), (3, "m", "p\\\\x")]


def test_prompts_survive_csv(spark, tmp_path):
    rows = [(0, "oab_0", "oab", '{"api": 1}', ["oab_1", "oab_2"], "A"), (1, "oab_1", "oab", "", [], "B")]
    df = spark.createDataFrame(rows, PROMPTS)
    C.write_csv(df, str(tmp_path / "p"))
    assert sorted(C.read_csv(spark, str(tmp_path / "p"), PROMPTS).collect()) == sorted(df.collect())


def counted(spark, calls, scorer=None):
    """A scorer that counts the prompts it is given."""

    def score(path, prompts):
        calls.add(len(prompts))
        return scorer(path, prompts) if scorer else ["Sim"] * len(prompts)

    return score


def few_prompts(spark, n=10):
    rows = [(i, f"hatebr_{i}", "hatebr", f'{{"tok_instruct": {{"prompt": "p{i}", "models": ["org/m"]}}}}', [], "1") for i in range(n)]
    return spark.createDataFrame(rows, PROMPTS)


@pytest.mark.parametrize("store", ["by_pair", "by_model", "export"])
def test_every_prompt_is_scored_once(spark, tmp_path, store):
    calls = spark.sparkContext.accumulator(0)
    answers = answers_table(few_prompts(spark), ["org/m"], counted(spark, calls))
    path = str(tmp_path / "a")
    if store == "by_pair":
        store_answers(answers, path)
    elif store == "by_model":
        store_answers_by_model(spark, answers, path)
        assert calls.value == 10
        store_answers_by_model(spark, answers, path)
        calls.add(-10)
    else:
        export_answers(answers, path)
    assert calls.value == 10


def test_good_rows_are_never_called_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(path, prompts):
        seen.add(sum(p == "good" for p in prompts))
        return [ValueError("busy") if p == "bad" else p for p in prompts]

    df = spark.createDataFrame([(i, "m", "bad" if i == 3 else "good") for i in range(6)], "id int, model_path string, prompt string")
    got = {r.id: (r.model_answer, r.error) for r in I.score_batches(df.coalesce(1), score, 6).collect()}
    assert got[3] == (None, "busy") and got[0] == ("good", None)
    assert seen.value == 5


def test_programming_errors_fail_the_job(spark):
    def score(path, prompts):
        return [p.missing_method() for p in prompts]

    df = spark.createDataFrame([(1, "m", "x")], "id int, model_path string, prompt string")
    with pytest.raises(PySparkException, match="missing_method"):
        I.score_batches(df, score, 6).collect()


def test_replacing_a_model_leaves_other_files_alone(spark, tmp_path):
    path = tmp_path / "a"
    rows = stored("m", "oab", 3) + stored("m", "enem", 2) + stored("k", "oab", 2)
    store_answers_by_model(spark, spark.createDataFrame(rows, ANSWERS), str(path))
    others = {p: p.stat().st_mtime_ns for p in (path / "model_name=k").rglob("*.parquet")}
    store_answers_by_model(spark, spark.createDataFrame(stored("m", "oab", 1), ANSWERS), str(path))
    assert others and {p: p.stat().st_mtime_ns for p in others} == others
    assert not list((path / "model_name=m" / "benchmark=enem").glob("*.parquet"))
    assert S.read_table(spark, str(path), ANSWERS).where("model_name = 'm'").count() == 1


ODD_NAMES = ["two words", "a:b", "50%", "x=y", "è-é", "m%20n", "{1,2}*?[a]", "tab\there", "plain"]


@pytest.mark.parametrize("name", ODD_NAMES)
def test_replacement_holds_for_any_name(spark, tmp_path, name):
    path = str(tmp_path / "with blank" / "a")
    store_answers_by_model(spark, spark.createDataFrame(stored(name, "oab", 3) + stored(name, "b %:=é", 2) + stored("k", "oab", 2), ANSWERS), path)
    store_answers_by_model(spark, spark.createDataFrame(stored(name, "b %:=é", 1), ANSWERS), path)
    left = sorted((r.model_name, r.benchmark) for r in S.read_table(spark, path, ANSWERS).collect())
    assert left == sorted([("k", "oab")] * 2 + [(name, "b %:=é")])


@pytest.mark.parametrize("stop", ["write_table", "Folder.rename", "Folder.remove"])
def test_a_stopped_replacement_is_finished_by_the_next(spark, tmp_path, monkeypatch, stop):
    path = str(tmp_path / "a")
    store_answers_by_model(spark, spark.createDataFrame(stored("m", "oab", 3) + stored("m", "enem", 2) + stored("k", "oab", 2), ANSWERS), path)

    def stopped(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        owner = replacing.Folder if "." in stop else replacing
        m.setattr(owner, stop.split(".")[-1], stopped)
        with pytest.raises(KeyboardInterrupt):
            store_answers_by_model(spark, spark.createDataFrame(stored("m", "oab", 1), ANSWERS), path)
    store_answers_by_model(spark, spark.createDataFrame(stored("n", "oab", 1), ANSWERS), path)
    left = sorted((r.model_name, r.id_bench) for r in S.read_table(spark, path, ANSWERS).collect())
    assert left == [("k", "oab_0"), ("k", "oab_1"), ("m", "oab_0"), ("n", "oab_0")]
    assert not replacing.finish_replacement(spark, path, ["model_name", "benchmark"])


def test_a_lost_batch_removes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    store_answers_by_model(spark, spark.createDataFrame(stored("m", "oab", 1), ANSWERS), path)
    folder = replacing.Folder(spark, path)
    folder.write(replacing.WRITING, json.dumps({"batch": str(tmp_path / "gone"), "schema": ANSWERS.json(), "stale": ["model_name=m/benchmark=oab"]}))
    with pytest.warns(UserWarning, match="store them again"):
        store_answers_by_model(spark, spark.createDataFrame(stored("k", "oab", 1), ANSWERS), path)
    assert S.read_table(spark, path, ANSWERS).count() == 2


@pytest.mark.parametrize("model, bench", [(None, "oab"), ("m", None), ("", "oab")])
def test_answers_need_a_model_and_a_benchmark(spark, tmp_path, model, bench):
    with pytest.raises(ValueError, match="model_name and benchmark"):
        store_answers_by_model(spark, spark.createDataFrame(stored(model, bench, 1), ANSWERS), str(tmp_path / "a"))
    store_answers_by_model(spark, spark.createDataFrame([], ANSWERS), str(tmp_path / "a"))


def test_export_numbers_gappy_ids(spark, tmp_path):
    rows = [r for r in stored("m", "oab", 5) if r[0] != 2] + stored("k", "enem", 2)
    export_answers(spark.createDataFrame(rows, ANSWERS), str(tmp_path / "e"))
    back = C.read_csv(spark, str(tmp_path / "e"), ANSWERS).orderBy("id").collect()
    assert [(r.id, r.id_bench) for r in back] == [(1, "enem_0"), (2, "enem_1"), (3, "oab_0"), (4, "oab_1"), (5, "oab_3"), (6, "oab_4")]


def test_boards_with_hub_ids_do_not_multiply(spark, tmp_path):
    evals = spark.createDataFrame([("one", "oab", 0.5, None, None, None, None, 0.0, 0.0), ("two", "oab", 0.7, None, None, None, None, 0.0, 0.0)], EVAL)
    overrides = spark.createDataFrame([("one", "org/one"), ("two", "org/two")], "model_name string, model_id string")
    hub = "model_id string, hub_id string, sha string, likes long, private boolean, license string, architectures array<string>, "
    hub += "precision string, params_total long, base_model array<string>, is_adapter boolean"
    fetched = spark.createDataFrame([(m, "hub/same", *[None] * 9) for m in ("org/one", "org/two")], hub)
    path = str(tmp_path / "board")
    for overwrite in (False, False, False, True):
        store_board(spark, evals, path, overrides, overwrite=overwrite, fetched=fetched)
        rows = S.read_table(spark, path).collect()
        assert sorted((r.model_name, r.Modelo, r.OAB) for r in rows) == [("one", "hub/same", 0.5), ("two", "hub/same", 0.7)]


def test_job_one_reads_its_sources_once(spark):
    from gabarito.plans.prompts import build_prompts

    read = spark.sparkContext.accumulator(0)

    def counting(pages):
        for page in pages:
            read.add(len(page))
            yield page

    rows = spark.createDataFrame([(i, f"s{i}", str(i % 2)) for i in range(50)], "item_key long, sentence string, label string")
    source = rows.mapInPandas(counting, rows.schema)
    build_prompts({"hatebr": source}, MODELS, order=["item_key"], n_shots=2).count()
    assert read.value == 50
    head = build_prompts({"hatebr": source}, MODELS, order=["item_key"], percent=10)
    assert sorted(r.id for r in head.select("id").collect()) == list(range(5))
    assert read.value <= 150  # the keys, then the head


def test_null_benchmarks_fail_and_null_models_stay(spark):
    from gabarito.operators.clean import exclude_models
    from gabarito.operators.metrics import evaluate

    rows = spark.createDataFrame([("m", "hatebr", "1", "1"), ("m", None, "1", "1")], "model_name string, benchmark string, label string, parsed_model_answer string")
    with pytest.raises(PySparkException, match="unknown benchmark: null"):
        evaluate(rows).collect()
    names = spark.createDataFrame([("a",), (None,), ("b",)], "model_name string")
    assert sorted(map(str, (r[0] for r in exclude_models(names, ["a"]).collect()))) == ["None", "b"]


def test_failed_replacement_names_its_copy(spark, tmp_path, monkeypatch):
    df = spark.range(3)
    target = tmp_path / "t"
    target.write_text("a file where the folder should be")
    with pytest.raises(RuntimeError, match="its new rows are in") as problem:
        S.replace_table(df, f"{target}/below")
    assert spark.read.parquet(str(problem.value).rsplit(" ", 1)[-1]).count() == 3


def logging_scorer(log, broken=None):
    """Notes every prompt it answers in a file of its own; breaks down where `broken` says so."""

    def score(path, prompts):
        if broken and broken(prompts):
            raise AssertionError("stopped")
        for p in prompts:
            (log / f"{uuid.uuid4().hex}-{path.split('/')[-1]}-{p}").touch()
        return [ValueError("busy") if p == "p7" else f"answer to {p}" for p in prompts]

    return score


def asked(log):
    return sorted(f.name.split("-", 1)[1] for f in log.iterdir())


@pytest.mark.parametrize("commit_rows", [1, 4, 1000])
def test_a_stopped_run_asks_nothing_twice(spark, tmp_path, commit_rows):
    log, folder = tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()
    df = spark.createDataFrame([(i, f"m{i % 2}", f"p{i}") for i in range(40)], "id long, model_path string, prompt string").repartition(3)
    with pytest.raises(PySparkException, match="stopped"):
        score_resumable(df, logging_scorer(log, lambda ps: "p31" in ps), folder, batch_size=2, commit_rows=commit_rows, attempts=1)
    half = len(asked(log))
    assert 0 < half < 40
    rows = score_resumable(df, logging_scorer(log), folder, batch_size=2, commit_rows=commit_rows, attempts=1)
    got = {r.id: (r.model_path, r.model_answer, r.error) for r in rows.collect()}
    assert got == {i: (f"m{i % 2}", None if i == 7 else f"answer to p{i}", "busy" if i == 7 else None) for i in range(40)}
    assert rows.columns == ["id", "model_path", "prompt", "model_answer", "error"]
    # Only the row that failed is asked again.
    times = Counter(asked(log))
    assert {p: n for p, n in times.items() if n > 1}.keys() <= {"m1-p7"} and len(times) == 40
    score_resumable(df, logging_scorer(log), folder, attempts=1)
    assert sum(Counter(asked(log)).values()) == sum(times.values()) + 1


def test_changed_prompts_are_asked_and_old_ones_left_out(spark, tmp_path):
    log, folder = tmp_path / "log", f"file://{tmp_path}/with blank/answers"
    log.mkdir()
    make = lambda texts: spark.createDataFrame([(i, "m", t) for i, t in texts], "id long, model_path string, prompt string")
    score_resumable(make([(1, "a"), (2, "b"), (None, "c")]), logging_scorer(log), folder)
    rows = score_resumable(make([(1, "a"), (2, "other")]), logging_scorer(log), folder)
    assert sorted((r.id, r.model_answer) for r in rows.collect()) == [(1, "answer to a"), (2, "answer to other")]
    again = score_resumable(make([(None, "c"), (3, None)]), logging_scorer(log), folder)
    assert {(r.id, r.model_answer) for r in again.collect()} == {(None, "answer to c"), (3, "answer to None")}
    assert asked(log) == ["m-None", "m-a", "m-b", "m-c", "m-other"]
    assert score_resumable(make([(1, "a")]).where("id < 0"), logging_scorer(log), str(tmp_path / "none")).count() == 0


def test_answers_table_resumes(spark, tmp_path):
    log, folder = tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()
    table = lambda scorer: answers_table(few_prompts(spark), ["org/m"], scorer, resume=folder, batch_size=1)
    with pytest.raises(PySparkException, match="stopped"):
        table(logging_scorer(log, lambda ps: ps == ["p9"]))
    rows = table(logging_scorer(log))
    assert rows.columns == ANSWERS.names and rows.where("model_answer LIKE 'answer to p%'").count() == 9
    assert len(set(asked(log))) == 10


def test_item_texts_are_written_once_and_their_numbers_not_broadcast(spark, monkeypatch):
    copies = []

    def noted(df, name, partition_by=None):
        copies.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return staged(df, name, partition_by)

    monkeypatch.setattr(prompt_plans, "staged", noted)
    rows = spark.createDataFrame([(i, f"t{i}", str(i % 2)) for i in range(20)], "k long, sentence string, label string")
    items, _ = prompt_plans.staged_items({"hatebr": rows}, ["k"], 100, lambda sizes: None)
    assert [(r.idx, r.n_rows, r.id_bench) for r in items.orderBy("k").collect()] == [(i, 20, f"hatebr_{i}") for i in range(20)]
    (last, plan), = [c for c in copies if "turns" in c[0]]
    assert "strategy=merge" in plan
