"""Files in, tables out: the pipeline from captured pages to gold tables, and its streaming half."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from askgauge.operators import quality
from askgauge.operators.enrich import FROM_QUESTIONS, enrich_responses
from askgauge.operators.scoring import grade_responses
from askgauge.operators.staging import stage_responses
from askgauge.plans import marts, reports, warehouse
from askgauge.schemas import ENRICHED_COLUMNS, MARTS, RESPONSES
from askgauge.sources import derived, files
from askgauge.streaming import grading


@pytest.fixture(scope="module")
def silver(spark, sf_dir, tmp_path_factory):
    home = tmp_path_factory.mktemp("silver")
    files.write_clean_questions(derived.questions(spark, sf_dir), f"{home}/questions")
    files.append_responses(derived.responses(spark, sf_dir), f"{home}/responses", batch_size=400)
    return str(home)


def test_pages_to_clean_questions(spark, tmp_path):
    def question(i, text):
        return {"type": "multiple", "difficulty": "easy", "category": "Science & Nature", "question": text,
                "correct_answer": f"r{i}", "incorrect_answers": ["a", 'b "q"', f"c&amp;{i}"]}

    pages = [
        {"response_code": 0, "results": [question(1, 'Line one\nsays "hi", &quot;ok&quot;'), question(2, "Two")]},
        {"response_code": 4, "results": [question(9, "never read")]},
        {"response_code": 0, "results": [question(2, "TWO"), question(3, "Three\\n")]},
    ]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.json").write_text("\n".join(map(json.dumps, pages)))
    collected = files.read_api_pages(spark, f"{tmp_path}/pages")
    assert collected.count() == 4
    assert files.read_api_pages(spark, f"{tmp_path}/pages", 3).count() == 3
    files.write_raw_questions(collected.coalesce(1), f"{tmp_path}/bronze")
    with pytest.raises(ValueError):
        files.write_raw_questions(collected.limit(0), f"{tmp_path}/nothing")

    part = next(f for f in os.listdir(f"{tmp_path}/bronze") if f.endswith(".csv"))
    with open(f"{tmp_path}/bronze/{part}", newline="") as f:
        rows = list(csv.DictReader(f))
    assert [json.loads(r["incorrect_answers"])[1] for r in rows] == ['b "q"'] * 4
    assert rows[0]["question"].startswith("Line one\nsays")

    clean = warehouse.build_questions(files.read_raw_questions(spark, f"{tmp_path}/bronze"), f"{tmp_path}/silver", spark)
    assert {r.question for r in clean.collect()} == {'Line one says "hi", "ok"', "Two", "Three\\n"}
    assert clean.where(F.col("question") == "Two").first().incorrect_answers == ["a", 'b "q"', "c&2"]


def test_blank_fields_stay_blank(spark, tmp_path):
    (tmp_path / "q.csv").write_text(
        'type,difficulty,category,question,correct_answer,incorrect_answers\nmultiple,easy,,"a ""b""",NA,"[""x""]"\n'
    )
    row = files.read_raw_questions(spark, f"{tmp_path}/q.csv").first()
    assert (row.category, row.question, row.correct_answer, row.incorrect_answers) == ("", 'a "b"', "NA", '["x"]')


def test_wrong_columns_stop_the_pipeline(spark, tmp_path):
    (tmp_path / "extra.csv").write_text(
        'type,difficulty,category,question,correct_answer,incorrect_answers,more\nmultiple,easy,a,b,c,"[""1"",""2"",""3""]",x\n'
    )
    (tmp_path / "short.csv").write_text("type,difficulty\nmultiple,easy\n")
    for name in ("extra", "short"):
        raw = files.read_raw_questions(spark, f"{tmp_path}/{name}.csv")
        with pytest.raises(quality.ContractError, match="1 check.*expected_columns"):
            warehouse.build_questions(raw, f"{tmp_path}/out", spark)
    assert not os.path.exists(f"{tmp_path}/out")


def test_dominant_question_is_split_in_the_join(spark):
    """A question holding a third of the answers, both sides too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, "q0").otherwise(F.concat(F.lit("q"), (F.col("id") % 500).cast("string")))
        answers = spark.range(0, 30000, 1, 6).withColumn("question_id", key)
        graded = answers.select(
            "question_id",
            *(F.lit(None).cast("string").alias(c) for c in ENRICHED_COLUMNS
              if c not in (*FROM_QUESTIONS, "question_id", "random_baseline", "run_id")),
            F.md5(F.col("id").cast("string")).alias("run_id"),
        )
        questions = spark.range(500).select(
            F.concat(F.lit("q"), F.col("id").cast("string")).alias("question_id"),
            *(F.lit("x").alias(c) for c in FROM_QUESTIONS if c != "nb_options"),
            F.lit(4).alias("nb_options"),
        )
        joined = enrich_responses(graded, questions)
        rows = joined.select("run_id", "question_id", "random_baseline").collect()
        assert len(rows) == len({r.run_id for r in rows}) == 30000 and {r.random_baseline for r in rows} == {0.25}
        full = enrich_responses(graded, questions)
        full.collect()
        assert "skew=true" in full._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_config_and_prompt_set(spark, tmp_path):
    header = ("run_order,run_id,model_key,lmstudio_id,model_name,publisher,country,params_b,disable_thinking,"
              "prompt_version,label_style,prompt_description,system_prompt,user_template,temperature,max_tokens,"
              "n_questions,sample_seed")
    line = '{0},r{0},m,lab/m,M,P,FR,1.5,false,v1,letters,"a, b",,"Q: {{question}}\n{{options}}",0.0,5,10,42'
    (tmp_path / "c.csv").write_text("\n".join([header, line.format(2), line.format(1)]) + "\n")
    config = files.read_run_config(spark, f"{tmp_path}/c.csv").collect()
    assert [r.run_order for r in config] == [1, 2]
    assert config[0].user_template == "Q: {question}\n{options}" and config[0].system_prompt == ""
    assert [r.run_id for r in files.read_run_config(spark, f"{tmp_path}/c.csv", [2]).collect()] == ["r2"]
    with pytest.raises(ValueError):
        files.read_run_config(spark, f"{tmp_path}/c.csv", [7])
    (tmp_path / "p.csv").write_text("prompt_version,system_prompt,user_template,structured_output\nv1,a\\nb,c\\nd, TRUE \n")
    assert tuple(files.read_prompt_set(spark, f"{tmp_path}/p.csv").first()) == ("v1", "a\nb", "c\nd", True)


def write_text(path, **files_):
    path.mkdir()
    for name, text in files_.items():
        (path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(path)


def test_columns_are_matched_by_each_files_header(spark, tmp_path):
    path = write_text(
        tmp_path / "prompts",
        a='prompt_version,system_prompt,user_template,structured_output\nv1,S,"T, {options}\nx",true\n',
        b='user_template,structured_output,prompt_version,system_prompt\nU,,v2,\n"say ""hi""",True,v3,s\n',
        c="\ufeffstructured_output,system_prompt,user_template,prompt_version\nfalse,p,q,v4\n",
    )
    got = {tuple(r) for r in files.read_prompt_set(spark, path).collect()}
    assert got == {("v1", "S", "T, {options}\nx", True), ("v2", "", "U", False), ("v3", "s", 'say "hi"', True), ("v4", "p", "q", False)}


@pytest.mark.parametrize(
    "body",
    [
        "prompt_version,system_prompt,user_template\nv1,S,T\n",
        "prompt_version,system_prompt,user_template,structured\nv1,S,T,true\n",
        "prompt_version,system_prompt,user_template,structured_output\nv1,S,T\n",
        "prompt_version,system_prompt,user_template,structured_output\nv1,S,T,true,more\n",
        "prompt_version,prompt_version,user_template,structured_output\nv1,S,T,true\n",
    ],
)
def test_a_prompt_set_that_does_not_fit_is_refused(spark, tmp_path, body):
    good = "prompt_version,system_prompt,user_template,structured_output\nv0,S,T,true\n"
    path = write_text(tmp_path / "prompts", a=good, b=body)
    with pytest.raises(Exception, match="(?i)unexpected columns|malformed"):
        files.read_prompt_set(spark, path).collect()
    with pytest.raises(Exception, match="(?i)unexpected columns|malformed"):
        files.read_prompt_set(spark, path).count()


def test_a_run_configuration_is_read_by_name_and_type(spark, sf_dir, tmp_path):
    config = derived.run_config(spark, sf_dir)
    turned = config.select(*reversed(config.columns))
    turned.coalesce(1).write.options(header=True, quote='"', escape='"').csv(f"{tmp_path}/runs")
    assert sorted(map(str, files.read_run_config(spark, f"{tmp_path}/runs").collect())) == sorted(
        map(str, config.na.fill("").collect())
    )
    turned.withColumn("max_tokens", F.lit("many")).coalesce(1).write.mode("overwrite").options(header=True).csv(f"{tmp_path}/bad")
    with pytest.raises(Exception, match="many"):
        files.read_run_config(spark, f"{tmp_path}/bad").collect()


def test_response_parts(spark, silver):
    parts = [f for f in os.listdir(f"{silver}/responses") if f.endswith(".parquet")]
    responses = files.read_responses(spark, f"{silver}/responses")
    assert responses.schema == RESPONSES and len(parts) >= responses.count() / 400
    pairs = files.answered_pairs(spark, f"{silver}/responses")
    assert "ReadSchema: struct<run_id:string,question_id:string>" in pairs._jdf.queryExecution().executedPlan().toString()


def test_warehouse(spark, silver):
    questions = files.read_clean_questions(spark, f"{silver}/questions")
    responses = files.read_responses(spark, f"{silver}/responses")
    with pytest.raises(warehouse.MartMissing):
        warehouse.load_mart(spark, MARTS[0], gold="t_gold")
    assert warehouse.available_marts(spark, "t_gold") == set()
    written = warehouse.build(spark, questions, responses, silver="t_silver", gold="t_gold")
    assert len(written) == 13 and warehouse.available_marts(spark, "t_gold") == set(MARTS)
    with pytest.raises(ValueError):
        warehouse.load_mart(spark, "mart_of_nothing", gold="t_gold")

    enriched = spark.table("t_silver.int_responses_enriched")
    n = enriched.count()
    assert n == responses.count()
    nb = {r.nb_options: r["count"] for r in questions.groupBy("nb_options").count().collect()}
    assert spark.table("t_silver.int_answer_options").count() == 4 * nb[4] + 2 * nb[2]
    gold = {name: warehouse.load_mart(spark, name, "t_gold") for name in MARTS}
    assert gold["mart_leaderboard"].agg(F.sum("n_questions")).first()[0] == n
    volumes = reports.volumes(gold["mart_leaderboard"], gold["mart_question_insights"]).first()
    assert (volumes.n_responses, volumes.n_models, volumes.n_prompts, volumes.n_runs) == (n, 4, 4, 16)
    again = marts.position_bias(enriched)
    assert sorted(map(str, again.collect())) == sorted(map(str, gold["mart_position_bias"].collect()))

    # Filters on the partition columns never read the other files.
    plan = marts.prompt_format(enriched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(temperature" in plan


def test_status_counts_add_up(spark, sf_dir):
    enriched = derived.enriched_responses(spark, sf_dir)
    shares = reports.status_shares(marts.leaderboard(enriched))
    for row in shares.groupBy("model_name", "prompt_version").agg(F.sum("share").alias("s")).collect():
        assert row.s == pytest.approx(1, abs=2e-4)


def as_set(df):
    return {str(tuple(r)) for r in df.collect()}


@pytest.mark.parametrize("watermark", [None, "20000 days"])
def test_stream_equals_batch_and_resumes(spark, silver, tmp_path, watermark):
    responses = files.read_responses(spark, f"{silver}/responses")
    early, late = responses.where("run_order <= 8"), responses.where("run_order > 8")
    source, sink, progress = (f"{tmp_path}/{name}" for name in ("in", "out", "progress"))
    files.append_responses(early, source)
    grading.start_grading(spark, source, sink, progress, watermark, max_files=1).awaitTermination()
    assert spark.read.parquet(sink).count() == early.count()
    files.append_responses(late.union(early.limit(50)), source)
    grading.start_grading(spark, source, sink, progress, watermark).awaitTermination()
    streamed = spark.read.parquet(sink)
    batch = grade_responses(stage_responses(responses))
    assert streamed.schema.fieldNames() == batch.schema.fieldNames()
    assert [f.dataType for f in streamed.schema] == [f.dataType for f in batch.schema]
    assert as_set(streamed) == as_set(batch)
    assert streamed.count() == batch.count()


HEADER = "type,difficulty,category,question,correct_answer,incorrect_answers\n"


@pytest.mark.parametrize(
    "second",
    [
        "type,difficulty,category,correct_answer,question,incorrect_answers\nmultiple,easy,c,A,Q?,[]\n",
        HEADER + "multiple,easy,c,Q?,A,[],surplus\n",
        HEADER + "multiple,easy,c,Q?\n",
    ],
)
def test_files_that_do_not_fit_fail_the_read(spark, tmp_path, second):
    (tmp_path / "a.csv").write_text(HEADER + "multiple,easy,c,Q?,A,[]\n")
    (tmp_path / "b.csv").write_text(second)
    with pytest.raises(Exception):
        files.read_raw_questions(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("page", ['{"response_code": 2, "results": []}', '{"response_code": 3, "results": []}', "no json"])
def test_pages_of_unknown_outcome_fail_the_query(spark, tmp_path, page):
    good = '{"response_code": 0, "results": [{"question": "q"}]}'
    skipped = "".join(f'{{"response_code": {c}, "results": []}}\n' for c in (1, 4, 5))
    (tmp_path / "p.json").write_text(f"{good}\n{skipped}")
    assert files.read_api_pages(spark, str(tmp_path)).count() == 1
    (tmp_path / "q.json").write_text(page + "\n")
    with pytest.raises(Exception, match="unexpected response code"):
        files.read_api_pages(spark, str(tmp_path)).collect()


def test_a_cap_keeps_the_first_collected(spark, tmp_path):
    for name in "abc":
        pages = [{"response_code": 0, "results": [{"question": f"{name}{i}{j}"} for j in range(3)]} for i in range(4)]
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, pages)))
    got = files.read_api_pages(spark, str(tmp_path), 14).collect()
    assert [r.question for r in got] == [f"a{i}{j}" for i in range(4) for j in range(3)] + ["b00", "b01"]


def test_tables_from_what_the_stream_graded(spark, silver, tmp_path):
    source, sink, progress = (f"{tmp_path}/{name}" for name in ("in", "out", "progress"))
    responses = files.read_responses(spark, f"{silver}/responses")
    files.append_responses(responses, source)
    grading.start_grading(spark, source, sink, progress).awaitTermination()
    questions = files.read_clean_questions(spark, f"{silver}/questions")
    graded = spark.read.parquet(sink)
    names = warehouse.build(spark, questions, None, "s_silver", "s_gold", graded=graded)
    assert "s_gold.mart_leaderboard" in names
    n = warehouse.load_mart(spark, "mart_leaderboard", "s_gold").agg(F.sum("n_questions")).first()[0]
    assert n == responses.count()


def test_files_added_later_are_seen(spark, sf_dir, tmp_path):
    for name in ("part", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    before = derived.responses(spark, str(tmp_path)).count()
    added = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(5)
    added.write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    assert derived.responses(spark, str(tmp_path)).count() == before + 5


def test_every_line_item_is_a_response(spark, sf_dir):
    responses = derived.responses(spark, sf_dir)
    assert responses.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert responses.select("run_id", "question_id").distinct().count() == responses.count()
    assert derived.run_config(spark, sf_dir).select("sample_seed").distinct().count() == 2
