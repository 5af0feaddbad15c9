"""Benchmark: one JSON line with the seconds of each headline query.

The silver inputs (clean questions, raw responses) are derived from the tables once, untimed. Each
query then runs once to warm up and is timed on the following run. ``build`` is the whole
transformation pipeline: staging, grading, joining, the option table and the eight evaluation tables,
all written as tables.

``python bench.py --duckdb`` runs the same statements in DuckDB on the same files instead: the enriched
responses as a table, then every evaluation table from it, each timed on its second run.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from askgauge.functions.text import clean_text, tidy_spaces  # noqa: E402
from askgauge.operators import cleaning, prompting, quality  # noqa: E402
from askgauge.operators.enrich import enrich_responses  # noqa: E402
from askgauge.operators.scoring import grade_responses  # noqa: E402
from askgauge.operators.staging import stage_questions, stage_responses  # noqa: E402
from askgauge.plans import marts, reports, warehouse  # noqa: E402
from askgauge.sources import derived, files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session(home):
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("askgauge-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        # Tables written in few partitions need no sort by partition first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    home = tempfile.mkdtemp(prefix="askgauge-bench-")
    spark = session(home)
    files.write_clean_questions(derived.questions(spark, SF_DIR), f"{home}/questions")
    files.append_responses(derived.responses(spark, SF_DIR), f"{home}/responses")
    questions = files.read_clean_questions(spark, f"{home}/questions")
    responses = files.read_responses(spark, f"{home}/responses")
    repeated = derived.repeated_raw_questions(spark, SF_DIR)

    def graded():
        return grade_responses(stage_responses(responses))

    def build():
        warehouse.build(spark, questions, responses, silver="bench_silver", gold="bench_gold", parallel=8)

    def gold(name):
        return warehouse.load_mart(spark, name, gold="bench_gold")

    def mart(make):
        return lambda: make(spark.table("bench_silver.int_responses_enriched")).collect()

    queries = {
        "build": build,
        "grade_responses": lambda: consume(graded()),
        "enriched": lambda: consume(enrich_responses(graded(), stage_questions(questions))),
        **{name.removeprefix("mart_"): mart(make) for name, make in marts.MART_BUILDERS.items()},
        "clean_questions": lambda: consume(cleaning.clean_questions(repeated, "seq")),
        "contract_silver": lambda: quality.check_clean_questions(questions).collect(),
        "clean_text_documents": lambda: consume(
            derived.table(spark, SF_DIR, "documents").select("doc_id", tidy_spaces(F.col("text")))
        ),
        "clean_html_pages": lambda: consume(
            derived.table(spark, SF_DIR, "pages").select("page_id", clean_text(F.col("html")))
        ),
        "seeded_permutation": lambda: consume(prompting.seeded_permutation(questions.select("question_id"), (42,))),
        "remaining_work": lambda: consume(
            prompting.remaining_work(
                prompting.work_list(
                    derived.run_config(spark, SF_DIR).select("run_id", "sample_seed"),
                    questions.select("question_id"),
                ),
                responses,
            )
        ),
        "volumes": lambda: reports.volumes(gold("mart_leaderboard"), gold("mart_question_insights")).collect(),
        "difficulty_crosstab": lambda: reports.difficulty_crosstab(gold("mart_question_insights")).collect(),
        "family_rollup": lambda: reports.family_rollup(gold("mart_perf_by_category")).collect(),
    }
    seconds = {}
    for name, run in queries.items():
        run()
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "responses": responses.count(),
                "responses_per_second_build": round(responses.count() / seconds["build"]),
            }
        )
    )


def duckdb_main():
    import duckdb

    from askgauge.oracles import BLOCKS, oracle

    con = duckdb.connect()
    con.execute(f"SET TimeZone = 'UTC'; SET threads = {CPUS}")
    for name in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    statements = {"grade_responses": oracle("SELECT * FROM graded", "graded"), "enriched": oracle("SELECT * FROM enr", "enr")}
    seconds = {}
    for name, statement in statements.items():
        for _ in range(2):
            started = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TABLE bench_{name} AS {statement}")
            seconds[name] = round(time.perf_counter() - started, 3)
    BLOCKS["enr"] = ("SELECT * FROM bench_enriched", ())
    for name in marts.MART_BUILDERS:
        for _ in range(2):
            started = time.perf_counter()
            con.execute(oracle(f"SELECT * FROM {name}", name)).fetchall()
            seconds[name.removeprefix("mart_")] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    duckdb_main() if "--duckdb" in sys.argv else main()
