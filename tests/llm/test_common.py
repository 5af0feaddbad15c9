import os
import subprocess
import sys

from pyspark.sql import functions as F

from askgauge.llm import common

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from askgauge.llm import simhash
df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
print("FP", simhash.with_fingerprints(df).first()["fp"])
"""


def test_workers_know_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "FP " in done.stdout, done.stderr[-2000:]


def test_scratch_is_beside_the_checkpoints_or_in_the_warehouse(spark):
    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.sql.warehouse.dir": "file:/w"}.get(key, default)

    class Unset:
        conf = Conf

    assert common.shared_dir(Unset) == "file:/w/_scratch"


def test_words_split_on_six_spaces_only(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a\x0bb\r\nc\xa0d e "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", common.words(F.col("t")).alias("w")).collect()}
    assert got == {0: [], 1: [], 2: [], 3: ["a"], 4: ["a", "b", "c\xa0d e"]}


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2)], "fp long, _FP long")
    assert common.unused(df, "fp") == "__fp" and common.unused(df, "x") == "x"


def test_remainders(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in (None, 0, 7, 123456789)], "k long")
    for r in df.select("k", common.remainder(F.col("k"), 7).alias("m"), common.is_held_out(F.col("k"), 7).alias("o")).collect():
        want = None if r["k"] is None else zlib.crc32(str(r["k"]).encode()) % 7
        assert r["m"] == want and r["o"] == (want == 2)
