import subprocess
import sys

from landledger.session import drop_scratch, materialize, scratch_path

CODE = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from landledger.session import materialize, drop_scratch
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
df = materialize(spark.range(5), "t")
assert df.count() == 5 and os.listdir(sys.argv[2]), os.listdir(sys.argv[2])
assert all(sys.argv[2] in f for f in df.inputFiles()), df.inputFiles()
drop_scratch(spark)
assert not any(name.startswith("landledger-") for name in os.listdir(sys.argv[2]))
"""


def test_named_checkpoint_folder_is_used(tmp_path):
    root = __file__.rsplit("/tests/", 1)[0]
    done = subprocess.run([sys.executable, "-c", CODE, root, str(tmp_path)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.createDataFrame([(1, None, [1.5]), (2, "x", None)], "a int, b string, c array<double>")
    kept = materialize(df)
    assert kept.dtypes == df.dtypes and kept.exceptAll(df).isEmpty() and kept.count() == 2
    empty = materialize(df.where("a > 5"))
    assert empty.isEmpty() and empty.dtypes == df.dtypes
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    drop_scratch(spark)
