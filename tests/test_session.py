from tessera.session import cut, shared_folder, table


def test_folder_of_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir").split("/")[-1] in shared_folder(spark)
    df = spark.range(10)
    assert cut(df).count() == 10


def test_table_reads_a_file_or_a_folder(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").count() == 5


def test_package_reaches_executors_from_elsewhere(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tessera.operators.packing import next_fit
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", 2).config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
print("rows", next_fit(s.range(9), ["id"], "id", 10).agg({{"shard_no": "max"}}).first()[0])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, cwd=tmp_path, env=env)
    assert said.stdout.split() == ["rows", "4"], said.stderr[-800:]
