from tessera.plans import catalogue
from tessera.sources import files


def test_line_ends(spark):
    lines = ["aa  v/a.mp4", "bb  v/b.mp4\r", "cc  v/c.mp4\r\n", "dd  v/d\re.mp4\r", "ee  v/ e  f.mp4", "  g\r", "no blanks\r"]
    got = {(r["sha256"], r["file_name"]) for r in files.manifest_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {("aa", "v/a.mp4"), ("bb", "v/b.mp4"), ("cc", "v/c.mp4"), ("dd", "v/d\re.mp4"), ("ee", "v/ e  f.mp4"), ("", "g")}


def test_query_takes_every_row(spark, tmp_path):
    held = [(1, "v/a.mp4", "aa"), (2, "v/b.mp4\r", "bb"), (3, None, "cc"), (4, "v/d.mp4\r", None)]
    spark.createDataFrame(held, "line_no long, file_name string, sha256 string").write.parquet(f"{tmp_path}/checksums.parquet")
    got = {(r["sha256"], r["file_name"]) for r in catalogue.queries()["checksum_manifest"](spark, str(tmp_path)).collect()}
    assert got == {("aa", "v/a.mp4"), ("bb", "v/b.mp4"), ("cc", ""), ("", "v/d.mp4")}
