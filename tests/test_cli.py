import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from eventide.__main__ import main
from eventide.plans import QUERIES
from eventide.sources import Fixtures
from eventide.sources.parsers import parse_login


def test_batch_command_writes_query_result(spark, tmp_path):
    out = str(tmp_path / "hot")
    assert main(["batch", "hot_items", "--sf-dir", SF_SMALL, "--out", out]) == 0
    assert rows(spark.read.parquet(out)) == rows(QUERIES["hot_items"](spark, SF_SMALL))


def test_parser_passes_extra_columns(spark):
    lines = spark.createDataFrame([("7,10.0.0.1,fail,1558430832", 5)], "value string, seq long")
    r = parse_login(lines).rows.first()
    assert r.seq == 5 and r.login_state == "fail"


def test_stream_command_on_text_lines(spark, tmp_path):
    lg = Fixtures(spark, SF_SMALL).login
    lines = lg.select(F.concat_ws(",", "user_id", "ip", "login_state",
                                  F.expr("cast(cast(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' as interval second) as bigint)")
                                  .cast("string")).alias("value"))
    src = str(tmp_path / "lines")
    lines.coalesce(1).write.text(src)
    with open(os.path.join(src, "zz-flush.txt"), "w") as f:
        f.write("999999,x,success,1924992000\n")
    out = str(tmp_path / "runs")
    assert main(["stream", "login_fail_runs", "--source", f"login={src}", "--format", "text", "--sink", "parquet",
                 "--out", out, "--checkpoint", str(tmp_path / "ck"), "--once"]) == 0
    got = spark.read.parquet(out)
    assert got.count() > 0
