
from conftest import ts
from eventide.sources import (parse_access_log, parse_ad_click, parse_login, parse_order, parse_receipt,
                              parse_user_behavior)
from eventide.sources.connectors import kafka_options


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_order_lines_keep_empty_tx_id(spark):
    p = parse_order(lines(spark, "501,create,,1700000000", "501,pay,tx9,1700000100", "oops", "x,pay,tx,1"))
    got = sorted(tuple(r) for r in p.rows.collect())
    assert got == [(501, "create", "", ts("2023-11-14 22:13:20")), (501, "pay", "tx9", ts("2023-11-14 22:15:00"))]
    assert p.rejects.count() == 2
    reasons = {r.reason for r in p.rejects.collect()}
    assert reasons == {"expected 4 fields", "bad order_id"}


def test_user_behavior_and_extra_fields(spark):
    p = parse_user_behavior(lines(spark, "1,22,3,pv,1511658000", "1,22,3,pv,1511658000,extra", "1,22,x,pv,1"))
    assert p.rows.count() == 2
    assert p.rows.schema["category_id"].dataType.simpleString() == "int"
    assert p.rejects.count() == 1


def test_access_log_time_and_fields(spark):
    p = parse_access_log(lines(spark, "83.149.9.216,u7,-,17/05/2015:10:05:43,+0000,GET,/present.css",
                               "1.2.3.4,u8,-,99/99/2015:10:05:43,+0000,GET,/x", "short,line"))
    r = p.rows.collect()
    assert len(r) == 1 and r[0].ts == ts("2015-05-17 10:05:43") and r[0].url == "/present.css"
    assert r[0].user_id == "u7" and r[0].method == "GET"
    assert p.rejects.count() == 2


def test_login_ad_receipt(spark):
    assert parse_login(lines(spark, "9,10.0.0.1,fail,1558430832")).rows.first().login_state == "fail"
    assert parse_ad_click(lines(spark, "5,7,beijing,beijing,1511658000")).rows.first().ad_id == 7
    assert parse_receipt(lines(spark, "ab12,alipay,1558430844")).rows.first().pay_channel == "alipay"


def test_kafka_option_map():
    o = kafka_options("h:9092", "hotitems", "consumer-group")
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "hotitems", "startingOffsets": "latest",
                 "kafka.group.id": "consumer-group"}


def test_publish_writer_and_side_outputs(spark):
    from eventide.sources.connectors import publish_lines_writer
    from eventide.streaming.sinks import SideOutputs
    lines = spark.createDataFrame([("a,b",), ("c,d",)], "value string")
    w = publish_lines_writer(lines, "h:9092", "hotitems")
    assert w is not None  # building the writer needs no connector jar; save() would
    tagged = spark.createDataFrame([(1, "main"), (2, "late"), (3, "main")], "seq long, channel string")
    outs = SideOutputs.of(tagged, ["main", "late"])
    assert sorted(r.seq for r in outs["main"].collect()) == [1, 3]
    assert outs["late"].columns == ["seq"]


def test_numbers_outside_the_calendar_are_rejects(spark):
    for parse, line in ((parse_user_behavior, "1,2,3,pv,{}"), (parse_ad_click, "1,2,p,c,{}"), (parse_login, "1,ip,fail,{}"),
                        (parse_order, "1,pay,t,{}"), (parse_receipt, "t,ali,{}")):
        p = parse(lines(spark, *(line.format(x) for x in ("1511658000", "1511658000000", "9223372036854775807",
                                                          "-99999999999999", "99999999999999999999"))))
        assert p.rows.count() == 1 and {r.reason for r in p.rejects.collect()} == {"bad ts"}
        assert p.rejects.count() == 4


def test_access_log_time_does_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:  # 02:30 on 10 March 2024 does not exist there
        rows = parse_access_log(lines(spark, "i,u,-,10/03/2024:02:30:00,-,GET,/x")).rows
        assert rows.selectExpr("cast(ts as string) as t").first().t == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
