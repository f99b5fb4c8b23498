
from eventide.functions import bitmap_offset, equals_value, is_static_asset, non_empty, not_equals_null_safe


def test_behavior_predicates_null_semantics(spark):
    df = spark.createDataFrame([("pv",), (None,), ("UNINSTALL",), ("CLICK",)], "b string")
    assert df.filter(equals_value("b", "pv")).count() == 1
    kept = sorted(str(r.b) for r in df.filter(not_equals_null_safe("b", "UNINSTALL")).collect())
    assert kept == ["CLICK", "None", "pv"]


def test_static_asset_urls(spark):
    urls = ["/a.css", "/a.js", "/a.png", "/favicon.ico", "/a.css?v=1", "", "/A.CSS", "/css", "/a.json"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    static = {r.url for r in df.filter(is_static_asset("url")).collect()}
    assert static == {"/a.css", "/a.js", "/a.png", "/favicon.ico"}


def test_non_empty_key(spark):
    df = spark.createDataFrame([("",), ("tx1",), (None,)], "t string")
    assert sorted(str(r.t) for r in df.filter(non_empty("t")).collect()) == ["None", "tx1"]


def py_offset(uid, cap=1 << 29, seed=43):
    h = 0
    for ch in str(uid):
        h = h * seed + ord(ch)
    return h & (cap - 1)


def test_bitmap_offset_matches_plain_fold(spark):
    ids = [0, 7, 543462, 99999, 1234567890123, 987654321987654321]
    df = spark.createDataFrame([(i,) for i in ids], "u bigint")
    for cap in (1 << 29, 1 << 6):
        got = {r.u: r.o for r in df.select("u", bitmap_offset("u", cap).alias("o")).collect()}
        # 64-bit wrap-around then mask == mask at every step
        assert got == {i: py_offset(i, cap) for i in ids}
