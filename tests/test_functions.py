from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.functions.jsontext import (
    field_scalar,
    has_object_id,
    is_json_array,
    json_elements,
    json_objects,
    object_id,
)
from clickloom.functions.labels import crawl_outcome, metal_type, payment_label, stone_type
from clickloom.functions.network import address_position
from clickloom.functions.numbers import inside, safe_divide, safe_integer, safe_numeric
from clickloom.functions.temporal import date_key, epoch_date, epoch_timestamp, week_from_sunday
from clickloom.functions.text import packed_id, page_name, squeeze, unpacked_id


def values(spark, inputs, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_scalar_is_null_for_containers_only(spark):
    lines = ['{"id":{"v":1}}', '{"id":[1]}', '{"id":"7"}', '{"id":7}', '{"id":null}', "{}", "5", '{"id":"{x"}', '{"id":"[1]"}']
    carts = [f"[{line}]" for line in lines]
    got = values(spark, carts, lambda c: field_scalar(json_objects(c, ["id"])[0], "id"))
    assert got == [None, None, "7", "7", None, None, None, "{x", "[1]"]


def test_fields_are_the_first_of_their_key_as_sent(spark):
    line = '{"a":1.25,"a":2,"b":123456789012345678901234567890,"c":2.0,"d":true,"e":" x","f":{"y": 1}}'
    cart = f'[{line},5,"s",[1],null,{{}}]'
    element = lambda c: json_objects(c, list("abcdefz"))
    for name, want in zip("abcdez", ["1.25", "123456789012345678901234567890", "2.0", "true", " x", None]):
        assert values(spark, [cart], lambda c, n=name: element(c)[0][n]) == [want]
    for k in range(1, 6):
        assert values(spark, [cart], lambda c, k=k: element(c)[k]["a"]) == [None]


def test_only_arrays_have_elements(spark):
    carts = ['[{"a":1},5,null]', '{"a":1}', "[]", None, "no json", ' [1] ']
    assert values(spark, carts, lambda c: F.size(json_elements(c))) == [3, None, 0, None, None, 1]
    assert values(spark, carts, is_json_array) == [True, False, True, None, False, True]


def test_object_id(spark):
    ids = ['{"$oid":"ab12"}', '{"$oid": {"x":1}}', '{"oid":"x"}', "ab12", None, 'x "$oid" : "cd" x']
    assert values(spark, ids, object_id) == ["ab12", None, None, None, None, "cd"]
    assert values(spark, ids, has_object_id) == [True, False, False, False, None, True]


def test_safe_casts(spark):
    numbers = ["12", "2.0", "1e3", "1,234.5", "", None, " 7 ", "0.1234567895"]
    assert values(spark, numbers, safe_integer) == [12, None, None, None, None, None, 7, None]
    as_text = values(spark, numbers, lambda c: safe_numeric(c).cast("string"))
    assert as_text == ["12.000000000", "2.000000000", "1000.000000000", None, None, None, "7.000000000", "0.123456790"]


def test_safe_divide_and_range(spark):
    df = spark.sql("select cast(10 as decimal(38,9)) a, 3L b, 0L z")
    row = df.select(safe_divide(F.col("a"), F.col("b")).cast("string"), safe_divide(F.col("a"), F.col("z"))).first()
    assert row[0] == "3.333333333" and row[1] is None
    assert values(spark, [-90.0, 90.5, None], lambda c: inside(c, -90, 90), "double") == [-90.0, None, None]


def test_epoch_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = [1704067200, 1704067199, -1, None]
        assert values(spark, seconds, epoch_date, "bigint") == [date(2024, 1, 1), date(2023, 12, 31), date(1969, 12, 31), None]
        assert values(spark, seconds[:1], epoch_timestamp, "bigint") == [datetime(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_week_from_sunday_matches_strftime(spark):
    days = [date(1995, 1, 1) + timedelta(days=i) for i in range(0, 4000)]
    assert values(spark, days, week_from_sunday, "date") == [int(d.strftime("%U")) for d in days]
    assert values(spark, days[:1], date_key, "date") == [19950101]


def test_labels(spark):
    names = ["Ring 750 Silver", "silver 14K", "Plain", None, "PLATINUM ruby", "Cubic Zirconia emerald"]
    assert values(spark, names, metal_type) == [
        "18K Gold - 750", "14K Gold - 585", "Not Defined", "Not Defined", "Platinum - 950", "Not Defined"]
    assert values(spark, names, stone_type) == ["Not Defined"] * 4 + ["Ruby", "Zirconia"]
    flags = ["TRUE", "1", "yes", "False", "0", "no", None, "maybe", ""]
    assert values(spark, flags, payment_label) == ["paypal"] * 3 + ["other"] * 3 + ["unknown"] * 3


def test_crawl_outcome(spark):
    log = [(403, None, None), (500, None, None), (200, "", None), (200, "Ring", None), (None, None, "ReadTimeout"), (503, "x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(log)], "i int, s bigint, n string, e string")
    got = df.select("i", crawl_outcome(F.col("s"), F.col("n"), F.col("e")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == ["blocked_403", "http_500", "no_name_found", None, "request_error:ReadTimeout", "blocked_503"]


def test_squeeze(spark):
    assert values(spark, ["  a \t\n b ", " x y ", "", None], squeeze) == ["a b", "x y", "", None]


def test_page_name(spark):
    pages = [
        '<meta content="Social &amp; Co" property="og:title"><title>T</title>',
        "<head><TITLE>\n Big &lt;Ring&gt; </TITLE></head><h1>H</h1>",
        "<title> </title><h1 class='x'>One <b>two</b>&nbsp;</h1><h1>no</h1>",
        "<title>&nbsp;</title><h1></h1>",
        "<!-- <title>hidden</title> --><script>var t='<title>x</title>';</script><h1>Shown</h1>",
        '<meta property="og:title" content=""><title>Fallback</title>',
        None,
    ]
    assert values(spark, pages, page_name) == ["Social & Co", "Big <Ring>", "One two", None, "Shown", "Fallback", None]


@pytest.mark.parametrize(
    "ip, position",
    [
        ("1.2.3.4", "0" * 20 + "ffff" + "01020304"),
        ("255.255.255.255", "0" * 20 + "ffff" + "ffffffff"),
        ("1.2.3.256", None),
        ("2001:db8::1", "20010db8" + "0" * 23 + "1"),
        ("2001:DB8:1:2:3:4:5:6", "20010db8000100020003000400050006"),
        ("::", "0" * 32),
        ("::1", "0" * 31 + "1"),
        ("fe80::", "fe80" + "0" * 28),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_address_position(spark, ip, position):
    assert values(spark, [ip], address_position) == [position]


def test_packed_ids(spark):
    ids = ["", "0a", "0A", "0", "6566", "ef", "65efg", "\u00e9", "f" * 24, None]
    got = spark.createDataFrame([(i,) for i in ids], "id string").select("id", packed_id(F.col("id")).alias("packed"))
    back = got.select("id", "packed", unpacked_id(F.col("packed")).alias("back")).collect()
    assert [r.back for r in back] == ids and len({r.packed and bytes(r.packed) for r in back}) == len(ids)
    assert len(back[-2].packed) == 13
