import pytest
from pyspark.sql import functions as F

from folioline.functions import urls as U
from folioline.operators import lookup
from folioline.schema import INVALID_URL

GOOD = ("https://juris.bundesgerichtshof.de/cgi-bin/rechtsprechung/document.py?Gericht=bgh&Art=en&Datum=2021"
        "&Seite=98&nr=117424&anz=3571&pos=2950&Blank=1.pdf")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def param(spark, url, key="a"):
    return spark.createDataFrame([(url,)], "u string").select(U.query_param(F.col("u"), key)).first()[0]


def test_path_of_good_url(spark):
    assert one(spark, U.path_from_url(F.lit(GOOD))) == "judgements/bgh/2021/117424_3571_2950.pdf"


@pytest.mark.parametrize("missing", ["Gericht=bgh&", "Datum=2021&", "nr=117424&", "anz=3571&", "pos=2950&"])
def test_missing_parameter_is_rejected(spark, rows, missing):
    links = spark.createDataFrame([(GOOD.replace(missing, ""),), (GOOD,)], "link string")
    good, bad = lookup.with_path(links)
    assert rows(good, "link") == [(GOOD,)]
    assert rows(bad) == [(GOOD.replace(missing, ""), "path", INVALID_URL)]


@pytest.mark.parametrize("url, value", [
    ("http://h/p?a=1&a=2", "1"),
    ("http://h/p?b=1", ""),
    ("http://h/p", ""),
    ("http://h/p?xa=1", ""),
    ("http://h/p?a=x%20y+z", "x y z"),
    ("http://h/p?a=%zz&a=5", "5"),
    ("http://h/p?a=1;2&a=3", "3"),
    ("http://h/p?a&a=2", ""),
    ("http://h/p?a=&a=2", ""),
    ("http://h/p#f?a=1", ""),
    ("http://h/p?a=1#f&a=2", "1"),
    ("http://h/p?x=?a=1", ""),
    ("http://h/p?b=2&a=%C3%BC", "ü"),
    ("http://h/p?a=b=c", "b=c"),
    (None, ""),
])
def test_query_param(spark, url, value):
    assert param(spark, url) == value


@pytest.mark.parametrize("url, bad", [
    ("http://h/%zz?a=1", True), ("http://h/x?a=%zz", False), ("http://h /x", True), ("http://h/x y", False),
    (":x", True), ("http://h/x\n", True), ("http://h/x#%g", True), ("/x?a=1", False)])
def test_malformed(spark, url, bad):
    assert spark.createDataFrame([(url,)], "u string").select(U.is_malformed(F.col("u"))).first()[0] is bad


def test_listing_url(spark):
    base = "https://juris.bundesgerichtshof.de/cgi-bin/rechtsprechung/list.py?Art=en&Datum=2024&Gericht=bgh"
    assert one(spark, U.listing_url(F.lit(2024), F.lit(1))) == base
    assert one(spark, U.listing_url(F.lit(2024), F.lit(3))) == base + "&Seite=3"


def test_host(spark, rows):
    df = spark.createDataFrame(
        [("https://User:pw@EXAMPLE.org:80/x",), ("example.org/x",), ("https://evil.org/?x=https://good.org/",)], "u string")
    assert [r[0] for r in df.select(U.host(F.col("u"))).collect()] == ["example.org", None, "evil.org"]
    assert [r[0] for r in df.select(U.allowed_host(F.col("u"), ["good.org", "Example.org"])).collect()] == [True, False, False]
