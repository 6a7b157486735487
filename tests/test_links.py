from pyspark.sql import functions as F

from folioline.fixed import LINK_BASE
from folioline.functions import text as T
from folioline.operators import links as L
from folioline.plans.crawl import crawl, next_listings
from folioline.schema import NO_HREF

HOST = "https://juris.bundesgerichtshof.de/cgi-bin/rechtsprechung/list.py?Gericht=bgh&Art=en"


def row(chamber, *anchors):
    return f"<tr class=x><td>{chamber}</td><td>1.1.2024</td><td>{''.join(anchors)}</td></tr>"


def pdf(href):
    return f'<a class="doklink" href="{href}" type="application/pdf">PDF</a>'


LISTING = "".join([
    "<html><body><select name=j id=\"kaljahr\"><option value=1>2024</option><option selected>+5</option>",
    "<option> 7 </option><option>Jahr</option><option></option></select>",
    '<a href="list.py?Gericht=bgh&amp;Datum=2024&amp;Seite=12">last</a><a href="list.py?Seite=x">x</a>',
    '<a href="list.py?a=1?Seite=99">two marks</a><a href="other.py?Seite=77">other</a>',
    "<table><TR><th>Senat</th></TR>",
    row("I. Zivilsenat", '<a href="document.py?nr=0">html</a>', pdf("document.py?nr=1&amp;pos=1"), pdf("document.py?nr=9")),
    row(" \n<b>X. Zivilsenat</b>&nbsp;", pdf("document.py?nr=2")),
    row("II. Zivilsenat", pdf("document.py?nr=3")),
    row("X. Zivilsenat", '<a href="document.py?nr=4">no pdf</a>'),
    row("I. Zivilsenat", '<a type="application/pdf">no target</a>', pdf("document.py?nr=5")),
    "</table></body></html>",
])


def listings(spark):
    again = row("I. Zivilsenat", pdf("document.py?nr=2"))
    return spark.createDataFrame([
        (HOST + "&Datum=2024", LISTING), (HOST + "&Datum=2024&Seite=2", again),
        (HOST + "&Datum=2023", "<p>"), ("https://elsewhere.org/", LISTING.replace("nr=1", "nr=666"))], "url string, html string")


def test_crawl(spark, rows):
    done = crawl(listings(spark))
    assert rows(done.links) == [(f"{LINK_BASE}/document.py?nr=1&pos=1",), (f"{LINK_BASE}/document.py?nr=2",)]
    # a first anchor without a target counts as no link, as does a row without a typed anchor
    assert rows(done.rejects) == [(HOST + "&Datum=2024", "crawl", NO_HREF)] * 2


def test_years(spark, rows):
    assert rows(L.read_years(listings(spark))) == [(2024,), (5,)]


def test_parse_years(spark, rows):
    df = spark.createDataFrame([(["2024", "+5", " 7 ", "Jahr", "", "-3", "99999999999999999999", "5\n"],)], "t array<string>")
    assert rows(L.parse_years(df, "t")) == [(-3,), (2024,), (5,)]


def test_frontier(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, None), (5, -2)], "year int, n int")
    assert rows(L.listing_frontier(df, "n")) == [(2, 1), (3, 1), (3, 2), (3, 3)]
    assert rows(L.listing_frontier(df, "n", at_least_one=True)) == [
        (1, 1), (2, 1), (3, 1), (3, 2), (3, 3), (4, 1), (5, 1)]


def test_next_listings(spark, rows):
    found = next_listings(listings(spark))
    assert rows(found.where("year = 2023"), "page") == [(1,)]
    assert found.where("year = 2024").count() == 12
    assert next_listings(listings(spark), at_least_one=False).where("year = 2023").count() == 0
    assert found.where("year = 2024 and page = 2").first()["url"].endswith("Art=en&Datum=2024&Gericht=bgh&Seite=2")


def test_link_set(spark):
    numbers = spark.range(1000)
    assert L.distinct_links(numbers.select(F.format_string("https://example.com/%d", "id").alias("link"))).count() == 1000
    assert L.distinct_links(numbers.select(F.lit("https://example.com").alias("link"))).count() == 1


def test_union_and_counts(spark, rows):
    a = spark.createDataFrame([("x", "1"), ("x", "1"), ("y", "2")], "g string, link string")
    b = spark.createDataFrame([("z", "2"), ("z", "3")], "g string, link string")
    assert rows(L.union_links([a, b])) == [("1",), ("2",), ("3",)]
    assert rows(L.crawl_counts(a.union(b), "g")) == [(3, 5, 3)]
    assert rows(L.crawl_counts(a.limit(0), "g")) == [(0, 0, 0)]


def test_trim_space(spark):
    for space in T.WHITE_SPACE:
        df = spark.createDataFrame([(f"{space}a{space}b{space}{space}",)], "t string")
        assert df.select(T.trim_space(F.col("t"))).first()[0] == f"a{space}b"
        assert df.select(T.tokens(F.col("t"))).first()[0] == ["a", "b"]
    kept = "​a​"
    assert spark.createDataFrame([(kept,)], "t string").select(T.trim_space(F.col("t"))).first()[0] == kept
