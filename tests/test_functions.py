from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from callmill.functions import text as T
from callmill.functions import urls as U


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("co-\nordinated", "coordinated"), ("a-b-c-d", "abcd"), ("‘x’ “y”", "'x' \"y\""), ("a – b", "a - b"), ("so­ft", "soft"), (" a  b\u001cc\u0085d ", "a b c d"),
        ("end-\n  of", "endof"), ("", ""), (None, None), ("é-é", "éé"), ("- x -", "- x -"),
    ],
)
def test_normalize_quote(spark, given, wanted):
    assert one(spark, given, T.normalize_quote) == wanted


def test_nfkc_and_tokens(spark):
    assert one(spark, "ﬁne ½ plain", T.normalize_quote) == "fine 1⁄2 plain"
    assert one(spark, None, T.nfkc) is None and one(spark, "plain", T.nfkc) == "plain"
    assert one(spark, ["ﬁ-x", None, "a"], T.normalize_spans, "array<string>") == ["fix", None, "a"]
    assert one(spark, ["a-b"], T.normalize_spans, "array<string>") == ["ab"] and one(spark, None, T.normalize_spans, "array<string>") is None
    assert one(spark, "they were has", T.meaningful_tokens) == ["they", "has"]
    assert one(spark, "The Fund-of and 12a x1 fund", T.meaningful_tokens) == ["fundof", "12a", "fund"]
    assert one(spark, None, T.meaningful_tokens) == []


@pytest.mark.parametrize(("given", "wanted"), [("Été & Co. 3", "t-co-3"), ("", "source"), (None, "source"), ("--", "source")])
def test_slugify(spark, given, wanted):
    assert one(spark, given, T.slugify) == wanted


def test_markup(spark):
    page = "<img><IMG src=x><image><figure><figcaption></figure><svg>" * 2
    counts = one(spark, page, T.markup_counts)
    assert counts == {"img": 4, "svg": 2, "canvas": 0, "figure": 2}
    assert one(spark, {"img": 4, "figure": 1, "svg": 90}, T.visual_heavy, "map<string,int>") is True
    assert one(spark, {"img": 3, "svg": 40}, T.visual_heavy, "map<string,int>") is False


@pytest.mark.parametrize(
    ("locator", "page", "specific"),
    [("p.2-5", 2, False), ("map 3", 3, False), ("p. 4 - table 5", 4, True), ("p.9 — view grid", 9, True), ("char:0-10", None, False), ("P.7", 7, False), ("overview", None, True), (None, None, False), ("", None, False)],
)
def test_locator(spark, locator, page, specific):
    assert one(spark, locator, T.cited_page) == page
    assert one(spark, locator, T.visual_locator) is specific


def test_leaf_overlap(spark):
    y = spark.sql("SELECT 'Gold and Silver Mining Inc' l, 'Goldmine output, silver up' e").select(T.leaf_overlap(F.col("l"), F.col("e")).alias("n"), T.leaf_overlap(F.lit(None).cast("string"), F.col("e")).alias("z")).first()
    assert (y.n, y.z) == (2, 0)
    assert one(spark, 25.0, T.format_number, "double") == "25"
    for given in (0.86, 12.3456789, 1234567.5, 100000.0, 999999.9, 0.0001, 0.00001234, 0.0, -3.10, 123456.0, 2e16, 1.0000004, 30.0):
        assert one(spark, given, T.format_number, "double") == f"{given:g}"
    assert one(spark, None, T.format_number, "double") is None
    assert one(spark, "```json\n{\"a\":1}\n```", T.fenced_json) == '{"a":1}'
    assert one(spark, "{{a}} {{b}}", lambda x: T.fill_template(x, {"a": F.lit("{{b}}"), "b": F.lit("c")})) == "c c"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("https://x.example/a?utm_source=m&b=1&gclid=2#t", "https://x.example/a?b=1#t"), ("https://x.example/a?UTM_x=1", "https://x.example/a"), ("https://x.example/a", "https://x.example/a"),
        ("https://x.example/a?b=1&c=2&b=3", "https://x.example/a?b=1&b=3&c=2"), ("https://x.example/a?b=", "https://x.example/a?b="), ("https://x.example/a?b=%2A~", "https://x.example/a?b=%2A~"),
        ("https://x.example/?q=100%&b=2", "https://x.example/?q=100%25&b=2"), ("https://x.example/?q=%41%zz&gclid=1", "https://x.example/?q=A%25zz"),
        ("read://https_x/?url=https%3A%2F%2Fx.example%2Fp.pdf%3Ffbclid%3D1", "https://x.example/p.pdf"), ("https://y.seismic.com/aPLUSSIGNb___c", "https://y.seismic.com/a+b/c"), (None, None), ("", ""), ("no url at all", "no url at all"),
    ],
)
def test_resolve_url(spark, given, wanted):
    assert one(spark, given, U.resolve_url) == wanted


def test_source_type(spark):
    assert one(spark, "https://x.example/A.PDF?y=1", U.source_type) == "pdf"
    assert one(spark, "https://x.example/a?f=b.pdf", U.source_type) == "html"
    assert one(spark, "https://files.pdf", U.source_type) == "html"
