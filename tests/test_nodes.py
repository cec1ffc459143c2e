"""Node arrays: structure, selections and text."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kliping.functions import nodes as N
from kliping.rules.notation import at, every, having


def flat(spark, *htmls):
    pages = spark.createDataFrame([(k, h) for k, h in enumerate(htmls)], "k int, html string")
    return N.flatten_pages(pages)


def texts(spark, html, *steps, take="text"):
    steps_df = spark.createDataFrame([(0, list(steps))], f"k int, steps array<{N.STEP.simpleString()}>")
    nodes = F.col("nodes")
    found = N.select(nodes, N.root(nodes), F.col("steps"))
    row = flat(spark, html).join(steps_df, "k").select(F.transform(found, lambda n: N.value_of(nodes, n, F.lit(take))).alias("v")).first()
    return row.v


def test_implied_ends(spark):
    assert texts(spark, "<p><b>one<br><p>two</p>three", every("p")) == ["one", "two"]
    assert texts(spark, "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", every("li")) == ["a", "bc", "c", "d"]
    assert texts(spark, "<table><tr><td>1<td>2<tr><td>3</table>", every("td")) == ["1", "2", "3"]
    assert texts(spark, "<div><span><p>x</span>y</p>z</div>", at("p")) == ["xy"]


def test_unclosed_page(spark):
    assert texts(spark, "<article><p>x", at("article")) == ["x"]
    assert texts(spark, "", at("p")) == []
    assert flat(spark, None).select(F.size("nodes")).first()[0] == 1


def test_class_matching(spark):
    html = '<p class="b a">1</p><p class="a  b">2</p><p class="ab">3</p><p CLASS="a">4</p>'
    assert texts(spark, html, every("p", "a")) == ["1", "2", "4"]
    assert texts(spark, html, every("p", "a b")) == ["2"]


def test_picks_and_axes(spark):
    html = "<h1 class=t>T</h1> x <div><span>d1</span></div><div><span>d2</span></div><a>no</a><a href=''>yes</a>"
    assert texts(spark, html, at("span", pick=-1)) == ["d2"]
    assert texts(spark, html, at("span", pick=3)) == []
    assert texts(spark, html, at("span", pick=-3)) == []
    assert texts(spark, html, at("h1", "t"), at("*", axis="next"), at("span")) == ["d1"]
    assert texts(spark, html, having("a", "href")) == ["yes"]


def test_script_text_is_no_text(spark):
    html = "<div>a<script>var t='</p>';</script><style>p{}</style>b<!-- c -->d</div>"
    assert texts(spark, html, at("div")) == ["abd"]


def test_entities_and_attributes(spark):
    html = "<a href='/x?a=1&amp;b=2' title=\"&quot;q&quot;\">R&amp;D &#8211; &eacute;</a>"
    assert texts(spark, html, at("a"), take="href") == ["/x?a=1&b=2"]
    assert texts(spark, html, at("a")) == ["R&D – é"]


def joined(spark, html):
    nodes = F.col("nodes")
    return flat(spark, html).select(N.joined_text(nodes, F.get(nodes, 0), N.none_of(nodes))).first()[0]


def test_breaks_and_white_space(spark):
    assert joined(spark, "<p> one\xa0two<br>three <br/> <b> four </b> </p>five") == "one\xa0two threefourfive"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<br>", "<li>", "</ul>", "x", " ", "<td>", "<!--c-->", "< "]), max_size=25))
def test_subtrees_are_nested(parts):
    tokens = N._Tokens()
    tokens.page("".join(parts))
    n = len(tokens.tag)
    assert tokens.last[0] == n - 1
    for i in range(1, n):
        up = tokens.up[i]
        assert 0 <= up < i <= tokens.last[i] <= tokens.last[up]
    kept = [t for t in tokens.text if t]
    assert "".join(kept).count("x") == parts.count("x")
