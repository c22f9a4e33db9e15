"""Character models of URLs against dictionaries, and the cases in which they are easily lost."""

import random

import pytest

from ledgerloom.llm import url_model
from tests.llm import plain


def compare(df, urls):
    got = {r.page_id: r for r in url_model.filter_urls(df).collect()}
    assert len(got) == len(urls)
    for i, (verdict, score) in enumerate(plain.url_verdicts(urls)):
        assert got[i].verdict == verdict, urls[i]
        assert got[i].score == (None if score is None else pytest.approx(score, abs=1e-8)), urls[i]
    return got


def test_like_dictionaries(spark):
    """Real characters beyond ASCII, marks in the text, repeated and empty URLs, a very long one, clashing columns."""
    r = random.Random(5)
    part = lambda: "".join(r.choice("ab_%=?&é漢\U0001f600\x02.-/7") for _ in range(r.randrange(1, 14)))
    hosts = ["x.example.net/en/", "b.net/", "example.com/de/", "c.org/fr/", "free.io/", "例.jp/"]
    urls = [f"http://{r.choice(hosts)}{part()}" for _ in range(220)]
    urls += urls[:20] + [None, "", "://", "no scheme", "http://free.io/" + "ab/" * 30_000]
    rows = [(i, u, i, "g", i) for i, u in enumerate(urls)]
    compare(spark.createDataFrame(rows, "page_id bigint, url string, `_row` int, gram string, half int"), urls)


def test_one_site_holds_all_allowed(spark):
    r = random.Random(3)
    urls = [f"http://one.example.net/en/story-{r.randrange(10**6)}" for _ in range(200)] + [f"http://junk{k}.net/pills{r.randrange(10**6)}" for k in range(200)]
    urls += [f"http://junk{k}.info/pills{r.randrange(10**6)}" for k in range(50)]
    got = compare(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), urls)
    assert {got[i].verdict for i in range(400, 450)} == {"block"}


def test_long_contexts_decide(spark):
    """Only five characters back do the two verdicts differ."""
    r = random.Random(8)
    tail = lambda first, last: f"{first}-----{last}"
    urls = [f"http://a.example.net/en/{tail(*p)}" for p in r.choices([("x", "1"), ("y", "2")], k=400)]
    urls += [f"http://a.net/en/{tail(*p)}" for p in r.choices([("x", "2"), ("y", "1")], k=400)]
    urls += [f"http://a.io/en/{tail(*p)}" for p in (("x", "1"), ("y", "2"), ("x", "2"), ("y", "1"))]
    got = compare(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), urls)
    assert min(got[800].score, got[801].score) > max(got[802].score, got[803].score)


def test_one_verdict_only(spark):
    urls = ["http://x.net/a", "http://y.net/b", "http://z.io/c", ""]
    got = url_model.filter_urls(spark.createDataFrame([*enumerate(urls), (None, "http://z.io/d")], "page_id bigint, url string")).collect()
    assert sorted((r.page_id is None, r.page_id, r.verdict) for r in got if r.page_id is not None) == [(False, 0, "block"), (False, 1, "block"), (False, 2, "allow"), (False, 3, "block")]
    assert [r.verdict for r in got if r.page_id is None] == ["allow"]
