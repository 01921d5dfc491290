"""Domain, URL and name functions on the reference's own cases."""

import pytest
from pyspark.sql import functions as F

from conftest import col
from searchlake.functions import domains as G

CLEAN = [
    ("example.com", "example.com"), ("https://example.com", "example.com"),
    ("http://example.com", "example.com"), ("www.example.com", "example.com"),
    ("https://www.example.com/path/page?q=1#hash", "example.com"), ("example.com/", "example.com"),
    ("https://example.com/a/b/c/", "example.com"), ("", ""), ("   ", ""),
    ("  example.com  ", "example.com"), ("HTTPS://WWW.EXAMPLE.COM", "example.com"),
    ("https://", ""), ("example.com:8080", "example.com"), ("ftp://example.com", "example.com"),
    ("https://https://example.com", "https"), ("sub.example.com", "sub.example.com"),
    ("example.com?q=1", "example.com"),
]

NAMES = [
    ("example.com", "Example"), ("harbourtours.com.au", "Harbourtours"),
    ("my-cool-site.com", "My Cool Site"), ("my_site.com", "My Site"), ("192.168.1.1", "192"),
    ("localhost", "Localhost"), ("", ""), (".com", ""), ("a1b-site.com", "A1B Site"),
]


def test_clean_domain(spark):
    df = col(spark, [c for c, _ in CLEAN]).select("s", G.clean_domain(F.col("s")).alias("o"))
    got = {r.s: r.o for r in df.collect()}
    for raw, want in CLEAN:
        assert got[raw] == want, raw


def test_clean_domain_keep_path(spark):
    cases = [("https://www.shopfront.com/fw/", "shopfront.com/fw"),
             ("HTTP://Example.com:8080/a/b?x=1#f", "example.com/a/b"), ("example.com", "example.com")]
    df = col(spark, [c for c, _ in cases]).select("s", G.clean_domain_keep_path(F.col("s")).alias("o"))
    got = {r.s: r.o for r in df.collect()}
    for raw, want in cases:
        assert got[raw] == want


def test_normalizers_differ_on_case(spark):
    df = col(spark, ["HTTPS://WWW.X.com/", " https://www.y.com// ", None])
    out = df.select(G.normalize_domain_sql(F.col("s")).alias("a"),
                    G.normalize_domain_review(F.col("s")).alias("b")).collect()
    assert out[0].a == "https://www.x.com" and out[0].b == "x.com"
    assert out[1].b == "y.com"
    assert out[2].a is None and out[2].b == ""


def test_domain_to_name(spark):
    df = G.domain_to_name(col(spark, [c for c, _ in NAMES]), "s", G.suffix_rules(spark), "o")
    got = {r.s: r.o for r in df.collect()}
    for raw, want in NAMES:
        assert got[raw] == want, raw


@pytest.mark.parametrize("url,dom,path", [
    ("https://blog.example.co.uk/a/b?x=1", "example.co.uk", "/a/b"),
    ("http://example.com", "example.com", "/"),
    ("https://foo.eu/x", "foo.eu", "/x"),
    ("https://shop.foo.co.il/", "foo.co.il", "/"),
    ("https://a.foo.com.tr/", "foo.com.tr", "/"),
    ("https://a.b.x.ck/", "b.x.ck", "/"),
    ("https://a.www.ck/", "www.ck", "/"),
    ("https://a.city.kawasaki.jp/", "city.kawasaki.jp", "/"),
    ("https://a.b.c.kawasaki.jp/", "b.c.kawasaki.jp", "/"),
    ("https://a.b.pvt.k12.ma.us/", "b.pvt.k12.ma.us", "/"),
    ("https://co.uk/", ".co.uk", "/"),
    ("https://10.0.0.1/", "10.0.0.1.", "/"),
    ("https://a.nosuchtld/", "nosuchtld.", "/"),
    ("https://user@shop.example.com.au:8443/p#top", "example.com.au", "/p"),
])
def test_registered_domain_and_path(spark, url, dom, path):
    r = G.registered_domain(col(spark, [url]), "s", G.suffix_rules(spark), "d").withColumn("p", G.url_path(F.col("s"))).first()
    assert (r.d, r.p) == (dom, path)


def test_endpoint_slug(spark):
    u = "https://api.x.com/v3/serp/google/organic/task_get/0b1a2c3d-4e5f-4a6b-8c7d-9e0f1a2b3c4d/extra"
    cases = [(u, "serp-google-organic-task_get"),
             ("https://api.x.com/v3/backlinks/backlinks/live", "backlinks-backlinks-live"),
             ("https://api.x.com/v3/", "unknown")]
    df = col(spark, [c for c, _ in cases]).select("s", G.endpoint_slug(F.col("s")).alias("o"))
    got = {r.s: r.o for r in df.collect()}
    for raw, want in cases:
        assert got[raw] == want


def test_project_domain_name(spark):
    r = col(spark, ["parkside.com.au_001", "plain"]).select(G.project_domain_name(F.col("s")).alias("o"))
    assert [x.o for x in r.collect()] == ["parkside.com.au", "plain"]


def test_missing_suffix_data_is_an_error(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("// nothing\n")
    with pytest.raises(ValueError):
        G.suffix_rules(spark, str(tmp_path / "empty.txt"))
    with pytest.raises(FileNotFoundError):
        G.suffix_rules(spark, str(tmp_path / "none.txt"))
    with pytest.raises(ValueError):
        G.domain_to_name(col(spark, ["a.com"]), "s", G.suffix_rules(spark).limit(0))
