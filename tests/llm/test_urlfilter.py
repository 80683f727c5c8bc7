import pytest

from triagelake.llm.urlfilter import (
    ALLOW, BLOCK, LISTED_HOSTS, RULES, DigestArray, build, filter_urls, op7_digest_array, parse)

CASES = {
    None: ("", ""), "": ("", ""), "no-scheme.example.net/en/": ("", ""), "http://": ("", ""),
    "HTTP://WWW.Example.NET/EN/x?y#z": ("www.example.net", "/EN/x"), "https://a.net?x=/en/": ("a.net", ""),
    "https://É.org/fr/#": ("É.org", "/fr/"), "a://b://c/d": ("b:", "//c/d"), "x://h#/p": ("h", ""),
}


@pytest.mark.parametrize("url", list(CASES))
def test_parse(url):
    assert parse(url) == CASES[url]


def slow(url, rules, listed):
    host, path = parse(url)
    fits = [(r, v) for r, v in rules
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    if fits:
        return max(fits, key=lambda f: len(f[0]))
    return None, "block" if any(host == h or host.endswith("." + h) for h in listed) else "allow"


def test_rules_and_edges(spark):
    urls = [*CASES, *(f"http://{h}{p}" for h in ("net", "anet", "example.net", "x.example.net", "m.example.com", "org", "a.b.org",
            "x.spam-farm.example.org", "casino-win.example.com", "." * 3000 + "net", "a" * 70000 + ".net")
            for p in ("", "/", "/en", "/en/", "/en/a/b", "/de/1", "/fr/", "?/en/"))]
    rows = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] * 2, "page_id int, url string, rule string")
    for r in filter_urls(rows).collect():
        assert (r.host, r.path) == parse(r.url) and (r.rule, r.verdict) == slow(r.url, RULES, LISTED_HOSTS), r.url
    assert filter_urls(rows.limit(0)).count() == 0
    assert {r.verdict for r in filter_urls(rows, (), ()).collect()} == {"allow"}


def test_colliding_keys_are_confirmed(tmp_path):
    import triagelake.llm.urlfilter as u

    one = lambda _: 7
    real, u.xxhash.xxh64_intdigest = u.xxhash.xxh64_intdigest, one
    try:
        (tmp_path / "f").write_bytes(build([("net/", BLOCK), ("example.net/en/", ALLOW)]))
    finally:
        u.xxhash.xxh64_intdigest = real
    array = DigestArray(str(tmp_path / "f"), one)
    got = array.judge([("a.net", "/x"), ("example.net", "/en/"), ("a.org", "/en/")])
    assert got == [("net/", "block"), ("example.net/en/", "allow"), (None, "allow")]


def test_whole_table(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = op7_digest_array(spark, sf_dir).collect()
    assert len(got) == len(pages)
    assert all((r.rule, r.verdict) == slow(pages[r.page_id], RULES, LISTED_HOSTS) for r in got)
    assert {r.rule for r in got} >= {"net/", None}
