from kerbline.llm import urls


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")


URLS = ["http://Www.Example.ORG/es/1?q", "https://a.example.org/en/12#x", "https://example.org/en/2", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com", "ftp://notorg/", "no scheme", None, "", "http://b.net/?http://c.org/", "HTTP://ÉX.org/a", "http://sub.org?x/y", "a://b://c.com/fr/", "http://good.net/1", "http://bad.net/1"]


def test_host_path_rule(spark):
    df = pages(spark, [(k, u, "h", "v") for k, u in enumerate(URLS)])
    none = spark.createDataFrame([], "host string, bad int")
    got = {r.page_id: r for r in urls.judge(df, none).collect()}
    for k, u in enumerate(URLS):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
        fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[k].host, got[k].path) == (host, path)
        assert got[k].rule == (max(fit)[1] if fit else None)
        if fit:
            assert got[k].verdict == max(fit)[2]
    assert len(got) == len(URLS)


def test_shrinkage(spark):
    rows = [("bad.net", 1)] * 60 + [("good.net", 0)] * 300 + [("once.net", 1)] + [(f"h{k}.fine.com", k % 10 == 0) for k in range(100)]
    outcomes = spark.createDataFrame([(h, int(b)) for h, b in rows], "host string, bad int")
    df = pages(spark, [(1, "http://bad.net/", "", ""), (2, "http://good.net/", "", ""), (3, "http://once.net/", "", ""), (4, "http://never.seen.com/", "", ""), (5, "http://bad.net/", "", ""), (5, "http://bad.net/", "", "")])
    got = [(r.page_id, r.verdict) for r in urls.judge(df, outcomes, rules=()).collect()]
    assert sorted(got) == [(1, "block"), (2, "allow"), (3, "allow"), (4, "allow"), (5, "block"), (5, "block")]
    assert sorted(r.page_id for r in urls.keep(df, outcomes, rules=()).collect()) == [2, 3, 4]
    named = df.selectExpr("*", "'x' AS kept_id", "'x' AS own_id", "'x' AS row")
    assert sorted((r.page_id, r.kept_id) for r in urls.keep(named, outcomes, rules=()).collect()) == [(2, "x"), (3, "x"), (4, "x")]
    assert urls.judge(df.limit(0), outcomes).count() == 0


def test_registered_domains(spark):
    names = {"user:pw@shop.a.co.uk:8080": ("shop.a.co.uk", "a.co.uk", "co.uk"), "a.com:8080": ("a.com", "a.com", "com"), "x.y.example.org": ("x.y.example.org", "example.org", "org"), "co.uk": ("co.uk", "co.uk", "co.uk"), "localhost": ("localhost",) * 3, "": ("", "", "")}
    df = spark.createDataFrame([(h,) for h in names], "host string")
    name = urls.name_of(df.host)
    assert {r[0]: tuple(r)[1:] for r in df.select("host", name, urls.domain_of(name), urls.suffix_of(name)).collect()} == names
    # Two owners under one two-label suffix don't share a reputation; ports of one host do.
    outcomes = spark.createDataFrame([("bad.co.uk:81", 1)] * 80 + [("good.co.uk", 0)] * 80 + [(f"h{k}.com", 0) for k in range(200)], "host string, bad int")
    got = {r.host: r.verdict for r in urls.judge(pages(spark, [(k, f"http://{h}/", "", "") for k, h in enumerate(("bad.co.uk", "bad.co.uk:99", "good.co.uk", "never.co.uk"))]), outcomes, rules=()).collect()}
    assert got["bad.co.uk"] == got["bad.co.uk:99"] == "block" and got["good.co.uk"] == "allow"


def test_single_labels(spark):
    """No host, domain or suffix with two labels: nothing can be fitted, and nothing is blocked on one label."""
    df = pages(spark, [(1, "http://h.net/", "", ""), (2, "http://b.org/", "", ""), (3, "http://x.dev/", "", "")])
    for labels in ([("h.net", 0)], [("h.net", 1)], [("h.net", 1), ("b.org", 0), ("c.com", 0)], [("a.co.uk", 1), ("b.co.uk", 1)], [("h.net", 1), ("h.net", None)]):
        outcomes = spark.createDataFrame(labels, "host string, bad int")
        got = urls.judge(df, outcomes, rules=()).collect()
        assert len(got) == 3 and all(r.bad_bound is not None for r in got)
        assert {r.verdict for r in urls.judge(df, spark.createDataFrame([("h.net", 0)], "host string, bad int"), rules=()).collect()} == {"allow"}


def test_keep_judges_rows(spark):
    """Page ids that are null or stand with several urls; a very long url."""
    none = spark.createDataFrame([], "host string, bad int")
    rows = [(1, "http://x.com/de/1"), (1, "http://x.com/fr/1"), (None, "http://x.com/de/1"), (None, "http://a.org/"), (2, None), (3, "http://x.com/de/" + "y" * 200_000), (3, "http://a.org/" + "z" * 200_000), (4, "http://a.org/"), (4, "http://a.org/")]
    df = pages(spark, [(k, u, "h", "v") for k, u in rows])
    bad = {u for _, u in rows if u and "/de/" in u}
    left = urls.keep(df, none)
    assert left.columns == df.columns and sorted(((r.page_id, r.url) for r in left.collect()), key=str) == sorted((x for x in rows if x[1] not in bad), key=str)
