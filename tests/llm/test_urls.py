import re

from pyspark.sql import functions as F

from veridact.llm import urls as U


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    cases = [None, "", "no scheme", "://", "http://", "HTTP://A.B.NET/es/1?x#y", "x://É.com?q=/en/", "a://b://c/d", "http://example.com/en/1", "http://www.example.com/en/1",
             "http://m.www.example.com/en/", "http://notexample.com/en/", "http://net/fr/", "http://x.net/de/fr/", "http://com", "http://x.org/en/\nb", "h://a.net#/es/", "l\n://q.net/es/"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in U.judge(df, keep=("page_id",)).collect()}
    for i, u in enumerate(cases):
        host, path = brute_parts(u)
        rule, verdict = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or "allow")


def test_tree_generalises_merges_and_rejects(spark):
    rows = []
    for i in range(60):  # many rare children under one node: one wildcard; labelled bad
        rows.append((f"http://spam.org/buy/slug{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}/now", 1 if i % 2 else None))
    for part in ("de", "fr"):  # similar siblings are merged, also where one alone has too few labels
        rows += [(f"http://mixed.org/{part}/{i}", 1 if i < (40 if part == "de" else 8) else None) for i in range(50)]
    rows += [(f"http://mixed.org/en/{i}", 0 if i < 40 else None) for i in range(50)]
    rows += [("http://unknown.org/en/1", None)]
    df = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(rows)], "page_id long, url string, y int")
    got = U.judge(df, keep=("page_id", "url"), rules=(), label_col="y")
    by = {(r.host, r.path.split("/")[1]): r.verdict for r in got.collect()}
    assert by == {("spam.org", "buy"): "block", ("mixed.org", "de"): "block", ("mixed.org", "fr"): "block", ("mixed.org", "en"): "allow", ("unknown.org", "en"): "allow"}
    assert got.count() == len(rows)


def test_deep_paths_and_repeats(spark):
    deep = "http://a.org/" + "x/" * 30
    df = spark.createDataFrame([(1, deep), (1, deep), (None, deep), (2, None)], "page_id long, url string")
    got = U.judge(df, keep=("page_id",)).collect()
    assert len(got) == 4 and {r.verdict for r in got} == {"allow"}
    assert df.select(F.size(U.template(U.path_of(F.col("url"))))).first()[0] == 30
    # labels below the eighth segment are told apart
    rows = [(i, f"http://a.org/{'x/' * 12}{end}/{i}", y) for end, y in (("good", 0), ("bad", 1)) for i in range(60)] + [(60, f"http://a.org/{'x/' * 12}bad/60", None), (60, f"http://a.org/{'x/' * 12}good/60", None)]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string, y int"), keep=("page_id",), rules=(), label_col="y").where("page_id = 60").collect()
    assert {r.path.split("/")[-2]: r.verdict for r in got} == {"bad": "block", "good": "allow"}


def test_branches_speak_for_siblings_without_labels(spark):
    """Pages that no rule decides are blocked where the host's labelled branches are."""
    urls = [f"http://a.net/{part}/{i}" for part in ("es", "fr") for i in range(40)] + [f"http://a.net/de/{i}" for i in range(5)] + ["http://few.net/es/1", "http://few.net/de/1", "http://b.org/de/1"]
    urls += [f"http://www.c.com/x/{i}" for i in range(90)]
    got = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), keep=("page_id", "url")).collect()
    undecided = {r.url: r.verdict for r in got if r.rule is None}
    assert undecided == {f"http://a.net/de/{i}": "block" for i in range(5)} | {"http://few.net/de/1": "allow", "http://b.org/de/1": "allow"}


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), keep=("page_id",)).collect() == []
