import random
import re

import duckdb
import pytest

from folio.llm import license_scan as ls
from folio.llm import url_filter as uf
from folio.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[key](spark, SF)
    exp = con.sql(ORACLE_SQL[key])
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, exp.select(*cols).fetchall()))


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_rules_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(uf, "BROADCAST_RULES", broadcast)
    r = random.Random(8)
    labels, steps = ["a", "b", "net", "org", "example", "é", ""], ["x", "y", "en", "", "a.b", "x y"]
    rules = list({(".".join(r.choice(labels[:6]) for _ in range(r.randint(1, 3))), r.choice(["", "/", "/x", "/x/", "/en/y", "/x/y/"])): r.choice(["block", "allow"]) for _ in range(40)}.items())
    rules = [(h, p, a) for (h, p), a in rules]
    urls = [None, "", "no scheme", "http://", "://b/x", "http://A.NET", "http://a.net?x=/", "http://a\nb/x"]
    for _ in range(400):
        host = ".".join(r.choice(labels) for _ in range(r.randint(1, 5)))
        urls.append("http://" + host.upper() + "".join("/" + r.choice(steps) for _ in range(r.randint(0, 5))) + r.choice(["", "?q=/x/", "#f/", "/"]))
    urls.append("https://" + "a." * 20_000 + "net/" + "x/" * 20_000)
    df = spark.createDataFrame([(i, u, "p") for i, u in enumerate(urls)] + [(None, "http://a.net/x/", "p")], "page_id long, url string, prefix string")
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge_urls(df, table).collect()}
    assert got == {**{i: judge(u, rules) for i, u in enumerate(urls)}, None: judge("http://a.net/x/", rules)}
    none = uf.judge_urls(df, table.filter("false"), default="block").collect()
    assert len(none) == len(urls) + 1 and {(x["rule"], x["verdict"]) for x in none} == {(None, "block")}
    assert uf.judge_urls(df.filter("false"), table).count() == 0


def test_license_sequences_and_edges(spark):
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://x'
    rows = [
        (1, apache, "s"), (2, "All rights reserved.\nLicensed under the Apache License, Version 2.0.", "s"), (3, None, "s"), (4, "", "s"),
        (5, "  RELEASED   under the mit license!  ", "s"), (5, "Released under the MIT License.", "s"), (None, "MIT License\n\n\nfar\naway\n", "s"),
        (6, "The MIT License (MIT)\nx.\ny.\nz.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "s"),
        (7, "filler. " * 40_000 + "Licensed under CC BY-NC 4.0.", "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, seq string")
    got = sorted((r["doc_id"], r["license"], r["rule"], r["first_sentence"], r["n_sentences"]) for r in ls.scan_licenses(df, *ls.knowledge(spark)).collect())
    assert got == [
        (1, "Apache-2.0", "apache2-header", 0, 3),
        (2, "Apache-2.0", "apache2-line", 1, 1),
        (2, "Apache-2.0 with rights reserved", "reserved-then-apache2", 0, 2),
        (5, "MIT", "mit-line", 0, 1),
        (5, "MIT", "mit-line", 0, 1),
        (7, "CC-BY-NC-4.0", "ccbync4-line", 40_000, 1),
    ]
    assert ls.scan_licenses(df.filter("false"), *ls.knowledge(spark)).count() == 0


def test_license_scan_without_broadcast(spark, monkeypatch):
    want = sorted(map(tuple, QUERIES["op9_license_scan"](spark, "/root/testdata/sf0.01").collect()))
    monkeypatch.setattr(ls, "BROADCAST_SENTENCES", 0)
    assert want and sorted(map(tuple, QUERIES["op9_license_scan"](spark, "/root/testdata/sf0.01").collect())) == want


def test_license_scan_is_native(spark):
    plan = QUERIES["op9_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
