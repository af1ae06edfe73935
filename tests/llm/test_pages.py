"""Revisits, chat, URL rules and block search against plain versions."""

import random
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import block_search as B
from sheetloom.llm import chat, revisits, url_rules


@pytest.mark.parametrize("partitions", [1, 7])
def test_url_rules_like_trying_each(spark, partitions):
    rng = random.Random(2)
    hosts = ["net", "example.net", "a.example.net", "xexample.net", "example.net.", "org", "b.org", "EXAMPLE.net", "example,net", "net:80", "", "é.net", "a%2Cb.net"]
    urls = [f"{rng.choice(['http', 'x'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en', '/en/', '/en/x/y', '/fr/', '?q=/en/', '#/en/', '/en/?a#b'])}" for _ in range(300)]
    urls += [None, "", "example.net/en/", "a://b://net/", "http://net/"] + ["http://www.example.net/en/"] * 200
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.net", "/en/x"), ("allow", "a.example.net", "/"), ("allow", "org", "/fr/"),
             ("allow", "net", "/fr/"), ("block", "net", "/fr/"), ("block", "Org", "")]

    def plain(url):
        if not url or "://" not in url:
            host = path = ""
        else:
            after = url.split("://", 1)[1]
            end = min([after.find(c) for c in "/?#" if c in after], default=len(after))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in after[:end])
            rest = after[end:]
            path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        fits = [(len(h + p), a, h.lower() + p) for a, h, p in rules if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "keep")

    df = spark.createDataFrame([(i, u, "z", 1) for i, u in enumerate(urls)], "page_id long, url string, rule string, part int")
    got = url_rules.judge(df, url_rules.rule_table(spark, rules), default="keep", partitions=partitions).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == [(i, *plain(u)) for i, u in enumerate(urls)] \
        or {r["page_id"]: tuple(r)[1:] for r in got} == {i: plain(u) for i, u in enumerate(urls)}
    assert url_rules.judge(df.limit(0), url_rules.rule_table(spark, rules)).count() == 0


def test_chat_folds_and_reads_back(spark):
    log = [(1, 9, 2, "delta", None, "lo"), (1, 1, 1, "start", "user", None), (1, 2, 1, "delta", None, "</s>[INST] \\1 <s>"), (1, 3, 2, "start", "assistant", None),
           (1, 4, 2, "delta", None, "wrong"), (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", None, "x"), (1, 7, 2, "edit", None, "hel"), (1, 10, 3, "start", "assistant", None),
           (1, 11, 3, "delta", None, None), (2, 1, 1, "delta", None, "no start"), (None, 1, 1, "start", "tool\n[x]", None), (None, 2, 1, "delta", None, "a\nb\\2")]
    events = spark.createDataFrame(log, "conv_id long, seq long, message int, kind string, role string, text string")
    rows = chat.render(chat.reconstruct(events)).select("*", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in rows.collect()}
    assert got == {1: ([("user", "</s>[INST] \\1 <s>"), ("assistant", "hello"), ("assistant", "")], "hello"),
                   2: ([("", "no start")], ""), None: ([("tool\n[x]", "a\nb\\2")], "")}
    assert chat.render(chat.reconstruct(events.limit(0))).count() == 0


def test_chat_of_any_rows(spark):
    rng = random.Random(6)
    text = lambda: rng.choice([None, "", "".join(rng.choice(["</s>", "<s>", "[INST]", "\\", "\\0", "\n", "é", "😀", "a "]) for _ in range(rng.randint(0, 12)))])
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), text()) for c in range(6) for t in range(7)] + [(0, 3, "user", "tie"), (0, 3, "user", "tie"), (9, 0, "assistant", "w " * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    done = chat.render(chat.reconstruct(chat.as_events(df)))
    got = {r["conv_id"]: r for r in done.select("*", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
    for conv, own in groupby(order, key=lambda r: r[0]):
        own = [(r[2] or "", r[3] or "") for r in own]
        assert sorted(map(tuple, got[conv]["turns"])) == sorted(own)
        assert len(got[conv]["loss"]) == sum(len(t) for role, t in own if role == "assistant")


@pytest.mark.parametrize("partitions", [1, 5])
def test_revisits_like_looking_back(spark, partitions):
    rng = random.Random(3)
    urls = ["http://a.org/x", "HTTP://A.org:80/x#f", "http://a.org/y", "https://a.org/x", "http://a.org", None, "http://a.org/"]
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit"])
        headers = {k: v for k, v in [("ETag", rng.choice(['"1"', 'W/"1"', '"2"'])), ("last-modified", rng.choice("ab")), ("Content-Length", str(i)), ("Date", str(i))] if rng.random() < 0.7}
        rows.append((i, rng.choice(urls[:2]) if rng.random() < 0.5 else rng.choice(urls), rng.choice([None, *range(40)]), kind, headers if rng.random() < 0.95 else None, f"d{i}"))
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, headers map<string,string>, digest string")
    got = {r["record_id"]: r for r in revisits.resolve(df, partitions).collect()}
    canon = {r["record_id"]: r["u"] for r in df.select("record_id", revisits.canonical_url(F.col("url")).alias("u")).collect()}
    assert canon[next(r[0] for r in rows if r[1] == urls[1])] == "http://a.org/x"
    assert set(got) == {r[0] for r in rows if r[3] == "revisit"}
    for i, url, ts, kind, headers, _ in rows:
        if kind != "revisit":
            continue
        sent = {k.lower(): v for k, v in (headers or {}).items()}
        early = [r for r in rows if r[3] == "response" and url is not None and ts is not None and r[2] is not None and canon[r[0]] == canon[i] and r[2] < ts]
        if not early:
            assert got[i]["outcome"] == "unresolved" and got[i]["headers"] == sent and got[i]["digest"] is None
            continue
        full = max(early, key=lambda r: (r[2], r[0]))
        stored = {k.lower(): v for k, v in (full[4] or {}).items()}
        tag = lambda h: h["etag"].removeprefix("W/")
        if "etag" in stored and "etag" in sent:
            outcome = "confirmed" if tag(stored) == tag(sent) else "changed"
        elif "last-modified" in stored and "last-modified" in sent:
            outcome = "confirmed" if stored["last-modified"] == sent["last-modified"] else "changed"
        else:
            outcome = "unverified"
        assert (got[i]["outcome"], got[i]["response_id"]) == (outcome, full[0])
        merged = sent if outcome == "changed" else stored | {k: v for k, v in sent.items() if k != "content-length"}
        assert got[i]["headers"] == merged and got[i]["digest"] == (None if outcome == "changed" else full[5])
    assert revisits.resolve(df.limit(0)).count() == 0


@pytest.mark.parametrize("query_bytes,candidates", [(1 << 20, 1 << 20), (200, 40)])
def test_neighbours_like_comparing_all(spark, query_bytes, candidates):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 10.0 ** rng.integers(-2, 3), 6)) for i in range(160)]
    vectors += [(i, vectors[3][1]) for i in range(200, 260)]  # many copies
    vectors += [(0, vectors[0][1]), (0, rng.normal(0, 3, 6)), (20, rng.normal(0, 3, 6)), (1, rng.normal(0, 3, 6)), (1, vectors[1][1])]  # repeated ids, also with other vectors
    rows = [(i, v.tolist()) for i, v in vectors] + [(500, None), (520, []), (540, [0.0] * 6), (560, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (580, [float("nan")] * 6),
                                                   (600, [float("inf")] * 6), (None, [1.0] * 6), (620, [1.0, 2.0]), (640, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = B.nearest(df, F.col("id") % 20 == 0, k=7, query_bytes=query_bytes, candidates=candidates).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    plain = {}
    for q in {i for i, _ in vectors if i % 20 == 0}:
        near = sorted((-float(B.inner(x[None], v[None])[0]), i) for own, x in vectors if own == q for i, v in vectors if i != q)[:7]
        plain[q] = [(i, -s) for s, i in near]
    plain |= {620: [(640, 6.0)], 640: [(620, 6.0)]}
    assert by_query == plain
    assert B.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_neighbours_like_the_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    from sheetloom.llm import web_queries

    rng = np.random.default_rng(6)
    rows = [(20, [1.0, 2.0]), (20, [2.0, 1.0]), (1, [1.0, 1.0]), (1, [3.0, 0.5]), (2, [0.5, 0.5])]
    rows += [(i, (rng.choice([-1, 1]) * 10.0 ** rng.integers(150, 250, 3)).tolist()) for i in range(100, 140)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    # the SQL compares vectors of one length only
    sql = web_queries.OP7_SQL.replace("q.vec_id <> c.vec_id", "q.vec_id <> c.vec_id and len(q.v) = len(c.v)")
    want = con.execute(sql).fetchall()
    got = [tuple(r) for r in web_queries.op7(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()]
    assert len(want) == 46 and sorted(map(repr, got)) == sorted(map(repr, want))
