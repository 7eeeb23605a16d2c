"""Chat turns, URLs and vectors: odd rows, ties, and plain versions on random ones."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.llm import chat_format, exact_topk, url_filter, vector_search
from wattledger.llm.queries import QUERIES

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\l\\b\\n", "\\\\<|end|>", "<|turn|>user\nx<|end|>", "<s", "[INST",
           "", None, "a\nb", "日本 <|im_start|>", "\\<s>\\", "<|turn|", "<<s>", "[[INST]]"]


def conversation_frame(spark, rows):
    rows = [(c, t, r, x, 1, "p") for c, t, r, x in rows]
    schema = "conv_id long, turn long, role string, text string, position int, formatted string"
    return spark.createDataFrame(rows, schema).repartition(3)


def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(6)
    rows = [(1, k, rng.choice(["user", "assistant"]), x) for k, x in enumerate(HOSTILE)]
    rows += [(2, k, x, "hi") for k, x in enumerate(HOSTILE)]
    rows += [(3, k, "assistant", "".join(rng.choice("\\<|>lbn[/s]INST\n") for _ in range(40)))
             for k in range(60)]
    rows += [(4, 0, "user", "no reply"), (None, 0, "assistant", "no id"), (None, None, "user", "x"),
             (5, 1, "assistant", "same"), (5, 1, "assistant", "same"), (5, None, "user", "first")]
    formatted = chat_format.format_conversations(conversation_frame(spark, rows))
    read = formatted.select(
        "conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns")
    ).collect()
    replies = chat_format.read_loss(chat_format.expand_examples(formatted)).collect()
    for row in read:
        own = [r for r in rows if r[0] == row["conv_id"]]
        own.sort(key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        assert [tuple(t) for t in row["turns"]] == [(r or "", x or "") for _, _, r, x in own]
        # Nothing but the marks themselves looks like a mark.
        for mark in chat_format.CONTROL:
            expected = len(own) if mark in (chat_format.TURN, chat_format.END) else 0
            assert row["formatted"].count(mark) == expected
        got = sorted((r for r in replies if r["conv_id"] == row["conv_id"]), key=lambda r: r["position"])
        assert [r["reply"] for r in got] == [x or "" for _, _, r, x in own if r == "assistant"]
        for r in got:
            assert row["formatted"].startswith(r["text"]) and r["loss_end"] == len(r["text"])


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op2_chat_format", "op6_url_filter"):
        text = physical(QUERIES[name](spark, sf_dir))
        assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|NestedLoop", text)


def test_no_conversations(spark):
    assert chat_format.format_conversations(conversation_frame(spark, [])).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("example.org", "", "block"), ("a.b.c.example.org", "/x/y", "allow"),
         ("twice.net", "/", "allow"), ("twice.net", "/", "block")]

URLS = [None, "", "nothing", "://", "http://", "http://NET/", "http://net", "http://net?x=/", "http://xnet/",
        "https://Example.NET/en/1", "https://example.net/EN/1", "http://m.example.net/en/#a", "http://net/#/en/",
        "http://example.net/en", "http://example.com/de/a?b://c/d", "http://www.example.org/fr/x",
        "http://example.org", "http://z.a.b.c.example.org/x/yz", "http://a.b.c.example.org/x/z", "x://y://net/",
        "http://twice.net/a", "http://sub.twice.net/", "http://.net/", "http://net./", "http://a..net/",
        "http://user@net:80/", "http://ÉXAMPLE.net/en/", "http://net/" + "p" * 100_000,
        "http://" + "a." * 3000 + "net/"]


def plain_judgement(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p) and host
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [RULES, [], RULES[:4]])
def test_url_rules(spark, rules):
    rows = [(k, url, "html", "h", "r") for k, url in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge_urls(pages.repartition(3), frame).collect()}
    assert got == {k: plain_judgement(url, rules) for k, url, *_ in rows}
    assert url_filter.judge_urls(pages.limit(0), frame).count() == 0


def test_bloom_filter_never_misses_and_mostly_rejects(spark):
    listed = spark.range(2000).select(F.concat(F.lit("host"), "id").alias("key"))
    words = url_filter.bloom_filter(listed, "key")
    assert listed.where(~url_filter.may_contain(words, F.col("key"))).count() == 0
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    assert others.where(url_filter.may_contain(words, F.col("key"))).count() < 1500


def test_full_bloom_filter_leaves_the_verdicts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 1)
    test_url_rules(spark, RULES)


def vector_frame(spark, rows):
    rows = [(i, v, 3, 0.5) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double")


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(300)]
    hot = rng.normal(size=8).tolist()
    rows += [(1000 + k, hot) for k in range(700)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 8), (2150, [1.0, None] + [0.0] * 6),
             (2200, [float("nan")] + [1.0] * 7), (2250, [float("inf")] + [1.0] * 7), (None, hot),
             (2300, [1e200] * 8), (2350, [-1e-200] * 8), (2400, [1.0, 2.0]), (2401, [2.0, 1.0]),
             (0, rows[0][1]), (50, rows[3][1]), (7, rows[7][1])]
    return rows


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector)


def plain_top(rows, score, count=5):
    good = [(i, v) for i, v in rows if i is not None and usable(v)]
    asking = {}
    for i, v in good:
        if i % 50 == 0:
            asking[i] = min(asking.get(i, v), v)
    out = {}
    for q, v in asking.items():
        found = [(-score(v, w), i) for i, w in good if i != q and len(w) == len(v)]
        out[q] = [(-s, i) for s, i in sorted(found)[:count]]
    return {q: found for q, found in out.items() if found}


def got_lists(frame):
    lists = {}
    for row in frame.orderBy("query_id", "rank").collect():
        own = lists.setdefault(row["query_id"], [])
        own.append((row["score"], row["vec_id"]))
        assert row["rank"] == len(own)
    return lists


def cosine(a, b):
    a, b = (np.array(x, dtype=np.longdouble) for x in (a, b))
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))


def test_nearest_equals_brute_force(spark):
    rows = odd_vectors()
    got = got_lists(vector_search.nearest(vector_frame(spark, rows), F.col("vec_id") % 50 == 0))
    nonzero = [(i, v) for i, v in rows if not usable(v) or any(v)]
    expected = plain_top(nonzero, lambda a, b: round(cosine(a, b), 12))
    assert {q: [i for _, i in found] for q, found in got.items()} == {
        q: [i for _, i in found] for q, found in expected.items()
    }
    for q, found in got.items():
        assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[q]])


def test_int8_bound_holds():
    rng = np.random.default_rng(1)
    for scale in (1.0, 1e-150, 1e150):
        vectors = rng.normal(size=(50, 33)) * scale
        block = {"ids": np.arange(50).tobytes(), "numbers": vectors.tobytes(), "dim": 33}
        coded = vector_search.Coded(block)
        exact = np.array([[cosine(a, b) for b in vectors] for a in vectors])
        estimate = vector_search._products(coded.codes, coded.codes)
        estimate *= coded.scales[:, None] * coded.scales
        bound = coded.errors + coded.errors[:, None] * (1 + coded.errors) + vector_search.SLACK
        assert (np.abs(exact - estimate) <= bound).all() and bound.max() < 0.1


def product(a, b):
    whole = [[int(np.floor(np.float64(256) * x)) for x in v] for v in (a, b)]
    return sum(x * y for x, y in zip(*whole))


def test_top_products_equal_brute_force(spark):
    rows = [(i, v) for i, v in odd_vectors() if i not in (2300,)]
    rows += [(2500, [1e6 + k for k in range(8)]), (2501, [-3e6] * 8), (2550, [3e6] * 8)]
    got = got_lists(exact_topk.top_products(vector_frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert got == plain_top(rows, product)


def test_top_products_beyond_doubles(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [16.0, 3.0]), (2, [16.0, 1.0]), (3, [2.0**40, 0.0]), (4, [-(2.0**40), 0.0])]
    got = got_lists(exact_topk.top_products(vector_frame(spark, rows), F.col("vec_id") == 0))
    limit = 2**63 - 1
    assert got == {0: [(limit, 3), (product(rows[0][1], rows[1][1]), 1),
                       (product(rows[0][1], rows[2][1]), 2), (-(2**63), 4)]}


def test_no_vectors(spark):
    empty = vector_frame(spark, [])
    assert vector_search.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0
    assert exact_topk.top_products(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = vector_frame(spark, [(0, [1.0, 2.0])])
    assert exact_topk.top_products(one, F.col("vec_id") % 50 == 0).count() == 0
