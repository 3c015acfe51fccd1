"""Top-k search and URL filters against brute force."""

import math
import random
import re

import pytest

from pyspark.sql import functions as F

from riskloom.llm import topk_search as S
from riskloom.llm import url_filters as U

VECTORS = "vec_id long, embedding array<double>, score string"


def brute(rows, k, step=20):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % step == 0:
            scored = sorted((-max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -2**63), i) for i, b in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(df, k=5):
    got = S.top_k(df, F.col("vec_id") % 20 == 0, k)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_search_matches_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_BYTES", 400)
    monkeypatch.setattr(S, "FAN_IN", 4)
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.013, 0.5, 0.25]) for _ in range(6)], "clash") for i in range(120)]
    rows += [(200 + i, [0.5] * 6, None) for i in range(30)]  # one very common vector
    rows += [(None, [1.0] * 6, ""), (400, None, ""), (401, [1.0, None], ""), (420, [float("nan")] * 6, ""),
             (421, [float("inf")], ""), (440, [], ""), (441, [2.0, 3.0], ""), (460, [1e17, -1e17], "")]
    assert found(spark.createDataFrame(rows, VECTORS).repartition(5)) == brute(rows, 5)


def test_repeated_query_rows_each_get_a_list(spark):
    rows = [(20, [1.0], ""), (20, [1.0], ""), (1, [2.0], ""), (2, [2.0], "")]
    assert found(spark.createDataFrame(rows, VECTORS)) == sorted([(20, 1, 1, 8192), (20, 2, 2, 8192)] * 2)


def test_search_never_broadcasts_tiles(spark):
    # Tiles are small as files and large as rows: a join by the files' size sent them through the driver, once a salt.
    rows = [(i, [float(i % 7), 1.0], "") for i in range(60)]
    plan = S.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 5)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_search_over_many_blocks_and_salts_with_numbers_of_every_width(spark, monkeypatch):
    for name, value in (("TILE_BYTES", 400), ("BLOCK_BYTES", 200), ("WORTH", 50.0), ("READ_BYTES", 300), ("FAN_IN", 3),
                        ("CHUNK", 3)):
        monkeypatch.setattr(S, name, value)
    r = random.Random(2)
    scales = [1.0, 1.0, 100.0, 30000.0, 2.0 ** 40, 1e300]  # one, two, four and eight bytes, and beyond the long range
    rows = [(i % 180, [r.choice([-1.0, 0.3, 0.5]) * r.choice(scales) for _ in range(r.choice([2, 2, 3]))], "") for i in range(200)]
    rows += [(200 + i, [0.5, 0.5], "") for i in range(100)]
    got, want = found(spark.createDataFrame(rows, VECTORS).repartition(6), 4), brute(rows, 4)
    assert got == want


def test_search_layout_keeps_bytes_moved_near_the_input():
    # 740,000 queries against 14.8 million rows of 64 components, kept in a byte each.
    blocks, salts = S._layout(740_000, 64 * 740_000, 3_900, 14_800_000, 72 * 14_800_000, 600, 20)
    assert blocks * salts < 20_000 and 740_000 / blocks * (64 * 8 + 32) <= S.BLOCK_BYTES
    assert S._layout(1, 64, 1, 100, 7_200, 8, 20) == (1, 1)
    assert S._layout(1, 64, 40_000, 150_000_000, 72 * 150_000_000, 8, 20)[1] > 300  # one query, yet many tasks read


def test_empty_tables(spark):
    assert found(spark.createDataFrame([], VECTORS)) == []
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string"), U.all_rules()).count() == 0


URLS = [
    (1, "http://a.example.net/en/x"), (2, "https://EXAMPLE.net/fr/"), (3, "http://example.com/de/1"),
    (4, "http://my.org/fr/2"), (5, "http://notexample.com/de/1"), (6, None), (7, ""), (8, "no address"),
    (9, "http://example.net"), (10, "http://example.net?x=/en/"), (11, "http://é.org/fr/"), (12, "x://y://b.net/z"),
    (13, "http://q.com/?utm_source=feed"), (14, "http://q.com/?utm_source=feed&sponsored=true"),
    (15, "http://ads.q.com/"), (16, "http://a.tracker.com/"), (17, "http://loads.q.com/"), (17, "http://loads.q.com/"),
    (None, "http://q.com/wp-login.php?a"), (18, "http://q.com/" + "a/" * 5000 + "cart/checkout"),
]


def test_urls_match_every_rule_tried_in_turn(spark):
    rules = U.all_rules()
    df = spark.createDataFrame([(*x, "old", "old") for x in URLS], "page_id long, url string, host string, verdict string")
    got = U.judge_urls(df, rules)
    small = U.judge_urls(df, rules, per_pass=3)

    def expect(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m.group(1).translate(U._LOWER), m.group(2)) if m else ("", "")
        low = (url or "").translate(U._LOWER)
        fits = [r for r in rules if re.search(r.regex, host + path if r.tier == 1 else low)]
        best = min(fits, key=lambda r: (r.tier, -len(r.text), r.text), default=None)
        return host, path, best and best.text, best.verdict if best else "allow"

    def key(rows):
        return sorted(((r.page_id, r.host, r.path, r.rule_text, r.verdict) for r in rows), key=repr)

    assert key(got.collect()) == sorted(((i, *expect(u)) for i, u in URLS), key=repr)
    assert key(small.collect()) == key(got.collect())


def test_rules_are_filed_under_their_rarest_token():
    index, always = U.build_index([U.host_rule("example.net/en/", "allow"), U.pattern_rule("*abc*", "block")],
                                  {"example": 9, "net": 5, "en": 7})
    assert index == {"net": [0]} and always == [1]


@pytest.mark.parametrize("text, tokens", [("^utm_source=feed^", ("utm", "source", "feed")), ("/robots.txt^", ("robots", "txt")),
                                          ("^affiliate=*", ("affiliate",)), ("/wp-login.php", ("wp", "login"))])
def test_whole_tokens_of_patterns(text, tokens):
    assert U.pattern_rule(text, "block").tokens == tokens
