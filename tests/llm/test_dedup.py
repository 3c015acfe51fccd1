"""SimHash near-duplicates, line dedup and connected components against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import line_dedup as L
from riskloom.llm import simhash_dedup as D
from riskloom.llm.common import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >= 1 << 63 else value


def test_components_of_paths_stars_and_loops(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    links += [(r.randrange(300, 360), r.randrange(300, 360)) for _ in range(40)]
    want = roots(400, links)
    got = components(spark, spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {x.node: x.component for x in got} == {i: want[i] for a, b in links if a != b for i in (a, b)}
    assert len(got) == len({x.node for x in got})
    assert components(spark, spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_near_duplicates_match_brute_force(spark):
    r = random.Random(5)
    base = [" ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(200)) for _ in range(6)]
    texts = [*base, *base[:3], None, "", " \t", "One", "one", "a B", "Ünder Über", "x\u00a0y z w", "word " * 30_000]
    for t in base:
        for _ in range(4):
            words = t.split()
            words[r.randrange(200)] = "other"
            texts.append(" ".join(words))
    rows = [(i * 3, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "clash"), (None, texts[1], None)]
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    prints = [slow_print(t) for _, t, _ in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 2]
    group = roots(len(rows), near)
    least = {}
    for g, (i, _, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert sorted(((x.doc_id, x.fp, x.component_id) for x in got), key=repr) == sorted(
        ((i, p, least[g]) for (i, _, _), p, g in zip(rows, prints, group)), key=repr)


@pytest.mark.parametrize("posting", [1, 4, 128])
def test_links_lose_no_pair_however_long_a_posting_may_be(spark, monkeypatch, posting):
    monkeypatch.setattr(D, "POSTING", posting)
    r = random.Random(7)
    values = {r.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1}
    for v in list(values):
        for _ in range(8):
            for _ in range(r.choice([1, 2, 3])):
                v ^= 1 << r.randrange(64)
            values.add(v)
    values = sorted(values)
    want = roots(len(values), [(a, b) for a in range(len(values)) for b in range(a)
                               if (values[a] ^ values[b]).bit_count() <= 2])
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    place = {v: i for i, v in enumerate(signed)}
    links = D.links(spark, spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    assert roots(len(values), [(place[x.a], place[x.b]) for x in links]) == want


def lines_of(text):
    return [(k, x.strip(" \t\n\x0b\f\r").lower()) for k, x in enumerate((text or "").split("\n"))]


def slow_lines(rows, similarity=0.8):
    """(doc_id, line_no) of the lines taken out: all pairs of distinct lines, exact similarity, first one kept."""
    regex = pytest.importorskip("regex")
    spots = sorted({(d is not None, d or 0, xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42, k, n)
                    for d, t in rows for k, n in lines_of(t) if n},
                   key=lambda s: (s[0], s[1], s[2] - (1 << 64) if s[2] >= 1 << 63 else s[2], s[3]))
    names = sorted({s[4] for s in spots})
    grams = [frozenset(regex.findall(L.GRAMS, n)) for n in names]
    near = [(a, b) for a in range(len(names)) for b in range(a)
            if len(grams[a] & grams[b]) >= similarity * len(grams[a] | grams[b])]
    group = dict(zip(names, roots(len(names), near)))
    seen, gone = set(), set()
    for has, d, _, k, n in spots:
        if group[n] in seen:
            gone.add((d if has else None, k))
        seen.add(group[n])
    return gone


def corpus():
    r = random.Random(11)
    words = "river stone market window garden letter number silver engine planet".split()
    line = lambda n: " ".join(r.choice(words) + r.choice(["", "s", "ly", "ing"]) for _ in range(n))
    base, texts = [line(30) for _ in range(8)], []
    for i in range(30):
        picked = [r.choice(base) for _ in range(2)] + [line(25)]
        changed = r.choice(base).split()
        changed[r.randrange(30)] = f"new{i}"
        texts.append("\n".join([*picked, " ".join(changed), "", "  ", line(3)]))
    texts += [None, "", "\n\n", "Same Line here.\n same line HERE. ", "a" * 3000 + "\n" + "a" * 2900 + "b",
              "\n".join(base[0] + f" tail{i}" for i in range(90))]
    return [(i, t) for i, t in enumerate(texts)] + [(None, base[1]), (3, texts[3])]


@pytest.mark.parametrize("bucket", [2, 64])
def test_line_dedup_matches_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(L, "BUCKET", bucket)
    rows = corpus()
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, removed string")
    got = L.dedup_lines(df).collect()
    assert len(got) == len(rows)
    gone = {(x.doc_id, g.line_no) for x in got for g in x.removed or []}
    assert gone == slow_lines(rows)
    for x in got:
        text = dict((d, t) for d, t in rows)[x.doc_id]
        left = None if text is None else "\n".join(
            y for k, y in enumerate(text.split("\n")) if (x.doc_id, k) not in gone)
        assert x.text == left and x.n_lines == sum(bool(n) for _, n in lines_of(text))


def test_line_dedup_of_an_empty_table_and_its_plan(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert D.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    plan = L.dedup_lines(spark.createDataFrame(corpus(), "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Cartesian|NestedLoop", plan)


def test_line_signatures_hash_every_window_once():
    """Equal shingles have equal hashes, others unequal ones, in any company; astral and short lines included."""
    lines = ["abcabcabcabc", "", "a", "ab", "abcd", "abcde", "abcdef", "x\U0001f600yz\U0001f600w", "é" * 9, "ab" * 4000]
    hashes, counts = L.window_hashes(lines)
    shingles = [g for x in lines for g in ([x[i:i + 5] for i in range(len(x) - 4)] or [x])]
    assert len(shingles) == len(hashes) == counts.sum() and len(set(shingles)) == len(set(hashes.tolist()))
    assert len(set(zip(shingles, hashes.tolist()))) == len(set(shingles))
    n, keys = L.signatures(lines)
    assert n == [len(L.grams(x)) for x in lines] and all(len(k) >= 1 for k in keys)
    for x, k in zip(lines, keys):
        assert L.signatures([x])[1][0].tolist() == k.tolist()


def test_short_lines_with_one_word_changed_are_alike(spark):
    """All five-character windows, by an own definition: lines of 8 to 25 words, one word replaced."""
    r = random.Random(13)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9)))
    pairs = []
    for k in range(360):
        words = [word() for _ in range(8 + k % 18)]
        other = list(words)
        other[r.randrange(len(words))] = word()
        pairs.append((" ".join(words), " ".join(other)))
    sets = lambda x: {x[i:i + 5] for i in range(len(x) - 4)} or {x}
    like = [len(sets(a) & sets(b)) / len(sets(a) | sets(b)) >= 0.8 for a, b in pairs]
    rows = [(2 * k + i, x) for k, p in enumerate(pairs) for i, x in enumerate(p)]
    got = {x.doc_id: x.n_removed for x in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = [got[2 * k + 1] == 1 for k in range(len(pairs))]
    assert not any(g and not w for g, w in zip(gone, like)) and not any(got[2 * k] for k in range(len(pairs)))
    assert sum(like) > 150 and sum(gone) >= 0.97 * sum(like)
    assert sum(gone[k] for k in range(len(pairs)) if 8 + k % 18 == 16) > 10


def changed(r, words, times):
    for i in r.sample(range(len(words)), times):
        words = [*words[:i], f"new{r.random()}", *words[i + 1:]]
    return words


def five(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_stage_drops_near_copies_at_similarity_eight_tenths(spark):
    import corpus_pipeline

    r = random.Random(17)
    texts, like = [], []
    for n, times in [(300, 6)] * 60 + [(300, 3)] * 30 + [(1000, 20)] * 60 + [(1000, 10)] * 30 + [(300, 12)] * 30:
        words = [f"w{r.randrange(50_000)}" for _ in range(n)]
        pair = " ".join(words), " ".join(changed(r, words, times))
        a, b = map(five, pair)
        texts += pair
        like.append(len(a & b) >= 0.8 * len(a | b))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {x.doc_id for x in corpus_pipeline.dedup_documents(spark, docs, "").collect()}
    gone = [2 * k + 1 not in kept for k in range(len(like))]
    assert all(2 * k in kept for k in range(len(like))) and not any(g and not w for g, w in zip(gone, like))
    print("near copies found:", sum(gone), "of", sum(like))
    assert sum(like) > 120 and sum(gone) >= 0.95 * sum(like)


def test_stage_finds_near_copies_through_the_index_of_bytes(spark, monkeypatch):
    """Without the bands' pairs, those within two bits are found, and only such as have the similarity."""
    import corpus_pipeline

    none = lambda *_, **__: spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(L, "star_pairs", none)
    monkeypatch.setattr(L, "cross_pairs", none)
    r = random.Random(29)
    texts = []
    for _ in range(40):
        words = [f"w{r.randrange(50_000)}" for _ in range(1000)]
        texts += [" ".join(words), " ".join(changed(r, words, 1))]
    texts += ["one two", "one three", "x y"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    prints = [D.fingerprint(t, D.COPY_SHINGLE) for t in texts]
    near = [((prints[i] ^ prints[i + 1]) % (1 << 64)).bit_count() <= D.MAX_BITS for i in range(0, 80, 2)]
    kept = {x.doc_id for x in corpus_pipeline.dedup_documents(spark, docs, "").collect()}
    assert [i + 1 not in kept for i in range(0, 80, 2)] == near and sum(near) > 10
    assert kept >= {80, 81, 82, *range(0, 80, 2)}
    pairs = D.indexed_pairs(spark, spark.createDataFrame([(0, 5), (1, 5), (2, 4), (3, -9), (4, 5)], "node long, fp long"))
    assert sorted(tuple(x) for x in pairs.collect()) == [(0, 1), (0, 2), (0, 4)]


def test_stage_keeps_unlike_documents_of_null_and_repeated_ids(spark):
    import corpus_pipeline

    r = random.Random(19)
    text = lambda: " ".join(f"w{r.randrange(50_000)}" for _ in range(120))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (3, c), (9, e), (9, ""), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(x.doc_id, x.text) for x in corpus_pipeline.dedup_documents(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([(None, a), (None, b), (3, c), (7, d), (9, e), (9, "")], key=repr)


def test_marks_and_shown_shingles_take_out_unlike_pairs_alone(spark):
    r = random.Random(11)
    letters = "abcdefghij "
    lines = []
    for _ in range(60):
        line = "".join(r.choice(letters) for _ in range(r.choice([3, 30, 120, 900])))
        lines.append(line)
        for _ in range(2):
            at, width = r.randrange(len(line)), r.choice([1, 5, len(line) // 8, len(line) // 3])
            lines.append(line[:at] + "".join(r.choice(letters) for _ in range(width)) + line[at + width:])
    rows = [(i, len(L.grams(x)), x) for i, x in enumerate(lines)]
    bodies = spark.createDataFrame(rows, "node long, n int, body string").withColumn("marks", L.marks("body"))
    pairs = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))]
    passed = {tuple(x) for x in L.sifted(
        spark.createDataFrame(pairs, "a long, b long"), bodies, 0.8).collect()}
    sets = [L.grams(x) for x in lines]
    near = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert near and near <= passed and len(passed) < len(pairs) / 4
    # The same lines by their rare shingles: each alike pair shows, with a line of its bucket that comes first or itself.
    nodes = bodies.select("node")
    parts = L.with_leader(
        L.rare_buckets(nodes, bodies, L.shingle_set, 0.8), "gram", F.col("own_share"))
    none = spark.createDataFrame([], "node long, component long")
    stars = {tuple(sorted(x)) for x in L.star_pairs(parts, 0.8).collect()}
    crosses = {tuple(x) for x in L.cross_pairs(parts, none, "gram", 0.8, L.SHOWN).collect()}
    assert near <= stars | crosses


def test_lines_of_large_buckets_are_compared_by_their_marks_without_rare_shingles(spark, monkeypatch):
    """120 lines with one passage, of which few are alike: all pairs in place, those alike alone become rows."""
    r = random.Random(31)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9)))
    passage = " ".join(word() for _ in range(40))
    lines = [f"{passage} {' '.join(word() for _ in range(30))}" for _ in range(100)]
    lines += [f"{x[:-9]} {word()}" for x in lines[:20]]
    sets = [L.grams(x) for x in lines]
    near = {(i, j) for j in range(len(lines)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    bodies = spark.createDataFrame([(i, len(L.grams(x)), x) for i, x in enumerate(lines)], "node long, n int, body string")
    bodies = bodies.withColumn("marks", L.marks("body"))
    buckets = L.with_leader(bodies.select(
        F.lit(1).alias("key"), "node", "n", F.col("n").alias("s"), F.lit(1).alias("place")), "key", F.col("node"))
    none = spark.createDataFrame([], "node long, component long")
    made = {tuple(x) for x in L.cross_pairs(buckets, none, "key", 0.8, marked=bodies).collect()}
    stars = {tuple(sorted(x)) for x in L.star_pairs(buckets, 0.8).collect()}
    assert len(near) >= 20 and near <= made | stars and len(made) < 500

    def unwanted(*_):
        raise AssertionError("split by rare shingles")

    monkeypatch.setattr(L, "rare_buckets", unwanted)
    rows = list(enumerate(lines))
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, g.line_no) for x in got for g in x.removed or []} == slow_lines(rows)


def test_rows_among_wanted_hashes_keep_all_of_them_and_few_others(spark, monkeypatch):
    """By remainders alone, of which 2,000 hashes take all 64, every row would pass."""
    monkeypatch.setattr(L, "REMAINDERS", 64)
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("h"))
    wanted = rows.filter("id % 20 = 7").select("h")
    passed = {x.id for x in L.among(rows, F.col("h"), wanted, F.col("h")).select("id").collect()}
    assert {i for i in range(40_000) if i % 20 == 7} <= passed and 2_000 < len(passed) < 10_000
    assert L.among(rows, F.col("h"), wanted, F.col("h")).columns == ["id", "h"]
    assert L.among(rows, F.col("h"), wanted.limit(0), F.col("h")).count() == 0


def test_packed_shingles_are_the_shingles(spark):
    r = random.Random(37)
    lines = ["a", "ab", "abcd", "\x00ab", "abcde", "x" * 50, "é" * 9, "࿾" * 5, "࿿" * 5, "日本語テキスト", "ab\U0001f600cdef"]
    lines += ["".join(r.choice("ab é࿾") for _ in range(r.randrange(1, 60))) for _ in range(60)]
    lines += [x[:-1] + "日" for x in lines[-10:]] + [x + "q" for x in lines[:20]]
    for x in lines:
        p = L.packed(x)
        assert (p is None) == (max(x) >= "࿿") and (p is None or len(p) == len(L.grams(x)))
    pairs = [(i, j) for j in range(len(lines)) for i in range(j)]
    bodies = spark.createDataFrame([(i, len(L.grams(x)), x) for i, x in enumerate(lines)], "node long, n int, body string")
    got = {tuple(x) for x in L.verified_lines(
        spark.createDataFrame(pairs, "a long, b long"), bodies, L.shingle_set, 0.8).collect()}
    sets = [L.grams(x) for x in lines]
    assert got == {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} and got


def test_lines_are_trimmed_of_every_kind_of_space_and_no_more(spark):
    lines = ["a", " a", "a ", "\ta\x0b", "\x0c\r a b \r", " a ", "", " \t", "a\x1f"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    assert [y[0] for y in df.select(L.trimmed(F.col("x"))).collect()] == [x.strip(" \t\x0b\x0c\r") for x in lines]
