"""Quality model, language ID and quality rules."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from riskloom.llm import language_id as I
from riskloom.llm import quality_gam as Q
from riskloom.llm import quality_rules as R
from riskloom.llm.common import table

SF = "/root/testdata/sf0.01"


def test_additive_model_learns_tables_and_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit(x, y, rounds=30, pair_rounds=60)
    assert (1, 0) in model.pairs
    fresh = r.random((2000, 3))
    assert np.mean((model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))) > 0.9


def test_model_without_rows_scores_one_half():
    model = Q.fit(np.zeros((0, len(Q.FEATURES))), np.zeros(0))
    assert model.score(np.zeros((2, len(Q.FEATURES)))).tolist() == [0.5, 0.5]


def test_held_out_accuracy_and_inputs(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = Q.train(documents.select("doc_id", "text"), labels)
    # Labels of held-out rows change nothing.
    turned = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(Q.train(documents, turned).tables, model.tables)
    got = Q.score_documents(documents, model).withColumn("held", Q.held_out()).join(labels, "doc_id")
    held = got.filter("held").select("predicted", "quality").collect()
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.93


def test_quality_of_odd_rows(spark):
    model = Q.AdditiveModel(0.0, [np.zeros(0)] * len(Q.FEATURES), np.zeros((len(Q.FEATURES), Q.BINS + 1)), [], [], np.zeros((0, 9, 9)))
    rows = [(1, None, 5.0), (None, "", 1.0), (1, "a b " * 50_000, None), (1, None, 5.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    assert [r.score for r in Q.score_documents(df, model).collect()] == [0.5] * 4
    assert Q.score_documents(df.limit(0), model).count() == 0
    empty = Q.train(df.filter("doc_id < 0"), spark.createDataFrame([], "doc_id long, quality int"))
    assert Q.score_documents(df, empty).count() == 4
    assert [r[0] for r in df.select(Q.held_out()).collect()].count(False) >= 1


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    spans = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(spans)
    repeated = {i + k for i, s in enumerate(spans) if seen[s] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(repeated), len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def test_rule_counts_match_brute_force(spark):
    r = random.Random(2)
    words = ["a", "be", "sea", "Übel", "|", "#x", "end."]
    texts = [None, "", " \n\t", "one", "a b c d e f g h " * 6, "same\nsame\n same\n\n", "x" * 100_000, "é b c d",
             "\x1c \x1f \x85", "w " * 20_000, "a b c d e f g\na b c d e f g\n"]
    texts += ["".join(r.choice(words) + r.choice([" ", " ", "\n", "\r\n", "\x0b"]) for _ in range(r.randrange(120))) for _ in range(60)]
    texts += texts[5:8]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {x.doc_id: x for x in R.quality_rules(df).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == slow_counts(t), t
        assert not (x.base_failed and x.kept)
    assert R.quality_rules(df.limit(0)).count() == 0
    plan = R.quality_rules(df)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("line, fails", [
    ("A whole sentence with its stop.", False), ("Menu", True), ("No stop but many words here", False), ("Fin.", False),
    ("Home | News | Sport | About us here", True), ("ONE!! TWO!! THREE!! FOUR!! FIVE.", True), ("a%%% b&&& c*** d$$$ e.", True),
    ("All rights reserved by the owner.", True), ("This work is licensed under the GNU General Public License, version 3.", True)])
def test_line_rules(spark, line, fails):
    assert spark.createDataFrame([(line,)], "x string").select(R.line_fails(F.col("x"))).first()[0] is fails


def test_documents_that_lose_too_much_go(spark):
    good = " ".join(f"word{i}" for i in range(30)) + "."
    bad = " | ".join(f"item{i}" for i in range(60))
    rows = [(1, good), (2, f"{good}\n{bad}"), (3, f"{good}\nMenu")]
    got = {r.doc_id: r for r in R.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in (1, 2, 3)] == [True, False, True] and got[3].clean_text == good


def test_languages_without_the_path_and_outside_the_sample(spark):
    """Documents that the text model has not seen; pages whose path no longer names the language."""
    documents, pages = table(spark, SF, "documents"), table(spark, SF, "pages")
    model = I.train_text(documents.filter("doc_id % 2 = 0"), named=I.named_languages(pages))
    unseen = documents.filter("doc_id % 2 = 1")
    got = I.identify(unseen, model, "doc_id", "text").join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 400 and np.mean([r.language == r.lang for r in got]) > 0.97
    masked = pages.withColumn("url", F.regexp_replace("url", "/[a-z]{2}/", "/x1/"))
    got = I.identify(masked, model, "page_id", "html", url="url", markup=True).join(
        pages.select("page_id", F.col("url").alias("whole")), "page_id").collect()
    right = np.mean([f"/{r.language}/" in r.whole for r in got])
    print("pages named without their path:", right)
    assert all(r.suffix == "" or r.suffix in I.SUFFIX.values() for r in got) and right > 0.9


def test_junk_codes_are_no_languages(spark):
    rows = [(i, f"http://h{i}.com/", f'<html lang="{a}{b}x">text', "q") for i, (a, b) in enumerate(
        (a, b) for a in "abcdefghij" for b in "klmnopqrst")]
    pages = spark.createDataFrame([*rows, (500, "http://z.com/qq/", '<html lang="de">ein text', None)],
                                  "page_id long, url string, html string, host string")
    assert I.named_languages(pages) == {"de"}
    model = I.train_text(spark.createDataFrame([(1, "some words here", "en"), (2, "words", "junk")],
                                               "doc_id long, text string, lang string"), named=I.named_languages(pages))
    assert model.languages == ["en", "de"]
    got = {r.page_id: r for r in I.identify(pages, model, "page_id", "html", url="url", markup=True).collect()}
    assert len(got) == 101 and got[500].declared == "de" and got[0].declared == "akx"


def test_long_texts_and_ties(spark):
    model = I.TextModel(["de", "en"], np.log(np.full((2, I.CELLS), 1.0 / I.CELLS)))
    rows = [(i, t) for i, t in enumerate(["the word " * 400_000, "a", None, ""])]
    got = {r.doc_id: r for r in I.identify(spark.createDataFrame(rows, "doc_id long, text string"), model, "doc_id", "text").collect()}
    assert all(r.language == "de" and r.posterior == 0.5 for r in got.values()) and len(got) == 4
    many = I.gram_counts("the word " * 400_000)
    assert many.sum() == 9 * 400_000 - I.GRAM + 1


def test_posterior_matches_the_formula(spark):
    model = I.TextModel(["de", "en"], np.log(np.full((2, I.CELLS), 1.0 / I.CELLS)))
    rows = [(1, "http://a.x.de/", '<html lang="en">'), (2, "http://a.x.de/", "<html>"), (3, "http://b.x.de/en/", None),
            (4, None, '<HTML class=q lang=de-AT>'), (None, "", ""), (4, None, '<HTML class=q lang=de-AT>')]
    got = I.identify(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string"),
                     model, "page_id", "html", url="url", markup=True).collect()
    say = {"": (1, 1), "de": (0.85, 0.15), "en": (0.15, 0.85)}
    hint = {"": (1, 1), "de": (0.6, 0.4), "en": (0.4, 0.6)}
    facts = [("en", "de", "a.x.de", "x.de"), ("", "de", "a.x.de", "x.de"), ("", "en", "b.x.de", "x.de"), ("de", "", "", ""),
             ("", "", "", ""), ("de", "", "", "")]
    like = np.array([np.multiply(say[a], hint[b]) for a, b, _, _ in facts], float)
    soft = np.round(like / like.sum(1, keepdims=True), 6)
    m = I.PRIOR_ROWS

    def prior(row, host, domain):
        """All counts without the row's own vote."""
        others = [i for i in range(len(facts)) if i != row]
        votes = lambda chosen: soft[chosen].sum(0) if chosen else np.zeros(2)
        base = (votes(others) + m[0] / 2) / (len(others) + m[0])
        near = [i for i in others if facts[i][3] == domain]
        above = (votes(near) + m[1] * base) / (len(near) + m[1])
        same = [i for i in near if facts[i][2] == host]
        return (votes(same) + m[2] * above) / (len(same) + m[2])

    want = []
    for at, ((i, _, _), e, f) in enumerate(zip(rows, like, facts)):
        post = e * prior(at, f[2], f[3])
        post /= post.sum()
        want.append((i, ["de", "en"][int(post.argmax())] if post.max() >= 0.5 else "und", round(round(float(post.max()), 6), 5)))
    assert sorted(((r.page_id, r.language, round(r.posterior, 5)) for r in got), key=repr) == sorted(want, key=repr)


def test_language_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = I.train_text(empty)
    assert model.languages == [] and I.identify(empty, model, "doc_id", "text").count() == 0
    one = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert I.identify(one, model, "doc_id", "text").first().language == "und"


def test_training_takes_each_labelled_id_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append((x, y)))
    rows = [(i, f"text {'word ' * i}of number {i}.") for i in range(1, 40)]
    hot = next(i for i in range(1, 40) if zlib.crc32(str(i).encode()) % Q.FOLDS)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(hot, hot % 2)] * 5, "doc_id long, quality int")
    for repeats in (0, 500):
        docs = spark.createDataFrame(rows + [(hot, rows[hot - 1][1])] * repeats, "doc_id long, text string")
        Q.train(docs.repartition(5), labels, rows=20)
    (x, y), (x2, y2) = seen
    assert len(y) == 20 and np.array_equal(x, x2) and np.array_equal(y, y2)
    several = spark.createDataFrame(rows + [(hot, f"other {i}") for i in range(50)], "doc_id long, text string")
    Q.train(several.repartition(3), labels, rows=40)
    Q.train(several.repartition(7), labels, rows=40)
    assert len(seen[2][1]) <= 39 and np.array_equal(seen[2][0], seen[3][0])


def test_rare_and_unlabelled_languages_are_named(spark):
    r = random.Random(21)
    words = {x: ["".join(r.choice(letters) for _ in range(r.randrange(3, 8))) for _ in range(200)]
             for x, letters in (("de", "abcdefgh"), ("en", "ijklmnop"), ("pl", "qrstuvwx"))}
    text = lambda x: " ".join(r.choice(words[x]) for _ in range(80))
    rows = [(i, text(x), x) for i, x in enumerate(["de", "en"] * 3000 + ["pl"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    strange = " ".join("".join(r.choice("αβγδεζηθ") for _ in range(5)) for _ in range(60))
    pages = spark.createDataFrame(
        [(1, "http://a.b.jp/x", f'<html lang="ja">{strange}'), (2, "http://c.d.com/", f"<html>{text('en')}"),
         (3, "http://e.f.com/", f"<html>{text('pl')}")], "page_id long, url string, html string")
    model = I.train_text(docs, rows=500, named=I.named_languages(pages))
    assert model.languages == ["de", "en", "pl", "ja"]
    got = I.identify(pages, model, "page_id", "html", url="url", markup=True).collect()
    assert {x.page_id: x.language for x in got} == {1: "ja", 2: "en", 3: "pl"}
    got = I.identify(docs, model, "doc_id", "text").join(docs, "doc_id").collect()
    assert np.mean([x.language == x.lang for x in got]) > 0.99
