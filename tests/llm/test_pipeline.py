"""The pipeline's stages against brute force on a small table, and the quality model against slow searches."""

import bisect
import random

import numpy as np
import pytest
from test_dedup import five, lines_of, roots, slow_lines

import corpus_pipeline
from riskloom.llm import packing as P
from riskloom.llm import quality_gam as Q

KIND = "doc_id long, text string, lang string, source string, n_chars long, _row long, removed string"


def slow_margin(model, x):
    total = model.base
    for j, v in enumerate(x):
        total += model.tables[j][bisect.bisect_right(list(model.edges[j]), v)]
    for (a, b), cells in zip(model.pairs, model.pair_tables):
        total += cells[bisect.bisect_right(list(model.pair_edges[a]), x[a])][bisect.bisect_right(list(model.pair_edges[b]), x[b])]
    return total


def test_scores_are_sums_of_looked_up_bins():
    r = np.random.default_rng(5)
    x, y = r.normal(size=(600, 4)).round(1), r.integers(0, 2, 600).astype(float)
    model = Q.fit(x, y, rounds=6, pair_rounds=6)
    want = [1 / (1 + np.exp(-slow_margin(model, row))) for row in x[:200]]
    assert model.score(x[:200]) == pytest.approx(want)


def newton(g, h):
    return g.sum() ** 2 / (h.sum() + Q.RIDGE)


@pytest.mark.parametrize("seed", range(5))
def test_shallow_trees_take_the_best_cuts(seed):
    r = np.random.default_rng(seed)
    g, h = r.normal(size=12), r.uniform(0.1, 1, 12)
    best = max(range(1, 12), key=lambda i: newton(g[:i], h[:i]) + newton(g[i:], h[i:]))
    want = np.r_[np.full(best, g[:best].sum() / (h[:best].sum() + Q.RIDGE)), np.full(12 - best, g[best:].sum() / (h[best:].sum() + Q.RIDGE))]
    assert Q.line_tree(g, h, 2) == pytest.approx(want)
    g, h = r.normal(size=(6, 6)), r.uniform(0.1, 1, (6, 6))
    boxes = lambda i, j: [(slice(None, i), slice(None, j)), (slice(None, i), slice(j, None)),
                          (slice(i, None), slice(None, j)), (slice(i, None), slice(j, None))]
    gain = {(i, j): sum(newton(g[b], h[b]) for b in boxes(i, j)) - newton(g, h) for i in range(1, 6) for j in range(1, 6)}
    i, j = max(gain, key=gain.get)
    won, out = Q.box_tree(g, h)
    assert won == pytest.approx(gain[i, j])
    for b in boxes(i, j):
        assert out[b] == pytest.approx(np.full(g[b].shape, g[b].sum() / (h[b].sum() + Q.RIDGE)))


def small_corpus():
    """Good and bad texts, copies, near copies, shared lines, nulls, empties, repeated rows and ids."""
    r = random.Random(31)
    words = [f"{a}{b}{c}" for a in ("riv", "stone", "mark", "win", "gard", "lett") for b in ("er", "et", "ow", "en") for c in ("", "s", "ly")]
    sentence = lambda n: " ".join(r.choice(words) for _ in range(n)).capitalize() + "."
    good = ["\n".join(sentence(14) for _ in range(6)) for _ in range(40)]
    shared = sentence(20)
    texts = good + [g.replace("river", "rivers", 1) for g in good[:3]] + good[3:5] + [f"{g}\n{shared}" for g in good[5:9]]
    texts += ["click here || >> ### $$$ " * 12 for _ in range(12)] + [None, "", " \n ", shared, "word " * 3000]
    rows = [(i, t, "en", r.choice(["hot", "hot", "a", None]), None if t is None else len(t), 7, "x") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, good[20], None, "a", 1, 7, "x"), (None, sentence(90), None, "b", 1, 7, "x"), (2, sentence(70), "en", "a", 1, 7, "x")]


def write(spark, folder, rows):
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/documents.parquet")
    labels = [(d, int("click" not in (t or "") and len(t or "") > 20)) for d, t, *_ in rows if d is not None]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")


def test_every_stage_matches_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, folder = small_corpus(), str(tmp_path)
    write(spark, folder, rows)
    docs = corpus_pipeline.table(spark, folder, "documents").select(*corpus_pipeline.COLUMNS)
    model = Q.train(docs, corpus_pipeline.table(spark, folder, "labels"))
    have = [tuple(x) for x in docs.collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = corpus_pipeline.stage_table(spark, stage(spark, docs, folder), f"brute-{i}")
        assert docs.columns == corpus_pipeline.COLUMNS
        got = [tuple(x) for x in docs.collect()]
        if i == 0:
            want = [x for x in have if 1 / (1 + np.exp(-slow_margin(model, Q.text_features(x[1])))) >= 0.3]
            assert len(want) < len(have) and not any("click" in (x[1] or "") for x in want)
        elif i == 1:
            gone, want = slow_lines([x[:2] for x in have]), []
            for d, t, lang, source, n in have:
                cut = any((d, k) in gone for k, line in lines_of(t) if line)
                left = t if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if (d, k) not in gone)
                if not cut or left.strip(" \t\n\x0b\f\r"):
                    want.append((d, left, lang, source, None if left is None else len(left)))
            # Ids that several texts share are told apart by their texts; here they lose nothing of their own.
            assert len(want) < len(have)
        elif i == 2:
            sets = [five(x[1].lower()) or {x[1].lower()} if (x[1] or "").split() else set() for x in have]
            near = [(a, b) for a in range(len(have)) for b in range(a)
                    if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
            group = roots(len(have), near)
            want = [min((x for x, g in zip(have, group) if g == c), key=lambda x: (x[0] is None, x[0] or 0)) for c in set(group)]
        else:
            want = have
        same = lambda x: tuple(x[:2])
        if i == 2:
            assert sorted((x[0] for x in got), key=repr) == sorted((x[0] for x in want), key=repr)
        else:
            assert sorted(map(same, got), key=repr) == sorted(map(same, want), key=repr), name
        have = got
    pieces = corpus_pipeline.pack(spark, docs, folder).toPandas().sort_values(["sequence_id", "offset"])
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    want = [len(tokenizer.encode(x[1] or "", add_special_tokens=False).ids) + 1 for x in have]
    assert pieces["length"].sum() == sum(want) and sorted(pieces[pieces["start"] == 0]["doc_tokens"]) == sorted(want)
    whole = corpus_pipeline.run(spark, folder).toPandas()
    assert whole["length"].sum() == sum(want)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    write(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("n", [9, 15, 30, 80, 250])
def test_near_copies_of_short_and_long_texts(spark, n):
    """One word appended or replaced, at similarity 0.8 and more: the bit filter and the bands lose few."""
    r = random.Random(n)
    texts, like = [], []
    for _ in range(120):
        words = [f"w{r.randrange(50_000)}" for _ in range(n)]
        other = [*words, "tail"] if r.random() < 0.5 or n < 60 else [*words[:3], "new", *words[4:]]
        texts += [" ".join(words), " ".join(other)]
        a, b = five(texts[-2]), five(texts[-1])
        like.append(len(a & b) >= 0.8 * len(a | b))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {x.doc_id for x in corpus_pipeline.dedup_documents(spark, docs, "").collect()}
    gone = [2 * k + 1 not in kept for k in range(len(like))]
    assert all(2 * k in kept for k in range(len(like))) and not any(g and not w for g, w in zip(gone, like))
    assert sum(like) > 60 and sum(gone) >= 0.95 * sum(like)
