"""Fill-in-middle, spelling variants and embedding near-duplicates against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import embedding_dedup as M
from riskloom.llm import fill_in_middle as I
from riskloom.llm import spelling_variants as V

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_skip_list_ranks_match_sums():
    r = random.Random(2)
    for n in (0, 1, 2, 3, 7, 100, 5000):
        widths = [r.choice([1, 1, 5, 80]) for _ in range(n)]
        units = I.SkipList(widths)
        for rank in {0, n, n // 2, *(r.randrange(n + 1) for _ in range(50))}:
            assert units.points_before(rank) == sum(widths[:rank])
        assert sum(len(lane) for lane in units.lanes) <= 2 * n + 1 and len(units.lanes) <= 12
        for k, lane in enumerate(units.lanes):
            assert sum(x[0] for x in lane) <= n and (k > 0 or len(lane) == n)


def slow_fim(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, sha, sha
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), form, len(p), len(m), hashlib.sha256(out.encode()).hexdigest(), sha


def test_fill_in_middle_matches_slow_cuts(spark, tmp_path):
    r = random.Random(4)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\r\nb c\né\U0001f600\n", "has <P>\nin it", "<S>", "x<M>", "<", "<S\n<\nP>\n<P",
             "line\n" * 40_000, "x" * 300_000]
    texts += ["".join(r.choice("aü<>PSM\n \U0001f40d") for _ in range(r.randrange(120))) for _ in range(300)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "null\nid\n", None), (3, texts[3], "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fim_text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(x) for x in I.op11(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((slow_fim(d, t) for d, t, _ in rows), key=repr)
    assert {"psm", "spm", "plain"} == {x[2] for x in got}
    some = I.fill_in_middle(df, rate=30).groupBy("fim_form").count().collect()
    assert {x["fim_form"]: x["count"] for x in some}["plain"] > 150
    assert I.fill_in_middle(df.limit(0)).count() == 0


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in letters:
                yield word[:i] + c + word[i + 1:]


def slow_near(words):
    letters = sorted(set("".join(words)))
    return {(min(a, b), max(a, b)) for a in words for b in edits(a, letters) if b in words and b != a}


@pytest.mark.parametrize("limit", [2, 64])
def test_near_words_match_all_edits(spark, limit):
    """Families of near words, frequent beginnings and endings, repeated letters; short lists force every way."""
    r = random.Random(limit)
    words = {"aaaaaa", "aaaaaaa", "aaaaaaaa", "aaaaab", "baaaaa", "abababab", "babababa", "x" * 63, "x" * 64, "x" * 65, "x" * 66,
             "y" + "x" * 64, "x" * 40 + "y" + "x" * 40, "x" * 40 + "z" + "x" * 40, "z" * 2000, "z" * 2001, "z" * 1000 + "q" + "z" * 1000}
    for _ in range(60):
        base = r.choice(["inter", "un", "", "trans"]) + "".join(r.choice("abcdeé") for _ in range(r.randrange(4, 8))) + r.choice(
            ["ation", "ing", "", "ments"])
        words.add(base)
        words.update(r.sample(sorted(set(edits(base, "abé"))), 6))
    words |= {"same" + c + d + "tail" for c in "abcdefgh" for d in "abcdefgh"}
    words = {w for w in words if len(w) >= 6}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    got = [tuple(x) for x in V.near_words(spark, df, limit).collect()]
    assert len(got) == len(set(got)) and set(got) == slow_near(words)


def slow_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1:] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in slow_near(set(n)):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out, key=repr)


def test_variants_match_brute_force(spark):
    r = random.Random(8)
    stems = ["receive", "separate", "Überblick", "definitely", "ÀÉÎõü÷", "colour"]
    pool = []
    for stem in stems:
        pool += [stem] * 400 + [stem[:-1]] * 40 + [stem[:-2] + stem[-1]] * 6 + [stem.upper()] * 30 + [stem[1:]] * 200 + [stem[:-2]] * 6
    r.shuffle(pool)
    rows = [(i, " ".join(pool[i * 9:i * 9 + 9])) for i in range(len(pool) // 9)]
    rows += [(None, "colour colour"), (5, None), (6, ""), (7, "12 -- \n"), (8, "colouring " * 3000), (9, "q" * 20_000), (1, rows[1][1])]
    df = spark.createDataFrame([(*x, "w") for x in rows], "doc_id long, text string, word string")
    got = V.group_variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    want = slow_variants(rows)
    assert sorted(map(tuple, got), key=repr) == want
    assert any(x[3] and x[5] != x[3] for x in want)  # some chain has two steps
    assert V.group_variants(df.limit(0)).count() == 0


def slow_vectors(rows, cosine=0.93):
    def usable(v, label):
        return v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    dims = max(len(v) for _, v, _ in rows if v)
    x = np.zeros((len(rows), dims))
    for i, (_, v, label) in enumerate(rows):
        if usable(v, label):
            x[i, :len(v)] = np.asarray(v, "f8") / np.linalg.norm(v)
    same = np.array([[a[2] == b[2] for b in rows] for a in rows])
    mask = (x @ x.T >= cosine) & same
    np.fill_diagonal(mask, False)
    return mask


def test_embedding_links_match_brute_force(spark, monkeypatch):
    """Groups of near copies, a dense ball, a chain, odd vectors; small blocks and cells force every way."""
    monkeypatch.setattr(M, "BLOCK", 16)
    r = np.random.default_rng(3)
    rows = []

    def add(v, label):
        rows.append((len(rows), None if v is None else [None if x is None else float(x) for x in v], label))

    for g in range(40):
        centre = r.standard_normal(16)
        for _ in range(r.integers(1, 9)):
            add(centre + r.standard_normal(16) * 0.15 * np.linalg.norm(centre) / 4, int(g % 3))
    hot = r.standard_normal(16)
    for i in range(150):
        add(hot + r.standard_normal(16) * 0.05, 1)
    for i in range(40):
        add([np.cos(i * 0.2), np.sin(i * 0.2), *[0] * 14], 2)
    for v in (None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 0.0], [1e-30] * 16, [1e30] * 16):
        add(v, 0)
        add(v, None)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    mask = slow_vectors(rows)
    df = spark.createDataFrame([(*x, 7) for x in rows], "vec_id long, embedding array<float>, label int, row int")
    got = {x.vec_id: x for x in M.near_vectors(df, cell=24).collect()}
    assert len(got) == len(rows)
    found, want = sum(x.n_links for x in got.values()), int(mask.sum())
    assert 0.98 * want <= found <= want and all(got[i].n_links <= mask[i].sum() for i in got)
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    comp = M.grouped(mask)
    # A lost link may cut a chain, but nothing is joined that links do not join.
    parts = {(got[i].component_id, comp[i]) for i in got}
    assert len(parts) == len({x.component_id for x in got.values()}) <= len(set(comp)) + 3
    alone = [i for i, (_, v, label) in enumerate(rows) if label is None or not v]
    assert all(got[i].n_links == 0 and got[i].kept for i in alone)
    hot_ids = [i for i in got if got[i].n_links > 100]
    assert len(hot_ids) > 100


def test_embedding_repeats_and_empty(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (7, [1.0, 0.01], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], 2)]
    got = sorted((tuple(x) for x in M.near_vectors(spark.createDataFrame(rows, kind)).collect()), key=repr)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (None, 0, None, True), (9, 0, 9, True)], key=repr)
    assert M.near_vectors(spark.createDataFrame([], kind)).count() == 0
    assert M.near_vectors(spark.createDataFrame([(1, None, 1)], kind)).collect()[0].kept
