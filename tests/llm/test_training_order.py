"""Mixing, packing, chat formatting and the pipeline."""

import bisect
import hashlib
import random
import zlib
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm import chat_format as C
from riskloom.llm import packing as P
from riskloom.llm import source_mixing as M


def slow_slots(blocks, weights):
    """Sources slot by slot with fractions, all slots in one run: of the blocks whose share has passed their number, the
    one that must end first. Also yields every source's share before each slot."""
    left, had, share = dict(enumerate(blocks)), [0] * len(blocks), [Fraction(0)] * len(blocks)
    ends = []
    for s, n in enumerate(blocks):  # times at which the share of each block begins and ends
        ends.append([fluid_time(blocks, weights, Fraction(j, weights[s])) for j in range(n + 1)])
    order = []
    for slot in range(sum(blocks)):
        ready = [(ceil(ends[s][had[s] + 1]), s) for s, n in left.items() if had[s] < n and floor(ends[s][had[s]]) <= slot]
        s = min(ready)[1]
        had[s] += 1
        order.append(s)
    return order, ends


def fluid_time(blocks, weights, v):
    return sum(min(Fraction(n), a * v) for n, a in zip(blocks, weights))


def share_before(ends, slot):
    """Blocks that a source's share has reached before a slot, from the times at which it passes whole numbers, at most."""
    return bisect.bisect_right(ends, slot) - 1, bisect.bisect_left(ends, slot)


@pytest.mark.parametrize("seed", range(8))
def test_ranges_of_slots_keep_all_deadlines(seed):
    """Shares of any sizes, also after sources run dry; one range gives the slow schedule, several keep the bound."""
    r = random.Random(seed)
    k = r.choice([2, 3, 9, 25])
    blocks = [r.choice([1, 2, 7, 40, 150]) for _ in range(k)]
    weights = [r.choice([1, 1, 3, 17, 90]) for _ in range(k)]
    shares, (want, ends) = M.Shares(blocks, weights), slow_slots(blocks, weights)
    assert [s for s, _, _ in M.schedule_range(shares, 0, sum(blocks))] == want
    size = 2 * (sum(weights) // min(weights)) + 4
    had = [0] * k
    for number in range(-(-sum(blocks) // size)):
        for s, j, slot in M.schedule_range(shares, number, size):
            assert j == had[s] and floor(ends[s][j]) <= slot < ceil(ends[s][j + 1])
            had[s] += 1
            for q in range(k):
                low, high = share_before(ends[q], slot + 1)
                assert low <= had[q] <= high
    assert had == blocks


def test_unrounded_weights_of_many_sources_within_a_block():
    r = random.Random(12)
    for k in (3, 40, 900):
        weights = [r.random() ** 4 + 1e-3 for _ in range(k)] + [0.35 * k]
        weights = [w / sum(weights) for w in weights]
        blocks = [int(60_000 * w) + 3 for w in weights]
        whole = [max(1, round(w * M.WHOLE)) for w in weights]
        shares, size = M.Shares(blocks, whole), 2 * (sum(whole) // min(whole)) + 4
        slots = [[] for _ in blocks]
        for number in range(-(-50_000 // size)):
            for s, j, slot in M.schedule_range(shares, number, size):
                slots[s].append(slot)
        t = np.arange(0, 50_001)  # no source is dry before
        for s, w in enumerate(weights):
            assert np.abs(np.searchsorted(slots[s], t) - t * w).max() < 1 + 1e-6, (k, s)


def test_mixed_order_keeps_every_row_and_the_weights(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["hot"] * 6 + ["x", "y", None, ""]), f"t{i}", "clash") for i in range(900)]
    rows += [rows[0], rows[0], (None, "x", None, "clash"), (None, "x", None, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot string").repartition(7)
    weights = {"hot": 0.5, "x": 0.2, "y": 0.2, "": 0.1}
    got = M.mix(df, weights, block=4, bucket_rows=50).collect()
    assert sorted(((g.doc_id, g.source, g.text) for g in got), key=repr) == sorted((x[:3] for x in rows), key=repr)
    assert len({g.mix_position for g in got}) == len(got)
    names = sorted(weights)
    slots = {}
    for g in got:
        assert slots.setdefault(g.mix_slot, g.mix_source) == g.mix_source
    order = [slots[s] for s in range(len(slots))]
    blocks = [order.count(s) for s in names]
    assert [names[s] for s in slow_slots(blocks, [round(weights[s] / sum(weights.values()) * M.WHOLE) for s in names])[0]] == order
    assert M.mix(df.limit(0)).count() == 0


def schedule_of(spark, blocks, weights, **limits):
    sizes = spark.createDataFrame([(f"s{i}", n, float(w)) for i, (n, w) in enumerate(zip(blocks, weights))],
                                  "mix_source string, blocks long, weight double")
    got = M.slots(spark, sizes, **limits).collect()
    assert sorted(x.mix_slot for x in got) == list(range(sum(blocks)))
    out = [sorted((x.mix_block, x.mix_slot) for x in got if x.mix_source == f"s{i}") for i in range(len(blocks))]
    assert all([j for j, _ in x] == list(range(n)) and x == sorted(x, key=lambda y: y[1]) for x, n in zip(out, blocks))
    return [np.array([slot for _, slot in x]) for x in out]


@pytest.mark.parametrize("limits", [{}, {"range_slots": 64}, {"together": 12}, {"max_range": 600}])
def test_two_levels_stay_within_two_blocks(spark, limits):
    r = random.Random(3)
    weights = [r.random() + 0.05 for _ in range(30)] + [0.004, 0.001]
    weights = [w / sum(weights) for w in weights]
    blocks = [int(4000 * w) + 2 for w in weights]
    slots, t = schedule_of(spark, blocks, weights, **limits), np.arange(0, 3600)
    bound = 1 if {"together", "max_range"}.isdisjoint(limits) else 2
    assert all(np.abs(np.searchsorted(x, t) - t * w).max() < bound + 1e-6 for x, w in zip(slots, weights))


def test_shares_go_on_in_proportion_when_sources_are_dry(spark):
    slots = schedule_of(spark, [100, 4000, 2000, 5], [0.5, 0.3337, 0.1663, 0.0])
    assert slots[3].min() >= 6100
    t = np.arange(200, 6000)
    assert np.abs(np.searchsorted(slots[1], t) - 66.74 - (t - 200) * 0.3337 / 0.5).max() < 1.001


def test_every_source_keeps_its_name_and_its_weight(spark):
    rows = [(i, f"s{i % 700}" if i < 2100 else "hot") for i in range(4000)]
    got = M.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"s699": 0.5, "hot": 0.0001}, block=1).collect()
    assert len({g.mix_source for g in got}) == 701 and sorted(g.mix_slot for g in got) == list(range(4000))
    share = 0.5 / (0.5 + 0.0001 + 699 * 0.25005)
    third = sorted(g.mix_slot for g in got if g.mix_source == "s699")[2]
    assert abs(third - 2.5 / share) < 1 / share


def slow_cost(cuts, penalty, window):
    """Least cost over all choices of window ends, by trying every predecessor."""
    cost = [0] + [None] * (len(cuts) - 1)
    for j in range(1, len(cuts)):
        best = []
        for i in range(j):
            n = cuts[j] - cuts[i]
            if n <= window and cost[i] is not None:
                best.append(cost[i] + (0 if n & (n - 1) == 0 and n >= P.LEAST_POWER else window - n))
        cost[j] = min(best) + penalty[j]
    return cost[-1]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_the_cheapest(seed, monkeypatch):
    monkeypatch.setattr(P, "LEAST_POWER", 4)
    r = random.Random(seed)
    cuts = np.unique(np.r_[0, np.cumsum([r.choice([1, 2, 4, 7, 15]) for _ in range(60)])])
    penalty = np.array([0] + [r.choice([0, 3, 9]) for _ in cuts[1:]])
    ends = [0, *P.plan_cuts(cuts, penalty, 32, False)]
    place = {int(c): i for i, c in enumerate(cuts)}
    paid = sum((0 if (n := b - a) & (n - 1) == 0 and n >= 4 else 32 - n) + penalty[place[b]] for a, b in zip(ends, ends[1:]))
    assert paid == slow_cost(cuts.tolist(), penalty.tolist(), 32)


def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    r = random.Random(9)
    words = ["It's", "a", "Straße,", "naïve", "été", "3.14", "x y", "<|endoftext|>", "don't.", "中文", "end.", "!?",
             "ΟΔΟΣ.", "a\x1cb", "A<|startoftext|>.", "ﬁne!", "İstanbul.", "ǅ", "١٢", "²", "ﬀ.", "CAFÉ,"]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (3, 40, 700, 9000)] + [
        None, "", "  \n ", "no stops " * 6000, "a\tb\r\nc  d\n", "z" * 3000 + ".", "word. " * 5000]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(0, texts[0], 7), (None, "null id", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").coalesce(1)
    got = P.pack(df, P.tokenizer_path(), block_tokens=10_000).toPandas()
    want = sorted(((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
                   for i, t, _ in rows), key=repr)
    docs, now = [], None
    for x in got.sort_values(["sequence_id", "offset"]).itertuples():
        if x.start == 0:
            now = [None if x.doc_id != x.doc_id else int(x.doc_id), b""]
            docs.append(now)
        assert 4 * x.start == len(now[1]) and 4 * x.length == len(x.ids) and x.ids_crc32 == zlib.crc32(x.ids)
        now[1] += x.ids
        assert x.start + x.length <= x.doc_tokens
    assert sorted((tuple(d) for d in docs), key=repr) == want
    sizes = got.groupby("sequence_id")["length"].sum()
    placed = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")["length"].cumsum() - got["length"]
    assert (placed == got["offset"]).all() and sizes.max() <= 4096
    padding = sum(4096 - n for n in sizes if n & (n - 1))
    assert padding < 0.02 * sizes.sum()
    assert P.pack(df.limit(0), P.tokenizer_path()).count() == 0


NASTY = ["\\", "<", "<|", "|>", "<|turn|>", "<\\|", "\\\\<|end|>", "### Assistant:", "</turn>", "<|endoftext|>", "é́", "\U0001f600", "\n\n", " "]


def test_escaping_is_reversible():
    r = random.Random(6)
    for _ in range(500):
        text = "".join(r.choice(NASTY) for _ in range(r.randrange(8)))
        assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)


@pytest.mark.parametrize("segment", [50, 1_000_000])
def test_chats_are_read_back(spark, segment):
    r = random.Random(8)
    rows = [(i, t, r.choice(["user", "assistant", "assistant", "system", None]),
             r.choice([None, "", "".join(r.choice(NASTY + ["plain words "]) for _ in range(9))]), "clash")
            for i in range(40) for t in range(r.randrange(1, 7))]
    rows += [(None, 0, "assistant", "of no conversation", ""), (3, None, "user", "no turn", ""), rows[0], (50, 1, "<|end|>", "role", ""),
             (51, 0, "assistant", "long " * 50_000, "")] + [(60, t, "assistant", f"turn {t}", "") for t in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string").repartition(6)
    formatted = C.format_chats(df, C.tokenizer_path(), segment_chars=segment)
    got = {x.conv_id: x for x in C.digests(formatted).collect()}
    none_first = lambda x: (x is not None, x)
    chats = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda x: (none_first(x[0]), *map(none_first, x[1:4]))):
        chats.setdefault(conv, []).append((role or "", text or ""))
    assert got.keys() == chats.keys()
    for conv, turns in chats.items():
        x, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert x.n_turns == len(turns) and x.loss_chars == len(loss)
        assert x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert x.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert C.digests(C.format_chats(df.limit(0), C.tokenizer_path())).count() == 0


def test_masked_tokens_are_the_trained_texts():
    text, spans = C.render([("user", "hello <|end|>"), ("assistant", " Naïve\n\nreply 😀"), ("assistant", ""), ("user", "x")])
    enc = C.chat_tokenizer(C.tokenizer_path()).encode(text, add_special_tokens=False)
    starts, ends = np.array(enc.offsets).T
    mask = C.span_mask(starts, ends, spans)
    inside = [any(a <= s and e <= b and s < e for a, b in spans) for s, e in enc.offsets]
    assert mask.tolist() == inside and C.loss_text(text, mask, starts, ends) == " Naïve\n\nreply 😀"


def test_pipeline_stages_take_effect(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    before = {r.doc_id for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stage_table(spark, stage(spark, docs, small), f"test-{i}")
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
            now = {r.doc_id for r in docs.collect()}
            assert now <= before and len(now) == docs.count() and (i not in (0,) or now < before) and (i != 3 or now == before)
            before = now
    pieces = docs.toPandas()
    assert set(pieces.doc_id) == before
    total = pieces.drop_duplicates("doc_id").doc_tokens.sum()
    assert pieces.length.sum() == total


def test_sequences_follow_the_mix_over_several_files(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "FILE_ROWS", 300)
    r = random.Random(15)
    # Texts of very unlike lengths, as scans put files together by size.
    rows = [(i, " ".join(["word"] * r.choice([3, 40, 400])) + ".", "en", "hot" if i % 10 else "cold", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.stage_table(spark, corpus_pipeline.mix(spark, docs, ""), "test-mix")
    assert len(mixed.inputFiles()) > 5
    place = {x.doc_id: x.mix_position for x in M.mix(docs).collect()}
    first = corpus_pipeline.pack(spark, mixed, "").filter("start = 0").collect()
    order = [place[x.doc_id] for x in sorted(first, key=lambda x: (x.sequence_id, x.offset))]
    assert order == sorted(place.values())
    sources = {i: s for i, _, _, s, _ in rows}
    read = [sources[x.doc_id] for x in sorted(first, key=lambda x: (x.sequence_id, x.offset))]
    share = 300 ** 0.5 / (300 ** 0.5 + 2700 ** 0.5)
    assert all(abs(read[:n].count("cold") - n * share) < M.BLOCK + 1 for n in range(100, 1100, 50))


def test_word_ids_are_the_tokenizers_own_and_case_makes_no_new_words():
    r = random.Random(23)
    signs = list("aAhHtTwWyYjJiIsSzZ.,!?;:'<|> \n\t019-") + [
        "\u0331", "\u0308", "\u030a", "\u030c", "\u0307", "\u00e9", "\u00c9", "\u00df", "\u0130", "\u0131", "\u212a", "\u03a3",
        "\ufb01", "\u00b5", "\u00ba", "\u00a0", "\u0085", "<|endoftext|>", "<|ENDOFTEXT|>", "'S", "'LL"]
    latin = [x for x in signs if max(x) < "\u0100" and "<|" not in x]
    texts = ["".join(r.choices(signs if k % 2 else latin, k=r.choice([3, 8, 20]))) for k in range(3000)] + ["\u0130. \u0130", "h\u0331 H\u0331"]
    encode = P.WordIds(P.tokenizer_path())
    want = [x.ids for x in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    encode = P.WordIds(P.tokenizer_path())
    encode(["River Stone MARKET, \u00c9tat", "river STONE market, \u00c9TAT"])
    assert len(encode.young) == 7  # the empty word, three words, one of them with its mark, the mark, and "\u00c9tat"


def test_latin_words_and_closing_signs_need_no_normalising():
    """Words of letters up to U+00FF go to the vocabulary spelt, whatever signs close them; the whole tokenizer gets the signs alone."""
    encode, asked = P.WordIds(P.tokenizer_path()), []
    whole = encode.tokenizer

    class Counted:
        def encode_batch_fast(self, given, **how):
            asked.extend(given)
            return whole.encode_batch_fast(given, **how)

    encode.tokenizer = Counted()
    texts = ["état*** vièle.%%% Été stone&&& naïve, ªºµÿß", "<|endoftext|> a<|endoftext|>. (x) y̱."]
    want = [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    assert set(asked) == {"", "***", ".%%%", "&&&", ",", "<|endoftext|>", "a<|endoftext|>.", "(x", ")", "y̱."} - {""}
