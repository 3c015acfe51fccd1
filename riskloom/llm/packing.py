"""Packing: order-preserving dynamic programming over document and sentence ends, with a monotone queue."""

from __future__ import annotations

import codecs
import os
import string
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

# Fixed values of the contract: tokens of a sequence, the id that ends a document.
WINDOW = 4096
END_ID = 2
# Cost, in padding tokens, of a cut at a sentence end, and of one elsewhere (only where a sentence outgrows a window).
SENTENCE_PENALTY = 8
INNER_PENALTY = 64
# Tokens that one run of the dynamic programme takes; the open window at its end moves into the next run.
BLOCK_TOKENS = 1 << 20
# Distinct words that each of a worker's two generations of known words holds, and the longest one kept.
CACHE_WORDS = 450_000
CACHE_CHARS = 64
# Texts that are encoded together.
TEXTS = 128
# The smallest power of two that a window is cut to for its own sake.
LEAST_POWER = 256
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


class WordIds:
    """Ids of texts, word by word, four little-endian bytes an id.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its space-separated words
    in a row; and it splits letters from marks, so a word's closing marks can be set apart, and it lower-cases. Words
    repeat, hence two generations of known words of bounded size: when the younger is full, it becomes the older. Words
    are told apart at spaces and line ends alone; all other white space is left to the tokenizer.
    """

    # The signs that close a word: ASCII punctuation, but for the one that ends a control string.
    MARKS = string.punctuation.replace(">", "")
    # Letters below this one stay one letter each when normalised and lower-cased.
    BEYOND = "\u0100"
    # The one letter that ends in a mark when lower-cased.
    DOTTED = "\u0130"

    def __init__(self, path: str):
        # Spark runs one task a core; the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same vocabulary for words of letters alone, spelt in its signs for UTF-8 bytes: they need no normalising
        # and no rules of where a word ends.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.CharDelimiterSplit(" ")
        self.signs = byte_signs()
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        # Ids of full stops, question and exclamation marks: a sentence ends behind them.
        stops = [i for x, i in self.tokenizer.get_vocab().items() if x.removesuffix("</w>").strip(".!?") == "" and x[0] in ".!?"]
        self.stops = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.stops[stops] = True
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.word_end[[i for x, i in self.tokenizer.get_vocab().items() if x.endswith("</w>")]] = True

    def learn(self, words: set[str]) -> None:
        """Put the words' ids into the younger generation; what neither knows is encoded in one or two calls."""
        young, old = self.young, self.old
        known = words & old.keys()
        young.update(zip(known, map(old.__getitem__, known)))
        marks, beyond = self.MARKS, self.BEYOND
        fresh = words - known
        letters = {word for word in fresh if word.isascii() and word.isalpha() and word.islower()}
        spelt = list(letters)
        split, odd = [], set()
        for word in fresh - letters:
            if "<|" in word:
                odd.add(word)
                continue
            core, tail = word.rstrip(marks), ""
            if core != word:
                if core and core[-1].isalnum() and core[-1] != self.DOTTED:
                    tail = word[len(core):]
                    if tail not in young:
                        odd.add(tail)
                else:
                    core = word
            ascii_ = core.isascii()
            if ascii_:
                core = core.lower()
            if core != word:
                split.append((word, core, tail))
            if core not in young:
                if not core.isalpha() or not ascii_ and max(core) >= beyond:
                    odd.add(core)
                elif core not in letters:
                    letters.add(core)
                    spelt.append(core)
        if spelt:
            # A run of letters is one word, whose last token alone is marked as a word's end.
            row = " ".join(spelt)
            if not row.isascii():
                row = row.lower()
                row = codecs.charmap_decode(row.encode(), "strict", self.signs)[0]
            ids = np.array(self.letters.encode_batch_fast([row], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.word_end[ids]) + 1)).tolist()
            raw, begun = ids.tobytes(), 0
            for word, end in zip(spelt, ends, strict=True):
                young[word] = raw[begun:end]
                begun = end
        given = list(odd)
        for x, found in zip(given, self.tokenizer.encode_batch_fast(given, add_special_tokens=False)):
            young[x] = array("I", found.ids).tobytes()
        for word, core, tail in split:
            young[word] = young[core] + young[tail] if tail else young[core]

    @staticmethod
    def lowered(text: str) -> str:
        """The text with A-Z in lower case, so that fewer words differ; one that the vocabulary might then read otherwise
        stays as it is: signs beyond Latin-1 may combine with a letter, and a control string is matched as it is written."""
        if "<|" in text:
            return text
        if text.isascii():
            return text.lower()
        try:
            return text.encode("latin-1").lower().decode("latin-1")
        except UnicodeEncodeError:
            return text

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the texts' words are looked up together."""
        lists = [self.lowered(text).replace("\n", " ").split(" ") for text in texts]
        unknown = set().union(*lists).difference(self.young)
        if unknown:
            self.learn(unknown)
        find = self.young.__getitem__
        out = [b"".join(map(find, words)) for words in lists]
        for word in unknown:
            if len(word) > CACHE_CHARS:
                self.young.pop(word, None)
                core = word.rstrip(self.MARKS)
                self.young.pop(core.lower() if core.isascii() else core, None)
                if len(word) - len(core) > CACHE_CHARS:
                    self.young.pop(word[len(core):], None)
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {"": b""}
        return out

    def sentence_ends(self, ids: bytes) -> np.ndarray:
        """Token counts behind which a sentence has ended."""
        return np.flatnonzero(self.stops[np.frombuffer(ids, "<u4")]) + 1


def byte_signs() -> str:
    """The vocabulary's sign for each byte of UTF-8, a space staying one: two signs a letter from U+0080 to U+00FF."""
    from tokenizers.pre_tokenizers import ByteLevel

    signs, spell = [chr(i) for i in range(256)], ByteLevel(add_prefix_space=False, use_regex=False)
    for i in range(0x80, 0x100):
        pieces = spell.pre_tokenize_str(chr(i))
        for byte, sign in zip(chr(i).encode(), pieces[0][0], strict=True):
            signs[byte] = sign
    return "".join(signs)


#: One per Python worker and vocabulary: the words stay known from task to task.
_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def plan_cuts(cuts: np.ndarray, penalty: np.ndarray, window: int, last_free: bool) -> list[int]:
    """Choose the window ends among sorted token positions ``cuts`` (the first is 0), at the least total cost.

    A window of n tokens costs window - n of padding, or nothing when n is a power of two, plus the penalty of the
    place it ends at. cost[j] = min over i of cost[i] + window - cuts[j] + cuts[i] + penalty[j], so the best i minimises
    cost[i] + cuts[i] among those within reach: the front of a monotone queue. Powers of two are a few more candidates
    each. ``last_free`` leaves the padding of the last window out, when more tokens follow.
    """
    n = len(cuts)
    places, fines = cuts.tolist(), penalty.tolist()
    powers = [1 << b for b in range(LEAST_POWER.bit_length() - 1, window.bit_length()) if 1 << b <= window]
    hits: dict[int, list[int]] = defaultdict(list)
    for power in powers:
        reach = np.searchsorted(cuts, cuts - power)
        for j in np.flatnonzero(cuts[reach] == cuts - power).tolist():
            hits[j].append(int(reach[j]))
    cost, back = [0] * n, [0] * n
    # The queue: places, and cost + cuts there, which grows from head to tail.
    queue, value, head, tail = [0] * n, [0] * n, 0, 1
    for j in range(1, n):
        here = places[j]
        while here - places[queue[head]] > window:
            head += 1
        from_ = queue[head]
        least = value[head] - here + window
        if j in hits:
            for r in hits[j]:
                if cost[r] < least:
                    least, from_ = cost[r], r
        if last_free and j == n - 1:
            least, from_ = min((cost[i], i) for i in queue[head:tail])
        mine = cost[j] = least + fines[j]
        back[j] = from_
        mine += here
        while tail > head and value[tail - 1] >= mine:
            tail -= 1
        queue[tail] = j
        value[tail] = mine
        tail += 1
    chosen, j = [], n - 1
    while j > 0:
        chosen.append(places[j])
        j = back[j]
    return chosen[::-1]


def split_tail(cuts: list[int], window: int) -> list[int]:
    """Cut the very last window into sizes that are powers of two, where those cuts cost less than its padding."""
    begin, end = ([0, *cuts])[-2:]
    size = end - begin
    parts = [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]
    if len(parts) < 2 or (len(parts) - 1) * INNER_PENALTY >= window - size:
        return cuts
    return [*cuts[:-1], *(begin + np.cumsum(parts)).tolist()]


def candidates(docs: list[tuple], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end and their penalties: document ends, sentence ends, and forced cuts in between."""
    places, fines, at = [np.zeros(1, "i8")], [np.zeros(1, "i8")], 0
    for _, _, ends, total, begun in docs:
        left = total - begun
        inner = ends[np.searchsorted(ends, begun, "right"):np.searchsorted(ends, total)] - begun
        edges = np.r_[0, inner, left]
        gaps = np.flatnonzero(np.diff(edges) > window)
        spots = edges[1:]
        fine = np.full(len(spots), SENTENCE_PENALTY)
        if len(gaps):
            # A stretch that no window can hold may be cut inside, at short steps so that windows still fill up.
            step = max(1, window // 64)
            forced = [np.arange(edges[g] + step, edges[g + 1], step) for g in gaps]
            spots = np.unique(np.concatenate([spots, *forced]))
            fine = np.where(np.isin(spots, inner), SENTENCE_PENALTY, INNER_PENALTY)
        fine[-1] = 0
        places.append(spots + at)
        fines.append(fine)
        at += left
    return np.concatenate(places), np.concatenate(fines)


def _packer(path: str, window: int, block_tokens: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()
    names = [c.split(" ")[0] for c in PIECES.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        docs: list[tuple] = []  # doc_id, ids, sentence ends, tokens, tokens already placed
        held, sequence, part = 0, 0, 0

        def place(last: bool) -> pa.RecordBatch:
            nonlocal docs, held, sequence
            cuts = plan_cuts(*candidates(docs, window), window, not last)
            cuts = split_tail(cuts, window) if last else cuts[:-1]  # or the last window stays open
            rows, starts = [], [0, *cuts]
            at, w = 0, 0
            left = []
            for doc_id, ids, ends, total, begun in docs:
                while begun < total:
                    if w == len(cuts):
                        left.append((doc_id, ids, ends, total, begun))
                        break
                    size = min(total - begun, cuts[w] - at)
                    piece = ids[4 * begun:4 * (begun + size)]
                    rows.append((doc_id, begun, size, zlib.crc32(piece), total, (part << 33) + sequence + w,
                                 at - starts[w], piece))
                    begun, at = begun + size, at + size
                    if at == cuts[w]:
                        w += 1
            sequence += len(cuts)
            docs, held = left, sum(d[3] - d[4] for d in left)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else
                                              [pa.array([], t) for t in schema.types], schema=schema)

        for batch in batches:
            # A few texts of the batch become Python objects at a time.
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS).to_pydict()
                part = some["part"][-1]
                for doc_id, ids in zip(some["doc_id"], encode([t or "" for t in some["text"]])):
                    docs.append((doc_id, ids + end, encode.sentence_ends(ids), len(ids) // 4 + 1, 0))
                    held += len(ids) // 4 + 1
                    if held >= block_tokens:
                        yield place(False)
        if docs:
            yield place(True)
    return run


def pack(df: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pack documents, in the order of the rows, into sequences of at most ``window`` tokens; one row per piece.

    Columns: doc_id, start (tokens of the document before the piece), length, ids_crc32, doc_tokens (the end id
    counted), sequence_id, offset (place in the sequence), ids (the piece's ids, little-endian, four bytes each).
    Sequences are padded to ``window``, except those of a power of two. Windows end at document or sentence ends, or
    inside a sentence only where it is longer than a window; the choice is the cheapest by ``plan_cuts``.

    Each partition is packed by itself, without a shuffle: a run of the programme takes about ``block_tokens`` and
    hands its open window to the next, so memory depends on that and on the longest document, and only a partition's
    last sequence may be short of good ends. A hot source or copies change nothing, as no key is used.

    Null text is empty: the document is its end id. A null doc_id stays null. Repeated rows are packed each. An empty
    table gives an empty result. Other columns are ignored.
    """
    rows = df.select(F.spark_partition_id().cast("long").alias("part"), F.col(doc_id).cast("long").alias("doc_id"),
                     F.col(text).alias("text"))
    return rows.mapInArrow(_packer(tokenizer, window, block_tokens, end_id), PIECES)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack(table(spark, folder, "documents"), tokenizer_path()).drop("ids")
