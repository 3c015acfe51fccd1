"""Chat formatting: whole conversations rendered, encoded once with offsets, and masked by intersecting spans."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

# The template: each turn is TURN role TEXT text END. A text or role cannot hold a mark, as its `<|` is escaped.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TRAINED_ROLE = "assistant"
# Characters after which a conversation goes on in a further row; marks keep tokens from crossing the border.
SEGMENT_CHARS = 1_000_000
# Characters that are encoded in one call.
BATCH_CHARS = 300_000
FORMATTED = "conv_id long, segment long, n_turns long, formatted string, input_ids array<int>, loss_mask array<boolean>, token_starts array<int>, token_ends array<int>"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    """Backslashes doubled, then every ``<|`` broken by one; undone by ``unescape``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], trained: str = TRAINED_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and the spans, in order, of the trained role's texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def span_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span: one binary search of the tokens' starts in the spans' starts."""
    if not spans or not len(starts):
        return np.zeros(len(starts), bool)
    firsts, lasts = (np.array(x) for x in zip(*spans))
    place = np.searchsorted(firsts, starts, "right") - 1
    return (place >= 0) & (ends <= lasts[place]) & (starts < ends)


def chat_tokenizer(path: str):
    """The byte-level tokenizer with the template's marks as whole tokens."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (TURN, TEXT, END)])
    return tokenizer


def _format(path: str, segment_chars: int, trained: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = chat_tokenizer(path)
        held: list[tuple] = []
        turns: list[tuple[str, str]] = []
        now, size, segment, ready = None, 0, 0, 0

        def close(more: bool) -> None:
            nonlocal turns, size, segment, ready
            text, spans = render(turns, trained)
            held.append((now, segment, len(turns), text, spans))
            ready += len(text)
            turns, size, segment = [], 0, segment + 1 if more else 0

        def out() -> pd.DataFrame:
            nonlocal held, ready
            rows = []
            for (conv, part, n, text, spans), enc in zip(
                    held, tokenizer.encode_batch([x[3] for x in held], add_special_tokens=False)):
                offsets = np.array(enc.offsets, "i4").reshape(-1, 2)
                mask = span_mask(offsets[:, 0], offsets[:, 1], spans)
                rows.append((conv, part, n, text, enc.ids, mask, offsets[:, 0], offsets[:, 1]))
            held, ready = [], 0
            return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in FORMATTED.split(", ")])

        for batch in batches:
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if turns and conv != now:
                    close(False)
                elif size >= segment_chars:
                    close(True)
                if conv != now:
                    segment = 0
                now = conv
                turns.append((role or "", text or ""))
                size += len(role or "") + len(text or "")
                if ready >= BATCH_CHARS:
                    yield out()
        if turns:
            close(False)
        if held:
            yield out()
    return run


def format_chats(df: DataFrame, tokenizer: str, trained: str = TRAINED_ROLE, segment_chars: int = SEGMENT_CHARS
                 ) -> DataFrame:
    """Render each conversation, encode it once, and mark the tokens of the trained role's texts.

    Columns: conv_id, segment, n_turns, formatted, input_ids, loss_mask (per token), token_starts and token_ends
    (characters of ``formatted``). Turns are ordered by turn, then role and text. One exchange by conversation brings
    turns together, sorted on disk; a task streams through them. A conversation longer than ``segment_chars``, up to one
    that holds a third of all rows, comes as several rows cut between turns, so memory stays bounded. Its turns stay in
    one task, because the order of a conversation is one sequence.

    Null texts and roles are empty; rows of a null conv_id form one conversation; repeated rows are turns each; an empty
    table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInPandas(_format(tokenizer, segment_chars, trained), FORMATTED)
    )


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_text(formatted: str, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text under the mask, unescaped: runs of masked tokens, each character once."""
    places = np.flatnonzero(mask)
    if not len(places):
        return ""
    cut = np.flatnonzero(np.diff(places) > 1)
    firsts, lasts = places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]]
    return "".join(unescape(formatted[starts[a]:ends[b]]) for a, b in zip(firsts, lasts))


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state: list | None = None

    def row() -> tuple:
        conv, n, turns, chars, loss, size = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

    for batch in batches:
        rows = []
        for x in batch.itertuples(index=False):
            if x.segment == 0:
                rows += [row()] if state else []
                state = [None if pd.isna(x.conv_id) else int(x.conv_id), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_back(x.formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            loss = loss_text(x.formatted, np.asarray(x.loss_mask, bool), x.token_starts, x.token_ends)
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += len(x.formatted)
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in DIGEST.split(", ")])
    if state:
        yield pd.DataFrame([row()], columns=[c.split(" ")[0] for c in DIGEST.split(", ")])


def digests(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, read back from the formatted rows as they stream by."""
    return formatted.select("conv_id", "segment", "formatted", "loss_mask",
                            "token_starts", "token_ends").mapInPandas(_digest, DIGEST)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Fixed values of the contract: a conversation whose texts hold control strings.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations and of conversation -7."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return digests(format_chats(given.unionByName(planted), tokenizer_path()))
