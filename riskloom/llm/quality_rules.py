"""Quality rules, line first: lines that fail a rule go, then documents that lose too much text go. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, table

WHITE = r"[ \t\n\x0B\f\r]+"
# Fixed values of the contract.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT = 30
# A document may lose this share of its words' characters to the line rules.
MAX_LOST = 0.5
# A line without a closing mark is kept from this many words on.
OPEN_WORDS = 4
MANY_WORDS = rf"\A(?:[^ \t\n\x0B\f\r]+[ \t\n\x0B\f\r]+){{{OPEN_WORDS - 1}}}[^ \t\n\x0B\f\r]"
# A line fails if this share of its words are separators, or end in symbols or doubled exclamation marks.
SEPARATOR_SHARE = 0.2
NOISE_SHARE = 0.4
CLOSING = r"[.!?:;\"'’”»)。！？…]$"
SEPARATOR = r"(?:^| )(?:\||>|>>|»|•|·|/)(?= |$)"
NOISE = r"(?:[#*$%&|<>]{2,}|!{2,})(?= |[.,;:]|$)"
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|terms (?:of (?:use|service)|and conditions)|privacy policy|cookie (?:policy|settings)|"
    r"accept (?:all )?cookies|we use cookies|enable javascript|javascript is (?:disabled|required)|lorem ipsum|"
    r"click here|sign up (?:now|for)|log ?in to|skip to (?:main )?content|back to top|share (?:this|on)|"
    r"licensed under|released under the|copyright (?:\(c\)|©|[0-9]{4}))\b"
)


def words_of(text: Column) -> Column:
    """Words between white space (space, U+0009 to U+000D); an empty array for a text without any."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE))


def with_window_hashes(df: DataFrame, words: str, name: str, width: int = WINDOW) -> DataFrame:
    """Add a hash of every window of ``width`` (a power of two) words, by hashing neighbours of neighbours.

    Each doubling is a column of its own, so it is computed once and read by position.
    """
    df, step = df.withColumn(name, F.transform(words, lambda w: F.xxhash64(w))), 1
    while step < width:
        before, name_ = name if step == 1 else f"{name}{step}", f"{name}{2 * step}"
        df = df.withColumn(name_, F.expr(f"transform({before}, (x, i) -> xxhash64(x, get({before}, i + {step})))"))
        step *= 2
    whole = F.greatest(F.size(words) - (width - 1), F.lit(0))
    return df.withColumn(name, F.slice(f"{name}{width}", F.lit(1), whole)).drop(
        *[f"{name}{2 ** k}" for k in range(1, width.bit_length())])


def repeat_words(places: str, width: int = WINDOW) -> Column:
    """Words inside the windows that begin at ``places``: the length of the union of their spans."""
    return F.expr(f"""aggregate(
        array_sort(transform({places}, x -> x.i)), named_struct('last', -{width}, 'n', 0),
        (acc, i) -> named_struct('last', i, 'n', acc.n + least({width}, i - acc.last)), acc -> acc.n)""")


def line_fails(line: Column) -> Column:
    """Whether a line with a word fails: no closing mark on a short line, navigation, boilerplate, or symbol noise."""
    bare = F.btrim(line, F.lit(SPACE))
    n = F.size(F.split(bare, WHITE))  # looked at only where a line has separators or noise
    unclosed = ~bare.rlike(MANY_WORDS) & ~bare.rlike(CLOSING)
    separators, noises = F.regexp_count(bare, F.lit(SEPARATOR)), F.regexp_count(bare, F.lit(NOISE))
    navigation = (separators > 1) & (separators > SEPARATOR_SHARE * n)
    noise = (noises > 0) & (noises > NOISE_SHARE * n)
    return (bare != "") & (unclosed | navigation | noise | bare.rlike(BOILERPLATE))


def quality_rules(df: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Every row of ``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text,
    lost_share and kept.

    Lines are judged first and failing ones removed (``clean_text`` is what is left); a document is then kept unless it
    fails a base count or lost more than ``max_lost`` of its words' characters. All of it happens inside the row, with
    SQL functions: no exchange, and a hot source or many copies change nothing. Windows of words are compared by 64-bit
    hashes, first for any repeat; only documents with one sort their windows. Work grows linearly with a text's length.

    Null and empty texts have no words: all counts 0, base_failed, not kept, clean_text ''. Repeated rows are judged
    each; an empty table gives an empty result; other columns pass through, those with clashing names are replaced.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text",
           "lost_share", "kept"]
    help_ = ["_words", "_hashes", "_sorted", "_again", "_lines"]
    rest = [c for c in df.columns if c not in new]
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    split = df.select(*rest, words_of(F.col(text)).alias("_words"))
    out = (
        with_window_hashes(split, "_words", "_hashes")
        .select(*rest, F.size("_words").cast("long").alias("n_words"),
                F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
                "_hashes", lines.alias("_lines"))
        .withColumn("_sorted", F.when(repeats, F.array_sort(F.transform(
            "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_again", F.expr(
            "filter(_sorted, (x, j) -> x.h <=> get(_sorted, j - 1).h or x.h <=> get(_sorted, j + 1).h)"))
        .withColumn("n_repeat_words", F.coalesce(repeat_words("_again"), F.lit(0)).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("clean_text", F.array_join(F.filter("_lines", lambda x: ~line_fails(x)), "\n"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    )
    left = F.length(F.regexp_replace("clean_text", WHITE, ""))
    lost = F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(0.0))
    out = out.withColumn("lost_share", lost).withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= max_lost))
    return out.drop(*help_).select(*rest, *new)


def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP10_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
win as (select r, unnest(range(1, greatest(len(words) - 6, 1))) as i, words from w),
dup as (select r, unnest(list(i)) as i from win group by r, array_to_string(words[i:i + 7], ' ') having count(*) > 1),
rep as (select r, count(distinct i + k) as n from dup, (select unnest(range(0, 8)) as k) group by r),
l as (select *, list_filter(lines, lambda x: not (
   (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) < 4
    and not regexp_matches(regexp_replace(x, '[\x20\x09-\x0D]+$', ''), '[.!?:;"''\x{2019}\x{201d}\x{00bb})\x{3002}\x{ff01}\x{ff1f}\x{2026}]$'))
   or len(regexp_extract_all(regexp_replace(x, ' ', '  ', 'g'), '(?:^| )(?:\||>|>>|\x{00bb}|\x{2022}|\x{00b7}|/)(?: |$)'))
      > greatest(1.0, 0.2 * len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))
   or len(regexp_extract_all(regexp_replace(x, '[\x20\x09-\x0D]+$', ''), '(?:[#*$%&|<>]{2,}|!{2,})(?: |[.,;:]|$)'))
      > 0.4 * len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))
   or regexp_matches(x, '(?i)\b(?:all rights reserved|terms (?:of (?:use|service)|and conditions)|privacy policy|cookie (?:policy|settings)|accept (?:all )?cookies|we use cookies|enable javascript|javascript is (?:disabled|required)|lorem ipsum|click here|sign up (?:now|for)|log ?in to|skip to (?:main )?content|back to top|share (?:this|on)|licensed under|released under the|copyright (?:\(c\)|©|[0-9]{4}))\b'))) as clean
 from w),
c as (select l.*, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
   coalesce(rep.n, 0) as n_repeat_words,
   length(regexp_replace(array_to_string(clean, ''), '[\x20\x09-\x0D]+', '', 'g')) as clean_chars
 from l left join rep using (r))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and
    (word_chars = 0 or 1 - clean_chars / word_chars <= 0.5) as kept
from c
"""
