"""Language ID by Bayesian evidence fusion: text, declared markup language, address suffix and host priors."""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import UPPER, stage_table, table

# Labelled documents the text model is fitted on, about, dealt out evenly to the languages: of each language those of the
# smallest digests of their id, at least LEAST_ROWS if it has as many.
TRAIN_ROWS = 4_000
LEAST_ROWS = 100
# Bytes of an n-gram, and hashed cells of the likelihood tables.
GRAM = 3
CELLS = 1 << 14
# A document's n-grams overlap and repeat, so their log-likelihoods are discounted, and held to this many nats.
DISCOUNT = 0.2
MAX_TEXT_NATS = 30.0
# A language without a text model counts as one whose n-grams are this many nats less likely than a modelled language's
# own usually are: text of a modelled language is told from it, any other text says little.
NEUTRAL_NATS = 0.75
# How often a declaration, or a suffix that names a language, is right.
DECLARED_TRUST = 0.85
SUFFIX_TRUST = 0.6
# Rows that each level of the priors counts as: all languages alike, whole table, domain, host.
PRIOR_ROWS = (1.0, 20.0, 10.0)
# Most likely languages that must reach this to be named; below it the answer is `und`.
MIN_POSTERIOR = 0.5
# Suffixes that suggest a language, and path parts do so by the language's own code.
SUFFIX = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en",
          "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "kr": "ko"}
# The two-letter codes of ISO 639-1. Any other code that a label, declaration or path names is unknown, so
# the languages to choose from are these at most, whatever a crawl declares.
CODES = frozenset("""
aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et
eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl
km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj
om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to
tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu
""".split())
_TAG = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_CHUNK = 1 << 20


@dataclass
class TextModel:
    """Log-likelihoods of hashed byte n-grams by language; its size is languages times cells."""

    languages: list[str] = field(default_factory=list)
    logs: np.ndarray = field(default_factory=lambda: np.zeros((0, CELLS)))  # of the first of the languages
    neutral: float = 0.0  # log-likelihood of an n-gram under each of the others

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.append(self.logs @ counts, np.full(len(self.languages) - len(self.logs), self.neutral * counts.sum()))


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of the whole lower-cased text, in pieces of bounded size."""
    raw = np.frombuffer((text or "").lower().encode(), "u1")
    out = np.zeros(CELLS, "i8")
    for at in range(0, max(0, len(raw) - GRAM + 1), _CHUNK):
        part = raw[at:at + _CHUNK + GRAM - 1].astype("u4")
        key = part[:len(part) - GRAM + 1].copy()
        for i in range(1, GRAM):
            key = key * np.uint32(257) + part[i:len(part) - GRAM + 1 + i]
        key *= np.uint32(2654435761)
        out += np.bincount(key >> np.uint32(32 - 14), minlength=CELLS)
    return out


def named_languages(pages: DataFrame, html: str = "html", url: str = "url") -> set[str]:
    """Known languages that pages declare or whose suffix suggests one, by a grouped count."""
    _, _, suffix = address(F.col(url))
    names = F.create_map(*[F.lit(x) for pair in SUFFIX.items() for x in pair])
    said = F.array(declared_language(F.col(html)), F.try_element_at(names, suffix))
    found = pages.select(F.explode(said).alias("lang")).filter(F.col("lang").isin(*sorted(CODES))).groupBy("lang").count()
    return {r.lang for r in found.collect()}


def train_text(documents: DataFrame, label: str = "lang", rows: int = TRAIN_ROWS, named: set[str] = frozenset()) -> TextModel:
    """N-gram likelihoods of every known language that labels name, from a bounded sample of each; those only ``named``
    elsewhere, or without text, follow with a neutral likelihood. Counts are summed in the tasks, then by language."""
    labelled = documents.filter(F.col(label).isin(*sorted(CODES)))
    with_text = F.col("text").isNotNull() & (F.col("text") != "")
    found = {r.lang: r.n for r in labelled.groupBy(F.col(label).alias("lang")).agg(
        F.count_if(with_text).alias("n")).collect()}
    modelled = {x: n for x, n in found.items() if n}
    if not modelled:
        return TextModel(sorted(found.keys() | named))
    most = max(LEAST_ROWS, -(-rows // len(modelled)))
    # Digests up to a bound that leaves about twice the rows needed, so that no language's rows meet in one task.
    shares = F.create_map(*[F.lit(x) for k, n in sorted(modelled.items()) for x in (k, min(1.0, 2 * most / n))])
    digest = F.xxhash64("doc_id")
    low = F.pmod(digest, F.lit(1 << 30)) < F.try_element_at(shares, F.col(label)) * (1 << 30)
    ids = labelled.filter(with_text & low & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).alias("lang"), F.pmod(digest, F.lit(1 << 30)).alias("digest")).distinct()
    order = Window.partitionBy("lang").orderBy("digest", "doc_id")
    sample = ids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("doc_id", "lang")
    # The bounded number of ids above for each language.
    chosen = documents.filter(with_text).select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                sums[lang] = sums.get(lang, 0) + gram_counts(text)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "counts": [c.astype("<i8").tobytes() for c in sums.values()]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        whole = sum(np.frombuffer(c, "<i8") for c in parts["counts"])
        return pd.DataFrame({"lang": parts["lang"][:1], "counts": [whole.tobytes()]})

    schema = "lang string, counts binary"
    total = {r.lang: np.frombuffer(r.counts, "<i8") for r in chosen.mapInPandas(count, schema).groupBy("lang").applyInPandas(
        add, schema).toLocalIterator()}
    languages = sorted(total)
    if not languages:
        return TextModel(sorted(found.keys() | named))
    counts = np.array([total[x] for x in languages], "f8") + 0.5
    shares_ = counts / counts.sum(1, keepdims=True)
    neutral = float((shares_ * np.log(shares_)).sum(1).mean()) - NEUTRAL_NATS
    return TextModel([*languages, *sorted((found.keys() | named) - set(languages))], np.log(shares_), neutral)


def visible_text(html: str | None) -> str:
    """Text of a page without scripts, styles, comments and tags."""
    return _TAG.sub(" ", html or "")


def text_evidence(model: TextModel, text: Column, markup: bool) -> Column:
    """Log-likelihood of the text under each language, the best at 0; all 0 where there is no text."""
    def run(batch: pd.Series) -> pd.Series:
        out = []
        for t in batch:
            counts = gram_counts(visible_text(t) if markup else t)
            logs = model.of(counts) * DISCOUNT
            out.append(np.maximum(logs - logs.max(initial=-np.inf), -MAX_TEXT_NATS) if len(logs) else logs)
        return pd.Series(out)

    return F.pandas_udf(run, "array<double>")(text)


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (its last two labels) and suffix (its last label), empty for an address without host."""
    host = F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())
    host = F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":[0-9]*\z", "")
    return host, F.regexp_extract(host, r"[^.]+\.[^.]+\z", 0), F.regexp_extract(host, r"[^.]+\z", 0)


def declared_language(html: Column) -> Column:
    """Language code that the markup's root element declares, or empty."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def voice(code: Column, languages: list[str], trust: float) -> Column:
    """Log-likelihoods of a named code under the languages; nothing said, or a language unknown here, weighs nothing."""
    rest = math.log((1 - trust) / max(1, len(languages) - 1)) if len(languages) > 1 else 0.0
    heard = F.coalesce(code.isin(languages), F.lit(False))
    return F.transform(F.lit(languages), lambda x: F.when(~heard, 0.0).when(x == code, math.log(trust)).otherwise(rest))


def fuse(rows: DataFrame, languages: list[str], key_columns: list[str]) -> DataFrame:
    """Posterior from evidence ``e`` (text, markup and suffix, as logs by language) and host priors.

    Grouped sums of the evidence's own posteriors by host give the host counts, their sums the domain counts, and those
    the whole table's. Each level's prior is smoothed by the one above: (counts + m * prior above) / (rows + m). A row's
    own vote is taken out of all three counts, so its evidence counts once. Of equal posteriors the language that comes
    first in ``languages`` is named.
    """
    spark = rows.sparkSession
    k = len(languages)
    top = F.array_max("e")
    raw = F.transform("e", lambda v: F.exp(v - top))
    rows = rows.withColumn("raw", raw).withColumn(
        "soft", F.expr("transform(raw, v -> round(v / aggregate(raw, 0D, (a, b) -> a + b), 6))"))
    sums = [F.sum(F.col("soft")[i].cast("decimal(28,6)")).alias(f"c{i}") for i in range(k)]
    hosts = stage_table(spark, rows.groupBy("domain", "host").agg(F.count("*").alias("n"), *sums), "host-counts")
    up = [F.sum(f"c{i}").alias(f"d{i}") for i in range(k)]
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("m"), *up)
    whole = domains.agg(F.sum("m"), *[F.sum(f"d{i}") for i in range(k)]).first()
    total, sums_ = float(whole[0] or 0), [float(x or 0) for x in whole[1:]]
    middle = domains.select("domain", "m", F.array(*[F.col(f"d{i}").cast("double") for i in range(k)]).alias("d"))
    counts = hosts.join(middle, "domain").select(
        "host", "n", "m", "d", F.array(*[F.col(f"c{i}").cast("double") for i in range(k)]).alias("c"))
    joined = rows.join(counts, "host").withColumn("w", F.lit(sums_))
    table_, domain_, host_ = PRIOR_ROWS
    # A vote that was rounded up may leave a hair less than nothing.
    prior = f"""transform(w, (x, i) ->
        (greatest(c[i] - soft[i], 0D) + {host_}D * (
            greatest(d[i] - soft[i], 0D) + {domain_}D * (
                greatest(x - soft[i], 0D) + {table_}D / {k}) / ({total}D - 1 + {table_}D)
        ) / (m - 1 + {domain_}D)) / (n - 1 + {host_}D))"""
    joined = joined.withColumn("prior", F.expr(prior))
    joined = joined.withColumn("all", F.zip_with("e", "prior", lambda a, b: a + F.log(b)))
    joined = joined.withColumn("raw", F.expr("transform(all, v -> exp(v - array_max(all)))")).withColumn(
        "post", F.expr("transform(raw, v -> v / aggregate(raw, 0D, (a, b) -> a + b))"))
    best = F.array_position("post", F.array_max("post"))
    return joined.select(
        *key_columns, "declared", "suffix", "host",
        F.when(F.array_max("post") >= MIN_POSTERIOR, F.element_at(F.lit(languages), best.cast("int")))
        .otherwise("und").alias("language"), F.round(F.array_max("post"), 6).alias("posterior"))


def identify(df: DataFrame, model: TextModel, key: str, text: str, url: str | None = None, host: str | None = None,
             markup: bool = False) -> DataFrame:
    """Language of each row: key, declared, suffix, host, language, posterior.

    Evidence adds up as logs: the whole text's n-gram likelihood, the language its markup declares (``markup``), the
    address's suffix or path part (``url``), and a prior of the host (from ``url``, or the column ``host``), smoothed
    towards its domain and the whole table. The text is read once; evidence, a few numbers a row, is written to the
    shared folder, counted by host with partial sums before the exchange, and joined with the host's prior.

    Null texts and addresses say nothing; a row without any evidence gets the prior of the other rows, `und` if that is
    below one half. Very long texts are read whole, piece by piece. Ties go to the language that comes first in the
    model: the modelled ones by code, then the others by code. Repeated rows count and appear each; an empty table or a model without languages gives no rows or
    `und` with posterior 0. Other columns are ignored. A host with a third of all rows is one row of the counts.
    """
    spark = df.sparkSession
    spot, domain, suffix = address(F.col(url)) if url else (
        F.coalesce(F.col(host).cast("string") if host else F.lit(""), F.lit("")), F.lit(""), F.lit(""))
    part = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://[^/?#]*/([A-Za-z]{2})(?:[/?#]|\z)", 1), F.lit(""))
                   ) if url else F.lit("")
    names = F.create_map(*[F.lit(x) for pair in SUFFIX.items() for x in pair])
    hint = F.when(part.isin(model.languages), part).otherwise(F.coalesce(F.try_element_at(names, suffix), F.lit("")))
    declared = declared_language(F.col(text)) if markup else F.lit("")
    base = df.select(F.col(key).alias(key), declared.alias("declared"), hint.alias("suffix"), spot.alias("host"),
                     domain.alias("domain"), text_evidence(model, F.col(text), markup).alias("text_e"))
    if not model.languages:
        return base.select(key, "declared", "suffix", "host", F.lit("und").alias("language"),
                           F.lit(0.0).alias("posterior"))
    said = F.zip_with(voice(F.col("declared"), model.languages, DECLARED_TRUST),
                      voice(F.col("suffix"), model.languages, SUFFIX_TRUST), lambda a, b: a + b)
    rows = base.select(key, "declared", "suffix", "host", "domain", F.zip_with("text_e", said, lambda a, b: a + b).alias("e"))
    return fuse(stage_table(spark, rows, "evidence"), model.languages, [key])


def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every page (page_id set) and of every document (doc_id set; its source stands for a host)."""
    documents = table(spark, folder, "documents")
    pages = table(spark, folder, "pages")
    model = train_text(documents, named=named_languages(pages))
    pages = identify(pages, model, "page_id", "html", url="url", markup=True)
    texts = identify(documents, model, "doc_id", "text", host="source")
    rest = ["declared", "suffix", "host", "language", "posterior"]
    empty = F.lit(None).cast("long")
    return texts.select("doc_id", empty.alias("page_id"), *rest).unionByName(
        pages.select(empty.alias("doc_id"), "page_id", *rest))
