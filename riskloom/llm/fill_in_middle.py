"""Fill-in-middle: an indexable skip list over a text's lines, whose lanes carry widths in units and in code points."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

# Fixed values of the contract: marks of the three parts, a unit (a line with its end), digest prefix, shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[^\n]*\n|[^\n]+"
SEED = "7"
RATE = 100
SPM_RATE = 50
# A unit is promoted to the next lane with one chance in FAN, drawn from its number.
FAN = 4


class SkipList:
    """Units in order, built by appending. Lane 0 links each unit to the next; a lane above links every FAN-th of the lane
    below, about. A link carries how many units and how many code points it passes, so a descent from the highest lane
    adds up both on the way and needs about FAN steps a lane.

    ``lanes[k]`` holds the links of lane k in order as (units, code points, place in lane k - 1 after the link).
    """

    def __init__(self, widths: Iterable[int]) -> None:
        self.lanes: list[list[tuple[int, int, int]]] = [[]]
        self.units = self.points = 0
        open_: list[list[int]] = [[0, 0]]  # what each lane's last, unfinished link has passed
        for width in widths:
            self.units += 1
            self.points += width
            draw = self.units * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF  # multiplicative hash of the unit's number
            draw ^= draw >> 32
            height = 0
            while height < len(open_) and draw % FAN == 0:  # at most one lane more than there are
                height, draw = height + 1, draw // FAN
            if height == len(open_):
                self.lanes.append([])
                open_.append([self.units - 1, self.points - width])
            self.lanes[0].append((1, width, 0))
            for k in range(1, len(open_)):
                open_[k][0] += 1
                open_[k][1] += width
                if k <= height:
                    self.lanes[k].append((*open_[k], len(self.lanes[k - 1])))
                    open_[k] = [0, 0]

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        units = points = place = 0
        for k in range(len(self.lanes) - 1, -1, -1):
            lane = self.lanes[k]
            below = lane[place - 1][2] if place else 0
            while place < len(lane) and units + lane[place][0] <= rank:
                units += lane[place][0]
                points += lane[place][1]
                below = lane[place][2]
                place += 1
            place = below
        return points


def cut_points(text: str | None, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and code points before the two cuts: the draws modulo the number of cut places, in order."""
    units = SkipList(m.end() - m.start() for m in re.finditer(UNIT, text or ""))
    a, b = sorted((first % (units.units + 1), second % (units.units + 1)))
    return units.units, units.points_before(a), units.points_before(b)


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits, the first digits of the sha256 of seed, colon and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """``df`` with fim_units, fim_form (plain, psm or spm), fim_text, fim_prefix_chars and fim_middle_chars.

    A text is cut at two ends of lines, drawn from the document's id, into prefix, middle and suffix. psm puts them as
    prefix, suffix, middle behind their marks, spm as suffix, prefix, middle. ``rate`` of a hundred texts are transformed,
    ``spm_rate`` of a hundred of these as spm.

    Cuts come from a skip list of the whole text's lines, in one pass and without a shuffle; only three numbers a row
    come back from Python. A text's list is as long as its lines.

    A null text counts as empty; an empty one, and one that holds a mark already, stays plain, with null part lengths. A
    null id counts as an empty one; equal ids draw alike, so repeated rows are transformed alike. Cuts that tie leave an
    empty middle, and the parts may be empty. Very long texts are cut whole. An empty table gives an empty result. Other
    columns pass through, those named like the new ones are replaced.
    """
    new = ["fim_units", "fim_form", "fim_text", "fim_prefix_chars", "fim_middle_chars"]
    df = df.drop(*new)

    @F.pandas_udf("units long, a long, b long")
    def cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        found = [cut_points(*row) for row in zip(texts, first, second)]
        return pd.DataFrame(found, columns=["units", "a", "b"], dtype="int64")

    h1, h2, h3, h4 = draws(F.col(doc_id), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    rows = df.withColumns({"_text": whole, "fim_form": form, "_cut": cuts(whole, h1, h2)})
    a, b = F.col("_cut.a").cast("int"), F.col("_cut.b").cast("int")
    prefix, middle = F.substring("_text", F.lit(1), a), F.substring("_text", a + 1, b - a)
    suffix = F.substring("_text", b + 1, F.length("_text"))
    shown = (
        F.when(F.col("fim_form") == "plain", F.col("_text"))
        .when(F.col("fim_form") == "psm", F.concat(
            F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    changed = F.col("fim_form") != "plain"
    return rows.withColumns({
        "fim_units": F.col("_cut.units"), "fim_text": shown, "fim_prefix_chars": F.when(changed, F.col("_cut.a")),
        "fim_middle_chars": F.when(changed, F.col("_cut.b") - F.col("_cut.a"))}).select(*df.columns, *new)


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed one came from. No mark can begin inside a part and end in the mark after it, so each
    mark is where it occurs first."""
    n = len(PREFIX)

    def between(start: Column, mark: str) -> tuple[Column, Column]:
        end = F.position(F.lit(mark), output, start)
        return F.substring(output, start, end - start), end + n

    def back(second: str) -> tuple[Column, Column, Column]:
        one, at = between(F.lit(n + 1), second)
        two, at = between(at, MIDDLE)
        return one, two, F.substring(output, at, F.length(output))

    prefix, suffix, middle = back(SUFFIX)
    late_suffix, late_prefix, late_middle = back(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix)).otherwise(output)
    )


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every transformed document and of the text restored from it."""
    found = fill_in_middle(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim_text"), F.col("fim_form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest
  from documents
), cut as (
  select doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as lines,
    cast('0x' || substr(digest, 1, 8) as ubigint) as h1, cast('0x' || substr(digest, 9, 8) as ubigint) as h2,
    cast('0x' || substr(digest, 25, 8) as ubigint) as h4
  from drawn
), ranked as (
  select *, len(lines) as n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) as a,
    greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from cut
), parts as (
  select *, array_to_string(lines[1:a], '') as prefix, array_to_string(lines[a + 1:b], '') as middle,
    array_to_string(lines[b + 1:n], '') as suffix
  from ranked
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
