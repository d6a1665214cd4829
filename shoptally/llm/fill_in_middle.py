"""Fill-in-the-middle: texts cut at two unit borders and written in an order that asks for the middle last.

One ``fullmatch`` of ``(unit)*`` by the regex library, which keeps every repetition of a group, gives all borders at once:
``match.ends(1)`` has as many entries as the text has units, and the two cut offsets are entries of it. Only the offsets
come back from the workers; the pieces are put together, and taken apart again, by string functions.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import table


@dataclass(frozen=True)
class Settings:
    """``rate`` of 100 texts are cut, ``spm_rate`` of 100 of these have the suffix first."""

    unit: str = r"[^\n]*\n|[^\n]+"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 7
    rate: int = 100
    spm_rate: int = 50

    def __post_init__(self):
        """The marks must not overlap with one another, else a piece beside a mark could show another one."""
        marks = (self.prefix, self.suffix, self.middle)
        clash = len(set(marks)) < len(marks) or not all(marks)
        for a in marks:
            for b in marks:
                if clash or (a != b and a in b) or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                    raise ValueError("marks must be different, not empty, and must not overlap")


DEFAULT = Settings()


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first four 8-digit groups of a hash of seed and id.

    A null id counts as an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cut_offsets(text: Column, first: Column, second: Column, unit=DEFAULT.unit) -> Column:
    """Struct ``(n, start, stop)``: units of the text, and where prefix and middle end, in code points.

    Prefix and middle end after the smaller and the larger of ``first % (n + 1)`` and ``second % (n + 1)`` units. A text
    that units do not cover wholly gives nulls.
    """

    @F.pandas_udf("n long, start long, stop long")
    def offsets(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        import regex

        units, rows = regex.compile(f"({unit})*"), []
        for value, a, b in zip(texts, first, second, strict=True):
            match = units.fullmatch(value)
            if match is None:
                rows.append((None, None, None))
                continue
            ends = match.ends(1)
            n = len(ends)
            low, high = sorted((a % (n + 1), b % (n + 1)))
            rows.append((n, ends[low - 1] if low else 0, ends[high - 1] if high else 0))
        return pd.DataFrame(rows, columns=["n", "start", "stop"]).astype("Int64")

    return offsets(text, first, second)


def fill_in_middle(docs: DataFrame, settings=DEFAULT, id_column="doc_id", text_column="text") -> DataFrame:
    """Add one struct column ``fim (n, form, prefix_chars, middle_chars, output)`` to every row.

    A null text counts as empty. Empty texts, texts that hold a mark, and those that the draw spares keep their text
    (``plain``, without lengths). Ties of the two cuts give an empty middle. Cuts follow from the id alone, so rows that
    repeat an id and a text give the same result; rows without an id draw alike. An input column ``fim`` is replaced, all
    others pass through. No row depends on another, nothing is shuffled.
    """
    s = settings
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    h = draws(F.col(id_column), s.seed)
    given = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c != "fim"]).alias("row"),
        text.alias("text"),
        F.struct(*[x.alias(f"h{i + 1}") for i, x in enumerate(h)]).alias("draw"),
    )
    cut = given.withColumn("cut", cut_offsets(F.col("text"), F.col("draw.h1"), F.col("draw.h2"), s.unit))
    text, start, stop = F.col("text"), F.col("cut.start"), F.col("cut.stop")
    marked = F.lit(False)
    for mark in (s.prefix, s.suffix, s.middle):
        marked = marked | F.contains(text, F.lit(mark))
    plain = (F.length(text) == 0) | marked | (F.col("draw.h3") % 100 >= s.rate) | start.isNull()
    form = F.when(plain, "plain").when(F.col("draw.h4") % 100 < s.spm_rate, "spm").otherwise("psm")
    formed = cut.withColumn("form", form)
    prefix = F.substr(text, F.lit(1), start)
    middle = F.substr(text, start + 1, stop - start)
    suffix = F.substr(text, stop + 1)
    p, x, m = F.lit(s.prefix), F.lit(s.suffix), F.lit(s.middle)
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "spm", F.concat(x, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, x, suffix, m, middle))
    )
    lengths = [F.when(F.col("form") != "plain", v).alias(name) for v, name in ((start, "prefix_chars"), (stop - start, "middle_chars"))]
    result = F.struct(F.col("cut.n").alias("n"), "form", *lengths, output.alias("output"))
    return formed.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "fim"], result.alias("fim"))


def restored(output: Column, form: Column, settings=DEFAULT) -> Column:
    """The text that an output was made from. The pieces hold no mark, so each mark is found at its first place."""
    s = settings

    def after(value, mark):
        return F.substr(value, F.instr(value, F.lit(mark)) + F.lit(len(mark)))

    def before(value, mark):
        return F.substring_index(value, mark, 1)

    tail = after(output, s.middle)
    psm = F.concat(before(after(output, s.prefix), s.suffix), tail, before(after(output, s.suffix), s.middle))
    spm = F.concat(before(after(output, s.prefix), s.middle), tail, before(after(output, s.suffix), s.prefix))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || CAST(doc_id AS VARCHAR)) AS s FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS x,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""

QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
ORACLES = {"op12_fill_in_middle": ORACLE}
