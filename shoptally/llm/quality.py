"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document is measured once. Values fall into logarithmic buckets (ratio ``GAMMA`` apart) and the bucket counts per
language and source are a quantile sketch of bounded relative error: two sketches merge by adding counts, in any order
and with the same result, so the sketches of a language and of the whole corpus are sums of those of its sources.
A threshold is the upper fence q75 + ``FENCE`` * (q75 - q25) of a measure in its language and source, or in the nearest
larger population while the group has fewer than ``MIN_GROUP`` documents. Where the quartiles lie closer together than one
step of the measure in a document of median size, that step takes the place of their distance; median sizes come from
sketches of the same population, so no threshold is a fixed number. Thresholds are joined to the measures.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shoptally.llm.common import SPACE_CLASS, let, table, word_array
from shoptally.session import checkpointed

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

GAMMA = 1.02
FENCE = 6.0
MIN_GROUP = 200
QUANTILES = {"low": 0.25, "middle": 0.5, "high": 0.75}

# Each measure's smallest step, in units of its document size: one symbol or character of the words, one line of the lines,
# one repeated window.
STEPS = {"symbols_per_word": (1, "n_words"), "chars_per_word": (1, "n_words"), "dup_lines_per_line": (1, "n_lines"), "repeats_per_word": (WINDOW, "n_words")}
SIZES = ("n_words", "n_lines")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(hashes):
    """Words covered by windows whose hash occurs at least twice; hashes in window order."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(a, b):
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def positions(p):
        twice = F.filter(
            p, lambda x, i: same(x, F.when(i > 0, F.get(p, i - 1))) | same(x, F.get(p, i + 1))
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(starts):
        step = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda total, n: total + n)

    return let(let(placed, positions), covered)


def measures(docs: DataFrame, text="text") -> DataFrame:
    """``docs`` without its text, with the counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines``.

    Null and empty texts have no words. Columns of these names in the input are replaced.
    """
    kept = [c for c in docs.columns if c not in {text, *COUNTS, "n_lines", "_text", "_words", "_lines", "_hashes"}]
    split = docs.select(
        *kept,
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).select("*", word_array(F.col("_text")).alias("_words"))
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    window_hashes = let(
        F.transform(F.col("_words"), lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>")),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
        ),
    )
    wide = split.select("*", lines.alias("_lines"), window_hashes.alias("_hashes"))
    return wide.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _repeat_words(F.col("_hashes")))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def ratios() -> dict:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "chars_per_word": F.col("word_chars") / words,
        "dup_lines_per_line": F.col("n_dup_lines") / lines,
        "repeats_per_word": F.col("n_repeat_words") / words,
    }


def sketch(measured: DataFrame, groups=("lang", "source")) -> DataFrame:
    """Bucket counts ``(*groups, measure, bucket, n)`` of every ratio and size; zero has a bucket of its own (null)."""
    sizes = {name: F.col(name).cast("double") for name in SIZES}
    values = F.explode(F.create_map(*[x for name, c in {**ratios(), **sizes}.items() for x in (F.lit(name), c)]))
    bucket = F.when(F.col("value") > 0, F.ceil(F.log(F.col("value")) / math.log(GAMMA)))
    return (
        measured.select(*groups, values.alias("measure", "value"))
        .groupBy(*groups, "measure", bucket.cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, groups=()) -> DataFrame:
    """Sum sketches over all grouping columns but ``groups``."""
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, groups=(), least=1) -> DataFrame:
    """``(*groups, measure, low, middle, high)`` for groups of at least ``least`` documents."""
    by = W.partitionBy(*groups, "measure")
    running = by.orderBy(F.col("bucket").asc_nulls_first())
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    at = sketches.withColumns({"_upto": F.sum("n").over(running), "_all": F.sum("n").over(by), "_value": value})
    quantile = {
        name: F.min(F.when(F.col("_upto") >= F.ceil(q * F.col("_all")), F.col("_value"))) for name, q in QUANTILES.items()
    }
    found = at.groupBy(*groups, "measure").agg(
        *[c.alias(name) for name, c in quantile.items()], F.max("_all").alias("_all")
    )
    return found.filter(F.col("_all") >= least).select(*groups, "measure", *QUANTILES)


def fences(sketches: DataFrame, groups=(), least=1, prefix="fence") -> DataFrame:
    """One row ``(*groups, <prefix>_<measure>, ...)`` for each group of at least ``least`` documents."""

    def of(measure, name):
        return F.max(F.when(F.col("measure") == measure, F.col(name)))

    columns = []
    for measure, (step, size) in STEPS.items():
        least_spread = step / F.greatest(of(size, "middle"), F.lit(1.0))
        high = of(measure, "high")
        columns.append((high + FENCE * F.greatest(high - of(measure, "low"), least_spread)).alias(f"{prefix}_{measure}"))
    return quartiles(sketches, groups, least).groupBy(*groups).agg(*columns)


def thresholds(measured: DataFrame, min_group=MIN_GROUP) -> DataFrame:
    """One row per language and source (nulls are a value) with the fence of each measure."""
    own = checkpointed(sketch(measured))
    by_source = fences(own, ("lang", "source"), min_group, "s")
    by_lang = fences(merge(own, ("lang",)), ("lang",), min_group, "l")
    overall = fences(merge(own), prefix="a")
    groups = own.select("lang", "source").distinct()
    joined = (
        groups.alias("g")
        .join(by_source.alias("s"), F.expr("g.lang <=> s.lang AND g.source <=> s.source"), "left")
        .join(by_lang.alias("l"), F.expr("g.lang <=> l.lang"), "left")
    )
    general = overall.first()
    return joined.select(
        "g.lang",
        "g.source",
        *[
            F.coalesce(f"s_{m}", f"l_{m}", F.lit(general[f"a_{m}"] if general else None).cast("double")).alias(f"fence_{m}")
            for m in STEPS
        ],
    )


def judge(docs: DataFrame, min_group=MIN_GROUP) -> DataFrame:
    """Measures of every document with ``base_failed`` and ``kept``.

    ``docs`` needs ``text``, ``lang`` and ``source``; all other columns pass through. ``base_failed`` holds for fewer than
    20 words, or more than 30 % of the words in repeated windows. Others are kept unless a ratio lies above its fence. An input
    column ``_limit`` is dropped.
    Null languages and sources form groups of their own; null and empty texts fail; repeated rows are judged alike; an
    empty table gives an empty result.
    """
    measured = checkpointed(measures(docs))
    limits = checkpointed(thresholds(measured, min_group)).select(F.struct("*").alias("_limit"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.lit(True)
    for name, value in ratios().items():
        inside = inside & (value <= F.col(f"_limit.fence_{name}"))
    measured = measured.drop("_limit")
    joined = measured.join(limits, F.expr("lang <=> _limit.lang AND source <=> _limit.source"), "left")
    return joined.select(
        *[c for c in measured.columns if c not in ("base_failed", "kept")],
        failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(True))).alias("kept"),
    )


def keep_good(docs: DataFrame, min_group=MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged and with all their columns."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source")
    return judge(packed, min_group).filter("kept").select("_row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")


QUERIES = {"op6_quality_rules": op6_quality_rules}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_STEPS = ", ".join(f"('{m}', {step}::DOUBLE, '{size}')" for m, (step, size) in STEPS.items())

ORACLES = {
    "op6_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(list_slice(words, p, p + {WINDOW - 1}), ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM d)),
twice AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, sum(least({WINDOW}, coalesce(next - p, {WINDOW}))) AS n
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines
  FROM d LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT doc_id, lang, source, unnest([
    {{'measure': 'symbols_per_word', 'v': n_symbols / greatest(n_words, 1)}},
    {{'measure': 'chars_per_word', 'v': word_chars / greatest(n_words, 1)}},
    {{'measure': 'dup_lines_per_line', 'v': n_dup_lines / greatest(n_lines, 1)}},
    {{'measure': 'repeats_per_word', 'v': n_repeat_words / greatest(n_words, 1)}},
    {{'measure': 'n_words', 'v': n_words::DOUBLE}}, {{'measure': 'n_lines', 'v': n_lines::DOUBLE}}], recursive := true)
  FROM m),
b AS (
  SELECT *, CASE WHEN v > 0 THEN 2 * pow({GAMMA}, ceil(ln(v) / {math.log(GAMMA)!r})) / ({GAMMA} + 1) ELSE 0 END AS x
  FROM r),
levels AS (
  SELECT 1 AS level, lang AS l, source AS s, measure, x FROM b
  UNION ALL SELECT 2, lang, NULL, measure, x FROM b
  UNION ALL SELECT 3, NULL, NULL, measure, x FROM b),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY level, l, s, measure ORDER BY x) AS k,
         count(*) OVER (PARTITION BY level, l, s, measure) AS n FROM levels),
fences AS (
  SELECT level, l, s, measure, n,
         max(x) FILTER (k = ceil(0.75 * n)) AS high, max(x) FILTER (k = ceil(0.25 * n)) AS low,
         max(x) FILTER (k = ceil(0.5 * n)) AS middle
  FROM ranked GROUP BY ALL),
limits AS (
  SELECT f.level, f.l, f.s, f.measure, f.high + {FENCE} * greatest(f.high - f.low, step / greatest(z.middle, 1)) AS fence
  FROM fences f JOIN (VALUES {_STEPS}) t(measure, step, size) ON f.measure = t.measure
  JOIN fences z ON z.measure = t.size AND z.level = f.level AND z.l IS NOT DISTINCT FROM f.l AND z.s IS NOT DISTINCT FROM f.s
  WHERE f.level = 3 OR f.n >= {MIN_GROUP}),
outside AS (
  SELECT doc_id, bool_or(v > coalesce(f1.fence, f2.fence, f3.fence)) AS out
  FROM b
  LEFT JOIN limits f1 ON f1.level = 1 AND f1.measure = b.measure AND f1.l IS NOT DISTINCT FROM b.lang
    AND f1.s IS NOT DISTINCT FROM b.source
  LEFT JOIN limits f2 ON f2.level = 2 AND f2.measure = b.measure AND f2.l IS NOT DISTINCT FROM b.lang
  LEFT JOIN limits f3 ON f3.level = 3 AND f3.measure = b.measure
  GROUP BY doc_id),
v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m JOIN outside USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT out AS kept
FROM v
""",
}
