"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Fixed cutoffs are replaced by fences that each (language, source) group sets itself:

1. every text is measured once, on the executors' JVM side (words, symbols, repeated
   lines, repeated 8-word windows, capitals), and the narrow measures are staged;
2. each measure is an integer ratio. Its distribution is kept as a sketch: row counts per
   log-linear bucket (exact up to 127, then buckets of at most 1/64 of their value), so
   sketches merge by adding counts. A group's sketch has a few hundred buckets at most,
   whatever its number of rows; groups are combined map-side, so a hot source costs one
   partial row per task and bucket;
3. a group with too few rows takes the merged sketch of its language, and if that is too
   small as well, the one of all rows;
4. fence = quartile + reach * interquartile range + slack. The fences (a row per group)
   are joined to the measures, and a row outside any fence is rejected.

Null text: no words. Null language or source: a group of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SYMBOLS, WORD, stage, stage_in_few

# The base rules of the query contract.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30

_BUCKET_BITS = 7
MAX_BROADCAST_GROUPS = 200_000  # about 100 bytes each


@dataclass(frozen=True)
class Measure:
    """An integer ratio ``scale * part / whole`` and how far from the quartiles it may lie."""

    name: str
    part: str
    whole: str
    scale: int
    slack: int
    low_side: bool = False


MEASURES = (
    Measure("symbols", "n_symbols", "n_words", 1000, 200),
    Measure("capitals", "n_capitals", "word_chars", 1000, 250),
    Measure("repeats", "n_repeat_words", "n_words", 1000, 150),
    Measure("same_lines", "n_dup_lines", "n_lines", 1000, 300),
    Measure("word_length", "word_chars", "n_words", 100, 250, low_side=True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Fences:
    reach: int = 3
    min_rows: int = 200
    low_quartile: tuple[int, int] = (1, 4)
    high_quartile: tuple[int, int] = (3, 4)


def measured(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` plus the counts of every whole text, as a struct column ``counts``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(F.struct(*keep).alias("row"), body.alias("body"))
    df = df.withColumn("words", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)))
    df = df.withColumn("lines", F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD)))
    df = df.select(
        "row", "words", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    df = df.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    # Most texts repeat no window: those stop here, without sorting.
    df = df.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("starts", F.when(F.col("sorted").isNotNull(), F.array_sort(F.transform(
        F.filter(F.transform("sorted", lambda x, k: F.struct(
            x["i"].alias("i"),
            (F.coalesce(F.get("sorted", k - 1)["h"] == x["h"], F.lit(False))
             | F.coalesce(F.get("sorted", k + 1)["h"] == x["h"], F.lit(False))).alias("twin"))),
            lambda y: y["twin"]),
        lambda y: y["i"]))))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda s, p: F.struct((p + WINDOW).alias("end"),
                              (s["sum"] + p + WINDOW - F.greatest(p, s["end"])).alias("sum")),
        lambda s: s["sum"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.select("row.*", F.struct(*COUNTS).alias("counts"))


def base_failed(c: str = "counts") -> Column:
    return ((F.col(f"{c}.n_words") < MIN_WORDS)
            | (F.col(f"{c}.n_repeat_words") * 100 > F.col(f"{c}.n_words") * MAX_REPEAT_PERCENT))


def ratio(m: Measure) -> Column:
    part, whole = F.col(f"counts.{m.part}"), F.col(f"counts.{m.whole}")
    return F.when(whole > 0, F.call_function("div", part * m.scale, whole)).otherwise(F.lit(0)).cast("long")


def bucket_top(value: Column) -> Column:
    """Largest value in the bucket of ``value``: the sketch keeps this as the bucket's key."""
    shift = F.greatest(F.char_length(F.bin(value)) - _BUCKET_BITS, F.lit(0))
    unit = F.pow(F.lit(2.0), shift).cast("long")
    return F.call_function("div", value, unit) * unit + unit - 1


def sketches(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Row count per group, measure and bucket: the mergeable sketch of each measure."""
    long = rows.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(m.name).alias("measure"), bucket_top(ratio(m)).alias("top"))
        for m in MEASURES])).alias("m")).select(*groups, "m.measure", "m.top")
    return long.groupBy(*groups, "measure", "top").agg(F.count("*").alias("n"))


def _merge(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "top").agg(F.sum("n").alias("n"))


def _quartiles(sketch: DataFrame, groups: list[str], f: Fences) -> DataFrame:
    """Row count and both quartiles of each group and measure."""
    whole = Window.partitionBy(*groups, "measure")
    run = whole.orderBy("top").rowsBetween(Window.unboundedPreceding, 0)
    s = sketch.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(run))

    def at(q: tuple[int, int]) -> Column:
        return F.min(F.when(F.col("upto") * q[1] >= F.col("total") * q[0], F.col("top")))

    return s.groupBy(*groups, "measure").agg(
        F.max("total").alias("rows"), at(f.low_quartile).alias("q1"), at(f.high_quartile).alias("q3"))


def fences(rows: DataFrame, f: Fences, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per (lang, source): struct ``limit`` with the fences of every measure."""
    own = stage(sketches(rows, [lang, source]))
    by_lang = _merge(own, [lang])
    everything = _merge(own, [])
    q = _quartiles(own, [lang, source], f).alias("a")
    l = _quartiles(by_lang, [lang], f).alias("b")
    # At most one row per measure: bounded by the number of measures.
    g = F.broadcast(_quartiles(everything, [], f)).alias("c")
    q = (q.join(l, F.col(f"a.{lang}").eqNullSafe(F.col(f"b.{lang}"))
                & (F.col("a.measure") == F.col("b.measure")))
         .join(g, F.col("a.measure") == F.col("c.measure")))

    def pick(c: str) -> Column:
        return (F.when(F.col("a.rows") >= f.min_rows, F.col(f"a.{c}"))
                .when(F.col("b.rows") >= f.min_rows, F.col(f"b.{c}")).otherwise(F.col(f"c.{c}")))

    q = q.select(F.col(f"a.{lang}").alias("f_lang"), F.col(f"a.{source}").alias("f_source"),
                 F.col("a.measure").alias("measure"), pick("q1").alias("q1"), pick("q3").alias("q3"))
    limits = []
    for m in MEASURES:
        mine = F.col("measure") == m.name
        width = F.lit(f.reach) * (F.col("q3") - F.col("q1")) + m.slack
        limits.append(F.max(F.when(mine, F.col("q3") + width)).alias(f"{m.name}_high"))
        if m.low_side:
            limits.append(F.max(F.when(mine, F.col("q1") - width)).alias(f"{m.name}_low"))
    q = q.groupBy("f_lang", "f_source").agg(*limits)
    names = [c for c in q.columns if c not in ("f_lang", "f_source")]
    return q.select("f_lang", "f_source", F.struct(*names).alias("limit"))


def inside(limit: str = "limit") -> Column:
    """True if every measure lies within its fences."""
    ok = F.lit(True)
    for m in MEASURES:
        ok = ok & (ratio(m) <= F.col(f"{limit}.{m.name}_high"))
        if m.low_side:
            ok = ok & (ratio(m) >= F.col(f"{limit}.{m.name}_low"))
    return ok


def limits_of(rows: DataFrame, f: Fences, lang: str = "lang", source: str = "source") -> DataFrame:
    """The fences, staged; marked for broadcast only when they were counted to be few."""
    limits = stage(fences(rows, f, lang, source))
    return F.broadcast(limits) if limits.count() <= MAX_BROADCAST_GROUPS else limits


def judged(rows: DataFrame, limits: DataFrame, lang: str, source: str) -> DataFrame:
    """``rows`` (with ``counts``) plus ``kept``, joined with the fences of their group.

    ``kept`` is one CASE over both sides of the join on purpose. As a conjunction, its part
    over the counts could be pushed down into the measuring of the texts, whose steps would
    then be nested into one expression and repeated for every word.
    """
    out = rows.join(limits, F.col(lang).eqNullSafe(F.col("f_lang"))
                    & F.col(source).eqNullSafe(F.col("f_source")), "left")
    known = F.col("limit").isNull() | inside()
    return out.withColumn("kept", F.when(known, ~base_failed()).otherwise(F.lit(False)))


def _group_keys() -> list[Column]:
    return [F.col("lang").alias("g_lang"), F.col("source").alias("g_source")]


def quality_rows(docs: DataFrame, f: Fences = Fences()) -> DataFrame:
    """One row per row of ``docs`` with its counts, ``base_failed`` and ``kept``.

    Repeated rows are judged alike; an empty table gives an empty result; other columns
    of ``docs`` are ignored.
    """
    rows = stage(measured(docs, [F.col("doc_id"), *_group_keys()]))
    return judged(rows, limits_of(rows, f, "g_lang", "g_source"), "g_lang", "g_source").select(
        "doc_id", "counts.n_words", "counts.word_chars", "counts.n_symbols", "counts.n_dup_lines",
        "counts.n_repeat_words", base_failed().alias("base_failed"), "kept")


def quality_filter(docs: DataFrame, f: Fences = Fences()) -> DataFrame:
    """The rows of ``docs`` that pass, with exactly its columns.

    The fences need the measures of all rows before the first row can be judged, so the
    texts are measured a second time for the filter: two scans, and no text is shuffled
    or copied.
    """
    limits = limits_of(stage_in_few(measured(docs, _group_keys())), f, "g_lang", "g_source")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    again = measured(docs, [*_group_keys(), whole])
    return judged(again, limits, "g_lang", "g_source").filter("kept").select("doc.*")
