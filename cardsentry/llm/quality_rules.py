"""Quality rules with adaptive thresholds (operator 1), in DataFrame functions only.

Base rules reject documents of fewer than 10 words, and those where more than
20 % of the words lie in five-word windows that occur twice or more in the text.

Of the documents that pass, four rates are summarised by KLL quantile sketches,
one per language and source.  Sketches merge into one per language and one of
the corpus.  A language's median and low decile are blended with the corpus's,
and a group's with its language's: of n documents the own quantile has the
weight n^2 / (n^2 + BLEND^2), so verdicts shift gradually with a group's size and
some tens of documents of a style are judged by it.  A rate is out of bounds if it lies further from the group's median than ``REACH`` times the
spread on the median's low side (a decile), or than a smallest spread where a
group hardly varies.  The low side is used because junk raises these rates: up to half of a
group may be junk before its bounds follow.

Defined cases: null text has no words; null language or source is a group of its
own; a document without words fails the base rules; repeated rows are judged
each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, fresh, stats_join

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# rate -> (times the spread, smallest spread, bounded below as well)
RATES = {
    "symbol_rate": (4.0, 0.05, False),
    "dup_line_rate": (4.0, 0.125, False),
    "repeat_rate": (4.0, 0.05, False),
    "word_length": (10.0, 0.25, True),
}
SKETCH_K = 4096
BLEND = 5
LENGTH_WORDS = 50
LOW, MID = 0.1, 0.5


def _measures(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of the base measures."""
    t, words, lines, h, g, e, p = (fresh(docs, n) for n in ("t", "words", "lines", "h", "g", "e", "p"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn(t, text)
    spaced = F.col(t)
    for c in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    # splitting at one plain character needs no pattern matcher
    df = df.withColumn(words, F.array_remove(F.split(spaced, " "), ""))
    df = df.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(words)
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col(h), i + k) for k in range(WINDOW)]))
    df = df.withColumn(g, F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    # windows in order of their hash: a repeated one stands next to an equal one
    pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.withColumn(e, F.when(F.size(F.array_distinct(g)) < F.size(g), pairs))
    x = lambda j: F.get(F.col(e), j)["x"]
    same = lambda j: F.coalesce((x(j) == x(j - 1)), F.lit(False)) | F.coalesce((x(j) == x(j + 1)), F.lit(False))
    places = F.transform(F.filter(F.sequence(F.lit(0), F.size(e) - 1), same), lambda j: F.get(F.col(e), j)["i"])
    df = df.withColumn(p, F.when(F.col(e).isNotNull(), F.sort_array(places)))
    step = lambda k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(p), k + 1) - F.get(F.col(p), k), F.lit(WINDOW)))
    covered = F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), F.lit(0), lambda acc, k: acc + step(k))
    measures = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.col(p).isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
    )
    return df.select(*[F.col(c) for c in docs.columns], measures.alias(out))


def _rates(m: str) -> dict[str, Column]:
    v = lambda c: F.col(f"{m}.{c}")
    share = lambda a, b: F.when(v(b) > 0, v(a) / v(b))
    return {
        "symbol_rate": share("n_symbols", "n_words"),
        "dup_line_rate": share("n_dup_lines", "n_lines"),
        "repeat_rate": share("n_repeat_words", "n_words"),
        # a mean over few words says little
        "word_length": F.when(v("n_words") >= LENGTH_WORDS, share("word_chars", "n_words")),
    }


def _base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words"))


def _bounds(measured: DataFrame, m: str, s: Scratch) -> DataFrame:
    """One row per (language, source): the bounds of every rate."""
    rates = _rates(m)
    rows = measured.where(~_base_failed(m)).select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), *[r.alias(k) for k, r in rates.items()])
    sketch = lambda c: F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(c)
    merge = lambda c, n: F.kll_merge_agg_double(c, F.lit(SKETCH_K)).alias(n)
    fine = s.stash(rows.groupBy("lang", "source").agg(*[sketch(c) for c in RATES]), "sketches")
    by_lang = fine.groupBy("lang").agg(*[merge(c, f"{c}_lang") for c in RATES])
    seen, quantile = F.kll_sketch_get_n_double, F.kll_sketch_get_quantile_double
    q = lambda of, at: F.when(seen(of) > 0, quantile(of, F.lit(at)))
    # the whole corpus: one row of numbers
    merged = fine.agg(*[merge(c, c) for c in RATES])
    every = merged.select(*[q(c, at).alias(f"{c}_{at}") for c in RATES for at in (LOW, MID)]).first()
    joined = fine.join(by_lang.withColumnRenamed("lang", "lang_"), F.col("lang").eqNullSafe(F.col("lang_")))

    def blend(sketch: Column, at: float, parent: Column) -> Column:
        """The sketch's quantile, drawn to the parent's if it has seen few values."""
        weight = seen(sketch).cast("double") * seen(sketch).cast("double")
        drawn = (weight * q(sketch, at) + F.lit(float(BLEND**2)) * parent) / (weight + F.lit(float(BLEND**2)))
        return F.when(seen(sketch) > 0, drawn).otherwise(parent)

    def bound(c: str) -> list[Column]:
        reach, floor, below = RATES[c]
        of = lambda at: blend(F.col(c), at, blend(F.col(f"{c}_lang"), at, F.lit(every[f"{c}_{at}"]).cast("double")))
        spread = F.lit(reach) * F.greatest(of(MID) - of(LOW), F.lit(floor))
        return [(of(MID) + spread).alias(f"{c}_max"), ((of(MID) - spread) if below else F.lit(None).cast("double")).alias(f"{c}_min")]

    return joined.select("lang", "source", *[b for c in RATES for b in bound(c)])


def judged(docs: DataFrame, s: Scratch, keep_text: bool) -> tuple[DataFrame, str]:
    """``docs`` (or its key columns) with a struct column of measures, base_failed and kept."""
    m, key, b = fresh(docs, "measures"), fresh(docs, "grp"), fresh(docs, "bounds")
    measured = _measures(docs, m)
    if not keep_text:
        measured = measured.drop("text")
    measured = s.stash(measured, "measures", keep=True)
    bounds = s.stash(_bounds(measured, m, s).select(F.struct("lang", "source").alias(key), F.struct(*[f"{c}_{x}" for c in RATES for x in ("max", "min")]).alias(b)), "bounds", keep=True)
    rows = measured.withColumn(key, F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")))
    rows = stats_join(rows, bounds, key, F.col("doc_id"))
    inside = F.lit(True)
    for c, rate in _rates(m).items():
        high, low = F.col(f"{b}.{c}_max"), F.col(f"{b}.{c}_min")
        inside = inside & F.coalesce((rate <= high) & (low.isNull() | (rate >= low)), F.lit(True))
    verdict = F.struct(f"{m}.*", _base_failed(m).alias("base_failed"), (~_base_failed(m) & inside).alias("kept"))
    return rows.withColumn(m, verdict).drop(key, b), m


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``."""
    with Scratch(docs.sparkSession, "quality") as s:
        rows, m = judged(docs.select("doc_id", "text", "lang", "source"), s, keep_text=False)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        return rows.select("doc_id", *[f"{m}.{c}" for c in names])


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    with Scratch(docs.sparkSession, "quality") as s:
        rows, m = judged(docs, s, keep_text=True)
        return rows.where(F.col(m)["kept"]).select(*docs.columns)
