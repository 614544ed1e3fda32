"""Quality rules with adaptive fences instead of fixed cutoffs.

Every text gets a few measures.  Mergeable quantile sketches of each are taken
per language and source, per language, and over all; a group's quantiles are
drawn towards its language's, and those towards all, by as much as ``PRIOR``
documents weigh, so that small groups do not decide alone.

Ratios that should be low have an upper fence.  From the median up, each higher
quantile that is at most ``REACH`` times the last one plus a small step belongs
to the body of the group; the first jump ends it.  The fence is ``REACH`` times
the body's end plus the step.  So junk that stands apart goes, be it a tenth of
the group, and a group whose documents reach further has a higher fence.

The mean length of words has a fence on either side, ``SPREAD`` times as far from
the outer quantiles as these are from the median.

The fences are joined back, and what lies beyond any of them goes, as does what
fails the base rules.

Only built-in expressions are used.  Null texts count as empty and fail.  Null
languages and sources form groups of their own.  Repeated rows count each.  Very
long texts are measured whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import FILE, ROW, address, stored, with_numbers
from tidemark.llm.tables import column, packed, small, staged

# Ratios with an upper fence, and the step that a quantile may always take.
STEPS = {"symbol_ratio": 0.01, "shout_ratio": 0.05, "dup_line_ratio": 0.1, "repeat_ratio": 0.05}
# A measure with a fence on either side.
LENGTH = "mean_length"
QUANTILES = (0.02, 0.5, 0.75, 0.9, 0.95, 0.96, 0.97, 0.98, 0.99, 0.995)
_LOW, _MEDIAN, _HIGH = 0, 1, 7
REACH = 2.0
SPREAD = 3.0
PRIOR = 10
ACCURACY = 10_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# Fences are joined by a broadcast up to this many groups, and by a shuffle of
# rows of a few numbers beyond.
BROADCAST_GROUPS = 100_000

_WORD = r"[^\x20\x09-\x0D]+"
_METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_INDEX_BASE, _INDEX_WIDTH = 1_000_000_000, 11


def _repeated_words(words: Column, n: Column) -> Column:
    """Words in three-word windows that the text holds twice or more.

    Windows are sorted together with their place, so that equal ones are
    neighbours; this takes n log n steps.
    """
    keyed = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.concat_ws(
            " ",
            F.get(words, i),
            F.get(words, i + 1),
            F.get(words, i + 2),
            (i + _INDEX_BASE).cast("string"),
        ),
    )
    return F.when(n >= 3, F.sort_array(keyed)).otherwise(F.array().cast("array<string>"))


def _covered(windows: Column) -> Column:
    window = lambda s: F.substring(s, F.lit(1), F.length(s) - _INDEX_WIDTH)
    same = F.filter(
        windows,
        lambda s, i: (window(s) == window(F.get(windows, i + 1)))
        | (window(s) == window(F.get(windows, i - 1))),
    )
    at = F.transform(same, lambda s: F.right(s, F.lit(_INDEX_WIDTH - 1)).cast("int") - _INDEX_BASE)
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))


def quality_metrics(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``lang``, ``source``, counts, ratios and ``base_failed``."""
    frame = docs.select(
        packed(docs, keep),
        column(lang).alias("lang"),
        column(source).alias("source"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    frame = frame.withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    lines = F.filter(F.split("text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    frame = frame.select(
        "doc",
        "lang",
        "source",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).alias("shouts"),
        lines.alias("lines"),
        _repeated_words(F.col("words"), F.size("words")).alias("windows"),
    )
    frame = frame.select(
        "doc",
        "lang",
        "source",
        *(F.col(c).cast("bigint").alias(c) for c in ("n_words", "word_chars", "n_symbols", "shouts")),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("windows")).cast("bigint").alias("n_repeat_words"),
    )
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    return frame.select(
        "doc",
        "lang",
        "source",
        *_METRICS,
        per("n_symbols", "word_chars").alias("symbol_ratio"),
        per("shouts", "n_words").alias("shout_ratio"),
        per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_ratio"),
        per("word_chars", "n_words").alias(LENGTH),
        (
            (F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
        ).alias("base_failed"),
    )


def _drawn(own, n, wider):
    """A group's quantiles, drawn towards those of a wider one."""
    return F.zip_with(own, wider, lambda a, b: (a * n + b * PRIOR) / (n + PRIOR))


def _upper(quantiles: Column, step: float) -> Column:
    """``REACH`` times the end of the body plus the step."""
    end = F.get(quantiles, F.lit(_MEDIAN))
    for i in range(_MEDIAN + 1, len(QUANTILES)):
        following = F.get(quantiles, F.lit(i))
        end = F.when(following <= end * REACH + step, following).otherwise(end)
    return end * REACH + step


def fences(metrics: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """The bounds of each measure, by language and source.

    One row per group.  Partial sketches are merged after the shuffle, so a hot
    source sends one sketch per task; documents that fail the base rules do not
    count.
    """
    measures = [*STEPS, LENGTH]
    # A filter instead of the condition would be pushed below the counts, and
    # work them out a second time.
    passed = lambda m: F.when(~F.col("base_failed"), F.col(m))
    lang, source = F.col("lang"), F.col("source")
    sketches = metrics.groupingSets([[lang, source], [lang], []], lang, source).agg(
        F.grouping_id().alias("level"),
        F.count_if(~F.col("base_failed")).alias("n"),
        *(F.percentile_approx(passed(m), list(QUANTILES), accuracy).alias(m) for m in measures),
    )
    sketches = staged(sketches, "quality-sketches")
    every = sketches.where("level = 3").first()
    if every is None or not every.n:
        # Nothing passes, so no fence is asked for.
        nothing = [F.lit(None).cast("double").alias(c) for c in _BOUNDS]
        own = sketches.where("level = 0")
        return own.select(lang.alias("fence_lang"), source.alias("fence_source"), *nothing)
    # One row of a few numbers.
    of_all = {m: F.array(*(F.lit(q) for q in every[m])) for m in measures}
    wide = sketches.where("level = 1 AND n > 0").select(
        lang.alias("wide_lang"), *(_drawn(F.col(m), F.col("n"), of_all[m]).alias(f"wide_{m}") for m in measures)
    )
    own = sketches.where("level = 0 AND n > 0").join(
        small(wide, BROADCAST_GROUPS), lang.eqNullSafe(F.col("wide_lang"))
    )
    own = own.select(
        "lang", "source", *(_drawn(F.col(m), F.col("n"), F.col(f"wide_{m}")).alias(m) for m in measures)
    )
    at = lambda i: F.get(F.col(LENGTH), F.lit(i))
    return own.select(
        lang.alias("fence_lang"),
        source.alias("fence_source"),
        *(_upper(F.col(m), step).alias(f"max_{m}") for m, step in STEPS.items()),
        (at(_LOW) - (at(_MEDIAN) - at(_LOW)) * SPREAD).alias(f"min_{LENGTH}"),
        (at(_HIGH) + (at(_HIGH) - at(_MEDIAN)) * SPREAD).alias(f"max_{LENGTH}"),
    )


_BOUNDS = [*(f"max_{m}" for m in STEPS), f"min_{LENGTH}", f"max_{LENGTH}"]


def judged(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """``metrics`` with ``kept``: passes the base rules and lies within all fences.

    ``limits`` is a stored table; the rows joined with it hold no texts.
    """
    joined = metrics.join(
        small(limits, BROADCAST_GROUPS),
        F.col("lang").eqNullSafe(F.col("fence_lang"))
        & F.col("source").eqNullSafe(F.col("fence_source")),
        "left",
    )
    within = ~F.col("base_failed") & (F.col(LENGTH) >= F.col(f"min_{LENGTH}"))
    for m in (*STEPS, LENGTH):
        within = within & (F.col(m) <= F.col(f"max_{m}"))
    return joined.withColumn("kept", F.coalesce(within, F.lit(False)))


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Each document's counts and verdict.

    Counts are written without texts first, so texts are read once.
    """
    metrics = staged(quality_metrics(docs, keep=[doc_id], **options), "quality")
    return judged(metrics, staged(fences(metrics), "quality-fences")).select(
        F.col("doc").getField(doc_id).alias("doc_id"), *_METRICS, "base_failed", "kept"
    )


def keep_good(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``docs`` without those that fail, columns as given.

    Texts are read twice, to be measured and to be given out, and never stored or
    shuffled; measures are worked out once.
    """
    table = stored(docs, "quality-input")
    read = table.select(
        *(column(c).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))), *address(table)
    )
    metrics = staged(quality_metrics(read, keep=[FILE, ROW]), "quality")
    kept = judged(metrics, staged(fences(metrics), "quality-fences")).where("kept")
    kept = staged(kept.select("doc.*", F.lit(1).alias("good")), "quality-kept")
    rows = with_numbers(table, kept, "good", 1, "quality").where("good > 0")
    return rows.select(*(F.col("doc").getField(c).alias(c) for c in table.columns))
