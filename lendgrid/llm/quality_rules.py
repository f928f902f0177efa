"""Quality rules: a table of thresholds compiled into one Spark projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.llm.frames import GAPS, fresh, words_of

#: Frequent function words of the four languages, in natural order (fixed values).
STOP_WORDS = (
    "the be to of and that have with is in it for on this "
    "le la les de des du un une et est en que qui dans pour "
    "der die das und ist nicht ein eine mit zu von sich den "
    "el los las del una y es con por para se no"
).split()

#: (measure, smallest, largest); None leaves a side open. Every bound includes its own value.
DEFAULT_RULES = (
    ("n_words", 50, None),
    ("repeat_word_ratio", None, 0.5),
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_word_ratio", None, 0.3),
    ("stop_word_ratio", 0.01, None),
    ("dup_line_ratio", None, 0.5),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def _window_hashes(words: Column) -> Column:
    """64-bit hash of each 3-word window."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _sorted_windows(hashes: Column) -> Column:
    """Hash and position of each window, equal windows next to each other; null if all differ."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def _repeated_places(windows: Column) -> Column:
    """Sorted positions of the windows that equal a neighbour."""
    hashes = windows["h"]
    n = F.size(windows)
    same = F.zip_with(F.slice(hashes, 1, n - 1), F.slice(hashes, 2, n), lambda a, b: a == b)
    either = F.zip_with(F.concat(same, F.array(F.lit(False))), F.concat(F.array(F.lit(False)), same), lambda a, b: a | b)
    marked = F.zip_with(windows["i"], either, lambda i, repeated: F.when(repeated, i))
    return F.when(windows.isNotNull(), F.sort_array(F.array_compact(marked)))


def _covered_words(places: Column) -> Column:
    """Size of the union of the 3-word windows at these positions."""
    following = F.concat(F.slice(places, 2, F.size(places)), F.array(F.lit(2147483000)))
    gaps = F.zip_with(places, following, lambda a, b: F.least(F.lit(3), b - a))
    return F.when(F.size(places) > 0, F.aggregate(gaps, F.lit(0), lambda s, x: s + x)).otherwise(F.lit(0))


def rule_column(rules, measure: dict[str, Column]) -> Column:
    """The whole table as one boolean expression: true if every measure is within its bounds."""
    checks = []
    for name, least, most in rules:
        if least is not None:
            checks.append(measure[name] >= F.lit(least))
        if most is not None:
            checks.append(measure[name] <= F.lit(most))
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def measure_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``MEASURES`` (long). A missing or empty text has 0 everywhere.

    Columns of ``docs`` with one of these names are replaced. Each text is measured whole, in its own row. Repeated 3-word
    windows are found by sorting 64-bit hashes of their words, so a text costs n log n; no step compares all its windows.
    """
    body, words, lines, hashes, windows, places = fresh(docs, "body", "words", "lines", "hashes", "windows", "places")
    whole = docs.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    kept = [c for c in docs.columns if c.lower() not in MEASURES]
    split = whole.select(*[F.col(f"`{c}`") for c in kept], body, words_of(F.col(body)).alias(words),
                         F.filter(F.split(F.col(body), "\n", -1), lambda x: F.trim(x, F.lit(GAPS)) != "").alias(lines))
    split = split.withColumn(hashes, _window_hashes(F.col(words))).withColumn(windows, _sorted_windows(F.col(hashes))).withColumn(places, _repeated_places(F.col(windows)))
    w, b = F.col(words), F.col(body)
    measures = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(b) - F.length(F.regexp_replace(b, r"[#*$%&|<>]", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
        "n_repeat_words": _covered_words(F.col(places)),
    }
    return split.select(*[F.col(f"`{c}`") for c in kept], *[c.cast("long").alias(k) for k, c in measures.items()])


def apply_quality_rules(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half the words inside repeated 3-word windows. ``kept`` is false then, and
    else the verdict of ``rules`` (a ratio over no words or lines counts as 0). Every row stays; filter on ``kept``.
    """
    measured = measure_quality(docs, text)
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    measure = {k: F.col(k) for k in MEASURES} | {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_word_ratio": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "repeat_word_ratio": per("n_repeat_words", "n_words"),
    }
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = [c for c in measured.columns if c not in ("base_failed", "kept")]
    return measured.select(*[F.col(f"`{c}`") for c in kept], failed.alias("base_failed"), (~failed & rule_column(rules, measure)).alias("kept"))
