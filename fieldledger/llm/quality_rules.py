"""Quality rules: clean each text line by line, then reject texts that fail or lose too much."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.llm.store import packed, unpacked
from fieldledger.operators.columns import quoted

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class LineRules:
    """What makes a line fail, and how much of a text may fail.

    ``symbol_share``: per cent of symbols among the characters of a line's words. ``separators``: marks
    between menu entries (``|``, ``>``, ``*``) at which a line is navigation, if they stand after every third word or
    more often. ``shout_marks``: exclamation marks per cent of words. ``boilerplate``: phrases of page furniture.
    ``max_lost``: per cent of a text's word characters that may be in failed lines.
    """

    symbol_share: int = 10
    separators: int = 4
    shout_marks: int = 30
    min_words: int = 3
    max_lost: int = 50
    boilerplate: tuple[str, ...] = (
        "javascript is disabled",
        "enable javascript",
        "accept all cookies",
        "we use cookies",
        "click here to",
        "terms of service",
        "skip to main content",
        "add to cart",
        "sign in to continue",
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, SPACES, ""))


def count_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, SYMBOLS, ""))


def window_codes(words: Column, size: int = WINDOW) -> Column:
    """A 64-bit code for each run of ``size`` words: of their own codes, each taken once per word."""
    codes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return let(
        F.struct(codes.alias("c"), starts.alias("s")),
        lambda x: F.transform(x["s"], lambda i: F.xxhash64(*[F.get(x["c"], i + k) for k in range(size)])),
    )


def covered(codes: Column, size: int = WINDOW) -> Column:
    """Number of words in windows whose code occurs more than once, in n log n steps.

    Windows are sorted by code, those equal to a neighbour keep their position, and positions are sorted again:
    each then adds the words up to the next one, at most ``size``.
    """
    placed = F.array_sort(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i"))))
    repeated = let(
        placed,
        lambda p: F.transform(
            F.filter(
                F.transform(
                    p,
                    lambda x, j: F.struct(
                        x["i"].alias("i"),
                        (
                            F.coalesce(F.get(p, j - 1)["c"] == x["c"], F.lit(False))
                            | F.coalesce(F.get(p, j + 1)["c"] == x["c"], F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda y: y["twice"],
            ),
            lambda y: y["i"],
        ),
    )
    return let(
        F.array_sort(repeated),
        lambda r: F.aggregate(
            F.transform(r, lambda at, j: F.least(F.lit(size), F.coalesce(F.get(r, j + 1) - at, F.lit(size)))),
            F.lit(0),
            lambda total, n: total + n,
        ),
    )


def line_fails(line: Column, rules: LineRules) -> Column:
    """True if a line with words fails one of the rules."""
    n_words = F.size(words_of(line))
    marks = F.char_length(F.regexp_replace(line, "[^|>*·•»]+", ""))
    shouts = F.char_length(F.regexp_replace(line, "[^!]+", ""))
    furniture = "(?i)" + "|".join(rules.boilerplate)
    return F.coalesce(
        (100 * count_symbols(line) > rules.symbol_share * word_chars(line))  # punctuation
        | ((n_words >= rules.min_words) & (100 * shouts > rules.shout_marks * n_words))
        | ((marks >= rules.separators) & (3 * marks >= n_words))  # navigation
        | ~F.regexp_like(line, F.lit("[\\p{L}\\p{N}]"))
        | F.regexp_like(line, F.lit(furniture)),
        F.lit(False),
    )


def apply_rules(docs: DataFrame, rules: LineRules | None = None, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with counts, the cleaned text and the verdict added.

    Added are ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``lost_chars`` (word characters in lines that fail), ``cleaned_text`` (the other lines) and ``kept``: false
    if the base rules fail or more than ``rules.max_lost`` per cent of the word characters are lost.

    Each text is judged by itself in one projection: there is no shuffle, so nothing to skew, and no step takes
    more than n log n of a text's length. Sorting for repeated windows is done only where some code occurs twice.

    A null or empty text has no words and fails the base rules; ``cleaned_text`` is then empty. Rows that repeat
    get the same verdict. An empty table gives no rows. Other columns pass through, whatever their names; columns named like
    one of those added are replaced.
    """
    rules = rules or LineRules()
    whole = F.coalesce(quoted(text), F.lit(""))
    measured = packed(
        docs,
        word_chars=word_chars(whole).cast("long"),
        n_symbols=count_symbols(whole).cast("long"),
        words=let(words_of(whole), lambda w: F.struct(F.size(w).alias("n"), window_codes(w).alias("codes"))),
        lines=F.filter(F.split(whole, "\n", -1), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]"))),
    )
    counted = measured.select(
        "row",
        F.col("words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("words.codes")) == F.size("words.codes"), F.lit(0))
        .otherwise(covered(F.col("words.codes")))
        .cast("long")
        .alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(line_fails(x, rules).alias("fails"), x.alias("line"))).alias("judged"),
    )
    good = F.filter("judged", lambda x: ~x["fails"])
    lost = F.aggregate(
        F.filter("judged", lambda x: x["fails"]),
        F.lit(0).cast("long"),
        lambda total, x: total + word_chars(x["line"]),
    )
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    verdict = counted.select(
        "row",
        *COUNTS,
        base_failed.alias("base_failed"),
        lost.alias("lost_chars"),
        F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("cleaned_text"),
    )
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.max_lost * F.col("word_chars"))
    added = {name: F.col(name) for name in (*COUNTS, "base_failed", "lost_chars", "cleaned_text")}
    return verdict.select(*unpacked(docs.columns, {**added, "kept": kept}))
