"""Quality rules: a threshold table compiled into Spark projections, without user functions.

A rule names a measure and the range in which a document passes. `measured` adds all measures as one struct column,
`judged` adds the verdict, `reasons` and the base rules. Everything happens within the row: there is no shuffle, however
the rows are dealt. Repeated passages are found by sorting the hashes of the five-word windows of a text together with
their places, in texts that hold an equal pair at all; 64-bit hashes stand for the windows.

Edge cases: a null or empty text has no words, lines or symbols and fails `n_words`; repeated rows are judged alike; other
columns are kept, also one that bears the name of a measure, since all results stand in one struct (`OUT`).
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, text_of, words_of

OUT = "_tl_rules"
WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and a to in is it that was for on are as with his they at be this from have or by had not but what all "
    "were we when your can said there an which their if will each how them then she many some so these would".split(),
    "de": "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über".split(),
    "fr": "le la les de des du un une et en que qui dans pour par sur pas plus au avec ce il sont est se ne cette ou son "
    "aux ont mais comme nous".split(),
    "es": "el la los las de del y en que un una se no con por para su al lo como más o pero sus le ha me sin sobre este "
    "ya entre cuando todo esta son".split(),
}


class Rule(NamedTuple):
    """A document passes when `low <= measure <= high`; None leaves that end open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# The base rules come first: too few words, and too large a share of words in repeated windows.
BASE = (Rule("few_words", "n_words", low=10), Rule("repeated_windows", "repeat_percent", high=20))
RULES = (
    Rule("symbols", "symbol_ratio", high=0.25),
    Rule("shouting", "bang_ratio", high=0.25),
    Rule("word_length", "mean_word_chars", low=1.5, high=25),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("one_word", "stop_ratio", high=0.9),
    Rule("no_stop_words", "stop_ratio_long", low=0.005),
)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the struct column `OUT` of all measures."""
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})
    body = text_of(text)
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    df = docs.withColumns({"_tl_words": words_of(body), "_tl_lines": lines})
    df = df.withColumns({
        "_tl_hashes": F.transform("_tl_words", lambda w: F.xxhash64(w)),
        "_tl_n": F.size("_tl_words").cast("long"),
        "_tl_lines_n": F.size("_tl_lines").cast("long"),
        "_tl_dups": (F.size("_tl_lines") - F.size(F.array_distinct("_tl_lines"))).cast("long"),
        "_tl_chars": F.char_length(F.array_join("_tl_words", "")).cast("long"),
        "_tl_stops": F.size(F.filter("_tl_words", lambda w: F.lower(w).isin(stops))).cast("long"),
        "_tl_symbols": (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long"),
        "_tl_bangs": F.size(F.filter("_tl_words", lambda w: F.endswith(w, F.lit("!!")))).cast("long"),
    }).drop("_tl_words", "_tl_lines")
    df = df.withColumn("_tl_grams", _windows("_tl_hashes", "_tl_n")).drop("_tl_hashes")
    df = df.withColumn("_tl_sorted", _sorted_windows("_tl_grams")).drop("_tl_grams")
    df = df.withColumn("_tl_places", _repeated_places("_tl_sorted")).drop("_tl_sorted")
    df = df.withColumn("_tl_repeats", _covered("_tl_places")).drop("_tl_places")
    n = F.col("_tl_n")
    ratio = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    measures = {
        "n_words": n,
        "word_chars": F.col("_tl_chars"),
        "n_symbols": F.col("_tl_symbols"),
        "n_dup_lines": F.col("_tl_dups"),
        "n_repeat_words": F.col("_tl_repeats"),
        "repeat_percent": ratio(100 * F.col("_tl_repeats"), n),
        "symbol_ratio": ratio(F.col("_tl_symbols"), n),
        "bang_ratio": ratio(F.col("_tl_bangs"), n),
        "mean_word_chars": ratio(F.col("_tl_chars"), n),
        "dup_line_ratio": ratio(F.col("_tl_dups"), F.col("_tl_lines_n")),
        "stop_ratio": ratio(F.col("_tl_stops"), n),
        # a share means little in a short text
        "stop_ratio_long": F.when(n >= 100, F.col("_tl_stops") / n).otherwise(1.0),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c != OUT]
    return df.select(*kept, F.struct(*(c.alias(k) for k, c in measures.items())).alias(OUT))


def _windows(hashes: str, n: str) -> Column:
    """A hash of every window of five words, in order."""
    word = lambda i, k: F.get(hashes, i + k)
    spots = F.sequence(F.lit(0), (F.col(n) - WINDOW).cast("int"))
    made = F.transform(spots, lambda i: F.xxhash64(*(word(i, k) for k in range(WINDOW))))
    return F.when(F.col(n) >= WINDOW, made).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows(grams: str) -> Column:
    """(window, place) in order; null when no window occurs twice."""
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), pairs)


def _repeated_places(pairs: str) -> Column:
    """Places of the windows that equal a neighbour in that order, ascending."""
    after = F.slice(pairs, 2, F.greatest(F.size(pairs), F.lit(1)))
    equal = F.zip_with(pairs, after, lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))


def _covered(places: str) -> Column:
    """Words in windows that begin at the given places."""
    after = F.slice(places, 2, F.greatest(F.size(places), F.lit(1)))
    own = F.zip_with(places, after, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.coalesce(F.aggregate(own, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long")


def _failed(rule: Rule) -> Column:
    value, bad = F.col(f"{OUT}.{rule.measure}"), F.lit(False)
    if rule.low is not None:
        bad = bad | (value < rule.low)
    if rule.high is not None:
        bad = bad | (value > rule.high)
    return bad


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`measured`, with `base_failed`, `kept` and `reasons` (names of the rules that fail, in order) in the struct."""
    df = measured(docs, text)
    base = F.lit(False)
    for rule in BASE:
        base = base | _failed(rule)
    named = F.array(*(F.when(_failed(r), F.lit(r.name)) for r in (*BASE, *rules)))
    reasons = F.array_compact(named)
    verdict = F.lit(True)
    for rule in (*BASE, *rules):
        verdict = verdict & ~_failed(rule)
    return df.withColumn(OUT, F.col(OUT).withField("base_failed", base).withField("kept", verdict).withField("reasons", reasons))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass all rules, with the columns they came with."""
    # a column that is not deterministic keeps the optimizer from writing the verdict out below, once per use of a measure
    found = judged(docs, rules, text).withColumn("_tl_row", F.monotonically_increasing_id())
    return found.filter(F.col(f"{OUT}.kept") & (F.col("_tl_row") >= 0)).select(*(F.col(f"`{c}`") for c in docs.columns))
