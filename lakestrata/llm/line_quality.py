"""Operator 9: quality rules, lines first.

Every line is judged on its own (sentence end, navigation, boilerplate, symbols), failing lines are
removed, and a document that loses too large a share of its words is rejected. Document rules on word
and repetition counts are checked as well. All of it is column expressions over one row: no shuffle, no
Python, and a document is never compared with another one, so no key can be hot.

Defined results: a null or empty text has zero counts and fails the base rules; lines without a word are
neither judged nor lost; repeated rows are judged alike; other columns pass
through, and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.tables import documents

_SPACES = " \t\n\x0b\x0c\r"
_SPACE_CLASS, _WORD_CLASS = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_SYMBOL_CLASS = r"[#*$%&|<>]"
_WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: line rules: marks that end a sentence, words of navigation lines, phrases of boilerplate lines
_SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*$"
_NAVIGATION = r"(?i)^(home|menu|about( us)?|contact( us)?|log ?in|log ?out|sign (in|up)|search|next|previous|back to top|read more|share|subscribe)$"
_BOILERPLATE = r"(?i)(enable javascript|uses cookies|cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|lorem ipsum)"
MIN_LINE_WORDS, MAX_LINE_SYMBOLS_PERCENT, MAX_LOST_PERCENT = 3, 20, 50


OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "n_bad_lines", "n_lost_words", "base_failed",
          "lines_failed", "kept")


def _length_without(text: Column, chars: str) -> Column:
    """Code points outside the class ``chars``."""
    return F.length(F.regexp_replace(text, f"{chars}+", "")).cast("long")


def words_of(text: Column) -> Column:
    """The runs of other characters between white space, in order."""
    return F.array_remove(F.split(text, rf"{_SPACE_CLASS}+"), "")


def _covered(starts: Column, width: int) -> Column:
    """Number of positions that windows of ``width`` at the ascending ``starts`` cover."""
    gaps = F.zip_with(F.slice(starts, F.lit(2), F.size(starts) - 1), F.slice(starts, F.lit(1), F.size(starts) - 1),
                      lambda b, a: F.least(b - a, F.lit(width)))
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(width), lambda s, x: s + x)).cast("long")


def base_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. A window is compared by
    the hashes of its five words; only texts in which a hash comes twice sort their windows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD_CLASS))
    df = df.withColumns({"__words": words_of(text), "__lines": lines})
    hashed = F.when(F.size("__words") >= _WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__words") - _WINDOW),
        lambda i: F.xxhash64(*(F.get("__words", i + j) for j in range(_WINDOW)))))
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"), "word_chars": _length_without(text, _SPACE_CLASS),
        "n_symbols": F.length(text) - _length_without(text, _SYMBOL_CLASS),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"), "__windows": hashed,
    })
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    df = df.withColumn("__sorted", F.when(some, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = F.filter("__sorted", lambda x, i: F.coalesce(F.get("__sorted", i - 1)["h"] == x["h"], F.lit(False))
                  | F.coalesce(F.get("__sorted", i + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn("__starts", F.array_sort(F.transform(at, lambda x: x["i"])))
    return df.withColumn("n_repeat_words", F.coalesce(_covered(F.col("__starts"), _WINDOW), F.lit(0).cast("long")))


def _line_fails(line: Column) -> Column:
    """Whether a line that has a word is to be removed."""
    bare = F.btrim(line, F.lit(_SPACES))
    words = F.size(F.split(bare, rf"{_SPACE_CLASS}+"))
    pipes = F.regexp_count(bare, F.lit("[|]"))
    symbols = F.length(bare) - _length_without(bare, _SYMBOL_CLASS)
    short = (words < MIN_LINE_WORDS) & ~bare.rlike(_SENTENCE_END)
    navigation = (pipes * 3 >= words) | bare.rlike(_NAVIGATION)
    noisy = symbols * 100 > F.length(bare) * MAX_LINE_SYMBOLS_PERCENT
    shouting = (F.length(F.regexp_replace(bare, "[^A-Z]", "")) * 2 > F.length(bare))
    return short | navigation | noisy | shouting | (bare.rlike(_BOILERPLATE) & (words <= 20))


def clean_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``clean_text`` (the lines that pass, joined again), ``n_bad_lines`` and ``n_lost_words``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    judged = F.transform(F.split(text, "\n"), lambda x: F.struct(
        x.alias("line"), F.when(x.rlike(_WORD_CLASS), _line_fails(x)).otherwise(F.lit(False)).alias("bad")))
    df = df.withColumn("__judged", judged)
    bad = F.filter("__judged", lambda x: x["bad"])
    return df.withColumn("__bad", bad).withColumns({
        "clean_text": F.array_join(F.transform(F.filter("__judged", lambda x: ~x["bad"]), lambda x: x["line"]), "\n"),
        "n_bad_lines": F.size("__bad").cast("long"),
        "n_lost_words": F.aggregate("__bad", F.lit(0).cast("long"), lambda s, x: s + F.size(words_of(x["line"]))),
    })


def quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, the cleaned text and the verdicts ``base_failed``, ``lines_failed`` and ``kept``.
    Write the result before filtering on a verdict: a filter is rewritten into all that the verdict is made of."""
    own = [c for c in docs.columns if c.lower() not in OUTPUT]
    # the helper columns live beside one struct, where no name of the input can meet theirs
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("__row"), F.col(text_col).alias("__text"))
    df = clean_lines(base_counts(df, "__text"), "__text")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lines_failed = 100 * F.col("n_lost_words") > MAX_LOST_PERCENT * F.col("n_words")
    df = df.withColumns({"base_failed": base_failed, "lines_failed": lines_failed, "kept": ~base_failed & ~lines_failed})
    return df.select(*(F.col(f"__row.`{c}`").alias(c) for c in own), *OUTPUT)


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "lines_failed", "kept", "n_bad_lines", "n_lost_words")


QUERIES = {"op9_line_quality": op9_line_quality}
ORACLES: dict[str, str] = {}
