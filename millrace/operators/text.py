"""Tokens and word counts over a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import quoted


def split_words(text: Column, trailing_empty: bool = True) -> Column:
    """Split on a single space. Two spaces in a row give an empty word between them; other
    white space, newlines included, is part of a word.

    ``trailing_empty=False`` drops empty words at the end of a text, as a split on the JVM
    does: there a text of spaces only has no word at all, while an empty text is one empty word.
    """
    if trailing_empty:
        return F.split(text, " ", -1)
    trimmed = F.rtrim(text)
    only_spaces = (trimmed == "") & (text != "")
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(trimmed, " ", -1))


def words(df: DataFrame, text: str, trailing_empty: bool = True) -> DataFrame:
    """One row per word."""
    return df.select(F.explode(split_words(quoted(text), trailing_empty)).alias("word"))


def word_count(df: DataFrame, text: str, trailing_empty: bool = True) -> DataFrame:
    """How often each word occurs, upper and lower case apart, in no particular order."""
    return words(df, text, trailing_empty).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
