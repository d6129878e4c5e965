"""Tokenisers: documents with a text column become documents with a token list."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.dictionary import code_tokens, decode_tokens
from gleanery.functions.text import (
    MIN_TOKEN_LENGTH,
    letters_only,
    pattern_tokens,
    sentences,
    surface_tokens,
    without_words,
)
from gleanery.operators.lemmas import derive_lemmas
from gleanery.session import staged

StopWords = list[str] | DataFrame


def drop_stop_words(docs: DataFrame, words: StopWords) -> DataFrame:
    """Remove a list of words, or those of a table ``words(word)``, from ``tokens``."""
    if isinstance(words, list):
        return docs.withColumn("tokens", without_words(F.col("tokens"), words))
    gone = words.select(F.col("word").alias("token"), F.lit(None).cast("string").alias("lemma"))
    return look_up(docs, gone)


def tokenize_pattern(docs: DataFrame, stop_words: StopWords, text: str = "text") -> DataFrame:
    """Words of 6-24 letters and numbers between blanks, stop words removed."""
    return drop_stop_words(
        docs.withColumn("tokens", pattern_tokens(F.col(text))).drop(text), stop_words
    )


def tokenize_lemma(
    docs: DataFrame, stop_words: StopWords, lemmas: DataFrame | None, text: str = "text"
) -> DataFrame:
    """Letters-only tokens replaced by their lemma in ``lemmas(token, lemma)``, then length and stop-word filters.

    Without a table one is derived from the documents. The text is scanned once: lemmas, filters and stop words
    work on the dictionaries of the shards of documents.
    """
    coded = code_tokens(docs.withColumn("tokens", surface_tokens(F.col(text))).drop(text))
    if lemmas is None:
        lemmas = staged(derive_lemmas(staged(coded.words.select("token").distinct())))
    words = _kept_words(_replaced(coded.words, lemmas.where(F.col("lemma").isNotNull())))
    if isinstance(stop_words, list):
        words = words.where(~F.col("token").isin(stop_words))
    else:
        words = words.join(stop_words.select(F.col("word").alias("token")), "token", "left_anti")
    return decode_tokens(coded, words)


def apply_lemmas(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each token by its lemma in ``lemmas(token, lemma)``; tokens not listed stay."""
    coded = code_tokens(docs)
    words = _replaced(coded.words, lemmas.where(F.col("lemma").isNotNull()))
    return decode_tokens(coded, _kept_words(words)).select(*docs.columns)


def look_up(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by ``lemma``, or remove them where it is null; a token of the input is looked up once."""
    coded = code_tokens(docs)
    return decode_tokens(coded, _replaced(coded.words, lemmas)).select(*docs.columns)


def _replaced(words: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(_of, _at, token) with the tokens that ``lemmas`` lists replaced, or gone where its lemma is null."""
    listed = lemmas.where(F.col("token").isNotNull()).select("token", "lemma", F.lit(True).alias("_listed"))
    token = F.when(F.col("_listed"), F.col("lemma")).otherwise(F.col("token"))
    found = words.join(listed, "token", "left").select("_of", "_at", token.alias("token"))
    return found.where(F.col("token").isNotNull())


def _kept_words(words: DataFrame) -> DataFrame:
    return words.where((F.length("token") >= MIN_TOKEN_LENGTH) & letters_only(F.col("token")))


def _keep_terms(docs: DataFrame) -> DataFrame:
    kept = F.filter("tokens", lambda t: (F.length(t) >= MIN_TOKEN_LENGTH) & letters_only(t))
    return docs.withColumn("tokens", kept)


Annotator = Callable[[str], list[str]]


def tokenize_annotator(
    docs: DataFrame, stop_words: StopWords, factory: Callable[[], Annotator], text: str = "text"
) -> DataFrame:
    """Lemmas from an outside annotator, built once per task by ``factory``."""

    @F.pandas_udf("array<string>")
    def annotate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lemmas_of = factory()
        for part in parts:
            yield part.map(lambda t: [w.lower() for w in lemmas_of(t or "")])

    marked = docs.withColumn("tokens", annotate(F.col(text))).drop(text)
    return drop_stop_words(_keep_terms(marked), stop_words)


def sentence_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(F.size(sentences(F.col(text))), F.lit(0)).alias("sentences")
    )
