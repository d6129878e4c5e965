"""Quality rules by distribution divergence.

A document's histograms of character classes and of its language's common words are compared with
those of the language by Jensen-Shannon distance (base 2, so from 0 to 1). The references are the
summed histograms of all documents of the language that pass the base rules. Three guards keep small
samples from being judged: minimum lengths of documents and references, and, for the common words,
the divergence that a sample of n words shows from its own source on average, (bins - 1) / (8 n ln 2),
is taken off first.

Defined results: null or empty text has zero counts and fails the base rules; a null language is a
language of its own; languages without a word list are compared by characters only; repeated rows
each give a row; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm import textstats
from gleanery.llm.scan import SPACE, Words, mix, pieces, text_column
from gleanery.llm.stage import written
from gleanery.session import fits

#: Very common words of each language (from public frequency lists).
COMMON = {
    "en": "the of and to in a is that for it was on are with as be by at this not or from an have he".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er sie".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se il elle".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
#: Words a document needs for a verdict by characters, and for one by common words.
MIN_WORDS = 50
MIN_WORDS_COMMON = 100
#: Words the reference of a language needs.
MIN_REFERENCE = 1000
MAX_CHAR_DISTANCE = 0.25
#: Largest divergence of common words above what sampling alone explains.
MAX_WORD_EXCESS = 0.045
#: Languages up to which the references are broadcast.
BROADCAST_LANGUAGES = 10_000

LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = T.StructType(
    [T.StructField(n, T.LongType()) for n in LONGS]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("chars", "commons")]
)


def _common_keys(common: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray, dict[str, int]]:
    """Sorted keys of (language, word), the column of each, and the languages' numbers."""
    codes = {lang: i + 1 for i, lang in enumerate(common)}
    keys, columns = [], []
    for lang, words in common.items():
        scanned = Words(pa.array([" ".join(words)]), SPACE)
        keys.append(scanned.hashes() ^ mix(np.uint64([codes[lang]])))
        columns.append(np.arange(len(words)))
    key = np.concatenate(keys)
    order = np.argsort(key)
    return key[order], np.concatenate(columns)[order], codes


def statistics(docs: DataFrame, common: dict[str, list[str]] = COMMON) -> DataFrame:
    """doc_id, lang, the base counts, ``chars`` (characters per class) and ``commons`` (each
    common word of the document's language, then all other words)."""
    keys, columns, codes = _common_keys(common)
    width = max(len(v) for v in common.values()) + 1

    def measure(batches):
        for piece in pieces(batches):
            w = Words(text_column(piece), SPACE)
            hashes = w.hashes()
            code = np.array([codes.get(x, 0) for x in piece.column(1).to_pylist()], np.uint64)
            own = hashes ^ mix(code)[w.doc]
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            column = np.where(keys[at] == own, columns[at], width - 1)
            commons = np.bincount(w.doc * width + column, minlength=w.n_docs * width).reshape(-1, width)
            arrays = [
                w.counts,
                textstats.word_chars(w, SPACE),
                textstats.symbol_counts(w),
                textstats.duplicate_lines(w)[0],
                textstats.repeat_words(w, hashes),
            ]
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.arange(w.n_docs + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), pa.int64())
                )
                for m in (textstats.class_counts(w), commons)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), *[pa.array(a, pa.int64()) for a in arrays], *lists],
                ["doc_id", "lang", *STATS.fieldNames()],
            )

    given = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    return given.mapInArrow(measure, T.StructType(given.schema.fields[:2] + STATS.fields))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def references(stats: DataFrame) -> DataFrame:
    """lang, ref_words, ref_chars and ref_commons: sums over the documents that pass the base rules."""
    n_chars, n_commons = len(textstats.CLASSES), max(len(v) for v in COMMON.values()) + 1
    add = lambda c, n: F.array(*[F.coalesce(F.sum(F.get(c, F.lit(i))), F.lit(0)) for i in range(n)])
    return (
        stats.where(~base_failed())
        .groupBy("lang")
        .agg(
            F.sum("n_words").alias("ref_words"),
            add("chars", n_chars).alias("ref_chars"),
            add("commons", n_commons).alias("ref_commons"),
        )
        .withColumnRenamed("lang", "ref_lang")
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as counts; 0 if one of them is empty."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    p_all, q_all = total(counts), total(reference)

    def term(a: Column, b: Column) -> Column:
        p, q = F.try_divide(a, p_all), F.try_divide(b, q_all)
        m = (p + q) / 2
        part = lambda x: F.when(x > 0, x * F.log2(F.try_divide(x, m))).otherwise(0.0)
        return (part(p) + part(q)) / 2

    divergence = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda s, x: s + x)
    return F.when((p_all > 0) & (q_all > 0), F.sqrt(F.greatest(F.lit(0.0), divergence))).otherwise(0.0)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, char_distance, word_distance and kept."""
    stats = written(statistics(docs))
    refs = references(stats)
    if fits(refs, BROADCAST_LANGUAGES):
        refs = F.broadcast(refs)
    known = F.coalesce("ref_words", F.lit(0)) >= MIN_REFERENCE
    enough = known & (F.col("n_words") >= MIN_WORDS)
    listed = known & F.col("lang").isin(*COMMON) & (F.col("n_words") >= MIN_WORDS_COMMON)
    measured = stats.join(refs, stats["lang"].eqNullSafe(refs["ref_lang"]), "left").select(
        "doc_id", *LONGS,
        base_failed().alias("base_failed"),
        F.when(enough, js_distance(F.col("chars"), F.col("ref_chars"))).alias("char_distance"),
        F.when(listed, js_distance(F.col("commons"), F.col("ref_commons"))).alias("word_distance"),
    )
    bins = max(len(v) for v in COMMON.values()) + 1
    excess = F.pow("word_distance", F.lit(2)) - F.try_divide(F.lit((bins - 1) / (8 * math.log(2))), F.col("n_words"))
    far = (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE) | (
        F.coalesce(excess, F.lit(0.0)) > MAX_WORD_EXCESS
    )
    return measured.withColumn("kept", ~F.col("base_failed") & ~far)
