"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule: knots (t, weight) with t from 0 to 1, linear in between. The
integral of a schedule is the source's share of all words. A share that would take a source more
than ``repeats`` times is cut there and the excess goes to the others by weight. The words a source
has to deliver up to time t are ``target * W(t) / W(1)`` with W the integral of its schedule; the
inverse of that demand turns the running word count of the source (documents in hash order, epoch
after epoch) into training positions. Documents are then sorted by position, by range.

No task sees a whole source: running counts come from range partitions of (source, hash).
Windows without partitions run over one row per source or partition.

Defined results: null or empty text has size 0 and takes 0 words; a null source is a source, last in
order; equal rows are taken one after the other; with no words at all every target is 0; an empty table gives no rows;
a source without a schedule or with integral 0 gets no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.names import column, free_names
from gleanery.llm.prefix import ranked, row_key, unique_rows
from gleanery.session import fits

REPEATS = 3
GAP = r"[\x20\x09-\x0D]+"
#: Sources up to which the source table is broadcast; beyond, the joins shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words between white space; splitting at the gaps costs half of extracting the words."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")).cast("long")


def sizes(docs: DataFrame, *extra: Column) -> DataFrame:
    """doc_id, source and words of each document."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *extra)


def segments(schedule: DataFrame) -> DataFrame:
    """source, integral and the linear pieces (t0, length, w0, w1, integral before) of (source, t, weight)."""
    knots = schedule.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct(F.col("t").cast("double").alias("t"), F.col("weight").cast("double").alias("w")))).alias("k")
    )
    piece = F.transform(
        F.sequence(F.lit(1), F.size("k") - 1),
        lambda i: F.struct(
            F.element_at("k", i)["t"].alias("t0"),
            (F.element_at("k", i + 1)["t"] - F.element_at("k", i)["t"]).alias("length"),
            F.element_at("k", i)["w"].alias("w0"),
            F.element_at("k", i + 1)["w"].alias("w1"),
        ),
    )
    area = lambda p: p["length"] * (p["w0"] + p["w1"]) / 2
    with_area = F.transform(
        "p",
        lambda p, i: F.struct(
            p["t0"].alias("t0"), p["length"].alias("length"), p["w0"].alias("w0"), p["w1"].alias("w1"),
            F.aggregate(F.slice("p", 1, i), F.lit(0.0), lambda s, q: s + area(q)).alias("done"),
        ),
    )
    return (
        knots.where(F.size("k") > 1)
        .select("source", piece.alias("p"))
        .select("source", with_area.alias("pieces"), F.aggregate("p", F.lit(0.0), lambda s, q: s + area(q)).alias("weight"))
    )


def targets(totals: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight, ...): shares of all words by weight, none
    above ``repeats`` times its source.

    With the sources in order of cap / weight, those whose cap binds come first. The level (words per
    unit of weight) after fixing the caps of the first i sources rises while caps bind and falls
    afterwards, so its maximum is the level that holds.
    """
    weight, cap = F.coalesce("weight", F.lit(0.0)), F.col("source_size") * F.lit(repeats)
    ratio = F.when(weight > 0, cap / weight)
    # One row per source.
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("_ratio").asc_nulls_last(), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    active = totals.withColumns({"_w": weight, "_ratio": ratio, "_cap": F.when(weight > 0, cap).otherwise(0)})
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    left_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    level = active.withColumn("_level", F.when(F.col("_w") > 0, F.try_divide(left_words, left_weight)))
    best = F.coalesce(F.max("_level").over(everything), F.lit(0.0))
    return level.withColumn("target", F.least(best * F.col("_w"), F.col("_cap").cast("double"))).drop(
        "_w", "_ratio", "_cap", "_level"
    )


def position(words: Column, target: Column, weight: Column, pieces: Column) -> Column:
    """Time at which the demand reaches ``words``: the inverse of the integrated schedule."""
    y = F.least(F.try_divide(words, target), F.lit(1.0)) * weight
    piece = F.try_element_at(F.filter(pieces, lambda p: (p["done"] <= y) & (p["length"] > 0)), F.lit(-1))
    slope = F.try_divide(piece["w1"] - piece["w0"], piece["length"])
    rest = y - piece["done"]
    root = F.sqrt(F.greatest(F.lit(0.0), piece["w0"] * piece["w0"] + 2 * slope * rest))
    inside = F.coalesce(F.try_divide(2 * rest, piece["w0"] + root), F.lit(0.0))
    return F.when(target > 0, piece["t0"] + F.least(inside, piece["length"]))


def plan(docs: DataFrame, schedule: DataFrame, repeats: int = REPEATS, extra: tuple[Column, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, ``extra`` and
    ``copies``, an array of (position, words) with one entry for each time the mix takes it.

    The last document a source delivers may be taken in part, so a source's words reach its target
    but for the fraction of a word.
    """
    rows = sizes(docs, *extra)
    names = rows.columns[3:]
    rows = rows.withColumn("_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    order = [F.col("source").asc_nulls_last(), F.col("_order"), F.col("doc_id"), *names]
    return _planned(ranked(rows, order, "size"), schedule, repeats, names)


def _planned(placed: DataFrame, schedule: DataFrame, repeats: int, extra: list[str]) -> DataFrame:
    totals = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before").alias("_offset"))
    totals = totals.withColumnRenamed("source", "_source")
    wanted = segments(schedule)
    joined = totals.join(wanted, totals["_source"].eqNullSafe(wanted["source"]), "left").drop("source")
    aimed = targets(joined.withColumnRenamed("_source", "source"), repeats).withColumnRenamed("source", "_source")
    if fits(totals, BROADCAST_SOURCES):
        aimed = F.broadcast(aimed)
    each = placed.join(aimed, placed["source"].eqNullSafe(aimed["_source"]))
    start = F.col("before") - F.col("_offset")

    def copy(epoch: Column) -> Column:
        at = start + epoch * F.col("source_size")
        words = F.floor(F.least(F.col("size").cast("double"), F.greatest(F.lit(0.0), F.col("target") - at)))
        return F.struct(
            position(at.cast("double"), F.col("target"), F.col("weight"), F.col("pieces")).alias("position"),
            words.cast("long").alias("words"),
        )

    copies = F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), copy)
    return each.select(
        "doc_id", "source", "size", "source_size", "target", *extra,
        F.filter(copies, lambda c: c["words"] > 0).alias("copies"),
    ).withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c["words"]))


def training_order(planned: DataFrame) -> DataFrame:
    """The documents in the order in which training first meets them, dealt by range of position;
    documents that are not taken come last."""
    first = planned.withColumn("position", F.get(F.col("copies")["position"], F.lit(0)))
    return first.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )


def mix(docs: DataFrame, schedule: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """The mixed training set: a row of ``docs`` for each time it is taken, in training order.

    Documents stay whole: the one that a source's target cuts is there if over half of it is taken. Other
    columns of ``docs`` stay as they are, whatever their names.
    """
    key, position = free_names(docs, "mix_key", "mix_position")
    taken = plan(docs, schedule, repeats, (row_key(docs, key),)).select(
        key, F.explode(F.filter("copies", lambda c: 2 * c["words"] > F.col("size"))["position"]).alias(position)
    )
    mixed = unique_rows(docs, key).join(taken, key)
    ordered = mixed.repartitionByRange(position, key).sortWithinPartitions(position, key)
    return ordered.select(*[column(c) for c in docs.columns])


def cycle_schedule(docs: DataFrame, weights: tuple = (5.0, 2.0, 1.0), drift: tuple = (0.2, 0.0, -0.2)) -> DataFrame:
    """A curriculum for the sources in order of code point (null last): weights repeat along
    ``weights``, and each rises or falls by its ``drift`` over the run with its mean kept."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod("_n", F.lit(len(values))) + 1).cast("int"))
    sources = docs.select("source").distinct().withColumn("_n", place)
    ends = F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("t")
    return sources.select("source", ends, pick(weights).alias("_w"), pick(drift).alias("_d")).select(
        "source", "t", (F.col("_w") * (1 + F.col("_d") * (2 * F.col("t") - 1))).alias("weight")
    )
