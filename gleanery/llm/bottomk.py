"""Near-dedup by bottom-k sketches from one hash function.

A document's set are its word shingles. Documents are linked if their Jaccard similarity is at least
``similarity``; the groups are the connected components. The steps:

1. One hash gives every shingle a value. A document keeps the ``k`` smallest (its sketch), the size of its set
   and a 128-bit digest of it. Equal sets become one class, so copies cost one row each from here on. Classes are
   numbered (``doc``) in the order of their smallest doc_id, which need not be theirs alone.
2. Inverted lists: a list holds the classes that retain the same ``RUN`` neighbouring values. Of the
   k smallest values of a union each is in both sets with probability J; a run of 3 shared ones is
   missing among 48 with a probability of about 1e-7 at J = 0.8. Sets up to k are listed whole, where a run is certain
   (of 2 for sets of up to 5, which are listed by 2, too). Single values would give lists as long as common
   shingles are frequent.
3. Each list compares its members with its first class, its centre (a star, not all pairs). Pairs are
   checked by the similarity estimated from the sketch of their union, which only rejects
   what is many standard deviations below, and then exactly on the full sets.
4. Lists whose members are in one component then are done. In the others, members of different components
   are compared among each other by two exact prefix filters, with shingles ordered by frequency, rarest first:

   * far from the centre (``prefix_pairs``): two similar sets share one of the first n - ceil(s n) + 1 shingles.
   * near the centre (``delta_pairs``), where all members share nearly all shingles: sets are written as differences from the
     centre c, D = c minus x (a of them) and x minus c (b). With f = (a + s b) / (1 + s) and t = |c| (1 - s) / (1 + s), x is
     linked with c if f(x) <= t, and x with y if D(x) and D(y) have f(x) + f(y) - t in common or more. If y is not linked with c, that is more
     than f(x), so one of the first |D(x)| - floor(f(x)) differences, mostly x's own words, is in D(y).

   By the triangle inequality of the Jaccard distance, a linked pair of which one is within 2 (1 - s) of the centre has the
   other one within 3 (1 - s), so each linked pair is in one of the two.

No list, however long, is cut, and no group emits all its pairs.

Defined results: null or empty text has the empty set and is linked with nothing; a text of fewer words
than a shingle is one shingle as a whole; a row without doc_id is linked with nothing, its component_id is null
and it is kept; rows that share a doc_id are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.components import components
from gleanery.llm.names import column, free_names
from gleanery.llm.scan import SPACE, Words, mix, pieces, text_column
from gleanery.llm.stage import written
from gleanery.session import fits

WORDS, SIMILARITY = 2, 0.8
SKETCH = 48
RUN = 3
#: Sets this small are listed by runs of 2 as well: of 5 values in a union the middle one may differ.
SMALL = 5
MARGIN = 6.0
#: Estimated share from which a pair with a centre is measured; below, the member counts as far from it. Members
#: that must count as near have twice the similarity at least (see above), over four standard deviations more.
STAR_SHARE = 0.1
#: Document ids up to which the sets to be compared are picked by a broadcast.
BROADCAST_IDS = 1_000_000

_U = np.uint64


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each document, one after the other, and their bounds."""
    w = Words(column, SPACE, lower=True)
    hashes = w.hashes()
    starts = w.whole(words)
    values, docs = [w.windows(hashes, words)[starts]], [w.doc[starts]]
    for short in range(1, words):
        # The whole sequence of a text that is too short for a shingle.
        rows = np.flatnonzero(w.counts == short)
        values.append(mix(w.windows(hashes, short)[w.first[rows]] ^ _U(short)))
        docs.append(rows)
    value, doc = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(w.n_docs + 1))


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((bounds * 8).astype(np.int32).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def digests(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A 128-bit digest of each set."""
    sums = [np.concatenate([_U([0]), np.cumsum(mix(values ^ _U(salt)), dtype=_U)]) for salt in (1, 2)]
    digest = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
    return _binary(digest.ravel(), np.arange(len(bounds)) * 2)


def sketches(docs: DataFrame, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """doc_id, n (size of the set), digest of the set, sketch (the k smallest values), and a hash of the text."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))

    def sketch(batches):
        for piece in pieces(batches):
            values, bounds = shingle_sets(text_column(piece), words)
            n = np.diff(bounds)
            rank = np.arange(len(values)) - np.repeat(bounds[:-1], n)
            few = np.concatenate([[0], np.cumsum(np.minimum(n, k))])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(n, pa.int64()), digests(values, bounds), _binary(values[rank < k], few), piece.column(2)],
                ["doc_id", "n", "digest", "sketch", "text_hash"],
            )

    return given.mapInArrow(sketch, "doc_id long, n long, digest binary, sketch binary, text_hash long")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """key, doc, n: the lists (by key) of the retained runs of values of each class."""

    def keys(batches):
        for batch in batches:
            ids, sizes, sketch = (batch.column(i) for i in range(3))
            values = np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in sketch]) if len(ids) else np.zeros(0, _U)
            count = np.fromiter((len(x.as_buffer()) // 8 for x in sketch), np.int64, len(ids))
            row = np.repeat(np.arange(len(ids)), count)
            n = sizes.to_numpy()
            out_key, out_row = [], []
            for run, chosen in ((RUN, n >= RUN), (2, (n >= 4) & (n <= SMALL))):
                m = len(values) - run + 1
                if m <= 0:
                    continue
                key = np.full(m, run, _U)
                for i in range(run):
                    key = mix(key ^ values[i : i + m])
                whole = (row[:m] == row[run - 1 :]) & chosen[row[:m]]
                out_key.append(key[whole])
                out_row.append(row[:m][whole])
            key = np.concatenate(out_key) if out_key else np.zeros(0, _U)
            at = np.concatenate(out_row) if out_row else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), ids.take(pa.array(at)), sizes.take(pa.array(at))], ["key", "doc", "n"]
            )

    return classes.select("doc", "n", "sketch").mapInArrow(keys, "key long, doc long, n long")


def _alike_sizes(similarity: float):
    return F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(similarity - 1e-9)


def estimated(pairs: DataFrame, classes: DataFrame, low: float, exact: float, k: int = SKETCH) -> DataFrame:
    """The pairs (a, b) whose share in the sketch of their union is ``low`` or more; ``exact`` where
    the union has fewer than k values and the sketch is all of it."""

    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(s.as_buffer(), _U) for s in (x, y))
                union = np.union1d(a, b)[:k]
                both = np.intersect1d(a, b, assume_unique=True)
                shared = int(np.searchsorted(both, union[-1], "right"))
                good.append(shared >= (low if len(union) == k else exact - 1e-9) * len(union))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    own = classes.select("doc", "sketch")
    sides = pairs.join(own.toDF("a", "sa"), "a").join(own.toDF("b", "sb"), "b")
    return sides.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """doc and set (all shingle hashes) of the classes in ``wanted`` (distinct ``doc``). Texts are picked by
    doc_id, then sets by size and digest, as one doc_id may have several texts."""
    wanted = classes.select("doc", "first_id", "n", "digest").join(wanted, "doc", "left_semi")
    if fits(wanted, BROADCAST_IDS):
        wanted = F.broadcast(wanted)
    given = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(wanted, "first_id", "left_semi")

    def build(batches):
        for piece in pieces(batches):
            values, bounds = shingle_sets(text_column(piece), words)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(np.diff(bounds), pa.int64()), digests(values, bounds), _binary(values, bounds)],
                ["first_id", "n", "digest", "set"],
            )

    built = given.mapInArrow(build, "first_id long, n long, digest binary, set binary")
    return built.join(wanted, ["first_id", "n", "digest"]).select("doc", "set").dropDuplicates(["doc"])


def measured(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """a, b, na, nb and ``both``, the size of the intersection of the full sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sets = full_sets(docs, classes, wanted, words)

    def count(batches):
        for batch in batches:
            sizes = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(s.as_buffer(), _U) for s in (x, y))
                sizes.append((len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))))
            found = np.array(sizes, np.int64).reshape(-1, 3)
            columns = [pa.array(found[:, i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["a", "b", "na", "nb", "both"])

    sides = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return sides.select("a", "b", "sa", "sb").mapInArrow(count, "a long, b long, na long, nb long, both long")


def _reaches(percent: int):
    return 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def star_pairs(lists: DataFrame) -> DataFrame:
    """a, b: the centre of each list (its first class) with every other member."""
    first = lists.groupBy("key").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pairs = lists.join(first, "key").select("a", F.col("doc").alias("b"))
    return pairs.where("a <> b").distinct()


def unfinished(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct (a, b, n, c): centre, member, its size and component, of the lists that are in several
    components. In a list of two classes the star has compared them."""
    several = lists.groupBy("key").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 2")
    placed = (
        lists.join(several, "key")
        .join(labels, lists["doc"] == labels["node"], "left")
        .select("key", "a", F.col("doc").alias("b"), "n", F.coalesce("component", "doc").alias("c"))
    )
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    return placed.join(mixed, "key", "left_semi").where("a <> b").select("a", "b", "n", "c").distinct()


def delta_pairs(near: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int, inner: int) -> DataFrame:
    """a, b: pairs of ``near`` (a, b, c, na, nb, both) around one centre and in different components whose
    differences from it may have enough in common; one of the two is ``inner`` percent like the centre."""
    sets = full_sets(docs, classes, near.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), words)

    def differences(batches):
        for batch in batches:
            parts = [
                np.setxor1d(*(np.frombuffer(s.as_buffer(), np.int64) for s in pair), assume_unique=True)
                for pair in zip(batch.column(2), batch.column(3))
            ]
            at = pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts]))
            values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(values)], ["a", "b", "token"]
            )

    sides = near.select("a", "b").join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    tokens = written(sides.select("a", "b", "sa", "sb").mapInArrow(differences, "a long, b long, token long"))
    frequency = tokens.groupBy("a", "token").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # Differences of one member only come first in the order but join with nothing: they just use up places.
    ranked = tokens.join(frequency, ["a", "token"]).groupBy("a", "b").agg(
        F.array_sort(F.collect_list(F.struct("f", "token"))).alias("t")
    )
    # f and t of the module's text, times 100 + percent.
    lost, new = F.col("na") - F.col("both"), F.col("nb") - F.col("both")
    own = near.join(ranked, ["a", "b"]).withColumns(
        {
            "d": lost + new,
            "f": 100 * lost + percent * new,
            "limit": (100 - percent) * F.col("na"),
            "inner": _reaches(inner),
        }
    )
    unit = 100 + percent
    alone = F.col("d") - F.size("t")

    def prefix(rows: DataFrame, places, side: str) -> DataFrame:
        kept = rows.withColumn("places", (places - alone).cast("int")).where("places > 0")
        token = F.posexplode(F.slice("t", F.lit(1), F.col("places"))["token"]).alias("i", "token")
        names = {"b": side, "nb": f"n{side}", "c": f"c{side}", "inner": f"inner{side}", "f": f"f{side}"}
        named = [F.col(k).alias(f"_{v}") for k, v in names.items()]
        rest = (F.size("t") - F.col("i")).alias(f"_left{side}")  # differences from this one on
        return kept.select("a", "limit", "t", *named, token).select("a", "limit", "token", rest, *[f"_{v}" for v in names.values()])

    every = prefix(own, F.col("d") - F.floor(F.col("f") / unit), "x")
    apart = own.where(F.col("f") > F.col("limit"))
    unlinked = prefix(apart, F.col("d") - F.ceil((F.col("f") - F.col("limit")) / unit) + 1, "y")
    # At the first common difference, so many are left at most on either side.
    enough = F.least("_leftx", "_lefty") * unit >= F.col("_fx") + F.col("_fy") - F.col("limit")
    joined = every.join(unlinked.drop("limit"), ["a", "token"]).where(
        (F.col("_cx") != F.col("_cy")) & (F.col("_innerx") | F.col("_innery")) & enough
    )
    pairs = joined.select(
        F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), F.col("_nx").alias("na"), F.col("_ny").alias("nb")
    )
    return pairs.where(_alike_sizes(percent / 100)).select("a", "b").distinct()


def prefix_pairs(far: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: pairs of ``far`` (a, b, n, c) around one centre and in different components that share a
    shingle of their prefixes."""
    members = far.select(F.col("b").alias("doc"), "n", "c").distinct()
    sets = full_sets(docs, classes, members.select("doc"), words)

    def explode(batches):
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(values)], ["doc", "token"])

    tokens = written(sets.mapInArrow(explode, "doc long, token long"))
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # Shingles of one document only come first in the order but join with nothing: they just use up places.
    ranked = tokens.join(frequency, "token").groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("f", "token"))).alias("t")
    )
    own = ranked.join(members, "doc")
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("t"))
    prefix = own.where(places > 0).select(
        "doc", "n", "c", "t", F.posexplode(F.slice("t", F.lit(1), places.cast("int"))["token"]).alias("i", "token")
    )
    rows = prefix.select("doc", "n", "c", "token", (F.size("t") - F.col("i")).alias("left")).join(
        far.select("a", F.col("b").alias("doc")).distinct(), "doc"
    )
    x = rows.select("a", "token", *[F.col(c).alias(f"_{c}x") for c in ("doc", "n", "c", "left")])
    y = rows.select("a", "token", *[F.col(c).alias(f"_{c}y") for c in ("doc", "n", "c", "left")])
    # At the first common shingle, so many are left at most on either side.
    enough = F.least("_leftx", "_lefty") * (100 + percent) >= percent * (F.col("_nx") + F.col("_ny"))
    joined = x.join(y, ["a", "token"]).where((F.col("_cx") < F.col("_cy")) & enough)
    pairs = joined.select(
        F.least("_docx", "_docy").alias("a"), F.greatest("_docx", "_docy").alias("b"),
        F.col("_nx").alias("na"), F.col("_ny").alias("nb"),
    )
    return pairs.where(_alike_sizes(percent / 100)).select("a", "b").distinct()


def grouped(docs: DataFrame, words: int, similarity: float, k: int) -> DataFrame:
    """doc_id, n_shingles, text_hash, class_id, component_id of each document, and ``head``: whether it has the
    smallest doc_id of the class that names its group. Documents that are linked with nothing have no head."""
    percent = round(similarity * 100)
    if not 75 <= percent <= 100:
        raise ValueError("the search is built for similarities from 0.75 to 1")
    inner, outer = max(0, 100 - 2 * (100 - percent)), max(0, 100 - 3 * (100 - percent))
    low = similarity - MARGIN * math.sqrt(similarity * (1 - similarity) / k)
    sketched = written(sketches(docs, words, k))
    named = sketched.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    order = ["first_id", "n", "digest"]
    first = named.groupBy("digest", "n").agg(F.min("doc_id").alias("first_id"))
    # Ascending over the ranges, so the smallest number of a group belongs to its smallest doc_id.
    first = written(
        first.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("doc", F.monotonically_increasing_id())
    )
    members = written(
        named.join(first, ["digest", "n"]).select(
            "doc_id", "n", "doc", "first_id", "text_hash", F.when(F.col("doc_id") == F.col("first_id"), F.col("sketch")).alias("sketch")
        )
    )
    classes = members.where(F.col("sketch").isNotNull()).dropDuplicates(["doc"])
    lists = inverted_lists(classes)
    stars = written(
        measured(written(estimated(star_pairs(lists), classes, STAR_SHARE, STAR_SHARE, k)), docs, first, words)
    )
    links = stars.where(_reaches(percent)).select("a", "b")
    labels = components(links)
    rest = written(unfinished(lists, labels).join(stars.select("a", "b", "na", "both"), ["a", "b"], "left"))
    if not rest.isEmpty():
        around = rest.withColumnRenamed("n", "nb").where("both IS NOT NULL")
        near = around.where(_reaches(outer))
        far = rest.withColumnRenamed("n", "nb").where(~F.coalesce(_reaches(inner), F.lit(False)))
        far = far.select("a", "b", F.col("nb").alias("n"), "c")
        more = delta_pairs(near, docs, first, words, percent, inner).union(prefix_pairs(far, docs, first, words, percent)).distinct()
        likely = written(estimated(written(more), classes, low, similarity, k))
        links = links.union(written(measured(likely, docs, first, words)).where(_reaches(percent)).select("a", "b"))
        labels = components(links)
    heads = first.select(F.col("doc").alias("component"), F.col("first_id").alias("component_id"))
    labels = labels.join(heads, "component")
    linked = members.join(labels, members["doc"] == labels["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "text_hash", F.col("first_id").alias("class_id"),
        F.coalesce("component_id", "first_id").alias("component_id"),
        ((F.col("doc") == F.coalesce("component", "doc")) & (F.col("doc_id") == F.col("first_id"))).alias("head"),
        "doc",
    )
    alone = sketched.where(F.col("doc_id").isNull() | (F.col("n") == 0)).select(
        "doc_id", F.col("n").alias("n_shingles"), "text_hash", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"),
        F.lit(None).cast("boolean").alias("head"), F.lit(None).cast("long").alias("doc"),
    )
    return linked.union(alone)


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, k: int = SKETCH
) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id (smallest doc_id
    reachable) and kept (doc_id = component_id) of each document."""
    found = grouped(docs, words, similarity, k).drop("text_hash", "head", "doc")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group, one with the smallest doc_id; rows without doc_id and different
    texts without words all stay, equal rows of one doc_id count once. Other columns stay as they are, whatever their names."""
    found = grouped(docs, words, similarity, SKETCH).where("doc_id IS NOT NULL")
    # Of a group's rows of one doc_id and one set any text will do: the one of the smallest hash.
    heads = found.where("head").groupBy("doc", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    empty = found.where("head IS NULL").select("doc_id", "text_hash")
    kept = heads.select("doc_id", "text_hash").union(empty).distinct()
    names = free_names(docs, "id_key", "text_key")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(names[0]), F.xxhash64("text").alias(names[1]))
    kept = kept.toDF(*names)
    named = keyed.join(kept, names, "left_semi").dropDuplicates(names)
    return named.select(*[column(c) for c in docs.columns]).unionByName(docs.where("doc_id IS NULL"))
