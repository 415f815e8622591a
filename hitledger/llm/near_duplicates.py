"""MinHash near-duplicates: one permutation, optimal densification, star-shaped candidates.

A document is the set of its five-word shingles. Equal sets are one node from the start, so
a large group of copies costs one node. The signature of a set takes a single hash of each
shingle: the hash picks one of ``BINS`` bins, the smallest hash of a bin is its value, and
an empty bin borrows the value of a filled one, which it finds by hashing its own number
again and again until it hits one (optimal densification: each borrower chooses anew, so
equal sets still agree and others stay independent). Bands of ``ROWS`` values are buckets.

In a bucket, candidate edges form a star: its centre is compared with all other members,
never all members with each other. The centre is the member that meets the most others over
all bands. Comparison is exact, on the full sets. Where everybody is linked, directly or
through other buckets, the star settles a bucket. Members of the other buckets may still be
similar to each other; between those that are not yet connected, candidates are found
exactly, by a join on their rarest shingles (see ``rare_pairs``). So no link between
members of a bucket is lost, and the number of pairs stays near that of the links.

Two sets of similarity 0.75 miss each other in all bands with probability
(1 - 0.75^ROWS)^BANDS, which is 5e-6 here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.components import components
from hitledger.llm.frames import stored, without

WORDS = 5
PERCENT = 75
BANDS = 32
ROWS = 4
BINS = BANDS * ROWS

ADDED = ("n_shingles", "component_id", "kept")
IN_WORD = batches.word_class(batches.SPACES)
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row in ascending order, and their bounds. A row of
    one to four words has its whole sequence as its only shingle."""
    starts, ends, bounds = batches.words(data, offsets, IN_WORD)
    hashes = batches.word_hashes(data, starts, ends, batches.FOLDED)
    row = batches.rows_of(bounds)
    found = batches.shingle_hashes(hashes, WORDS)
    inside = row[: len(found)] == row[WORDS - 1 :] if len(found) else np.zeros(0, bool)
    values, rows = [found[inside]], [row[: len(found)][inside]]
    n = np.diff(bounds)
    for few in range(1, WORDS):
        short = np.flatnonzero(n == few)
        if len(short):
            values.append(batches.shingle_hashes(hashes, few)[bounds[short]])
            rows.append(short)
    values, rows = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[first], rows[first]
    return values, np.searchsorted(rows, np.arange(len(bounds)))


def set_digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """16 bytes for each set, equal for equal sets; null for an empty one."""
    out = []
    for half in (1, 2):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(batches.mix(values + np.uint64(half)), out=sums[1:])
        out.append(batches.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    digests = np.stack(out, axis=1).astype(">u8")
    return [d.tobytes() if n else None for d, n in zip(digests, np.diff(bounds), strict=True)]


def _probes(count: int = 64) -> np.ndarray:
    """For each bin, the bins it would borrow from, in order."""
    tries = np.arange(BINS * count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (batches.mix(tries) % np.uint64(BINS)).astype(np.int64).reshape(BINS, count)


PROBES = _probes()


def signature(values: np.ndarray) -> np.ndarray:
    """One value per bin for a set of hashes that is not empty."""
    spread = batches.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    bins = np.full(BINS, _EMPTY)
    np.minimum.at(bins, ((spread >> np.uint64(32)) % np.uint64(BINS)).astype(np.int64), spread)
    filled = bins != _EMPTY
    empty = np.flatnonzero(~filled)
    if len(empty):
        hits = filled[PROBES[empty]]
        found = hits.any(axis=1)
        source = PROBES[empty, hits.argmax(axis=1)]
        # After so many misses the next filled bin lends: possible for the smallest sets.
        after = np.flatnonzero(filled)
        following = after[np.searchsorted(after, empty) % len(after)]
        bins[empty] = bins[np.where(found, source, following)]
    return bins


def bands_of(values: np.ndarray) -> np.ndarray:
    """A hash for each band of a set's signature."""
    rows = signature(values).reshape(BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        h = batches.mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h


def _signed_sets(batch):
    """Per document its set's digest, size and bands."""
    for first, last, data, offsets in batches.slices(batch.column("text")):
        values, bounds = shingle_sets(data, offsets)
        n = np.diff(bounds)
        bands = [batches.signed(bands_of(values[bounds[r] : bounds[r + 1]])) for r in np.flatnonzero(n)]
        bands = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        edges = np.concatenate([[0], np.cumsum((n > 0) * BANDS)])
        yield pa.record_batch(
            [batch.column("doc").slice(first, last - first), pa.array(set_digests(values, bounds), pa.binary()),
             pa.array(n.astype(np.int64)), batches.lists(bands, edges, pa.int64())],
            ["doc", "node", "n_shingles", "bands"],
        )


def _full_sets(batch):
    for first, last, data, offsets in batches.slices(batch.column("text")):
        values, bounds = shingle_sets(data, offsets)
        yield pa.record_batch(
            [batch.column("node").slice(first, last - first), batches.lists(batches.signed(values), bounds, pa.int64())],
            ["node", "shingles"],
        )


def similar(n_a, n_b, common):
    """Jaccard similarity of at least PERCENT, in whole numbers."""
    return 100 * common >= PERCENT * (n_a + n_b - common)


def could_be(n_a, n_b):
    """The sizes alone allow it: the smaller set inside the larger."""
    return similar(n_a, n_b, F.least(n_a, n_b))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar, by their full sets."""
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(of_a, "a").join(of_b, "b")
    return both.filter(similar(F.size("set_a"), F.size("set_b"), common)).select("a", "b")


def _distinct(pairs: DataFrame) -> DataFrame:
    """The same pair may come from many buckets, with either as the centre."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return stored(pairs.distinct(), "pairs")


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the components on both sides of each link have become one. Only the
    labels are linked with each other, so the graph shrinks from round to round."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    between = links.join(of_a, "a").join(of_b, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    lower = components(stored(between.distinct(), "between"))
    lower = lower.select(F.col("label").alias("lower"), F.col("node").alias("label"))
    renamed = labels.join(lower, "label", "left").select("node", F.coalesce("lower", "label").alias("label"))
    return stored(renamed, "labels")


def needed(n_a, n_b):
    """The least number of common shingles with which sets of these sizes are similar."""
    return F.ceil(F.lit(PERCENT) * (n_a + n_b) / F.lit(100 + PERCENT))


def rare_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of ``nodes`` (node, n, label) with different labels, among them all
    that are similar.

    A set's shingles are ordered by how many of the nodes have them, the rarest first. Two
    similar sets share one among the first few of both, their prefixes. If that is the
    first they share, no more can be common than come after it; so the places of the shared
    shingle must leave enough. Shingles that all have one label are out before the join, and
    so are places from which no partner is in reach: what thousands of connected copies
    share pairs nobody.
    """
    rows = sets.join(nodes, "node").select("node", "n", "label", F.explode("shingles").alias("shingle"))
    rows = stored(rows, "shingles")
    times = rows.groupBy("shingle").agg(F.count("*").alias("times"))
    order = Window.partitionBy("node").orderBy("times", "shingle")
    n = F.col("n")
    ranked = rows.join(times, "shingle").withColumn("after", n - F.row_number().over(order) + 1)
    # ``after`` counts the shingles from this one on.
    prefix = stored(ranked.filter((F.col("times") > 1) & (F.col("after") >= needed(n, F.ceil(n * PERCENT / 100)))), "prefix")
    mixed = (
        prefix.groupBy("shingle")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"))
        .filter(F.col("low") != F.col("high"))
        .select("shingle", "least")
    )
    near = prefix.join(mixed, "shingle").filter(F.col("after") >= needed(n, F.col("least")))
    near = stored(near.select("shingle", "node", "n", "label", "after"), "near")
    other = near.select("shingle", *(F.col(c).alias(f"o_{c}") for c in ("node", "n", "label", "after")))
    enough = needed(n, F.col("o_n"))
    return _distinct(
        near.join(other, "shingle")
        .filter((F.col("node") < F.col("o_node")) & (F.col("label") != F.col("o_label")))
        .filter((F.col("after") >= enough) & (F.col("o_after") >= enough))
        .select(F.col("node").alias("a"), F.col("o_node").alias("b"))
    )


def links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, of all members.

    ``members`` has a row for each node of a bucket of two or more: ``band``, ``value``,
    ``node``, ``n`` (size of its set), and ``c_node``, ``c_n`` of the bucket's centre.
    """
    bucket = ["band", "value"]
    star = members.filter((F.col("node") != F.col("c_node")) & could_be(F.col("n"), F.col("c_n")))
    pairs = _distinct(star.select(F.col("c_node").alias("a"), F.col("node").alias("b")))
    labels = members.select("node").distinct().select("node", F.col("node").alias("label"))
    labels = joined(stored(labels, "labels"), confirmed(pairs, sets))

    # Members of buckets that are not all in one component may be similar to each other.
    labelled = members.select(*bucket, "node", "n").join(labels, "node")
    several = (
        labelled.groupBy(*bucket)
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter(F.col("low") != F.col("high"))
    )
    open_ = labelled.join(several.select(*bucket), bucket).select("node", "n", "label").distinct()
    found = stored(confirmed(rare_pairs(stored(open_, "open"), sets), sets), "found")
    return joined(labels, found)


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds to every document ``n_shingles`` (size of its set), ``component_id`` (the smallest
    id among the documents it is linked with, directly or through others, itself included)
    and ``kept`` (it has that id).

    Two documents are linked if the Jaccard similarity of their sets is PERCENT or more.
    Words are parted by ASCII white space and folded to lower case in ASCII. A text of fewer
    than five words, but not none, is one shingle; a null or empty text has none and is
    linked with nothing: it is kept, a component of its own. Null ids are passed over when
    the smallest is taken; a document whose component has no other id has a null
    ``component_id`` and is not kept unless its id is. Repeated ids each count as linked by
    their own text only; rows alike are both kept or both not. Besides, ``chosen`` is true
    for one row of each component, a kept one if there is, and for all without a set. Columns
    of the input named like an added one are replaced.
    """
    key = F.xxhash64(documents[text], documents[doc_id])
    other = F.xxhash64(F.lit("b"), documents[doc_id], documents[text])
    keys = F.struct(key.alias("a"), other.alias("b"))
    rows = documents.select(F.struct(documents[doc_id].alias("id"), keys.alias("key")).alias("doc"), documents[text].alias("text"))
    kind = dict(rows.dtypes)["doc"]
    signed = batches.map_batches(rows, _signed_sets, f"doc {kind}, node binary, n_shingles bigint, bands array<bigint>")
    signed = stored(signed, "signed")

    nodes = (
        signed.filter("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.min("doc.id").alias("least_id"),
             F.min(F.struct(F.isnull("doc.id").alias("none"), "doc")).alias("head"))
    )
    nodes = stored(nodes, "nodes")
    buckets = nodes.select("node", "n", F.posexplode("bands").alias("band", "value"))
    bucket = ["band", "value"]
    sizes = buckets.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1")
    crowded = stored(buckets.join(sizes, bucket), "crowded")
    # The centre is the member that meets the most others over all bands: of copies that were
    # changed in different places, the one in the middle, which most are similar to. It is
    # the same in all bands.
    turns = crowded.groupBy("node").agg((-F.sum("size")).alias("turn"))
    crowded = stored(crowded.drop("size").join(turns, "node"), "turns")
    centres = crowded.groupBy(*bucket).agg(F.min(F.struct("turn", "node", "n")).alias("centre"))
    centres = centres.select(*bucket, F.col("centre.node").alias("c_node"), F.col("centre.n").alias("c_n"))
    members = stored(crowded.join(centres, bucket), "members")

    # The full sets of the nodes that share a bucket, from the text of one document each.
    wanted = nodes.select("node", F.col("doc.key").alias("key")).join(members.select("node").distinct(), "node")
    wanted = wanted.select("node", F.col("key.a").alias("key_a"), F.col("key.b").alias("key_b"))
    texts = documents.select(key.alias("key_a"), other.alias("key_b"), documents[text].alias("text"))
    texts = texts.join(wanted, ["key_a", "key_b"]).dropDuplicates(["key_a", "key_b"]).select("node", "text")
    sets = stored(batches.map_batches(texts, _full_sets, "node binary, shingles array<bigint>"), "sets")

    labels = links(members, sets)
    labelled = nodes.select("node", "least_id", "head").join(labels, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"), F.min("head").alias("head"))
    found = labelled.drop("head").join(least, "label").select("node", "component_id", F.col("head.doc.key").alias("head"))
    result = signed.select("doc.key.a", "doc.key.b", "n_shingles", "node").distinct()
    # Names of its own for what is joined to columns of the input.
    result = result.join(found, "node", "left").select(
        F.col("a").alias("__a"), F.col("b").alias("__b"), "n_shingles", F.col("component_id").alias("__least"),
        ((F.col("head.a") == F.col("a")) & (F.col("head.b") == F.col("b"))).alias("__head"),
    )
    keyed = documents.select(*without(documents, (*ADDED, "chosen")), key.alias("__a"), other.alias("__b"))
    # Rows alike lie together after the join; it is dropped where nobody asks for it.
    alike = Window.partitionBy("__a", "__b").orderBy("__a")
    chosen = (F.col("n_shingles") == 0) | (F.col("__head") & (F.row_number().over(alike) == 1))
    component = F.when(F.col("n_shingles") == 0, F.col(doc_id)).otherwise(F.col("__least"))
    return (
        keyed.join(result, ["__a", "__b"], "left")
        .withColumn("component_id", component)
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col(doc_id)))
        .withColumn("chosen", chosen)
        .drop("__a", "__b", "__least", "__head")
    )
