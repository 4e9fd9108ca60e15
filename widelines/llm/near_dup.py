"""Operator 7, near-duplicates: fast similarity sketching, banding, exact verification, components.

Sketch. Each text's set of word shingles fills ``bins`` coordinates in rounds: in round i every shingle is hashed to
a bin and a value, a bin keeps its smallest value, and earlier rounds win. After ``bins`` random rounds, round
``bins + j`` throws every shingle at bin j, so each coordinate is filled after at most 2 * bins rounds; texts of many
shingles need one round, about n + bins * ln(bins) hash evaluations in all. Equal coordinates estimate Jaccard
similarity with the concentration of independent samples.

Candidates. Texts with equal sets are one class. Rows of ``rows`` coordinates make band keys; classes that share a
key are candidates. ``rows`` and ``bands`` are set so that a pair at the threshold is missed with probability below
1e-5. Buckets of the same members count once. In each bucket a hub (the class that meets most others) is compared
with all members; linked members are one component, the hub leaves the bucket, and a bucket whose rest is one
component is done. Members of buckets that are still open after ``STAR_ROUNDS`` meet in cells of bounded size with
their full sets. A large bucket is cut into blocks by hash, and each pair of blocks is a cell, so that no bucket's
size is capped. A cell emits links that join components, at most one fewer than it has members: shingles that no other
member holds are counted out first (copies that differ from all others in too many of them can't be linked), then
intersections are counted through the cell's inverted index, for members of different components only.

Links are confirmed on the full shingle sets, read again from the whole texts of candidates. Shingles are 64-bit
fingerprints of their words.

Defined results: null or empty text, or text without words: 0 shingles, linked with nothing. Null doc_id: component
null and kept, since it names no document. Rows that share a doc_id are one document: all its texts' links count.
Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.llm.graph import components
from widelines.llm.storage import stored
from widelines.llm.textkernel import WHITESPACE_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = 5
STAR_ROUNDS = 1
ID_BUCKETS = 1 << 20
#: Members, and bytes of their sets, of one block of a bucket; a cell holds one or two blocks.
BLOCK_MEMBERS, BLOCK_BYTES = 512, 32 << 20


def bands_for(threshold: float, rows: int = ROWS, miss: float = 1e-5) -> int:
    return math.ceil(math.log(miss) / math.log1p(-(threshold ** rows)))


def shingle_sets(chunk: Chunk, size: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles, as 64-bit fingerprints."""
    starts, ends, first = chunk.words(WHITESPACE_WORDS)
    hashes = span_hashes(chunk.data, starts, ends)
    windows = mix(hashes, 1)
    for _ in range(size - 1):
        hashes = hashes[1:]
        windows = mix(windows[: len(hashes)] + hashes, 2)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for h in span_hashes(chunk.data, starts[a:b], ends[a:b]):
                whole = mix(np.array([whole ^ h]), 3)[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` values for each non-empty set (rows of empty sets stay unfilled)."""
    empty = np.uint64(2**64 - 1)
    bits = np.uint64((2 * bins).bit_length())  # the round's number stands first, so that earlier rounds win
    out = np.full(len(sets) * bins, empty, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(2 * bins):
        if not len(items):
            break
        h = mix(items, 16 + i)
        at = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32) if i < bins else np.uint64(i - bins)
        value = (np.uint64(i) << (np.uint64(64) - bits)) | (mix(h) >> bits)
        np.minimum.at(out, owner * bins + at.astype(np.int64), value)
        full = (out.reshape(-1, bins) != empty).all(axis=1)
        todo = ~full[owner]
        items, owner = items[todo], owner[todo]
    return out.reshape(-1, bins)


def _digest(s: np.ndarray, seed: int) -> int:
    return int(mix(s, seed).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0


SKETCHED = "doc_id long, n_shingles long, hi long, lo long, bands array<long>"


def sketch_texts(df: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, n_shingles, 128-bit digest of the set, band keys) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), lower=True):
                sets = list(shingle_sets(chunk, size))
                filled = sketches(sets, rows * bands)
                keys = np.zeros((len(sets), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                for r in range(rows):
                    keys = mix(keys + filled[:, r * bands : (r + 1) * bands], 5)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, len(chunk)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s, 11) for s in sets], pa.int64()),
                    pa.array([_digest(s, 12) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(sets) * bands + 1, bands), pa.int32()),
                                             pa.array(keys.ravel().view(np.int64)))],
                    names=["doc_id", "n_shingles", "hi", "lo", "bands"])

    return df.mapInArrow(run, SKETCHED)


def set_bytes(df: DataFrame, size: int) -> DataFrame:
    """(doc_id, hi, lo, items: the sorted fingerprints as bytes) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), lower=True):
                sets = list(shingle_sets(chunk, size))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, len(chunk)),
                    pa.array([_digest(s, 11) for s in sets], pa.int64()),
                    pa.array([_digest(s, 12) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "hi", "lo", "items"])

    return df.mapInArrow(run, "doc_id long, hi long, lo long, items binary")


def linked_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, items_a, items_b) those pairs with 100 * |intersection| >= percent * |union|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                if 100 * min(len(u), len(v)) < percent * max(len(u), len(v)):
                    good.append(False)
                    continue
                both = np.sort(np.concatenate([u, v]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]],
                                             names=["a", "b"])

    return pairs.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long")


def cell_links(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (100 * |intersection| >= percent * |union|) that join the components of a cell's members as far as any do.
    Members with different ``side`` are compared, or all where it is 0 throughout."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    item, member = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(item, kind="stable")
    item, member = item[order], member[order]
    first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    df = np.diff(np.append(first, len(item)))
    shared = np.repeat(df > 1, df)
    common = np.bincount(member[shared], minlength=n)  # no intersection is larger
    alive = 100 * common >= percent * size
    keep = shared & alive[member]
    item, member = item[keep], member[keep]
    start = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
    number = np.cumsum(np.isin(np.arange(len(item)), start)) - 1
    end = np.append(start[1:], len(item))
    own = np.argsort(member, kind="stable")
    mine = np.searchsorted(member[own], np.arange(n + 1))
    _, label = np.unique(component, return_inverse=True)
    links = []
    for x in np.argsort(-common, kind="stable").tolist():
        if not alive[x]:
            continue
        open_ = alive & (label != label[x]) & ((side != side[x]) | (side.max() == 0))
        least = np.minimum(common, common[x])  # the largest intersection there can be
        open_ &= 100 * least >= percent * (size + size[x] - least)
        if not open_.any():
            continue
        of = number[own[mine[x] : mine[x + 1]]]
        length = end[of] - start[of]
        at = np.repeat(start[of] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        both = np.bincount(member[at], minlength=n)
        for y in np.flatnonzero(open_ & (100 * both >= percent * (size + size[x] - both))).tolist():
            if label[x] != label[y]:
                label[label == label[y]] = label[x]
                links.append((x, y))
    return links


def _compared(percent: int):
    """Function of one cell (bucket, i, j): its links."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"]]
        found = []
        if len(np.unique(table["component"].to_numpy())) > 1:
            side = (block != block[0]).astype(np.int64)
            if table["i"][0].as_py() == table["j"][0].as_py() or side.max() > 0:
                found = cell_links(sets, table["component"].to_numpy(), side, percent)
        rep = table["rep"].to_numpy()
        return pa.table({"a": pa.array([rep[x] for x, _ in found], pa.int64()),
                         "b": pa.array([rep[y] for _, y in found], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text: str = "text", rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept. ``doc_id`` must be an integer column."""
    threshold = percent / 100
    bands = bands_for(threshold, rows)
    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sk = stored(sketch_texts(bare, size, rows, bands), "sketches")
    named = sk.where("n_shingles > 0 and doc_id is not null")
    classes = stored(named.groupBy("hi", "lo", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")

    rows_of = classes.select("rep", "hi", "lo", "n_shingles", F.explode("bands").alias("bucket"))
    kinds = stored(rows_of.groupBy("bucket").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("m1"),
        F.sum(F.shiftright(F.xxhash64("rep", F.lit(2)), 24)).alias("m2")).where("size > 1").groupBy("size", "m1", "m2").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "buckets")
    met = stored(rows_of.join(kinds, "bucket"), "met")
    meets = met.groupBy("rep").agg(F.sum("size").alias("meets"))
    members = stored(met.drop("size", "hi", "lo").distinct().join(meets, "rep"), "members")

    wanted = met.select(F.col("rep").alias("doc_id"), "hi", "lo").distinct()
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS)).cast("int")
    marked = F.broadcast(wanted.select(bucket.alias("_bucket")).distinct())  # at most ID_BUCKETS rows
    texts = bare.join(marked, bucket == F.col("_bucket"), "left_semi")  # so that few other texts are shuffled
    full = set_bytes(texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text"), size)
    sets = stored(full.join(wanted, ["doc_id", "hi", "lo"], "left_semi").dropDuplicates(["doc_id", "hi", "lo"])
                  .select(F.col("doc_id").alias("rep"), "items"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a"))
        right = sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b"))
        return stored(linked_pairs(pairs.join(left, "a").join(right, "b"), percent), "links")

    # A document whose rows have several texts ties their classes together.
    several = named.groupBy("doc_id").agg(F.min("hi").alias("h1"), F.max("hi").alias("h2"),
                                          F.min("lo").alias("l1"), F.max("lo").alias("l2")
                                          ).where("h1 != h2 or l1 != l2").select("doc_id")
    links = (named.join(several, "doc_id").join(classes.select("hi", "lo", "n_shingles", "rep"),
                                                ["hi", "lo", "n_shingles"])
             .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b"))

    comp = None
    for _ in range(STAR_ROUNDS):
        hubs = stored(members.groupBy("bucket").agg(F.max(F.struct("meets", "rep")).alias("top")).select(
            "bucket", F.col("top.rep").alias("hub")), "hubs")
        spokes = members.join(hubs, "bucket").where("rep != hub")
        links = links.unionByName(confirmed(spokes.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()))
        comp = stored(components(links), "components")
        labelled = spokes.drop("hub").join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))
        open_ = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
        members = stored(labelled.drop("component").join(open_.select("bucket"), "bucket", "left_semi"), "members")

    rest = stored(members.select("rep", "bucket", "n_shingles").join(
        comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "rest")
    blocks = stored(rest.groupBy("bucket").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_MEMBERS, 8 * F.sum("n_shingles") / BLOCK_BYTES)).alias("blocks")), "blocks")
    celled = (rest.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("rep", "bucket"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("rep", "component", "bucket", "block", F.least("block", "other").alias("i"),
                      F.greatest("block", "other").alias("j")).join(sets, "rep"))
    links = links.unionByName(stored(celled.groupBy("bucket", "i", "j").applyInArrow(
        _compared(percent), "a long, b long"), "links"))
    comp = stored(components(links), "components")

    of_class = classes.select("hi", "lo", "n_shingles", "rep").join(
        comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "hi", "lo", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    found = sk.select("doc_id", "n_shingles", "hi", "lo").join(of_class, ["hi", "lo", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(
        F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less those of documents that another document of their component stands for."""
    gone = near_duplicates(docs, size, percent, id_col, text).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
