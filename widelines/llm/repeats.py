"""Operator 12, substring dedup: prefix-partitioned suffix trees over words.

Every word with at least ``window`` words of its document from it on begins a suffix. Suffixes are split by prefixes
of variable length: those whose first word falls into a bin of at most ``group_records`` suffixes go by that word;
those of larger bins by their first four words, and where even these are too many, by all ``window`` words. The bins
are counted over all documents, one scan a length. Bins are packed by hash into groups that fit a task's memory.

A group holds the subtrees of its prefixes. A subtree is built only where it matters: suffixes are sorted by a
fingerprint of their path down to depth ``window``, so that the leaves below one internal node of at least that depth
stand together. All leaves but the first, by (document, place), begin a repeat; repeats that overlap or touch in
a document join to maximal ones. A fingerprint has 56 bits beside the group, and only suffixes of one group can be
confused: n suffixes give about n * group_records / 2**57 false repeats, one in 1,000 runs over 100 million words.

What a suffix needs to travel is 7 bytes of fingerprint, and its place in its chunk of documents and its document as
differences. A chunk sends each path once, since its later copies are known to be repeats, so that a passage that
stands in every document makes one record a chunk. Decisions come back by chunk, and become word spans by document.
Texts are shuffled only for documents whose hash bucket (of ``BUCKETS``) holds one with repeats.

Defined results: null or empty text, or fewer words than ``window``: nothing is removed. Null doc_ids count as one
id after all others. Rows that share a doc_id stand in one document's place: of equal words at equal places in them
neither is earlier, while later places and ids lose theirs; exactly repeated rows so have equal results. Other
columns are not read. ``docs`` should be a stored table, since it is scanned several times.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.llm import varint
from widelines.llm.storage import stored
from widelines.llm.textkernel import WHITESPACE_WORDS, Chunk, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of the prefixes that are tried before the whole window.
PREFIXES = (1, 4)
GROUP_RECORDS = 2_000_000
PRINT_BYTES = 7
BUCKETS = 1 << 20
CHUNK_BYTES = 4 << 20

PACKED = "group int, chunk long, a binary, b binary, c binary, d binary, e binary"
BACK = "chunk long, directory boolean, a binary, b binary, c binary, d binary, e binary"
DOC_ID = np.dtype([("null", "u1"), ("id", "<i8")])


def path_hashes(words: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size the hash of the words from each place on (shorter by size - 1 places)."""
    power, made = [words], []
    while 2 ** len(power) <= max(sizes):
        half, n = power[-1], 2 ** (len(power) - 1)
        power.append(mix(half[:-n] * np.uint64(3) + half[n:], 31) if len(half) > n else half[:0])
    for size in sizes:
        out, done = None, 0
        for k in reversed(range(len(power))):
            if size >> k & 1:
                part = power[k][done:]
                out = part if out is None else mix(out[: len(part)] * np.uint64(5) + part, 32 + k)
                done += 2 ** k
        made.append(out)
    return made


def _suffixes(chunk: Chunk, window: int, sizes: tuple[int, ...]):
    """Of a chunk: first word of each text, places of suffixes of at least ``window`` words, path hashes per size."""
    starts, ends, first = chunk.words(WHITESPACE_WORDS)
    hashes = path_hashes(span_hashes(chunk.data, starts, ends), sizes)
    count = np.maximum(np.diff(first) - window + 1, 0)
    at = np.arange(int(count.sum())) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    return first, at, np.repeat(np.arange(len(chunk)), count), [h[at] for h in hashes]


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """Chunks of several small batches together, so that a task has few of them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= CHUNK_BYTES:
            yield from _cut(held, column)
            held, size = [], 0
    if held:
        yield from _cut(held, column)


def _cut(held: list[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    batch = pa.Table.from_batches(held).combine_chunks().to_batches()
    for part in batch:
        for chunk in chunks(part.column(column), size=CHUNK_BYTES):
            yield part.slice(chunk.first, len(chunk)), chunk


def _bin(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hashes, 41) >> np.uint64(64 - bits)).astype(np.int64)


def _counted(docs: DataFrame, window: int, level: int, bits: int, crowded: list[np.ndarray]) -> DataFrame:
    """(bin, n): suffixes in each bin of the level's prefixes, of those that all shorter prefixes leave in crowded bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for _, chunk in _texts(batches, 0):
            *_, hashes = _suffixes(chunk, window, PREFIXES[: level + 1])
            left = np.ones(len(hashes[0]), bool)
            for known, h in zip(crowded, hashes):
                left &= known[_bin(h, bits)]
            total += np.bincount(_bin(hashes[level][left], bits), minlength=1 << bits)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bin", "n"])

    return docs.select("text").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))


def _doc_ids(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), DOC_ID)
    out["null"] = column.is_null().to_numpy(zero_copy_only=False)
    out["id"] = column.fill_null(0).to_numpy(zero_copy_only=False)
    return out


def _first_of_path(prints: np.ndarray, docs: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf whose path another leaf shares: its index and the index of the path's first leaf, by document and place."""
    order = np.argsort(prints)
    p = prints[order]
    same = np.zeros(len(p), bool)
    if len(p):
        equal = p[1:] == p[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    some = order[same]
    some = some[np.lexsort((place[some], docs["id"][some], docs["null"][some], prints[some]))]
    p = prints[some]
    head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, np.int64)
    return some, np.repeat(some[head], np.diff(np.append(head, len(p))))


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _varints(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Values [bounds[i], bounds[i + 1]) as one binary each."""
    data, size = varint.encode(values)
    return _binary(data, np.concatenate([[0], np.cumsum(size)])[bounds])


def _deltas(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Differences of ascending values; the first of each stretch as it is."""
    out = np.diff(values, prepend=0)
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    out[heads] = values[heads]
    return out


def _undeltas(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[1:] - np.repeat(total[bounds[:-1]], np.diff(bounds))


def _batch(columns: list[pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, schema)], schema=schema)


_B = pa.binary()
PACKED_ARROW = pa.schema([("group", pa.int32()), ("chunk", pa.int64()), *((c, _B) for c in "abcde")])
BACK_ARROW = pa.schema([("chunk", pa.int64()), ("directory", pa.bool_()), *((c, _B) for c in "abcde")])


def _pack(docs: DataFrame, window: int, bits: int, crowded: list[np.ndarray], groups: int) -> DataFrame:
    """A row for each chunk and group, of the paths that the chunk sends, and a directory row for each chunk.

    Paths: a fingerprints, b places, c records a document, d first word of the document, e its id. Directory: a digest
    of each text, b places known to begin repeats, c words of each text, d pairs (place, place that decides for it),
    e ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows, chunk in _texts(batches, 2):
            first, at, row, hashes = _suffixes(chunk, window, (*PREFIXES, window))
            path = hashes[-1]
            ids = _doc_ids(rows.column(0))
            place = at - first[row]
            some, head = _first_of_path(path, ids[row], place)
            later = (ids[row[some]] != ids[row[head]]) | (place[some] != place[head])
            alias = ~later & (some != head)
            send = np.ones(len(at), bool)
            send[some] = some == head
            key = path
            for level in reversed(range(len(PREFIXES))):
                short = _bin(hashes[level], bits)
                key = np.where(crowded[level][short], key, mix(short.astype(np.uint64), 50 + level))
            group = (mix(key, 42) % np.uint64(groups))[send].astype(np.uint16 if groups < 1 << 16 else np.int64)
            order = np.argsort(group, kind="stable")
            kept = np.flatnonzero(send)[order]
            group = group[order].astype(np.int64)
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]) if len(group) else np.zeros(1, np.int64)
            new = np.ones(len(kept), bool)
            if len(kept):
                new[1:] = row[kept[1:]] != row[kept[:-1]]
            new[bounds[:-1]] = True
            runs = np.flatnonzero(new)
            by_group = np.searchsorted(runs, bounds)
            prints = path[kept].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PRINT_BYTES]
            of_run = row[kept[runs]]
            listed = [
                pa.array(np.append(group[bounds[:-1]], groups + number % groups)),
                pa.array(np.full(len(bounds), number)),
                *[pa.chunked_array([x.cast(_B), pa.array([y], _B)]).combine_chunks() for x, y in (
                    (_binary(prints, bounds * PRINT_BYTES), rows.column(1).to_numpy(zero_copy_only=False).tobytes()),
                    (_varints(_deltas(at[kept], bounds), bounds),
                     varint.encode(np.diff(np.sort(at[some[later]]), prepend=0))[0].tobytes()),
                    (_varints(np.diff(np.append(runs, len(kept))), by_group), varint.encode(np.diff(first))[0].tobytes()),
                    (_varints(_deltas(first[of_run], by_group), by_group),
                     varint.encode(np.stack([at[some[alias]], at[head[alias]]], 1).ravel())[0].tobytes()),
                    (_binary(ids[of_run].view(np.uint8), by_group * DOC_ID.itemsize), ids.tobytes()))]]
            yield _batch(listed, PACKED_ARROW)
            number += 1

    return docs.mapInArrow(run, PACKED)


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each value ends in them, from 0."""
    whole = column.cast(pa.large_binary()).combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    _, bounds, data = whole.buffers()
    bounds = np.frombuffer(bounds, np.int64)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of varints, and how many lie before each row's end, from 0."""
    data, bounds = _bytes(column)
    return varint.decode(data), np.concatenate([[0], np.cumsum(data < 128)])[bounds]


def _repeat_places(groups: int):
    """Function of one group's rows: per chunk the places of the leaves that are not their path's first."""

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return BACK_ARROW.empty_table()
        if table["group"][0].as_py() >= groups:  # directories
            return pa.table([table["chunk"], pa.array([True] * table.num_rows), *(table[c] for c in "abcde")],
                            schema=BACK_ARROW)
        raw, size = _bytes(table["a"])
        bounds = size // PRINT_BYTES
        prints = np.zeros((int(bounds[-1]), 8), np.uint8)
        prints[:, :PRINT_BYTES] = raw.reshape(-1, PRINT_BYTES)
        prints = prints.view("<u8").ravel()
        place = _undeltas(_values(table["b"])[0], bounds)
        runs, by_run = _values(table["c"])
        begin = np.repeat(_undeltas(_values(table["d"])[0], by_run), runs)
        ids = np.repeat(np.frombuffer(_bytes(table["e"])[0].tobytes(), DOC_ID), runs)
        start = place - begin
        some, head = _first_of_path(prints, ids, start)
        later = np.sort(some[(ids[some] != ids[head]) | (start[some] != start[head])])
        cut = np.searchsorted(later, bounds)
        has = np.flatnonzero(np.diff(cut))
        cut = np.append(cut[has], len(later))
        found = _varints(_deltas(place[later], cut), cut).cast(_B)
        none = pa.nulls(len(has), _B)
        return pa.table([table["chunk"].take(pa.array(has)), pa.array([False] * len(has)), none, found, none, none, none],
                        schema=BACK_ARROW)

    return run


SPANS = "doc_id long, digest long, spans binary"
SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("spans", _B)])


def _spans_of_chunk(window: int):
    """Function of one chunk's directory and decisions: the documents with repeats, and their word spans."""

    def run(table: pa.Table) -> pa.Table:
        listed = table.filter(table["directory"]).slice(0, 1)
        words = _values(listed["c"])[0]
        first = np.concatenate([[0], np.cumsum(words)])
        ids = np.frombuffer(_bytes(listed["e"])[0].tobytes(), DOC_ID)
        digests = np.frombuffer(_bytes(listed["a"])[0].tobytes(), np.int64)
        repeat = np.zeros(first[-1] + 1, bool)
        places, bounds = _values(table["b"])
        repeat[_undeltas(places, bounds)] = True
        alias = _values(listed["d"])[0].reshape(-1, 2)
        repeat[alias[:, 0]] = repeat[alias[:, 1]]
        at = np.flatnonzero(repeat)
        row = np.searchsorted(first, at, "right") - 1
        new = np.ones(len(at), bool)
        if len(at):
            new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + window)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[: len(head)] - 1
        owner = row[head]
        flat = np.stack([at[head] - first[owner], at[tail] - at[head] + window], 1).ravel()
        docs = np.unique(owner)
        cut = np.append(np.searchsorted(owner, docs), len(owner)) * 2
        return pa.table([pa.array(ids["id"][docs], mask=ids["null"][docs] == 1), pa.array(digests[docs]),
                         _varints(flat, cut).cast(_B)], schema=SPANS_ARROW)

    return run


def repeat_spans(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text: str = "text",
                 group_records: int = GROUP_RECORDS) -> DataFrame:
    """(doc_id, digest, spans) of the documents with repeats. ``spans``: varints, the first word and the length of each
    maximal stretch of words that windows cover which begin earlier elsewhere. ``digest``: xxhash64 of the text."""
    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    bits, crowded, total = 12, [], None
    for level in range(len(PREFIXES)):
        if total is None or crowded[-1].any():
            bins = stored(_counted(bare, window, level, bits, crowded), "prefix-bins")
            if total is None:
                total = bins.agg(F.sum("n")).first()[0] or 0
            found = [r[0] for r in bins.where(F.col("n") > group_records).select("bin").collect()]
        else:
            found = []
        crowded.append(np.isin(np.arange(1 << bits), found))
    groups = max(1, math.ceil(2 * total / group_records))
    packed = _pack(bare, window, bits, crowded, groups)
    back = packed.groupBy("group").applyInArrow(_repeat_places(groups), BACK)
    return back.groupBy("chunk").applyInArrow(_spans_of_chunk(window), SPANS).dropDuplicates(["doc_id", "digest"])


def drop_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text: str = "text",
                 group_records: int = GROUP_RECORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    spans = stored(repeat_spans(docs, window, id_col, text, group_records), "repeat-spans")
    bucket = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(BUCKETS)).cast("int")
    found = spans.withColumnRenamed("doc_id", "_id").withColumnRenamed("digest", "_digest")
    marked = F.broadcast(spans.select(bucket.alias("_bucket")).distinct().withColumn("_marked", F.lit(True)))  # at most BUCKETS
    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    bare = bare.withColumn("_bucket", bucket).join(marked, "_bucket", "left")
    touched = bare.where("_marked").join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    both = touched.select("doc_id", "text", "spans").unionByName(
        bare.where("_marked is null").select("doc_id", "text", F.lit(None).cast("binary").alias("spans")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
                words = (text.as_py() or b"").split()
                left = words
                if spans.is_valid:
                    left, done = [], 0
                    for a, n in varint.decode(np.frombuffer(spans.as_buffer(), np.uint8)).reshape(-1, 2).tolist():
                        left += words[done:a]
                        done = a + n
                    left += words[done:]
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
