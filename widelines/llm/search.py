"""Operator 11, ranked lexical search: bit-sliced Bloom signatures as upper bounds, then exact scores.

Index. A chunk of documents is cut into classes of similar size. A class has a Bloom signature of 12 to 24 bits for
each entry of a document, stored by bit: a slice holds one bit of all documents of the class, a document a column. An
entry is a term and a level; level l says that the term occurs at least 2**l times. The slices of a term's entry,
AND-ed, mark every document that has it (and some that don't), so the levels bound its frequency from above.

Search. For each query the weights of the marked terms at their highest possible frequency sum to an upper bound of
each document's score. The ``TOP`` documents of the highest bounds are scored exactly; the lowest of these scores is
a floor under the query's last rank. All documents whose bound reaches it (none is provably excluded) are then scored
exactly from their whole texts. Floors come from real scores and bounds never fall short, so ranks are exact.

Queries are read in blocks of at most ``BLOCK_QUERIES`` rows or ``BLOCK_BYTES`` of text (on average, by hash), which
bounds everything that is broadcast or collected; documents to score are broadcast below ``BROADCAST_ROWS`` rows and
joined by a shuffle beyond. Terms are 64-bit fingerprints of their words, in the index 48 bits of them.

Defined results: documents or queries with null or empty text, or no term: never ranked, no rank. Fewer than ``TOP``
documents with a score above 0: all of them. Equal scores: ascending doc_id, nulls last. Repeated rows are documents
of their own. Rows that share an item_id are queries of their own. Other columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from widelines.functions.joins import is_bounded
from widelines.llm.storage import stored
from widelines.llm.textkernel import ALNUM_WORDS, chunks, mix, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
BLOCK_QUERIES, BLOCK_BYTES = 1000, 4 << 20
BROADCAST_ROWS = 100_000
CHUNK_BYTES = 8 << 20
ROW_BITS = 16
FINGERPRINT = np.uint64((1 << 64 - ROW_BITS) - 1)
LEVELS = 7
HASHES = 4
BITS_PER_ENTRY = 12
FILTER_BITS = 20
#: Query and document pairs that a task holds before it keeps the best of each query only.
HELD = 1 << 20

INDEX = "bits int, docs int, slices binary, doc_ids binary, digests binary, terms binary, most binary, n_docs long, n_terms long"
DOC_ID = np.dtype([("null", "u1"), ("id", "<i8")])


def _slices_of(entries: np.ndarray, bits: int) -> np.ndarray:
    """The HASHES slices of each entry."""
    low, high = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    at = np.stack([((low + np.uint64(j) * high) & np.uint64(0xFFFFFFFF)) * np.uint64(bits) >> np.uint64(32)
                   for j in range(HASHES)], 1)
    return at.astype(np.int64)


def _entry(fingerprints: np.ndarray, level: int) -> np.ndarray:
    return mix(fingerprints, 70 + level)


def _signatures(row: np.ndarray, fingerprints: np.ndarray, tf: np.ndarray, docs: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """For each class of documents: bits, its documents, its slices."""
    per_doc = np.zeros(docs, np.int64)
    level_of = np.minimum(np.frexp(tf.astype(np.float64))[1] - 1, LEVELS - 1)  # highest level of each term
    np.add.at(per_doc, row, level_of + 1)
    size_class = np.ceil(np.log2(np.maximum(per_doc, 4))).astype(np.int64)
    for c in np.unique(size_class[per_doc > 0]):
        mine = np.flatnonzero((size_class == c) & (per_doc > 0))
        column = np.full(docs, -1, np.int64)
        column[mine] = np.arange(len(mine))
        bits = BITS_PER_ENTRY << int(c)
        marks = np.zeros((bits, len(mine)), bool)
        inside = np.flatnonzero(column[row] >= 0)
        for level in range(LEVELS):
            inside = inside[level_of[inside] >= level]
            if not len(inside):
                break
            at = _slices_of(_entry(fingerprints[inside], level), bits)
            marks[at, column[row[inside]][:, None]] = True
        yield bits, mine, np.packbits(marks, axis=1).tobytes()


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The signature index of all documents that have a term: a row for each chunk and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1 << ROW_BITS):
                batch = whole.slice(begin, 1 << ROW_BITS)
                for chunk in chunks(batch.column(2), lower=True, size=CHUNK_BYTES):
                    starts, ends, first = chunk.words(ALNUM_WORDS)
                    terms = np.diff(first)
                    key = np.repeat(np.arange(len(chunk), dtype=np.uint64) << np.uint64(64 - ROW_BITS), terms)
                    key = np.sort(key | (span_hashes(chunk.data, starts, ends) & FINGERPRINT))
                    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
                    tf = np.diff(np.append(head, len(key)))
                    row = (key[head] >> np.uint64(64 - ROW_BITS)).astype(np.int64)
                    most = np.zeros(len(chunk), np.int64)
                    np.maximum.at(most, row, tf)
                    ids = np.zeros(len(chunk), DOC_ID)
                    column = batch.column(0).slice(chunk.first, len(chunk))
                    ids["null"], ids["id"] = column.is_null().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()
                    digests = batch.column(1).slice(chunk.first, len(chunk)).to_numpy()
                    for bits, mine, slices in _signatures(row, key[head] & FINGERPRINT, tf, len(chunk)):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([bits], pa.int32()), pa.array([len(mine)], pa.int32()),
                            *(pa.array([x], pa.binary()) for x in (slices, ids[mine].tobytes(), digests[mine].tobytes(),
                                                                   terms[mine].astype(np.int64).tobytes(), most[mine].tobytes())),
                            pa.array([len(mine)], pa.int64()), pa.array([int(terms[mine].sum())], pa.int64())],
                            names=[x.split()[0] for x in INDEX.split(", ")])

    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    return bare.mapInArrow(run, INDEX)


class Queries:
    """A block of queries: its distinct terms, and for each term the queries that hold it and how often."""

    def __init__(self, texts: list[str | None]):
        term, query = [], []
        for chunk in chunks(pa.array(texts, pa.large_string()), lower=True):
            starts, ends, first = chunk.words(ALNUM_WORDS)
            term.append(span_hashes(chunk.data, starts, ends))
            query.append(np.repeat(np.arange(chunk.first, chunk.last), np.diff(first)))
        term = np.concatenate(term) if term else np.zeros(0, np.uint64)
        query = np.concatenate(query) if query else np.zeros(0, np.int64)
        self.n = len(texts)
        self.terms, number = np.unique(term, return_inverse=True)
        pairs, self.count = np.unique(number * max(self.n, 1) + query, return_counts=True)
        self.query = pairs % max(self.n, 1)
        self.first = np.searchsorted(pairs // max(self.n, 1), np.arange(len(self.terms) + 1))
        self.may = np.zeros(1 << FILTER_BITS, bool)
        self.may[mix(self.terms) >> np.uint64(64 - FILTER_BITS)] = True
        self.weight, self.docs, self.total = np.zeros(len(self.terms), np.int64), 0, 1

    @classmethod
    def of(cls, state: dict) -> "Queries":
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    def weigh(self, df: dict[int, int], docs: int, total: int) -> None:
        self.docs, self.total = docs, max(total, 1)
        self.weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1)))
                                for t in range(len(self.terms))], np.int64)

    def damping(self, n: np.ndarray) -> np.ndarray:
        """m of documents of n terms."""
        if len(n) and 25 * int(n.max()) * self.docs >= 2**63:
            return np.array([75 + 25 * int(x) * self.docs // self.total for x in n], np.int64)
        return 75 + 25 * n * self.docs // self.total

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, term) of the hashes that are terms of the block."""
        at = np.flatnonzero(self.may[mix(hashes) >> np.uint64(64 - FILTER_BITS)])
        term = np.searchsorted(self.terms, hashes[at])
        good = np.zeros(len(at), bool)
        inside = term < len(self.terms)
        good[inside] = self.terms[term[inside]] == hashes[at[inside]]
        return at[good], term[good]

    def frequencies(self, chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, tf) of a chunk's texts for the block's terms, and the terms of each text."""
        starts, ends, first = chunk.words(ALNUM_WORDS)
        at, term = self.found(span_hashes(chunk.data, starts, ends))
        row = np.searchsorted(first, at, "right") - 1
        pairs, tf = np.unique(row * max(len(self.terms), 1) + term, return_counts=True)
        return pairs // max(len(self.terms), 1), pairs % max(len(self.terms), 1), tf, np.diff(first)

    def scores(self, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, rows: int) -> np.ndarray:
        """Sums by (row, query); ``m`` by row."""
        part = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
        times = np.diff(self.first)[term]
        use = np.repeat(self.first[term] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        out = np.zeros(rows * self.n, np.int64)
        np.add.at(out, np.repeat(row, times) * self.n + self.query[use], self.count[use] * np.repeat(part, times))
        return out.reshape(rows, self.n)


def document_frequencies(docs: DataFrame, shared, text: str) -> DataFrame:
    """(term, df) for the terms of a block of queries, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries.of(shared.value)
        total = np.zeros(len(queries.terms), np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0), lower=True):
                total += np.bincount(queries.frequencies(chunk)[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["term", "df"])

    return docs.select(text).mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class _Best:
    """The best ``TOP`` rows of each query so far: (query, score, document id, a further number)."""

    def __init__(self, top: int):
        self.top, self.held, self.size = top, [], 0

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, more: np.ndarray) -> None:
        self.held.append((query, score, ids, more))
        self.size += len(query)
        if self.size > HELD:
            self.held = [self.best()]
            self.size = len(self.held[0][0])

    def best(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, DOC_ID), np.zeros(0, np.int64)
        query, score, ids, more = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids["id"], ids["null"], -score, query))
        first = np.searchsorted(query[order], query[order])
        order = order[np.arange(len(order)) - first < self.top]
        return query[order], score[order], ids[order], more[order]


def _ids_array(ids: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(ids["id"]), mask=ids["null"] == 1)


def _bounds(queries: Queries, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(upper bounds by (document, query), ids, digests) of a row of the index."""
    bits, docs = row["bits"], row["docs"]
    slices = np.frombuffer(row["slices"], np.uint8).reshape(bits, -1)
    n, most = np.frombuffer(row["terms"], np.int64), np.frombuffer(row["most"], np.int64)
    fingerprints = queries.terms & FINGERPRINT
    marked = np.arange(len(fingerprints))
    level = np.zeros((len(fingerprints), docs), np.int8)
    before = None
    for lv in range(LEVELS):
        at = _slices_of(_entry(fingerprints[marked], lv), bits)
        here = slices[at[:, 0]]
        for j in range(1, HASHES):
            here &= slices[at[:, j]]
        if before is not None:
            here &= before
        some = here.any(axis=1)
        marked, before = marked[some], here[some]
        if not len(marked):
            break
        level[marked] += np.unpackbits(before, axis=1, count=docs).view(np.int8)
    term, doc = np.nonzero(level)
    lv = level[term, doc].astype(np.int64)
    tf = np.where(lv < LEVELS, np.minimum((1 << lv) - 1, most[doc]), most[doc])
    return (queries.scores(doc, term, tf, queries.damping(n), docs), np.frombuffer(row["doc_ids"], DOC_ID),
            np.frombuffer(row["digests"], np.int64))


def _candidates(index: DataFrame, shared, floors: np.ndarray | None, top: int) -> DataFrame:
    """(query, doc_id, digest, bound): each task's ``top`` highest bounds of a query, or all that reach its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = Queries.of(shared.value), _Best(top)
        names = ["query", "doc_id", "digest", "bound"]
        for batch in batches:
            for k in range(batch.num_rows):
                bounds, ids, digests = _bounds(queries, batch.slice(k, 1).to_pylist()[0])
                if floors is not None:
                    doc, query = np.nonzero(bounds >= floors)
                    yield pa.RecordBatch.from_arrays([pa.array(query), _ids_array(ids[doc]), pa.array(digests[doc]),
                                                      pa.array(bounds[doc, query])], names=names)
                    continue
                least = max(1, len(ids) - top)
                doc = np.argpartition(bounds, least - 1, axis=0)[least - 1 :] if len(ids) > top else np.repeat(
                    np.arange(len(ids))[:, None], queries.n, 1)
                query = np.broadcast_to(np.arange(queries.n), doc.shape)
                doc, query = doc.ravel(), query.ravel()
                good = bounds[doc, query] > 0
                best.add(query[good], bounds[doc, query][good], ids[doc[good]], digests[doc[good]])
        if floors is None:
            query, bound, ids, digests = best.best()
            yield pa.RecordBatch.from_arrays([pa.array(query), _ids_array(ids), pa.array(digests), pa.array(bound)], names=names)

    return index.drop("n_docs", "n_terms").mapInArrow(run, "query long, doc_id long, digest long, bound long")


def _scored(docs: DataFrame, wanted: DataFrame, shared, top: int) -> DataFrame:
    """(query, doc_id, score): exact scores of the wanted pairs (doc_id, digest, queries), the ``top`` of each task."""
    known = wanted.withColumnRenamed("doc_id", "_id").withColumnRenamed("digest", "_digest")
    both = docs.join(known, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))).select(
        "doc_id", "text", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = Queries.of(shared.value), _Best(top)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                for chunk in chunks(batch.column(1), lower=True):
                    part = batch.slice(chunk.first, len(chunk))
                    row, term, tf, n = queries.frequencies(chunk)
                    scores = queries.scores(row, term, tf, queries.damping(n), len(chunk))
                    lists = part.column(2)
                    row = np.repeat(np.arange(len(chunk)), lists.value_lengths().to_numpy())
                    query = lists.flatten().to_numpy()
                    ids = np.zeros(len(chunk), DOC_ID)
                    column = part.column(0)
                    ids["null"], ids["id"] = column.is_null().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()
                    score = scores[row, query]
                    good = score > 0
                    best.add(query[good], score[good], ids[row[good]], np.zeros(int(good.sum()), np.int64))
        query, score, ids, _ = best.best()
        yield pa.RecordBatch.from_arrays([pa.array(query), _ids_array(ids), pa.array(score)], names=["query", "doc_id", "score"])

    return both.mapInArrow(run, "query long, doc_id long, score long")


def _ranked(found: DataFrame, order: list, top: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)


def _by_document(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("doc_id", "digest").agg(F.collect_set("query").alias("queries"))


def _query_blocks(queries: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list]]:
    rows = queries.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    size, count = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    n = max(1, math.ceil(2 * size / BLOCK_BYTES), math.ceil(2 * count / BLOCK_QUERIES)) if max(
        size / BLOCK_BYTES, count / BLOCK_QUERIES) > 1 else 1
    for k in range(n):
        found = (rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows).collect()
        yield [r["item_id"] for r in found], [r["text"] for r in found]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    spark = docs.sparkSession
    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    index = stored(build_index(bare), "signatures")
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    item_type = items.schema[item_id].dataType
    kinds = T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", item_type)])
    out = None
    for names, texts in _query_blocks(items, item_id, item_text):
        queries = Queries(texts)
        plain = spark.sparkContext.broadcast(vars(queries))
        df = {r["term"]: r["df"] for r in document_frequencies(bare, plain, "text").collect()}  # a row for each term at most
        queries.weigh(df, n_docs, n_terms)
        shared = spark.sparkContext.broadcast(vars(queries))
        highest = _ranked(_candidates(index, shared, None, top), [F.desc("bound"), F.col("doc_id").asc_nulls_last()], top)
        first = _scored(bare, F.broadcast(_by_document(highest)), shared, top)  # top rows for each query at most
        floors = np.ones(max(queries.n, 1), np.int64)
        for r in _ranked(first, [F.desc("score"), F.col("doc_id").asc_nulls_last()], top).where(F.col("rank") == top).collect():
            floors[r["query"]] = r["score"]
        wanted = stored(_by_document(_candidates(index, shared, floors[: queries.n], top)), "candidates")
        if is_bounded(wanted, BROADCAST_ROWS):
            wanted = F.broadcast(wanted)
        best = _ranked(_scored(bare, wanted, shared, top), [F.desc("score"), F.col("doc_id").asc_nulls_last()], top)
        named = spark.createDataFrame(pa.table({"query": pa.array(range(len(names)), pa.int64()),
                                                "item_id": pa.array(names, to_arrow_type(item_type))}), kinds)
        part = best.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out
