"""Operator 10, token-id output: texts to ids, ids to compressed, checksummed blocks in ascending id order, and back.

Texts are range-partitioned and sorted by document id; each task tokenises its range and writes blocks of whole
documents (about ``BLOCK_IDS`` ids; a longer document is one block). The table of blocks is the file: one row is a
block with its range, its place in the range, its documents and their lengths, and the coded ids, so any block can be
read alone. A document's offset is the ids of earlier ranges, of earlier blocks, and of earlier documents of its
block.

Tokenising. The vocabulary never joins text across white space, so a text's ids are the ids of its parts between
ASCII blanks; every different part is encoded by the tokenizers library once per worker process, which remembers parts
by 64-bit fingerprints from batch to batch and task to task. Parts of lower-case letters alone are one word to the
vocabulary and are encoded many at a time, told apart by the ids that only end a word; other plain parts by a mark.

Defined results: null and empty texts have the end id only; null doc_ids come first; rows of one doc_id are ordered by
text (null first) and each is written; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from widelines.llm.storage import stored
from widelines.llm.textkernel import span_hashes
from widelines.llm.token_codec import decode_block, encode_block

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END = 1
BLOCK_IDS = 1 << 20
#: Different parts that a worker process remembers (about 30 bytes each); beyond it the memory starts anew.
KEPT_PARTS = 4_000_000
#: Texts tokenised at once: bounds the memory of a batch.
SLICE_BYTES = 4 << 20
#: Plain pieces that are encoded as one text.
JOINED = 64
#: Stands between joined pieces that are not all letters; no plain piece holds it.
MARK = "\x01"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SIGNS_AT_END = r"[a-zß-öø-ÿ](?P<tail>[!-/:-@\[-`{-~]+)$"
_LETTERS = "^[a-zß-öø-ÿ]+$"
BLOCKS = "part long, block long, doc_ids array<long>, lengths array<long>, n_ids long, ids binary"


def _pieces(parts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Parts without blanks as two pieces each (the second may be empty) whose ids are the part's: in plain parts the
    signs at the end are split from a letter before them, and the tokenizer lower-cases."""
    plain = _plain(parts)
    lower = pc.if_else(plain, pc.utf8_lower(parts), parts)
    tail = pc.struct_field(pc.extract_regex(pc.if_else(plain, lower, ""), _SIGNS_AT_END), "tail").fill_null("")
    body = pc.utf8_rtrim(pc.if_else(pc.not_equal(tail, ""), lower, ""), characters=_SIGNS)
    return pc.if_else(pc.not_equal(tail, ""), body, lower), tail.cast(pa.large_string())


def _plain(parts: pa.Array) -> pa.Array:
    """Parts of visible ASCII and Latin-1 letters: the tokenizer's normaliser changes but their case (of its special
    tokens, in "<|", not even that)."""
    return pc.and_not(pc.match_substring_regex(parts, "^[!-~À-ÖØ-öø-ÿ]*$"), pc.match_substring(parts, "<|"))


def _hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the strings that are not empty, as blanks at a text's end leave some; their fingerprints)."""
    if not len(strings):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    _, bounds, data = strings.buffers()
    bounds = np.frombuffer(bounds, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    full = np.flatnonzero(np.diff(bounds))
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return full, span_hashes(data, bounds[:-1][full], bounds[1:][full])


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` items, by half as many again at least, so that adding costs what is added."""
    if size <= len(array):
        return array
    more = np.empty(max(size, len(array) * 3 // 2), array.dtype)
    more[: len(array)] = array
    return more


class Memory:
    """Token ids of strings by their fingerprints. An entry's number is its place in the order of adding; number 0 is
    the empty string and 1 a text's end, both without a fingerprint. The numbers are found in a table of twice as many
    slots or more: from the slot that the fingerprint names, up to the next free one."""

    def __init__(self):
        self.n, self.slots = 0, np.full(1 << 12, -1, np.int32)
        self.prints, self.bounds, self.flat = np.zeros(16, np.uint64), np.zeros(16, np.int64), np.zeros(16, np.int32)
        self._append(np.zeros(2, np.uint64), np.array([0, 1]), np.array([END], np.int32))

    def __len__(self) -> int:
        return self.n

    def _append(self, prints: np.ndarray, count: np.ndarray, flat: np.ndarray) -> None:
        n, size = self.n + len(prints), int(self.bounds[self.n])
        self.prints, self.bounds = _grown(self.prints, n), _grown(self.bounds, n + 1)
        self.flat = _grown(self.flat, size + len(flat))
        self.prints[self.n : n], self.flat[size : size + len(flat)] = prints, flat
        self.bounds[self.n + 1 : n + 1] = size + np.cumsum(count)
        self.n = n

    def _place(self, first: int) -> None:
        """Put the entries from ``first`` on into the table."""
        mask = len(self.slots) - 1
        todo = np.arange(first, self.n, dtype=np.int32)
        slot = (self.prints[first : self.n] & np.uint64(mask)).astype(np.int64)
        while len(todo):
            free = self.slots.take(slot) < 0
            self.slots[slot[free]] = todo[free]
            lost = self.slots.take(slot) != todo
            todo, slot = todo[lost], (slot[lost] + 1) & mask

    def find(self, prints: np.ndarray) -> np.ndarray:
        """Numbers of the entries with these fingerprints, or -1."""
        found, mask = np.full(len(prints), -1, np.int64), len(self.slots) - 1
        todo, slot = np.arange(len(prints)), (prints & np.uint64(mask)).astype(np.int64)
        while len(todo):
            entry = self.slots.take(slot)
            used = entry >= 0
            hit = used & (self.prints.take(entry, mode="clip") == prints.take(todo))
            found[todo[hit]] = entry[hit]
            on = used & ~hit
            todo, slot = todo[on], (slot[on] + 1) & mask
        return found

    def add(self, prints: np.ndarray, count: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Remember strings that are different and not known yet, by the number of their ids and these in a row;
        returns their numbers."""
        first = self.n
        self._append(prints, count, flat)
        if 2 * self.n > len(self.slots):
            self.slots, first_placed = np.full(1 << (2 * self.n).bit_length(), -1, np.int32), 2
        else:
            first_placed = first
        self._place(first_placed)
        return np.arange(first, self.n)

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all entries in a row, ids of each)."""
        first = self.bounds.take(entries)
        count = self.bounds.take(entries + 1) - first
        return self.flat.take(np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))), count


class Encoder:
    """Ids of whole texts, through a memory of parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain, self.letters = (Tokenizer.from_file(path) for _ in range(3))
        self.plain.normalizer = self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.mark = self.plain.encode(MARK, add_special_tokens=False).ids
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.last = np.zeros(self.vocabulary, bool)  # ids that only the end of a word has
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.last[number] = token.endswith(suffix)
        self.memory = Memory()

    @property
    def keys(self) -> np.ndarray:
        """Fingerprints of what is remembered."""
        return self.memory.prints[2 : self.memory.n]

    def _together(self, tokenizer, pieces: pa.Array, between: str, end: str) -> np.ndarray:
        """Ids of pieces, many encoded as one text."""
        some = pa.ListArray.from_arrays(pa.array([*range(0, len(pieces), JOINED), len(pieces)], pa.int32()), pieces)
        texts = pc.binary_join(some, pa.scalar(between, pieces.type)).to_pylist()
        ids = [x.ids for x in tokenizer.encode_batch_fast([t + end for t in texts], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int32, sum(map(len, ids)))

    def _of_letters(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, ids of each piece) of pieces of lower-case letters, each one word to the tokenizer; None if the ends
        of words don't tell them apart."""
        flat = self._together(self.letters, pieces, " ", "")
        ends = np.flatnonzero(self.last[flat])
        if len(ends) != len(pieces) or ends[-1] != len(flat) - 1:
            return None
        return flat, np.diff(ends, prepend=-1)

    def _of_signs(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The same of any plain lower-case pieces; None if the marks don't tell them apart."""
        flat = self._together(self.plain, pieces, f" {MARK} ", f" {MARK}")
        ends = np.flatnonzero(flat == self.mark[0])
        if len(self.mark) != 1 or len(ends) != len(pieces):
            return None
        return flat[flat != self.mark[0]], np.diff(ends, prepend=-1) - 1

    def _one_by_one(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(count.sum())), count

    def _pieces_entries(self, pieces: pa.Array) -> np.ndarray:
        """Entries of different pieces; those not known are encoded and remembered."""
        full, prints = _hashes(pieces)
        at = self.memory.find(prints)
        new = np.flatnonzero(at < 0)
        unknown = pieces.take(pa.array(full[new]))
        letters = pc.match_substring_regex(unknown, _LETTERS)
        plain = pc.and_not(_plain(unknown), letters)
        other = pc.invert(pc.or_(letters, plain))
        for some, encode in ((letters, self._of_letters), (plain, self._of_signs), (other, self._one_by_one)):
            if pc.any(some).as_py():
                chosen = unknown.filter(some)
                flat, count = encode(chosen) or self._one_by_one(chosen)
                where = new[some.to_numpy(zero_copy_only=False)]
                at[where] = self.memory.add(prints[where], count, flat)
        entries = np.zeros(len(pieces), np.int64)
        entries[full] = at
        return entries

    def _learn(self, prints: np.ndarray, parts: pa.Array) -> np.ndarray:
        """Remember parts by the ids of their pieces, many of which are remembered from other parts."""
        body, tail = (p.cast(pa.large_string()) for p in _pieces(parts))
        pieces = pa.concat_arrays([body, tail]).dictionary_encode()
        pairs = self._pieces_entries(pieces.dictionary)[pieces.indices.to_numpy()].reshape(2, -1)
        made = pc.or_(pc.not_equal(body, parts), pc.not_equal(tail, "")).to_numpy(zero_copy_only=False)
        flat, count = self.memory.ids(pairs[:, made].T.reshape(-1))
        entries = pairs[0].copy()  # a part that is a piece itself is remembered by now
        entries[made] = self.memory.add(prints[made], count.reshape(-1, 2).sum(axis=1), flat)
        return entries

    def _parts_entries(self, parts: pa.Array) -> np.ndarray:
        """Entries of different parts."""
        full, prints = _hashes(parts)
        at = self.memory.find(prints)
        new = np.flatnonzero(at < 0)
        if len(self.memory) + len(new) > KEPT_PARTS:
            self.memory = Memory()
            new = np.arange(len(prints))
        if len(new):
            at[new] = self._learn(prints[new], parts.take(pa.array(full[new])))
        entries = np.zeros(len(parts), np.int64)
        entries[full] = at
        return entries

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each ended by ``END``; ids of each text)."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        entries = self._parts_entries(words.dictionary.cast(pa.large_string()))
        # the ids of each kind of word as a byte string, and of a text's end as one more kind: Arrow lines them up
        flat, count = self.memory.ids(np.append(entries, 1))
        bounds = np.concatenate([[0], np.cumsum(count)]) * flat.itemsize
        kinds = pa.Array.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
        ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        order = np.insert(words.indices.to_numpy(zero_copy_only=False), ends, len(entries))
        _, bounds, data = kinds.take(pa.array(order)).buffers()
        bounds = np.frombuffer(bounds, np.int64)[: len(order) + 1] // flat.itemsize
        ids = np.frombuffer(data or b"", flat.dtype)[: bounds[-1]]
        return ids, np.diff(bounds[ends + np.arange(1, len(ends) + 1)], prepend=0)


def worker_encoder(path: str) -> Encoder:
    """This worker process's encoder; it and its memory are kept for the tasks to come."""
    kept = vars(sys.modules.setdefault("_widelines_encoders", types.ModuleType("_widelines_encoders")))
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_blocks(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None,
                 ranges: int | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of ``docs`` as a table of blocks below ``spark.checkpoint.dir``; returns the table read again."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path("word_bpe_49k.json")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = None, TaskContext.get().partitionId(), 0
        held, held_docs, held_lengths, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([number]), pa.array([held_docs], pa.list_(pa.int64())),
                 pa.array([held_lengths], pa.list_(pa.int64())), pa.array([len(ids)]),
                 pa.array([encode_block(ids, encoder.vocabulary)], pa.binary())],
                names=["part", "block", "doc_ids", "lengths", "n_ids", "ids"])

        for batch in batches:
            encoder = encoder or worker_encoder(path)
            for rows in _slices(batch):
                ids, lengths = encoder.encode(rows.column(1))
                ends = np.cumsum(lengths)
                for doc, end, n in zip(rows.column(0).to_pylist(), ends, lengths):
                    if size and size + n > block_ids:
                        yield block()
                        held, held_docs, held_lengths, size, number = [], [], [], 0, number + 1
                    held.append(ids[end - n : end])
                    held_docs.append(doc)
                    held_lengths.append(int(n))
                    size += int(n)
        if held:
            yield block()

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(
        ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, BLOCKS), "token-blocks")


def block_starts(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``start``: ids of all blocks before. Sums within a range, then over the ranges' totals."""
    before = Window.unboundedPreceding, -1
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids_of_part")).select(
        "part", F.coalesce(F.sum("ids_of_part").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("part_start"))
    index = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("block").rowsBetween(*before)), F.lit(0)).alias("block_start"))
    starts = index.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("start"))
    return blocks.join(starts, ["part", "block"])


def read_documents(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document, decoded from its block and checked; without
    ``with_ids`` all but the ids, which then needn't leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, lengths, start, data in zip(*(batch.column(k) for k in range(4))):
                ids = decode_block(data.as_py())
                lengths = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                if ends[-1] != len(ids):
                    raise ValueError("a block's documents do not add up to its ids")
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = {"doc_id": docs.values, "start": pa.array(start.as_py() + ends - lengths),
                           "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
                    columns["ids"] = pa.ListArray.from_arrays(bounds, pa.array(ids))
                yield pa.RecordBatch.from_pydict(columns)

    found = block_starts(blocks).select("doc_ids", "lengths", "start", "ids")
    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
