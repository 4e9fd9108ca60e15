"""Operator 10's memory of parts: the ids are the library's own, whatever is remembered or forgotten."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from widelines.llm import token_codec, token_output


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    parts = ["the", "The", "THE", "a.", "b,", "a..", "end.)", "naïve", "Ünïcode.", "日本語", "é", "<|endoftext|>", "<|END|>", "x<|y",
             "don't", "3.14", "1,000", "--", ".", ",", "A.B.C.", "emoji😀.", "tab nb", "İ", "ß", "http://a.b/c?d=e", "​"]
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", " \n "]
    return ["".join(rng.choice(parts) + rng.choice(blanks) for _ in range(rng.randrange(12))).strip(rng.choice(["", " \n"]))
            for _ in range(n)] + ["", " ", "\n\n", None]


def test_ids_are_those_of_whole_texts(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), odd_texts(6000)
    want = [x.ids + [token_output.END] for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]

    def check(encoder, step):
        for a in range(0, len(texts), step):
            ids, per_text = encoder.encode(pa.array(texts[a : a + step], pa.string()))
            assert per_text.tolist() == [len(w) for w in want[a : a + step]]
            assert ids.tolist() == [i for w in want[a : a + step] for i in w]

    encoder = token_output.Encoder(path)
    check(encoder, 1000)
    remembered = len(encoder.keys)
    check(encoder, 700)
    assert len(encoder.keys) == remembered  # nothing is learnt twice
    monkeypatch.setattr(token_output, "KEPT_PARTS", 40)
    check(token_output.Encoder(path), 300)


def test_a_worker_keeps_its_encoder():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_output.worker_encoder(path) is token_output.worker_encoder(path)


def test_blocks_take_few_steps_and_stay_small():
    """Work that each step does for the whole vocabulary is done at most 128 times for a block of usual size."""
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 1 << 18), 48_999)
    assert token_codec._lanes(token_output.BLOCK_IDS)[1] <= 128
    for n in (1, 2, 127, 128, 129, 5_000, 1 << 18):
        data = token_codec.encode_block(ids[:n], 49_000)
        assert np.array_equal(token_codec.decode_block(data), ids[:n])
    assert len(data) < 1.5 * len(ids)


def test_words_leave_lanes_that_are_settled_or_short():
    rng = np.random.default_rng(6)
    low, span = rng.integers(0, 2**64, (2, 4000), np.uint64)
    span[::3] >>= np.uint64(40)
    low[::5] = np.uint64(2**48 - 5)  # a carry is open
    span[::5] = np.uint64(10)
    want = [(int(a) ^ (int(a) + int(b)) % 2**64) < 2**48 or int(b) < 2**32 for a, b in zip(low, span)]
    assert token_codec._due(low, span).tolist() == want


def test_pieces_of_plain_parts():
    """Signs after a letter are a piece of their own, letters of Latin-1 are lower-cased; the ids are the library's."""
    parts = ["ÉTÉ!!!", "été", "Don't.,", "it's'", "x<|Y.", "a1.", "...", "Ünï_-", "a\x01b.", "x\x1cY", "ŁÓ.", "éT.", "\x01", "'S!",
             "×A.", "µM,", "a B.", "ÀÿÞß%%%", "q.w?!", "<|endoftext|>"]
    body, tail = token_output._pieces(pa.array(parts, pa.large_string()))
    pairs = dict(zip(parts, zip(body.to_pylist(), tail.to_pylist())))
    assert pairs["ÉTÉ!!!"] == ("été", "!!!") and pairs["Don't.,"] == ("don't", ".,") and pairs["q.w?!"] == ("q.w", "?!")
    assert pairs["x<|Y."] == ("x<|Y.", "") and pairs["a1."] == ("a1.", "") and pairs["..."] == ("...", "")
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), token_output.Encoder(path)
    texts = [" ".join(parts), *parts, *(f"{p}{s}" for p in parts for s in ("", ".", "?!", "'s", "é"))]
    for some in (texts[:1], texts[1:30], texts):
        ids, _ = encoder.encode(pa.array(some, pa.string()))
        want = library.encode_batch(some, add_special_tokens=False)
        assert ids.tolist() == [i for x in want for i in (*x.ids, token_output.END)]


def test_plain_pieces_are_encoded_together(monkeypatch):
    path, seen = public_tokenizers.path("word_bpe_49k.json"), []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **kw):
            seen.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **kw)

    encoder = token_output.Encoder(path)
    encoder.tokenizer = Counting(encoder.tokenizer)
    if hasattr(encoder, "plain"):
        encoder.plain = Counting(encoder.plain)
    words = [a + b + c for a in "abcdefgh" for b in "aeiou" for c in ("n", "s.", "T!", "é")]
    encoder.encode(pa.array([" ".join(words)], pa.string()))
    assert len(seen) <= len(words) // 16


def test_letter_pieces_are_encoded_without_marks():
    """The library gives out hardly more ids than the pieces have: none for marks between parts of letters."""
    path, given = public_tokenizers.path("word_bpe_49k.json"), []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **kw):
            made = self.tokenizer.encode_batch_fast(texts, **kw)
            given.extend(i for x in made for i in x.ids)
            return made

    encoder, library = token_output.Encoder(path), Tokenizer.from_file(path)
    for name, value in list(vars(encoder).items()):
        if isinstance(value, Tokenizer):
            setattr(encoder, name, Counting(value))
    words = [a + b + c + d for a in "abcdefgh" for b in "aeiouéü" for c in "nstß" for d in ("", "ing", "ÿ", "E.")]
    ids, _ = encoder.encode(pa.array([" ".join(words)], pa.string()))
    assert ids.tolist() == [*library.encode(" ".join(words), add_special_tokens=False).ids, token_output.END]
    assert len(given) < len(ids) + len(words) // 16


def test_pieces_that_cannot_be_told_apart_are_encoded_one_by_one():
    path, texts = public_tokenizers.path("word_bpe_49k.json"), odd_texts(300, seed=8)
    library, encoder = Tokenizer.from_file(path), token_output.Encoder(path)
    encoder.last[:], encoder.mark = False, [*encoder.mark, *encoder.mark]  # as with a vocabulary that has neither
    ids, _ = encoder.encode(pa.array(texts, pa.string()))
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert ids.tolist() == [i for x in want for i in (*x.ids, token_output.END)]


def test_memory_finds_what_was_added():
    """Through growth, and with fingerprints that name the same slot; what is added costs no copy of the rest."""
    rng, memory, want = np.random.default_rng(9), token_output.Memory(), {}
    for k in range(40):
        same_slot = rng.integers(0, 2**20, 9, np.uint64) << np.uint64(40)
        prints = np.unique(np.concatenate([rng.integers(0, 2**63, 300, np.uint64), same_slot]))
        prints = prints[memory.find(prints) < 0]
        count = rng.integers(0, 4, len(prints))
        flat = rng.integers(0, 49_000, int(count.sum())).astype(np.int32)
        entries = memory.add(prints, count, flat)
        for p, e, ids in zip(prints.tolist(), entries.tolist(), np.split(flat, np.cumsum(count)[:-1])):
            want[p] = (e, ids.tolist())
    found = memory.find(np.array([*want], np.uint64))
    flat, count = memory.ids(found)
    assert found.tolist() == [e for e, _ in want.values()] and len(memory) == len(want) + 2
    assert [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])] == [ids for _, ids in want.values()]
    assert (memory.find(rng.integers(2**63, 2**64, 1000, np.uint64)) < 0).all()
    kept = memory.flat
    memory.add(np.array([2**63 + 5], np.uint64), np.array([1]), np.array([7], np.int32))
    assert memory.flat is kept or len(memory.flat) >= len(kept) * 3 // 2


def test_documents_are_read_with_and_without_ids(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts(60, seed=4))]
    blocks = token_output.write_blocks(spark.createDataFrame(rows, "doc_id long, text string"), ranges=3, block_ids=50)
    whole, digests = token_output.read_documents(blocks), token_output.read_documents(blocks, with_ids=False)
    assert whole.columns == [*digests.columns, "ids"]
    assert sorted(map(tuple, whole.drop("ids").collect())) == sorted(map(tuple, digests.collect()))
    assert all(len(r["ids"]) == r["n_tokens"] for r in whole.collect())
