"""Operators against plain versions, exact round trips and held-out rows."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from widelines.llm import queries as q
from widelines.llm import licenses, mixing, sharding, url_filter
from widelines.llm.token_codec import decode_block, encode_block

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query_equals_its_sql(spark, con, name):
    got = q.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = con.sql(q.ORACLE[name]).project(", ".join(names)).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select(*names).collect())


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_near_duplicates_by_all_pairs(spark):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for doc, text in texts(spark).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(low))
        sets[doc] = {tuple(words[i:i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()
    label = {d: d for d in sets}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((top(a), top(b)))
                    label[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.op7_minhash_near_dedup(spark, SF).collect()}
    assert got == {d: (len(s), top(d)) for d, s in sets.items()}


def test_mix_meets_targets(spark):
    rows = q.op2_source_mixing(spark, SF).select("*").collect()
    by_source = {}
    for r in rows:
        got = by_source.setdefault((r["source_size"], r["target"]), [0])
        got[0] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(v[0] - k[1]) <= mixing.BLOCK for k, v in by_source.items())


def test_draw_deals_the_sources_and_blocks_hold_their_words(spark):
    docs, per_shard = spark.read.parquet(f"{SF}/documents.parquet"), 64
    placed, draw, packed = mixing.write_packed(docs, per_shard=per_shard)
    slots = [(r["shard"], r["place"], r["rank"]) for r in draw.collect()]
    assert sorted(s[0] * per_shard + s[1] for s in slots) == list(range(len(slots))) and len(slots) > 10 * per_shard
    share = {k: sum(s[2] == k for s in slots) / len(slots) for k in {s[2] for s in slots}}
    counts = {}
    for shard, _, rank in slots:
        counts[shard, rank] = counts.get((shard, rank), 0) + 1
    off = [(counts.get((d, k), 0) - per_shard * p) / (per_shard * p * (1 - p)) ** 0.5
           for d in range(len(slots) // per_shard) for k, p in share.items()]
    assert max(map(abs, off)) < 5 and 0.5 < np.std(off) < 1.5

    known, of = texts(spark), {(r["rank"], r["start"]): r["doc_id"] for r in placed.where("size > 0").collect()}
    blocks = packed.collect()
    assert sorted((r["shard"], r["place"], r["rank"]) for r in blocks) == sorted(slots)
    taken = {}
    for r in blocks:
        for piece in r["pieces"]:
            doc, low = of[r["rank"], piece["start"]], max(r["block_no"] * mixing.BLOCK - piece["start"], 0)
            words = re.findall(r"[^\x20\x09-\x0D]+", known[doc])[low:low + piece["n"]]
            assert re.findall(r"[^\x20\x09-\x0D]+", piece["words"]) == words and len(words) == piece["n"]
            taken[doc] = taken.get(doc, 0) + piece["n"]
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()} == {d: taken.get(d, 0) for d in known}
    assert {r["doc_id"]: r["taken"] for r in q.op2_source_mixing(spark, SF).collect()} == {d: taken.get(d, 0) for d in known}


def test_shares_fill_up_to_three_times(spark):
    sizes = spark.createDataFrame([(False, "a", 10), (False, "b", 1000), (False, "c", 500)],
                                  "no_source boolean, source_key string, source_size long")
    got = {r["source_key"]: r["target"] for r in mixing.shares(sizes).collect()}
    assert got["a"] == 30 and abs(got["b"] - 1480 * 2 / 3) < 1e-6 and abs(got["c"] - 1480 / 3) < 1e-6


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 97, 1000):
        got = spark.range(n).select(mixing.permuted("id", f"{n}L", "5").alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_only_blocks_of_the_draw_leave_their_texts(spark):
    sizes = spark.createDataFrame([(False, "a", 64 * 90), (False, "b", 64 * 11 + 5), (False, "c", 64 * 70 + 1)],
                                  "no_source boolean, source_key string, source_size long")
    sources = mixing.with_slots(mixing.shares(sizes))
    assert {r["passes"] for r in sources.collect()} >= {0, 3}
    laid = sources.withColumn("text", F.expr("repeat('w ', int(source_size))")).selectExpr("*", "source_size AS size", "0L AS start")
    drawn = {(r["rank"], r["block_no"]) for r in mixing.slots(sources).collect()}
    rows = mixing.drawn_pieces(laid).collect()
    assert {(r["rank"], r["block_no"]) for r in rows} == drawn and len(drawn) < 90 + 12 + 71
    assert all(r["words"] == "w " * r["n"] and r["at"] == 0 for r in rows)


def test_permutations_run_backwards(spark):
    for n in (1, 2, 37, 1000):
        back = mixing.permuted_from("p", f"{n}L", "5")
        got = spark.range(n).select("id", mixing.permuted("id", f"{n}L", "5").alias("p")).selectExpr("id", f"{back} AS back").collect()
        assert all(r["id"] == r["back"] for r in got)



def test_deal_is_one_to_one_and_like_a_draw(spark):
    n, size = 200_000, 4096
    x, y = np.array(spark.range(n).select("id", mixing.dealt("id", f"{n}L")).collect()).T
    assert len(np.unique(y)) == n and y.min() == 0 and y.max() == n - 1
    for low, high in ((0, 0.05), (0.05, 0.3), (0.3, 1)):
        own, p = (x >= low * n) & (x < high * n), high - low
        counts = np.bincount(y[own] // size, minlength=n // size + 1)[:n // size]
        assert 0.6 < np.std((counts - size * p) / (size * p * (1 - p)) ** 0.5) < 1.4


def test_lookup_table_is_even_and_moves_little():
    one, two = sharding.lookup_table(), sharding.lookup_table(sharding.SHARDS[:-1])
    counts = np.bincount(one)
    assert counts.max() - counts.min() <= 1
    moved = np.mean([a != b for a, b in zip(one, two) if a < len(sharding.SHARDS) - 1])
    assert moved < 0.1


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000, 70_000])
def test_codec_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.zeros(n, np.int64), rng.zipf(1.3, n) % 49408, np.arange(n) % 7):
        data = encode_block(ids, 49408)
        assert (decode_block(data) == ids).all()


def test_codec_compresses_and_checks():
    ids = np.random.default_rng(1).zipf(1.5, 50_000) % 5000
    data = encode_block(ids, 49408)
    assert len(data) < 2 * len(ids)
    broken = bytearray(data)
    broken[len(data) // 2] ^= 255
    with pytest.raises(ValueError):
        decode_block(bytes(broken))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    found = q.op8_toxicity(spark, sf)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found.collect())
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    row = found.where("held_out").join(labels, "doc_id").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("bad"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false")).first()
    assert row["bad"] > 0.5 and row["false"] < 0.05


def test_licences_of_varied_notices(spark):
    rows, want = [], {}
    for k, (family, notices) in enumerate(licenses.TEMPLATES.items()):
        rows.append((k, f"Some text before.\n{notices[0]}\nAnd after."))
        want[k] = [family]
    rows.append((99, "An ordinary paragraph about licence plates and gardens.\n\nNothing else."))
    want[99] = []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["licences"] for r in licenses.licences(docs).collect()} == want


def test_slot_of_a_document(spark):
    row = q.op5_maglev_sharding(spark, SF).where("doc_id = 3").first()
    slot = int(hashlib.md5(b"3").hexdigest()[:15], 16) % sharding.SLOTS
    assert row["slot"] == slot and row["shard"] == sharding.SHARDS[sharding.lookup_table()[slot]]


def test_licences_of_wrapped_notices(spark):
    import textwrap

    rows, want = [], {}

    def add(text, families):
        want[len(rows)] = families
        rows.append((len(rows), text))

    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            for mark in ("", "# ", " * "):
                wrapped = "\n".join(mark + x for x in textwrap.wrap(notice, 40))
                add(f"Some words of prose come before it.\n\n{wrapped}\n\nAnd after.", [family])
                add(f"Some words of prose come before it.\n{wrapped}\nint main() of the program", [family])
    header = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General "
              "Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your "
              "option) any later version.")
    add(header.format("", 3), ["gpl-3.0"])
    add(header.format("", 2), ["gpl-2.0"])
    add(header.format("Lesser ", 3), [])
    add(header.format("Affero ", 3), [])
    add("This work is licensed under the GNU Lesser General Public License, version 3.", [])
    add("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", [])
    add("This work is licensed under a Creative Commons\nAttribution 3.0 International License.", [])
    add("Licensed under CC BY-ND 4.0.", [])
    add("Licensed under the MIT License.\nLicensed under CC BY 4.0.", ["cc-by-4.0", "mit"])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licenses.licences(docs).collect()}
    assert {k: (rows[k][1], v) for k, v in got.items() if v != want[k]} == {}


def test_trees_are_trained_with_a_rare_class(spark):
    rows = [(k, f"https://site{k}.com/page{k}") for k in range(2000)] + [(5000, "https://a.net/es/x"), (6000, "https://b.org/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judge(pages, max_rows=20, trees=2)
    assert got.where("p_block is null").count() == 0 and got.where("verdict = 'block' and rule is not null").count() == 1
