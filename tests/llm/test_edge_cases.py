"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from widelines.llm import decontaminate, mixing, near_dup, quality, sharding
from widelines.llm import queries as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BENCH = "item_id string, text string"
ITEM = " ".join(f"bench{k}" for k in range(20))


def prose(start: int, n: int) -> str:
    return " ".join(f"word{start + k * 7}" for k in range(n))


ROWS = [
    (1, prose(0, 80), "en", "a", 1),
    (2, prose(0, 80), "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 0),
    (None, prose(5000, 70), None, "a", None),
    (None, None, None, None, None),
    (6, prose(9000, 70), "en", "c", 1),
    (6, prose(9000, 70), "en", "c", 1),
    (7, ("long " + prose(20000, 60000)), "en", "a", 1),
    (8, f"{prose(30000, 30)} {ITEM} {prose(31000, 30)}", "en", None, 1),
]
ITEMS = [("i1", ITEM), ("i2", None), ("i3", ""), (None, "nothing like this here"), ("i1", ITEM)]
PAGES = [(1, "https://www.example.com/en/x"), (2, None), (3, "no scheme"), (4, "http://EXAMPLE.com/en/"),
         (None, "ftp://a.net/es/?q=1#f"), (5, "http://b.org/" + "x" * 50000), (1, "https://www.example.com/en/x")]
LABELS = [(1, 1, 0), (2, None, None), (None, 0, 1), (6, 0, 1), (6, 0, 1)]


def folder(spark, root, docs=ROWS, items=ITEMS, pages=PAGES, labels=LABELS) -> str:
    for name, rows, schema in (("documents", docs, DOCS), ("benchmark", items, BENCH),
                               ("pages", [(*p, "") for p in pages], "page_id long, url string, html string"),
                               ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("edge"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


# Ranks and words are not a row per row: the tests of those two queries hold their edge rows.
@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - {"op11_ranked_search", "op13_spelling_variants"}))
def test_every_row_of_the_edge_table_gets_a_row(spark, edge, name):
    rows = q.QUERIES[name](spark, edge).collect()
    assert len(rows) == len(PAGES if name.startswith("op4_") else ROWS)


@pytest.mark.parametrize("name", q.QUERIES)
def test_empty_tables_give_empty_results(spark, empty, name):
    assert q.QUERIES[name](spark, empty).collect() == []


def test_quality_of_edge_rows(spark, edge):
    rows = {r["doc_id"]: r for r in q.op1_quality_rules(spark, edge).where("doc_id is not null").collect()}
    assert [rows[k]["n_words"] for k in (3, 4, 5)] == [0, 0, 0]
    assert all(rows[k]["base_failed"] and not rows[k]["kept"] for k in (3, 4, 5))
    assert rows[7]["n_words"] == 60001 and rows[1]["kept"]


def test_quality_order_changes_no_verdict(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    names = list(quality.RULES)
    one, two = (sorted(map(str, quality.assess(docs, order=o).drop("rejected_by").collect())) for o in (names, names[::-1]))
    assert one == two


def test_near_duplicates_of_edge_rows(spark, edge):
    rows = q.op7_minhash_near_dedup(spark, edge).collect()
    named = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert named[2]["component_id"] == 1 and not named[2]["kept"]
    assert named[3]["n_shingles"] == 0 and named[3]["kept"] and named[4]["component_id"] == 4
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)


def test_decontamination_finds_place_and_length(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet").where("doc_id = 8")
    row = decontaminate.find_matches(docs, spark.read.parquet(f"{edge}/benchmark.parquet")).first()
    assert [(m["item"], m["item_start"], m["start"], m["length"]) for m in row["_matches"]][0] == ("i1", 0, 30, 20)
    assert [(s["start"], s["end"]) for s in row["_spans"]] == [(30, 50)]


def test_decontamination_by_small_blocks_is_the_same(spark, edge):
    docs, items = (spark.read.parquet(f"{edge}/{t}.parquet") for t in ("documents", "benchmark"))
    whole, parts = (decontaminate.find_matches(docs, items, block_bytes=b).select(
        "doc_id", "_n_words", decontaminate.hit_words().alias("hit")) for b in (1 << 20, 100))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_url_rules(spark, edge):
    rows = {(r["page_id"], r["host"]): r for r in q.op4_url_filter(spark, edge).collect()}
    assert rows[1, "www.example.com"]["rule"] == "www.example.com/en/" and rows[1, "www.example.com"]["verdict"] == "allow"
    assert rows[4, "example.com"]["verdict"] == "block" and rows[None, "a.net"]["rule"] == "net/es/"
    assert rows[2, ""]["path"] == "" and rows[3, ""]["rule"] is None


def test_mixing_of_edge_rows(spark, edge):
    rows = q.op2_source_mixing(spark, edge).collect()
    assert all(r["taken"] <= 3 * r["size"] for r in rows) and sum(r["size"] == 0 for r in rows) == 4
    assert sorted(map(str, rows)) == sorted(map(str, q.op2_source_mixing(spark, edge).collect()))


def test_tokens_are_the_librarys(spark, edge):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ordered, start, want = sorted((r for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), 0, []
    for r in ordered:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in q.op10_token_output(spark, edge).orderBy("start").collect()]
    assert got == want


CLASHING = ("_n_words", "_spans", "_matches", "_words", "_id", "_size", "_source", "_times", "_time", "_gone", "size",
            "slot", "shard", "_slot", "_shard", "taken", "target", "rank", "component_id", "kept")


def test_stages_pass_columns_of_clashing_names(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet").select("*", *(F.lit(c).alias(c) for c in CLASHING))
    for step in (quality.keep_good, near_dup.keep_one, mixing.mixed_documents):
        out = step(docs)
        assert out.columns == docs.columns
        assert out.select(*CLASHING).distinct().collect() in ([], [tuple(CLASHING)])
    out = decontaminate.remove_contaminated(docs, spark.read.parquet(f"{edge}/benchmark.parquet"))
    assert out.columns == docs.columns and out.where("doc_id = 8").count() == 0 and out.count() == len(ROWS) - 1
    placed = sharding.placed(docs, sharding.document_key())
    assert len(placed.columns) == len(set(placed.columns)) and placed.count() == len(ROWS)


def test_pipeline_of_edge_rows(spark, edge, empty):
    rows = corpus_pipeline.run(spark, edge).collect()
    ids = {r["doc_id"] for r in rows}
    assert ids <= {1, 6, 7, None} and 8 not in ids and 2 not in ids
    assert corpus_pipeline.run(spark, empty).collect() == []
