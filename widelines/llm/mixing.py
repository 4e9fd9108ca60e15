"""Operator 2, mixing sources to target weights, with DataFrame functions only.

Sizes are words. Each source's texts are laid end to end in a pseudorandom order and cut into blocks of ``block``
words (the last one shorter). Sources share the total by weight, none above ``most`` times its size. A source's slots
number its takes of blocks: whole passes, then a part of one more, cut so that the words come to the target within a
block. Slot j of a pass is mapped through that pass's pseudorandom permutation of the source's blocks, and slots and
the blocks that documents lie in are joined by (source, block). All slots together are permuted once more and dealt
to output shards of ``per_shard`` slots: each shard's source counts are a multinomial draw conditioned on the targets
(so that targets are met and not only expected). The draw is stored in the shared folder, and so are the packed
blocks: for each shard and place the words of its block, text by text, joined to the draw by (source, block). What is
taken of a text is counted in the packed blocks.

Permutations are swap-or-not networks on [0, n), computed per row: nothing is sorted, reruns agree.

Defined results: null or empty text has size 0, is never taken; a null source is a source of its own, ranked last;
null or repeated doc_ids are rows like any other; a table without words has targets of 0; an empty table gives an
empty result. One row per source and one number per (source, chunk) are gathered, never a source's documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from widelines.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the blanks after it, so that a packed text keeps its lines.
SPACED_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
WEIGHTS = (5, 2, 1)
BLOCK = 64
PER_SHARD = 4096
MOST = 3
#: Documents of a chunk: a source's running sum is taken within chunks, then over the chunks' totals.
CHUNK_ROWS = 4_000
PRIME = 2**31 - 1
ROUNDS = 8
#: A shard's slots come from 2 ** DEAL_ROUNDS places: far more than it has, or its source counts spread too much.
DEAL_ROUNDS = 24


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def permuted(x: str, n: str, seed: str) -> Column:
    """Image of ``x`` in a pseudorandom permutation of [0, n): swap-or-not. Arguments are SQL of bigints."""
    return F.expr(_swap_or_not(x, n, seed))


def permuted_from(x: str, n: str, seed: str) -> str:
    """SQL of the number whose image ``permuted`` makes ``x``: each round undoes itself, so they are taken in reverse."""
    return _swap_or_not(x, n, seed, back=True)


def _swap_or_not(x: str, n: str, seed: str, back: bool = False) -> str:
    rounds = f"sequence({ROUNDS - 1}L, 0L, -1L)" if back else f"sequence(0L, {ROUNDS - 1}L)"
    key = f"((({seed}) * 7919 + r * 1299709 + 12345) % {PRIME} * 48271 % {PRIME} * 69621 % {PRIME})"
    turn = f"(({key} * {PRIME} + {key} * 16807 % {PRIME}) % ({n}))"
    other = f"(({turn} + ({n}) - x) % ({n}))"
    coin = f"((greatest(x, {other}) % {PRIME} * 48271 + {key}) % {PRIME} * 69621 % {PRIME} div 1024 % 2)"
    return f"aggregate({rounds}, {x}, (x, r) -> if({coin} = 1, {other}, x))"


def dealt(x: str, n: str) -> Column:
    """As ``permuted``, with turns and coins by hash and enough rounds that neighbours are dealt independently."""
    turn = f"pmod(xxhash64(r, 20240229L), {n})"
    other = f"pmod({turn} - x, {n})"
    coin = f"pmod(xxhash64(greatest(x, {other}), r), 2L)"
    return F.expr(f"aggregate(sequence(0L, {DEAL_ROUNDS - 1}L), {x}, (x, r) -> if({coin} = 1, {other}, x))")


def shares(sizes: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (no_source, source_key, source_size) with rank, weight and target: the total shared by weight, filled
    up to a common level per weight at which no source is above ``most`` times its size."""
    by_name, everything = Window.orderBy("no_source", "source_key"), Window.partitionBy()
    by_level = Window.orderBy("level", "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    return (sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("long"))
            .withColumn("weight", weight.cast("long")).withColumn("total", F.sum("source_size").over(everything))
            .withColumn("level", F.lit(most) * F.col("source_size") / F.col("weight"))
            .withColumn("below", F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(
                by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("capped", F.col("below") + F.col("level") * F.col("left") <= F.col("total"))
            .withColumn("given", F.sum(F.when(F.col("capped"), F.lit(most) * F.col("source_size")).otherwise(0)).over(everything))
            .withColumn("open", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
            .withColumn("target", F.when(F.col("capped"), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(
                F.col("weight") * (F.col("total") - F.col("given")) / F.col("open")))
            .select("no_source", "source_key", "source_size", "rank", "weight", "target"))


def with_slots(sources: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """Adds blocks, whole passes, words of the last pass (``rest``), slots, and the number of the source's first slot."""
    words = F.least(F.floor(F.col("target") + 0.5), F.lit(most) * F.col("source_size"))
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return (sources.where("source_size > 0").withColumn("words", words.cast("long"))
            .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
            .withColumn("passes", F.expr("words div source_size")).withColumn("rest", F.expr("words % source_size"))
            .withColumn("slots", F.expr(f"passes * blocks + (rest + {block - 1}) div {block}"))
            .withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0).cast("long")))
            .withColumn("all_slots", F.sum("slots").over(Window.partitionBy())))


def slots(sources: DataFrame, block: int = BLOCK, per_shard: int = PER_SHARD, batch: int = 8192) -> DataFrame:
    """One row per take: rank, slot, pass, block_no, words (taken of the block), shard, place."""
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A number of partitions keeps AQE from merging these few rows, which grow to many slots, into one task.
    rows = (sources.withColumn("part", F.explode(F.expr(f"sequence(0L, slots div {batch})")))
            .repartition(tasks, "rank", "part")
            .withColumn("slot", F.explode(F.expr(
                f"if(slots > part * {batch}, sequence(part * {batch}, least(slots, (part + 1) * {batch}) - 1), "
                "cast(array() as array<bigint>))")))
            .withColumn("pass", F.expr("slot div blocks")).withColumn("at", F.expr("slot % blocks"))
            .withColumn("block_no", permuted("at", "blocks", "rank * 4 + pass"))
            .withColumn("words", F.expr(f"if(pass < passes, {block}L, least({block}L, rest - at * {block}))"))
            .withColumn("position", dealt("first_slot + slot", "all_slots")))
    return rows.select("rank", "slot", "pass", "block_no", "words",
                       F.expr(f"position div {per_shard}").alias("shard"),
                       F.expr(f"position % {per_shard}").alias("place"))


def laid_out(docs: DataFrame, id_col: str, rows: int, chunk_rows: int = CHUNK_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """``docs`` (with ``size``, ``text_hash``, ``no_source``, ``source_key``) with ``start``: words of its source before it.
    ``sizes``: the same rows without their texts, from which the chunks' totals are taken."""
    n = max(1, math.ceil(rows / chunk_rows))
    key = F.expr(f"pmod(coalesce({id_col}, size), {PRIME}) * 48271 % {PRIME}")
    docs, sizes = (d.withColumn("order_key", key).withColumn("chunk", F.expr(f"order_key * {n} div {PRIME}"))
                   for d in (docs, docs if sizes is None else sizes))
    own = ["no_source", "source_key", "chunk"]
    before = Window.partitionBy(*own).orderBy("order_key", id_col, "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sizes.groupBy(*own).agg(F.sum("size").alias("chunk_size")).withColumn(
        "chunk_start", F.coalesce(F.sum("chunk_size").over(Window.partitionBy("no_source", "source_key").orderBy(
            "chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    return (docs.withColumn("within", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")))
            .join(chunks.drop("chunk_size"), own).withColumn("start", F.col("chunk_start") + F.col("within")))


def _sized(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), word_count(text).alias("size"), F.xxhash64(text).alias("text_hash"),
        F.col(source).alias("source"), F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source), F.lit("")).alias("source_key"), F.col(text).alias("text"))


def _drawn(sized: DataFrame, block: int, most: int, weights: tuple[int, ...], per_shard: int) -> tuple[DataFrame, DataFrame]:
    """Sources with their targets, and the stored draw: shard, place, rank, block_no, words (taken of the block)."""
    sources = stored(shares(sized.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size")), most, weights), "sources")
    draw = slots(with_slots(sources, block, most), block, per_shard).select("shard", "place", "rank", "block_no", "words")
    return sources, stored(draw, "draw")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
        most: int = MOST, weights: tuple[int, ...] = WEIGHTS, per_shard: int = PER_SHARD) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source, source_size, target (of its source), taken (words, repeats counted),
    by the draw alone. ``id_col`` must be an integer column."""
    names = ["no_source", "source_key"]
    sized = stored(_sized(docs, id_col, text, source).drop("text"), "sized")
    sources, draw = _drawn(sized, block, most, weights, per_shard)
    takes = draw.groupBy("rank", "block_no").agg(
        F.sum(F.expr(f"int(words = {block})")).alias("whole"), F.sum(F.expr(f"if(words < {block}, words, 0L)")).alias("part"))
    placed = stored(laid_out(sized, "doc_id", sized.count()).join(sources, names), "placed")
    pieces = (placed.where("size > 0").select(
        "rank", "start", "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block_no"))
        .join(takes, ["rank", "block_no"]))
    low = f"greatest(start, block_no * {block})"
    taken = (f"whole * (least(start + size, (block_no + 1) * {block}) - {low}) + "
             f"greatest(0L, least(start + size, block_no * {block} + part) - {low})")
    return _with_taken(placed, pieces.groupBy("rank", "start").agg(F.sum(F.expr(taken)).alias("taken")))


def _with_taken(placed: DataFrame, summed: DataFrame) -> DataFrame:
    """Texts with words are told apart by rank and start."""
    summed = summed.withColumn("has_words", F.lit(True))
    return placed.withColumn("has_words", F.col("size") > 0).join(summed, ["rank", "start", "has_words"], "left").select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def drawn_pieces(laid: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rank, start, block_no, at, n, words) of the parts of ``laid`` texts that lie in blocks which a slot takes: all
    where the source has a whole pass, else those that are the images of the last pass's first numbers. ``laid``: text,
    size, start, and rank, blocks, passes, rest of the source."""
    at = permuted_from("b", "blocks", "rank * 4 + passes")
    laid = laid.withColumn("drawn", F.expr(
        f"filter(sequence(start div {block}, (start + size - 1) div {block}), b -> passes > 0 or {at} * {block} < rest)"))
    first, last = f"greatest(b * {block}, start)", f"least((b + 1) * {block}, start + size)"
    # The words are an argument of the outer function, so that a text is cut once and not once per block.
    cut = F.expr(
        f"transform(array(regexp_extract_all(if(size(drawn) > 0, text, ''), '{SPACED_WORD}', 0)), w -> transform("
        f"drawn, b -> named_struct('block_no', b, "
        f"'at', {first} - b * {block}, 'n', {last} - {first}, "
        f"'words', array_join(slice(w, int({first} - start + 1), int({last} - {first})), ''))))[0]".replace("\\", "\\\\"))
    return laid.select("rank", "start", F.explode(cut).alias("piece")).select("rank", "start", "piece.*")


def write_packed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
                 most: int = MOST, weights: tuple[int, ...] = WEIGHTS,
                 per_shard: int = PER_SHARD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as stored tables: texts (doc_id, size, source, source_size, target, rank, start), the draw, and the packed
    blocks (shard, place, rank, block_no, pieces: start of the text, n words, words), one row per slot of the draw."""
    names = ["no_source", "source_key"]
    whole = _sized(docs, id_col, text, source)
    sized = stored(whole.drop("text"), "sized")
    sources, draw = _drawn(sized, block, most, weights, per_shard)
    rows = sized.count()
    placed = stored(laid_out(sized, "doc_id", rows).join(sources, names), "placed")
    drawn_of = with_slots(sources, block, most).select(*names, "rank", "blocks", "passes", "rest")
    laid = laid_out(whole.where("size > 0"), "doc_id", rows, sizes=sized).join(F.broadcast(drawn_of), names)
    pieces = drawn_pieces(laid, block)
    taken = pieces.join(draw.withColumnRenamed("words", "limit"), ["rank", "block_no"]).where("at < limit")
    short = f"array_join(slice(regexp_extract_all(words, '{SPACED_WORD}', 0), 1, int(limit - at)), '')".replace("\\", "\\\\")
    taken = taken.withColumn("words", F.expr(f"if(at + n > limit, {short}, words)")).withColumn("n", F.expr("least(n, limit - at)"))
    packed = taken.groupBy("rank", "block_no", "shard", "place").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "words"))).alias("pieces"))
    return placed, draw, stored(packed.select("shard", "place", "rank", "block_no", "pieces"), "packed")


def mix_packed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """As ``mix``, with the words taken counted in the packed blocks, which are written to the shared folder."""
    placed, _, packed = write_packed(docs, id_col, text, source)
    taken = packed.select("rank", F.explode(F.arrays_zip("pieces.start", "pieces.n")).alias("piece")).groupBy(
        "rank", F.col("piece.start").alias("start")).agg(F.sum("piece.n").alias("taken"))
    return _with_taken(placed, taken)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as the mix takes its words, 0 to ``MOST`` times. A broken
    number of times is rounded up or down by a hash of the id, so that a source's words stay near its target."""
    names = docs.columns
    id_col, text, source = (f"c{names.index(c)}" for c in (id_col, text, source))
    docs = docs.toDF(*(f"c{k}" for k in range(len(names))))  # so that no column's name clashes with the ones added
    taken = mix(docs, id_col, text, source).groupBy("doc_id", "size", "source").agg(
        F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    times = F.expr(f"floor(taken / rows / size + (pmod(xxhash64(doc_id, size), {PRIME}) / {PRIME}D))")
    copies = taken.where("size > 0").select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("source").alias("_source"),
        F.least(times, F.lit(MOST)).cast("int").alias("_times")).where("_times > 0")
    return (docs.withColumn("_words", word_count(text)).join(copies, F.col(id_col).cast("long").eqNullSafe(F.col("_id"))
            & (F.col("_words") == F.col("_size")) & F.col(source).eqNullSafe(F.col("_source")))
            .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns).toDF(*names))
