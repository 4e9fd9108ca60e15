"""Operator 9, line dedup by a log-template tree, with DataFrame functions only.

Digit runs are masked first. Every line with a word is parsed to a leaf of fixed depth: the number of its tokens and
its first ``DEPTH`` tokens. A leaf has one template: at each place the token that more than half of the leaf's lines
hold there, or a variable field. Since this is a share and not a count, fields stay variable however large the data.
A line fits when at least ``literal_percent`` of its tokens are the template's. A template recurs when lines of
``min_docs`` documents fit; so does a whole (masked) line that ``min_docs`` documents hold, or two where it has
``long_tokens`` tokens or more. Lines that recur in either way are dropped.

Leaves with fewer lines than ``min_docs`` have no template. Tokens are counted per leaf and place map-side first, so a
leaf that holds a third of all lines is a few rows a task by then, and only leaves whose literal places suffice keep a
template. Lines travel as hashes; which leaves are worth a second look is known to the scans by hash buckets, a
broadcast of at most ``BUCKETS`` rows, so that texts move once, to lose their lines.

Defined results: null or empty text has no lines; lines without a word are kept and not counted; equal rows get equal
results and count as one document; null doc_ids are judged by their text; an empty table gives an empty result.
Exactly ``min_docs`` documents suffice; exactly half of a leaf's lines do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.llm.storage import stored

DEPTH = 3
MIN_DOCS = 10
LITERAL_PERCENT = 60
LONG_TOKENS = 50
BUCKETS = 1 << 20
#: Inside a line every blank is turned into a space, so that tokens are cut by a plain split.
_BLANKS = "\t\x0b\x0c\r"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, line_no, tokens, leaf) of the lines with a word. ``doc`` stands for the row's id and text."""
    masked = F.col("text")
    for blank in _BLANKS:
        masked = F.replace(masked, F.lit(blank), F.lit(" "))
    masked = F.regexp_replace(masked, "[0-9]+", "0")
    first = ", ".join(f"coalesce(try_element_at(tokens, {k}), '')" for k in range(1, DEPTH + 1))
    return (docs.select("doc", F.posexplode(F.split(masked, "\n")).alias("line_no", "line"))
            .withColumn("tokens", F.expr("array_remove(split(line, ' '), '')")).where(F.size("tokens") > 0)
            .select("doc", "line_no", "tokens", F.expr(f"xxhash64(size(tokens), {first})").alias("leaf")))


def _in(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """The lines of leaves whose hash bucket holds one of ``leaves``: all of theirs, and a few others."""
    bucket = F.pmod(F.col("leaf"), F.lit(BUCKETS)).cast("int")
    marked = leaves.select(bucket.alias("_bucket")).distinct()  # at most BUCKETS rows
    return lines.join(F.broadcast(marked), bucket == F.col("_bucket"), "left_semi")


def _at_places(tokens: str = "tokens") -> str:
    """A hash of each token and its place."""
    return f"transform({tokens}, (t, i) -> xxhash64(i, t))"


def templates(lines: DataFrame, leaves: DataFrame, min_docs: int = MIN_DOCS,
              literal_percent: int = LITERAL_PERCENT) -> DataFrame:
    """(leaf, literals: hashes of tokens at their places) of the leaves whose template a line can fit. ``leaves``: leaf,
    n (lines), n_tokens of those with enough lines."""
    counted = _in(lines, leaves).select("leaf", F.explode(F.expr(_at_places())).alias("at")).groupBy("leaf", "at").agg(
        F.count("*").alias("held")).where(F.col("held") * 2 > min_docs)
    major = counted.join(leaves, "leaf").where(F.col("held") * 2 > F.col("n"))
    return major.groupBy("leaf", "n_tokens").agg(F.collect_list("at").alias("literals")).where(
        F.size("literals") * 100 >= literal_percent * F.col("n_tokens")).select("leaf", "literals")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, literal_percent: int = LITERAL_PERCENT,
                  long_tokens: int = LONG_TOKENS) -> DataFrame:
    """(doc, line_no) of every line that recurs. ``docs``: doc, text; ``doc`` tells different rows apart."""
    lines = _lines(docs)
    forms = stored(lines.select("doc", "line_no", "leaf", F.size("tokens").alias("n_tokens"), F.xxhash64("tokens").alias("form"),
                                F.xxhash64(F.lit(1), "tokens").alias("form2")), "forms")
    leaves = stored(forms.groupBy("leaf").agg(F.count("*").alias("n"), F.first("n_tokens").alias("n_tokens"))
                    .where(F.col("n") >= min_docs), "leaves")
    known = stored(templates(lines, leaves, min_docs, literal_percent), "templates")
    fitting = stored(_in(lines, known).join(known, "leaf").where(
        F.size(F.array_intersect(F.expr(_at_places()), "literals")) * 100 >= literal_percent * F.size("tokens"))
        .select("doc", "line_no", "leaf"), "fitting")
    recurring = fitting.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).where(
        F.col("docs") >= min_docs).select("leaf")
    by_template = fitting.join(stored(recurring, "recurring"), "leaf", "left_semi").select("doc", "line_no")

    repeated = forms.select("form", "form2", "n_tokens", "doc").distinct().groupBy("form", "form2").agg(
        F.count("*").alias("docs"), F.first("n_tokens").alias("n_tokens")).where(
        (F.col("docs") >= min_docs) | ((F.col("n_tokens") >= long_tokens) & (F.col("docs") >= 2))).select("form", "form2")
    by_form = forms.join(stored(repeated, "repeated"), ["form", "form2"], "left_semi").select("doc", "line_no")
    return by_template.unionByName(by_form).distinct()


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                   literal_percent: int = LITERAL_PERCENT, long_tokens: int = LONG_TOKENS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (with a word), n_dropped, clean_text (null stays null)."""
    bare = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "doc", F.struct(*(F.xxhash64(F.lit(k), F.col("doc_id").isNull(), "doc_id", "text") for k in (1, 2))))
    gone = dropped_lines(bare.select("doc", "text"), min_docs, literal_percent, long_tokens).groupBy("doc").agg(
        F.collect_list("line_no").alias("gone"))
    joined = bare.join(gone, "doc", "left")
    n_lines = F.expr("coalesce(size(filter(split(text, '\\n'), x -> rlike(x, '[^\\\\x20\\\\x09-\\\\x0D]'))), 0)")
    kept = "transform(array_except(sequence(0, size(lines) - 1), gone), i -> element_at(lines, i + 1))"  # in linear time
    joined = joined.withColumn("lines", F.split("text", "\n"))
    return joined.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.expr(kept), "\n")).alias("clean_text"))
