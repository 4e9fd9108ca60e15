"""Registered queries of the training-data operators, and their SQL where SQL can express them.

Every query takes (spark, sf_dir), reads its whole tables and returns one row per row of the table it judges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widelines.llm import (decontaminate, licenses, line_templates, mixing, near_dup, quality, repeats, search,
                           sharding, spelling, token_output, toxicity, url_filter)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).drop("rejected_by")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_packed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), "n_confirmed", "n_unconfirmed")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.placed(docs, sharding.document_key()).select("doc_id", "slot", "shard")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.filter(F.transform("_matches", lambda m: m["item"]), F.isnotnull)))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), decontaminate.hit_words().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped",
                        F.coalesce(F.length("clean_text"), F.lit(0)).cast("long").alias("clean_chars"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_output.write_blocks(table(spark, sf_dir, "documents"))
    return token_output.read_documents(blocks, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_maglev_sharding": op5_maglev_sharding,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_line_templates": op9_line_templates,
    "op10_token_output": op10_token_output,
    "op11_ranked_search": op11_ranked_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORDS = r"[^\x20\x09-\x0D]+"
_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS l
  FROM documents),
p AS (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d),
s AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM p),
n AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM s WHERE c > 1) GROUP BY r),
m AS (
  SELECT d.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits
  FROM d LEFT JOIN n ON n.r = d.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
            OR 10 * upper > 6 * greatest(letters, 1) OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 10 * n_dup_lines > 4 * greatest(n_lines, 1) OR 2 * digits > word_chars) AS kept
FROM m""",
    "op7_minhash_near_dedup": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3
    THEN list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM d),
z AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM sh GROUP BY doc_id),
c AS (SELECT h, min(doc_id) AS rep, any_value(n) AS n FROM z GROUP BY h),
f AS (SELECT s, count(*) AS df FROM sh WHERE doc_id IN (SELECT rep FROM c) GROUP BY s),
o AS (SELECT sh.doc_id AS rep, sh.s, c.n, row_number() OVER (PARTITION BY sh.doc_id ORDER BY f.df, sh.s) AS k
      FROM sh JOIN c ON c.rep = sh.doc_id JOIN f ON f.s = sh.s),
pre AS (SELECT * FROM o WHERE k <= n - ceil(0.85 * n) + 1),
cand AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM pre a JOIN pre b ON a.s = b.s AND a.rep < b.rep
         AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
link AS (SELECT a, b FROM (
    SELECT cand.a, cand.b, x.n + y.n AS t, count(*) AS i FROM cand
    JOIN o x ON x.rep = cand.a JOIN o y ON y.rep = cand.b AND y.s = x.s GROUP BY cand.a, cand.b, x.n, y.n)
  WHERE 100 * i >= 85 * (t - i)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
comp AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(comp.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(comp.component, d.doc_id) AS kept
FROM d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN c ON c.h = z.h LEFT JOIN comp ON comp.rep = c.rep""",
    "op5_maglev_sharding": f"""
WITH k AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(text), '')), 1, 15))::BIGINT
         % {sharding.SLOTS} AS slot FROM documents),
t AS (SELECT [{", ".join(map(str, sharding.lookup_table()))}] AS shards)
SELECT doc_id, slot, 'shard-' || lpad(CAST(t.shards[slot + 1] AS VARCHAR), 2, '0') AS shard FROM k, t""",
    "op6_benchmark_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens)),
hit AS (SELECT r, pos.n, i, item FROM pos JOIN win ON win.s = pos.s AND win.n = pos.n),
words AS (SELECT r, count(DISTINCT k) AS n_hit
          FROM (SELECT DISTINCT r, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op12_substring_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
p AS (SELECT r, doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
      FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)),
later AS (SELECT r, i FROM (SELECT r, i, rank() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST, i) AS k FROM p) WHERE k > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 19)) AS k FROM later),
word AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS k FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept
         FROM word ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    "op11_ranked_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d),
q AS (SELECT q, item_id, term, count(*) AS c
      FROM (SELECT q, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark))
      GROUP BY ALL),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, s GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(t) * n_docs) // n_terms AS m FROM d, s WHERE len(t) > 0),
x AS (SELECT q, item_id, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
WHERE rank <= 20""",
    "op13_spelling_variants": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
b AS (
  SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c) - 64] END)) AS bytes
  FROM (SELECT id, run, count(*) AS n FROM run GROUP BY ALL)),
h AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
           lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) AS h FROM b, crc),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
             n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS s
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
cut AS (SELECT DISTINCT less.word AS a, less.n AS a_n, v.word AS b, v.n AS b_n FROM less JOIN v ON v.word = less.s),
near AS (
  SELECT a AS word, b AS near, b_n AS near_n FROM cut UNION ALL SELECT b, a, a_n FROM cut
  UNION ALL SELECT x.word, y.word, y.n FROM less x JOIN less y ON x.i = y.i AND x.s = y.s AND x.word <> y.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS best_n, arg_min(near, (-near_n, near)) AS best FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form,
             CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.at
          WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word JOIN f AS last ON last.word = chain.at AND last.form IS NULL""",
    "op9_line_templates": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(text) AS doc,
         string_split(regexp_replace(text, '[0-9]+', '0', 'g'), chr(10)) AS p
  FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, doc, i, regexp_extract_all(line, '{_WORDS}') AS t
      FROM (SELECT r, doc, unnest(generate_series(1, len(p))) AS i, unnest(p) AS line FROM d)),
f AS (SELECT *, len(t) AS n, array_to_string(t, ' ') AS form,
             concat_ws(chr(10), len(t), t[1], coalesce(t[2], ''), coalesce(t[3], '')) AS leaf FROM l WHERE len(t) > 0),
leaves AS (SELECT leaf, count(*) AS lines FROM f GROUP BY leaf HAVING count(*) >= {line_templates.MIN_DOCS}),
tok AS (SELECT r, i, leaf, unnest(generate_series(1, n)) AS pos, unnest(t) AS token FROM f WHERE leaf IN (SELECT leaf FROM leaves)),
major AS (SELECT leaf, pos, token FROM tok JOIN leaves USING (leaf) GROUP BY leaf, pos, token, lines HAVING count(*) * 2 > lines),
fit AS (SELECT r, i, leaf FROM f JOIN (SELECT r, i, count(*) AS same FROM tok JOIN major USING (leaf, pos, token) GROUP BY r, i)
        USING (r, i) WHERE same * 100 >= {line_templates.LITERAL_PERCENT} * n),
recur AS (SELECT leaf FROM fit JOIN d USING (r) GROUP BY leaf HAVING count(DISTINCT doc) >= {line_templates.MIN_DOCS}),
same AS (SELECT form FROM f GROUP BY form, n HAVING count(DISTINCT doc) >= {line_templates.MIN_DOCS}
         OR n >= {line_templates.LONG_TOKENS} AND count(DISTINCT doc) >= 2),
gone AS (SELECT r, count(*) AS n, list(i) AS places FROM (
           SELECT r, i FROM fit WHERE leaf IN (SELECT leaf FROM recur)
           UNION SELECT r, i FROM f WHERE form IN (SELECT form FROM same)) GROUP BY r),
x AS (SELECT doc_id, text, n, places FROM d LEFT JOIN gone USING (r)
      UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE text IS NULL)
SELECT doc_id,
       len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda z: regexp_matches(z, '{_WORDS}'))) AS n_lines,
       coalesce(n, 0) AS n_dropped,
       CASE WHEN n IS NULL THEN length(coalesce(text, '')) ELSE length(array_to_string(list_filter(
         string_split(text, chr(10)), lambda z, k: NOT list_contains(places, k)), chr(10))) END AS clean_chars
FROM x""",
}
