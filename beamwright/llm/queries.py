"""The registered corpus queries and their check SQL; each reads its whole tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright.llm import align, bpe, decontam, jaccard, lines, mixing, periodic, quality, spotsigs, tokencount, toxicity, vptree, warc
from beamwright.llm.common import table, written
from beamwright.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ENGLISH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


@query("op5_byte_bpe")
def op5(spark, folder):
    return bpe.digests(table(spark, folder, "documents"), MULTI, public_tokenizers.PATTERN)


WARC_SQL = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT *, octet_length(body) AS n, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_page, chr(13) || chr(10) AS nl FROM p),
b AS (SELECT *, array_to_string(list_transform([0, 1, 2, 3], lambda i: array_to_string(list_transform([35, 30, 25, 20, 15, 10, 5, 0],
    lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || substr(hex, 1 + 10 * i::INT, 10))::BIGINT >> s::BIGINT) & 31) + 1)::INT]), '')), '') AS digest,
    replace('HTTP/1.1 200 OK|Content-Type: text/html; charset=utf-8|Content-Length: ' || n || '||', '|', nl) AS head, page_id = first_page AS own FROM d),
h AS (SELECT *, replace('WARC/1.1|WARC-Type: ' || CASE WHEN own THEN 'response' ELSE 'revisit' END || '|WARC-Record-ID: <urn:page:' || page_id
    || '>|WARC-Date: 1970-01-01T00:00:00Z|', '|', nl) || coalesce('WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A') || nl, '')
    || CASE WHEN own THEN '' ELSE 'WARC-Refers-To: <urn:page:' || first_page || '>' || nl || 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl END
    || replace('WARC-Payload-Digest: sha1:' || digest || '|Content-Type: application/http; msgtype=response|Content-Length: '
    || (octet_length(encode(head)) + CASE WHEN own THEN n ELSE 0 END) || '||', '|', nl) || head AS header FROM b)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN NOT own THEN first_page END AS refers_to,
    sha256(encode(header) || CASE WHEN own THEN body ELSE ''::BLOB END || encode(nl || nl)) AS record_sha256
FROM h
"""


@query("op1_warc_archive", WARC_SQL)
def op1(spark, folder):
    archive = scratch_dir(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.describe(warc.read_archive(spark, archive))


NEAREST_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL),
ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        sqrt(list_reduce(list_prepend(0::DOUBLE, list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda a, b: a + b)) AS score
      FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS n FROM d)
SELECT query_id, n::INT AS rank, vec_id, score FROM r WHERE n <= 10
"""


@query("op10_vp_search", NEAREST_SQL)
def op10(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return vptree.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10, factor=1.0)


LINES_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


@query("op8_line_dedup", LINES_SQL)
def op8(spark, folder):
    rows = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w),
e AS (SELECT r, len(shingles) AS size, unnest(shingles) AS shingle FROM s),
p AS (SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.r < b.r GROUP BY a.r, b.r, a.size, b.size
    HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))),
link AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT r, r AS other FROM s UNION SELECT reach.r, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT s.doc_id, len(s.shingles) AS n_shingles, c.component_id FROM s
JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN s o ON reach.other = o.r GROUP BY reach.r) c ON c.r = s.r
"""


@query("op9_ngram_jaccard", JACCARD_SQL)
def op9(spark, folder):
    return jaccard.components(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_source_mix")
def op3(spark, folder):
    rows = mixing.dealt(mixing.plan(table(spark, folder, "documents").select("doc_id", "source", "text")))
    words = F.aggregate("units", F.lit(0).cast("long"), lambda total, unit: total + unit["words"])
    return rows.select("doc_id", "size", "source_size", "target", words.alias("taken"), F.col("units.shard").alias("shards"))


@query("op6_toxicity")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels"), "toxic"), threshold=0.3)


@query("op7_quality_votes")
def op7(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, folder, "labels"), "quality"), threshold=0.7)
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


@query("op4_spot_signatures")
def op4(spark, folder):
    return spotsigs.chained(table(spark, folder, "documents").select("doc_id", "text"))


@query("op2_token_counts")
def op2(spark, folder):
    """Three edits a document, by its length: a passage put in at the middle, a tenth cut out from the first quarter on, and a
    word written over the third character from the end. The trees are written first; the edits are applied to the written table."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    change = lambda start, length, text: F.struct(
        start.cast("int").alias("start"), (start + length).cast("int").alias("end"), F.lit(text).alias("replacement"))
    edits = F.array(change(F.floor(n / 2), F.lit(0), " an added\n\n passage of 12 words"), change(F.floor(n / 4), F.floor(n / 10), ""), change(n - 3, F.lit(1), "X's "))
    store = written(tokencount.stored(docs.withColumn("edits", edits), ENGLISH, public_tokenizers.PATTERN), "segments")
    rows = tokencount.apply_edits(store, F.col("doc.edits"), ENGLISH, public_tokenizers.PATTERN)
    return rows.select(
        "doc.doc_id", F.col("n_tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_chars_reencoded",
        F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"))


@query("op11_token_alignment")
def op11(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


DECONTAM_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
s AS (SELECT item_id, words, least(10, len(words)) AS l, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, l, array_to_string(words[i:i + l - 1], ' ') AS w FROM s),
p AS (SELECT r, words, l, unnest(range(1, len(words) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(words) >= l),
hit AS (SELECT r, i, p.l, item_id FROM p JOIN bw ON p.l = bw.l AND array_to_string(words[i:i + p.l - 1], ' ') = bw.w),
n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS place FROM hit) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""


@query("op12_benchmark_windows", DECONTAM_SQL)
def op12(spark, folder):
    rows = decontam.marked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


@query("op13_periodic_runs")
def op13(spark, folder):
    """Documents whose id has a checksum divisible by 10 repeat a passage of theirs up to their end."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    docs = docs.withColumn("a", F.expr("case when size(w) > 0 then h div 10 % size(w) end"))
    docs = docs.withColumn("p", F.expr("1 + (size(w) - a) div (3 + h div 10 % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    docs = docs.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(repeated).alias("text"))
    rows = periodic.periodic_runs(docs).withColumn("best", periodic.strongest(F.col("runs")))
    return rows.select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(periodic.listing(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
