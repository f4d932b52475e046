"""The opN queries: thin callables (spark, sf_dir) -> DataFrame over whole tables, and their DuckDB texts."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm import decontam, langid, linededup, merkle, minhash, mixing, pieces, pii, resample, tokencounts, urlrules, vectors, warc
from monsoon.llm.common import Scratch, source


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that leak a benchmark item, with the items."""
    found = decontam.leaks(spark, source(spark, sf_dir, "documents"), source(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "matched", "total", "share")


#: Segments and chunks of the archives that op2 writes: most pages take several of both.
SEGMENT, CHUNK = 4096, 1024


def op2_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives of small segments and read back; a row for each page, null html as an empty payload."""
    path = Scratch(spark, "op2").path("archives")
    pages = source(spark, sf_dir, "pages")
    warc.write(spark, pages, path, segment=SEGMENT, chunk=CHUNK)
    kind = pages.schema["page_id"].dataType
    return warc.read(spark, path, payloads=False).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "valid", "segments"
    )


RULES = [
    urlrules.Rule.domain("net", "/", "block"),
    urlrules.Rule.domain("example.net", "/en/", "allow"),
    urlrules.Rule.domain("example.com", "/de/", "block"),
    urlrules.Rule.domain("org", "/fr/", "allow"),
]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; without a rule the verdict is allow, also for null URLs."""
    found = urlrules.judge(spark, source(spark, sf_dir, "pages"), RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of every document's base spans, and all its spans; null and empty texts have none."""
    found = pii.find(spark, source(spark, sf_dir, "documents"))

    def text(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces; null texts have null results.

    The public model is of the BPE kind: its ids are the best segmentation under Zipf's law of its merge ranks, not the order
    of its merges, so they serve counts and round trips but no model trained with that file.  Unigram files give their own ids.
    """
    return pieces.encode(spark, source(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later occurrences of three-line windows; null texts stay null, repeated rows count as one."""
    return linededup.dedup_lines(spark, source(spark, sf_dir, "documents")).select("doc.doc_id", "text", "n_lines", "n_removed")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; null texts and those without a letter are und."""
    docs = source(spark, sf_dir, "documents")
    model, threshold = langid.train(spark, docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(spark, docs, model, threshold)
    return found.select(F.col("id").alias("doc_id"), langid.held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and shingle count of every document; null and empty texts link with nothing."""
    conf = minhash.MinHash(k=3, share_num=85, share_den=100)
    return minhash.near_duplicates(spark, source(spark, sf_dir, "documents"), conf).withColumnRenamed("id", "doc_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each encoded length, null texts counting as empty ones."""
    return tokencounts.histogram(spark, source(spark, sf_dir, "documents"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector; those that are null, zero or not finite link with nothing."""
    return vectors.near_vectors(spark, source(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, weight, score and rank among the drawn of every document, towards the texts of the benchmark."""
    found = resample.importance(spark, source(spark, sf_dir, "documents"), source(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; of each fifth id's, a text in lower case is put to the proof."""
    docs = source(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("group"), merkle.leaf([F.col(c) for c in fields]).alias("leaf"),
        F.when(tampered, merkle.leaf([lower if c == "text" else F.col(c) for c in fields])).alias("claimed"),
    )
    return merkle.manifest(spark, leaves).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; labelled documents weigh 2 (good) or 1/2 (bad), others 1."""
    labels = source(spark, sf_dir, "labels").where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.pow(F.lit(2.0), 2 * F.avg("quality") - 1).alias("quality"))
    found = mixing.mix(spark, source(spark, sf_dir, "documents"), ratings=labels)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


_ALL = (
    op1_benchmark_decontamination, op2_warc_segments, op3_url_rules, op4_personal_data, op5_sentencepiece, op6_line_dedup, op7_language_id,
    op8_minhash_near_dedup, op9_token_counts, op10_embedding_near_dedup, op11_importance_resampling, op12_merkle_manifest,
    op13_source_mixing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


_UNITS = ", ".join(f"'{u}'" for u in decontam.UNITS.split())
#: Tokens by gaps and islands, windows as joined lists, and one value of the document for each value of the item along
#: every alignment.
_OP1 = rf"""
WITH raw AS (
  SELECT DISTINCT 'd' AS side, doc_id AS id, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL),
cut AS (SELECT side, id, regexp_extract_all(text, '[\p{{L}}\p{{M}}]+|\p{{N}}+(?:[.,:]\p{{N}}+)*|[^\p{{L}}\p{{M}}\p{{N}}]+') AS x FROM raw),
part AS (SELECT side, id, unnest(x) AS x, generate_subscripts(x, 1) AS p FROM cut),
kind AS (SELECT *, CASE WHEN regexp_full_match(x, '\p{{Lu}}\p{{Ll}}+') THEN 'name' WHEN regexp_matches(x, '^\p{{N}}') THEN 'number' WHEN regexp_matches(x, '^[\p{{L}}\p{{M}}]') THEN 'word' ELSE 'gap' END AS kind FROM part),
run AS (SELECT *, kind = 'name' AND coalesce(lag(x) OVER k = ' ' AND lag(kind, 2) OVER k = 'name', false) AS more FROM kind WINDOW k AS (PARTITION BY side, id ORDER BY p)),
nth AS (SELECT *, sum(CASE WHEN more THEN 0 ELSE 1 END) OVER (PARTITION BY side, id ORDER BY p) AS pos FROM run WHERE kind <> 'gap'),
tok AS (SELECT side, id, pos, min(kind) AS kind, lower(string_agg(x, ' ' ORDER BY p)) AS v, min(x) AS x FROM nth GROUP BY ALL),
tpl AS (SELECT side, id, pos, v, CASE WHEN kind = 'word' AND x IN ({_UNITS}) AND lag(kind) OVER (PARTITION BY side, id ORDER BY pos) = 'number' THEN '<unit>' WHEN kind = 'word' THEN v ELSE '<' || kind || '>' END AS w FROM tok),
t AS (SELECT side, id, list(w ORDER BY pos) AS w, list(v ORDER BY pos) AS v FROM tpl GROUP BY ALL),
size AS (SELECT id AS item, least(len(w), 8) AS s FROM t WHERE side = 'b'),
span AS (
  SELECT side, id, s, p, w, v FROM t JOIN size ON side = 'b' AND id = item, unnest(range(1, len(w) - s + 2)) r(p)
  UNION ALL SELECT side, id, z.s, p, w, v FROM t, (SELECT DISTINCT s FROM size) z, unnest(range(1, len(w) - z.s + 2)) r(p) WHERE side = 'd'),
win AS (SELECT side, id, s, p, w[p:p + s - 1] AS ws, v[p:p + s - 1] AS vs FROM span),
keyed AS (SELECT side, id, s, p, ws, vs, len(list_filter(ws, lambda x: x NOT IN ('<name>', '<number>', '<unit>'))) < least(4, s) AS poor FROM win),
hash AS (SELECT *, array_to_string(CASE WHEN poor THEN vs ELSE ws END, chr(31)) AS k FROM keyed),
total AS (SELECT id AS item, count(*) FILTER (NOT poor) AS rich, count(*) AS total FROM hash WHERE side = 'b' GROUP BY 1),
hit AS (SELECT d.id AS doc, b.id AS item, d.p - b.p AS shift, b.p AS ipos, b.s, b.poor, b.ws, b.vs AS iv, d.vs AS dv FROM hash d JOIN hash b USING (s, poor, k) WHERE d.side = 'd' AND b.side = 'b'),
slot AS (SELECT doc, item, shift, ipos, iv[i] AS iv, dv[i] AS dv FROM hit, unnest(range(1, s + 1)) r(i) WHERE ws[i] IN ('<name>', '<number>', '<unit>')),
split AS (SELECT doc, item, shift, iv FROM slot GROUP BY ALL HAVING count(DISTINCT dv) > 1),
broken AS (SELECT DISTINCT doc, item, shift, ipos FROM slot SEMI JOIN split USING (doc, item, shift, iv)),
good AS (SELECT DISTINCT doc, item, ipos, poor FROM hit ANTI JOIN broken USING (doc, item, shift, ipos)),
n AS (SELECT doc, item, count(*) FILTER (NOT poor) AS r, count(*) AS n FROM good GROUP BY ALL),
m AS (SELECT doc, item, n, total, r, rich, rich > 0 AND r >= 0.5 * rich AS enough FROM n JOIN total USING (item))
SELECT doc AS doc_id, item AS item_id, CASE WHEN enough THEN r ELSE n END AS matched, CASE WHEN enough THEN rich ELSE total END AS total,
  CASE WHEN enough THEN r / rich ELSE n / total END AS share
FROM m WHERE enough OR n >= 0.5 * total
"""

_BASE32 = "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '')"
_OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, octet_length(encode(payload)) AS n, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, {len(warc.HTTP_HEAD)} + (n // {CHUNK}) * {CHUNK + len(f"{CHUNK:x}") + 4} + CASE WHEN n % {CHUNK} > 0 THEN n % {CHUNK} + length(printf('%x', n % {CHUNK})) + 4 ELSE 0 END + 5 AS block FROM m)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to, true AS valid,
  CAST(CASE WHEN first = page_id THEN greatest(1, ceil(block / {SEGMENT})) ELSE 1 END AS INTEGER) AS segments FROM b
"""

_OP3 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^?#]*') AS r FROM u),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(r, length(regexp_extract(r, '^[^/]*')) + 1) AS path FROM s),
rules(host_, path_, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT h.*, host_ || path_ AS rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(host_ || path_) DESC) AS n
  FROM h LEFT JOIN rules ON (host = host_ OR ends_with(host, '.' || host_)) AND starts_with(path, path_))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""

_OP6 = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p AS pos, array_to_string(l[p:p + 2], chr(10)) AS k FROM l, unnest(range(1, len(l) - 1)) r(p)),
later AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM l),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, coalesce(len(l), 0)::INTEGER AS n_lines, (coalesce(len(l), 0) - coalesce(kept.n, 0))::INTEGER AS n_removed
FROM l LEFT JOIN kept USING (doc_id)
"""

#: All pairs of documents with a shared shingle, counted; components by label propagation.
_OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id, n.doc_id = m.c AS kept
FROM n JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m USING (doc_id)
"""

_OP10 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN (SELECT vec_id, min(c) AS c FROM r GROUP BY 1) m USING (vec_id) LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) d ON d.a = v.vec_id
"""


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text's UTF-8 bytes, half a byte at a time, the lower half first."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    # hex digits in the order of the halves: 2, 1, 4, 3...
    halves = f"list_transform(range(0, length(hex(encode({text})))), lambda i: ('0x' || substr(hex(encode({text})), CAST(i + 2 - 2 * (i % 2) AS INTEGER), 1))::BIGINT)"
    return f"xor(list_reduce({halves}, lambda c, x: xor(c >> 4, list_extract({table}, 1 + (xor(c, x) & 15))), 4294967295::BIGINT), 4294967295::BIGINT)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP11 = rf"""
WITH raw AS (SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 'b', item_id, row_number() OVER (), text FROM benchmark),
w AS (SELECT side, id, r, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM raw),
p AS (SELECT side, r, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT side, r, unnest([w[i], w[i] || ' ' || w[i + 1], w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]]) AS g FROM p),
c AS (SELECT g, {_crc32("g")} % 10000 AS bucket FROM (SELECT DISTINCT g FROM g WHERE g IS NOT NULL)),
f AS (SELECT side, r, bucket FROM g JOIN c USING (g)),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM n) + 10000)::DOUBLE) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
total AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM f JOIN gain USING (bucket) WHERE side = 'd' GROUP BY 1),
x AS (SELECT id AS doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM w LEFT JOIN total USING (r) WHERE side = 'd'),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY words >= 20) AS m FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND k <= 5 * m // 100 THEN k END AS rank FROM z
"""

_LEAF = "sha256(" + " || ".join(f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
#: Numbers by source and over sources; levels until one node is left; siblings from the families that a leaf's path meets.
_OP12 = f"""
WITH RECURSIVE d AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, {_LEAF.format("text")} AS leaf, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_LEAF.format(_LOWER.format("text"))} END AS claimed FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM o UNION ALL SELECT g, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM t WHERE n > 1 GROUP BY g, lvl, n, i // 16),
s AS (SELECT g, h AS subroot FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, g - 1 AS i, subroot AS h, count(*) OVER () AS n FROM s UNION ALL SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM u WHERE n > 1 GROUP BY lvl, n, i // 16),
root AS (SELECT h AS root FROM u WHERE n = 1),
ft AS (SELECT g, lvl, i // 16 AS p, list(h ORDER BY i) AS kids FROM t WHERE n > 1 GROUP BY ALL),
fu AS (SELECT lvl, i // 16 AS p, list(h ORDER BY i) AS kids FROM u WHERE n > 1 GROUP BY ALL),
step AS (
  SELECT o.g, o.i, lvl AS k, kids, (o.i // (16 ** lvl)::BIGINT) % 16 AS m FROM o JOIN ft ON ft.g = o.g AND p = o.i // (16 ** (lvl + 1))::BIGINT
  UNION ALL SELECT o.g, o.i, 1000 + lvl, kids, ((o.g - 1) // (16 ** lvl)::BIGINT) % 16 FROM o JOIN fu ON p = (o.g - 1) // (16 ** (lvl + 1))::BIGINT),
around AS (SELECT g, i, k, array_to_string(kids[:m], '') AS before, array_to_string(kids[m + 2:], '') AS after FROM step),
path AS (SELECT g, i, string_agg(before || after, '' ORDER BY k) AS siblings, list(before || ':' || after ORDER BY k) AS path FROM around GROUP BY ALL),
x AS (SELECT o.doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, list_reduce(coalesce(path, []), lambda h, x: sha256(split_part(x, ':', 1) || h || split_part(x, ':', 2)), coalesce(claimed, leaf)) AS folded_root
  FROM o JOIN s USING (g) CROSS JOIN root LEFT JOIN path USING (g, i))
SELECT *, folded_root = root AS verified FROM x
"""

#: The level is the first, by the sources' limits a unit of weight, that the next limit doesn't undercut.
_OP13 = r"""
WITH q AS (SELECT doc_id, avg(quality) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS h, CASE WHEN good IS NULL THEN 1.0::DOUBLE ELSE pow(2.0::DOUBLE, 2 * good - 1) END AS quality FROM documents LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM d GROUP BY 1),
o AS (SELECT *, 2 * n / w AS ratio, sum(n) OVER () AS total, sum(w) OVER () AS ws, coalesce(sum(2 * n) OVER k, 0) AS fixed, coalesce(sum(w) OVER k, 0) AS gone FROM s WINDOW k AS (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(arg_min((1.5 * total - fixed) / (ws - gone), ratio) FILTER ((1.5 * total - fixed) / (ws - gone) <= ratio), 0) AS level FROM o),
t AS (SELECT source, n, least(level * w, 2.0 * n) AS target FROM s, l),
e AS (SELECT d.*, n, target, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS epochs, sum(size) OVER (PARTITION BY d.source ORDER BY -ln((h + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / quality, doc_id, r) - size AS before FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size::BIGINT AS size, n AS source_size, target, (epochs * size + greatest(0, least(size, floor(target - epochs * n + 0.5) - before)))::BIGINT AS taken FROM e
"""


def oracle_sql() -> dict[str, str]:
    """op4, op5, op7 and op9 have none: the field, the tokenisers and the language models have no SQL form."""
    return {
        "op1_benchmark_decontamination": _OP1, "op2_warc_segments": _OP2, "op3_url_rules": _OP3, "op6_line_dedup": _OP6, "op8_minhash_near_dedup": _OP8,
        "op10_embedding_near_dedup": _OP10, "op11_importance_resampling": _OP11, "op12_merkle_manifest": _OP12, "op13_source_mixing": _OP13,
    }
