"""One query per operator over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestax_spark.llm import chat, fingerprint, jaccard, language, linededup, mixing, neardup, negatives, packing, secrets, sharding, spelling, warc
from salestax_spark.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language.held_out("doc_id")
    dictionaries = language.learn_dictionaries(docs.where(~held))
    judged = language.identify_languages(docs, dictionaries)
    return judged.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score", "lang_rejected")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(warc.page_records(spark, sf_dir))
    return resolved.withColumn("headers", warc.flat_headers(F.col("headers")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_classes(docs, words=4, percent=85).drop("_row")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    tricky = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    formatted = chat.format_conversations(rows.unionByName(more))
    read = chat.read_turns(F.col("formatted"))
    loss = chat.read_loss_text(F.col("formatted"), F.col("loss_spans"))
    lines = F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.withColumn("_read", read).withColumn("_loss", loss).select(
        "conv_id",
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.delete_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_runs", F.lit(0).cast("long"), lambda n, r: n + r["to_line"] - r["from_line"] + 1)
    return cut.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        removed.alias("n_removed"),
        F.size("removed_runs").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.frequent_words(spelling.edited_runs(docs), least_length=5, least_count=3)
    return spelling.spelling_variants(words)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), negatives.whole_components(F.col("embedding")).alias("vector")
    )
    return negatives.mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    dealt = sharding.shard_rows(docs, order=("doc_id", "size", "text_crc32"), shards=24)
    return dealt.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_secret_scan, op3_embedding_near_dedup, op4_revisit_resolution, op5_jaccard_join, op6_chat_format,
        op7_weighted_fingerprints, op8_line_dedup, op9_packing, op10_source_mix, op11_spelling_variants, op12_hard_negatives, op13_feistel_shards,
    )
}

ORACLES: dict[str, str] = {}

ORACLES["op6_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER w AS opens,
    replace(replace(replace(replace(text, '\', '\\'), '<turn ', '<\turn '), '</turn>', '<\/turn>'), '<next/>', '<\next/>') AS body
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(body) + CASE WHEN opens THEN length('<turn ' || role || '>x' || '</turn>x') ELSE length('<next/>') END)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

ORACLES["op3_embedding_near_dedup"] = r"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), links AS (
  SELECT a.r, b.r AS other FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.usable AND b.usable AND a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT r, r AS other FROM vectors
  UNION
  SELECT reach.r, links.other FROM reach JOIN links ON links.r = reach.other
), roots AS (
  SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN vectors v ON v.r = reach.other GROUP BY reach.r
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.r = v.r)::BIGINT AS n_links, component_id,
  coalesce(vec_id = component_id, FALSE) AS kept
FROM vectors v JOIN roots USING (r)
"""

ORACLES["op10_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('20|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS perm
  FROM documents
), sources AS (
  SELECT k, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY min(source) NULLS LAST) AS rank FROM sized GROUP BY k
), weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM sources
), levels AS (
  SELECT *, cap / weight AS full_at,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT k, source_size, least(cap::DOUBLE, (SELECT arg_min(level, (full_at, rank)) FROM levels WHERE level <= full_at) * weight) AS target FROM levels
), placed AS (
  SELECT doc_id, k, size, coalesce(sum(size) OVER (PARTITION BY k ORDER BY perm, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN (before + size / 2 < target)::BIGINT + (source_size + before + size / 2 < target)::BIGINT ELSE 0 END * size)::BIGINT AS taken
FROM placed JOIN targets USING (k)
"""

ORACLES["op8_line_dedup"] = r"""
WITH parts AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM parts
), wordy AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM wordy
), ends AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 20 AND b.upto - a.upto + a.words >= 20 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i), b.i FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND a.i BETWEEN b.i - 20 AND b.i AND b.upto - a.upto + a.words >= 20 GROUP BY b.doc_id, b.i
), runs AS (
  SELECT r.doc_id, r.s, r.e, string_agg(w.line, chr(10) ORDER BY w.i) AS body
  FROM ends r JOIN wordy w ON w.doc_id = r.doc_id AND w.i BETWEEN r.s AND r.e GROUP BY ALL
), later AS (
  SELECT doc_id, s, e FROM runs QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM later
), islands AS (
  SELECT g.doc_id, min(w.pos) AS a, max(w.pos) AS b
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM gone) g JOIN wordy w ON w.doc_id = g.doc_id AND w.i = g.i
  GROUP BY g.doc_id, island
), cut AS (
  SELECT l.doc_id, count(*) AS n_lines, count(x.a) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (x.a IS NULL), '') AS kept
  FROM lines l LEFT JOIN islands x ON x.doc_id = l.doc_id AND l.pos BETWEEN x.a AND x.b GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  (SELECT count(*) FROM islands x WHERE x.doc_id = d.doc_id)::BIGINT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
"""

ORACLES["op4_revisit_resolution"] = r"""
WITH captures AS (
  SELECT page_id * 5 + k AS record_id, k, k IN (0, 3) AS is_response, length(html) AS size,
    page_id * 10 + [100000, 50000, 200000, 300000, 400000][k + 1] AS moment,
    url || CASE WHEN k = 2 THEN '#again' ELSE '' END AS url,
    CASE WHEN page_id % 3 = 0 AND k >= 3 THEN md5(md5(html) || '+') ELSE md5(html) END AS digest,
    k = 4 AND page_id % 7 = 0 AS stale
  FROM pages CROSS JOIN range(5) AS ks(k)
), parts AS (
  SELECT *, '"' || CASE WHEN stale THEN md5('stale') ELSE digest END || '"' AS tag,
    lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
  FROM captures
), named AS (
  SELECT *, CASE WHEN scheme = '' THEN regexp_extract(url, '^([^#]*)', 1) ELSE scheme || '://'
      || CASE WHEN scheme = 'http' THEN regexp_replace(host, ':80$', '') WHEN scheme = 'https' THEN regexp_replace(host, ':443$', '') ELSE host END
      || CASE WHEN rest = '' THEN '/' WHEN starts_with(rest, '?') THEN '/' || rest ELSE rest END END AS canonical_url
  FROM parts
), responses AS (
  SELECT * FROM named WHERE is_response QUALIFY row_number() OVER (PARTITION BY canonical_url, moment ORDER BY record_id DESC) = 1
), found AS (
  SELECT v.*, r.record_id AS response_id, r.tag AS r_tag, r.digest AS r_digest, r.moment AS r_at, r.size AS r_size,
    CASE WHEN r.record_id IS NULL THEN 'no_response'
      WHEN v.k <> 2 AND v.tag IS NOT NULL THEN CASE WHEN v.tag = r.tag THEN 'resolved' ELSE 'mismatch' END
      WHEN v.digest IS NOT NULL THEN CASE WHEN v.digest = r.digest THEN 'resolved' ELSE 'mismatch' END
      ELSE 'unverified' END AS outcome
  FROM (SELECT * FROM named WHERE NOT is_response) v ASOF LEFT JOIN responses r ON v.canonical_url = r.canonical_url AND v.moment > r.moment
)
SELECT record_id, canonical_url, moment::BIGINT AS captured_at, outcome, response_id,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN r_digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN concat_ws('&', 'content-length=' || r_size, 'date=' || moment, 'etag=' || tag, 'server=origin')
    WHEN outcome <> 'no_response' THEN concat_ws('&', 'content-length=' || r_size, 'date=' || r_at, 'etag=' || r_tag, 'server=origin') END AS headers
FROM found
"""

ORACLES["op5_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(ws), 0) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct([array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, len(ws) - 2)])) END AS s
  FROM worded
), classes AS (
  SELECT md5(array_to_string(s, chr(10))) AS c, any_value(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 1
), shingles AS (
  SELECT c, n, unnest(s) AS shingle FROM classes
), edges AS (
  SELECT a.c AS x, b.c AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.c < b.c
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT c AS node, c AS other FROM classes
  UNION
  SELECT r.node, e.other FROM reach r JOIN (SELECT x, y AS other FROM edges UNION ALL SELECT y, x FROM edges) e ON e.x = r.other
), named AS (
  SELECT r.node AS c, min(d.doc_id) AS component_id
  FROM reach r JOIN (SELECT doc_id, md5(array_to_string(s, chr(10))) AS c FROM sets WHERE len(s) > 0) d ON d.c = r.other GROUP BY r.node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN named ON len(d.s) > 0 AND named.c = md5(array_to_string(d.s, chr(10)))
"""


# CRC-32 by nibbles of a list of bytes; the sixteen entries follow from the polynomial.
def _crc_entry(i: int) -> int:
    for _ in range(4):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
    return i


def _crc32(text: str) -> str:
    entries = "[" + ", ".join(str(_crc_entry(i)) for i in range(16)) + "]"
    low = f"xor(xor(a, b) >> 4, {entries}[(xor(a, b) & 15) + 1])"
    step = f"xor({low} >> 4, {entries}[({low} & 15) + 1])"
    listed = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {listed}), lambda a, b: {step}), 4294967295)::BIGINT"


ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), counted AS (
  SELECT d, run, count(*) AS times FROM runs GROUP BY ALL
), hashed AS (
  SELECT *, {_crc32("d || ':' || run")} AS h FROM counted
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3
), lacking AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS x, b.word AS y FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word FROM lacking a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word FROM lacking a JOIN words b ON a.rest = b.word
), near AS (
  SELECT x AS word, count(*) AS n_near, arg_min(y, (-w.n, y)) AS best, max(w.n) AS best_n FROM pairs JOIN words w ON w.word = y GROUP BY x
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), walk AS (
  SELECT word, coalesce(form, word) AS at FROM forms
  UNION
  SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near::BIGINT AS n_near, f.form, f.form_n, walk.at AS root
FROM forms f JOIN walk USING (word) JOIN forms l ON l.word = walk.at AND l.form IS NULL
"""

ORACLES["op12_hard_negatives"] = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), usable AS (
  SELECT *, row_number() OVER () AS r FROM vectors WHERE label IS NOT NULL
), scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER best::INT AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.ar = n.ar AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW best AS (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.id, n.br)
QUALIFY row_number() OVER best <= 3
"""

ORACLES["op13_feistel_shards"] = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number FROM sized
), sides AS (
  SELECT n, a, ((n + a - 1) // a)::BIGINT AS b FROM (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM documents)
), walk AS (
  SELECT row_number, row_number // b AS l, row_number % b AS r, 0 AS k FROM numbered, sides
  UNION ALL
  SELECT row_number,
    CASE WHEN k % 2 = 0 THEN (l + ('0x' || substr(md5('13|' || (k % 6) || '|' || r), 1, 15))::BIGINT % a) % a ELSE l END,
    CASE WHEN k % 2 = 1 THEN (r + ('0x' || substr(md5('13|' || (k % 6) || '|' || l), 1, 15))::BIGINT % b) % b ELSE r END,
    k + 1
  FROM walk, sides WHERE k = 0 OR k % 6 <> 0 OR l * b + r >= n
), placed AS (
  SELECT row_number, l * b + r AS place FROM walk, sides WHERE k > 0 AND k % 6 = 0 AND l * b + r < n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, row_number, (place % 24)::INT AS shard, place // 24 AS slot, NULL::INT AS grown_shard
FROM numbered JOIN placed USING (row_number)
"""
