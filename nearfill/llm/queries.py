"""The registered queries of the subpackage: each applies its operator to its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, importance, jaccard_join, license_rules, license_scan, masked_lm, mixing, multi_index, packing, quality_rules, token_files, turn_repair, warc, window_dedup


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents by ordered signature rules."""
    return license_scan.report(_read(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.components(_read(spark, sf_dir, "documents"), k=5, percent=75)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to flattened source weights: one row per document and epoch, with its block's slot."""
    found = mixing.positions(_read(spark, sf_dir, "documents").select("doc_id", "source"))
    return found.select("doc_id", "source", F.col("__block").alias("block"), F.col("__epoch").alias("epoch"),
                        F.col("__slot").alias("slot"), F.col("__place").alias("place"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents against the good labelled ones, and the Gumbel top-k sample (kept)."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return importance.resample(docs, importance.fit(docs, labels))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents under a window network trained on all of them."""
    docs = _read(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.train(docs))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to dictionary-compressed WARC archives and read back; one row per record."""
    return warc.read(warc.write(_read(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit decreasing packing of all documents into sequences of 2048 tokens; one row per piece."""
    pieces = packing.pack(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows by cosine for every row whose vec_id is divisible by 50."""
    vectors = _read(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), multi_index.fit(vectors, k=5), k=5)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bit-packed token files of all documents, written in doc_id order and read back."""
    files = token_files.write(_read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=2)
    return token_files.read(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rule and calibrated n-gram model over all documents."""
    docs = _read(spark, sf_dir, "documents")
    model = quality_rules.fit(quality_rules.labelled_grams(docs, _read(spark, sf_dir, "labels")))
    q = quality_rules.scored(docs.select("doc_id", "text"), model)
    return q.select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                    "quality.n_repeat_words", "quality.base_failed", "quality.kept", "quality.p_good")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation: faults, cost, edits and a digest of the repaired turns."""
    return turn_repair.report(turn_repair.damaged(_read(spark, sf_dir, "conversations")))


def op12_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after windows of 20 words that also start earlier are taken out."""
    return window_dedup.report(_read(spark, sf_dir, "documents"), window=20)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives in the score windows of the positives of every row whose vec_id is divisible by 100."""
    vectors = _read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.whole_rows(vectors.withColumn("label", moved), scale=256)
    return hard_negatives.mine(rows, vectors.where(F.col("vec_id") % 100 == 0))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_masked_lm": op5_masked_lm,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_multi_index": op8_multi_index,
    "op9_token_files": op9_token_files,
    "op10_quality_rules": op10_quality_rules,
    "op11_turn_repair": op11_turn_repair,
    "op12_window_dedup": op12_window_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
_MIXING_SQL = """
WITH RECURSIVE c AS (
    SELECT coalesce('s:' || source, 'null') AS src, count(*) AS docs, pow(count(*), 0.9) AS s FROM documents GROUP BY 1),
f AS (
    SELECT src, docs, row_number() OVER (ORDER BY src) AS i, 1000 * s / sum(s) OVER () AS want,
           greatest(1, CAST(floor(1000 * s / sum(s) OVER ()) AS BIGINT)) AS p FROM c),
w AS (
    SELECT src, docs, i, p + CASE WHEN row_number() OVER (ORDER BY p - want, i) <= 1000 - sum(p) OVER () THEN 1 ELSE 0 END AS p
    FROM f),
l AS (SELECT list(p ORDER BY i) AS parts FROM w),
sched(t, nxt, pick) AS (
    SELECT CAST(-1 AS BIGINT), list_transform(parts, lambda p: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM l
    UNION ALL
    SELECT t + 1, list_transform(nxt, lambda k, i: CASE WHEN i = pick THEN k + 1 ELSE k END), pick FROM (
        SELECT t, nxt, list_min(list_filter(list_transform(nxt, lambda k, i:
                   CASE WHEN k < parts[i] AND (k * 1000) // parts[i] <= t + 1
                        THEN (((k + 1) * 1000 + parts[i] - 1) // parts[i]) * 100000 + i END),
                   lambda x: x IS NOT NULL)) % 100000 AS pick
        FROM sched, l WHERE t + 1 < 1000)),
own AS (
    SELECT src, p, (docs + 63) // 64 AS blocks, list(t ORDER BY t) AS slots
    FROM w JOIN sched ON pick = i GROUP BY src, p, docs),
e AS (
    SELECT *, max(((blocks - 1) // p) * 1000 + slots[(blocks - 1) % p + 1] + 1) OVER () AS length FROM own),
plan AS (
    SELECT *, least((length // 1000) * p + len(list_filter(slots, lambda t: t < length % 1000)), blocks * 4) AS total FROM e),
r AS (
    SELECT doc_id, source, coalesce('s:' || source, 'null') AS src,
           row_number() OVER (PARTITION BY source ORDER BY md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))) - 1 AS n
    FROM documents),
x AS (
    SELECT doc_id, source, n // 64 AS block, n % 64 AS place, p, slots, blocks,
           unnest(range((total - 1 - n // 64) // blocks + 1)) AS epoch
    FROM r JOIN plan USING (src))
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(epoch AS BIGINT) AS epoch,
       CAST(((epoch * blocks + block) // p) * 1000 + slots[(epoch * blocks + block) % p + 1] AS BIGINT) AS slot,
       CAST(place AS BIGINT) AS place
FROM x"""


_TURN_REPAIR_SQL = r"""
WITH RECURSIVE tab AS (
    SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
src AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
num AS (
    SELECT src.*, xor(4294967295, list_reduce([4294967295] || list_transform(range(1, len(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS f FROM src, tab),
dmg AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN f = 0 THEN 0 WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM num),
ord AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
           rtrim(text, E'\t\n\x0b\x0c\r ') AS bare FROM dmg),
flt AS (
    SELECT *, left(role, 1) AS ini, CASE WHEN bare = '' THEN 'blank'
           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
           WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ord),
ids AS (SELECT DISTINCT conv_id FROM conversations),
agg AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal,
           list({'ini': ini, 'must': fault IN ('blank', 'duplicate'), 'x': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END,
                 'role': role, 'text': text} ORDER BY i) AS rs FROM flt GROUP BY conv_id),
dp(conv_id, i, e, s, u, a) AS (
    SELECT conv_id, len(rs), {'c': 0, 't': ''}, {'c': 10, 't': 'II'}, {'c': 5, 't': 'I'}, {'c': 0, 't': ''} FROM agg
    UNION ALL
    SELECT conv_id, i, least(be, {'c': 5 + nu.c, 't': 'I' || nu.t}), least(bs, {'c': 5 + nu.c, 't': 'I' || nu.t}), nu, na FROM (
        SELECT *, least(bu, {'c': 5 + ba.c, 't': 'I' || ba.t}) AS nu, least(ba, {'c': 5 + bu.c, 't': 'I' || bu.t}) AS na FROM (
            SELECT conv_id, i - 1 AS i,
                list_min(list_filter([{'c': 2 + e.c, 't': 'D' || e.t},
                    CASE WHEN NOT r.must AND r.ini = 's' THEN {'c': r.x + s.c, 't': 'K' || s.t} END,
                    CASE WHEN NOT r.must AND r.ini = 'u' THEN {'c': r.x + u.c, 't': 'K' || u.t} END,
                    CASE WHEN NOT r.must THEN {'c': 1 + r.x + u.c, 't': 'R' || u.t} END], lambda z: z IS NOT NULL)) AS be,
                list_min(list_filter([{'c': 2 + s.c, 't': 'D' || s.t},
                    CASE WHEN NOT r.must AND r.ini = 'u' THEN {'c': r.x + u.c, 't': 'K' || u.t} END,
                    CASE WHEN NOT r.must THEN {'c': 1 + r.x + u.c, 't': 'R' || u.t} END], lambda z: z IS NOT NULL)) AS bs,
                list_min(list_filter([{'c': 2 + u.c, 't': 'D' || u.t},
                    CASE WHEN NOT r.must AND r.ini = 'a' THEN {'c': r.x + a.c, 't': 'K' || a.t} END,
                    CASE WHEN NOT r.must THEN {'c': 1 + r.x + a.c, 't': 'R' || a.t} END], lambda z: z IS NOT NULL)) AS bu,
                list_min(list_filter([{'c': 2 + a.c, 't': 'D' || a.t},
                    CASE WHEN NOT r.must AND r.ini = 'u' THEN {'c': r.x + u.c, 't': 'K' || u.t} END,
                    CASE WHEN NOT r.must THEN {'c': 1 + r.x + u.c, 't': 'R' || u.t} END], lambda z: z IS NOT NULL)) AS ba
            FROM (SELECT dp.*, rs[dp.i] AS r FROM dp JOIN agg ON dp.conv_id IS NOT DISTINCT FROM agg.conv_id WHERE dp.i > 0)))),
best AS (SELECT conv_id, e.c AS cost, e.t AS audit FROM dp WHERE i = 0),
ltr AS (
    SELECT b.conv_id, rs, j, audit[j] AS l, len(replace(audit[1:j], 'I', '')) AS row, len(replace(audit[1:j - 1], 'D', '')) AS n,
           CASE WHEN audit LIKE '%K%' AND rs[len(replace(regexp_extract(audit, '^[^KRI]*K'), 'I', ''))].ini = 's' THEN 1 ELSE 0 END AS sys
    FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS j FROM best) b JOIN agg ON b.conv_id IS NOT DISTINCT FROM agg.conv_id),
txt AS (
    SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN rs[row].role WHEN (n - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END
               || ':' || CASE WHEN l = 'I' THEN '' ELSE rs[row].text END, E'\n' ORDER BY j) AS t
    FROM ltr WHERE l <> 'D' GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM ids LEFT JOIN agg ON ids.conv_id IS NOT DISTINCT FROM agg.conv_id
LEFT JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN txt ON ids.conv_id IS NOT DISTINCT FROM txt.conv_id"""


def _license_sql() -> str:
    """The scan as SQL: every rule at every anchor, then suppression by a self-join."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ",\n".join(
        f"({i}, {quote(r.label)}, {r.priority}, {str(r.base).lower()}, {quote(r.anchor)}, {quote(f'^({r.pattern})( |$)')}, "
        f"{license_rules.CONFIDENCE[r.priority]})" for i, r in enumerate(license_rules.rules()))
    word = license_scan.WORD
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH r(number, label, priority, base, anchor, pattern, confidence) AS (VALUES {rules}),
t AS (
    SELECT row_number() OVER () AS id, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS w FROM documents),
p AS (SELECT id, w, unnest(range(len(w))) AS i FROM t),
a AS (
    SELECT id, i, w[i + 1] AS anchor, array_to_string(w[i + 1:i + {license_rules.WINDOW_WORDS}], ' ') AS near
    FROM p WHERE w[i + 1] IN (SELECT anchor FROM r)),
m AS (
    SELECT id, i AS s, number, label, priority, base, confidence, regexp_extract(near, pattern, 1) AS found
    FROM a JOIN r USING (anchor)),
d AS (SELECT *, s + len(string_split(found, ' ')) AS e FROM m WHERE found <> ''),
k AS (
    SELECT * FROM d WHERE base OR NOT EXISTS (
        SELECT 1 FROM d o WHERE o.id = d.id AND NOT o.base
            AND o.s <= d.s AND o.e >= d.e
            AND (o.priority > d.priority OR (o.priority = d.priority AND (
                o.e - o.s > d.e - d.s OR (o.s = d.s AND o.e = d.e AND o.number < d.number))))))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(*) FILTER (base) AS n_base,
       min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(confidence), 0) AS DOUBLE) AS score
FROM t LEFT JOIN k USING (id) GROUP BY id, doc_id, w"""


ORACLE: dict[str, str] = {
    "op1_license_scan": _license_sql(),
    "op3_mixing": _MIXING_SQL,
    "op11_turn_repair": _TURN_REPAIR_SQL,
    "op12_window_dedup": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
n AS (SELECT r, doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN sha256(array_to_string(w[i:i + 19], ' ')) END AS s FROM p),
m AS (SELECT *, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM n),
c AS (
    SELECT *, coalesce(max(CASE WHEN later THEN i END) OVER (PARTITION BY r ORDER BY i) >= i - 19, false) AS gone FROM m),
a AS (
    SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (r)""",
    "op13_hard_negatives": """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.label AS al, b.vec_id, b.label AS bl, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE al = bl
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE al <> bl AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
    "op6_warc": """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS winner FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to
FROM w""",
}
