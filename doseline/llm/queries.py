"""The registered queries over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doseline.llm import (
    chat,
    decontamination,
    exact_dedup,
    language,
    line_dedup,
    mixture,
    quality,
    resampling,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    warc,
)
from doseline.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of whole texts, and which exceed a context of 512."""
    docs = table(spark, sf_dir, "documents").select(
        F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("key"),
        "text",
    )
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.token_prefixes(docs, path, id_col="key")
    return counted.select("key.doc_id", "key.n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def fold(folds: int, held: int) -> Column:
    """Whether a document belongs to the held-out fold."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == held, F.lit(False))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole texts, learned from four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.quality_scores(docs, labels.where(~fold(5, 0)))
    return scored.select(
        "doc_id", fold(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of whole texts, learned from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    read = language.languages_of(docs, public_tokenizers.path("piece_bpe_32k.model"), learn=~fold(4, 2))
    return read.select("doc_id", fold(4, 2).alias("held_out"), "lang_pred", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts and the component each is in."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each text after passages that a smaller doc_id has."""
    cut = substring_dedup.drop_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document enters the mix."""
    mixed = mixture.mix_counts(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back through their merged index."""
    history = warc.archive_pages(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations repaired at the least cost and rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item, and where."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents and the one that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents share."""
    cut = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of the documents likest to the benchmark, drawn by weight and ranked."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, and the form that each one leads to."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    "op1_token_counts": shipped(op1_token_counts),
    "op2_quality": shipped(op2_quality),
    "op3_simhash": shipped(op3_simhash),
    "op4_language": shipped(op4_language),
    "op5_substring_dedup": shipped(op5_substring_dedup),
    "op6_mixture": op6_mixture,
    "op7_warc": shipped(op7_warc),
    "op8_chat": shipped(op8_chat),
    "op9_decontamination": op9_decontamination,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_importance_resampling": shipped(op12_importance_resampling),
    "op13_spelling_variants": shipped(op13_spelling_variants),
}

# CRC-32 of a column of texts `v`, in SQL: its table follows from the polynomial, and a text's bytes
# are folded over it one by one.
CRC_TABLE = r"""
SELECT list(list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
FROM (SELECT unnest(range(256)) AS i)
"""


def crc_sql(source: str) -> str:
    """A query for (v, crc) of the texts `v` that the query `source` gives."""
    return f"""
SELECT v, xor(list_reduce(
  list_prepend(4294967295, list_transform(range(octet_length(encode(v))),
    lambda k: ('0x' || substr(hex(encode(v)), 2 * k + 1, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc
FROM ({source}), ({CRC_TABLE})
"""


ORACLE_SQL: dict[str, str] = {
    "op6_mixture": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][(rk % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS cap FROM s
), l AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS lev
  FROM w
  WINDOW o AS (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
    least(cap::DOUBLE, (SELECT lev FROM l WHERE lev * weight <= cap ORDER BY cap::DOUBLE / weight, rk LIMIT 1) * weight) AS target
  FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
    ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || digest), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496.0 AS u,
    count(*) OVER same AS n, row_number() OVER same AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
  WINDOW same AS (PARTITION BY d.doc_id, d.source, digest)
), e AS (
  SELECT *, n * (rate - floor(rate)) AS due FROM r
), c AS (
  SELECT *, (floor(rate) + CASE WHEN k <= floor(due) + CASE WHEN u < due - floor(due) THEN 1 ELSE 0 END THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM e
)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken
FROM c
""",
    "op7_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op9_decontamination": r"""
WITH d AS (
  SELECT DISTINCT doc_id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')),
    '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')),
    '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
), i AS (
  SELECT item_id, w, len(w) AS n, least(13, len(w)) AS win,
         greatest(0, (least(13, len(w)) - 3) // 5) AS subs
  FROM b WHERE len(w) >= 1
), dw AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS at FROM d),
iw AS (SELECT item_id, n AS item_n, win, subs, unnest(w) AS word, unnest(range(n)) AS at FROM i),
diagonals AS (
  SELECT doc_id, dw.n, item_id, item_n, win, subs, dw.at - iw.at AS off, list(iw.at) AS same
  FROM dw JOIN iw USING (word)
  GROUP BY ALL HAVING count(*) >= win - subs
), starts AS (SELECT *, unnest(range(item_n - win + 1)) AS s FROM diagonals)
SELECT doc_id, item_id, min(s + off)::BIGINT AS start_word
FROM starts
WHERE s + off >= 0 AND s + off + win <= n
  AND len(list_filter(same, lambda x: x >= s AND x < s + win)) >= win - subs
GROUP BY doc_id, item_id
""",
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""",
    "op11_line_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d
), k AS (
  SELECT r, place, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), shared AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), left_over AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY place) AS kept
  FROM k WHERE key NOT IN (SELECT key FROM shared) GROUP BY r
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r)
""",
    "op12_importance_resampling": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), b AS (
  SELECT list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark
), dw AS (SELECT r, unnest(words) AS word FROM d),
bw AS (SELECT unnest(words) AS word FROM b),
crc AS (
  SELECT v AS word, crc % 10000 AS bucket FROM ({crc_sql("SELECT word AS v FROM dw UNION SELECT word FROM bw")})
), s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000::DOUBLE * ln(
    (coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)
), w AS (
  SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN crc USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN w USING (r)
), placed AS (
  SELECT *, n_features >= 20 AS drawable,
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN drawable AND place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), long_runs AS (
  SELECT d || ':' || run AS v, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY d, run
), typed AS (
  SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2)
    ELSE run END AS word, n
  FROM long_runs JOIN ({crc_sql("SELECT v FROM long_runs")}) USING (v)
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gone AS (
  SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(r := -other_n, other := other)) AS b FROM near GROUP BY word
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -b.r >= 2 * n THEN b.other END AS form, CASE WHEN -b.r >= 2 * n THEN -b.r END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (
  SELECT walk.word, walk.root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL
) r ON f.word = r.word
""",
}
