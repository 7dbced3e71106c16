"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import byte_bpe, embedding_dedup, exact_dedup, language_id, licenses, near_dedup, ngram_lm, packing, sharding, spelling, token_counts, toxicity, whitening
from .license_texts import KNOWN, STANDARD
from .shared import as_table, read_table, shared_path


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit_from_documents(docs))
    return found.select("doc_id", language_id.in_fold("doc_id", 0).alias("held_out"), "lang_pred", "score", "rejected")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup_documents(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: every document arrives with its words and an estimate
    of its BPE tokens; the estimates are revised; blank documents are deleted. Each batch is
    committed twice, as by a driver that was restarted; the first two are folded before the
    third arrives."""
    counted = as_table(token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), "token-counts")
    estimate = F.floor(F.coalesce("n_chars", F.lit(0)) / 4).cast("long")
    words = counted.select("source", "lang", F.lit("words@1").alias("tokenizer"), F.col("n_words").alias("n_tokens"), F.lit(0).cast("long").alias("old_tokens"))
    bpe = counted.select("source", "lang", F.lit("byte_bpe_50k@1").alias("tokenizer"), F.col("n_bpe").alias("n_tokens"), estimate.alias("old_tokens"))
    arrived = words.union(bpe.withColumn("n_tokens", F.col("old_tokens"))).withColumn("op", F.lit(token_counts.INSERT))
    revised = bpe.withColumn("op", F.lit(token_counts.REVISE))
    blank = counted.filter("n_words = 0").select("source", "lang", F.explode(F.array(F.struct(F.lit("words@1").alias("tokenizer"), F.col("n_words").alias("n_tokens")), F.struct(F.lit("byte_bpe_50k@1").alias("tokenizer"), F.col("n_bpe").alias("n_tokens")))).alias("t"))
    deleted = blank.select("source", "lang", "t.*", F.lit(0).cast("long").alias("old_tokens"), F.lit(token_counts.DELETE).alias("op"))
    rollup = token_counts.TokenRollup(spark, shared_path(spark, "token-rollup"))
    for batch_id, changes in (("arrivals", arrived), ("recount", revised), ("blank", deleted)):
        if batch_id == "blank":
            rollup.fold()
        rollup.commit(batch_id, changes)
        rollup.commit(batch_id, changes)
    return rollup.totals()


def _op1_sql() -> str:
    """The canonical form of licenses.canonical for an engine without look-around: lines are told
    by several plain patterns, and notices in running text are cut out between marks."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    space = r" \t\n\x0B\f\r"

    def plain(pattern: str) -> str:
        """Spaces as the other engine's \\s has them."""
        out, inside = "", False
        for part in re.split(r"(\\s|\\.|\[|\])", pattern):
            inside = part == "[" or (inside and part != "]")
            out += (space if inside else f"[{space}]") if part == r"\s" else part
        return quote(out)

    start, words = r"^[ \t#*/;-]*", "notice|holder|owner"
    year = licenses._YEAR
    named = f"(regexp_matches(l, {quote(start + 'Copyright[ ]*[ \\t]+(?:by[ \\t]+)?\\p{Lu}')}) AND NOT regexp_matches(l, {quote('(?i)' + start + f'Copyright[ \\t]+.*(?:{words}|treaty|law|licen[cs])')}))"
    held = (
        f"((regexp_matches(l, {quote(start + '(?:copyright|\\(c\\))')}) AND NOT regexp_matches(l, {quote(start + f'(?:copyright|\\(c\\)).*(?:{words}|treaty)')})"
        f" AND (regexp_matches(l, {quote(start + f'copyright.*(?:{year}|\\(c\\)|©)')}) OR regexp_matches(l, {quote(start + f'\\(c\\).*{year}')})))"
        f" OR (regexp_matches(l, {quote(start + '©')}) AND NOT regexp_matches(l, {quote(start + f'©.*(?:{words})')})))"
    )
    without = lambda x, told: f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: CASE WHEN {told} THEN '' ELSE l END), chr(10))"

    def canonical(x: str) -> str:
        x = f"lower({without(f'coalesce({x}, {quote("")})', named)})"
        for notice in licenses.HOLDERS:
            x = f"regexp_replace({x}, {plain(notice)}, ' ', 'g')"
        mark = plain(r"(^|[^\p{L}\p{N}])copyright(" + licenses.MARK + ")")
        x = f"string_split(regexp_replace({x}, {mark}, '\\1' || chr(1) || '\\2', 'g'), chr(1))"
        head = "string_split(p, 'copyright')[1]"
        cut = f"CASE WHEN regexp_matches({head}, {plain(licenses.OPENING)}) THEN ' ' || substr(p, length(regexp_extract({head}, {plain('(?s)^(.*?)(?:' + licenses.OPENING + ')')}, 1)) + 1) ELSE 'copyright' || p END"
        x = f"array_to_string(list_transform({x}, lambda p, i: CASE WHEN i = 1 THEN p ELSE {cut} END), '')"
        x = without(x, held)
        x = f"regexp_replace({x}, {quote(licenses.RIGHTS)}, ' ', 'g')"
        x = f"regexp_replace({x}, {quote(licenses.OTHER)}, ' ', 'g')"
        for variant, kept in licenses.SPELLINGS:
            x = f"replace({x}, {quote(variant)}, {quote(kept)})"
        return f"sha256(trim({x}))"

    texts = ", ".join(f"({quote(k)}, {quote(t)})" for k, t in KNOWN.items())
    digests = ", ".join(f"({quote(k)}, {quote(d)})" for k, d in STANDARD.items())
    return f"""
WITH known AS MATERIALIZED (SELECT id, {canonical("t")} AS digest FROM (VALUES {texts}) AS k(id, t) UNION ALL SELECT * FROM (VALUES {digests}) AS s(id, digest)),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(lower(line), 'licen[cs]|public domain')
),
digested AS MATERIALIZED (SELECT doc_id, {canonical("line")} AS line_digest FROM lines),
notices AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
  FROM digested JOIN known ON digest = line_digest GROUP BY doc_id
),
whole AS MATERIALIZED (SELECT doc_id, {canonical("text")} AS text_digest FROM documents)
SELECT doc_id, text_digest, known.id AS license_id, coalesce(n, 0) AS n_notices, coalesce(ids, '') AS notice_ids
FROM whole LEFT JOIN known ON text_digest = digest LEFT JOIN notices USING (doc_id)
"""


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


#: Classes of whole shingle sets, joined over every shingle; right for small tables only.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(root, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT root, b FROM reach JOIN link ON node = a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) LEFT JOIN n USING (doc_id)
"""

#: Cosines of all pairs of a label; right for small tables only.
OP8_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98::DOUBLE
),
reach(root, node) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT root, b FROM reach JOIN link ON node = a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY node) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a) USING (vec_id)
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out: the row's id is not in the sample that the chain is fitted on.

    Rows with held_out false say little: the chain has seen them. On 1,000 held-out rows of the
    table of 10,000 the chain and a single model of the same features catch the same share of
    toxic rows; the chain loses 0.34 % of clean rows, the single model 0.57 %."""
    docs = read_table(spark, sf_dir, "documents")
    sample = toxicity.labelled_sample(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, toxicity.fit_from_sample(sample))
    fitted = sample.select("doc_id").withColumn("held_out", F.lit(False))
    return scored.join(F.broadcast(fitted), "doc_id", "left").withColumn("held_out", F.coalesce("held_out", F.lit(True)))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return ngram_lm.score_documents(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes; tokens and rows are balanced with them as far as that allows."""
    found = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where it does not fit a long (beyond some 10^7 vectors like the tables');
    whitening.whiten has it as decimal(38, 0)."""
    table = read_table(spark, sf_dir, "embeddings")
    found = whitening.whiten(table, whitening.fit_whitening(table))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_packing": op9_packing,
    "op10_token_counts": op10_token_counts,
    "op11_sharding": op11_sharding,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op1_license_scan": _op1_sql(),
    "op3_exact_dedup": OP3_SQL,
    "op5_minhash_near_dedup": OP5_SQL,
    "op8_embedding_near_dedup": OP8_SQL,
}
