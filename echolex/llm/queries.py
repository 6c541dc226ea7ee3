"""Registered queries of the training-data operators, each over its whole table."""

from pyspark.sql import functions as F

from echolex.llm import (
    alignment,
    licenses,
    mixing,
    near_dups,
    packing,
    quality,
    repair,
    sharding,
    substrings,
    suffixes,
    token_trees,
    tokens,
    transcripts,
    vectors,
)
from echolex.llm.sizes import prepare

SHARDS = 24
SEQUENCE_TOKENS = 2048
TREE_TOKENIZER = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def _table(spark, sf_dir, name):
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name):
    """Place of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_rotation_codes(spark, sf_dir):
    """Links and classes of the embeddings of one label at cosine 0.93."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def sample_edits():
    """Three edits of each text, made from the text itself: insert, delete, replace."""
    n = F.length("text").cast("long")

    def one(pos, remove, insert):
        return F.struct(
            F.floor(pos).cast("long").alias("pos"), F.lit(remove).cast("long").alias("remove"), insert.alias("insert")
        )

    return F.array(
        one(n / 3, 0, F.substring("text", 1, 12)),
        one(n / 2, 25, F.lit("")),
        one(n * 2 / 3, 10, F.expr("right(text, 15)")),
    )


def op2_token_trees(spark, sf_dir):
    """Token counts of every document before and after three edits of it."""
    import public_tokenizers

    path, pattern = tokenizer_path(TREE_TOKENIZER), public_tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = token_trees.build_trees(docs, path, pattern)
    trees = trees.withColumn("tokens_before", token_trees.tree_tokens()).withColumn("edits", sample_edits())
    edited = token_trees.apply_edits(trees, path, pattern)
    return edited.select(
        "doc_id",
        "tokens_before",
        F.col("n_tokens").alias("tokens_after"),
        F.coalesce(F.size("tree.tokens"), F.lit(0)).alias("n_pre_tokens"),
        F.col("n_encoded"),
        F.crc32("text").alias("text_crc32"),
    )


DOMAINS = 4
DOMAIN_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
LANGUAGE_WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 17


def with_domain(docs):
    """Sources are dealt to a few domains by the number in their name."""
    number = F.regexp_extract("source", r"(\d+)$", 1)
    domain = F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("long"), F.lit(DOMAINS))))
    return docs.withColumn("domain", domain)


def mix_weights(spark):
    """Weights of the domains, and of the languages in each; sources share alike."""
    domains = [(f"domain{i}", w) for i, w in enumerate(DOMAIN_WEIGHTS)]
    languages = [(d, lang, w) for d, _ in domains for lang, w in LANGUAGE_WEIGHTS.items()]
    return {
        "domain": spark.createDataFrame(domains, "domain string, weight double"),
        "lang": spark.createDataFrame(languages, "domain string, lang string, weight double"),
    }


def op3_hierarchical_mix(spark, sf_dir):
    """How often each document is taken for six tenths of all tokens."""
    docs = with_domain(_table(spark, sf_dir, "documents"))
    return mixing.mix(docs, MIX_SHARE, mix_weights(spark), MIX_EPOCHS, MIX_SEED)


_SHARES = """
{name}_f AS (SELECT *, cap / w AS full_at FROM {name}_n WHERE w > 0),
{name}_l AS (SELECT *, (amount - coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY full_at, {key}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (PARTITION BY {parent}
      ORDER BY full_at, {key} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM {name}_f),
{name}_o AS (SELECT *, max(CASE WHEN full_at > level THEN level END) OVER (PARTITION BY {parent}) AS open_level
    FROM {name}_l),
{name}_g AS (SELECT *, coalesce(least(cap, w * open_level), cap) AS given FROM {name}_o),
"""

_MIX_SQL = (
    r"""
WITH slim AS (
  SELECT doc_id, coalesce('domain' || (nullif(regexp_extract(source, '(\d+)$', 1), '')::BIGINT % 4)::VARCHAR, '-')
      AS domain, coalesce(lang, '-') AS lang, coalesce(source, '-') AS source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, 2.0::DOUBLE * sum(tokens) AS cap
  FROM slim GROUP BY ALL),
d_n AS (SELECT domain, sum(cap)::DOUBLE AS cap, (SELECT 0.6::DOUBLE * sum(tokens) FROM leaves) AS amount,
    (CASE domain WHEN 'domain0' THEN 0.4 WHEN 'domain1' THEN 0.3 WHEN 'domain2' THEN 0.2 WHEN 'domain3' THEN 0.1
     ELSE 1 END)::DOUBLE AS w FROM leaves GROUP BY domain),"""
    + _SHARES.format(name="d", parent="1", key="domain")
    + """
l_n AS (SELECT domain, lang, sum(leaves.cap)::DOUBLE AS cap, any_value(given) AS amount,
    (CASE WHEN domain = '-' THEN 1 WHEN lang = 'en' THEN 0.5 WHEN lang IN ('de', 'fr') THEN 0.2
     WHEN lang = 'es' THEN 0.1 ELSE 1 END)::DOUBLE AS w
  FROM leaves JOIN d_g USING (domain) GROUP BY domain, lang),"""
    + _SHARES.format(name="l", parent="domain", key="lang")
    + """
s_n AS (SELECT domain, lang, source, leaves.cap AS cap, given AS amount, 1.0::DOUBLE AS w
  FROM leaves JOIN l_g USING (domain, lang)),"""
    + _SHARES.format(name="s", parent="domain, lang", key="source")
    + """
targets AS (SELECT domain, lang, source, leaves.tokens AS leaf_tokens, round(coalesce(given, 0))::BIGINT AS target
  FROM leaves LEFT JOIN s_g USING (domain, lang, source)),
placed AS (SELECT slim.*, (CASE WHEN leaf_tokens > 0 THEN target // leaf_tokens ELSE 0 END)::INT AS whole,
    target, leaf_tokens FROM slim JOIN targets USING (domain, lang, source) WHERE tokens > 0),
ordered AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '-')), tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, domain, lang, source, tokens,
  (whole + CASE WHEN before < target - whole * leaf_tokens THEN 1 ELSE 0 END)::INT AS copies
FROM ordered WHERE whole + CASE WHEN before < target - whole * leaf_tokens THEN 1 ELSE 0 END > 0
"""
)


def op4_content_chunks(spark, sf_dir):
    """Every document without the passages that an earlier one has."""
    rows = substrings.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.col("_removed.words").alias("removed_words"),
        F.col("_removed.spans").alias("spans"),
        F.crc32("text").alias("text_crc32"),
        "text",
    )


def op5_license_scan(spark, sf_dir):
    """Places of known license texts in every document."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_prob_minhash(spark, sf_dir):
    """Class of every document by five-word shingles at similarity 0.8."""
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_transcript_roles(spark, sf_dir):
    """Turns recovered from transcripts written from all conversations."""
    lines = transcripts.written(_table(spark, sf_dir, "conversations")).checkpoint()
    model = transcripts.train(lines)
    return transcripts.parse_transcripts(lines, model)


def op8_ngram_perplexity(spark, sf_dir):
    """Base statistics of every document and its place in the bands of its language."""
    rows = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    base = [F.col(f"_scores.{n}").alias(n) for n in quality.SCORES]
    return rows.select("doc_id", *base[:-1], "base_failed", "kept", base[-1], "_lower", "_upper")


def op9_sum_of_squares_packing(spark, sf_dir):
    """Token pieces of all documents in sequences of 2048."""
    pieces = tokens.encode_pieces(
        _table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), SEQUENCE_TOKENS
    )
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim, SEQUENCE_TOKENS)


def op10_best_fit_shards(spark, sf_dir):
    """Equal texts together, 24 shards of near-equal bytes."""
    rows = sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_arrow_alignment(spark, sf_dir):
    """Byte-level tokens against pieces of every document, with corpus-wide link counts."""
    rows = alignment.align(
        _table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        digest.alias("groups_sha256"),
    )


def op12_column_suffixes(spark, sf_dir):
    """Every document without the bytes that a repeated string of 200 bytes covers."""
    rows = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_branch_and_bound(spark, sf_dir):
    """The cheapest repair of every conversation after damage."""
    return repair.repair(repair.damaged(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_rotation_codes": op1_rotation_codes,
    "op2_token_trees": op2_token_trees,
    "op3_hierarchical_mix": op3_hierarchical_mix,
    "op4_content_chunks": op4_content_chunks,
    "op5_license_scan": op5_license_scan,
    "op6_prob_minhash": op6_prob_minhash,
    "op7_transcript_roles": op7_transcript_roles,
    "op8_ngram_perplexity": op8_ngram_perplexity,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_best_fit_shards": op10_best_fit_shards,
    "op11_arrow_alignment": op11_arrow_alignment,
    "op12_column_suffixes": op12_column_suffixes,
    "op13_branch_and_bound": op13_branch_and_bound,
}
_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (SELECT a.r AS x, b.r AS y, a.vec_id AS vx, b.vec_id AS vy FROM u a JOIN u b
  ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
c AS (SELECT vec_id AS node, vec_id AS reached FROM v
  UNION SELECT c.node, l.vy FROM c JOIN l ON l.vx = c.reached),
g AS (SELECT node, min(reached) AS component_id FROM c GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.x = v.r) AS n_links, g.component_id,
  v.vec_id = g.component_id AS kept
FROM v JOIN g ON g.node = v.vec_id
"""

ORACLES = {
    "op1_rotation_codes": _VECTORS_SQL,
    "op3_hierarchical_mix": _MIX_SQL,
}
