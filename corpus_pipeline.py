"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it
as Parquet in the shared folder and reads it again as the next one's input.
"""

from pyspark.sql import functions as F

from echolex.llm import mixing, near_dups, packing, quality, substrings, tokens
from echolex.llm.queries import (
    MIX_SEED,
    SEQUENCE_TOKENS,
    WORD_TOKENIZER,
    mix_weights,
    tokenizer_path,
    with_domain,
)
from echolex.llm.sizes import prepare
from echolex.session import scratch_path

MIX_SHARE = 0.8  # of the tokens that are left
MIX_EPOCHS = 1
SLICE_BYTES = 1 << 19  # texts encoded at once; the workers keep what other stages took, too


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the text rules and the perplexity bands."""
    prepare(spark)
    return quality.judge(docs).filter("kept").select(docs.columns)


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate class: that with the smallest id."""
    prepare(spark)
    found = near_dups.near_duplicates(docs).filter("kept")
    ids = found.select(F.col("doc_id").alias("_kept")).distinct()
    met = docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    # A row that repeats an id is the same document; rows without an id are all kept.
    named = met.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(met.filter("doc_id is null"))


def substring_dedup(spark, docs, sf_dir):
    """Texts without the passages of earlier documents; emptied documents go."""
    prepare(spark)
    rows = substrings.dedup_substrings(docs)
    return rows.filter("_removed.words = 0 or length(trim(text)) > 0").select(docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Documents taken so that sources meet their target weights."""
    prepare(spark)
    mixed = mixing.mix(with_domain(docs), MIX_SHARE, mix_weights(spark), MIX_EPOCHS, MIX_SEED)
    return mixing.take(docs, mixed)


def pack_sequences(spark, docs, sf_dir):
    """Token pieces with the sequence and the place each lies at."""
    prepare(spark)
    path = tokenizer_path(WORD_TOKENIZER)
    return packing.pack(tokens.encode_pieces(docs, path, SEQUENCE_TOKENS, slice_bytes=SLICE_BYTES), SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark, sf_dir):
    """All stages over the documents, each written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None  # perplexity, near-duplicate search and tokens are beyond SQL; tests compare with brute force
