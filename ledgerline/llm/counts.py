"""Token counts behind a digest cache: only texts never counted before are encoded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.tokens import encoder, file_digest
from ledgerline.llm.workers import ready

CACHE = "tokenizer string, digest string, n_tokens long"


def _rooted(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an absent cache is an empty one."""
    files, hadoop = _rooted(spark, path)
    if not files.exists(hadoop):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path)


def normalised(text: Column, word_wise: bool) -> Column:
    """Texts of one digest have one count. Runs of ASCII white space count as one space, and
    none at the ends, for tokenizers that drop white space; nothing else is touched."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, r"[ \t-\r]+", " ")) if word_wise else text


def count_tokens(
    docs: DataFrame, path: str, cache_path: str, key: str = "doc_id", text: str = "text",
    word_wise: bool = True, limit: int = 2048,
) -> DataFrame:
    """The key, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    Texts are joined to the cache by the digest of their normalised content and the digest of
    the tokenizer file. Distinct misses are encoded once and appended to the cache, which is a
    Parquet table at ``cache_path`` in storage that all executors share; an append that fails
    leaves nothing behind. Copies meet in the map side of an aggregate, so one text that fills
    a third of the table travels once per task.

    Null texts count as empty: no bytes and no tokens. Repeated rows and keys each give a row;
    other columns play no part; an empty table gives no rows.
    """
    spark = docs.sparkSession
    version = file_digest(path)
    texts = docs.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    plain = texts.select(key, F.octet_length("_text").cast("long").alias("n_bytes"), normalised(F.col("_text"), word_wise).alias("_text"))
    keyed = plain.withColumn("_digest", F.sha2(F.col("_text"), 256))

    known = read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
    missing = (
        keyed.groupBy("_digest").agg(F.first("_text").alias("_text"))
        .join(known.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, word_wise)
        for batch in batches:
            sizes = [n for _, counts in tokenizer.batches(batch.column(1)) for n in counts.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(sizes), pa.string()), batch.column(0), pa.array(sizes, pa.int64())],
                names=["tokenizer", "digest", "n_tokens"],
            )
        tokenizer.forget()

    ready(missing).mapInArrow(encode, CACHE).write.mode("append").parquet(cache_path)
    # Two runs at once may both have appended a text; they agree on its count.
    known = read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
    counts = known.groupBy(F.col("digest").alias("_digest")).agg(F.max("n_tokens").alias("n_tokens"))
    return (
        keyed.select(key, "n_bytes", "_digest").join(counts, "_digest", "left")
        .select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
