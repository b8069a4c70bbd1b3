"""Token counts with a digest cache.

``count_tokens`` joins (content digest, tokenizer version) to the counts kept
in a cache table, encodes only the distinct contents that miss, appends their
counts, and answers every row from the cache.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_table

CACHE_SCHEMA = "digest binary, n_tokens long, version string"
#: distinct words a worker remembers before it starts again
WORDS_KEPT = 1_000_000
#: below this code point all Unicode versions agree on letters, digits and white space
PLAIN_BELOW = 0x0250


@functools.lru_cache(maxsize=4)
def _encoder(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library's version."""
    import tokenizers
    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + b"\0" + f.read()).hexdigest()


class TokenCounter:
    """Counts the tokens of texts as the library gives them.

    A byte-level tokenizer without normaliser cuts a text into words by its
    pattern and encodes each word alone. So in plain texts each distinct word
    goes through the library once and its count is remembered; a text with a
    special token or a character beyond Latin goes through the library whole.
    """

    def __init__(self, path: str, pattern: str | None):
        self.library = _encoder(path)
        self.words: dict[str, int] = {}
        self.find = None
        if pattern is not None:
            import regex
            self.find = regex.compile(pattern).findall
            special = [regex.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
            beyond = f"[^\\x00-{chr(PLAIN_BELOW - 1)}]"
            self.whole = regex.compile("|".join([beyond, *special])).search

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        plain = [i for i, t in enumerate(texts) if self.find and not self.whole(t)]
        rest = sorted(set(range(len(texts))) - set(plain))
        for i, n in zip(rest, self._lengths([texts[i] for i in rest])):
            out[i] = n
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        cut = [self.find(texts[i]) for i in plain]
        new = list(set().union(*cut) - self.words.keys())
        self.words.update(zip(new, self._lengths(new)))
        count = self.words.__getitem__
        for i, words in zip(plain, cut):
            out[i] = sum(map(count, words))
        return out


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table, empty where none has been written yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, pattern: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens per row of ``docs``.

    ``cache_path`` is a table on storage that driver and executors share;
    ``tokenizer_path`` a tokenizer file that every machine has. ``pattern`` is
    the tokenizer's own word pattern, given only for byte-level tokenizers
    without normaliser. The content is the text itself, as normalising it
    would change its count.

    A null text counts as empty (0 tokens). Repeated rows and copies are
    encoded once and each row is answered; a null doc_id is kept; an empty
    table gives an empty result; other columns are ignored. Two runs that
    append the same digest at once leave equal counts, of which one is read.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("content"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2("content", 256)))

    def known() -> DataFrame:
        return (read_cache(spark, cache_path).where(F.col("version") == version)
                .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))

    # copies meet in the map tasks, so a content that a third of the rows hold is moved once a task
    misses = (keyed.groupBy("digest").agg(F.first("content").alias("content"))
              .join(known().select("digest"), "digest", "left_anti"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                counts = counter.counts(part.column("content").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest").cast(pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    (misses.mapInArrow(encode, "digest binary, n_tokens long").withColumn("version", F.lit(version))
     .write.mode("append").parquet(cache_path))
    # written first: a join right above its aggregation could not be split where a digest is hot
    counts = scratch_table(known(), "token-counts")
    return (keyed.select("doc_id", "digest", F.octet_length("content").cast("long").alias("n_bytes"))
            .join(counts, "digest").select("doc_id", "n_bytes", "n_tokens"))
