"""The driver queries of the corpus operators: each applies one operator, with
its production parameters, to the whole of its table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def register(name: str, sql: str | None = None):
    def keep(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function
    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds, cut from every document."""
    from .suffix_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents"), length=50)


@register("op2_sampled_segmentations")
def op2_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight different sampled segmentations of every document: their pieces' ids,
    inclusion scores, and the digest of the text that the ids decode to."""
    from .sampling import sample_segmentations
    sampled = sample_segmentations(_table(spark, sf_dir, "documents"), PIECES, k=8, with_text=True)
    return sampled.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


@register("op3_merkle_fingerprints")
def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every text, of its edited text, and how alike they are."""
    from .merkle import compare_with_edited
    return compare_with_edited(_table(spark, sf_dir, "documents"))


@register("op4_minhash_near_dedup", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_distinct(
        [array_to_string(ws[i:i + 4], ' ') for i in range(1, greatest(len(ws) - 4, 1) + 1)]) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
pair AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM pair UNION SELECT r.a, k.b FROM reach r JOIN pair k ON r.b = k.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(least.m, n.doc_id)) AS component_id,
       least(n.doc_id, coalesce(least.m, n.doc_id)) = n.doc_id AS kept
FROM n LEFT JOIN least ON least.a = n.doc_id""")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are 85 % alike."""
    from .minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


@register("op5_pseudonyms")
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with its personal data replaced by pseudonyms."""
    from .pseudonyms import pseudonymise
    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=PSEUDONYM_KEY)


#: stands for the secret of a production run
PSEUDONYM_KEY = "public-example-key"


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32(doc_id) mod 3 is not 1."""
    from .langid import identify, train
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = train(docs, ~held_out)
    return identify(docs, model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


@register("op7_exact_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""")
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    from .topk import exact_top_k
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@register("op8_warc_bundles", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f""")
def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into seekable bundles and read back."""
    from .warc import read_records, write_bundles
    folder = scratch_path(spark, "warc")
    index = write_bundles(_table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder).drop("url")


@register("op9_length_buckets")
def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and padding of every document, by its number of words."""
    from .packing import pack
    return pack(_table(spark, sf_dir, "documents"), buckets=16, token_budget=32_768)


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the digest cache (a new cache per run)."""
    from .token_cache import count_tokens
    counted = count_tokens(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"), BYTE_BPE,
                           pattern=public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@register("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte-level and the SentencePiece tokens of every document, aligned."""
    from .alignment import align_corpus
    return align_corpus(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)[0]


#: DuckDB has no crc32: the same by eight shifts a byte of the decimal id
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""


@register("op12_conversation_trie", f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id
             ORDER BY turn NULLS FIRST, sha256(concat(octet_length(encode(r)), ':', r, x))) AS p, r, x
           FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
                 WHERE conv_id IS NOT NULL)),
own AS (SELECT c, list(struct_pack(r := r, x := x) ORDER BY p) AS l FROM t GROUP BY c),
head AS (SELECT c, c - c % 100 AS b, {_CRC.format(id="c")} % 6 AS h, l FROM own),
w AS (SELECT head.c, list_concat(coalesce(base.l[1:h], []), head.l[h + 1:]) AS w FROM head LEFT JOIN own base ON base.c = head.b),
pre AS (SELECT c, d, w[1:d] AS k, d = len(w) AS last FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM w)),
n AS (SELECT k, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
      FROM pre GROUP BY k),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, up.conv_id AS parent_conv_id,
             CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.k[n.d].x) END AS saved
      FROM n LEFT JOIN kids ON kids.k = n.k LEFT JOIN n up ON n.d > 0 AND up.k = n.k[1:n.d - 1]),
below AS (SELECT k[1:a] AS k, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM v) GROUP BY 1)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM v JOIN below ON below.k = v.k""")
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations that share their first turns in hundreds."""
    from .prefix_trie import conversation_trie
    conv = F.col("conv")
    return conversation_trie(_table(spark, sf_dir, "conversations"), shared=conv - conv % 100,
                             head=(F.crc32(conv.cast("string")) % 6).cast("int"))


@register("op13_ngram_scores")
def op13_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document under a trigram model of those
    whose crc32(doc_id) mod 7 is not 2. A row without id is neither learned
    from nor held out."""
    from .ngram_lm import score_corpus
    remainder = F.crc32(F.col("doc_id").cast("string")) % 7
    scored = score_corpus(_table(spark, sf_dir, "documents"), remainder != 2)
    return scored.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")
