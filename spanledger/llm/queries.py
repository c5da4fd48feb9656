"""The operators over their whole tables, as named queries; SQL where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm import bag_minhash, byte_bpe, conversations, language, licences, main_text, neighbours, packing, positional_index, quality, runs, sharding, warc
from spanledger.llm.columns import let

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_MODEL = "word_bpe_49k.json"
SHARDS = 24


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(parts: int) -> Column:
    """Remainder of the CRC-32 of the id's decimals."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of the nearest directory above."""
    return licences.inherit(licences.scan(documents(spark, sf_dir), licences.source_path()))


def op2_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside 10-word windows of benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = positional_index.contaminated_documents(documents(spark, sf_dir), items, F.col("doc_id"))
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return found.select(F.col("key").cast("bigint").alias("doc_id"), *columns)


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS p FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(p) AS n FROM win),
places AS (SELECT r, n, i, list_slice(w, i, i + n - 1) AS p FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, n, i, item_id FROM places JOIN win USING (p)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, n, i FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards by its id, and its shard once there is one more."""
    tree = sharding.base_tree(SHARDS)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(data) + 8).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law")
    )
    placed = sharding.place(sharding.place(rows, "doc_id", tree), "doc_id", sharding.grow(tree), "grown_shard")
    out = sharding.number_slots(placed)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    return byte_bpe.digests(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.RuleModel:
    """Rules learned from the labelled documents outside of the held-out fifth."""
    return quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold(5) != 0)


def op6_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and whether it is the one that stays."""
    rows = bag_minhash.near_duplicates(documents(spark, sf_dir))
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    return rows.select("doc_id", "class_id", "class_rows", stays.alias("stays"))


def op7_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, sf_dir)
    model = quality_model(spark, sf_dir, docs)
    scored = docs.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).cast("int"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


def op9_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = documents(spark, sf_dir)
    samples = language.sample(docs, fold(3) != 1)
    found = language.identify(docs.select("doc_id", "text"), samples)
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", F.col("lang_score").alias("score"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion record of every page, with identifiers, digests and sizes."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.derivatives(warc.responses_of(pages)).drop("record").withColumnRenamed("key", "page_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults by the CRC-32 of id and turn; NULLs are read as one space."""
    code = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    faulty = rows.where(code != 0).select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("copy"),
    )
    return faulty.drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least cost, audit and digest of every conversation, after damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    counts, blocks = conversations.repair(damaged(rows))
    return conversations.with_every_key(rows, counts, conversations.digests(blocks))


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text, or for one of ten ids its words with a tail that repeats a block: from word a on, the p words there over and over.

    A NULL id leaves the text as it is.
    """
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(crc / F.lit(10))
    given = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(a, lambda a: let(p, lambda p: F.concat(F.slice(w, 1, a), F.transform(F.slice(w, a + 1, n), lambda _, i: F.get(w, a + i % p)))))

    tail = let(given, lambda w: F.when(F.size(w) > 0, F.array_join(repeat(w), " ")).otherwise(""))
    return F.when(crc % 10 == 0, tail).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, longest and digests of the runs of repeated words in every document, one of ten with a periodic tail."""
    docs = documents(spark, sf_dir)
    found = runs.find(docs.select("doc_id", periodic_tail(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.select("*", longest.alias("best"))
    length, period = F.col("best.length"), -F.col("best.col3")
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, and its place in sequences of 4,096 ids."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(WORD_MODEL), with_ids=False)


QUERIES = {
    "op1_licence_scan": op1_licence_scan,
    "op2_positional_index": op2_positional_index,
    "op3_main_text": op3_main_text,
    "op4_hash_tree_shards": op4_hash_tree_shards,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_bag_minhash": op6_bag_minhash,
    "op7_rule_quality": op7_rule_quality,
    "op8_nn_descent": op8_nn_descent,
    "op9_cross_parsing": op9_cross_parsing,
    "op10_warc_derivatives": op10_warc_derivatives,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_best_fit_packing": op13_best_fit_packing,
}
ORACLES: dict[str, str] = {"op2_positional_index": OP2_SQL}
