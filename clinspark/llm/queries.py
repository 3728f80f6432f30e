"""The operators of this subpackage as queries over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm import (
    bpe, fm_index, hard_negatives, html_text, lattice, licenses, line_dedup, pseudo_likelihood, quotes, simhash, token_files,
    token_links, toxicity,
)
from clinspark.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[bpe.Ranks, str]:
    """The vocabulary file's ranks and its pattern, read on the driver; both have a fixed size."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of the whole conversations, sent as mails that quote the turns before them."""
    messages = quotes.as_replies(table(spark, sf_dir, "conversations"))
    return quotes.link_quotes(messages, Staging(spark)).select(
        "conv_id", "turn", "role", "own_text", "n_quotes", "n_linked", "to_conv", "to_turn", "thread_conv", "thread_turn",
        "depth")


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_patience_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every whole document without the blocks that an earlier one has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.dedup_lines(docs, Staging(spark))
    return left.select(
        "doc_id",
        F.coalesce(F.size("line_dedup.deleted"), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce("line_dedup.words_deleted", F.lit(0)).cast("long").alias("words_deleted"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op7_masked_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every whole document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_likelihood.train_and_score(docs, Staging(spark)).select("doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, and its tokens decoded again."""
    ranks, pattern = tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_round_trip(docs, ranks, pattern).select(
        "doc_id",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every whole document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Staging(spark))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op2_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    found = lattice.near_vectors(table(spark, sf_dir, "embeddings"), Staging(spark))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every whole document shares with the benchmark's windows of ten words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fm_index.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "leak.n_words", "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op9_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, filed by source and language."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        "text")
    return licenses.scan_licences(files, Staging(spark)).select(
        "doc_id", "path", "own_licence", "own_score", "inherited_licence", "inherited_from", "licence")


def op11_spilled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every whole text, and how common their links are in the corpus."""
    import public_tokenizers

    encoders = token_links.encoders(
        spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_links.align(docs, encoders, Staging(spark))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = found.documents.select(
        token_links.KEY, "doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"))
    return found.with_contributions(rows).drop(token_links.KEY)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's ids written to files in document order, and what the files hold."""
    import public_tokenizers

    encoder = token_files.word_encoder(spark, public_tokenizers.path("word_bpe_49k.json"))
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), Staging(spark).path("tokens")
    token_files.write_tokens(docs, path, encoder)
    stored = token_files.TokenFiles(spark, path).documents()
    return token_files.with_checksum(stored, "ids_crc32").select("doc_id", "start", "n_tokens", "ids_crc32")


def op13_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its positives."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", flipped)
    return hard_negatives.mine_negatives(vectors, F.col("vec_id") % 100 == 0, Staging(spark)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES: dict[str, Query] = {
    "op1_bk_trees": op1_bk_trees,
    "op2_e8_lattice": op2_e8_lattice,
    "op3_fm_index": op3_fm_index,
    "op4_quotation_links": op4_quotation_links,
    "op5_string_kernel": op5_string_kernel,
    "op6_patience_lines": op6_patience_lines,
    "op7_masked_window": op7_masked_window,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_text_density": op9_text_density,
    "op10_licence_scan": op10_licence_scan,
    "op11_spilled_links": op11_spilled_links,
    "op12_token_files": op12_token_files,
    "op13_slot_negatives": op13_slot_negatives,
}

#: DuckDB SQL of those that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_quotation_links": r"""WITH RECURSIVE
  n AS (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)),
          lambda x: trim(lower(regexp_replace(x, '\s+', ' ', 'g')))), lambda x: x <> '') AS lines FROM conversations),
  s AS (SELECT conv_id, turn, unnest(list_append(lines, array_to_string(lines, chr(10)))) AS said FROM n),
  f AS (SELECT conv_id, said, min(turn) AS to_turn FROM s GROUP BY conv_id, said),
  q AS (SELECT n.conv_id, n.turn + level AS turn, level, array_to_string(lines, chr(10)) AS said
        FROM n, (VALUES (1), (2)) AS v(level)
        WHERE len(lines) > 0 AND EXISTS (FROM n AS own WHERE own.conv_id = n.conv_id AND own.turn = n.turn + level)),
  r AS (SELECT conv_id, turn, arg_min(to_turn, level) AS to_turn, count(*) AS n_quotes
        FROM q JOIN f USING (conv_id, said) GROUP BY conv_id, turn),
  t AS (SELECT conv_id, turn, turn AS thread_turn, CAST(0 AS BIGINT) AS depth FROM n ANTI JOIN r USING (conv_id, turn)
        UNION ALL SELECT r.conv_id, r.turn, t.thread_turn, t.depth + 1
        FROM t JOIN r ON r.conv_id = t.conv_id AND r.to_turn = t.turn)
  SELECT c.conv_id, c.turn, role, regexp_replace(text, '^(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+$', '', 'g') AS own_text,
    coalesce(n_quotes, 0) AS n_quotes, coalesce(n_quotes, 0) AS n_linked,
    CASE WHEN to_turn IS NOT NULL THEN c.conv_id END AS to_conv, to_turn, t.conv_id AS thread_conv, thread_turn, depth
  FROM conversations c JOIN t ON c.conv_id = t.conv_id AND c.turn = t.turn
    LEFT JOIN r ON c.conv_id = r.conv_id AND c.turn = r.turn""",
    "op13_slot_negatives": """WITH
  v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_dot_product(a.c, v.c) AS BIGINT) AS score
        FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
  n AS (SELECT p.*, vec_id AS negative_id, score AS negative_score,
          row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
          AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
  SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
  FROM n WHERE place <= 10""",
}
