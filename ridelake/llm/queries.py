"""The operators of this subpackage as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.token_files import read_tokens, token_digests, tokens_to_files

    path = tokens_to_files(_table(spark, sf_dir, "documents"), tokenizer_path())
    return token_digests(read_tokens(spark, path))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.lines import remove_repeated_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    return remove_repeated_lines(docs).select("doc_id", F.col("n_lines").cast("long"), "text")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.language import identify

    return identify(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.decontaminate import report

    return report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.pii import digests, find

    return digests(find(_table(spark, sf_dir, "documents")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.bpe import digests

    return digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.common import in_fold
    from ridelake.llm.hmm import score_texts

    return score_texts(_table(spark, sf_dir, "documents"), in_fold(F.col("doc_id"), 7, 2))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.hard_negatives import hard_negatives, quantised

    rows = quantised(_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ridelake.llm.prefix_trie import conversations, rebuilt, trie

    convs = conversations(_table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    heads = F.crc32(conv.cast("string").cast("binary")) % 4
    return trie(rebuilt(convs, conv - conv % 20, heads, 3))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_lines": op3_lines,
    "op4_quality": op4_quality,
    "op5_neighbours": op5_neighbours,
    "op6_language": op6_language,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_personal_data": op9_personal_data,
    "op10_bpe": op10_bpe,
    "op11_hidden_markov": op11_hidden_markov,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op3_lines": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM documents
        ), windows AS (
            SELECT doc_id, pos,
                   [line, lead(line, 1) OVER w, lead(line, 2) OVER w] AS three,
                   lead(pos, 2) OVER w AS last
            FROM lines
            WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
        ), placed AS (
            SELECT *, row_number() OVER w AS n,
                   first_value(doc_id) OVER w AS first_doc, first_value(pos) OVER w AS first_pos
            FROM windows
            WHERE last IS NOT NULL
            WINDOW w AS (PARTITION BY three ORDER BY doc_id, pos)
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(
                CASE WHEN doc_id = first_doc THEN greatest(pos, first_pos + 3) ELSE pos END, last + 1)) AS pos
            FROM placed
            WHERE n > 1
        ), kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
            FROM lines ANTI JOIN gone USING (doc_id, pos)
            GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines, coalesce(kept.text, '') AS text
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
                   list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
    """,
    "op13_prefix_trie": """
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
            FROM conversations
            WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
                list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                lambda crc, byte: list_reduce(
                    [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
            )) % 4 AS h
            FROM own
        ), parts AS (
            SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
            UNION ALL
            SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND pos > h
        ), prefixes AS (
            SELECT conv_id, row_number() OVER w AS depth,
                   md5(string_agg(md5(concat(length(role), ':', role, text)), ',') OVER w) AS node,
                   len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
            FROM parts
            WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
            UNION ALL
            SELECT conv_id, 0, 'root', 0 FROM convs
        ), nodes AS (
            SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved
            FROM prefixes
            GROUP BY node, depth
        ), linked AS (
            SELECT n.*, p.node AS parent
            FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
        ), counted AS (
            SELECT l.*, coalesce(c.n, 0) AS n_children
            FROM linked l LEFT JOIN (SELECT parent, count(*) AS n FROM linked GROUP BY parent) c ON c.parent = l.node
        ), totals AS (
            SELECT a.node, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM counted u JOIN prefixes a ON a.conv_id = u.conv_id AND a.depth <= u.depth
            GROUP BY a.node
        ), ended AS (
            SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
            FROM (SELECT conv_id, arg_max(node, depth) AS node FROM prefixes GROUP BY conv_id)
            GROUP BY node
        )
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens,
               coalesce(ends_sha256, sha256('')) AS ends_sha256
        FROM counted c LEFT JOIN nodes p ON p.node = c.parent JOIN totals t ON t.node = c.node LEFT JOIN ended e ON e.node = c.node
    """,
}
