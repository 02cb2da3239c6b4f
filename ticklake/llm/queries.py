"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import bpe, conversation_repair, decontaminate, exact_dedup, language_id, license_scan, near_dedup
from ticklake.llm import pii, ranked_search, token_counts, token_files, toxicity, warc
from ticklake.llm.common import crc32_of, table


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a similarity of 0.85 of their three-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=85)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of byte-equal texts, the row with the largest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as files and read back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.write_and_read(table(spark, sf_dir, "documents"), path, end_id=1)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    return warc.archive_and_read(table(spark, sf_dir, "pages")).filter(
        "record_type IN ('response', 'revisit')"
    ).select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned without the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs.filter(language_id.learnable(docs)))
    found = language_id.predictor(language_id.share(docs, model), F.col("text"))
    return docs.select(
        "doc_id", (crc32_of() % 3 == 1).alias("held_out"), found.alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the piece vocabulary."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is toxic, learned without the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(crc32_of() % 5 != 0))
    score = toxicity.score(toxicity.share(docs, model), F.col("text"))
    return docs.select("doc_id", (crc32_of() % 5 == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-end vocabulary."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row per document and item."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by hash and repaired at least cost."""
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _plus(value: str, cost: int, letters: str) -> str:
    """SQL that adds cost and letters in front of a value: nine digits of cost, then letters."""
    return f"lpad((left({value}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letters}' || substr({value}, 10)"


def _repair_step() -> str:
    """The four values before a row from those after it, v0 to v3; x0 to x3 are without inserts."""
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    role = [2, 2, 3, 2]
    before = []
    for q in range(4):
        keep = " ".join(
            f"WHEN kind = '{r}' THEN " + _plus(f"v{to}", 0, "K") for r, to in kept[q].items()
        )
        paid = " ".join(
            f"WHEN kind = '{r}t' THEN " + _plus(f"v{to}", 5, "K") for r, to in kept[q].items()
        )
        before.append(
            f"least({_plus(f'v{q}', 2, 'D')}, CASE {keep} {paid} END, "
            f"CASE WHEN kind = 'x' THEN NULL WHEN kind LIKE '%t' THEN {_plus(f'v{role[q]}', 6, 'R')} "
            f"ELSE {_plus(f'v{role[q]}', 1, 'R')} END) AS x{q}"
        )
    after = [
        f"least(x{q}, {_plus(f'x{role[q]}', 5, 'I')}, {_plus(f'x{role[role[q]]}', 10, 'II')}) AS v{q}" for q in range(4)
    ]
    return f"""
        SELECT conv_id, n, {", ".join(after)}
        FROM (SELECT r.conv_id, r.n, {", ".join(before)}
              FROM solved s JOIN said r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.n = s.n - 1)
    """


_REPAIR_SQL = rf"""
    WITH RECURSIVE crc AS (
        SELECT list(list_reduce([n::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY n) AS t
        FROM range(256) AS r(n)),
    fates AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
                       string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                       lambda x: ascii(x)::UBIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])),
                   4294967295) % 20 AS fate
        FROM conversations, crc),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM fates, (VALUES (1), (2)) AS copies(copy) WHERE fate <> 0 AND (copy = 1 OR fate = 3)),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n
        FROM damaged),
    faulty AS (
        SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS seen,
               NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
        FROM ordered),
    said AS (
        SELECT *, CASE WHEN blank OR seen THEN 'x' ELSE left(role, 1) || CASE WHEN cut THEN 't' ELSE '' END END AS kind
        FROM faulty),
    totals AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
               count(*) FILTER (cut AND NOT seen AND NOT blank) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
        FROM said GROUP BY conv_id),
    solved AS (
        SELECT conv_id, rows + 1 AS n, '000000000' AS v0, '000000010II' AS v1, '000000005I' AS v2, '000000000' AS v3
        FROM totals
        UNION ALL {_repair_step()}),
    audits AS (
        SELECT conv_id, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM solved WHERE n = 1),
    letters AS (
        SELECT conv_id, letter, place, length(audit) - length(replace(audit, 'D', '')) AS deleted, length(audit) AS edits,
               CASE WHEN letter <> 'I' THEN length(replace(left(audit, place), 'I', '')) END AS n,
               length(replace(left(audit, place - 1), 'D', '')) AS written
        FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS place,
                     unnest(string_split(audit, '')) AS letter FROM audits WHERE audit <> '')),
    repaired AS (
        SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY place)) AS repaired_sha256
        FROM (SELECT l.conv_id, l.place, CASE WHEN letter = 'I' THEN '' ELSE s.text END AS text,
                     CASE WHEN letter = 'K' THEN s.role
                          WHEN (written - (edits - deleted) % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role
              FROM letters l LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM l.conv_id AND s.n = l.n
              WHERE letter <> 'D')
        GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_warc": op2_warc,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_bpe_encode_decode": op9_bpe_encode_decode,
    "op10_decontaminate": op10_decontaminate,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_license_scan": op12_license_scan,
    "op13_ranked_search": op13_ranked_search,
}

SQL = {
    "op2_warc": """
        SELECT page_id, octet_length(data) AS payload_bytes, payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM (SELECT *, CASE WHEN octet_length(data) >= 100
                             THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
              FROM (SELECT page_id, encode(coalesce(html, '')) AS data,
                           sha256(coalesce(html, '')) AS payload_digest FROM pages))
    """,
    "op6_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                     sha256(coalesce(text, '')) AS text_sha256
              FROM documents WINDOW same AS (PARTITION BY coalesce(text, '')))
    """,
    "op11_conversation_repair": _REPAIR_SQL,
    "op13_ranked_search": r"""
        WITH doc_terms AS (
            SELECT row, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM (SELECT doc_id, row_number() OVER () AS row,
                         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
                  FROM documents)),
        lengths AS (SELECT row, doc_id, len(terms)::HUGEINT AS n FROM doc_terms WHERE len(terms) > 0),
        corpus AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM lengths),
        item_terms AS (
            SELECT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        counts AS (
            SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM doc_terms)
            WHERE term IN (SELECT term FROM item_terms) GROUP BY row, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), corpus),
        scores AS (
            SELECT item_id, doc_id, row,
                   sum(w * times * ((1000000000 * tf)
                       // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))::BIGINT)::BIGINT AS score
            FROM (SELECT item_id, term, count(*) AS times FROM item_terms GROUP BY item_id, term)
            JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row), corpus
            GROUP BY item_id, doc_id, row)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
              FROM scores WHERE score > 0)
        WHERE rank <= 10
    """,
}
