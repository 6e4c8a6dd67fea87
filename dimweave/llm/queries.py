"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import alignment, chat, html_text, lexical, line_dedup, mixing, neighbours, packing, quality, repeats, simhash, tiling, token_store
from dimweave.llm.common import materialize, new_folder, read, ship_code


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    folder = new_folder(spark, "tokens")
    token_store.write_store(docs, folder, tokenizer_path(), end_id=0)
    keys = docs.select("doc_id")
    rows = token_store.read_store(keys, folder, token_store.bucket_count(keys.count()))
    return rows.unionByName(token_store.read_unkeyed(spark, folder))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each leaked item of each document; clean documents give none."""
    return tiling.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), window=2048, end_id=1)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(quality.with_statistics(read(spark, sf_dir, "documents")), "statistics")
    return quality.scores(stats, quality.fit(stats, read(spark, sf_dir, "labels")))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"  # control strings as text
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], given.schema)
    written = materialize(chat.format_turns(given.union(extra)), "formatted")
    return chat.conversation_digests(chat.read_turns(written))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that are kept."""
    kept = line_dedup.remove_later_runs(read(spark, sf_dir, "documents"), short_times=line_dedup.SHORT_TIMES)
    return kept.select("row.doc_id", "n_lines", "n_removed", "text")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.statistics(read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q)
    for q in (op1_token_store, op2_decontamination, op3_packing, op4_quality, op5_html_text, op6_chat_format, op7_line_dedup, op8_neighbours,
              op9_repeated_bytes, op10_simhash, op11_source_mix, op12_token_alignment, op13_lexical_search)
}

ORACLE_SQL: dict[str, str] = {
    "op6_chat_format": r"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        escaped AS (
            SELECT *, CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + length(role) END
                + 2 * length(text) - length(replace(text, '\', ''))
                + length(regexp_replace(text, '(\[/?(SYS|INST|ROLE)\]|\[TEXT\]|</?s>)', '\1.', 'g')) - length(text) AS chars
            FROM given)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM escaped GROUP BY conv_id""",
    "op11_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS key
            FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM sized GROUP BY source),
        ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources),
        weighed AS (SELECT *, CAST((place - 1) % 3 + 1 AS HUGEINT) AS weight, CAST(source_size AS DOUBLE) / ((place - 1) % 3 + 1) AS level FROM ranked),
        levels AS (
            SELECT *, row_number() OVER (ORDER BY level, place) AS step,
                sum(source_size) OVER () - 3 * (sum(source_size) OVER (ORDER BY level, place ROWS UNBOUNDED PRECEDING) - source_size) AS left_over,
                sum(weight) OVER () - (sum(weight) OVER (ORDER BY level, place ROWS UNBOUNDED PRECEDING) - weight) AS weight_left
            FROM weighed),
        level AS (SELECT step, left_over, weight_left FROM levels WHERE left_over * weight <= 3 * source_size * weight_left ORDER BY step LIMIT 1),
        targets AS (
            SELECT l.source, l.source_size, CASE WHEN l.step < v.step THEN CAST(3 * l.source_size AS DOUBLE)
                ELSE CAST(l.weight * v.left_over AS DOUBLE) / CAST(v.weight_left AS DOUBLE) END AS target
            FROM levels l, level v),
        placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
        joined AS (
            SELECT p.doc_id, p.size, t.source_size, t.target, p.before, CAST(round(t.target) AS HUGEINT) AS budget,
                CASE WHEN t.source_size > 0 THEN CAST(round(t.target) AS HUGEINT) // t.source_size ELSE 0 END AS epochs
            FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
            CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
        FROM joined""",
    "op13_lexical_search": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS doc, doc_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        sizes AS (SELECT doc, doc_id, CAST(len(terms) AS HUGEINT) AS n FROM rows WHERE len(terms) > 0),
        whole AS (SELECT CAST(count(*) AS HUGEINT) AS n_docs, sum(n) AS n_terms FROM sizes),
        bags AS (SELECT doc, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc, unnest(terms) AS term FROM rows) GROUP BY doc, term),
        wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM bags, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term),
        classes AS (SELECT doc, doc_id, CAST(50 + (50 * n * n_docs) // n_terms AS BIGINT) AS m FROM sizes, whole),
        scored AS (
            SELECT item_id, doc, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM wanted JOIN weights USING (term) JOIN bags USING (term) JOIN classes USING (doc) GROUP BY item_id, doc),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
}
