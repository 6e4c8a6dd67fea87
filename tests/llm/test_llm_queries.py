"""Every registered query on the smallest tables: columns as promised, one row where one is due."""

import pytest

from dimweave.llm import queries
from dimweave.llm.common import read

COLUMNS = {
    "op1_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_decontamination": ["doc_id", "item_id", "coverage"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_quality": ["doc_id", "held_out", "score", "predicted"],
    "op5_html_text": ["page_id", "url", "text", "n_chars"],
    "op6_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op7_line_dedup": ["doc_id", "n_lines", "n_removed", "text"],
    "op8_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op9_repeated_bytes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    "op11_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_lexical_search": ["item_id", "rank", "doc_id", "score"],
}
PER_ROW = {"op1_token_store": "documents", "op4_quality": "documents", "op5_html_text": "pages", "op7_line_dedup": "documents",
           "op9_repeated_bytes": "documents", "op10_simhash": "documents",
           "op11_source_mix": "documents", "op12_token_alignment": "documents"}


def test_all_operators_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, sf_dir, name):
    rows = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert set(COLUMNS[name]) <= set(rows.columns)
    assert len(rows)
    if name in PER_ROW:
        key = COLUMNS[name][0]
        given = read(spark, sf_dir, PER_ROW[name]).select(key).toPandas()[key]
        assert sorted(rows[key]) == sorted(given)
    if name == "op3_packing":
        covered = rows.groupby("doc_id")["length"].sum()
        assert (covered == rows.groupby("doc_id")["doc_tokens"].first()).all()
    if name == "op6_chat_format":
        assert -1 in set(rows["conv_id"])
