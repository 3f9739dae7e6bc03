"""Registered queries against their SQL; ``tests/compare.py`` runs all of them."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, duck

SOME = [
    "src5_save_vectors_and_labels", "ext1_tokenize_sources", "ext2_extract_functions",
    "ext3_function_name", "ext12_control_flow_elements", "ext13_call_names",
    "ext14_feature_struct", "ext15_functions_per_file", "lab1_signal_table",
    "lab2_deterministic_side_effects", "lab2_side_effects_from_table", "lab6_parse_effects_reply",
    "lab5_prompts", "lab7_enrich", "lab_label_functions", "emb2_hash_embed", "fus3_apply_scaler", "fus4_fuse", "cls3_split",
    "cls6_classification_report", "cls2_label_distribution", "ret2_top_k_neighbours", "ret5_relevant_count", "ret7_retrieval_report",
    "ret9_worst_query", "clu4_cluster_profile", "clu6_misfits", "rep1_histogram", "rep2_describe",
    "sco1_score_sources", "sco2_score_stream", "sco3_compare_rule_and_model",
]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, sf, con, name):
    ok, text = check(spark, con, sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, sf):
    rows = entry.entry(spark).collect()
    assert {r.label for r in rows} == {"hardware", "io", "memory", "none"}
