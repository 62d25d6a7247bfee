"""The registered text queries: names, schemas, SQL twins, and whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from paylens.llm import registry

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op2": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double",
    "op3": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    "spans string",
    "op4": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op5": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op6": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double",
    "op8": "doc_id bigint, item_id bigint",
    "op9": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op11": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint",
    "op12": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op13": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string",
}


def test_all_are_registered():
    assert {name.split("_")[0] for name in registry.queries()} == set(COLUMNS)
    assert {*registry.queries(), "pipeline"} <= set(queries())
    assert set(registry.oracle_sql()) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_whole_table(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    wanted = COLUMNS[name.split("_")[0]].split(", ")
    assert [f"{c} {t}" for c, t in df.dtypes][: len(wanted)] == wanted
    rows = df.collect()
    total = duck.execute("SELECT COUNT(*) FROM documents").fetchone()[0]
    if name.startswith(("op11", "op12")):
        total = duck.execute("SELECT COUNT(DISTINCT conv_id) FROM conversations").fetchone()[0]
        total += name.startswith("op11")  # and the conversation that the query adds
    assert len(rows) == total or name.startswith("op8")
    if name in registry.oracle_sql():
        theirs = duck.execute(registry.oracle_sql()[name])
        names = [d[0] for d in theirs.description]
        assert sorted(tuple(r[c] for c in names) for r in rows) == sorted(theirs.fetchall())
