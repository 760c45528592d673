import __spark_entry__ as entry

# Queries that SQL cannot express; their tests compare with brute force, the
# tokenizer library, exact round trips or held-out accuracy.
WITHOUT_SQL = {"op3_language_id", "op4_entropy_mix", "op5_token_counts", "op6_secret_scan", "op8_packing",
               "op9_quality_rules", "op10_suffix_dedup", "op13_toxicity", "pipeline"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 198     # 25-round windows at sf0.001
    assert df.columns[:3] == ["dg_id", "player_name", "ppi"]


def test_every_query_has_an_oracle_except_documented(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) == WITHOUT_SQL & set(q)
