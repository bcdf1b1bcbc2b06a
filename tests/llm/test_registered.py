"""The entry point's guard hides no broken operator."""


def test_every_corpus_query_is_registered():
    import __spark_entry__ as contract
    import corpus_pipeline
    from ledgerline.llm.catalog import ORACLE, QUERIES

    names = contract.queries()
    assert len(QUERIES) == 13 and {*QUERIES, "pipeline"} <= set(names)
    assert set(ORACLE) <= set(contract.oracle_sql())
    assert names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
