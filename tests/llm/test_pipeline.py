import corpus_pipeline
from tributary.llm.queries import QUERIES


def test_all_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_stages_chain(spark, docs):
    now, names = docs, docs.columns
    for label, step in corpus_pipeline.STAGES[:-1]:
        before = now.count()
        now = step(spark, now, "/root/testdata/sf0.001").cache()
        assert now.columns == names, label
        assert label.startswith("mixing") or now.count() <= before
        assert now.count() > 0.5 * before or label.startswith("mixing")
    last = corpus_pipeline.STAGES[-1][1](spark, now, "/root/testdata/sf0.001")
    assert last.count() == now.count()
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == last.count()


def test_entry_lists_them():
    import __spark_entry__ as e

    assert "pipeline" in e.queries() and set(QUERIES) <= set(e.queries())
