"""The encoder leaves the settings of the session that asks it alone."""

from farelens.llm import registry, sentencepieces

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def test_other_queries_do_not_get_the_encoders_setting(spark):
    before = spark.conf.get(CO_PARTITION, "true")
    spark.conf.set(CO_PARTITION, "true")
    try:
        docs = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
        found = sentencepieces.encode(docs, sentencepieces.read_model(registry.PIECE_BPE))
        assert {r.doc_id: r.round_trip for r in found.collect()} == {1: True, 2: True}
        assert spark.conf.get(CO_PARTITION) == "true"
    finally:
        spark.conf.set(CO_PARTITION, before)
