from tintwell.llm import pii


def test_text_operators_without_shuffles_run_on_streams(spark, tmp_path):
    spark.createDataFrame([(1, "at 10.0.0.1"), (2, "clean")], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "in"))
    rows = []
    query = pii.pseudonymise(stream, b"k").writeStream.foreachBatch(lambda df, _: rows.extend(df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.doc_id, len(r.pii)) for r in rows) == [(1, 1), (2, 0)]
