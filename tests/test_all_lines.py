from tintwell.plans import catalog


def test_every_line_gives_codes(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_suppkey % 50 AS image_id", "CAST(CAST(l_quantity AS INT) AS STRING) AS code").distinct().count()
    assert catalog.QUERIES["token_entity_resolve_all"](spark, sf_dir).count() == lines
