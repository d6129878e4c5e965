from gleanery.operators.outliers import assign, standardize
from gleanery.operators.tokens import tokenize_pattern

STATS = {"mean_x": 1.0, "std_x": 2.0}


def test_row_local_operators_accept_a_stream(spark, tmp_path):
    spark.createDataFrame([(1, 3.0, "serious matter"), (2, -5.0, "matter")], "doc_id long, x double, text string").write.parquet(
        str(tmp_path / "in")
    )
    stream = spark.readStream.schema("doc_id long, x double, text string").parquet(str(tmp_path / "in"))
    scored = assign(standardize(stream, ["x"], STATS), ["z_x"], [[0.0], [-3.0]])
    query = (
        tokenize_pattern(scored, ["matter"])
        .writeStream.format("memory").queryName("marked")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.processAllAvailable()
    query.stop()
    rows = {r.doc_id: (r.cluster, r.distance, r.tokens) for r in spark.table("marked").collect()}
    assert rows == {1: (0, 1.0, ["serious"]), 2: (1, 0.0, [])}
