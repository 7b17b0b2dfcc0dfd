
from canopy.plans.fixtures import fixture_d
from canopy.plans.end_to_end import binned_sides, train_tree
from canopy.streaming import predict_stream, running_error

from .conftest import SF001


def test_streaming_predictions_equal_batch(spark, tmp_path):
    s = binned_sides(fixture_d(spark, SF001))
    tree = train_tree(s)
    batch = {r.doc_id: r.prediction for r in __import__("canopy").predict(s.test, tree).collect()}

    src = tmp_path / "in"
    src.mkdir()
    s.test.drop("review_body").write.parquet(str(src / "part"))
    stream = spark.readStream.schema(s.test.drop("review_body").schema).parquet(str(src / "part"))
    predicted = predict_stream(stream, tree, cuts=s.test_cuts)
    q = predicted.writeStream.format("memory").queryName("canopy_pred").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.doc_id: r.prediction for r in spark.sql("SELECT doc_id, prediction FROM canopy_pred").collect()}
    assert got == batch

    agg = running_error(predict_stream(spark.readStream.schema(s.test.drop("review_body").schema).parquet(str(src / "part")), tree, cuts=s.test_cuts))
    q2 = agg.writeStream.format("memory").queryName("canopy_err").outputMode("complete").start()
    q2.processAllAvailable()
    q2.stop()
    row = spark.sql("SELECT * FROM canopy_err").first()
    assert row.n_rows == len(batch)
