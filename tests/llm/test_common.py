import pyarrow as pa

from wattmill.llm import common


def test_workers_get_batches_of_bounded_size(spark):
    common.ship(spark)
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('x', 1048576) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    found = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 40
    assert max(r.bytes for r in found) <= common.BATCH_BYTES + (2 << 20)
