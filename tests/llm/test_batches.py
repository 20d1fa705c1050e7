"""Arrow batches of texts are small unless the session sets a limit."""

import pyarrow as pa
from pyspark.sql import functions as F

from tillroll.llm.bpe_codec import BATCH_BYTES, BATCH_LIMIT, small_batches


def sizes(docs):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    return [r.n for r in docs.select("text").mapInArrow(run, "n long").collect()]


def test_batches_are_bounded_and_a_set_limit_stays(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    old = spark.conf.get(BATCH_LIMIT)
    try:
        spark.conf.unset(BATCH_LIMIT)
        assert max(sizes(small_batches(docs))) < 2 * BATCH_BYTES
        spark.conf.set(BATCH_LIMIT, str(32 << 20))
        assert max(sizes(small_batches(docs))) > 16 << 20
    finally:
        spark.conf.set(BATCH_LIMIT, old)
