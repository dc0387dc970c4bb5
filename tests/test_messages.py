import datetime as dt
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.plans.messages import decode_messages, encode_messages
from sluice.schemas import LOAN_MESSAGE
from sluice.sources.files import kafka_options
from sluice.streaming.messages import decode_stream, envelope_file_stream, run_available_now, run_to_memory

TS = dt.datetime(2024, 1, 1, 12, 0)


def _envelope(spark, values):
    return spark.createDataFrame(
        [(None if v is None else bytearray(v.encode()), TS) for v in values], "value binary, timestamp timestamp"
    )


def test_encode_then_decode_roundtrip(spark):
    rows = spark.createDataFrame([Row(loan_id=1, borrower="Ann", amount=500000, status="active"),
                                  Row(loan_id=2, borrower="Bo", amount=250000, status="paid")],
                                 "loan_id int, borrower string, amount bigint, status string")
    env = encode_messages(rows).withColumn("timestamp", F.lit(TS))
    out = sorted(tuple(r)[:4] for r in decode_messages(env).collect())
    assert out == [(1, "Ann", 500000, "active"), (2, "Bo", 250000, "paid")]


def test_decode_edge_cases(spark):
    values = ["not json", "null", "[1,2]", None, '{"borrower":"x"}', '{"loan_id":"7"}',
              '{"loan_id":8,"amount":1.5,"status":"s"}', '{"loan_id":9,"borrower":"b","amount":3,"status":"ok","extra":1}']
    out = {r["loan_id"]: r for r in decode_messages(_envelope(spark, values)).collect()}
    assert set(out) == {8, 9}
    assert out[8]["amount"] is None
    assert (out[9]["borrower"], out[9]["amount"], out[9]["status"]) == ("b", 3, "ok")
    assert decode_messages(_envelope(spark, values)).columns == ["loan_id", "borrower", "amount", "status", "timestamp"]


def test_batch_equals_stream_and_restart(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ckpt"))
    first = ['{"loan_id":1,"status":"a"}', "junk", '{"loan_id":2,"status":"b"}']
    _envelope(spark, first).write.mode("append").parquet(src)
    run_available_now(decode_stream(envelope_file_stream(spark, src)), sink, ckpt)
    batch = decode_messages(spark.read.parquet(src))
    assert sorted(spark.read.parquet(sink).collect()) == sorted(batch.collect())
    # restart with the same checkpoint and no new input: nothing new is emitted
    run_available_now(decode_stream(envelope_file_stream(spark, src)), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    # one more file: only its rows are added
    _envelope(spark, ['{"loan_id":3,"status":"c"}']).write.mode("append").parquet(src)
    run_available_now(decode_stream(envelope_file_stream(spark, src)), sink, ckpt)
    assert sorted(r["loan_id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_memory_sink_named_table(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _envelope(spark, ['{"loan_id":5}', "x"]).write.parquet(src)
    q = run_to_memory(decode_stream(envelope_file_stream(spark, src)), "loans_stream_test")
    assert [r["loan_id"] for r in spark.table("loans_stream_test").collect()] == [5]
    q.stop()


def test_kafka_options_are_pass_through():
    o = kafka_options("broker:9091", "topic-a", security={"security.protocol": "SASL_SSL"})
    assert o == {"kafka.bootstrap.servers": "broker:9091", "subscribe": "topic-a", "startingOffsets": "earliest",
                 "kafka.security.protocol": "SASL_SSL"}
    w = kafka_options("broker:9091", "topic-a", for_write=True)
    assert w["topic"] == "topic-a" and "subscribe" not in w
    assert LOAN_MESSAGE.names == ["loan_id", "borrower", "amount", "status"]
