import re
from pathlib import Path

from pyspark.sql import functions as F

import topicstream as ts

README = Path(__file__).resolve().parents[1] / "README.md"


def test_the_example_runs(spark, root):
    code = re.search(r"```python\n(.*?)```", README.read_text(), re.S).group(1).replace("hdfs:///topics", root)
    setup, start = code.split("query = ts.start_transfer")
    names = {"spark": spark}
    exec(setup, names)
    source = ts.open_topic(spark, root, "shop", "clicks")
    rows = spark.range(1000).select(
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
        F.col("id").cast("int").alias("age"),
        (F.col("id") % 2).cast("double").alias("money"),
        (F.col("id") + 1704067207179).cast("string").alias("createTime"),
    )
    records = ts.prepare_records(
        rows, source, ts.key_hash_selector("name"), definition=names["clicks"], event_time=F.current_timestamp()
    )
    ts.append_topic(records, source, producer="app")
    assert start.rstrip().endswith("}, job)")
    exec("query = ts.start_transfer" + start.replace("}, job)", "}, job, available_now=True)"), names)
    names["query"].awaitTermination()
    sink = ts.read_topic_batch(spark, ts.open_topic(spark, root, "shop", "checked"))
    found = sink.select("age", F.unix_micros("event_time").alias("us"), ts.attribute(ts.BIZ_KEY).alias("key")).collect()
    assert sorted(map(tuple, found)) == [(i, (i + 1704067207179) * 1000, f"n{i}") for i in range(1, 1000, 2)]
