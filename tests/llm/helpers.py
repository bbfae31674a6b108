import hashlib
from pathlib import Path

from pyspark.sql import types as T

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def sha(value) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def table(spark, name):
    return spark.read.parquet(str(Path("/root/testdata/sf0.001") / f"{name}.parquet"))


def whole(frame):
    return sorted(map(tuple, frame.collect()), key=repr)
