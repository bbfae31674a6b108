"""Arrow helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbstone.session import ship

#: Bytes of text handed to a function at once. A longer single text goes alone.
SLICE_BYTES = 2 << 20
#: Bytes of rows that Spark sends a worker at once, where the session allows more.
SENT_BYTES = 8 << 20


def send_less(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``SENT_BYTES``; a smaller setting stays.

    A batch is held several times over, by the executor and by its worker, for
    each task that runs at once.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if bytes_of(spark.conf.get(name)) > SENT_BYTES:
        spark.conf.set(name, str(SENT_BYTES))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``most`` bytes of ``column``."""
    if batch.num_rows == 0:
        return
    texts = batch.column(column)
    if pa.types.is_list(texts.type):
        lengths = pc.multiply(pc.list_value_length(texts), 4)
    else:
        lengths = pc.binary_length(texts)
    lengths = pc.fill_null(lengths, 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + most, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def with_text_columns(
    df: DataFrame,
    text: str,
    function: Callable[..., dict[str, list]],
    types: dict[str, T.DataType],
    keep: list[str] | None = None,
    also: tuple[str, ...] = (),
    raw: bool = False,
) -> DataFrame:
    """The columns ``keep`` of ``df`` and, of each text, what ``function`` finds.

    ``function`` takes a list of texts (null: empty), and one for each column
    ``also``, and returns a list for each column in ``types``; with ``raw`` it
    takes Arrow arrays as they are. A column of ``df`` with the name of a new one is
    replaced. Texts go through in parts of bounded size; nothing is shuffled.
    """
    ship(df.sparkSession)
    send_less(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c not in types]
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in types.items()]
    )
    arrow = to_arrow_schema(T.StructType([schema[n] for n in types]))
    sent = df.select(*[df[f"`{c}`"] for c in dict.fromkeys([*kept, text, *also])])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                if raw:
                    found = function(*[part.column(c) for c in (text, *also)])
                else:
                    texts = [t or "" for t in part.column(text).to_pylist()]
                    found = function(texts, *[part.column(c).to_pylist() for c in also])
                new = [
                    x.cast(f.type) if isinstance(x := found[f.name], pa.Array) else pa.array(x, f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + new, names=[*kept, *types]
                )

    return sent.mapInArrow(run, schema)
