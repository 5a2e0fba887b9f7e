"""Running sums over sorted rows that no single task has to see: also where one key has nearly all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.shipping import ship
from tapeloom.work import written

ship(__name__)


def running_sum(rows: DataFrame, key: str, order: list[str], weight: str, name: str = "upto") -> DataFrame:
    """Rows with ``name``, the sum of ``weight`` over the rows of the same ``key`` up to and with this one in ``order``. Keys are not null.

    Rows are sorted over all partitions, by ranges of key and order, and written with the sums within each
    partition. What a partition lacks is the sum over earlier partitions for its first key alone: one row for
    each partition.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, last, carry = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(key).to_pandas()
            sums = b.column(weight).to_pandas().groupby(keys, sort=False).cumsum()
            sums[keys == last] += carry
            last, carry = keys.iloc[-1], int(sums.iloc[-1])
            more = [pa.array(sums, pa.int64()), pa.array([part] * b.num_rows, pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, name, "_part"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{name}` long, _part int"
    sorted_rows = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    local = written(sorted_rows.mapInArrow(run, schema))
    totals = local.groupBy("_part", key).agg(F.max(name).alias("total"))
    before = F.sum("total").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # Only keys that go on from one partition to the next have a sum before: at most one in each partition.
    offsets = totals.withColumn("before", before).where("before is not null").select("_part", key, "before")
    return local.join(F.broadcast(offsets), ["_part", key], "left").withColumn(name, F.col(name) + F.coalesce("before", F.lit(0))).drop("_part", "before")
