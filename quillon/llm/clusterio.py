"""Planning helpers: input size, size-checked broadcast, shared checkpoints."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which a side of a join may be broadcast, as rows of a hash table.
BROADCAST_BYTES = 64 << 20
#: What a row takes beside its values, and what a value of fixed length takes.
ROW_BYTES, VALUE_BYTES = 48, 8
#: Partial sums that one task adds up.
FAN_IN = 64
CHUNK_BYTES = 8 << 20
MIN_CHUNKS = 64


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; one of our own is set
    only where that is unset and all runs in this process, as in local tests.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if where is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="quillon-checkpoint-"))
    return df.checkpoint()


#: Nodes of a plan that give the same rows in the same order and split at every read.
_STEADY = {"Project", "Filter", "Relation", "LogicalRDD", "LocalRelation"}
_MIN_SPLITS = "spark.sql.files.minPartitionNum"


def steady(df: DataFrame) -> DataFrame:
    """``df`` such that every read of it gives the same rows in the same order and split.

    Files are split by the number of cores at the time of the read, which follows
    the live executors; where the session leaves that open, it is pinned to what it
    is now.  What comes out of anything but files, filters and projections, as of a
    shuffle, whose tasks may be run again in another order, is written first.
    """
    spark = df.sparkSession
    if spark.conf.get(_MIN_SPLITS, None) is None:
        spark.conf.set(_MIN_SPLITS, str(spark.sparkContext.defaultParallelism))
    nodes = re.findall(r"^[\s:+|!-]*'?(\w+)", df._jdf.queryExecution().optimizedPlan().toString(), re.MULTILINE)
    return df if set(nodes) <= _STEADY else checkpointed(df)


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value, long strings and arrays included."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(VALUE_BYTES)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType):
            return F.aggregate(F.coalesce(value, F.array().cast(kind)), F.lit(0).cast("long"), lambda n, x: n + _value_bytes(x, kind.elementType))
        width = len(kind.elementType.fields) + 2 if isinstance(kind.elementType, T.StructType) else 1
        return F.coalesce(F.size(value), F.lit(0)) * F.lit(VALUE_BYTES * width) + F.lit(16)
    return F.lit(VALUE_BYTES)


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if a sum shows at most ``limit`` bytes.

    Above the limit the plain frame comes back and the join is by shuffle.  The
    frame is read for the sum: hand over what is checkpointed or cheap.
    """
    size = F.lit(ROW_BYTES).cast("long")
    for f in df.schema.fields:
        size = size + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    return F.broadcast(df) if total <= limit else df


def shielded(docs: DataFrame, used: tuple[str, ...], work: Callable[[DataFrame], DataFrame], added: tuple[str, ...] = ()) -> DataFrame:
    """``work`` on ``docs`` whose further columns bear neutral names meanwhile.

    Columns that the work makes can then clash with none; those in ``added`` are
    kept after the columns of ``docs``, which keep their order and names.  An
    added name that ``docs`` has already gets an underscore.
    """
    plain = {c: c if c in used else f"_further_{i}" for i, c in enumerate(docs.columns)}
    out = work(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in plain.items()]))
    own = [F.col(n).alias(c) for c, n in plain.items()]
    return out.select(*own, *[F.col(c).alias(c if c not in plain else f"{c}_") for c in added])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def chunk_count(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(MIN_CHUNKS, -(-total_bytes // chunk_bytes))


def dealt(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES, work: Callable | None = None, schema: str = "chunk long, rows binary") -> DataFrame:
    """(chunk, rows): runs of rows with about ``chunk_bytes`` of text, packed.

    Chunks are cut as the rows come, so none depends on a value that many rows
    share, and a third of equal rows spread like all others; a longer text is a
    chunk of its own.  A chunk's number is its partition's and its own there.
    What is asked of a chunk must fit what it is told later: rows have to come in
    the same order when they are read again (a table or a checkpoint does so).

    ``work`` (number, rows) -> batches of ``schema`` takes the place of packing;
    it runs where the chunk is cut and gives its memory back after each.
    """

    def packed(number: int, rows: pa.Table):
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))
        with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
            out.write_table(rows)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    of_chunk = work or packed

    def deal(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy()
            start = 0
            while start < batch.num_rows:
                total = size + np.cumsum(lengths[start:])
                n = max(int(np.searchsorted(total, chunk_bytes, side="right")), 0 if held else 1)
                if n:
                    held.append(batch.slice(start, n))
                    size = int(total[n - 1])
                    start += n
                if start < batch.num_rows:
                    rows, held, size = pa.Table.from_batches(held), [], 0
                    yield from of_chunk(number, rows)
                    number += 1
                    if work:
                        _give_back()
        if held:
            yield from of_chunk(number, pa.Table.from_batches(held))
            if work:
                _give_back()

    return docs.mapInArrow(deal, schema)


def unpacked(chunk: pa.Table) -> pa.Table:
    """The rows of a packed chunk."""
    with pa.ipc.open_stream(pa.py_buffer(chunk["rows"][0].as_py())) as stream:
        return stream.read_all()


def table(fields: dict[str, object], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(fields[f.name], type=f.type) for f in schema], schema=schema)


def summed_vectors(df: DataFrame, batch_vectors: Callable, length: int, slices: int = 16) -> np.ndarray:
    """Element-wise sum over all partitions of an int64 vector of ``length``.

    ``batch_vectors(batches)`` folds one partition into its vector.  Each
    partition sends ``slices`` compressed pieces; they are added on the
    executors slice by slice, ``FAN_IN`` partitions at a time, then as many of
    those sums, then the rest (a million partitions leave 245), and the driver
    gets ``8 * length`` bytes.
    """
    step = -(-length // slices)

    def send(batches):
        total = batch_vectors(batches)
        lot = TaskContext.get().partitionId() // FAN_IN
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(range(slices), pa.int32()),
                "lot": pa.array([lot] * slices, pa.int32()),
                "data": pa.array([pack(total[i * step : (i + 1) * step]) for i in range(slices)], pa.binary()),
            }
        )

    def add(group: pa.Table) -> pa.Table:
        total = 0
        for x in group["data"]:
            total = total + unpack(x.as_py(), np.int64)
        lot = group["lot"][0].as_py() // FAN_IN
        return pa.table({"slice": group["slice"][:1], "lot": pa.array([lot], pa.int32()), "data": pa.array([pack(total)], pa.binary())})

    schema = "slice int, lot int, data binary"
    sent = df.mapInArrow(send, schema)
    for keys in (("slice", "lot"), ("slice", "lot"), ("slice",)):
        sent = sent.groupBy(*keys).applyInArrow(add, schema)
    out = np.zeros(length, np.int64)
    for r in sent.collect():
        part = unpack(bytes(r["data"]), np.int64)
        out[r["slice"] * step : r["slice"] * step + len(part)] = part
    return out


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed, with a header of their length."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    return len(planes).to_bytes(8, "little") + bytes(pa.compress(planes, codec="zstd", asbytes=True))


def unpack(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    item = np.dtype(dtype).itemsize
    if not size:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(item, size // item).T).view(dtype).ravel()


def _give_back() -> None:
    """Returns freed memory of a Python worker to the system.

    Workers are reused from task to task; without this each keeps the largest
    chunk it has ever held.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(of_chunk: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The function of a group, giving back its memory when it is done."""

    def run(chunk: pa.Table) -> pa.Table:
        try:
            return of_chunk(chunk)
        finally:
            _give_back()

    return run


def lean_pair(of_chunks: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for a function of two cogroups."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return of_chunks(chunk, answers)
        finally:
            _give_back()

    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
