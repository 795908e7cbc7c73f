"""Rows that cross a shuffle in compressed blocks.

The shuffle compresses rows as they come, those of all kinds of values mixed and without coding frequent bytes shorter;
wide rows keep a third of their size. Here a task gathers rows up to ``GATHERED`` bytes, deals them by the columns that
the shuffle deals by, and compresses the rows of one value of these together. Each block is one row of the shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

# Tasks get these functions by value: executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of rows that a task gathers before it makes blocks of them: its memory, whatever the input.
GATHERED = 64 << 20
# Bytes of rows that leave a task together when blocks are opened.
OPENED = 4 << 20
CODEC, LEVEL = "zstd", 6

_KEYS = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType, T.DateType)
_VALUES = (*_KEYS, T.BinaryType, T.FloatType, T.DoubleType, T.DecimalType, T.TimestampType, T.TimestampNTZType)


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of at least ``least`` bytes, and the rest."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def make_blocks(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One row (keys, size, block) for the gathered rows of each value of ``keys``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    codec = pa.Codec(CODEC, LEVEL)
    for table in gathered(batches, GATHERED):
        code = np.zeros(table.num_rows, np.int64)
        for k in keys:
            found = pc.dictionary_encode(table[k].combine_chunks(), null_encoding="encode")
            at = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
            # Numbered anew each time, so that many columns do not exceed a long.
            code = np.unique(code * len(at.dictionary) + at.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
        dealt = table.take(pa.array(order)).combine_chunks()
        sizes, blocks = [], []
        for start, end in zip(starts, [*starts[1:], len(order)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, dealt.schema) as out:
                out.write_table(dealt.slice(start, end - start))
            raw = sink.getvalue()
            sizes.append(raw.size)
            blocks.append(codec.compress(raw, asbytes=True))
        first = dealt.select(list(keys)).take(pa.array(starts)).combine_chunks()
        columns = [first[k].chunk(0) for k in keys]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(blocks, pa.binary())],
                                         names=[*keys, "_size", "_block"])


def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow as pa

    codec = pa.Codec(CODEC, LEVEL)

    def rows() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, block in zip(batch.column("_size"), batch.column("_block")):
                yield from pa.ipc.open_stream(codec.decompress(block.as_buffer(), size.as_py()))

    for table in gathered(rows(), OPENED):
        yield from table.to_batches()


def in_blocks(df: DataFrame, keys: Sequence[str], exchange: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``exchange``, which deals by ``keys``, over blocks of rows; every row comes back as it was.

    Rows with types that blocks do not hold, or dealt by other than texts, whole numbers and dates, cross as they are;
    so do all where Arrow is missing."""
    try:
        import pyarrow  # noqa: F401
    except ImportError:
        return exchange(df)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not all(isinstance(k, _VALUES) for k in kinds.values()) or not all(isinstance(kinds[k], _KEYS) for k in keys):
        return exchange(df)
    held = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], T.StructField("_size", T.LongType()), T.StructField("_block", T.BinaryType())])
    dealt = exchange(df.mapInArrow(lambda batches: make_blocks(batches, list(keys)), held))
    rows = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return dealt.mapInArrow(open_blocks, rows)
