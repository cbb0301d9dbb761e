"""Vectors packed into blocks, and blocks of queries paired with blocks of candidates.

A query set that grows with the data is never broadcast or collected. Queries and candidates are packed into blocks of bounded
size, dealt over a grid of groups, and each pair of groups meets in one place by an equality join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import shuffled

#: A component that scaling takes beyond the doubles is the largest of them.
LARGEST = np.finfo(np.float64).max
#: Blocks of queries that a place takes before candidates are sent to a second one.
BLOCKS_A_PLACE = 64
BLOCK = "block long, dim int, ids binary, data binary, low binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("low", pa.binary())])


def pack(vectors: DataFrame, rows: int, scale: float | None = None) -> DataFrame:
    """(id long, v array, low long) to blocks of at most `rows` vectors of one length: ids and low as int64, data by `_narrow`.

    scale: components become floor(scale * x). Vectors must be valid; see shared.valid_vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray], int]] = {}

        def block(dim: int, ids: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            nonlocal count
            count += 1
            data = np.clip(np.floor(data * scale), -LARGEST, LARGEST) if scale else data
            row = ([(part << 32) + count], [dim], [ids[:, 0].tobytes()], [_narrow(data).tobytes()], [ids[:, 1].tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SCHEMA, strict=True)], schema=_SCHEMA)

        for b in batches:
            lists = b.column(1)
            lengths, ids = lists.value_lengths().to_numpy(zero_copy_only=False), np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2)], axis=1)
            values, starts = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(lengths)[:-1]])
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                data = values[starts[at][:, None] + np.arange(dim)]
                a, v, n = held.pop(dim, ([], [], 0))
                a, v, n = [*a, ids[at]], [*v, data], n + len(at)
                if n >= rows:
                    all_ids, all_data = np.concatenate(a), np.concatenate(v)
                    for i in range(0, n - n % rows, rows):
                        yield block(dim, all_ids[i : i + rows], all_data[i : i + rows])
                    a, v, n = [all_ids[n - n % rows :]], [all_data[n - n % rows :]], n % rows
                held[dim] = (a, v, n)
        for dim, (a, v, n) in held.items():
            if n:
                yield block(dim, np.concatenate(a), np.concatenate(v))

    return vectors.select("id", "v", "low").mapInArrow(run, BLOCK)


def _narrow(data: np.ndarray) -> np.ndarray:
    """The same numbers as int16 or as float32 where one of them holds them all exactly."""
    with np.errstate(invalid="ignore", over="ignore"):
        for kind in (np.int16, np.float32):
            small = data.astype(kind)
            if (small == data).all():
                return small
    return data


def unpack(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 and vectors as float64."""
    of = np.frombuffer(ids, np.int64)
    kind = {2: np.int16, 4: np.float32, 8: np.float64}[len(data) // (len(of) * dim)]
    return of, np.frombuffer(data, kind).reshape(-1, dim).astype(np.float64)


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def paired(queries: DataFrame, candidates: DataFrame, query_blocks: int, groups: int) -> DataFrame:
    """Every block of queries beside every block of candidates: columns of queries with q_ before the name, and of candidates.

    Both frames have a column block. Candidates are heavy, so each is sent to one place for every BLOCKS_A_PLACE blocks of queries,
    mostly once; the light queries are sent to each of the `groups` places. These should be no more than the blocks of candidates, nor
    than the candidates are heavier than the queries, so that what is sent grows with the candidates. Each pair meets once, and no
    place has more than about BLOCKS_A_PLACE blocks of queries for a block of candidates.
    """
    query_groups = -(-query_blocks // BLOCKS_A_PLACE)
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    q = q.withColumn("_q", F.pmod(F.xxhash64("q_block"), F.lit(query_groups))).withColumn("_c", F.explode(_upto(groups)))
    c = candidates.withColumn("_c", F.pmod(F.xxhash64("block"), F.lit(groups))).withColumn("_q", F.explode(_upto(query_groups)))
    return c.join(shuffled(q), ["_c", "_q"]).drop("_c", "_q")
