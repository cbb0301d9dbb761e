"""Helpers that several training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of ids and hashes are broadcast up to so many rows (under 100 MB in memory), and joined by shuffle beyond that.
BROADCAST_ROWS = 1_000_000
#: Rows are handed back to Spark in batches of about so many bytes.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one where unset and all runs on one machine (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(where)
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: a lineage cut that outlives any executor."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join of which neither side may be broadcast: Spark takes a table to be no larger after an explode than before."""
    return df.hint("merge")


def sent_if_small(df: DataFrame) -> DataFrame:
    """A written table of two or three numbers a row, marked for broadcast where a count shows that it is small, and never broadcast otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else shuffled(df)


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """make(), which the worker holds for its later tasks of that key. What it held under another key goes first."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """For the start of tasks that need memory of their own: what the worker holds for another operator's tasks goes."""
    if _held:
        _held.clear()
        gc.collect()  # a tokenizer and its words refer to each other
    pa.default_memory_pool().release_unused()


def flushed(rows: Iterable[tuple], schema: pa.Schema, weigh: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Batches of rows, cut whenever their weight in bytes passes BATCH_BYTES."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += weigh(row) + 64
        if total > BATCH_BYTES or len(held) >= 10_000:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def valid_vector(v: Column) -> Column:
    """True where a vector is not null, not empty and all components are finite numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def private(name: str) -> str:
    """A column name that no caller's column can have."""
    return f"_{name}_{uuid.uuid4().hex}"


def comparable(df: DataFrame, column: str) -> Column:
    """A column as a value that can be hashed and ordered: what holds maps becomes JSON."""
    return F.to_json(F.struct(F.col(column))) if "map<" in df.schema[column].dataType.simpleString() else F.col(column)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value made once. A lambda makes what it refers to anew at each call, if that is not a variable."""
    return F.get(F.transform(F.array(value), use), 0)


#: Elements of a piece in `running`, and code points of a piece of a text in `pieces`.
PIECE = 64


def running(values: Column, op: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element of an int array, op over all elements before it; op is associative and zero its neutral element.

    A fold that appends to an array copies it at each step. Here folds run over pieces of PIECE elements, and over the pieces'
    totals, so the work grows with the array and not with its square.
    """

    def scan(xs: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, begin, lambda a, x: F.struct(op(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def by_pieces(values: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(PIECE)), lambda i: F.slice(values, i, F.lit(PIECE)))
        totals = lambda cut: F.transform(cut, lambda xs: F.aggregate(xs, zero, op))
        return let(cut, lambda cut: F.flatten(F.zip_with(cut, scan(totals(cut), zero), scan)))

    return let(values, lambda v: F.when(F.size(v) <= PIECE, scan(v, zero)).otherwise(by_pieces(v)))


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b, F.lit(0))


def running_max(values: Column) -> Column:
    """Values are at least -1, which stands for none."""
    return running(values, lambda a, b: F.greatest(a, b), F.lit(-1))


def pieces(text: Column) -> Column:
    """A text in pieces of PIECE code points, so that places far from its start are found at once."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut_out(of: Column, start: Column, end: Column) -> Column:
    """The code points from start to end (exclusive) of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(of, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
    return F.substr(F.array_join(some, ""), start - first * PIECE + 1, end - start)


def places(text: Column, regex: Column, measure: Callable[[Column], Column] = F.length) -> Column:
    """Leftmost matches of a regex that do not overlap: array of start, end, match. measure gives the length of a piece as an int."""
    found = lambda m: F.zip_with(F.slice(F.split(text, regex, -1), 1, F.size(m)), m, lambda b, m: F.struct(measure(b).alias("skip"), measure(m).alias("n"), m.alias("match")))
    steps = let(F.regexp_extract_all(text, regex, F.lit(0)), found)
    at = lambda b, s: F.struct((b + s["skip"]).alias("start"), (b + s["skip"] + s["n"]).alias("end"), s["match"].alias("match"))
    return let(steps, lambda steps: F.zip_with(running_sum(F.transform(steps, lambda s: s["skip"] + s["n"])), steps, at))
