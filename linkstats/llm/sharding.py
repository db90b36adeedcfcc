"""Sharding (operator 11) by a hypergeometric communication matrix.

A uniform shuffle with exact shard sizes. The rows lie in pieces (at most ``PIECE_ROWS``
neighbouring rows of one file), the shards are cut into blocks of exact size, and the matrix
says how many rows of each piece go to each block: its law is that of a uniform permutation
with those margins. It is never built as a whole: a piece's row of it is found on the way
from the root of a binary tree over the pieces to the piece, each step one multivariate
hypergeometric draw seeded by the step's place, so that all tasks that take the same step
draw the same numbers. A task permutes the destinations of its piece, the rows are exchanged
once, and every block is permuted again by random keys. The size of a block is known before
the exchange, so a row's slot is its block's first slot plus its place in the block.

Only the number of rows of each piece passes through the driver. A piece is named by its file
and row numbers and not by a task, so lost executors, other splits and reruns change nothing.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import ship, shuffle_width, table
from linkstats.session import materialize

PIECE_BITS = 20
PIECE_ROWS = 1 << PIECE_BITS
_NUMPY_LIMIT = 10 ** 9  # numpy's generator takes populations below this
_ROW = (1 << 33) - 1  # monotonically_increasing_id: partition above, row number in these bits


def _by_inversion(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One hypergeometric draw for populations of any size: the law's weights relative to
    its mode, over twelve deviations on both sides, inverted at a uniform number."""
    lowest, highest = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), lowest), highest)
    share = good / (good + bad)
    reach = int(12 * (n * share * (1 - share) * (1 - (n - 1) / (good + bad))) ** 0.5) + 32
    x = np.arange(max(lowest, mode - reach), min(highest, mode + reach) + 1, dtype=np.float64)
    step = np.log(good - x[:-1]) + np.log(n - x[:-1]) - np.log(x[1:]) - np.log(bad - n + x[1:])
    weight = np.concatenate([[0.0], np.cumsum(step)])
    total = np.cumsum(np.exp(weight - weight.max()))
    return int(x[np.searchsorted(total, rng.random() * total[-1], side="right")])


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many of ``n`` rows drawn from ``good + bad`` are good, element by element."""
    out = np.zeros(len(n), dtype=np.int64)
    drawn = n > 0
    small = drawn & (good < _NUMPY_LIMIT) & (bad < _NUMPY_LIMIT) & (good + bad < _NUMPY_LIMIT)
    out[small] = rng.hypergeometric(good[small], bad[small], n[small])
    for i in np.flatnonzero(drawn & ~small):
        out[i] = _by_inversion(rng, int(good[i]), int(bad[i]), int(n[i]))
    return out


def multivariate(rng: np.random.Generator, sizes: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows drawn from columns of these sizes each column gives: halves of
    the columns share the rows, then halves of the halves."""
    width = 1 << max(0, int(len(sizes) - 1).bit_length())
    levels = [np.concatenate([sizes, np.zeros(width - len(sizes), dtype=np.int64)])]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    take = np.array([n], dtype=np.int64)
    for level in reversed(levels[:-1]):
        left = hypergeometric(rng, level[0::2], level[1::2], take)
        take = np.stack([left, take - left], axis=1).ravel()
    return take[:len(sizes)]


class Matrix:
    """The communication matrix: ``pieces`` rows with these sums, ``columns`` with those."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, seed: int):
        self.until = np.concatenate([[0], np.cumsum(rows, dtype=np.int64)])
        self.columns, self.seed = columns, seed
        self._left = functools.lru_cache(maxsize=64)(self._draw_left)

    def _draw_left(self, first: int, last: int, whole: bytes) -> np.ndarray:
        rng = np.random.default_rng([self.seed, 1, first, last])
        middle = (first + last) // 2
        return multivariate(rng, np.frombuffer(whole, dtype=np.int64), int(self.until[middle] - self.until[first]))

    def row(self, piece: int) -> np.ndarray:
        """How many rows the piece sends to each column."""
        first, last, whole = 0, len(self.until) - 1, self.columns
        while last - first > 1:
            middle = (first + last) // 2
            left = self._left(first, last, whole.tobytes())
            first, last, whole = (first, middle, left) if piece < middle else (middle, last, whole - left)
        return whole

    def destinations(self, piece: int) -> tuple[np.ndarray, np.ndarray]:
        """(column, random key) of each row of the piece: its row of the matrix, permuted."""
        rng = np.random.default_rng([self.seed, 2, piece])
        to = rng.permutation(np.repeat(np.arange(len(self.columns), dtype=np.int32), self.row(piece)))
        return to, rng.integers(0, 1 << 63, len(to), dtype=np.int64)

    def __reduce__(self):
        return Matrix, (np.diff(self.until), self.columns, self.seed)


def _deal(matrix: Matrix, files: np.ndarray, chunks: np.ndarray):
    """An Arrow function (file hash, row number) -> (column, random key)."""
    index = {(int(f), int(c)): i for i, (f, c) in enumerate(zip(files, chunks))}
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def run(file: pa.Array, number: pa.Array) -> pa.Array:
        file, number = np.asarray(file), np.asarray(number)
        chunk = number >> PIECE_BITS
        to, key = np.empty(len(file), dtype=np.int32), np.empty(len(file), dtype=np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (chunk[1:] != chunk[:-1])]))
        for a, b in zip(cut, np.append(cut[1:], len(file))):
            piece = index[int(file[a]), int(chunk[a])]
            if piece not in held:
                held.clear()
                held[piece] = matrix.destinations(piece)
            at = number[a:b] & (PIECE_ROWS - 1)
            to[a:b], key[a:b] = held[piece][0][at], held[piece][1][at]
        return pa.StructArray.from_arrays([pa.array(to), pa.array(key)], ["column", "key"])
    return F.arrow_udf(run, "struct<column int, key bigint>")


def block_sizes(n_rows: int, n_shards: int, blocks: int) -> np.ndarray:
    """The size of every block of every shard, by shard: shards differ by one row at most, and
    block b of a shard of S rows has the slots from b * S // blocks."""
    shard = n_rows // n_shards + (np.arange(n_shards) < n_rows % n_shards).astype(np.int64)
    cuts = np.arange(blocks + 1, dtype=np.int64) * shard[:, None] // blocks
    return np.diff(cuts, axis=1).ravel()


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 11, blocks: int | None = None) -> DataFrame:
    """(shard, slot, row): every row of ``df``, as a struct of its columns, in a shard from 0
    to ``n_shards`` - 1 and at a slot that counts from 0 in it without gaps.

    All orders of all rows are equally likely; shard sizes differ by one row at most. Rows
    with null or repeated values in any column are rows like others, an empty table gives
    none. ``df`` is read where it lies when it comes straight from files (Parquet), else
    written once. ``blocks`` of a shard are separate tasks (by default as many as the
    session's shuffle partitions give to a shard).
    """
    spark = df.sparkSession
    try:
        place = df.metadataColumn("_metadata")
        df.select(place["file_path"], place["row_index"])
    except AnalysisException:
        df = materialize(df, "shard_input")
        place = df.metadataColumn("_metadata")
    file, number = F.xxhash64(place["file_path"]), place["row_index"].cast("long")
    pieces = (df.groupBy(file.alias("file"), F.shiftright(number, PIECE_BITS).alias("chunk"))
              .agg(F.max(number).alias("last"), F.count(F.lit(1)).alias("n")).orderBy("file", "chunk").toPandas())
    if len(pieces) and not ((pieces["last"] & (PIECE_ROWS - 1)) + 1 == pieces["n"]).all():
        raise ValueError("row numbers of the files have gaps: give the rows as a stored table")
    blocks = blocks or max(1, -(-shuffle_width(spark) // n_shards))
    sizes = pieces["n"].to_numpy(np.int64)
    n_rows = int(sizes.sum())
    ship(spark)
    deal = _deal(Matrix(sizes, block_sizes(n_rows, n_shards, blocks), seed), pieces["file"].to_numpy(np.int64), pieces["chunk"].to_numpy(np.int64))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), deal(file, number).alias("to"),
                     file.alias("file"), number.alias("number"))
    rows = rows.select("row", F.col("to.column").alias("column"), F.col("to.key").alias("key"), "file", "number")
    rows = rows.repartitionById(n_shards * blocks, F.col("column")).sortWithinPartitions("column", "key", "file", "number")
    rows = rows.select("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("place"),
                       F.expr(f"cast(`column` div {blocks} as int)").alias("shard"),
                       F.expr(f"cast(`column` % {blocks} as bigint)").alias("block"))
    held = F.lit(n_rows // n_shards).cast("long") + (F.col("shard") < n_rows % n_shards).cast("long")
    rows = rows.withColumn("held", held)
    return rows.select("shard", F.expr(f"(block * held) div {blocks} + place").alias("slot"), "row")


def write_shards(shards: DataFrame, path: str) -> None:
    """The shards as folders ``shard=N`` of Parquet files; ``slot`` orders the rows."""
    shards.write.mode("overwrite").partitionBy("shard").parquet(path)


def op11_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards whose counts differ by one row at most (law ``rows``). Equal
    texts are not kept together: with exact counts a large group must be able to part."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return shuffle_into_shards(table(spark, sf_dir, "documents"), 8).select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
