"""Whitening of embeddings from exact, bit-sliced cross-products.

Entries become integers. A block of rows is turned into bit planes: every dimension, shifted to
start at zero within the block, has one plane a bit, packed across the rows into 64-bit words.
The cross-product of two dimensions is then the sum, over pairs of their planes, of the number
of bits set in both, weighted by the planes' powers of two. Blocks add up as exact integers,
which are centred as integers before the one division and the eigendecomposition.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.staging import pinned

SCALE, OFFSET = 1024, 100_000  # entry c becomes floor(SCALE * c) + OFFSET
COMPONENTS = 8
ROWS_PER_BLOCK = 4096
# An entry must stay a whole number in double precision.
LIMIT = float(1 << 51)
# Eigenvalues below this share of the largest are rounding, and their directions are not whitened.
LEAST_SHARE = 1e-13
EXACT = "decimal(38,0)"


def integers(vectors: Column) -> Column:
    """Whole-number entries of a vector; null if the vector or an entry is null, not finite, or too large."""
    doubles = F.transform(vectors, lambda c: c.cast("double"))
    usable = F.forall(doubles, lambda c: F.coalesce(F.abs(c) * SCALE < LIMIT, F.lit(False)))
    return F.when(usable, F.transform(doubles, lambda c: F.floor(c * SCALE).cast("long") + OFFSET))


def usual_length(rows: DataFrame) -> int:
    """The length most vectors `x` have; the longer of equally frequent ones."""
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def bit_planes(shifted: np.ndarray) -> np.ndarray:
    """(dimensions, bits, words): bit b of every row's entry, 64 rows a word."""
    rows, dims = shifted.shape
    bits = max(1, int(shifted.max()).bit_length())
    words = -(-rows // 64)
    planes = np.zeros((dims, bits, words * 8), np.uint8)
    columns = np.ascontiguousarray(shifted.T)
    for b in range(bits):
        planes[:, b, : -(-rows // 8)] = np.packbits(((columns >> b) & 1).astype(np.uint8), axis=1)
    return planes.view(np.uint64)


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums of the dimensions of a block, and sums of products of dimension i with dimensions j >= i."""
    rows, dims = x.shape
    low = x.min(axis=0)
    planes = bit_planes(x - low)
    bits = planes.shape[1]
    weights = [1 << b for b in range(bits)]
    base = [int(v) for v in low]
    ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64)
    own = [sum(w * int(n) for w, n in zip(weights, counts)) for counts in ones]
    sums = [s + rows * lo for s, lo in zip(own, base)]
    # Sums of a block fit a long unless entries are far apart.
    power = np.array(weights, np.int64 if 2 * bits + rows.bit_length() < 62 else object)
    products = []
    for i in range(dims):
        # Bits set in both: one plane of dimension i against all planes of the dimensions from i on.
        both = np.stack([np.bitwise_count(planes[i:] & planes[i, a]).sum(axis=2, dtype=np.int64) for a in range(bits)])
        shifted = np.tensordot(power, both @ power, axes=1)
        products.append(
            [
                int(v) + base[j] * own[i] + base[i] * own[j] + rows * base[i] * base[j]
                for j, v in enumerate(shifted, start=i)
            ]
        )
    return sums, products


def cross_products(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums, and sums of products of the dimensions of `x`, all exact.

    A task adds up its own blocks and gives one row a dimension; Spark adds the tasks' rows.
    The driver gets `dims` rows of at most `dims` numbers, whatever the size of the table.
    """
    schema = "i int, n long, s decimal(38,0), p array<decimal(38,0)>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, [0] * dims, [[0] * (dims - i) for i in range(dims)]
        for batch in batches:
            flat = np.asarray(pc.list_flatten(batch.column(0)), np.int64).reshape(-1, dims)
            for start in range(0, len(flat), ROWS_PER_BLOCK):
                block = flat[start : start + ROWS_PER_BLOCK]
                own, pairs = scatter(block)
                n += len(block)
                sums = [a + b for a, b in zip(sums, own)]
                products = [[a + b for a, b in zip(p, q)] for p, q in zip(products, pairs)]
        if n:
            exact = pa.decimal128(38, 0)
            yield pa.record_batch(
                [
                    pa.array(range(dims), pa.int32()),
                    pa.array([n] * dims, pa.int64()),
                    decimals(sums),
                    pa.array([[Decimal(v) for v in line] for line in products], pa.list_(exact)),
                ],
                names=["i", "n", "s", "p"],
            )

    parts = rows.select("x").mapInArrow(run, schema)
    added = parts.select("i", "n", "s", F.posexplode("p").alias("k", "v")).groupBy("i", "k").agg(
        F.sum("n").alias("n"), F.sum("s").cast(EXACT).alias("s"), F.sum("v").cast(EXACT).alias("v")
    )
    found = added.collect()
    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in found:
        i, j = r["i"], r["i"] + r["k"]
        sums[i] = int(r["s"])
        products[i][j] = products[j][i] = int(r["v"])
    return (found[0]["n"] if found else 0), sums, products


def decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # falling eigenvalues of the covariance, at most as many as components
    vectors: np.ndarray  # their unit vectors, one a column
    explained: np.ndarray


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the covariance of `x` (divisor n); None without rows."""
    n, sums, products = cross_products(rows, dims)
    if not n:
        return None
    centred = [[n * products[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    square = n * n
    covariance = np.array([[float(Fraction(v, square)) for v in line] for line in centred])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(Fraction(sum(centred[i][i] for i in range(dims)), square))
    leading = values[order]
    leading = np.where(leading > LEAST_SHARE * max(float(values.max()), 0.0), leading, 0.0)
    return Whitening(n, sums, leading, vectors[:, order], leading / trace if trace > 0 else np.zeros(len(leading)))


def project(rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """Id, exact `deviation`, and the whitened coordinates `w` (null without variance) of every row of `x`."""
    n, dims = model.n, len(model.sums)
    # x = middle + y with a small y, so that n * x - S = n * y - rest stays within a long.
    middle = np.array([(2 * s + n) // (2 * n) for s in model.sums], np.int64)
    rest = np.array([s - n * int(m) for s, m in zip(model.sums, middle)], np.int64)
    rest_square = sum(int(v) ** 2 for v in rest)
    scaled = model.vectors[:, model.values > 0] / np.sqrt(model.values[model.values > 0])
    flat_at = np.flatnonzero(model.values > 0)
    width = len(model.values)
    schema = T.StructType(
        [rows.schema[id_col], T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("w", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(pc.list_flatten(batch.column(1)), np.int64).reshape(-1, dims) - middle
            most = int(np.abs(y).max(initial=0))
            wide = dims * most * max(most, int(np.abs(rest).max(initial=0))) >= 1 << 62
            exact = y.astype(object) if wide else y
            squares, mixed = (exact * exact).sum(axis=1), (exact * rest).sum(axis=1)
            deviation = [n * n * int(q) - 2 * n * int(m) + rest_square for q, m in zip(squares, mixed)]
            coordinates = (y - rest / n) @ scaled
            w = np.full((len(y), width), np.nan)
            w[:, flat_at] = coordinates
            flat = pa.array(w.reshape(-1), mask=np.isnan(w.reshape(-1)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * width, pa.int32()), flat)
            yield pa.record_batch([batch.column(0), decimals(deviation), lists], names=[id_col, "deviation", "w"])

    return rows.select(id_col, "x").mapInArrow(run, schema)


def identity_error(projected: DataFrame, used: list[int]) -> float | None:
    """Largest absolute entry of the whitened coordinates' covariance minus the identity."""
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return None
    wide = projected.select(*[F.col("w")[i].alias(f"w{i}") for i in used])
    found = wide.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for every usable vector and leading component: the id, `component` (from 1, by falling
    variance), `n` vectors, `deviation` (sum over dimensions of (n * x - S)^2, exact), `whitened`
    (the centred vector on the component, over the root of its variance), `explained` (share of
    the total variance) and `identity_error` (one value, of the whitened covariance).

    Vectors that are null, or hold a null, non-finite or immense entry, are left out, as are those
    whose length is not the usual one (the most frequent; of equally frequent ones the longer).
    There are as many components as dimensions, if fewer than `components`. A component without
    variance has null coordinates and explains nothing; if all are, the error is null. Repeated
    rows and null ids count as rows; other columns of the input play no part, whatever their
    names. An empty table, or one of empty vectors, gives no rows.

    Only sums over tasks reach the driver: dimensions squared, never rows. The coordinates are
    pinned between the two passes, so that a lost executor repeats only its own part.
    """
    rows = df.select(F.col(id_col), integers(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    dims = usual_length(rows)
    result = T.StructType(
        [
            df.schema[id_col],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    rows = rows.where(F.size("x") == dims)
    model = fit(rows, dims, components) if dims else None
    if model is None:
        return df.sparkSession.createDataFrame([], result)
    projected = pinned(project(rows, model, id_col))
    error = identity_error(projected, np.flatnonzero(model.values > 0).tolist())
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    return projected.select(F.col(id_col), "deviation", F.posexplode("w").alias("_k", "whitened")).select(
        F.col(id_col),
        (F.col("_k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
