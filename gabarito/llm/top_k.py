"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt into buckets of similar length. Each query gets a threshold from the bucket of
the longest vectors. In any bucket the threshold, divided by the lengths, is the cosine that a
vector must reach: a bucket that cannot reach it is skipped, and in the others a query prunes by
length where its threshold is loose, and by coordinates where it is tight. What is left is
verified by its integer products.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gabarito.staging import staged

SCALE = 256
QUERY_EVERY = 50
TOP = 5
BUCKET_ROWS = 1024
BLOCK_QUERIES = 256
ROWS_PER_PARTITION = 16 * BUCKET_ROWS
TIGHT_COSINE = 0.8  # from this local threshold on, coordinates prune better than lengths
FOCUS = 4  # coordinates of a query that are tested
SLACK = 1e-6
EXACT = 2.0**52  # sums of products below this are exact in floating point

MATRIX = "dimension int, width int, longest double, ids binary, values binary"
SEEDED = "dimension int, width int, ids binary, values binary, thresholds binary, reach double"
FOUND = "query_id long, vec_id long, score long"
ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of a table whose columns are declared like `a int, b binary`."""
    fields = [pa.field(name, ARROW[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, k: int) -> DataFrame:
    """`vec_id`, `v` (array of long) and its length, of the rows that take part.

    Of a row that repeats k copies are enough: no query has use for more.
    """
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id", "v").count()
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("count", F.lit(k)).cast("int")))).drop("copy", "count")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("length", F.sqrt(square))


def lengths(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    return np.sqrt((m * m).sum(axis=1))


def stored(rows: list[tuple[int, list[int]]]) -> tuple:
    """One matrix row, the longest vector first, in the narrowest integers that hold it."""
    ids = np.array([i for i, _ in rows], np.int64)
    values = np.array([v for _, v in rows], np.int64).reshape(len(rows), -1)
    size = lengths(values)
    order = np.lexsort((ids, -size))
    most = np.abs(values).max(initial=0)
    narrow = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return (values.shape[1], np.dtype(narrow).itemsize, float(size.max()), ids[order].tobytes(), values[order].astype(narrow).tobytes())


def matrices(rows: DataFrame, per: int) -> DataFrame:
    """Rows of (vec_id, v) as matrices of at most `per` vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part in batches:
            for vec_id, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held.setdefault(len(v), []).append((vec_id, v))
                if len(held[len(v)]) == per:
                    yield batch([stored(held.pop(len(v)))], MATRIX)
        for left in held.values():
            yield batch([stored(left)], MATRIX)

    return rows.select("vec_id", "v").mapInArrow(run, MATRIX)


def loaded(ids: bytes, values: bytes, width: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(values, f"i{width}").reshape(len(found), dimension)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every sum stays exact there."""
    bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def kept(query: int, ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best candidates of a query but itself, ties to the smaller id."""
    other = ids != query
    ids, scores = ids[other], scores[other]
    if len(ids) > k:
        high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[high], scores[high]
    order = np.lexsort((ids, -scores))[:k]
    return [(query, int(ids[i]), int(scores[i])) for i in order]


def by_coordinates(way: np.ndarray, unit: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """Rows of `unit` whose coordinates allow the `cosine` with the unit vector `way`.

    At an angle b from `way`, which is at an angle a from axis f, coordinate f lies between
    cos(a + b) and cos(a - b), and reaches the axis itself where b is the larger angle.
    """
    rows = np.arange(len(unit))
    for f in np.argsort(-np.abs(way))[:FOCUS]:
        t, q = cosine[rows], way[f]
        spread = np.sqrt(max(0.0, 1 - q * q) * np.maximum(0.0, 1 - t * t)) + SLACK
        low = np.where(-q > t - SLACK, -1.0 - SLACK, q * t - spread)
        high = np.where(q > t - SLACK, 1.0 + SLACK, q * t + spread)
        rows = rows[(unit[rows, f] >= low) & (unit[rows, f] <= high)]
    return rows


def searched(
    query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """The k best of a bucket for each query, as far as they reach its threshold."""
    size, q_size = lengths(vectors), lengths(queries)
    needed = thresholds - SLACK * (1 + np.abs(thresholds))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(needed > 0, needed / (q_size * size[0]), -np.inf)
    out: list[tuple[int, int, int]] = []
    tight = (cosine >= TIGHT_COSINE) & (cosine <= 1 + SLACK)
    unit = vectors / np.maximum(size, 1e-300)[:, None] if tight.any() else None
    for i in np.flatnonzero(tight).tolist():
        rows = np.flatnonzero(q_size[i] * size >= needed[i])
        at_least = np.minimum(1.0, needed[i] / (q_size[i] * size[rows]))
        rows = rows[by_coordinates(queries[i] / q_size[i], unit[rows], at_least)]
        scores = products(queries[i : i + 1], vectors[rows])[0]
        reached = scores >= thresholds[i]
        out += kept(int(query_ids[i]), ids[rows[reached]], scores[reached], k)
    loose = np.flatnonzero(cosine < TIGHT_COSINE)
    if len(loose):
        # Vectors lie by falling length: each query needs those before its own end.
        ends = np.array([np.count_nonzero(q_size[i] * size >= needed[i]) for i in loose])
        ends[needed[loose] <= 0] = len(ids)
        scores = products(queries[loose], vectors[: ends.max()])
        for i, end, row in zip(loose.tolist(), ends.tolist(), scores):
            reached = np.flatnonzero(row[:end] >= thresholds[i])
            out += kept(int(query_ids[i]), ids[reached], row[reached], k)
    return out


def top_products(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
    query_every: int = QUERY_EVERY,
    scale: int = SCALE,
) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id`, `score`: the k highest integer products of each query.

    A component x becomes floor(scale * x). Queries are the rows whose id divides by
    `query_every`, candidates all rows with another id; ties go to the smaller id. Rows with a
    null id, a null vector, or a null or non-finite component take no part; a row that repeats
    counts as often as it does, as candidate and, for its id, as query; vectors of different
    dimension do not meet. Scores must fit in 64 bits; sums too large for exact floating point are multiplied as integers. With fewer than k
    candidates all are returned, and an empty table gives no rows. Other columns are not read.
    Buckets and blocks of queries are tables in the shared folder, and a task multiplies one
    block with one bucket. Lengths tie by id, so equal vectors fill as many buckets as they need.
    """
    vectors = staged(integer_vectors(df, id_col, vector_col, scale, k), "vectors")
    parts = max(1, -(-vectors.count() // ROWS_PER_PARTITION))
    by_length = vectors.repartitionByRange(parts, F.desc("length"), F.col("vec_id"))
    by_length = by_length.sortWithinPartitions(F.desc("length"), "vec_id")
    buckets = staged(matrices(by_length, BUCKET_ROWS).withColumn("bucket", F.monotonically_increasing_id()), "buckets")
    queries = vectors.where(F.col("vec_id") % query_every == 0)
    blocks = matrices(queries.coalesce(max(1, parts // 4)), BLOCK_QUERIES)

    # Thresholds from the bucket of the longest vectors of the dimension.
    seeds = buckets.groupBy("dimension").agg(F.max_by(F.struct("ids", "values", "width"), "longest").alias("seed"))

    def with_thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for r in part.to_pylist():
                query_ids, q = loaded(r["ids"], r["values"], r["width"], r["dimension"])
                ids, v = loaded(r["seed"]["ids"], r["seed"]["values"], r["seed"]["width"], r["dimension"])
                scores = products(q, v).astype(np.float64)
                scores[query_ids[:, None] == ids[None]] = -np.inf
                ordered = np.sort(scores, axis=1)[:, ::-1]
                theta = ordered[:, k - 1] if len(ids) >= k else np.full(len(q), -np.inf)
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(theta > 0, theta / lengths(q), -np.inf).min()
                yield batch([(r["dimension"], r["width"], r["ids"], r["values"], theta.tobytes(), float(reach))], SEEDED)

    blocks = blocks.join(seeds, "dimension").mapInArrow(with_thresholds, SEEDED)
    blocks = staged(blocks.withColumn("block", F.monotonically_increasing_id()), "queries")

    # Blocks meet the buckets that are long enough for one of their queries.
    pairs = blocks.select("dimension", "block", "reach").join(buckets.select("dimension", "bucket", "longest"), "dimension")
    pairs = pairs.where(F.col("longest") * (1 + SLACK) + SLACK >= F.col("reach")).select("block", "bucket")
    renamed = buckets.select("bucket", F.col("width").alias("v_width"), F.col("ids").alias("v_ids"), F.col("values").alias("v_values"))
    met = pairs.join(blocks.drop("reach"), "block").join(renamed, "bucket")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(part.num_rows):
                (r,) = part.slice(at, 1).to_pylist()
                query_ids, q = loaded(r["ids"], r["values"], r["width"], r["dimension"])
                ids, v = loaded(r["v_ids"], r["v_values"], r["v_width"], r["dimension"])
                found = searched(query_ids, q, np.frombuffer(r["thresholds"]), ids, v, k)
                if found:
                    yield batch(found, FOUND)

    found = met.mapInArrow(search, FOUND)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
