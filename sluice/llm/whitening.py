"""Embedding whitening over exact integer sums from bit-sliced vectors.

Entries become integers. Tasks shift each dimension to start at zero, cut it into bit planes and pack a plane's
bits of 64 rows into one word: the sum of products of two dimensions is then the popcount of ANDed planes,
weighted by their places. Sums are exact at every size, so the covariance is centred as integers; only its
eigenvectors are floating point. What reaches the driver grows with the dimensions alone.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Rows that are bit-sliced together, and places of a limb of the sums that leave a task.
BLOCK = 1 << 15
LIMB = 60
# Entries beyond this have no place in a long and their vectors take no part.
LARGEST = 2.0**62
# Bytes of distinct vectors for each task of the fit.
FIT_BYTES = 16 << 20

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) of every entry; the constant that x adds to it changes no covariance."""
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64)


def encode(rows: np.ndarray) -> list[bytes]:
    """Each row in the least width that holds it: equal rows are equal bytes."""
    low, high = rows.min(axis=1), rows.max(axis=1)
    out: list[bytes] = [b""] * len(rows)
    left = np.ones(len(rows), bool)
    for tag, width in enumerate(_WIDTHS):
        fits = left & (low >= np.iinfo(width).min) & (high <= np.iinfo(width).max)
        places = np.flatnonzero(fits)
        raw, size = rows[places].astype(np.dtype(width).newbyteorder("<")).tobytes(), rows.shape[1] * np.dtype(width).itemsize
        for k, i in enumerate(places.tolist()):
            out[i] = bytes([tag]) + raw[k * size : (k + 1) * size]
        left &= ~fits
    return out


def decode(keys: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(keys), dims), np.int64)
    tags = np.array([k[0] for k in keys])
    for tag, width in enumerate(_WIDTHS):
        places = np.flatnonzero(tags == tag)
        if len(places):
            raw = b"".join(keys[i][1:] for i in places.tolist())
            out[places] = np.frombuffer(raw, np.dtype(width).newbyteorder("<")).reshape(len(places), dims)
    return out


def cross_products(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the columns, as Python integers: exact whatever the entries are."""
    count, dims = rows.shape
    least = [int(v) for v in rows.min(axis=0)]
    # Unsigned: the difference of two longs may need 64 places.
    shifted = rows.astype(np.uint64) - np.array(least, np.int64).astype(np.uint64)
    places = [int(v).bit_length() for v in shifted.max(axis=0)]
    owner = np.repeat(np.arange(dims), places)
    bit = np.array([b for n in places for b in range(n)], np.uint64)
    words = (count + 63) // 64
    planes = np.zeros((len(owner), words * 8), np.uint8)
    for p, (i, b) in enumerate(zip(owner.tolist(), bit.tolist(), strict=True)):
        packed = np.packbits((shifted[:, i] >> np.uint64(b) & np.uint64(1)).astype(np.uint8))
        planes[p, : len(packed)] = packed
    planes = planes.view(np.uint64)
    sums = np.zeros(dims, object)
    products = np.zeros((dims, dims), object)
    for p, (i, b) in enumerate(zip(owner.tolist(), bit.tolist(), strict=True)):
        ones = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
        sums[i] += int(ones[0]) << b
        for q, n in enumerate(ones.tolist(), start=p):
            if n:
                j = int(owner[q])
                weighted = n << b + int(bit[q])
                # Planes of one dimension meet once here and twice in its square.
                products[i, j] += weighted << 1 if i == j and q > p else weighted
    for i in range(dims):
        for j in range(i, dims):
            products[i, j] += least[i] * sums[j] + least[j] * sums[i] + count * least[i] * least[j]
    for i in range(dims):
        sums[i] += count * least[i]
    return sums, products


def _limbs(value: int) -> list[decimal.Decimal]:
    """A signed integer as digits of base 2**60, least first; sums of them carry exactly."""
    sign, value = (-1, -value) if value < 0 else (1, value)
    out = []
    while value:
        out.append(decimal.Decimal(sign * (value & (1 << LIMB) - 1)))
        value >>= LIMB
    return out


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """Rows that take part, as (id, vector of double), and their length: the most frequent one, the longest of ties."""
    vector = F.col(vec_col).cast("array<double>")
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= F.lit(LARGEST)))
    rows = vectors.select(F.col(id_col).alias("id"), vector.alias("vector")).where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    lengths = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 0
    return rows.where(F.size("vector") == dims), dims


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def fit_list(rows: DataFrame, dims: int) -> DataFrame:
    """(key): each distinct integer vector once; equal ones collapse before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(encode(whole(_matrix(batch.column(0), dims))), pa.binary())], ["key"])

    return rows.select("vector").mapInArrow(run, "key binary").distinct()


def totals(keys: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums and sums of products over the whole list, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            held = batch.column(0).to_pylist()
            for start in range(0, len(held), BLOCK):
                block = decode(held[start : start + BLOCK], dims)
                s, p = cross_products(block)
                count, sums, products = count + len(block), sums + s, products + p
        if count:
            cells = [(-1, -1, 0, decimal.Decimal(count))]
            cells += [(i, -1, k, v) for i in range(dims) for k, v in enumerate(_limbs(sums[i]))]
            cells += [(i, j, k, v) for i in range(dims) for j in range(i, dims) for k, v in enumerate(_limbs(products[i, j]))]
            for start in range(0, len(cells), BLOCK):
                part = list(zip(*cells[start : start + BLOCK], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32()) for c in part[:3]] + [pa.array(part[3], pa.decimal128(38, 0))], ["i", "j", "limb", "v"]
                )

    cells = keys.mapInArrow(run, "i int, j int, limb int, v decimal(38,0)").groupBy("i", "j", "limb").agg(F.sum("v").alias("v"))
    count, sums, products = 0, [0] * dims, np.zeros((dims, dims), object)
    # At most (dims + 2)^2 cells of a few limbs each.
    for cell in cells.collect():
        value = int(cell["v"]) << LIMB * cell["limb"]
        if cell["i"] < 0:
            count = value
        elif cell["j"] < 0:
            sums[cell["i"]] += value
        else:
            products[cell["i"], cell["j"]] += value
            if cell["i"] != cell["j"]:
                products[cell["j"], cell["i"]] += value
    return count, np.array(sums, object), products


def components(count: int, sums: np.ndarray, products: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, unit eigenvectors (columns, largest entry positive) and explained shares, by falling eigenvalue.

    The covariance is centred as integers, so its doubles are the nearest to the exact ones. Components
    whose eigenvalue is zero to double precision cannot be whitened and are left out.
    """
    dims = len(sums)
    centred = count * products - np.outer(sums, sums)
    square = count * count
    matrix = np.array([[int(v) / square for v in row] for row in centred], np.float64).reshape(dims, dims)
    trace = sum(int(centred[i, i]) for i in range(dims)) / square
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > 16 * dims * np.finfo(float).eps * max(trace, 0.0)] if trace > 0 else order[:0]
    values, vectors = values[order], vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
    return values, vectors * signs, values / trace if trace > 0 else values


def _centred(rows: np.ndarray, count: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S exactly: longs where they fit, Python integers where they do not."""
    largest = max(int(np.abs(rows).max(initial=0)), 1)
    if count * largest < 1 << 61 and max(abs(int(s)) for s in sums) < 1 << 61:
        return count * rows - sums.astype(np.int64)
    return count * rows.astype(object) - sums


def deviations(centred: np.ndarray) -> list[int]:
    """Sum of squares of each row, exactly."""
    largest = int(np.abs(centred).max(initial=0))
    if largest * largest * centred.shape[1] < 1 << 62:
        return (centred * centred).sum(axis=1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in centred]


def _identity_error(keys: DataFrame, dims: int, count: int, sums: np.ndarray, matrix: np.ndarray) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|, from centred sums of all tasks."""
    width = matrix.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for start in range(0, len(held), BLOCK):
                rows = _centred(decode(held[start : start + BLOCK], dims), count, sums)
                white = (rows.astype(np.float64) / count) @ matrix
                mean = white.mean(axis=0)
                square = (white - mean).T @ (white - mean)
                p, q = np.triu_indices(width)
                n = len(white)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(q), pa.array(square[p, q]), pa.array(n * mean[p]), pa.array(n * mean[q]), pa.array(n * mean[p] * mean[q])],
                    ["p", "q", "m2", "a", "b", "ab"],
                )

    cells = keys.mapInArrow(run, "p long, q long, m2 double, a double, b double, ab double")
    added = cells.groupBy("p", "q").agg(*[F.sum(c).alias(c) for c in ("m2", "a", "b", "ab")])
    covariance = (F.col("m2") + F.col("ab") - F.col("a") * F.col("b") / count) / count
    return added.select(F.max(F.abs(covariance - (F.col("p") == F.col("q")).cast("double")))).first()[0]


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """(``id_col``, component, n, deviation, whitened, explained, identity_error, deviation_digits).

    Vectors that are null or empty, hold a null or non-finite entry, one whose 64-fold has no place in a long, or have
    another length than most, take no part. The fit list is each distinct integer vector once, so repeated rows
    do not weigh, but each of them has its rows in the result, null ids too. ``deviation`` is null where the exact
    sum has no place in a long; ``deviation_digits`` has it at any size. Components without variance are left out:
    equal vectors alone, or a single one, give no rows, nor does an empty table. Other columns are not read.
    """
    id_type = vectors.schema[id_col].dataType
    rows, dims = _usable(vectors, id_col, vec_col)
    keys = cut_lineage(fit_list(rows, dims)) if dims else None
    count, sums, products = totals(_tasks(keys), dims) if dims else (0, np.zeros(0, object), np.zeros((0, 0), object))
    values, basis, explained = components(count, sums, products, most) if count else (np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    schema = T.StructType(
        [
            T.StructField("id", id_type), T.StructField("deviation", T.LongType()),
            T.StructField("deviation_digits", T.StringType()), T.StructField("white", T.ArrayType(T.DoubleType())),
        ]
    )
    matrix = basis / np.sqrt(values)
    error = _identity_error(_tasks(keys), dims, count, sums, matrix) if len(values) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch) or not len(values):
                continue
            away = _centred(whole(_matrix(batch.column(1), dims)), count, sums)
            white = (away.astype(np.float64) / count) @ matrix
            exact = deviations(away)
            offsets = pa.array(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([d if d < 1 << 63 else None for d in exact], pa.int64()),
                    pa.array([str(d) for d in exact], pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1))),
                ],
                schema.names,
            )

    shares = F.array(*[F.lit(float(e)) for e in explained]) if len(explained) else F.array().cast("array<double>")
    return (
        rows.mapInArrow(run, schema)
        .select("id", "deviation", "deviation_digits", F.posexplode("white").alias("at", "whitened"))
        .select(
            F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(count).cast("long").alias("n"), "deviation",
            "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_digits",
        )
    )


def _tasks(keys: DataFrame) -> DataFrame:
    """The staged list in portions of a bounded size: a task sends one row for each pair of dimensions."""
    size = keys.agg(F.sum(F.length("key"))).first()[0] or 0
    return keys.repartition(max(1, math.ceil(size / FIT_BYTES)))
