"""Binary logistic regressions over one table, fitted side by side, vectors off the driver.

The method and its constants are those of Spark's own regression: centred and scaled
columns, L-BFGS, a search along the line for the strong Wolfe conditions.  There every
pass brings a gradient as long as the vocabulary to the driver.  Here a gradient stays in
files, cut into blocks of columns.  All points the method visits are combinations of the
gradients so far, so the driver only holds the factors and the gradients' inner products.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtone.session import fresh_path
from threadtone.sources.filesystem import files, remove, stored_files

TOLERANCE = 1e-6  # that of Spark's regression, like the numbers of the search below
MEMORY = 10
# Columns of a block, and entries read at a time: a few MB each.
BLOCK = 4096
ENTRIES = 1 << 20
# Tasks of a pass.  Their gradients are shuffled by blocks of columns, so their number must
# not go with the rows.  More tasks come from models side by side.
MOST_GRADIENTS = 11
_WIDTH, _AT, _VALUES = "__width", "__at", "__values"
_PART = "block int, task int, vector binary, tail binary"
_WHOLE = "block int, vector binary, dots binary, tail binary"
# A spread this small beside the values themselves is rounding.
_NO_SPREAD = 1e-13


@dataclass(frozen=True)
class Fit:
    """A regression to fit: its L2 penalty, and the fold it leaves out, if any."""

    penalty: float
    left_out: int | None = None


class SearchFailed(Exception):
    """No step along the direction will do."""


# --- the method, over factors of gradients ------------------------------------


def _sum(a: np.ndarray, b: np.ndarray, times: float = 1.0) -> np.ndarray:
    out = np.zeros(max(len(a), len(b)))
    out[: len(a)] += a
    out[: len(b)] += times * b
    return out


class Span:
    """Vectors as the intercept and a factor for each gradient, with their inner product."""

    def __init__(self) -> None:
        self.products = np.zeros((0, 0))

    def add(self, with_all: np.ndarray) -> None:
        """One more gradient, by its products with those before it and with itself."""
        n = len(with_all)
        grown = np.zeros((n, n))
        grown[: n - 1, : n - 1] = self.products
        grown[n - 1, :] = grown[:, n - 1] = with_all
        self.products = grown

    def weights_dot(self, a: np.ndarray, b: np.ndarray) -> float:
        return float(a[1:] @ self.products[: len(a) - 1, : len(b) - 1] @ b[1:])

    def dot(self, a: np.ndarray, b: np.ndarray) -> float:
        return float(a[0] * b[0]) + self.weights_dot(a, b)

    def norm(self, a: np.ndarray) -> float:
        return float(np.sqrt(max(self.dot(a, a), 0.0)))


Asked = Generator[np.ndarray, tuple[float, float], tuple[float, np.ndarray]]


def _direction(span: Span, gradient: np.ndarray, steps: list, changes: list) -> np.ndarray:
    scale, found, shares = 1.0, gradient, []
    if steps:
        curve, length = span.dot(steps[0], changes[0]), span.dot(changes[0], changes[0])
        if not curve >= 0 or not length > 0:
            raise SearchFailed("no curvature")
        scale = curve / length
    for step, change in zip(steps, changes):
        share = span.dot(step, found) / span.dot(step, change)
        if np.isnan(share):
            raise SearchFailed("no curvature")
        shares.append(share)
        found = _sum(found, change, -share)
    found = found * scale
    for step, change, share in reversed(list(zip(steps, changes, shares))):
        found = _sum(found, step, share - span.dot(change, found) / span.dot(step, change))
    return -found


def _between(low: tuple, high: tuple) -> float:
    """Where the cubic through two points ``(at, value, slope)`` has its least value."""
    (a, fa, da), (b, fb, db) = sorted((low, high))
    one = da + db - 3 * (fa - fb) / (a - b)
    with np.errstate(invalid="ignore"):
        two = np.sqrt(np.float64(one * one - da * db))
        at = b - (b - a) * (db + two - one) / (db - da + 2 * two)
    return float(min(max(at, a + 0.1 * (b - a)), a + 0.9 * (b - a)))


def minimized(span: Span, penalty: float, intercept: float, most: int) -> Generator:
    """Asks for the loss at points and returns the last point.

    What is sent for a point is the mean loss and its slope by the intercept; by then
    ``span`` has the gradient of the loss there as its last vector.
    """

    def at(x: np.ndarray) -> Asked:
        loss, slope = yield x
        n = len(span.products)
        gradient = np.zeros(n + 1)
        gradient[: len(x)] = penalty * x
        gradient[0], gradient[n] = slope, gradient[n] + 1.0
        return loss + penalty / 2 * span.weights_dot(x, x), gradient

    def searched(x: np.ndarray, value: float, slope: float, way: np.ndarray, first: float) -> Generator:
        last = None

        def phi(t: float) -> Generator:
            nonlocal last
            y = _sum(x, way, t)
            f, g = yield from at(y)
            last = (y, f, g)
            return t, f, span.dot(way, g)

        def zoomed(low: tuple, high: tuple) -> Generator:
            for _ in range(10):
                c = yield from phi(_between(low, high))
                if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                    high = c
                else:
                    if abs(c[2]) <= 0.9 * abs(slope):
                        return (*last, c[0])
                    if c[2] * (high[0] - low[0]) >= 0:
                        high = low
                    low = c
            raise SearchFailed("no step between two points")

        if slope > 0:
            raise SearchFailed("the way leads upwards")
        low, t = (0.0, value, slope), first
        for i in range(10):
            c = yield from phi(t)
            if not np.isfinite(c[1]):
                t /= 2.0
                continue
            if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
                return (yield from zoomed(low, c))
            if abs(c[2]) <= 0.9 * abs(slope):
                return (*last, t)
            if c[2] >= 0:
                return (yield from zoomed(c, low))
            low, t = c, t * 1.5
        raise SearchFailed("no step")

    x = np.array([intercept])
    value, gradient = yield from at(x)
    least, seen = value, [np.inf, value]
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    done, failed = 0, False
    while done < most and span.norm(gradient) > max(TOLERANCE * abs(value), 1e-8):
        if len(seen) > 1 and abs(value - max(seen)) <= TOLERANCE * least:
            break
        try:
            way = _direction(span, gradient, steps, changes)
            first = 1.0 / span.norm(way) if done == 0 else 1.0
            y, f, g, t = yield from searched(x, value, span.dot(way, gradient), way, first)
            if t * span.norm(gradient) < 1e-10:
                raise SearchFailed("too small a step")
        except SearchFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        steps, changes = [_sum(y, x, -1.0), *steps][:MEMORY], [_sum(g, gradient, -1.0), *changes][:MEMORY]
        x, value, gradient, failed, done = y, f, g, False, done + 1
        seen = [*seen, value][-20:]
    return x


# --- the passes over the rows -------------------------------------------------


def store_rows(df: DataFrame, features: str, columns: Sequence[str], folder: str) -> None:
    """Rows as passes read them, once for all fits: numbers and the arrays of the vectors.

    Values are left out where all are one.
    """
    vector = F.unwrap_udt(F.col(features))
    values = vector["values"]
    same = (F.size(values) == 0) | ((F.array_min(values) == 1) & (F.array_max(values) == 1))
    ones = vector["indices"].isNotNull() & same
    df.select(
        *(F.col(c).cast("double").alias(c) for c in columns),
        F.coalesce(vector["size"], F.size(values)).alias(_WIDTH),
        vector["indices"].alias(_AT),
        F.when(~F.coalesce(ones, F.lit(False)), values).alias(_VALUES),
    ).write.parquet(folder)


def _bunches(paths: list[str], folder: str, label: str, fold: str | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, folds, sizes, positions and values of some rows at a time.

    Files are read a little at a time, so what a task holds does not go with its rows.
    No values stand for ones.
    """
    names = [label, *([fold] if fold else []), _AT, _VALUES]
    system, _ = files(folder)
    for path in paths:
        with system.open_input_file(path) as source:
            file = pyarrow.parquet.ParquetFile(source, buffer_size=1 << 20)
            for group in range(file.num_row_groups):
                held = file.metadata.row_group(group)
                arrays = (held.column(i) for i in range(held.num_columns))
                entries = max(c.num_values for c in arrays if c.path_in_schema.startswith((f"{_AT}.", f"{_VALUES}.")))
                most = max(1, min(held.num_rows, ENTRIES * held.num_rows // max(entries, 1)))
                for batch in file.iter_batches(most, [group], names, use_threads=False):
                    yield from _cut(*(batch.column(n) if n else None for n in (label, fold, _AT, _VALUES)))


def _cut(labels: pa.Array, folds: pa.Array | None, at: pa.Array, values: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """A batch in bunches of about ``ENTRIES`` entries at most, or of one row."""
    y = labels.to_numpy(zero_copy_only=False)
    number = folds.to_numpy(zero_copy_only=False) if folds is not None else np.full(len(y), -1.0)
    if not np.isin(y, (0.0, 1.0)).all():
        raise ValueError("labels must be 0 or 1")
    if np.isnan(number).any():
        raise ValueError("a row without a fold")
    plain = not at.null_count and values.null_count == len(y)
    if plain:
        sizes = at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        lengths = pc.coalesce(at.value_lengths(), values.value_lengths())
        if lengths.null_count:
            raise ValueError("a row without features")
        sizes = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(y):
        before = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
        rows = range(first, last)
        if plain:
            where, what = at.slice(first, last - first).flatten().to_numpy(), np.empty(0)
        else:
            where = np.concatenate([at[i].values.to_numpy() if at[i].is_valid else np.arange(sizes[i]) for i in rows])
            what = [values[i].values.to_numpy() if values[i].is_valid else np.ones(sizes[i]) for i in rows]
            what = np.concatenate(what).astype(float)
        yield y[first:last], number[first:last], sizes[first:last], where.astype(np.int32, copy=False), what
        first = last


def _row_sums(entries: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out, filled = np.zeros(len(sizes)), sizes > 0
    if filled.any():
        out[filled] = np.add.reduceat(entries, (np.cumsum(sizes) - sizes)[filled])
    return out


def _blocks(task: int, vectors: np.ndarray, tail: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    """Vectors of a task, columns last, cut into blocks."""
    for number in range(-(-vectors.shape[-1] // block)):
        part = np.ascontiguousarray(vectors[..., number * block : (number + 1) * block])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int32()), pa.array([task], pa.int32()),
                pa.array([part.tobytes()], pa.binary()), pa.array([tail.tobytes()], pa.binary()),
            ],
            ["block", "task", "vector", "tail"],
        )


def _read(folder: str, *columns: str) -> list[dict]:
    system, path = files(folder)
    return pyarrow.dataset.dataset(path, filesystem=system, format="parquet").to_table(columns=list(columns)).to_pylist()


def _block_of(folder: str, number: int, *shape: int) -> np.ndarray:
    (row,) = _read(f"{folder}/block={number}", "vector")
    return np.frombuffer(row["vector"]).reshape(*shape, -1)


def fitted(
    df: DataFrame, label: str, features: str, fits: list[Fit], most: int, fold: str | None = None, block: int = BLOCK,
    stored: str | None = None,
) -> list[tuple[np.ndarray, float] | None]:
    """Weights and intercept of every fit; None for one whose rows have a single label.

    ``features`` is a vector column, ``fold`` names the column that fits leave rows out
    by.  A pass goes over the rows once for all fits.  A task needs twice the weights of
    all fits, and what it sends does not depend on its rows.  ``stored`` is a folder that
    ``store_rows`` has put the same rows into; without it they are stored for these fits.

    The rows stay in files and out of the executors' heaps: cached they would be large
    arrays there, and every pass would copy them through the JVM to Python.
    """
    spark = df.sparkSession
    home, count = fresh_path(spark, "solver"), len(fits)
    outside = [f.left_out for f in fits]
    rows = stored or f"{home}/rows"

    def whole(name: str, partial: Callable, merged: Callable) -> list[dict]:
        """Sums of all tasks by block, stored; their tails and inner products."""

        def grouped(key: tuple, table: pa.Table) -> pa.Table:
            parts = sorted(table.to_pylist(), key=lambda r: r["task"])
            vector = sum(np.frombuffer(p["vector"]) for p in parts)
            tail = sum(np.frombuffer(p["tail"]) for p in parts)
            vector, dots = merged(key[0].as_py(), vector, tail)
            made = [[key[0].as_py()], [vector.tobytes()], [dots.tobytes()], [tail.tobytes()]]
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.Table.from_arrays(
                [pa.array(m, k) for m, k in zip(made, kinds)], ["block", "vector", "dots", "tail"]
            )

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task in batch.column(0).to_pylist():
                    for sums, tail in partial(_bunches(shares[task], rows, label, fold)):
                        yield from _blocks(task, sums, tail, block)

        tasks = spark.range(0, len(shares), 1, len(shares))
        parts = tasks.mapInArrow(over, _PART).groupBy("block").applyInArrow(grouped, _WHOLE)
        parts.write.partitionBy("block").parquet(f"{home}/{name}")
        return _read(f"{home}/{name}", "dots", "tail")

    shares: list[list[str]] = []

    def solve() -> list[tuple[np.ndarray, float] | None]:
        if not stored:
            store_rows(df, features, [label, *([fold] if fold else [])], rows)
        width = spark.read.parquet(rows).agg(F.max(_WIDTH)).first()[0]
        if not width:
            raise ValueError("no rows or no features to fit")
        paths = stored_files(rows, ".parquet")
        shares.extend(paths[i::MOST_GRADIENTS] for i in range(min(MOST_GRADIENTS, len(paths))))

        def counted(bunches: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            sums, tail, some = np.zeros((2, count, width)), np.zeros((2, count)), False
            for y, folds, sizes, at, values in bunches:
                some = True
                for f, left_out in enumerate(outside):
                    own = (folds != left_out).astype(float) if left_out is not None else np.ones(len(y))
                    each = np.repeat(own, sizes)
                    sums[0, f] += np.bincount(at, each * values if len(values) else each, width)
                    if len(values):
                        sums[1, f] += np.bincount(at, each * values * values, width)
                    else:
                        sums[1, f] += np.bincount(at, each, width)
                    tail[:, f] += own.sum(), own @ y
            if some:
                yield sums, tail

        def spread(number: int, vector: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            total, squares = vector.reshape(2, count, -1)
            n = np.maximum(tail.reshape(2, count)[0], 1.0)[:, None]
            mean = total / n
            variance = (squares - n * mean * mean) / np.maximum(n - 1, 1)
            variance[variance <= _NO_SPREAD * squares / n] = 0.0
            inverse = np.divide(1.0, np.sqrt(variance), out=np.zeros_like(variance), where=variance > 0)
            return np.stack([mean, inverse]), np.empty(0)

        sizes, positives = np.frombuffer(whole("spread", counted, spread)[0]["tail"]).reshape(2, count)
        blocks = -(-width // block)
        spans = [Span() for _ in fits]
        runs: dict[int, Generator] = {}
        points: dict[int, np.ndarray] = {}
        ends: dict[int, np.ndarray] = {}
        for f, fit in enumerate(fits):
            if 0 < positives[f] < sizes[f]:
                odds = np.log(positives[f] / (sizes[f] - positives[f]))
                runs[f] = minimized(spans[f], fit.penalty, float(odds), most)
                points[f] = next(runs[f])

        def combined(at: dict[int, np.ndarray], step: int, name: str) -> str:
            """The weights at a point of every fit, and what the means add up to by them."""
            factors = np.zeros((step, count))
            for f, point in at.items():
                factors[: len(point) - 1, f] = point[1:]

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for number in batch.column(0).to_pylist():
                        mean, inverse = _block_of(f"{home}/spread", number, 2, count)
                        weights = np.zeros_like(mean)
                        for j in range(step):
                            if factors[j].any():
                                weights += factors[j][:, None] * _block_of(f"{home}/{j}", number, count)
                        weights *= inverse
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([number], pa.int32()), pa.array([weights.tobytes()], pa.binary()),
                                pa.array([(weights * mean).sum(1).tobytes()], pa.binary()),
                            ],
                            ["block", "vector", "tail"],
                        )

            slots = spark.sparkContext.defaultParallelism
            numbers = spark.range(0, blocks, 1, max(1, min(blocks, slots)))
            numbers.mapInArrow(run, "block int, vector binary, tail binary").write.parquet(f"{home}/{name}")
            return f"{home}/{name}"

        def together(stored: list[dict]) -> tuple[np.ndarray, np.ndarray]:
            stored = sorted(stored, key=lambda r: r["block"])
            weights = np.concatenate([np.frombuffer(r["vector"]).reshape(count, -1) for r in stored], axis=1)
            return weights, sum(np.frombuffer(r["tail"]) for r in stored)

        def evaluated(step: int) -> None:
            intercepts = {f: float(point[0]) for f, point in points.items()}
            path = combined(points, step, f"at-{step}") if step else None

            def sloped(bunches: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                weights, offsets = together(_read(path, "block", "vector", "tail")) if path else (None, None)
                sums, tail, some = np.zeros((count, width)), np.zeros((2, count)), False
                for y, folds, sizes, at, values in bunches:
                    some = True
                    for f, intercept in intercepts.items():
                        margin = np.full(len(y), intercept)
                        if path:
                            entries = weights[f][at] * values if len(values) else weights[f][at]
                            margin += _row_sums(entries, sizes) - offsets[f]
                        with np.errstate(over="ignore"):
                            off = 1.0 / (1.0 + np.exp(-margin)) - y
                        loss = np.logaddexp(0.0, np.where(y == 1, -margin, margin))
                        if outside[f] is not None:
                            own = folds != outside[f]
                            off, loss = off * own, loss * own
                        each = np.repeat(off, sizes)
                        sums[f] += np.bincount(at, each * values if len(values) else each, width)
                        tail[:, f] += loss.sum(), off.sum()
                if some:
                    yield sums, tail

            def gradient(number: int, vector: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                mean, inverse = _block_of(f"{home}/spread", number, 2, count)
                off = tail.reshape(2, count)[1][:, None]
                own = (vector.reshape(count, -1) - mean * off) * inverse / np.maximum(sizes, 1.0)[:, None]
                before = (_block_of(f"{home}/{j}", number, count) for j in range(step))
                return own, np.array([(own * other).sum(1) for other in (*before, own)])

            found = whole(str(step), sloped, gradient)
            products = sum(np.frombuffer(r["dots"]).reshape(step + 1, count) for r in found)
            loss, off = np.frombuffer(found[0]["tail"]).reshape(2, count)
            for f in list(points):
                spans[f].add(products[:, f])
                try:
                    points[f] = runs[f].send((loss[f] / sizes[f], off[f] / sizes[f]))
                except StopIteration as end:
                    ends[f] = end.value
                    del points[f]

        step = 0
        while points:
            evaluated(step)
            step += 1
        weights, offsets = together(_read(combined(ends, step, "end"), "block", "vector", "tail"))
        return [(weights[f], float(ends[f][0] - offsets[f])) if f in ends else None for f in range(count)]

    try:
        return solve()
    finally:
        remove(spark, home)
