"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.topk import quantised
from lakeops.session import written_out

#: Bytes of one block of rows, and output rows of one batch.
BLOCK_BYTES, BATCH_ROWS = 4 << 20, 8192
#: Where a Lanczos vector, or a triple's residual, is nothing but rounding, in units of the largest singular value.
ROUNDING = 4 * np.finfo(float).eps
LONGEST = (1 << 63) - 1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A batch's vectors as rows, shorter ones filled up with zeros."""
    cut = column.offsets.to_numpy()
    values, size = column.values.to_numpy(zero_copy_only=False)[cut[0] : cut[-1]], np.diff(cut)
    if (size == dim).all():
        return values.reshape(len(size), dim)
    out = np.zeros((len(size), dim), np.int64)
    out[np.arange(dim) < size[:, None]] = values
    return out


def _exact(x: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    if float(np.abs(x.astype(float)).max(initial=0)) * max(1, len(x)) < LONGEST / 2:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in x.astype(object).sum(axis=0)]


class Fit:
    """The distinct vectors as blocks of rows in the shared folder, with their number, sums and size."""

    def __init__(self, vectors: DataFrame, column: str) -> None:
        """``vectors`` has whole-number vectors; equal ones count once, and shorter ones as filled up with zeros."""
        self.dim = vectors.agg(F.max(F.size(column))).first()[0] or 0
        dim = self.dim
        filled = F.concat(column, F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size(column)))
        # Partial distinct comes before the shuffle, so copies of one vector never meet in numbers.
        rows = vectors.select(filled.alias("x")).distinct()
        most = max(1, BLOCK_BYTES // (8 * max(1, dim)))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(0), dim)
                parts = [np.ascontiguousarray(x[k : k + most]) for k in range(0, len(x), most)]
                yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["n", "x"])

        self.blocks = written_out(rows.mapInArrow(pack, "n long, x binary"))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, top = [0] * dim, 0.0
            for x in self_blocks(batches):
                total = [a + b for a, b in zip(total, _exact(x))]
                top = max(top, float(np.abs(x.astype(float)).max(initial=0)))
            texts = pa.array([str(v) for v in total] + [repr(top)], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([*range(dim), -1], pa.int64()), texts], ["at", "v"])

        self_blocks = _blocks(dim)
        whole = F.when(F.col("at") >= 0, F.col("v").cast("decimal(38,0)"))
        found = self.blocks.mapInArrow(sums, "at long, v string").groupBy("at").agg(F.sum(whole).alias("s"), F.max(F.when(F.col("at") < 0, F.col("v").cast("double"))).alias("top")).collect()
        self.n = self.blocks.agg(F.sum("n")).first()[0] or 0
        by_place = {r["at"]: r for r in found}
        self.sums = [int(by_place[k]["s"]) if k in by_place else 0 for k in range(dim)]
        self.top = by_place[-1]["top"] if -1 in by_place else 0.0
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dim)

    def summed(self, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all centred blocks of a list of numbers: added up in the tasks, then by place.

        The driver gets one number for each place, however many rows or tasks there are.
        """
        mean, own = self.mean, _blocks(self.dim)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for x in own(batches):
                part = each(x - mean)
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

        got = self.blocks.mapInArrow(partial, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(len(got))
        for r in got:
            out[r["at"]] = r["v"]
        return out

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """For each row the sum over dimensions of (n x - S) squared, exact; None beyond a long."""
        reach = self.n * self.top + max(map(abs, self.sums), default=0)
        if float(reach) ** 2 * max(1, self.dim) < LONGEST / 2:
            return [int(v) for v in ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)]
        each = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1) if self.dim else [0] * len(x)
        return [int(v) if v <= LONGEST else None for v in each]


def _blocks(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for n, raw in zip(batch.column("n").to_pylist(), batch.column("x")):
                yield np.frombuffer(raw.as_buffer(), np.int64).reshape(n, dim)

    return read


def bidiagonalise(fit: Fit, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (as columns) and singular values of the centred rows, the largest ``wanted``.

    Right vectors v and left vectors u = Xv are made in turn, both fully reorthogonalised, until the last of the small
    bidiagonal matrix's singular triples that are wanted has no residual, or all dimensions are used up. A left vector
    has an entry for each row and stays with the rows: it is kept as the combination of the products XV that it is, so
    a step is one pass, in which each block gives Xv, and with it X'Xv, U'Xv and the length of Xv.
    """
    dim = fit.dim
    rng = np.random.default_rng(seed)
    right = np.zeros((dim, 0))
    left = np.zeros((0, 0))
    # X'U, the diagonals of the bidiagonal matrix, and the size of rounding errors.
    back, alphas, betas, size = np.zeros((dim, 0)), [], [], 0.0

    def fresh() -> np.ndarray:
        v = rng.standard_normal(dim)
        for _ in range(2):
            v -= right @ (right.T @ v)
        return v / np.linalg.norm(v)

    v = fresh()
    while True:
        right = np.c_[right, v]
        k = right.shape[1]

        def step(x: np.ndarray, right=right, left=left) -> np.ndarray:
            y = x @ right
            last = y[:, -1]
            return np.r_[x.T @ last, (y[:, :-1] @ left).T @ last, last @ last]

        got = fit.summed(step)
        there, onto, length = got[:dim], got[dim : dim + k - 1], got[-1]
        size = max(size, float(np.sqrt(length)))
        square = length - onto @ onto
        alpha = float(np.sqrt(square)) if square > (size * dim * ROUNDING) ** 2 and square > length * 1e-20 else 0.0
        # u = (Xv - U U'Xv) / alpha; without anything left of Xv there is no new left vector.
        made, u = np.zeros((k, k)), np.zeros(k)
        made[: k - 1, : k - 1] = left
        if alpha:
            u[: k - 1], u[-1] = -(left @ onto), 1.0
            made[:, -1] = u / alpha
        left = made
        w = (there - back @ onto) / alpha if alpha else np.zeros(dim)
        back = np.c_[back, w]
        alphas.append(alpha)
        w = w - alpha * v
        for _ in range(2):
            w = w - right @ (right.T @ w)
        beta = float(np.linalg.norm(w))
        small = np.diag(alphas) + np.diag(betas, 1)
        p, s, q = np.linalg.svd(small)
        size = max(size, float(s[0]))
        if k == dim:
            break
        if beta > size * dim * ROUNDING:
            if k >= wanted and (beta * np.abs(p[-1, :wanted]) <= size * ROUNDING / 16).all() and alpha:
                break
            v = w / beta
        else:
            beta, v = 0.0, fresh()
        betas.append(beta)
    vectors = right @ q[:wanted].T
    return vectors / np.linalg.norm(vectors, axis=0), s[:wanted]


def whitened(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """A row for each vector and component: id, component, n, deviation, whitened, explained and identity_error.

    Vectors become whole numbers floor(scale * entry). The components are those of the covariance of all distinct ones,
    from the bidiagonalisation of their centred rows: the largest ``components`` singular values, each over sqrt(n), are
    the deviations. ``whitened`` is a centred vector on a component, over its deviation; ``explained`` the component's
    share of the variance. ``identity_error`` is measured in one more pass over the distinct vectors.

    Rows whose vector is null or holds a null or non-finite entry are left out. Shorter vectors count as filled up with
    zeros. Entries beyond a long are taken as its end; a ``deviation`` beyond a long is null. With fewer dimensions there
    are as many components. A component without variance, as with a single distinct vector, has null ``whitened`` and 0
    ``explained``, and no part in ``identity_error``, which is 0 where none has variance. Equal rows and null ids are
    kept, empty vectors have no component, an empty table gives an empty table. Other columns are not looked at.

    The driver and each task hold square matrices of the vectors' size, not of the rows.
    """
    x = quantised(F.col(vector_col), scale)
    rows = rows.select(F.col(id_col), x.alias("__x")).where(F.col("__x").isNotNull())
    fit = Fit(rows, "__x")
    fields = T.StructType([rows.schema[id_col], *T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    kept = min(components, fit.dim)
    if not fit.n or not kept:
        return rows.sparkSession.createDataFrame([], fields)
    vectors, singular = bidiagonalise(fit, kept)
    total = float(fit.summed(lambda y: np.array([(y * y).sum()]))[0])
    varies = singular > max(singular[0], np.finfo(float).tiny) * fit.dim * ROUNDING if total else np.zeros(kept, bool)
    deviation = np.where(varies, singular / np.sqrt(fit.n), np.inf)
    onto = vectors / deviation
    explained = np.where(varies, singular**2 / total if total else 0.0, 0.0)
    found = fit.summed(lambda y, onto=onto: ((z := y @ onto).T @ z).ravel()).reshape(kept, kept) / fit.n
    error = float(np.abs((found - np.eye(kept))[np.ix_(varies, varies)]).max(initial=0.0))
    n, dim, mean = fit.n, fit.dim, fit.mean
    measured = fit.deviation
    fit.blocks = None  # Tasks need the figures alone.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(begin, BATCH_ROWS)
                x = _matrix(part.column(1), dim)
                count = len(x)
                on = ((x - mean) @ onto).ravel()
                each = np.tile(varies, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(count), kept))),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * kept, n)),
                        pa.array([v for v in measured(x) for _ in range(kept)], pa.int64()),
                        pa.array(np.where(each, on, np.nan), mask=~each),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * kept, error)),
                    ],
                    fields.names,
                )

    return rows.mapInArrow(run, fields)
