"""Embedding whitening by incremental eigendecomposition.

A vector becomes whole numbers x = floor(256 c); the fit list is every
distinct x vector once. The covariance is never accumulated as a matrix.
Each task keeps an eigendecomposition of the scatter of its rows and applies
one centred rank-one update for each vector: the update's eigenvalues are the
roots of the secular equation 1 + sum z_i^2 / (d_i - t) = 0, found between
neighbouring poles by two-pole rational steps with a bisection guard;
components with a negligible z_i or (after a rotation) equal d_i are deflated
and stay as they are; the vectors come from z recomputed from the roots, which
keeps them orthogonal. A task runs a few such streams ("lanes") side by side
in one set of arrays. Two spectra combine by successive rank-one updates: one
for each eigenpair of the second and one for the difference of the means.
Lanes combine in a tree, tasks in a tree of grouped jobs of ``FAN`` spectra
each. Last, a Rayleigh-Ritz pass projects all centred vectors on the found
basis, sums the small projected covariance by Spark and rotates the basis by
its eigenvectors, which gives the components to double precision.

Memory of a task is a few (lanes x d x d) arrays; only d x d numbers of one
spectrum come to the driver and go out with the closures. The fit list is
written once (130 bytes a vector of 64 entries).

Vectors that are null or hold null or non-finite entries are dropped. Vectors
of different lengths are separate populations, each with a fit of its own; an
empty vector has no components. Entries beyond the range of a long count as
its end. Repeated rows are all returned and fitted once; null ids pass
through. An empty table gives no rows. A component without variance (fewer
vectors than components, constant dimensions) has a null ``whitened``, which
takes no part in ``identity_error``. ``deviation`` is null where the exact
value is beyond a long. Other columns pass through ``whiten`` whatever their
names; a column of the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.names import free_name
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

SCALE = 256
COMPONENTS = 4
ROWS_A_TASK = 4096
FAN = 8
LANE_CELLS = 1 << 16          # lanes x d x d
MAX_STEPS = 40                # of the secular solver
EPS = np.finfo(np.float64).eps
LONG = (1 << 63) - 1


# --- packed vectors -----------------------------------------------------------

def pack(vector) -> bytes | None:
    """x of one embedding as bytes (equal vectors, equal bytes); None if it is
    null or holds null or non-finite entries."""
    if vector is None:
        return None
    c = np.asarray(vector, dtype=np.float64)
    if not np.isfinite(c).all():
        return None
    x = np.floor(SCALE * c)
    if not len(x) or np.abs(x).max() < 1 << 15:
        return b"2" + x.astype("<i2").tobytes()
    top = float(LONG - 1023)
    return b"8" + np.clip(x, -top, top).astype("<i8").tobytes()


def unpack(keys: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, int64 matrix) for each vector length of a batch."""
    kinds = np.array([(k[0], len(k)) for k in keys], dtype=np.int64).reshape(-1, 2)
    width = kinds[:, 0] - ord("0")
    lengths = (kinds[:, 1] - 1) // width
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        x = np.empty((len(at), d), dtype=np.int64)
        for w in (2, 8):
            mine = np.flatnonzero(width[at] == w)
            if len(mine):
                data = b"".join(keys[k][1:] for k in at[mine])
                x[mine] = np.frombuffer(data, f"<i{w}").reshape(len(mine), d)
        yield int(d), at, x


# --- rank-one updates -----------------------------------------------------------

def _deflate(poles, rows, z):
    """Set negligible z to zero; rotate pairs of (nearly) equal poles so that
    one of them has z = 0."""
    norm2 = (z * z).sum(1)
    tol = 8 * EPS * np.maximum(np.abs(poles).max(1), norm2)
    small = np.abs(z) * np.sqrt(norm2)[:, None] <= tol[:, None]
    z = np.where(small, 0.0, z)
    a, b = z[:, :-1], z[:, 1:]
    close = np.abs((poles[:, 1:] - poles[:, :-1]) * a * b) <= tol[:, None] * (a * a + b * b)
    if not (close & (a != 0) & (b != 0)).any() and not small.any():
        return poles, rows, z
    poles, rows = poles.copy(), rows.copy()
    before = np.full(len(z), -1)
    for j in range(z.shape[1]):
        live = np.flatnonzero((z[:, j] != 0) & (before >= 0))
        if len(live):
            i = before[live]
            zi, zj, di, dj = z[live, i], z[live, j], poles[live, i], poles[live, j]
            size = np.hypot(zi, zj)
            c, s = zj / size, -zi / size
            turn = np.abs((dj - di) * c * s) <= tol[live]
            if turn.any():
                at, i, c, s = live[turn], i[turn], c[turn], s[turn]
                di, dj = di[turn], dj[turn]
                z[at, i], z[at, j] = 0.0, size[turn]
                poles[at, i], poles[at, j] = di * c * c + dj * s * s, di * s * s + dj * c * c
                ri, rj = rows[at, i], rows[at, j]
                rows[at, i] = c[:, None] * ri + s[:, None] * rj
                rows[at, j] = c[:, None] * rj - s[:, None] * ri
        before = np.where(z[:, j] != 0, j, before)
    return poles, rows, z


def _secular(poles, z2, live):
    """Roots of 1 + sum z2_i / (poles_i - t) for each live pole (the root above
    it), as (root, matrix of poles_i - root_j [lane, j, i]).

    ``poles`` of dead entries stand above all roots and have z2 = 0.
    """
    lanes, d = poles.shape
    index = np.arange(d)
    # Next live pole; d stands for the upper bound of the last root.
    later = np.where(live, index, d)
    after = np.full((lanes, d), d)
    after[:, :-1] = np.minimum.accumulate(later[:, ::-1], axis=1)[:, ::-1][:, 1:]
    last = after == d
    total = z2.sum(1)
    top = np.where(live, poles, -np.inf).max(1) + total
    upper = np.take_along_axis(np.concatenate((poles, top[:, None]), 1), after, 1)
    weight = np.take_along_axis(np.concatenate((z2, np.zeros((lanes, 1))), 1), after, 1)
    width = np.where(live, upper - poles, 1.0)
    half = width / 2
    at_half = 1 + (z2[:, None, :] / (poles[:, None, :] - poles[:, :, None] - half[:, :, None])).sum(2)
    low_half = at_half > 0
    own = low_half | last                          # the root is measured from its own pole
    base = np.where(own, poles, upper)
    dj, dn = np.where(own, 0.0, -width), np.where(own, width, 0.0)
    lo = np.where(own, np.where(low_half, 0.0, half), -half)
    hi = np.where(own, np.where(low_half, half, width), 0.0)
    gaps = poles[:, None, :] - base[:, :, None]
    tri = (index[None, :] <= index[:, None]).astype(np.float64)

    def quadratic(a, b, c):
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        return np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))

    with np.errstate(divide="ignore", invalid="ignore"):
        c = at_half + z2 / half - weight / half
        t = quadratic(c * (dj + dn) + z2 + weight, c * dj * dn + z2 * dn + weight * dj, c)
    t = np.where((t > lo) & (t < hi), t, (lo + hi) / 2)
    done = ~live
    for _ in range(MAX_STEPS):
        diff = gaps - t[:, :, None]
        part = z2[:, None, :] / diff
        slope = part / diff
        value = 1 + part.sum(2)
        below = np.einsum("lji,ji->lj", part, tri)
        error = 8 * EPS * (1 + value - 1 - 2 * below) + EPS * d
        done = done | (np.abs(value) <= error) | (hi - lo <= 2 * EPS * np.abs(t))
        if done.all():
            break
        lo, hi = np.where(value < 0, t, lo), np.where(value < 0, hi, t)
        slope_low = np.einsum("lji,ji->lj", slope, tri)
        slope_all = slope.sum(2)
        pj, pn = dj - t, dn - t
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = quadratic((pj + pn) * value - pj * pn * slope_all, pj * pn * value,
                             value - pj * slope_low - pn * (slope_all - slope_low))
        new = t + step
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        t = np.where(done, t, new)
    return base + t, gaps - t[:, :, None]


def update(poles, rows, v):
    """Eigendecompositions of rows^T diag(poles) rows + v v^T, one a lane.

    ``poles`` (lanes, d) rise; ``rows`` (lanes, d, d) are unit eigenvectors.
    """
    z = np.matmul(rows, v[:, :, None])[:, :, 0]
    if not z.any():
        return poles, rows
    poles, rows, z = _deflate(poles, rows, z)
    live = z != 0
    z2 = z * z
    far = 2 * np.abs(poles).max(1) + 4 * z2.sum(1) + 1
    placed = np.where(live, poles, far[:, None])
    root, diff = _secular(placed, z2, live)
    # z recomputed from the roots: exactly the update these roots belong to.
    own = placed[:, :, None] - placed[:, None, :]                   # [lane, j, i]: pole_j - pole_i
    d = poles.shape[1]
    own[:, np.arange(d), np.arange(d)] = 1.0
    pairs = live[:, :, None] & live[:, None, :]
    ratio = np.ones_like(own)
    np.divide(-diff, own, out=ratio, where=pairs)
    fitted = np.where(live, np.copysign(np.sqrt(np.abs(ratio.prod(1))), z), 0.0)
    mix = fitted[:, None, :] / diff
    mix /= np.sqrt((mix * mix).sum(2))[:, :, None] + (~live)[:, :, None]
    if not live.all():
        mix[~live] = 0.0
        lane, j = np.nonzero(~live)
        mix[lane, j, j] = 1.0
        root = np.where(live, root, poles)
    rows = np.matmul(mix, rows)
    if not live.all():
        order = np.argsort(root, axis=1, kind="stable")
        root = np.take_along_axis(root, order, 1)
        rows = np.take_along_axis(rows, order[:, :, None], 1)
    return root, rows


class Spectra:
    """Scatter eigendecompositions of several streams of vectors of length d."""

    def __init__(self, d: int, lanes: int):
        self.n = np.zeros(lanes, dtype=np.int64)
        self.mean = np.zeros((lanes, d))
        self.poles = np.zeros((lanes, d))
        self.rows = np.broadcast_to(np.eye(d), (lanes, d, d)).copy()

    def push(self, x: np.ndarray) -> None:
        """One centred rank-one update for each row of x, dealt over the lanes."""
        lanes, d = self.mean.shape
        for at in range(0, len(x), lanes):
            part = x[at:at + lanes]
            delta = np.zeros((lanes, d))
            delta[:len(part)] = part - self.mean[:len(part)]
            grown = self.n + (np.arange(lanes) < len(part))
            over = np.maximum(grown, 1)
            self.poles, self.rows = update(self.poles, self.rows, np.sqrt(self.n / over)[:, None] * delta)
            self.mean += delta / over[:, None]
            self.n = grown

    def combined(self) -> Spectra:
        """All lanes in one, by successive rank-one updates in a tree."""
        out = self
        while len(out.n) > 1:
            half = (len(out.n) + 1) // 2
            d = out.mean.shape[1]
            rest = len(out.n) - half
            a, b = Spectra(d, half), Spectra(d, half)
            for name in ("n", "mean", "poles", "rows"):
                setattr(a, name, getattr(out, name)[:half].copy())
                getattr(b, name)[:rest] = getattr(out, name)[half:]
            size = np.sqrt(np.maximum(b.poles, 0.0))
            for k in range(d):
                a.poles, a.rows = update(a.poles, a.rows, size[:, k, None] * b.rows[:, k])
            total = np.maximum(a.n + b.n, 1)
            apart = b.mean - a.mean
            weight = np.sqrt(a.n / total * b.n)
            a.poles, a.rows = update(a.poles, a.rows, weight[:, None] * apart)
            a.mean += apart * (b.n / total)[:, None]
            a.n = a.n + b.n
            out = a
        return out


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low)]


_SPECTRUM = "dim int, n long, total array<string>, most string, mean array<double>, poles array<double>, rows array<double>"


def _row(d: int, s: Spectra, total: list[int], most: int) -> dict:
    return {"dim": d, "n": int(s.n[0]), "total": [str(v) for v in total], "most": str(most), "mean": s.mean[0],
            "poles": s.poles[0], "rows": s.rows[0].ravel()}


def _decompose(batches):
    held: dict[int, list] = {}
    for batch in batches:
        for d, _, x in unpack(batch["key"].to_list()):
            if d == 0:
                continue
            if d not in held:
                held[d] = [Spectra(d, max(1, min(16, LANE_CELLS // (d * d)))), [0] * d, 0]
            state = held[d]
            state[0].push(x.astype(np.float64))
            state[1] = [a + b for a, b in zip(state[1], exact_sums(x))]
            state[2] = max(state[2], int(x.max()), -int(x.min()))
    for d, (spectra, total, most) in held.items():
        yield pd.DataFrame([_row(d, spectra.combined(), total, most)])


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    d = int(pdf["dim"].iloc[0])
    pdf = pdf.sort_values(["n", "most"], ignore_index=True)
    s = Spectra(d, len(pdf))
    s.n = pdf["n"].to_numpy(dtype=np.int64)
    s.mean, s.poles = np.stack(pdf["mean"].to_list()), np.stack(pdf["poles"].to_list())
    s.rows = np.stack(pdf["rows"].to_list()).reshape(len(pdf), d, d)
    total = [sum(int(v) for v in column) for column in zip(*pdf["total"])]
    return pd.DataFrame([_row(d, s.combined(), total, max(int(v) for v in pdf["most"]))])


# --- the fit --------------------------------------------------------------------

class Model:
    """Mean, basis and sizes of one vector length."""

    def __init__(self, d: int, n: int, total: list[int], most: int, rows: np.ndarray):
        self.d, self.n, self.total, self.rows = d, n, total, rows
        self.wide = d * (2 * n * max(most, 1)) ** 2 > LONG      # int64 sums of squares could overflow
        self.mean_parts = np.array(total, dtype=object if self.wide else np.int64)
        self.values = self.explained = self.identity_error = None

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return (x.astype(object) if self.wide else x) * self.n - self.mean_parts

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.offsets(x) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Whitened leading components; NaN where a component has no variance."""
        y = self.centred(x) @ self.rows.T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, y / np.sqrt(self.values), np.nan)


def _moments(fit: DataFrame, models: dict[int, Model], project) -> dict[int, np.ndarray]:
    """Mean of y y^T over the fit list, y = project(model, x), by vector length."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in unpack(batch["key"].to_list()):
                if d in models:
                    y = project(models[d], x)
                    sums[d] = sums.get(d, 0.0) + y.T @ y
        for d, m in sums.items():
            yield pd.DataFrame({"dim": d, "place": np.arange(m.size), "value": m.ravel()})

    found = (fit.mapInPandas(run, "dim int, place int, value double")
             .groupBy("dim", "place").agg(F.sum("value").alias("value")).toPandas())
    out = {}
    for d, own in found.groupby("dim"):
        side = int(round(len(own) ** 0.5))
        m = own.sort_values("place")["value"].to_numpy().reshape(side, side) / models[d].n
        out[int(d)] = (m + m.T) / 2
    return out


def fit_models(packed: DataFrame, components: int) -> dict[int, Model]:
    """Models of the distinct vectors of ``packed`` (column key), by length."""
    spark = packed.sparkSession
    fit = cut_lineage(packed.select("key").distinct())
    wanted = -(-fit.count() // ROWS_A_TASK)
    tasks = max(1, min(wanted, max(4 * spark.sparkContext.defaultParallelism,
                                   int(spark.conf.get("spark.sql.shuffle.partitions")))))
    dealt = fit.repartition(tasks)
    spectra = cut_lineage(dealt.mapInPandas(_decompose, _SPECTRUM))
    while (most := spectra.groupBy("dim").count().agg(F.max("count")).first()[0] or 0) > 1:
        groups = -(-most // FAN)
        numbered = spectra.withColumn("bucket", F.pmod(F.xxhash64("total", "n"), F.lit(groups)))
        spectra = cut_lineage(numbered.groupBy("dim", "bucket").applyInPandas(
            lambda pdf: _combine(pdf), _SPECTRUM))
    models = {}
    for row in spectra.collect():                       # one spectrum for each vector length
        basis = np.array(row.rows).reshape(row.dim, row.dim)
        basis = np.linalg.qr(basis.T)[0].T              # orthonormal to the last bit before the refinement
        models[row.dim] = Model(row.dim, row.n, [int(v) for v in row.total], int(row.most), basis)
    if not models:
        return models
    for d, small in _moments(dealt, models, lambda model, x: model.centred(x) @ model.rows.T).items():
        model = models[d]
        values, turn = np.linalg.eigh(small)
        keep = np.argsort(values)[::-1][:components]
        model.values = np.where(values[keep] > d * EPS * max(values.max(), 0.0), values[keep], 0.0)
        model.rows = turn[:, keep].T @ model.rows
        trace = float(np.trace(small))
        model.explained = [v / trace if trace > 0 else None for v in model.values]
    for d, cov in _moments(dealt, models, lambda model, x: np.nan_to_num(model.whitened(x))).items():
        kept = models[d].values > 0
        off = np.abs(cov - np.eye(len(cov)))[np.ix_(kept, kept)]
        models[d].identity_error = float(off.max()) if off.size else None
    return models


_WHITENING = ("struct<n:bigint, deviation:bigint, whitened:array<double>, explained:array<double>, "
              "identity_error:double>")


def _apply(models: dict[int, Model]):
    def run(keys: pd.Series) -> pd.DataFrame:
        out = {name: [None] * len(keys) for name in ("n", "deviation", "whitened", "explained", "identity_error")}
        # Spark may call this before it drops the rows without a key.
        for d, at, x in unpack([k or b"2" for k in keys]):
            if d not in models:
                continue
            model = models[d]
            offsets = model.offsets(x)
            squares = (offsets * offsets).sum(1)
            white = model.whitened(x)
            for k, place in enumerate(at):
                size = int(squares[k])
                out["n"][place] = model.n
                out["deviation"][place] = size if size <= LONG else None
                out["whitened"][place] = [None if v != v else v for v in white[k].tolist()]
                out["explained"][place] = model.explained
                out["identity_error"][place] = model.identity_error
        return pd.DataFrame({"n": pd.array(out["n"], dtype="Int64"), "deviation": pd.array(out["deviation"], dtype="Int64"),
                             "whitened": out["whitened"], "explained": out["explained"],
                             "identity_error": out["identity_error"]})
    return F.pandas_udf(run, _WHITENING)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS,
           column: str = "whitening") -> DataFrame:
    """``rows`` that hold a usable vector, with struct ``column``: n, deviation,
    whitened, explained (arrays by falling eigenvalue) and identity_error."""
    packed_udf = F.pandas_udf(lambda v: v.map(pack), "binary")
    packed = packed_udf(F.col(vector).cast("array<double>"))
    models = fit_models(rows.select(packed.alias("key")).where("key is not null"), components)
    key = free_name(rows, "key")
    return (rows.withColumn(key, packed).where(F.col(key).isNotNull())
            .withColumn(column, _apply(models)(F.col(key))).drop(key))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    done = whiten(rows).select("vec_id", "whitening.*")
    return (done.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                    F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error"))
