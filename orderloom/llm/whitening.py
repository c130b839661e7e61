"""Whitening of embeddings: pivoted Cholesky of the scatter, then one-sided Jacobi on its factor.

1.  Every entry becomes a whole number; the fit list holds each distinct vector once. Hot
    vectors are combined in each task before they move.
2.  Tasks add up their part of the fit list and of its products in whole numbers, so counts,
    sums and scatter do not depend on how rows are dealt, and centring cancels nothing. Only
    matrices of the dimension's size leave the tasks; their sum goes to the driver.
3.  Pivoted Cholesky writes the covariance as L L'. One-sided Jacobi turns pairs of columns of L
    until all are orthogonal: then their squared norms are the eigenvalues and the normalised
    columns the components.
4.  Rows are projected where they are; a pass over the fit list measures the whitened covariance.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import slices, to_rows, written

# Fixed value: an entry counts as floor(SCALE * entry) + 1000000. The constant falls out of all
# that is centred, so it is left out of the sums.
SCALE = 64

COMPONENTS = 16

# Largest whole number of an entry, either way.
LARGEST = float(1 << 62)

# Whole numbers up to here are exact in a double.
EXACT = 1 << 53
LONG = (1 << 63) - 1

# Sums of whole numbers travel in limbs of so many bits, each added up as a long.
LIMB_BITS, LIMBS = 32, 6

# Sweeps of rotations after which rounding alone is left; six to ten do it.
MOST_SWEEPS = 60


class Model(NamedTuple):
    """What the fit list of one length of vectors says. Sums and mean are of floor(SCALE * entry)."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray  # a unit vector per row


def on_grid(entries: np.ndarray) -> np.ndarray:
    """floor(SCALE * entry) as longs; beyond LARGEST it is that."""
    return np.clip(np.floor(entries.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def _kept(vectors: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Rows with a vector of finite entries, and by length their numbers and grid vectors."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    good = flat.is_valid().to_numpy(zero_copy_only=False)
    entries = flat.cast(pa.float64()).fill_null(0.0).to_numpy()
    good &= np.isfinite(entries)
    ends = np.cumsum(np.maximum(lengths, 0))
    bad = np.concatenate([[0], np.cumsum(~good)])
    whole = (lengths >= 0) & (bad[ends] == bad[ends - np.maximum(lengths, 0)])
    by_length = {}
    for d in np.unique(lengths[whole & (lengths > 0)]).tolist():
        rows = np.flatnonzero(whole & (lengths == d))
        by_length[d] = (rows, on_grid(entries[(ends[rows] - d)[:, None] + np.arange(d)]))
    return np.flatnonzero(whole), by_length


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 2, 4 and 8 bytes an entry that holds it, after that width."""
    most, least = x.max(1), x.min(1)
    out: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), bool)
    for width in (2, 4, 8):
        limit = 1 << (8 * width - 1)
        fits = ~done & (most < limit) & (least >= -limit)
        raw = x[fits].astype(f"<i{width}")
        for k, row in zip(np.flatnonzero(fits).tolist(), raw):
            out[k] = bytes([width]) + row.tobytes()
        done |= fits
    return out


def unpacked(rows: list[bytes]) -> dict[int, np.ndarray]:
    """Packed rows as one matrix per length of vectors."""
    found: dict[tuple[int, int], list[bytes]] = {}
    for row in rows:
        found.setdefault((len(row), row[0]), []).append(row[1:])
    by_length: dict[int, list[np.ndarray]] = {}
    for (size, width), same in found.items():
        d = (size - 1) // width
        by_length.setdefault(d, []).append(np.frombuffer(b"".join(same), f"<i{width}").reshape(-1, d).astype(np.int64))
    return {d: np.concatenate(parts) for d, parts in by_length.items()}


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x in whole numbers of any size, as Python integers."""
    most = int(np.abs(x).max(initial=0))
    if most * most * max(1, len(x)) < EXACT:
        wide = x.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    if most * most * max(1, len(x)) < LONG:
        return (x.T @ x).astype(object)
    wide = x.astype(object)
    return wide.T @ wide


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    if int(np.abs(x).max(initial=0)) * max(1, len(x)) < LONG:
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def _limbs(values: np.ndarray) -> dict[str, pa.Array]:
    """Python integers as limbs; all but the last are not negative."""
    out = {}
    for k in range(LIMBS):
        part = values if k == LIMBS - 1 else values & ((1 << LIMB_BITS) - 1)
        out[f"limb{k}"] = pa.array(part.astype(np.int64))
        values = values >> LIMB_BITS
    return out


def _fit_list(df: DataFrame) -> DataFrame:
    """Each distinct grid vector once, packed."""

    def make():
        def run(batches):
            for batch in batches:
                _, by_length = _kept(batch.column("vector"))
                rows = list(dict.fromkeys(row for _, x in by_length.values() for row in packed(x)))
                yield {"x": pa.array(rows, pa.binary())}

        return run

    return to_rows(df.select("vector"), make, "x binary").distinct()


def _totals(fit: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """By length of vectors: n, sums and products of the fit list, exactly.

    A task holds one matrix per length; only matrices are shuffled, an entry a row.
    """
    names = [f"limb{k}" for k in range(LIMBS)]

    def make():
        def run(batches):
            held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for d, x in unpacked(batch.column("x").to_pylist()).items():
                    n, sums, products = held.get(d, (0, 0, 0))
                    held[d] = (n + len(x), sums + exact_sums(x), products + exact_products(x))
            for d, (n, sums, products) in held.items():
                i, j = np.triu_indices(d)  # entry (0, 0) of a frame of one more row holds n, the rest of its row the sums
                rows = np.concatenate([[0], np.zeros(d, np.int64), i + 1])
                columns = np.concatenate([[0], np.arange(1, d + 1), j + 1])
                values = np.concatenate([np.array([n], object), sums, products[i, j]])
                yield {
                    "d": pa.array(np.full(len(rows), d, np.int64)),
                    "i": pa.array(rows.astype(np.int64)),
                    "j": pa.array(columns.astype(np.int64)),
                    **_limbs(values),
                }

        return run

    parts = to_rows(fit, make, "d long, i long, j long, " + ", ".join(f"{n} long" for n in names))
    summed = parts.groupBy("d", "i", "j").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = {}
    for d, rows in summed.groupby("d"):
        frame = np.zeros((d + 1, d + 1), object)
        values = sum(rows[n].to_numpy().astype(object) << (LIMB_BITS * k) for k, n in enumerate(names))
        i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
        frame[i, j] = values
        frame[j, i] = values
        out[int(d)] = (int(frame[0, 0]), [int(s) for s in frame[0, 1:]], frame[1:, 1:])
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with v = L L', a column per step, the largest remaining diagonal entry first.

    It stops when what remains is rounding: L then has as many columns as v has rank.
    """
    d = len(v)
    rest = v.astype(np.float64).copy()
    noise = d * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    columns = []
    for _ in range(d):
        k = int(np.argmax(rest.diagonal()))
        if rest[k, k] <= noise:
            break
        column = rest[:, k] / np.sqrt(rest[k, k])
        rest -= np.outer(column, column)
        rest[k, :] = rest[:, k] = 0.0
        columns.append(column)
    return np.stack(columns, 1) if columns else np.zeros((d, 0))


def _rounds(n: int):
    """All pairs of n columns, in rounds of pairs that share no column."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :])) if max(a, b) < n]
        yield np.array(pairs, np.int64).reshape(-1, 2).T
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor with its columns turned, pair by pair, until all are orthogonal."""
    g = factor.copy()
    orthogonal = np.finfo(float).eps * np.sqrt(max(1, len(g)))  # a cosine that is rounding
    rounds = list(_rounds(g.shape[1]))
    for _ in range(MOST_SWEEPS):
        turned = False
        for a, b in rounds:
            x, y = g[:, a], g[:, b]
            p, q, r = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(r) > orthogonal * np.sqrt(p * q)
            if not turn.any():
                continue
            turned = True
            zeta = (q - p)[turn] / (2 * r[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[:, a[turn]], g[:, b[turn]] = c * x[:, turn] - s * y[:, turn], s * x[:, turn] + c * y[:, turn]
        if not turned:
            break
    return g


def fitted(n: int, sums: list[int], products: np.ndarray) -> Model:
    """The model of a fit list. The centred scatter is made in whole numbers and rounded once."""
    total = np.array(sums, object)
    scatter = n * products - np.multiply.outer(total, total)  # n * n times the covariance
    covariance = np.array([[int(s) / (n * n) for s in row] for row in scatter], np.float64).reshape(len(sums), len(sums))
    trace = int(scatter.trace()) / (n * n)
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    norms = (turned * turned).sum(0)
    order = np.argsort(-norms, kind="stable")
    return Model(n, list(sums), trace, norms[order], (turned[:, order] / np.sqrt(norms[order])).T)


def fit(df: DataFrame, vector: str = "embedding") -> tuple[dict[int, Model], DataFrame]:
    """A model for each length of vectors, and the written fit list."""
    named = df.select(F.col(f"`{vector}`").alias("vector"))
    listed = written(_fit_list(named), "fit-list")
    return {d: fitted(*totals) for d, totals in _totals(listed).items()}, listed


def _centred(x: np.ndarray, model: Model) -> np.ndarray:
    """x - sums / n, rounded once: n * x - sums is a whole number."""
    return _spread(x, model).astype(np.float64) / model.n


def _spread(x: np.ndarray, model: Model) -> np.ndarray:
    """n * x - sums in whole numbers."""
    most = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums), default=0)
    kind = np.int64 if most < LONG else object
    return x.astype(kind) * model.n - np.array(model.sums, kind)


def _deviations(spread: np.ndarray) -> list[int | None]:
    """Sums of squares in whole numbers; null where a long cannot hold one."""
    if spread.dtype != object and int(np.abs(spread).max(initial=0)) ** 2 * spread.shape[1] < LONG:
        return (spread * spread).sum(1).tolist()
    wide = spread.astype(object)
    return [int(s) if s <= LONG else None for s in (wide * wide).sum(1)]


def _whitened(x: np.ndarray, model: Model, components: int) -> np.ndarray:
    return _centred(x, model) @ model.components[:components].T / np.sqrt(model.eigenvalues[:components])


def identity_errors(listed: DataFrame, models: dict[int, Model], components: int) -> dict[int, float]:
    """By length of vectors, the largest entry of the whitened fit list's covariance minus the identity."""
    sent = listed.sparkSession.sparkContext.broadcast(models)

    def make():
        def run(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for d, x in unpacked(batch.column("x").to_pylist()).items():
                    w = _whitened(x, sent.value[d], components)
                    one = np.concatenate([np.ones((len(w), 1)), w], 1)
                    held[d] = held.get(d, 0) + one.T @ one
            for d, sums in held.items():
                i, j = np.indices(sums.shape)
                yield {
                    "d": pa.array(np.full(sums.size, d, np.int64)),
                    "i": pa.array(i.ravel().astype(np.int64)),
                    "j": pa.array(j.ravel().astype(np.int64)),
                    "value": pa.array(sums.ravel()),
                }

        return run

    parts = to_rows(listed, make, "d long, i long, j long, value double")
    summed = parts.groupBy("d", "i", "j").agg(F.sum("value").alias("value")).toPandas()
    errors = {}
    for d, rows in summed.groupby("d"):
        size = int(rows["i"].max()) + 1
        sums = np.zeros((size, size))
        sums[rows["i"], rows["j"]] = rows["value"]
        mean = sums[0, 1:] / sums[0, 0]
        covariance = sums[1:, 1:] / sums[0, 0] - np.outer(mean, mean)
        errors[int(d)] = float(np.abs(covariance - np.eye(size - 1)).max(initial=0.0))
    return errors


def whitened(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per remaining row of df and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or an entry that is not finite go. An entry c
    counts as the whole number floor(64 * c) + 1000000 (a floor beyond 2^62 either way is that). The
    fit list has each distinct vector once, so rows that repeat count once there and get the
    same results; n is its length. deviation is the exact sum over dimensions of
    (n * x - sums)^2, null where a long cannot hold it. Components are numbered from 1 by
    falling variance, at most `components` of them; a direction
    whose variance is nothing but rounding beside the largest is none, so
    constant or single vectors, and empty ones, give no rows. whitened is the centred row on a
    component in units of its standard deviation, explained the component's share of all variance,
    identity_error the largest entry of whitened's covariance minus the identity over the fit list.

    Vectors of another length are a space of their own, with a fit list and components of its
    own. Ids may be null or repeat. An empty table gives an empty result; other columns of df
    are not read. The driver holds matrices of the dimension's size, never rows.
    """
    models, listed = fit(df, vector)
    errors = identity_errors(listed, models, components)
    sent = df.sparkSession.sparkContext.broadcast((models, errors))
    docs = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))

    def make():
        models, errors = sent.value

        def run(batches):
            for batch in (part for b in batches for part in slices(iter([b]), 1 << 20)):
                for d, (rows, x) in _kept(batch.column("vector"))[1].items():
                    model = models[d]
                    many = min(components, len(model.eigenvalues))
                    if not many:
                        continue
                    each = lambda values: pa.array(np.tile(values, len(rows)))
                    chosen = pa.array(np.repeat(rows, many))
                    yield {
                        "id": batch.column("id").take(chosen),
                        "component": each(np.arange(1, many + 1, dtype=np.int32)),
                        "n": pa.array(np.full(len(rows) * many, model.n, np.int64)),
                        "deviation": pa.array(_deviations(_spread(x, model)), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), many))),
                        "whitened": pa.array(_whitened(x, model, components).ravel()),
                        "explained": each(model.eigenvalues[:many] / model.trace),
                        "identity_error": pa.array(np.full(len(rows) * many, errors[d])),
                    }

        return run

    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return to_rows(docs, make, schema)
