"""Boosted trees of many settings over one binned table, grown level by level in shared passes.

The trees are those of MLlib's ``GBTClassifier`` (log loss, variance, 32 bins, the same split
candidates and subsamples); what differs is how the rows are kept and read. MLlib holds every
row of every fit as objects and passes over them once per level and fit. Here rows are binned
once, into files of the shared folder: a few bytes a row. All fits that wait for a level share
one pass; histograms are summed and the best splits chosen on the executors, and only
splits reach the driver. Between trees a fit keeps its margin per row in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from threading import Condition

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_folders, scratch_dir, written

#: Fixed values of MLlib: bins of a feature, and the sample that split candidates come from.
MAX_BINS = 32
SAMPLE_ROWS = 10_000
EPSILON = float(np.finfo(float).eps)
#: Gains that differ by less, relatively, are equal.
TIE = 1e-12
DEFAULTS = {"maxDepth": 5, "stepSize": 0.1, "maxIter": 20, "minInstancesPerNode": 1, "subsamplingRate": 1.0}
#: Rows of a file, and the lanes its random numbers are drawn in.
BLOCK_ROWS = 1 << 16
LANES = 1 << 11
#: Features share a code as long as it has no more values than this.
CODES = 1 << 10


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _read(store: pafs.FileSystem, path: str) -> bytes:
    with store.open_input_file(path) as f:
        return f.read()


def _write(store: pafs.FileSystem, path: str, data: bytes) -> None:
    """A repeated task writes the same bytes; nobody sees half a file."""
    part = f"{path}-{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as f:
        f.write(data)
    store.move(part, path)


# --- Spark's random numbers ---------------------------------------------------------
def _step(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state ^= state >> np.uint64(35)
    state ^= state << np.uint64(4)
    return state


class Jump:
    """Powers of the generator's step, which is linear in the bits of its state."""

    def __init__(self, tables: np.ndarray):
        self.tables = tables

    @staticmethod
    def of(columns: np.ndarray) -> Jump:
        tables = np.zeros((8, 256), np.uint64)
        for byte in range(8):
            for bit in range(8):
                has = (np.arange(256) >> bit & 1).astype(bool)
                tables[byte, has] ^= columns[8 * byte + bit]
        return Jump(tables)

    def __call__(self, state: np.ndarray) -> np.ndarray:
        out = np.zeros_like(state)
        for byte in range(8):
            out ^= self.tables[byte][(state >> np.uint64(8 * byte) & np.uint64(255)).astype(np.intp)]
        return out

    def twice(self) -> Jump:
        units = np.uint64(1) << np.arange(64, dtype=np.uint64)
        return Jump.of(self(self(units)))


def _jumps() -> list[Jump]:
    """Jumps over 2^0, 2^1, ... steps."""
    if not _JUMPS:
        _JUMPS.append(Jump.of(_step(np.uint64(1) << np.arange(64, dtype=np.uint64))))
        while len(_JUMPS) < 48:
            _JUMPS.append(_JUMPS[-1].twice())
    return _JUMPS


_JUMPS: list[Jump] = []


def uniform(start: int, first: int, n: int) -> np.ndarray:
    """Numbers ``first`` to ``first + n`` of ``nextDouble`` from a hashed seed; two steps make one."""
    jumps, each = _jumps(), BLOCK_ROWS // LANES
    state = np.array([start & (2**64 - 1)], np.uint64)
    for k in range(47):
        if 2 * first >> k & 1:
            state = jumps[k](state)
    k = (2 * each).bit_length() - 1
    while len(state) * each < n:
        state = np.concatenate([state, jumps[k](state)])
        k += 1
    out = np.empty((each, len(state)))
    for i in range(each):
        state = _step(state)
        high = (state & np.uint64(2**26 - 1)) << np.uint64(27)
        state = _step(state)
        out[i] = (high + (state & np.uint64(2**27 - 1))).astype(float) * 2.0**-53
    return out.T.ravel()[:n]


# --- split candidates ---------------------------------------------------------------
def candidates(values: np.ndarray, weight: float, splits: int) -> np.ndarray:
    """MLlib's thresholds of one feature from its sampled values; zeros make up the expected number."""
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    some = float(counts.sum())
    found, counts = found.tolist(), counts.astype(float).tolist()
    if weight - some > EPSILON * some * 100:
        at = int(np.searchsorted(found, 0.0))
        found.insert(at, 0.0)
        counts.insert(at, weight - some)
    if len(found) - 1 <= splits:
        return np.array([(a + b) / 2.0 for a, b in zip(found, found[1:], strict=False)])
    stride = weight / (splits + 1)
    out, now, target = [], counts[0], stride
    for i in range(1, len(found)):
        before = now
        now += counts[i]
        if abs(before - target) < abs(now - target):
            out.append((found[i - 1] + found[i]) / 2.0)
            target += stride
    return np.array(out)


@dataclass(frozen=True)
class Coding:
    """Thresholds of every feature, and the code each feature is a digit of."""

    thresholds: list[np.ndarray]
    place: list[tuple[int, int] | None]
    sizes: list[int]

    @staticmethod
    def of(thresholds: list[np.ndarray]) -> Coding:
        place: list[tuple[int, int] | None] = []
        sizes: list[int] = []
        for t in thresholds:
            bins = len(t) + 1
            if bins == 1:
                place.append(None)
            elif sizes and sizes[-1] * bins <= CODES:
                place.append((len(sizes) - 1, sizes[-1]))
                sizes[-1] *= bins
            else:
                place.append((len(sizes), 1))
                sizes.append(bins)
        return Coding(thresholds, place, sizes)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """``[code, row]`` of rows of feature values."""
        out = np.zeros((len(self.sizes), len(x)), np.uint16)
        for i, at in enumerate(self.place):
            if at is not None:
                out[at[0]] += (np.searchsorted(self.thresholds[i], x[:, i]) * at[1]).astype(np.uint16)
        return out

    def bins(self, feature: int) -> np.ndarray:
        """The feature's bin of each value of its code."""
        code, stride = self.place[feature]
        return np.arange(self.sizes[code]) // stride % (len(self.thresholds[feature]) + 1)


# --- trees --------------------------------------------------------------------------
@dataclass
class Tree:
    """``splits[node]`` is (feature, bin, left, right); nodes without one are leaves."""

    splits: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    means: dict[int, float] = field(default_factory=dict)

    def parts(self, coding: Coding, codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The rows of every node without a split, node by node."""
        left = {n: (coding.place[f][0], coding.bins(f) <= b) for n, (f, b, _, _) in self.splits.items()}
        todo = [(0, rows)]
        while todo:
            node, at = todo.pop()
            if node not in self.splits:
                yield node, at
                continue
            code, table = left[node]
            goes = table[codes[code][at]]
            _, _, a, b = self.splits[node]
            todo += [(b, at[~goes]), (a, at[goes])]


@dataclass
class _Fit:
    """One fit: its settings, the tree in work, the one before, and the nodes to split."""

    number: int
    params: Mapping
    trees: list[Tree] = field(default_factory=list)
    todo: list[int] = field(default_factory=list)
    fresh: bool = True


def _weight(tree: int, params: Mapping) -> float:
    return 1.0 if tree == 0 else params["stepSize"]


def _histograms(coding, store, root, hashed, blocks, fits) -> Iterator[list[tuple[int, int, bytes]]]:
    """Counts and sums per bin and (fit, node) over blocks, then the node's count, sum and sum of squares."""
    sums: dict[int, list] = {}
    for part, first, n in blocks:
        data = _read(store, f"{root}/bins-{part}-{first}")
        y = np.frombuffer(data, np.int8, n).astype(float)
        codes = np.frombuffer(data, np.uint16, offset=n + n % 2).reshape(len(coding.sizes), n)
        drawn: dict[int, np.ndarray] = {}
        for fit in fits:
            m, tree, rate = len(fit.trees) - 1, fit.trees[-1], fit.params["subsamplingRate"]
            at = f"{root}/margin-{fit.number}-{{}}-{part}-{first}"
            if fit.fresh:
                margin = np.zeros(n)
                if m:
                    margin = np.frombuffer(_read(store, at.format(m - 1)), float, n).copy()
                    before, w = fit.trees[-2], _weight(m - 1, fit.params)
                    for node, rows in before.parts(coding, codes, np.arange(n)):
                        margin[rows] += before.means[node] * w
                if rate < 1.0 and m not in drawn:
                    drawn[m] = uniform(hashed[m + part], first, n)
                taken = drawn[m] < rate if rate < 1.0 else np.ones(n, bool)
                _write(store, at.format(m), margin.tobytes() + np.packbits(taken).tobytes())
                if m > 1 and store.get_file_info(at.format(m - 2)).type == pafs.FileType.File:
                    store.delete_file(at.format(m - 2))
            else:
                kept = _read(store, at.format(m))
                margin = np.frombuffer(kept, float, n)
                taken = np.unpackbits(np.frombuffer(kept, np.uint8, offset=8 * n), count=n).view(bool)
            parts = dict(tree.parts(coding, codes, np.flatnonzero(taken)))
            rows = [parts[node] for node in fit.todo]
            own = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            at_rows = np.concatenate(rows)
            target = y[at_rows]
            if m:
                target = 4.0 * target / (1.0 + np.exp(2.0 * target * margin[at_rows]))
            held = sums.setdefault(fit.number, [np.zeros((len(rows), 2, sum(coding.sizes))), np.zeros((len(rows), 3))])
            base = 0
            for code, size in enumerate(coding.sizes):
                key = own * size + codes[code][at_rows]
                held[0][:, 0, base : base + size] += np.bincount(key, minlength=len(rows) * size).reshape(-1, size)
                held[0][:, 1, base : base + size] += np.bincount(key, target, len(rows) * size).reshape(-1, size)
                base += size
            for i, weights in enumerate((None, target, target * target)):
                held[1][:, i] += np.bincount(own, weights, len(rows))
    for fit in fits:
        if fit.number in sums:
            cells, whole = sums[fit.number]
            found = np.concatenate([_per_feature(coding, cells), whole], axis=1)
            yield [(fit.number, node, row.tobytes()) for node, row in zip(fit.todo, found, strict=True)]


def _per_feature(coding: Coding, cells: np.ndarray) -> np.ndarray:
    """Counts, then sums, of the bins of every feature from those of the codes, node by node."""
    starts, nodes = np.concatenate([[0], np.cumsum(coding.sizes)]), len(cells)
    out = []
    for t, at in zip(coding.thresholds, coding.place, strict=True):
        if at is not None:
            own = cells[:, :, starts[at[0]] : starts[at[0] + 1]]
            out.append(own.reshape(nodes, 2, -1, len(t) + 1, at[1]).sum(axis=(2, 4)))
    return np.concatenate(out, axis=2).reshape(nodes, -1) if out else np.zeros((nodes, 0))


def best_split(coding: Coding, cells: np.ndarray, whole: np.ndarray, least: int) -> tuple:
    """(feature, bin, mean of the left, of the right, mean of all); feature -1 where no split gains."""
    n, s, squares = whole
    if not n:
        return -1, -1, 0.0, 0.0, 0.0
    none = (-1, -1, 0.0, 0.0, s / n)
    used = [i for i, t in enumerate(coding.thresholds) if len(t)]
    if not used or abs((squares - s * s / n) / n) < EPSILON:
        return none
    # One row per feature; places behind a feature's last bin have nothing on their right.
    widths = np.array([len(coding.thresholds[i]) + 1 for i in used])
    wide = np.zeros((2, len(used), widths.max()))
    wide[:, np.arange(widths.max()) < widths[:, None]] = cells
    left, below = np.cumsum(wide, axis=2)
    right, above = n - left, below[:, -1:] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (below * below / left + above * above / right - s * s / n) / n
    gain[(left < max(least, 1)) | (right < max(least, 1))] = 0.0
    most = gain.max(axis=1)
    if most.max() <= 0:
        return none
    # Features that part the rows alike differ in the last digits of their sums: the first one counts.
    i = int(np.argmax(most >= most.max() * (1 - TIE)))
    k = int(np.argmax(gain[i]))
    return used[i], k, below[i, k] / left[i, k], above[i, k] / right[i, k], s / n


class BinnedRows:
    """The labelled feature vectors of ``matrix``, binned once for all fits that are made of them."""

    def __init__(self, matrix: DataFrame, seed: int):
        self.spark, self.seed = matrix.sparkSession, seed
        self.folder = scratch_dir(self.spark, "binned")
        rows = matrix.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))
        told = rows.agg(F.count(F.lit(1)), F.count_if(F.col("label").isin(0, 1)), F.max(F.size("x"))).first()
        self.rows, labelled, self.features = told
        if labelled < self.rows:
            raise ValueError("labels of trees are 0 and 1")
        if not self.rows:
            raise ValueError("there are no rows to fit trees on")
        self.coding = Coding.of(self._thresholds(rows))
        self.blocks = [tuple(r) for r in self._binned(rows).orderBy("part", "at").collect()]
        self.hashed: list[int] = []
        self._turn, self._waiting, self._active, self._running, self._made = Condition(), {}, 0, False, 0
        self._found: dict[int, object] = {}

    def _hashed(self, seed: int) -> int:
        """The state that Spark's generator begins with."""
        companion = getattr(self.spark._jvm.org.apache.spark.util.random, "XORShiftRandom$")
        return getattr(companion, "MODULE$").hashSeed(seed)

    def _thresholds(self, rows: DataFrame) -> list[np.ndarray]:
        bins = min(MAX_BINS, self.rows)
        wanted = max(bins * bins, SAMPLE_ROWS)
        share = wanted / self.rows if wanted < self.rows else 1.0
        seed = self.spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.seed).nextInt()
        drawn = rows._jdf.rdd().sample(False, share, seed)
        sample = DataFrame(self.spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), self.spark)
        x = np.array([r[0] for r in sample.select("x").collect()], float).reshape(-1, self.features)
        return [candidates(x[:, i], share * self.rows, bins - 1) for i in range(self.features)]

    def _binned(self, rows: DataFrame) -> DataFrame:
        folder, coding = self.folder, self.coding

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = _store(folder)
            store.create_dir(root)
            part, first = TaskContext.get().partitionId(), 0
            labels: list[np.ndarray] = []
            codes: list[np.ndarray] = []

            def flush(n: int) -> pa.RecordBatch:
                nonlocal first
                y, c = np.concatenate(labels), np.concatenate(codes, axis=1)
                data = y[:n].tobytes() + bytes(n % 2) + np.ascontiguousarray(c[:, :n]).tobytes()
                _write(store, f"{root}/bins-{part}-{first}", data)
                labels[:], codes[:] = [y[n:]], [c[:, n:]]
                out = pa.RecordBatch.from_pylist([{"part": part, "at": first, "n": n}], _BLOCKS)
                first += n
                return out

            held = 0
            for batch in batches:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                labels.append((batch.column("label").to_numpy() * 2 - 1).astype(np.int8))
                codes.append(coding.codes(x))
                held += batch.num_rows
                while held >= BLOCK_ROWS:
                    yield flush(BLOCK_ROWS)
                    held -= BLOCK_ROWS
            if held:
                yield flush(held)

        return written(rows.mapInArrow(run, "part long, at long, n long"), "blocks")

    def fit(self, params: Mapping) -> list[Tree]:
        """The trees of one setting; settings that are fitted at the same time share the passes."""
        if other := set(params) - set(DEFAULTS):
            raise ValueError(f"not a setting of binned fits: {sorted(other)}")
        with self._turn:
            self._active += 1
            fit = _Fit(self._made, DEFAULTS | dict(params))
            self._made += 1
        try:
            for _ in range(fit.params["maxIter"]):
                fit.trees.append(Tree())
                self._grow(fit)
            return fit.trees
        finally:
            with self._turn:
                self._active -= 1
                self._turn.notify_all()

    def _grow(self, fit: _Fit) -> None:
        tree, fit.todo, fit.fresh, nodes = fit.trees[-1], [0], True, 1
        for _ in range(fit.params["maxDepth"]):
            found, todo = self._level(fit), []
            for node in fit.todo:
                feature, at, left, right, mean = found[node]
                tree.means.setdefault(node, mean)
                if feature >= 0:
                    tree.splits[node] = (feature, at, nodes, nodes + 1)
                    tree.means |= {nodes: left, nodes + 1: right}
                    todo += [nodes, nodes + 1]
                    nodes += 2
            fit.todo, fit.fresh = todo, False
            if not todo:
                break

    def _level(self, fit: _Fit) -> dict[int, tuple]:
        """Best splits of the fit's nodes, from a pass over the rows that all waiting fits share."""
        with self._turn:
            self._waiting[fit.number] = fit
            self._turn.notify_all()
            while fit.number not in self._found:
                if not self._running and len(self._waiting) == self._active:
                    fits, self._waiting, self._running = list(self._waiting.values()), {}, True
                    break
                self._turn.wait()
            else:
                return self._take(fit)
        found: dict[int, object] = {}
        try:
            found = self._pass(fits)
        except BaseException as error:
            found = {f.number: error for f in fits}
            raise
        finally:
            with self._turn:
                self._found |= found
                self._running = False
                self._turn.notify_all()
        with self._turn:
            return self._take(fit)

    def _take(self, fit: _Fit) -> dict[int, tuple]:
        found = self._found.pop(fit.number)
        if isinstance(found, BaseException):
            raise RuntimeError("the pass of a shared level failed") from found
        return found

    def _pass(self, fits: list[_Fit]) -> dict[int, dict[int, tuple]]:
        parts = max(p for p, _, _ in self.blocks) + 1
        while len(self.hashed) < max(len(f.trees) for f in fits) + parts:
            self.hashed.append(self._hashed(self.seed + len(self.hashed) + 1))
        # A task needs no more than the last two trees, under the number of the last.
        fits = [_Fit(f.number, f.params, [None] * (len(f.trees) - 2) + f.trees[-2:], f.todo, f.fresh) for f in fits]
        folder, coding, hashed, blocks = self.folder, self.coding, self.hashed, self.blocks
        slices = min(len(blocks), self.spark.sparkContext.defaultParallelism)
        least = {f.number: f.params["minInstancesPerNode"] for f in fits}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = _store(folder)
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    for rows in _histograms(coding, store, root, hashed, blocks[i::slices], fits):
                        yield _batch(_CELLS, rows)

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for fit, node, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    cells, known = np.frombuffer(cells, float), sums.get((fit, node))
                    sums[fit, node] = cells if known is None else known + cells
            best = [
                (*key, *best_split(coding, x[:-3].reshape(2, -1), x[-3:], least[key[0]])) for key, x in sums.items()
            ]
            yield _batch(_SPLITS, best)

        cells = self.spark.range(0, slices, 1, slices).mapInArrow(run, "fit int, node int, cells binary")
        rows = cells.repartition(slices, "fit", "node").mapInArrow(
            chosen, "fit int, node int, feature int, at int, left double, right double, mean double"
        )
        found: dict[int, dict[int, tuple]] = {f.number: {} for f in fits}
        for r in rows.collect():
            found[r.fit][r.node] = tuple(r)[2:]
        return found

    def model(self, trees: list[Tree], params: Mapping) -> GBTClassificationModel:
        """The trees as a model of MLlib."""
        jvm = self.spark._jvm
        ml = jvm.org.apache.spark.ml

        def node(tree: Tree, at: int):
            if at not in tree.splits:
                return ml.tree.LeafNode(tree.means[at], 0.0, None)
            feature, b, left, right = tree.splits[at]
            split = ml.tree.ContinuousSplit(feature, float(self.coding.thresholds[feature][b]))
            return ml.tree.InternalNode(tree.means[at], 0.0, 0.0, node(tree, left), node(tree, right), split, None)

        gateway = self.spark.sparkContext._gateway
        made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
        weights = gateway.new_array(jvm.double, len(trees))
        for i, tree in enumerate(trees):
            made[i] = ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", node(tree, 0), self.features)
            weights[i] = _weight(i, DEFAULTS | dict(params))
        return GBTClassificationModel(
            ml.classification.GBTClassificationModel(f"gbtc_{uuid.uuid4().hex[:12]}", made, weights, self.features, 2)
        )

    def drop(self) -> None:
        """Delete the files; models stay."""
        drop_folders(self.spark, [self.folder])


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_BLOCKS = pa.schema([("part", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])
_CELLS = pa.schema([("fit", pa.int32()), ("node", pa.int32()), ("cells", pa.binary())])
_SPLITS = pa.schema(
    [
        ("fit", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("at", pa.int32()),
        ("left", pa.float64()), ("right", pa.float64()), ("mean", pa.float64()),
    ]
)
