"""Multinomial gradient boosting on DataFrames.

The rows are cut into bins once.  A round grows one tree for every class, all of them together,
level by level: each task sums the gradients of its rows by (class, node, feature, bin), Spark
adds the tasks' sums, and the driver picks the best split of every open node.  A task sums by the
combinations of the bins of a few features at once, and then over all but one of them.  Of two
siblings only the one with less weight is summed; the other has what is left of the parent.  What
travels is bounded by ``classes * nodes * features * bins`` whatever the number of rows.  Gradients
are whole multiples of 2^-24, so that sums are exact and the model does not depend on how the rows
are partitioned; they are dealt evenly, as many to each core.

The rows' scores are written to the shared folder with every ``keep`` rounds.  In between the rows
of the round are cached with what the trees since then add, so no level goes through them again;
a lost executor costs its tasks and those few rounds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelens.operators.selection import order_statistics
from farelens.session import scratch_path

UNIT = 1 << 24
LEAF = -1


@dataclass
class BoostedClasses:
    """Fitted trees: ``feature``, ``cut`` and ``weight`` have a row per tree (round by round,
    class by class) and a column per node, whose children stand at 2i + 1 and 2i + 2."""

    features: list[str]
    classes: list[int]
    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    weight: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Score of every class (columns) for rows of feature values."""
        found = np.tile(self.start, (len(values), 1))
        for tree in range(len(self.feature)):
            found[:, tree % len(self.classes)] += _leaves(
                values, self.feature[tree], self.cut[tree], self.weight[tree])
        return found

    def transform(self, df: DataFrame, ids: Sequence[str], out: str = "pred") -> DataFrame:
        """``ids`` and the class of highest score, the first one of equal ones.

        Unknown feature values count as 0.
        """
        kept = df.select(*ids, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__x{i}")
                                 for i, c in enumerate(self.features)])
        place, model = len(ids), self
        classes = np.array(self.classes, np.int32)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = np.column_stack([batch.column(place + i).to_numpy(zero_copy_only=False)
                                          for i in range(len(model.features))])
                best = classes[np.argmax(model.scores(values), axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:place], pa.array(best, pa.int32())], names=[*ids, out])

        return kept.mapInArrow(run, f"{_ddl(kept, ids)}, `{out}` int")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node that is a split or a leaf, and one with what all trees share."""
        shared = json.dumps({"features": self.features, "classes": self.classes,
                             "start": self.start.tolist(), "shape": list(self.feature.shape)})
        tree, node = np.nonzero((self.feature != LEAF) | (self.weight != 0))
        rows = pa.table({
            "tree": pa.array(tree, pa.int32()), "node": pa.array(node, pa.int32()),
            "feature": pa.array(self.feature[tree, node], pa.int32()),
            "cut": pa.array(self.cut[tree, node], pa.float64()),
            "weight": pa.array(self.weight[tree, node], pa.float64()),
            "shared": pa.array([None] * len(tree), pa.string())})
        head = pa.table({c: pa.array([shared if c == "shared" else None], rows.schema.field(c).type)
                         for c in rows.column_names})
        spark.createDataFrame(pa.concat_tables([head, rows])).coalesce(1).write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedClasses:
        found = spark.read.parquet(path).toArrow()
        head = found.filter(pa.compute.is_valid(found["shared"]))["shared"][0].as_py()
        shared = json.loads(head)
        nodes = found.filter(pa.compute.is_null(found["shared"]))
        at = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        feature = np.full(shared["shape"], LEAF, np.int32)
        cut, weight = np.zeros(shared["shape"]), np.zeros(shared["shape"])
        feature[at], cut[at], weight[at] = (
            nodes[c].to_numpy() for c in ("feature", "cut", "weight"))
        return cls(shared["features"], shared["classes"], np.array(shared["start"]), feature, cut,
                   weight)


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def _leaves(values: np.ndarray, feature: np.ndarray, cut: np.ndarray,
            weight: np.ndarray) -> np.ndarray:
    """Weight of the leaf that each row falls into."""
    at = np.zeros(len(values), np.int64)
    rows = np.arange(len(values))
    while True:
        split = feature[at] != LEAF
        if not split.any():
            return weight[at]
        right = values[rows, np.maximum(feature[at], 0)] > cut[at]
        at = np.where(split, 2 * at + 1 + right, at)


def gradients(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss, in whole units."""
    by_class = np.ascontiguousarray(scores.T)
    odds = np.exp(by_class - by_class.max(axis=0))
    share = odds / odds.sum(axis=0)
    off = share.copy()
    off[labels, np.arange(len(labels))] -= 1
    return (np.rint(off * UNIT).astype(np.int64).T,
            np.rint(share * (1 - share) * UNIT).astype(np.int64).T)


def best_split(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int, int]:
    """Gain, feature and last bin on the left of the best split of a node.

    ``g`` and ``h`` have a row per feature and a column per bin.  Of equal gains the first
    feature and bin win.
    """
    left_g, left_h = (np.cumsum(x, axis=1)[:, :-1] / UNIT for x in (g, h))
    all_g, all_h = g[0].sum() / UNIT, h[0].sum() / UNIT
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = (left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2)
            - all_g ** 2 / (all_h + l2))
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    if not gain.size:
        return -np.inf, 0, 0
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Values that end the bins of each feature: exact quantiles, none twice.

    The last bin has no end.  A feature with at most ``bins`` values gets each of them.
    """
    long = df.select(F.posexplode(F.array(*[F.col(c) for c in features])).alias("f", "v"))
    counts = long.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(df.sparkSession, "values")
    counts.write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    few = [r.f for r in counts.groupBy("f").agg(F.count(F.lit(1)).alias("kinds")).where(
        F.col("kinds") <= bins).select("f").collect()]
    ends = {f: [] for f in range(len(features))}
    for r in counts.where(F.col("f").isin(few)).collect():
        ends[r.f].append(r.v)
    many = order_statistics(counts.where(~F.col("f").isin(few)), ["f"], "v", lambda n: (
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(bins - 1)),
                                     lambda i: F.floor(n * i / bins)))))
    for r in many.select("f", "v").distinct().collect():
        ends[r.f].append(r.v)
    # Of a feature with few values the largest ends no bin.
    return [np.array(sorted(v)[:-1] if f in few else sorted(v)) for f, v in ends.items()]


def fit_boosted(train: DataFrame, features: Sequence[str], label: str = "Cluster",
                rounds: int = 100, depth: int = 6, rate: float = 0.3, bins: int = 32,
                l2: float = 1.0, least: float = 1.0, keep: int = 10) -> BoostedClasses:
    """Trees that separate the whole-number classes of ``label``.

    Rows without a class are left out, unknown feature values count as 0.  A split needs a
    gain above 0 and second derivatives of at least ``least`` on both sides.  Training ends
    before ``rounds`` when no class finds a split any more.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must be 2 to 256, as a bin is one byte")
    spark = train.sparkSession
    features = list(features)
    rows = train.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("y"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}")
          for i, c in enumerate(features)])
    path = scratch_path(spark, "boosting-rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes, tasks = sorted(sizes), _tasks(spark, sum(sizes.values()))
    if len(classes) < 2:
        raise ValueError("there must be two classes at least")
    edges = bin_edges(rows, [f"x{i}" for i in range(len(features))], bins)
    used = [len(ends) + 1 for ends in edges]
    state = _binned(rows, edges, classes).repartition(tasks).persist()
    k, width = len(classes), 2 ** (depth + 1) - 1
    model = BoostedClasses(features, classes, np.zeros(k), np.full((0, width), LEAF, np.int32),
                           np.zeros((0, width)), np.zeros((0, width)))
    before = None
    for done in range(rounds):
        feature = np.full((k, width), LEAF, np.int32)
        cut, weight = np.zeros((k, width)), np.zeros((k, width))
        open_nodes = asked = [(c, 0) for c in range(k)]
        above: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for level in range(depth + 1):
            sums = dict(zip(asked, _node_sums(state, feature, cut, asked, used, bins)))
            if before is not None:
                before.unpersist()
                before = None
            here, following, asked = {}, [], []
            for c, node in open_nodes:
                here[c, node] = g, h = _own_sums(sums, above, c, node)
                if level == 0:
                    weight[c, node] = _step(g[0].sum(), h[0].sum(), rate, l2)
                gain, f, last = best_split(g, h, l2, least) if depth else (0.0, 0, 0)
                if gain <= 1e-9 or last >= len(edges[f]):
                    continue
                feature[c, node], cut[c, node], weight[c, node] = f, last, 0.0
                children, parts = (2 * node + 1, 2 * node + 2), (slice(0, last + 1),
                                                                 slice(last + 1, None))
                shares = [h[f, part].sum() for part in parts]
                for child, part, share in zip(children, parts, shares):
                    weight[c, child] = _step(g[f, part].sum(), share, rate, l2)
                # A node that cannot give both sides their share is not looked at again.
                again = [(c, child) for child, share in zip(children, shares)
                         if level + 1 < depth and share >= 2 * least * UNIT]
                if again:
                    following += again
                    asked.append((c, children[int(shares[1] < shares[0])]))
            open_nodes, above = following, here
            if not open_nodes:
                break
        values = cut.copy()
        for c, node in zip(*np.nonzero(feature != LEAF)):
            values[c, node] = edges[feature[c, node]][int(cut[c, node])]
        model = _grown(model, feature, values, weight)
        if (feature == LEAF).all():
            break
        if done + 1 < rounds:
            before = state
            grown = _rescored(state, BoostedClasses(features, classes, np.zeros(k), feature, cut,
                                                    weight), settle=(done + 1) % keep == 0)
            state = _stored(grown).repartition(tasks) if (done + 1) % keep == 0 else grown
            state = state.persist()
    state.unpersist()
    if before is not None:
        before.unpersist()
    return model


def _own_sums(sums: dict, above: dict, c: int, node: int) -> tuple[np.ndarray, np.ndarray]:
    """A node's sums, which are its parent's without its sibling's if only that one was summed."""
    if (c, node) in sums:
        return sums[c, node]
    parent, sibling = above[c, (node - 1) // 2], sums[c, node + 1 if node % 2 else node - 1]
    return parent[0] - sibling[0], parent[1] - sibling[1]


def _step(g: int, h: int, rate: float, l2: float) -> float:
    """Weight of a leaf with these sums."""
    return -rate * (g / UNIT) / (h / UNIT + l2)


def _grown(model: BoostedClasses, feature: np.ndarray, cut: np.ndarray,
           weight: np.ndarray) -> BoostedClasses:
    return BoostedClasses(model.features, model.classes, model.start,
                          np.concatenate([model.feature, feature]),
                          np.concatenate([model.cut, cut]), np.concatenate([model.weight, weight]))


def _binned(rows: DataFrame, edges: list[np.ndarray], classes: list[int]) -> DataFrame:
    """Blocks of ``y`` (place of the class), ``bins`` (a byte per feature), ``score`` and ``fresh``
    (0 per class)."""
    order = np.array(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _opened(map(binned, batches)):
            yield from _blocks(*part)

    def binned(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.column_stack([
            np.searchsorted(ends, batch.column(i + 1).to_numpy(zero_copy_only=False))
            for i, ends in enumerate(edges)]).astype(np.uint8)
        none = np.zeros((len(found), len(order)))
        return _state(np.searchsorted(order, batch.column(0).to_numpy()), found, none, none)

    return _stored(rows.mapInArrow(run, BLOCK))


# ``fresh`` is what the trees add that ``score`` does not hold yet.
STATE = pa.schema([("y", pa.int32()), ("bins", pa.binary()), ("score", pa.binary()),
                   ("fresh", pa.binary())])
# Every level passes all of it to Python tasks, so many rows of the state are one row for Spark.
BLOCK = "rows binary"
BLOCK_BYTES = 1 << 18
# Rows that a task looks at together: sums for all open nodes are worth many rows.
TOGETHER = 1 << 16


def _packed(values: np.ndarray) -> pa.Array:
    """A binary value for each row of ``values``."""
    width = values.shape[1] * values.itemsize
    ends = np.arange(len(values) + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(values),
                                 [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """The rows behind binary values of one length."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:][:len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    return data.view(kind).reshape(len(column), -1)


def _state(labels: np.ndarray, bins: np.ndarray, scores: np.ndarray,
           fresh: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(labels, pa.int32()), _packed(bins), _packed(scores), _packed(fresh)],
        schema=STATE)


def _blocks(*part: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a state in blocks of some ``BLOCK_BYTES``."""
    each = max(1, BLOCK_BYTES // sum(x[:1].nbytes for x in part))
    for start in range(0, len(part[0]), each):
        rows = _state(*(x[start:start + each] for x in part)).serialize().to_pybytes()
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.binary())], names=["rows"])


def _unblocked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``_opened`` gives of the rows in blocks."""
    return _opened(pa.ipc.read_record_batch(rows.as_buffer(), STATE)
                   for batch in batches for rows in batch.column(0))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, bins, scores and what is added to them, of some ``TOGETHER`` rows at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), *[
                _unpacked(batch.column(i), kind)
                for i, kind in ((1, np.uint8), (2, np.float64), (3, np.float64))]))
        if sum(len(part[0]) for part in held) >= TOGETHER:
            yield tuple(np.concatenate(parts) for parts in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(parts) for parts in zip(*held))


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "boosting-state")
    df.write.parquet(path)
    return df.sparkSession.read.schema(BLOCK).parquet(path)


def _rescored(state: DataFrame, trees: BoostedClasses, settle: bool) -> DataFrame:
    """The rows with what a round's ``trees`` add; ``settle`` puts all of it into the scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, bins, scores, fresh in _unblocked(batches):
            columns = np.ascontiguousarray(bins.T)
            fresh = fresh + np.column_stack([
                weight[_nodes(columns, feature, cut)]
                for feature, cut, weight in zip(trees.feature, trees.cut, trees.weight)])
            if settle:
                scores, fresh = scores + fresh, np.zeros_like(fresh)
            yield from _blocks(labels, bins, scores, fresh)

    return state.mapInArrow(run, BLOCK)


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks that go through the rows: a core gets as many rows as any other, and few at a time."""
    cores = spark.sparkContext.defaultParallelism
    return min(cores * math.ceil(rows / (cores * MOST)), max(1, math.ceil(rows / LEAST)))


# Rows that are worth a task of their own, and rows that a task has at most.
LEAST, MOST = 1 << 13, 1 << 19
# Slots whose sums a task adds up.
SLOTS = 1 << 14
# Cells that the combined bins of features may have, over all nodes that are asked for.
CELLS = 1 << 17


def _combined(sizes: Sequence[int], most: int) -> list[list[int]]:
    """Neighbouring features whose bins have ``most`` combinations, or a feature by itself."""
    groups, cells = [], most
    for f, size in enumerate(sizes):
        if groups and cells * size <= most:
            groups[-1].append(f)
            cells *= size
        else:
            groups.append([f])
            cells = size
    return groups


def _node_sums(state: DataFrame, feature: np.ndarray, cut: np.ndarray,
               nodes: list[tuple[int, int]], sizes: Sequence[int], bins: int,
               ) -> list[tuple[np.ndarray, np.ndarray]]:
    """First and second derivatives of each open node's rows, by feature and bin.

    The nodes of a class stand next to each other.  ``sizes`` has the number of bins that each
    feature uses.
    """
    k, width = len(feature), len(sizes)
    place = np.full(feature.shape, -1, np.int64)
    for i, (c, node) in enumerate(nodes):
        place[c, node] = i
    groups = [(group, [sizes[f] for f in group]) for group in _combined(sizes, CELLS // len(nodes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(nodes), math.prod(shape)), np.int64) for _, shape in groups]
        for labels, found, scores, fresh in _unblocked(batches):
            g, h = gradients(scores + fresh, labels)
            codes = [np.ravel_multi_index([found[:, f] for f in group], shape)
                     for group, shape in groups]
            columns = np.ascontiguousarray(found.T)
            for c in range(k):
                mine = place[c][place[c] >= 0]
                if not mine.size:
                    continue
                first, end = mine.min(), mine.max() + 1
                own = place[c, _nodes(columns, feature[c], cut[c])]
                rows = np.flatnonzero(own >= 0)
                own = own[rows] - first
                weights = [x[rows, c].astype(np.float64) for x in (g, h)]
                for total, code in zip(sums, codes):
                    cells = total.shape[2]
                    slots = own * cells + code[rows]
                    for i, x in enumerate(weights):
                        # Sums of these rows stay below 2^53, so they are exact in doubles.
                        total[i, first:end] += np.bincount(
                            slots, x, (end - first) * cells).astype(np.int64).reshape(-1, cells)
        total = np.zeros((2, len(nodes), width, bins), np.int64)
        for (group, shape), found in zip(groups, sums):
            found = found.reshape(2, len(nodes), *shape)
            for i, f in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != i)
                total[:, :, f, :sizes[f]] = found.sum(axis=others)
        total = total.reshape(2, -1)
        slots = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([
            pa.array(slots, pa.int64()), pa.array(total[0, slots], pa.int64()),
            pa.array(total[1, slots], pa.int64())], names=["slot", "g", "h"])

    # A task has a slot once, so there is nothing to combine before the exchange.
    parts = 1 + len(nodes) * width * bins // SLOTS
    sums = state.mapInArrow(run, "slot long, g long, h long").repartition(parts, "slot").groupBy(
        "slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, len(nodes) * width * bins), np.int64)
    out[:, sums["slot"].to_numpy()] = sums["g"].to_numpy(), sums["h"].to_numpy()
    shaped = out.reshape(2, len(nodes), width, bins)
    return [(shaped[0, i], shaped[1, i]) for i in range(len(nodes))]


def _nodes(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The node each row is in, in a tree that is still growing; ``columns`` has a row per
    feature."""
    at = np.zeros(columns.shape[1], np.int64)
    rows = {0: np.arange(columns.shape[1])}
    for node in range(len(feature)):
        if node in rows and feature[node] != LEAF:
            mine = rows.pop(node)
            right = columns[feature[node], mine] > cut[node]
            for child, part in ((2 * node + 1, mine[~right]), (2 * node + 2, mine[right])):
                at[part], rows[child] = child, part
    return at
