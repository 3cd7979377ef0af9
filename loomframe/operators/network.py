"""Feed-forward classifier trained by minibatch gradient steps over a distributed table.

Rows are stored once with a batch number drawn by hash, sorted by it inside every file, so that a step reads the row groups of
its batch only, from all executors. A step computes loss and gradients by back-propagation in each partition; the sums of the
layers' gradients go up a tree of partial sums, so the driver gets a bounded number of rows whatever the number of
partitions. The driver holds the parameters and the state of the update rule.

Steps follow each other, so small batches gain nothing from many tasks: if at least two batches fit into cellRows rows, rows are
dealt to segments of that many rows in the epoch's order of batches, and one task takes the steps of a segment, which it streams.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON
from loomframe.operators.contract import require_numeric
from loomframe.operators.linear import optimizer
from loomframe.plans.nearest import matrix_of
from loomframe.plans.runtime import CELL_ROWS, limit_of, require_columns, stored

FAN = 16  # partial sums that are added up in one task, and at most so many that reach the driver
SUMS = pa.schema([("layer", pa.int32()), ("value", pa.list_(pa.float64()))])

Layers = list[tuple[np.ndarray, np.ndarray]]


def initial_layers(sizes: Sequence[int], seed: int) -> Layers:
    """Normal weights of variance 2 / inputs, biases 0.01."""
    rng = np.random.default_rng(seed)
    return [(rng.normal(size=(a, b)) * np.sqrt(2.0 / a), np.full(b, 0.01)) for a, b in zip(sizes, sizes[1:])]


def forward(layers: Layers, x: np.ndarray, slope: float) -> tuple[list[np.ndarray], np.ndarray]:
    """Inputs of each layer and the class probabilities; hidden layers are leaky rectifiers."""
    inputs = [x]
    for i, (w, b) in enumerate(layers):
        z = inputs[-1] @ w + b
        if i < len(layers) - 1:
            inputs.append(np.where(z < 0, slope * z, z))
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return inputs, e / e.sum(axis=1, keepdims=True)


def backward(layers: Layers, x: np.ndarray, y: np.ndarray, slope: float) -> tuple[Layers, np.ndarray]:
    """Sums over rows: the gradients of the cross entropy, and (loss, right answers, rows)."""
    inputs, p = forward(layers, x, slope)
    at = (np.arange(len(y)), y)
    told = np.array([-np.log(np.maximum(p[at], EPSILON)).sum(), (p.argmax(axis=1) == y).sum(), len(y)], dtype=float)
    up = p
    up[at] -= 1.0
    out = []
    for i in range(len(layers) - 1, -1, -1):
        out.append((inputs[i].T @ up, up.sum(axis=0)))
        if i:
            up = (up @ layers[i][0].T) * np.where(inputs[i] < 0, slope, 1.0)
    return out[::-1], told


def _tree_sum(parts: DataFrame, partitions: int) -> dict[int, np.ndarray]:
    """Sums of the rows' arrays by layer, added up in rounds of FAN partitions."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for layer, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.values.to_numpy()
                total[layer] = total[layer] + value if layer in total else value
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], schema=SUMS)

    while partitions > FAN:
        partitions = -(-partitions // FAN)
        parts = parts.repartition(partitions).mapInArrow(add, "layer int, value array<double>")
    sums: dict[int, np.ndarray] = {}
    for row in parts.toArrow().to_pylist():
        value = np.asarray(row["value"])
        sums[row["layer"]] = sums[row["layer"]] + value if row["layer"] in sums else value
    return sums


def stepped(layers: Layers, rules: list, sums: Layers, n: float, l1: float, l2: float) -> tuple[Layers, Layers]:
    """The layers after a step of the update rules, and the mean gradient with the penalties'."""
    gradient = [(gw / n + l2 * w + l1 * np.sign(w), gb / n) for (w, _), (gw, gb) in zip(layers, sums)]
    return [tuple(rule(v, g) for rule, v, g in zip(*each)) for each in zip(rules, layers, gradient)], gradient


def _whole_batches(batches):
    """(x, y) of each place, which follow each other in order."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        place, x, y = batch.column(0).to_numpy(), matrix_of(batch.column(1)), batch.column(2).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
        for a, b in zip(cuts, cuts[1:]):
            if held and place[a] != at:
                yield tuple(np.concatenate(v) for v in zip(*held))
                held = []
            at = place[a]
            held.append((x[a:b], y[a:b]))
    if held:
        yield tuple(np.concatenate(v) for v in zip(*held))


class NetworkClassifier:
    """Dense layers with leaky rectifiers, softmax output, cross entropy with optional L1 and L2 penalties on the weights.

    A batch holds the rows of one hash value, about batch_size of them; batches come in a new order each epoch. Rows with a NULL
    label or feature are left out of the fit; `history` has loss and accuracy of each epoch, and of the validation rows if given.
    """

    def __init__(self, cols, label: str, hidden: Sequence[int], id_col: str, batch_size: int = 128, epochs: int = 10,
                 method: str = "adam", lr: float | None = None, slope: float = 0.01, l1: float = 0.0, l2: float = 0.0,
                 seed: int = 42, layers: Layers | None = None):
        if batch_size < 1 or epochs < 1:
            raise ValueError("batch_size and epochs must be positive")
        self.cols, self.label, self.hidden, self.id_col = list(cols), label, list(hidden), id_col
        self.batch_size, self.epochs, self.method, self.lr, self.slope = batch_size, epochs, method, lr, slope
        self.l1, self.l2, self.seed, self.start = l1, l2, seed, layers
        self.classes: list = []
        self.layers: Layers = []
        self.gradient: Layers = []
        self.history: list[dict] = []

    def _rows(self, df: DataFrame) -> DataFrame:
        x = [F.col(c).cast("double") for c in self.cols]
        y = (F.array_position(F.lit(self.classes), F.col(self.label)) - 1).cast("int")
        usable = F.col(self.label).isNotNull()
        for c in x:
            usable = usable & c.isNotNull()
        batch = F.xxhash64(F.lit(self.seed), F.col(self.id_col))
        return df.filter(usable).select(batch.alias("batch"), F.array(*x).alias("x"), y.alias("y")).filter("y >= 0")

    def _sums(self, rows: DataFrame, partitions: int, learn: bool) -> dict[int, np.ndarray]:
        layers, slope = self.layers, self.slope

        def partial(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    gradient, told = backward(layers, matrix_of(batch.column(0)), batch.column(1).to_numpy(), slope)
                    parts = [told, *(np.concatenate([w.ravel(), b]) for w, b in gradient)] if learn else [told]
                    total = parts if total is None else [a + b for a, b in zip(total, parts)]
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.list_(pa.float64()))], schema=SUMS)

        return _tree_sum(rows.select("x", "y").mapInArrow(partial, "layer int, value array<double>"), partitions)

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "NetworkClassifier":
        require_columns(df, [self.id_col, self.label])
        require_numeric(df, self.cols)
        # a class is a column of the last layer, so their number is bounded by the network that the driver holds
        self.classes = [r[0] for r in df.select(self.label).filter(F.col(self.label).isNotNull()).distinct().orderBy(self.label).collect()]
        self.layers = [(w.copy(), b.copy()) for w, b in self.start or initial_layers([len(self.cols), *self.hidden, max(1, len(self.classes))], self.seed)]
        rows = self._rows(df)
        n = rows.count()
        if n == 0:
            raise ValueError("no complete rows to fit")
        n_batches = -(-n // self.batch_size)
        numbered = rows.withColumn("batch", F.pmod("batch", F.lit(n_batches)))
        rows = stored(numbered.sortWithinPartitions("batch"))
        held = stored(self._rows(validation)) if validation is not None else None
        partitions, held_partitions = (t.rdd.getNumPartitions() if t is not None else 0 for t in (rows, held))
        steps = [tuple(optimizer(self.method, self.lr, 1e-8) for _ in pair) for pair in self.layers]
        order = np.random.default_rng(self.seed)
        per_job = limit_of(df.sparkSession, CELL_ROWS) // self.batch_size
        chained = n_batches > 1 and per_job > 1
        self.history = []
        for _ in range(self.epochs):
            told, numbers = np.zeros(3), order.permutation(n_batches)
            if chained:
                steps, told = self._chained(rows, numbers, per_job, steps)
            for batch in numbers if not chained else ():
                sums = self._sums(rows.filter(F.col("batch") == int(batch)), partitions, True)
                if not sums:
                    continue  # no row has this number
                told += sums[0]
                self._step(steps, sums, sums[0][2])
            self.history.append({"loss": told[0] / told[2], "accuracy": told[1] / told[2]})
            if held is not None:
                seen = self._sums(held, held_partitions, False).get(0, np.array([np.nan, np.nan, 1.0]))
                self.history[-1] |= {"validation_loss": seen[0] / seen[2], "validation_accuracy": seen[1] / seen[2]}
        return self

    def _step(self, steps, sums, n):
        sums = [(sums[i + 1][:w.size].reshape(w.shape), sums[i + 1][w.size:]) for i, (w, _) in enumerate(self.layers)]
        self.layers, self.gradient = stepped(self.layers, steps, sums, n, self.l1, self.l2)

    def _chained(self, rows: DataFrame, order: np.ndarray, per_job: int, steps: list) -> tuple[list, np.ndarray]:
        """An epoch by segments of so many batches: the update rules after it, and (loss, right answers, rows)."""
        places = rows.sparkSession.createDataFrame(pd.DataFrame({"batch": order, "place": range(len(order))}))
        placed = rows.join(F.broadcast(places), "batch").select("place", "x", "y", F.floor(F.col("place") / per_job).cast("int").alias("segment"))
        segments = stored(placed.repartition("segment").sortWithinPartitions("segment"))  # a segment's rows are in a few row groups of one file
        told = np.zeros(3)
        for segment in range(-(-len(order) // per_job)):
            layers, slope, l1, l2, before = self.layers, self.slope, self.l1, self.l2, steps

            def chain(batches):
                net, rules, gradient, total = layers, before, None, np.zeros(3)
                for x, y in _whole_batches(batches):
                    sums, seen = backward(net, x, y, slope)
                    total += seen
                    net, gradient = stepped(net, rules, sums, seen[2], l1, l2)
                if gradient is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps((net, rules, gradient, total))], pa.binary())], names=["state"])

            one = segments.filter(F.col("segment") == segment).select("place", "x", "y").repartition(1).sortWithinPartitions("place", "x", "y")
            for row in one.mapInArrow(chain, "state binary").collect():  # none if no row has these numbers
                self.layers, steps, self.gradient, seen = cloudpickle.loads(row["state"])
                told += seen
        return steps, told

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probabilities` (classes in sorted order) and `prediction`; NULL where a feature is."""
        layers, slope = self.layers, self.slope

        @F.pandas_udf("array<double>")
        def predict(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            known = ~np.isnan(x).any(axis=1)
            p = forward(layers, np.where(known[:, None], x, 0.0), slope)[1]
            return pd.Series([row if k else None for row, k in zip(p, known)])

        scored = df.withColumn("probabilities", predict(*[F.col(c).cast("double") for c in self.cols]))
        best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        return scored.withColumn("prediction", F.when(F.col("probabilities").isNotNull(), F.element_at(F.lit(self.classes), best)))

    def parameters(self, spark) -> DataFrame:
        """(layer, input, output, value, gradient): all numbers of the network, input 0 being the bias, with the last step's gradient."""
        rows = []
        for i, ((w, b), (gw, gb)) in enumerate(zip(self.layers, self.gradient)):
            values, gradients = np.vstack([b, w]), np.vstack([gb, gw])
            rows += [(i, a, c, float(values[a, c]), float(gradients[a, c])) for a in range(values.shape[0]) for c in range(values.shape[1])]
        return spark.createDataFrame(rows, "layer int, input int, output int, value double, gradient double")
