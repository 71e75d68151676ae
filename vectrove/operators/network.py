"""A feed-forward binary classifier trained by synchronous data-parallel jobs.

A training step sums the activations batch normalisation needs over the rows of one mini-batch,
then gradients. Both sums are exact over the whole mini-batch, so the result does not depend on
how rows are partitioned. Weights are broadcast (their size is fixed by the architecture); the
optimiser step runs on the driver.

A mini-batch of up to ``TASK_ROWS`` rows lies in one partition and is one job of one task, which
reads no other partition. Larger ones take a job over their partitions for each of the two sums.
"""

from __future__ import annotations

import copy
import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove.functions.vectors import matrix, row_slices
from vectrove.operators.centroids import local_frame, point_numbers
from vectrove.operators.reduce import CHUNK_SCHEMA, chunks, sum_chunks
from vectrove.operators.sample import sample_up_to

# Training set-up of the classifier.
HIDDEN = (1024, 512, 256, 128, 64)
FIRST = 1024
EPOCHS = 300
BATCH = 256
LEARNING_RATE = 0.0007
BN_MOMENTUM = 0.99
BN_EPSILON = 0.001
OPTIMISER_EPSILON = 1e-7
CLIP = 1e-7

MAX_PARAMETERS = 64_000_000
# Rows of a step that one task takes.
TASK_ROWS = 4096
# Rows of one partition of mini-batches, about; partitions at most.
PARTITION_ROWS, PARTITIONS = 4096, 16_384
# Numbers of a mini-batch that a task holds; of a larger one it makes a pass for each sum.
HELD_NUMBERS = 16_000_000
MODEL_SCHEMA = "layer int, kind string, activation string, parameter string, shape array<int>, values array<double>"
HISTORY_SCHEMA = (
    "epoch int, loss double, accuracy double, val_loss double, val_accuracy double, seconds double"
)


@dataclass
class Layer:
    """One layer: ``dense`` (kernel, bias) or ``batch_norm`` (gamma, beta, mean, variance)."""

    kind: str
    activation: str
    parameters: dict[str, np.ndarray] = field(default_factory=dict)


@dataclass
class Network:
    layers: list[Layer]

    @property
    def width(self) -> int:
        return self.layers[0].parameters["kernel"].shape[0]

    @property
    def normalised(self) -> bool:
        return len(self.layers) > 1 and self.layers[1].kind == "batch_norm"

    def size(self) -> int:
        return sum(p.size for layer in self.layers for p in layer.parameters.values())


def build_network(
    width: int, first: int = FIRST, hidden: Sequence[int] = HIDDEN, batch_norm: bool = True, seed: int = 0
) -> Network:
    """Dense relu, batch normalisation, dense relu layers, one sigmoid unit.

    Kernels are uniform with the fan-average bound, biases 0.
    """
    rng = np.random.default_rng(seed)

    def dense(fan_in: int, fan_out: int, activation: str) -> Layer:
        bound = math.sqrt(6.0 / (fan_in + fan_out))
        kernel = rng.uniform(-bound, bound, (fan_in, fan_out))
        return Layer("dense", activation, {"kernel": kernel, "bias": np.zeros(fan_out)})

    layers = [dense(width, first, "relu")]
    if batch_norm:
        layers.append(
            Layer(
                "batch_norm",
                "linear",
                {"gamma": np.ones(first), "beta": np.zeros(first), "mean": np.zeros(first), "variance": np.ones(first)},
            )
        )
    widths = [first, *hidden]
    layers += [dense(a, b, "relu") for a, b in zip(widths, widths[1:])]
    layers.append(dense(widths[-1], 1, "sigmoid"))
    network = Network(layers)
    if network.size() > MAX_PARAMETERS:
        raise ValueError(f"{network.size()} parameters are too many to broadcast")
    return network


# -- task-side arithmetic -----------------------------------------------------------------


def _dense(x: np.ndarray, layer: Layer) -> np.ndarray:
    z = x @ layer.parameters["kernel"] + layer.parameters["bias"]
    if layer.activation == "relu":
        return np.maximum(z, 0.0)
    if layer.activation == "sigmoid":
        return np.exp(-np.logaddexp(0.0, -z))
    return z


def _normalise(a: np.ndarray, mean: np.ndarray, variance: np.ndarray) -> np.ndarray:
    return (a - mean) / np.sqrt(variance + BN_EPSILON)


def forward(network: Network, x: np.ndarray) -> np.ndarray:
    """Probabilities, with the moving statistics of batch normalisation."""
    for layer in network.layers:
        p = layer.parameters
        if layer.kind == "batch_norm":
            x = p["gamma"] * _normalise(x, p["mean"], p["variance"]) + p["beta"]
        else:
            x = _dense(x, layer)
    return x[:, 0]


def _losses(y: np.ndarray, p: np.ndarray) -> np.ndarray:
    clipped = np.clip(p, CLIP, 1.0 - CLIP)
    return -(y * np.log(clipped) + (1.0 - y) * np.log(1.0 - clipped))


def _gradient_sums(network: Network, x: np.ndarray, y: np.ndarray, moments) -> list[np.ndarray]:
    """Unscaled gradient sums of some rows of a mini-batch, as arrays to add up over tasks.

    Batch normalisation makes a row's gradient depend on two means over the whole
    mini-batch. The first kernel's gradient is linear in them, so its three coefficients are
    summed apart and combined on the driver, which saves a third job.
    """
    layers = network.layers
    first = _dense(x, layers[0])
    active = first > 0.0
    start = 1
    a = first
    if moments is not None:
        scaled = _normalise(first, *moments)
        bn = layers[1].parameters
        a = bn["gamma"] * scaled + bn["beta"]
        start = 2
    inputs = [a]
    for layer in layers[start:]:
        inputs.append(_dense(inputs[-1], layer))
    p = inputs[-1][:, 0]
    score = np.array([_losses(y, p).sum(), float(((p > 0.5) == (y > 0.5)).sum()), float(len(y))])
    delta = (p - y)[:, None]  # of the sigmoid's input, for the log loss
    upper: list[np.ndarray] = []
    for at in range(len(layers) - 1, start - 1, -1):
        below = inputs[at - start]
        upper += [below.T @ delta, delta.sum(axis=0)]
        delta = delta @ layers[at].parameters["kernel"].T
        if at > start:
            delta = delta * (below > 0.0)
    if moments is None:
        delta = delta * active
        return [score, x.T @ delta, delta.sum(axis=0), *upper]
    weighted, on = delta * active, active.astype(np.float64)
    shifted = on * scaled
    return [
        score,
        x.T @ weighted, weighted.sum(axis=0),
        x.T @ on, on.sum(axis=0),
        x.T @ shifted, shifted.sum(axis=0),
        delta.sum(axis=0), (delta * scaled).sum(axis=0),
        *upper,
    ]


def _shapes(network: Network, with_moments: bool) -> list[tuple[int, ...]]:
    first = network.layers[0].parameters
    w, b = first["kernel"].shape, first["bias"].shape
    shapes: list[tuple[int, ...]] = [(3,), w, b]
    if with_moments:
        shapes += [w, b, w, b, b, b]
    for layer in reversed(network.layers[2 if with_moments else 1 :]):
        shapes += [layer.parameters["kernel"].shape, layer.parameters["bias"].shape]
    return shapes


def _row_elements(network: Network) -> int:
    return network.width + sum(l.parameters["bias"].size for l in network.layers if l.kind == "dense") * 2


def _sum_over(rows: DataFrame, size: int, per_block, width: int, row_elements: int) -> np.ndarray:
    """Sum ``per_block(x, y)`` (a list of arrays) over all rows of a mini-batch."""

    def run(batches):
        total = None
        for batch in batches:
            x = matrix(batch.column("features"), width)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            for part in row_slices(len(x), row_elements):
                block = per_block(x[part].astype(np.float64), y[part].astype(np.float64))
                flat = np.concatenate([b.ravel() for b in block])
                total = flat if total is None else total + flat
        if total is not None:
            yield from chunks(total)

    return sum_chunks(rows.mapInArrow(run, CHUNK_SCHEMA), size)


def batch_gradient(network: Network, rows: DataFrame):
    """Exact gradient of the mean log loss over ``rows (features, label)``.

    Returns (gradients per layer and parameter, batch moments or ``None``, loss, accuracy,
    row count).
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(network)
    elements = _row_elements(network)
    moments = None
    try:
        if network.normalised:
            width = network.layers[0].parameters["bias"].size

            def activations(x, y):
                a = _dense(x, shared.value.layers[0])
                return [np.array([float(len(a))]), a.sum(axis=0), (a * a).sum(axis=0)]

            sums = _sum_over(rows, 2 * width + 1, activations, network.width, elements)
            if sums[0] == 0:
                return None
            moments = _moments(sums, width)
        shapes = _shapes(network, moments is not None)
        size = sum(math.prod(s) for s in shapes)
        flat = _sum_over(
            rows, size, lambda x, y: _gradient_sums(shared.value, x, y, moments), network.width, elements
        )
    finally:
        shared.destroy()
    return _from_sums(network, flat, moments)


class StepBlocks:
    """Mini-batches as blocks of rows, cached step by step, so that a step is a job of one task.

    ``rows(features, label, step)``; partition ``step % partitions`` holds a step's rows. A task
    streams its partition and keeps blocks of its own step only.
    """

    def __init__(self, rows: DataFrame, steps: int, batch_size: int, network: Network):
        parallel = rows.sparkSession.sparkContext.defaultParallelism
        self.partitions = min(steps, PARTITIONS, max(parallel, -(-steps * batch_size // PARTITION_ROWS)))
        width = self.width = network.width
        placed = rows.repartitionById(self.partitions, F.pmod("step", F.lit(self.partitions)).cast("int")).sortWithinPartitions("step")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("features"), width)
                y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
                step = batch.column("step").to_numpy()
                starts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]]) if len(step) else []
                for a, b in zip(starts, [*starts[1:], len(step)]):
                    for at in range(a, b, TASK_ROWS):
                        part = slice(at, min(b, at + TASK_ROWS))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([int(step[a])], pa.int32()),
                                pa.array([x.dtype.str]),
                                pa.array([np.ascontiguousarray(x[part]).tobytes()], pa.binary()),
                                pa.array([y[part].tobytes()], pa.binary()),
                            ],
                            ["step", "kind", "x", "y"],
                        )

        blocks = placed.mapInArrow(pack, "step int, kind string, x binary, y binary")
        self.blocks = blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)

    def _run(self, step: int, task: Callable[[Iterator[tuple]], list]) -> list:
        width = self.width

        def run(blocks):
            held = ((np.frombuffer(x, kind).reshape(-1, width), np.frombuffer(y, "<f8")) for at, kind, x, y in blocks if at == step)
            return task(held)

        return self.blocks.context.runJob(self.blocks, run, [step % self.partitions])

    def gradient(self, network: Network, step: int):
        """As :func:`batch_gradient`, of the rows of one step."""
        shared = self.blocks.context.broadcast(network)
        elements, normalised = _row_elements(network), network.normalised
        units = network.layers[0].parameters["bias"].size

        def activations(x, y):
            a = _dense(x, shared.value.layers[0])
            return [np.array([float(len(a))]), a.sum(axis=0), (a * a).sum(axis=0)]

        def gradients(moments):
            return lambda x, y: _gradient_sums(shared.value, x, y, moments)

        def whole(blocks):
            rows, numbers = [], 0
            for x, y in blocks:
                rows.append((x, y))
                numbers += x.size
                if normalised and numbers > HELD_NUMBERS:
                    return []
            moments = _moments(_block_sums(rows, elements, activations), units) if normalised and rows else None
            return [(_block_sums(rows, elements, gradients(moments)), moments)]

        try:
            found = self._run(step, whole)
            if not found:  # very many rows of one step, as of one id that repeats
                moments = _moments(self._run(step, lambda blocks: [_block_sums(blocks, elements, activations)])[0], units)
                found = self._run(step, lambda blocks: [(_block_sums(blocks, elements, gradients(moments)), moments)])
        finally:
            shared.destroy()
        flat, moments = found[0]
        return None if flat is None else _from_sums(network, flat, moments)

    def unpersist(self) -> None:
        self.blocks.unpersist()


def _block_sums(blocks, elements: int, per_block) -> np.ndarray | None:
    """Sum ``per_block(x, y)`` over blocks of rows, one after the other; ``None`` without any."""
    total = None
    for x, y in blocks:
        for part in row_slices(len(x), elements):
            flat = np.concatenate([b.ravel() for b in per_block(x[part].astype(np.float64), y[part])])
            total = flat if total is None else total + flat
    return total


def _moments(sums: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the first layer's activations from their count, sums and sums of squares."""
    mean = sums[1 : width + 1] / sums[0]
    return mean, np.maximum(sums[width + 1 :] / sums[0] - mean * mean, 0.0)


def _from_sums(network: Network, flat: np.ndarray, moments):
    """Gradients, moments, loss, accuracy and row count from the sums over a mini-batch; ``None`` without rows."""
    shapes = _shapes(network, moments is not None)
    parts, at = [], 0
    for shape in shapes:
        parts.append(flat[at : at + math.prod(shape)].reshape(shape))
        at += math.prod(shape)
    n = parts[0][2]
    if n == 0:
        return None
    if moments is None:
        gradients = [{"kernel": parts[1] / n, "bias": parts[2] / n}]
        upper = parts[3:]
    else:
        dy, dy_scaled = parts[7], parts[8]
        gain = network.layers[1].parameters["gamma"] / np.sqrt(moments[1] + BN_EPSILON)
        gradients = [
            {
                "kernel": gain * (parts[1] - parts[3] * (dy / n) - parts[5] * (dy_scaled / n)) / n,
                "bias": gain * (parts[2] - parts[4] * (dy / n) - parts[6] * (dy_scaled / n)) / n,
            },
            {"gamma": dy_scaled / n, "beta": dy / n},
        ]
        upper = parts[9:]
    pairs = [{"kernel": upper[i] / n, "bias": upper[i + 1] / n} for i in range(0, len(upper), 2)]
    return gradients + pairs[::-1], moments, float(parts[0][0] / n), float(parts[0][1] / n), int(n)


# -- operators ----------------------------------------------------------------------------


def score_network(df: DataFrame, network: Network, features: str = "features") -> DataFrame:
    """Add ``probability``: a map, for streams too."""
    shared = df.sparkSession.sparkContext.broadcast(network)
    width, elements = network.width, _row_elements(network)

    @F.arrow_udf("double")
    def probability(vectors: pa.Array) -> pa.Array:
        x = matrix(vectors, width)
        out = np.empty(len(x))
        for rows in row_slices(len(x), elements):
            out[rows] = forward(shared.value, x[rows].astype(np.float64))
        return pa.array(out)

    return df.withColumn("probability", probability(F.col(features)))


def _log_loss(truth: str, probability: str):
    p = F.least(F.greatest(F.col(probability), F.lit(CLIP)), F.lit(1.0 - CLIP))
    y = F.col(truth).cast("double")
    return F.avg(-(y * F.log(p) + (1.0 - y) * F.log(1.0 - p)))


def _hit_rate(truth: str, probability: str):
    return F.avg(((F.col(probability) > 0.5) == (F.col(truth) > 0.5)).cast("double"))


def binary_log_loss(df: DataFrame, truth: str = "label", probability: str = "probability") -> DataFrame:
    """``log_loss``: mean binary cross-entropy, probabilities clipped to [1e-7, 1 - 1e-7]."""
    return df.agg(_log_loss(truth, probability).alias("log_loss"))


def binary_accuracy(df: DataFrame, truth: str = "label", probability: str = "probability") -> DataFrame:
    """``accuracy``: share of rows on the right side of 0.5."""
    return df.agg(_hit_rate(truth, probability).alias("accuracy"))


def evaluate_network(df: DataFrame, network: Network, label: str = "label", features: str = "features") -> DataFrame:
    """``loss, accuracy`` of a network over a table, in one scan."""
    scored = score_network(df.select(features, label), network, features)
    return scored.agg(_log_loss(label, "probability").alias("loss"), _hit_rate(label, "probability").alias("accuracy"))


def adagrad_step(network: Network, squares: list[dict], gradients: list[dict], moments, learning_rate: float) -> None:
    """Change the network, and its sums of squared gradients, by one mini-batch."""
    for layer, gradient, held in zip(network.layers, gradients, squares):
        for name, g in gradient.items():
            held[name] += g * g
            layer.parameters[name] = layer.parameters[name] - learning_rate * g / (np.sqrt(held[name]) + OPTIMISER_EPSILON)
    if moments is not None:
        bn = network.layers[1].parameters
        bn["mean"] = BN_MOMENTUM * bn["mean"] + (1.0 - BN_MOMENTUM) * moments[0]
        bn["variance"] = BN_MOMENTUM * bn["variance"] + (1.0 - BN_MOMENTUM) * moments[1]


@dataclass
class TrainingResult:
    network: Network
    history: DataFrame  # epoch, loss, accuracy, val_loss, val_accuracy, seconds


def fit_network(
    train: DataFrame,
    validation: DataFrame | None = None,
    network: Network | None = None,
    epochs: int = EPOCHS,
    batch_size: int = BATCH,
    learning_rate: float = LEARNING_RATE,
    max_rows: int | None = None,
    seed: int = 0,
    features: str = "features",
    label: str = "label",
    row_id: str = "row_id",
) -> TrainingResult:
    """Train with Adagrad on the log loss; metrics after every epoch.

    An epoch has ``ceil(rows / batch_size)`` steps, whatever the size of the table; ``max_rows``
    bounds the labelled rows that are learnt from to an exact sample of so many (all rows by
    default). Rows go to steps by hash, about ``batch_size`` to each, the same in every epoch,
    and lie in the cache by step (see :class:`StepBlocks`; sorted, where a step has more than
    ``TASK_ROWS`` rows, so that its statistics let a step skip the batches of the others); the
    order of the steps changes with every epoch. The given network is not changed: a copy is
    trained.
    """
    spark = train.sparkSession
    if max_rows is not None:
        train = sample_up_to(train, max_rows, f"{seed}:train", row_id)
    rows = train.count()
    if rows == 0:
        raise ValueError("training over an empty table")
    steps = math.ceil(rows / batch_size)
    if network is None:
        network = build_network(int(train.select(F.size(features)).first()[0]), seed=seed)
    else:
        network = copy.deepcopy(network)
    staged = train.select(
        F.col(features).alias("features"),
        F.col(label).cast("double").alias("label"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(steps)).cast("int").alias("step"),
        F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(math.ceil(batch_size / TASK_ROWS))).alias("part"),
    )
    if batch_size <= TASK_ROWS:
        staged = StepBlocks(staged.drop("part"), steps, batch_size, network)

        def gradient_of(step: int):
            return staged.gradient(network, step)
    else:
        # A step's rows lie in few partitions: each task of a step sends a whole gradient.
        staged = staged.repartition("step", "part").sortWithinPartitions("step").drop("part").persist(StorageLevel.MEMORY_AND_DISK)

        def gradient_of(step: int):
            return batch_gradient(network, staged.filter(F.col("step") == step).select("features", "label"))

    rng = np.random.default_rng(seed)
    squares = [{name: np.zeros_like(p) for name, p in layer.parameters.items()} for layer in network.layers]
    history = []
    try:
        for epoch in range(epochs):
            started = time.monotonic()
            seen, loss, accuracy = 0, 0.0, 0.0
            for step in rng.permutation(steps):
                result = gradient_of(int(step))
                if result is None:
                    continue
                gradients, moments, step_loss, step_accuracy, n = result
                adagrad_step(network, squares, gradients, moments, learning_rate)
                seen, loss, accuracy = seen + n, loss + step_loss * n, accuracy + step_accuracy * n
            held_out = (None, None)
            if validation is not None:
                row = evaluate_network(validation, network, label, features).first()
                held_out = (row["loss"], row["accuracy"])
            history.append((epoch, loss / seen, accuracy / seen, *held_out, time.monotonic() - started))
    finally:
        staged.unpersist()
    return TrainingResult(network, local_frame(spark, history, HISTORY_SCHEMA))


def network_frame(spark: SparkSession, network: Network) -> DataFrame:
    """Model table: one row per parameter array."""
    rows = [
        (i, layer.kind, layer.activation, name, list(p.shape), p.ravel().tolist())
        for i, layer in enumerate(network.layers)
        for name, p in layer.parameters.items()
    ]
    return local_frame(spark, rows, MODEL_SCHEMA)


def save_network(spark: SparkSession, network: Network, path: str) -> None:
    """Write architecture and weights as one Parquet model table."""
    network_frame(spark, network).coalesce(1).write.mode("overwrite").parquet(path)


def load_network(spark: SparkSession, path: str) -> Network:
    """Read a model table back."""
    layers: dict[int, Layer] = {}
    table = spark.read.parquet(path)
    held = point_numbers(table, "values")
    if held > MAX_PARAMETERS:
        raise ValueError(f"{held} numbers are too many for a network that is broadcast")
    for row in table.collect():
        layer = layers.setdefault(row["layer"], Layer(row["kind"], row["activation"]))
        layer.parameters[row["parameter"]] = np.array(row["values"]).reshape(row["shape"])
    if not layers:
        raise ValueError(f"no network at {path}")
    return Network([layers[i] for i in sorted(layers)])
