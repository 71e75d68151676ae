"""Network training with one job an epoch: a barrier stage whose tasks keep their rows.

Every task holds its share of the rows, sorted by step, and a copy of the network. In a step
each works out the sums of its own rows; ``allGather`` hands every task all of them, in task
order, so all copies change alike and stay equal. The weights are those of
:func:`vectrove.operators.network.fit_network`, but for the order in which numbers are added.

All tasks of the stage run at once, and a step's sums pass through the driver's coordinator
once for each task, so this is for networks of bounded size (``EXCHANGE``) on a fixed number of
slots; a task lost starts its epoch anew, and a stored epoch is never trained again. Spark
answers an ``allGather`` about once a second, so a step takes a second, or two with batch
normalisation, whatever the rows: it pays where two jobs a step take longer than that.
"""

from __future__ import annotations

import base64
import copy
import math
import pickle
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.functions.vectors import matrix, row_slices
from vectrove.operators import network as net
from vectrove.operators.centroids import local_frame
from vectrove.operators.sample import sample_up_to

#: Parameters of a network whose sums are exchanged; numbers of a task's rows.
EXCHANGE, HELD = 1_000_000, 100_000_000
#: Bytes of a state row.
PIECE = 4 << 20


def slots(spark) -> int:
    """Tasks that can run at once; 0 where Spark can't hold a barrier stage."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    return spark.sparkContext.defaultParallelism


def _gathered(values: np.ndarray) -> np.ndarray:
    """The sum over all tasks, added in task order; a task without rows sends nothing."""
    message = base64.b64encode(zlib.compress(values.astype("<f8").tobytes(), 1)).decode() if len(values) else ""
    total = None
    for text in BarrierTaskContext.get().allGather(message):
        if text:
            part = np.frombuffer(zlib.decompress(base64.b64decode(text)), "<f8")
            total = part.copy() if total is None else total + part
    return np.zeros(0) if total is None else total


def _block_sums(x: np.ndarray, y: np.ndarray, elements: int, per_block) -> np.ndarray:
    total = None
    for part in row_slices(len(x), elements):
        flat = np.concatenate([b.ravel() for b in per_block(x[part].astype(np.float64), y[part])])
        total = flat if total is None else total + flat
    return np.zeros(0) if total is None else total


def _epoch(shared, order: list[int], learning_rate: float):
    """The stage's map: all steps of an epoch; the first task gives back the state and the sums of the metrics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, squares = pickle.loads(shared.value)
        xs, ys, steps = [np.zeros((0, network.width))], [np.zeros(0)], [np.zeros(0, np.int64)]
        for batch in batches:
            xs.append(matrix(batch.column("features"), network.width))
            ys.append(batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64))
            steps.append(batch.column("step").to_numpy().astype(np.int64))
        step = np.concatenate(steps)
        by = np.argsort(step, kind="stable")
        # What the rows came in is kept, not widened: the empty first block is left out where there are others.
        x, y, step = np.concatenate(xs[1:] or xs)[by], np.concatenate(ys)[by], step[by]
        elements = net._row_elements(network)
        seen = np.zeros(3)
        for now in order:
            at = slice(int(np.searchsorted(step, now)), int(np.searchsorted(step, now + 1)))
            moments = None
            if network.normalised:
                width = network.layers[0].parameters["bias"].size

                def activations(a, _):
                    a = net._dense(a, network.layers[0])
                    return [np.array([float(len(a))]), a.sum(axis=0), (a * a).sum(axis=0)]

                sums = _gathered(_block_sums(x[at], y[at], elements, activations))
                if not len(sums):
                    continue
                mean = sums[1 : width + 1] / sums[0]
                moments = mean, np.maximum(sums[width + 1 :] / sums[0] - mean * mean, 0.0)
            flat = _gathered(_block_sums(x[at], y[at], elements, lambda a, b, m=moments: net._gradient_sums(network, a, b, m)))
            if not len(flat):
                continue
            gradients, moments, loss, accuracy, n = net._from_sums(network, flat, moments)
            net.adagrad_step(network, squares, gradients, moments, learning_rate)
            seen += np.array([n, loss * n, accuracy * n])
        if BarrierTaskContext.get().partitionId() == 0:
            data = pickle.dumps((network, squares, seen))
            pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], ["at", "data"])

    return run


def fit_network_barrier(
    train: DataFrame,
    validation: DataFrame | None = None,
    network: net.Network | None = None,
    epochs: int = net.EPOCHS,
    batch_size: int = net.BATCH,
    learning_rate: float = net.LEARNING_RATE,
    max_rows: int | None = None,
    seed: int = 0,
    features: str = "features",
    label: str = "label",
    row_id: str = "row_id",
    checkpoints: str | None = None,
    tasks: int | None = None,
) -> net.TrainingResult:
    """:func:`vectrove.operators.network.fit_network` in one job an epoch, and another for its validation.

    Steps, their order and the metrics are as there. ``tasks`` (by default all slots) hold the
    rows; too few for them, or a network beyond ``EXCHANGE`` parameters, is an error. With
    ``checkpoints``, a folder all executors see, every epoch's state is written there as a table,
    and training goes on after the last one found.
    """
    spark = train.sparkSession
    if max_rows is not None:
        train = sample_up_to(train, max_rows, f"{seed}:train", row_id)
    rows = train.count()
    if rows == 0:
        raise ValueError("training over an empty table")
    network = net.build_network(int(train.select(F.size(features)).first()[0]), seed=seed) if network is None else copy.deepcopy(network)
    free = slots(spark)
    tasks = tasks or min(free, rows)
    if not 0 < tasks <= free or rows * network.width > HELD * tasks:
        raise ValueError(f"{rows} rows of width {network.width} need more than {tasks} of {free} slots")
    if network.size() > EXCHANGE:
        raise ValueError(f"the sums of {network.size()} parameters are too many to exchange in every step")
    steps = math.ceil(rows / batch_size)
    staged = (
        train.select(
            F.col(features).alias("features"),
            F.col(label).cast("double").alias("label"),
            F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(steps)).cast("int").alias("step"),
        )
        .repartition(tasks)  # evenly, so every step has rows in every task
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    rng = np.random.default_rng(seed)
    squares = [{name: np.zeros_like(p) for name, p in layer.parameters.items()} for layer in network.layers]
    history: list[tuple] = []
    if (kept := _restored(spark, checkpoints, epochs)) is not None:
        network, squares, history = kept
    try:
        for epoch in range(epochs):
            order = rng.permutation(steps).tolist()
            if epoch < len(history):
                continue  # stored before
            started = time.monotonic()
            shared = spark.sparkContext.broadcast(pickle.dumps((network, squares)))
            found = staged.mapInArrow(_epoch(shared, order, learning_rate), "at int, data binary", barrier=True).collect()
            shared.destroy()
            network, squares, seen = pickle.loads(b"".join(r.data for r in sorted(found, key=lambda r: r.at)))
            held_out = (None, None)
            if validation is not None:
                row = net.evaluate_network(validation, network, label, features).first()
                held_out = (row["loss"], row["accuracy"])
            history.append((epoch, float(seen[1] / seen[0]), float(seen[2] / seen[0]), *held_out, time.monotonic() - started))
            if checkpoints is not None:
                _store(spark, checkpoints, network, squares, history)
    finally:
        staged.unpersist()
    return net.TrainingResult(network, local_frame(spark, history, net.HISTORY_SCHEMA))


def _place(checkpoints: str, epoch: int) -> str:
    return f"{checkpoints.rstrip('/')}/epoch-{epoch:05d}"


def _store(spark, checkpoints: str, network: net.Network, squares: list[dict], history: list[tuple]) -> None:
    """One row: the model, the optimiser's sums, all metrics so far. Spark marks the table when it is whole."""
    row = [(pickle.dumps((network, squares, history)),)]
    spark.createDataFrame(row, "state binary").coalesce(1).write.mode("overwrite").parquet(_place(checkpoints, len(history) - 1))


def _restored(spark, checkpoints: str | None, epochs: int):
    """The state after the last whole epoch of at most ``epochs``; None without any."""
    if checkpoints is None:
        return None
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for epoch in range(epochs - 1, -1, -1):
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_place(checkpoints, epoch)}/_SUCCESS")
        if done.getFileSystem(hadoop).exists(done):
            return pickle.loads(spark.read.schema("state binary").parquet(_place(checkpoints, epoch)).first().state)
    return None
