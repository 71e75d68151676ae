import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrove.plans import jobs
from vectrove.sources import logs, raw, tables
from vectrove.sources.storage import locate, scratch


def write(path, array):
    np.asarray(array, dtype="<f4").tofile(path)
    return str(path)


def rows(df):
    return {r["row_id"]: list(r["features"]) for r in df.collect()}


@pytest.fixture
def ten(tmp_path):
    return write(tmp_path / "x.dat", np.arange(30).reshape(10, 3))


def test_reads_rows_with_positions(spark, ten):
    df = raw.read_matrix(spark, ten, 3, partition_bytes=36)
    assert df.rdd.getNumPartitions() == 4
    assert rows(df) == {i: [3.0 * i, 3.0 * i + 1, 3.0 * i + 2] for i in range(10)}


def test_prefix_reads_fewer_spans(spark, ten):
    df = raw.read_matrix(spark, ten, 3, n_rows=4, partition_bytes=12)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(rows(df)) == [0, 1, 2, 3]


def test_sizes_are_checked(spark, ten, tmp_path):
    with pytest.raises(ValueError, match="11 rows"):
        raw.read_matrix(spark, ten, 3, n_rows=11)
    with pytest.raises(ValueError, match="multiple"):
        raw.read_matrix(spark, ten, 4)
    with pytest.raises(FileNotFoundError):
        raw.read_matrix(spark, str(tmp_path / "none"), 3)
    # A prefix of a ragged file is fine.
    assert raw.read_matrix(spark, ten, 4, n_rows=7).count() == 7


def test_round_trip_through_parts(spark, vectors, tmp_path):
    x = np.random.default_rng(1).normal(size=(101, 5)).astype(np.float32)
    df = vectors(x, partitions=6)
    path = str(tmp_path / "parts")
    raw.write_matrix(df, path)
    back = rows(raw.read_matrix(spark, path, 5))
    assert np.array_equal(np.array([back[i] for i in range(101)], dtype=np.float32), x)
    # The parts in name order are one raw file.
    names = sorted(n for n in os.listdir(path) if not n.startswith((".", "_")))
    joined = np.concatenate([np.fromfile(os.path.join(path, n), "<f4") for n in names])
    assert np.array_equal(joined.reshape(-1, 5), x)
    assert not [n for n in os.listdir(path) if n.startswith("_attempt")]


def test_overwrite_leaves_one_matrix(spark, vectors, tmp_path):
    path = str(tmp_path / "parts")
    raw.write_matrix(vectors([[1], [2], [3], [4]], partitions=4), path)
    raw.write_matrix(vectors([[9]], partitions=1), path)
    assert rows(raw.read_matrix(spark, path, 1)) == {0: [9.0]}


def test_ordered_write_needs_ordered_rows(spark, vectors, tmp_path, ten):
    source = raw.read_matrix(spark, ten, 3, partition_bytes=36)
    raw.write_matrix(source, str(tmp_path / "ordered"), ordered=True)
    assert rows(raw.read_matrix(spark, str(tmp_path / "ordered"), 3)) == rows(source)
    shuffled = source.repartitionByRange(2, F.desc("row_id")).sortWithinPartitions("row_id")
    with pytest.raises(Exception, match="order"):
        raw.write_matrix(shuffled, str(tmp_path / "mixed"), ordered=True)
    with pytest.raises(Exception, match="order"):
        raw.write_matrix(source.coalesce(1).sortWithinPartitions(F.desc("row_id")), str(tmp_path / "down"), ordered=True)


def test_labels_are_aligned_across_part_borders(spark, tmp_path, ten):
    folder = tmp_path / "y"
    folder.mkdir()
    for i, (a, b) in enumerate([(0, 1), (1, 1), (1, 7), (7, 10)]):
        write(folder / f"part-{i}", [j % 3 - 1 for j in range(a, b)])
    for size in (12, 24, 60, 1 << 20):
        df = raw.read_labelled(spark, ten, str(folder), 3, partition_bytes=size)
        assert {r["row_id"]: r["label"] for r in df.collect()} == {j: j % 3 - 1 for j in range(10)}
    head = raw.read_labelled(spark, ten, str(folder), 3, n_rows=8)
    assert head.count() == 8
    with pytest.raises(ValueError, match="rows"):
        raw.read_labelled(spark, ten, write(tmp_path / "short", [0, 1]), 3)
    assert raw.read_labels(spark, str(folder)).count() == 10


def test_zip_labels(spark):
    x = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "row_id bigint, features array<double>")
    y = spark.createDataFrame([(1, -1), (0, 1)], "row_id bigint, label int")
    assert {tuple(r)[0]: r["label"] for r in raw.zip_labels(x, y).collect()} == {0: 1, 1: -1}
    with pytest.raises(ValueError, match="1 rows"):
        raw.zip_labels(x, y.filter("row_id = 0"))


def test_write_assignments_returns_counts(spark, tmp_path):
    df = spark.createDataFrame([(i, 300 if i % 3 else 2) for i in range(9)], "row_id bigint, cluster int")
    path = str(tmp_path / "out")
    counts = {tuple(r) for r in raw.write_assignments(df, path).collect()}
    assert counts == {(300, 6), (2, 3)}
    assert {r["row_id"]: r["label"] for r in raw.read_labels(spark, path).collect()} == {
        i: 300 if i % 3 else 2 for i in range(9)
    }


@pytest.mark.parametrize("as_raw", [False, True])
def test_prepare_dataset(spark, vectors, tmp_path, as_raw):
    df = vectors([[i, -i] for i in range(30)], labels=[-1 if i < 5 else i % 2 for i in range(30)])
    path = str(tmp_path / "set")
    jobs.prepare_dataset(df, path, 0.1, seed=1, raw=as_raw)
    if as_raw:
        sets = [raw.read_labelled(spark, f"{path}/X{n}", f"{path}/Y{n}", 2) for n in ("training", "validation")]
    else:
        sets = tables.read_dataset(spark, path)
    values = [{r["features"][0]: r["label"] for r in s.collect()} for s in sets]
    assert (len(values[0]), len(values[1])) == (23, 2)
    assert {**values[0], **values[1]} == {float(i): i % 2 for i in range(5, 30)}


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a").startswith(base + "/a-")
    assert scratch(spark, "a") != scratch(spark, "a")


def test_locate_knows_local_paths(tmp_path):
    assert locate(str(tmp_path))[1] == str(tmp_path)
    assert locate(f"file:{tmp_path}")[1] == str(tmp_path)
    assert locate(f"file://{tmp_path}")[1] == str(tmp_path)


# -- logs ---------------------------------------------------------------------------------

GOOD = "9/9 [====] - 1s - loss: 0.5{i} - accuracy: 0.1 - val_loss: 0.7 - val_accuracy: 0.8"


def test_parse_log(spark):
    lines = [
        (0, GOOD.format(i=0)),
        (1, GOOD.format(i=1).replace("====", "....")),  # no bar
        (2, "9/9 [====] - ETA 1s"),  # nothing to extract
        (3, GOOD.format(i=3) + " [====]"),  # a bar left over
        (4, GOOD.format(i=4) + " trailing"),
        (5, GOOD.format(i="x")),  # not a number
        (6, None),
    ]
    df = logs.parse_training_log(spark.createDataFrame(lines, "ordinal int, line string"))
    got = {r["ordinal"]: (r["loss"], r["accuracy"], r["val_loss"], r["val_accuracy"]) for r in df.collect()}
    assert got == {0: (0.50, 0.1, 0.7, 0.8), 4: (0.54, 0.1, 0.7, 0.8)}


def test_read_log_numbers_lines_over_splits(spark, tmp_path):
    path = tmp_path / "log.txt"
    text = [GOOD.format(i=f"{i:04d}") if i % 3 else "noise" for i in range(3000)]
    path.write_text("\n".join(text))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = logs.read_training_log(spark, str(path))
        got = [(r["epoch"], r["loss"]) for r in df.orderBy("epoch").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    wanted = [float(f"0.5{i:04d}") for i in range(3000) if i % 3]
    assert got == list(enumerate(wanted))


def test_metrics_long_and_wide(spark):
    rows_ = [(0, 0.1, 0.2, 0.3, 0.4), (1, 0.5, 0.6, 0.7, 0.8)]
    df = spark.createDataFrame(rows_, "epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
    long = logs.log_metrics_long(df)
    assert {tuple(r) for r in long.collect()} == {
        (0, "loss", 0.1), (0, "accuracy", 0.2), (0, "eval_accuracy", 0.4),
        (1, "loss", 0.5), (1, "accuracy", 0.6), (1, "eval_accuracy", 0.8),
    }
    wide = logs.pivot_metrics(long)
    assert sorted(wide.columns) == ["accuracy", "epoch", "eval_accuracy", "loss"]
    assert {r["epoch"]: (r["loss"], r["eval_accuracy"]) for r in wide.collect()} == {0: (0.1, 0.4), 1: (0.5, 0.8)}


def test_assignment_is_evaluated_once(spark, tmp_path):
    rows = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def cluster(i):
        rows.add(1)
        return i % 3

    assigned = spark.range(0, 500, 1, 4).select(F.col("id").alias("row_id"), cluster("id").alias("cluster"))
    counts = raw.write_assignments(assigned, str(tmp_path / "a"))
    assert {tuple(r) for r in counts.collect()} == {(0, 167), (1, 167), (2, 166)} and rows.value == 500
    raw.write_assignments(assigned, str(tmp_path / "p"), parquet=True)
    assert spark.read.parquet(str(tmp_path / "p")).where("cluster = row_id % 3").count() == 500


def test_row_bounds_reach_the_spans(spark, tmp_path):
    path = str(tmp_path / "x")
    raw.write_matrix(spark.range(1000).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("float")).alias("features")), path)
    reader = raw.RawMatrixReader({"path": path, "dim": "1", "partition_bytes": "400"})
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    assert len(list(reader.pushFilters([GreaterThanOrEqual(("row_id",), 250), LessThan(("row_id",), 260)]))) == 2
    assert sum(s.rows for s in reader.partitions()) == 10 and reader.partitions()[0].first_row == 250
    rows = raw.read_matrix(spark, path, 1).filter(F.col("row_id").between(250, 259)).collect()
    assert [(r["row_id"], r["features"][0]) for r in sorted(rows)] == [(i, float(i)) for i in range(250, 260)]
    assert raw.read_matrix(spark, path, 1).filter("row_id > 5000").count() == 0


class Counting:
    """A file that counts the bytes read from it."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, size, at):
        self.read += size
        return self.data[at : at + size]


def test_mask_at_the_scan(spark, tmp_path):
    x = np.arange(2000, dtype="<f4").reshape(20, 100)
    path, mask = write(tmp_path / "x", x), [41, 30, 35]
    labels = write(tmp_path / "y", np.arange(20) % 3)
    found = raw.read_labelled(spark, path, labels, 100, partition_bytes=2800, features=mask).collect()
    assert [f.features for f in sorted(found)] == x[:, mask].tolist()
    assert [f.label for f in sorted(found)] == [i % 3 for i in range(20)]
    masked = raw.read_matrix(spark, path, 100, n_rows=5, features=mask)
    assert rows(masked) == dict(enumerate(x[:5, mask].tolist()))
    assert raw.read_matrix(spark, path, 100, features=mask).filter("row_id = 7").collect()[0].features == x[7, mask].tolist()
    for wrong in ([1, 1], [100], [-1], []):
        with pytest.raises(ValueError):
            raw.read_matrix(spark, path, 100, features=wrong)


@pytest.mark.parametrize(("skip", "read"), [(200, 20 * 12 * 4), (1 << 20, 19 * 400 + 48)])
def test_mask_reads_the_span_it_needs(skip, read):
    x = np.arange(2000, dtype="<f4").reshape(20, 100)
    reader = raw.RawMatrixReader({"path": "x", "dim": "100", "features": "41,30,35", "skip_bytes": str(skip)})
    source = Counting(x.tobytes())
    assert reader._values(source, 0, 20).reshape(20, 3).tolist() == x[:, [41, 30, 35]].tolist()
    assert source.read == read
    with pytest.raises(OSError, match="shorter"):
        reader._values(Counting(x.tobytes()[:7000]), 0, 20)
