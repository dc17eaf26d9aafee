"""Data side of embedding training: examples, views, batches, losses, batch scoring."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cadenza.functions.scalars import finite_or_zero
from cadenza.operators.clean import scale_params, attach_row
from cadenza.operators.joins import with_group_totals
from cadenza.operators.ordering import with_shuffled_position
from cadenza.session import write_and_read

# Defaults.
NOISE_STD = 0.15
TEMPERATURE = 0.07
CONTRASTIVE_BATCH = 2048
RETRIEVAL_BATCH = 1024
NORM = ("mean", "variance", "gamma", "beta")
LAYER_SCHEMA = ("layer int, weights array<array<double>>, bias array<double>, activation string, "
                + ", ".join(f"{c} array<double>" for c in NORM))
#: Weights of a network that is sent to every task.
MAX_WEIGHTS = 50_000_000


def profile_examples(df: DataFrame, profile: str, features, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(id, profile, item_vec, user_vec) and the scaling parameters.

    The user vector is the mean of the other rows of the profile; a profile with one row
    uses that row. Group sums are aggregated and joined back, so a profile holding a large
    share of the rows is never gathered in one task.
    """
    work = df.filter(F.col(profile).isNotNull()).select(
        id_col, F.col(profile).cast("string").alias("profile"),
        *[finite_or_zero(F.col(c)).alias(c) for c in features])
    # written once: both the group sums and the rows below are scaled with it
    params = write_and_read(scale_params(work, features), "scale-params")
    s = F.col("_stats")
    scaled = attach_row(work, params).withColumns(
        {c: (F.col(c) - s[f"shift_{c}"]) / s[f"scale_{c}"] for c in features}).drop("_stats")
    totals = with_group_totals(scaled, "profile", features, spread=[id_col])
    n = F.col("group_n")

    def others(c):
        return F.when(n > 1, (F.col(f"group_sum_{c}") - F.col(c)) / (n - 1)).otherwise(F.col(c))

    examples = totals.select(id_col, "profile", "group_n",
                             F.array(*[F.col(c) for c in features]).alias("item_vec"),
                             F.array(*[others(c) for c in features]).alias("user_vec"))
    return examples, params


def training_summary(examples: DataFrame, features) -> DataFrame:
    per_profile = examples.groupBy("profile").agg(F.count("*").alias("n"))
    return per_profile.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_profiles"),
                           F.lit(len(features)).alias("n_features"))


def augmented_views(df: DataFrame, vec: str = "vec", size: int = 9, std: float = NOISE_STD, seed: int = 42,
                    id_col: str = "id") -> DataFrame:
    """Two noisy copies of each vector.

    The normal noise is drawn from a hash of seed, row id and position (Box-Muller), so a row
    gets the same noise on every run, in any partitioning and after a lost executor.
    """
    def uniform(digest, start):
        return (F.conv(F.substring(digest, start, 13), 16, 10).cast("double") + 0.5) / float(16 ** 13)

    def pair(i):
        digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}:{i}")))
        radius = std * F.sqrt(-2.0 * F.log(uniform(digest, 1)))
        angle = 2.0 * math.pi * uniform(digest, 14)
        return F.col(vec)[i] + radius * F.cos(angle), F.col(vec)[i] + radius * F.sin(angle)

    pairs = [pair(i) for i in range(size)]
    return df.withColumns({"view1": F.array(*[a for a, _ in pairs]), "view2": F.array(*[b for _, b in pairs])})


def training_batches(df: DataFrame, batch_size: int, id_col: str = "id", seed: int = 42,
                     drop_remainder: bool = False) -> DataFrame:
    """Rows in a seeded shuffle with ``batch_id`` and ``batch_pos``."""
    placed = with_shuffled_position(df, id_col, seed, "_pos")
    out = placed.withColumn("batch_id", F.floor(F.col("_pos") / batch_size)) \
        .withColumn("batch_pos", F.col("_pos") % batch_size)
    if drop_remainder:
        n = df.agg(F.count("*")).scalar()
        out = out.filter(F.col("batch_id") < F.floor(n / batch_size))
    return out.drop("_pos")


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    return _rows(table.column(name).combine_chunks())


def _rows(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _log_sum_exp(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]


LOSS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("loss", T.DoubleType())])


def contrastive_loss(batches: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Symmetric in-batch contrastive loss of unit vectors z1, z2: one row per batch.

    A batch is the unit of the loss and has a fixed size, so its score matrix stays in
    the task instead of being written out as pairs.
    """
    def loss(table):
        z = np.concatenate([_matrix(table, "z1"), _matrix(table, "z2")])
        n = table.num_rows
        logits = z @ z.T / temperature
        positive = logits[np.arange(2 * n), np.roll(np.arange(2 * n), -n)]
        np.fill_diagonal(logits, -1e9)
        value = float((_log_sum_exp(logits) - positive).mean())
        return pa.table({"batch_id": [table.column("batch_id")[0].as_py()], "n": [n], "loss": [value]})

    return batches.select("batch_id", "z1", "z2").groupBy("batch_id").applyInArrow(loss, LOSS_SCHEMA)


def retrieval_loss(batches: DataFrame) -> DataFrame:
    """In-batch softmax loss of user against item vectors, summed over the batch."""
    def loss(table):
        logits = _matrix(table, "user_vec") @ _matrix(table, "item_vec").T
        value = float((_log_sum_exp(logits) - np.diag(logits)).sum())
        return pa.table({"batch_id": [table.column("batch_id")[0].as_py()], "n": [table.num_rows], "loss": [value]})

    return batches.select("batch_id", "user_vec", "item_vec").groupBy("batch_id").applyInArrow(loss, LOSS_SCHEMA)


def embed_items(items: DataFrame, layers: list[dict], keep=("id",)) -> DataFrame:
    """(keep..., embedding): a dense network applied batch by batch, result scaled to length 1.

    Each layer has ``weights`` (in x out) and ``bias``, optionally ``activation`` ('relu' or
    'elu') and batch-norm ``mean``, ``variance``, ``gamma``, ``beta``. Weights are a model of
    fixed size, sent to the tasks once.
    """
    model = items.sparkSession.sparkContext.broadcast(
        [{k: np.asarray(v) if not isinstance(v, str) else v for k, v in layer.items()} for layer in layers])
    schema = T.StructType([*[items.schema[c] for c in keep],
                           T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def forward(x):
        for layer in model.value:
            x = x @ layer["weights"] + layer["bias"]
            if layer.get("activation") == "relu":
                x = np.maximum(x, 0.0)
            elif layer.get("activation") == "elu":
                x = np.where(x > 0, x, np.expm1(np.minimum(x, 0.0)))
            if "mean" in layer:
                x = (x - layer["mean"]) / np.sqrt(layer["variance"] + 1e-3) * layer["gamma"] + layer["beta"]
        return x / np.sqrt(np.maximum((x * x).sum(axis=1, keepdims=True), 1e-12))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = forward(_rows(batch.column("vec")))
                starts = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.ListArray.from_arrays(starts, pa.array(out.ravel()))],
                    [*keep, "embedding"])

    return items.select(*keep, "vec").mapInArrow(run, schema)


def layers_table(spark, layers: list[dict]) -> DataFrame:
    """A network as rows, one per layer, as ``read_layers`` takes them."""
    rows = []
    for n, layer in enumerate(layers):
        rows.append((n, [[float(x) for x in row] for row in layer["weights"]], [float(x) for x in layer["bias"]],
                     layer.get("activation"),
                     *[[float(x) for x in layer[c]] if c in layer else None for c in NORM]))
    return spark.createDataFrame(rows, LAYER_SCHEMA)


def read_layers(table: DataFrame) -> list[dict]:
    """Layers of a network from a table of one row per layer; a model of checked size."""
    size = table.agg(F.coalesce(F.sum(F.size("weights") * F.size("bias")), F.lit(0))).first()[0]
    if size > MAX_WEIGHTS:
        raise ValueError(f"a network of {size} weights is too large to be sent to every task")
    layers = []
    for row in table.orderBy("layer").collect():
        given = {"weights": row["weights"], "bias": row["bias"], "activation": row["activation"],
                 **{c: row[c] for c in NORM}}
        layers.append({k: v if isinstance(v, str) else np.array(v) for k, v in given.items() if v is not None})
    return layers


def demo_layers(n_in: int, n_out: int, hidden=(256, 128), activation: str = "elu") -> list[dict]:
    """Deterministic weights of the usual tower shape, for trying out ``embed_items``."""
    layers, size = [], n_in
    for i, width in enumerate([*hidden, n_out]):
        grid = np.arange(size * width, dtype=np.float64).reshape(size, width)
        layer = {"weights": np.sin(grid + i) / np.sqrt(size), "bias": np.cos(np.arange(width)) / 10.0}
        if i < len(hidden):
            layer |= {"activation": activation, "mean": np.zeros(width), "variance": np.ones(width),
                      "gamma": np.ones(width), "beta": np.zeros(width)}
        layers.append(layer)
        size = width
    return layers


