"""Batched featurisation with an error channel.

One Arrow-batched pandas UDF turns each input (a decoded ``image`` struct, or any numeric
array) into ``features`` plus an ``error`` text. A failing row never fails its batch or its task:
preprocessing errors are caught per row, a failing model call is retried row by row to find the
culprit. The model is built once per Python worker (``make_predict_fn`` is the hook for any
scorer -- numpy, ONNX Runtime on broadcast bytes, ...) and reused across tasks and batches.

``featurize`` returns one DataFrame; ``split_quarantine`` splits it after it has been written
once, so the scorer runs a single time per row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructField, StructType, StringType

from imlens.session import ship_package

PredictFn = Callable[[np.ndarray], np.ndarray]

RESULT_TYPE = StructType(
    [StructField("features", ArrayType(FloatType()), True), StructField("error", StringType(), True)]
)

# Per-Python-worker cache of built predict functions. The key is a token drawn once per
# ``featurize`` call on the driver, so every task of that call reuses one model in a worker and
# no other call can ever be handed it (object ids of unpickled factories are reused).
_MODELS: dict[str, PredictFn] = {}


def _predictor(token: str, make_predict_fn: Callable[[], PredictFn]) -> PredictFn:
    if token not in _MODELS:
        _MODELS[token] = make_predict_fn()
    return _MODELS[token]


# --------------------------------------------------------------------------- preprocessing


def nearest_resize(arr: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Nearest-neighbour resize of an (h, w, c) array to (H, W, c), pixel-centre sampling."""
    h, w = arr.shape[:2]
    H, W = size
    ys = np.minimum(((np.arange(H) + 0.5) * h / H).astype(np.int64), h - 1)
    xs = np.minimum(((np.arange(W) + 0.5) * w / W).astype(np.int64), w - 1)
    return arr[ys][:, xs]


def _cubic(x: np.ndarray) -> np.ndarray:
    """Keys' cubic convolution kernel with a = -0.5."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))


def _cubic_weights(n_in: int, n_out: int) -> np.ndarray:
    """(out, in) weights; when shrinking, the kernel is widened by the scale, so every source pixel counts."""
    scale = n_in / n_out
    stretch = max(scale, 1.0)
    centres = (np.arange(n_out) + 0.5) * scale
    places = np.arange(n_in) + 0.5
    low, high = centres - 2 * stretch, centres + 2 * stretch
    weights = _cubic((places - centres[:, None]) / stretch)
    weights[(places < np.floor(low + 0.5)[:, None]) | (places > np.floor(high + 0.5)[:, None])] = 0.0
    return weights / weights.sum(1, keepdims=True)


def bicubic_resize(arr: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """Bicubic resize of a uint8 (h, w, c) array to (H, W, c): columns, then rows, rounded to bytes after each."""
    across = _cubic_weights(arr.shape[1], size[1])
    down = _cubic_weights(arr.shape[0], size[0])
    step = np.clip(np.floor(np.einsum("ow,hwc->hoc", across, arr.astype(np.float64)) + 0.5), 0, 255)
    return np.clip(np.floor(np.einsum("oh,hwc->owc", down, step) + 0.5), 0, 255).astype(np.uint8)


RESIZE = {"nearest": nearest_resize, "bicubic": bicubic_resize}


def image_tensor(
    height: int, width: int, n_channels: int, data: bytes, size: tuple[int, int] = (224, 224), resize: str = "nearest"
) -> np.ndarray:
    """Spark image struct fields -> float32 (H, W, 3) RGB in [-1, 1].

    Spark stores BGR(A) bytes; greyscale is repeated to three channels, alpha is dropped.
    """
    if height is None or height <= 0 or width <= 0 or not data:
        raise ValueError("undecodable image")
    arr = np.frombuffer(bytes(data), dtype=np.uint8)
    if arr.size != height * width * n_channels:
        raise ValueError(f"image buffer has {arr.size} bytes, expected {height}x{width}x{n_channels}")
    arr = arr.reshape(height, width, n_channels)
    if n_channels == 1:
        arr = np.repeat(arr, 3, axis=2)
    elif n_channels >= 3:
        arr = arr[:, :, 2::-1]  # BGR(A) -> RGB
    else:
        raise ValueError(f"unsupported channel count {n_channels}")
    arr = RESIZE[resize](arr, size)
    return arr.astype(np.float32) / np.float32(127.5) - np.float32(1.0)


def image_preprocess(size: tuple[int, int] = (224, 224), resize: str = "nearest") -> Callable[[pd.DataFrame], list]:
    """Preprocess for an ``image`` struct column: one tensor (or exception) per row."""

    def run(batch: pd.DataFrame) -> list:
        out = []
        for h, w, c, data in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"]):
            try:
                out.append(image_tensor(int(h), int(w), int(c), data, size, resize))
            except Exception as e:  # noqa: BLE001 -- every failure goes to the error column
                out.append(e)
        return out

    return run


def array_preprocess() -> Callable[[pd.Series], list]:
    """Preprocess for an ``array<number>`` column: float32 vectors, null rows become errors."""

    def run(batch: pd.Series) -> list:
        out = []
        for v in batch:
            if v is None:
                out.append(ValueError("null input"))
            else:
                out.append(np.asarray(v, dtype=np.float32))
        return out

    return run


# --------------------------------------------------------------------------- default scorer


def grid_histogram_model(grid: int = 4, bins: int = 16) -> Callable[[], PredictFn]:
    """A small deterministic image featuriser, used when no network is supplied.

    Per RGB channel: mean of each cell of a ``grid`` x ``grid`` split, and a ``bins``-bin
    histogram of values in [-1, 1] (fractions). Output length 3 * (grid**2 + bins).
    """

    def make() -> PredictFn:
        def predict(x: np.ndarray) -> np.ndarray:
            n, H, W, C = x.shape
            gh, gw = H // grid, W // grid
            cells = x[:, : gh * grid, : gw * grid, :].reshape(n, grid, gh, grid, gw, C).mean(axis=(2, 4))
            means = cells.transpose(0, 3, 1, 2).reshape(n, -1)
            idx = np.clip(((x + np.float32(1.0)) * np.float32(bins / 2.0)).astype(np.int64), 0, bins - 1)
            flat = idx.reshape(n, -1, C)
            offsets = (np.arange(n) * bins)[:, None]
            hist = np.stack(
                [np.bincount((flat[:, :, c] + offsets).ravel(), minlength=n * bins).reshape(n, bins) for c in range(C)],
                axis=1,
            )
            hist = hist.reshape(n, -1) / float(H * W)
            return np.concatenate([means, hist], axis=1).astype(np.float32)

        return predict

    return make


# --------------------------------------------------------------------------- the operator

# Errors of the machine, not of a row: they fail the task, so Spark retries it, and never reach quarantine.
RESOURCE_ERRORS = (MemoryError,)


def _score(tensors: list, predict: PredictFn, batch_size: int, zero: np.ndarray | None) -> tuple[list, list]:
    feats: list = [None] * len(tensors)
    errors: list = [None] * len(tensors)
    good = []
    for i, t in enumerate(tensors):
        if isinstance(t, Exception):
            errors[i] = f"{type(t).__name__}: {t}"
        else:
            good.append(i)
    for start in range(0, len(good), batch_size):
        chunk = good[start : start + batch_size]
        try:
            out = np.asarray(predict(np.stack([tensors[i] for i in chunk])))
            rows = [(i, out[j]) for j, i in enumerate(chunk)]
        except RESOURCE_ERRORS:
            raise
        except Exception:  # noqa: BLE001 -- isolate the failing rows
            rows = []
            for i in chunk:
                try:
                    rows.append((i, np.asarray(predict(tensors[i][None, ...]))[0]))
                except RESOURCE_ERRORS:
                    raise
                except Exception as e:  # noqa: BLE001
                    errors[i] = f"{type(e).__name__}: {e}"
        for i, v in rows:
            v = np.asarray(v, dtype=np.float32).reshape(-1)
            if not np.isfinite(v).all():
                errors[i] = "non-finite feature value"
            else:
                feats[i] = v
    if zero is not None:
        feats = [zero if f is None else f for f in feats]
    return feats, errors


def featurize(
    df: DataFrame,
    input_col: str,
    make_predict_fn: Callable[[], PredictFn] | None = None,
    *,
    output_col: str = "features",
    error_col: str = "error",
    batch_size: int = 64,
    size: tuple[int, int] = (224, 224),
    on_error: str = "quarantine",
    zero_dim: int | None = None,
    resize: str = "nearest",
) -> DataFrame:
    """Add ``output_col`` (array<float>) and ``error_col`` (string, null when fine) in one pass.

    Rows are scored where they are: a caller whose input has too few partitions repartitions it first.

    ``input_col`` is an ``image`` struct (from ``scan_images``) or a numeric array column.
    ``resize`` is "nearest" or "bicubic".
    on_error='quarantine' leaves failed features null; on_error='zero' fills a zero vector of
    ``zero_dim`` values (the reference's fallback) while still recording the error.
    Filter rows *before* calling this: the scorer is declared non-deterministic (so it is never
    evaluated twice), which also keeps later filters on input columns above it.
    Input batches are bounded by ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default)
    and ``maxRecordsPerBatch``; ``batch_size`` is the number of tensors per model call.
    """
    if on_error not in ("quarantine", "zero"):
        raise ValueError("on_error must be 'quarantine' or 'zero'")
    if on_error == "zero" and not zero_dim:
        raise ValueError("on_error='zero' needs zero_dim")
    make = make_predict_fn or grid_histogram_model()
    dtype = df.schema[input_col].dataType
    if isinstance(dtype, StructType):
        prep = image_preprocess(size, resize)
    elif isinstance(dtype, ArrayType):
        prep = array_preprocess()
    elif isinstance(dtype, BinaryType):
        raise TypeError(
            f"{input_col} holds raw file bytes: decode them with the JVM image source "
            "(sources.scan_images / image_items) and pass the `image` column instead"
        )
    else:
        raise TypeError(f"{input_col} must be an image struct or a numeric array, not {dtype.simpleString()}")
    zero = np.zeros(zero_dim, dtype=np.float32) if on_error == "zero" else None
    ship_package(df.sparkSession)
    token = uuid.uuid4().hex

    @pandas_udf(RESULT_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = _predictor(token, make)
        for batch in batches:
            feats, errors = _score(prep(batch), predict, batch_size, zero)
            yield pd.DataFrame({"features": feats, "error": errors})

    # Declared non-deterministic only so the optimizer never copies the call into a pushed-down
    # filter (e.g. the non-empty filter it infers from explode), which would score every row twice.
    score = score.asNondeterministic()
    scored = df.withColumn("_imlens_scored", score(F.col(input_col)))
    return scored.withColumn(output_col, F.col("_imlens_scored.features")).withColumn(
        error_col, F.col("_imlens_scored.error")
    ).drop("_imlens_scored")


def split_quarantine(scored: DataFrame, output_col: str = "features", error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows without ``error_col``, quarantined rows without ``output_col``) (M5, K3)."""
    good = scored.filter(F.col(error_col).isNull()).drop(error_col)
    bad = scored.filter(F.col(error_col).isNotNull()).drop(output_col)
    return good, bad


def batch_predict(make_predict_fn, return_type=ArrayType(FloatType()), batch_size: int = 64, input_tensor_shapes=None):
    """Spark ML's ``predict_batch_udf`` (M3 as a built-in): model cached per worker, Arrow batches."""
    from pyspark.ml.functions import predict_batch_udf

    ship_package(SparkSession.getActiveSession())
    udf = predict_batch_udf(
        make_predict_fn, return_type=return_type, batch_size=batch_size, input_tensor_shapes=input_tensor_shapes
    )
    return udf.asNondeterministic()  # never copied into pushed-down filters (see featurize)
