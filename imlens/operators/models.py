"""Scorer factories for ``featurize`` (M1, M2): parameters are broadcast once, the model is built
once per Python worker from the broadcast value.

``make_predict_fn`` is any zero-argument callable returning ``predict(batch) -> 2-D array``.
The factories here close over a ``Broadcast`` handle only, so tasks ship a few bytes and each
executor fetches the parameters once through Spark's broadcast mechanism.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession


#: Largest scorer that is broadcast: it is a model's parameters, whose size does not grow with the data.
MAX_BYTES = 1 << 30


def _broadcast(spark: SparkSession, value, size: int):
    if size > MAX_BYTES:
        raise ValueError(f"scorer parameters of {size} bytes exceed {MAX_BYTES}: read them on the executors instead")
    return spark.sparkContext.broadcast(value)


def linear_projection(spark: SparkSession, weights: np.ndarray, bias: np.ndarray | None = None):
    """Flatten each input and project it: ``x.reshape(n, -1) @ weights + bias``."""
    w = np.asarray(weights, dtype=np.float32)
    b = None if bias is None else np.asarray(bias, dtype=np.float32)
    handle = _broadcast(spark, (w, b), w.nbytes)

    def make():
        wv, bv = handle.value

        def predict(x: np.ndarray) -> np.ndarray:
            out = x.reshape(x.shape[0], -1).astype(np.float32) @ wv
            return out if bv is None else out + bv

        return predict

    return make


def onnx_model(spark: SparkSession, model_bytes: bytes, output_index: int = 0):
    """A network serialised as ONNX, run by ONNX Runtime on the executors.

    The model bytes are broadcast once; each Python worker builds one inference session. The
    input is fed as float32 in the layout ``featurize`` produces (n, H, W, 3); the chosen output is
    flattened per row (e.g. a pooled 1280-value embedding).
    """
    try:
        import onnxruntime  # noqa: F401
    except ImportError as e:  # pragma: no cover - depends on the environment
        raise ImportError("onnx_model needs onnxruntime on the driver and the executors") from e
    handle = _broadcast(spark, model_bytes, len(model_bytes))

    def make():
        import onnxruntime as ort

        session = ort.InferenceSession(handle.value, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name

        def predict(x: np.ndarray) -> np.ndarray:
            out = session.run(None, {name: x.astype(np.float32)})[output_index]
            return np.asarray(out).reshape(x.shape[0], -1)

        return predict

    return make
