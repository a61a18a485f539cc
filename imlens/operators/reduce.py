"""Standardise + PCA keeping a share of the variance.

Fit reads the input once: every task adds up count, means and centred cross products of its rows
(``imlens.operators.moments``), the states of all tasks are combined in rounds of bounded groups, and the driver
gets one d x d matrix. The state is kept with the model, so ``Reducer.refit`` adds new sets without reading the old ones. Standard deviations, the matrix of the standardised vectors and its eigenvectors follow
from that one matrix, so every explained-variance ratio is known before k is chosen, and a transform
projects on the k chosen columns only.

The driver holds d x d doubles (13 MB at d = 1280); the data never leaves the executors.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCAModel, StandardScalerModel, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imlens.functions.vectors import as_vector
from imlens.operators.moments import Moments

_VEC, _Z, _PC = "_imlens_vec", "_imlens_z", "_imlens_pc"


def choose_k(ratios, threshold: float = 0.9) -> int:
    """Smallest one-based k whose cumulative explained variance reaches ``threshold``.

    NaN ratios (constant or non-finite input) raise instead of silently giving k = 1; when
    rounding keeps the total just below the threshold, all components are kept.
    """
    r = np.asarray(ratios, dtype=float)
    if r.size == 0:
        raise ValueError("no explained-variance ratios: empty input")
    if not 0.0 < threshold <= 1.0:
        raise ValueError(f"threshold must be in (0, 1], got {threshold}")
    if np.isnan(r).any():
        raise ValueError("explained variance contains NaN: input is constant or has non-finite values")
    hit = np.nonzero(np.cumsum(r) >= threshold)[0]
    return int(hit[0]) + 1 if hit.size else int(r.size)


def moments(df: DataFrame, input_col: str):
    """(dim, rows, rows that are null or hold a null or non-finite value, mean, centred cross products) in one pass."""
    m = Moments.of(df, input_col)
    return m.dim, m.n, m.bad, m.mean, m.cross


def _java_model(kind: str, cls, *args):
    """A fitted Spark ML model from its parameters."""
    sc = SparkSession.getActiveSession().sparkContext
    java = getattr(sc._jvm.org.apache.spark.ml.feature, kind)(f"{kind}_{uuid.uuid4().hex[:12]}", *[_py2java(sc, a) for a in args])
    return cls(java)


def _pca_model(components: np.ndarray, ratios: np.ndarray) -> PCAModel:
    d, k = components.shape
    model = _java_model("PCAModel", PCAModel, DenseMatrix(d, k, components.T.ravel().tolist()), Vectors.dense(ratios))
    return model._set(k=k, inputCol=_Z, outputCol=_PC)


class ReductionModel:
    """A fitted scaler + PCA + slice, stored as a Spark ML ``PipelineModel``."""

    def __init__(self, pipeline: PipelineModel, input_col: str = "features", output: str = "vector", moments: Moments | None = None):
        self.pipeline = pipeline
        self.moments = moments
        self.input_col = input_col
        self.output = output

    @property
    def scaler(self) -> StandardScalerModel:
        return self.pipeline.stages[0]

    @property
    def pca(self) -> PCAModel:
        return self.pipeline.stages[1]

    @property
    def output_col(self) -> str:
        return self.pipeline.stages[2].getOutputCol()

    @property
    def k(self) -> int:
        return len(self.pipeline.stages[2].getIndices())

    @property
    def dim(self) -> int:
        return int(self.scaler.mean.size)

    def explained_variance(self) -> np.ndarray:
        return self.pca.explainedVariance.toArray()

    def explained_variance_table(self, spark: SparkSession) -> DataFrame:
        """(component, ratio, cumulative, selected): the W1 running total over the d ratios."""
        ratios = self.explained_variance()
        literal = F.array(*[F.lit(float(r)) for r in ratios])  # d model parameters, not data
        component = F.col("id").cast("int")
        df = spark.range(1, len(ratios) + 1, numPartitions=1).select(
            component.alias("component"), F.element_at(literal, component).alias("ratio")
        )
        running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(
            "component",
            "ratio",
            F.sum("ratio").over(running).alias("cumulative"),
            (F.col("component") <= F.lit(self.k)).alias("selected"),
        )

    def transform(self, df: DataFrame, components: list[int] | None = None) -> DataFrame:
        """Scale and project; keeps every input column and adds the reduced column.

        ``components`` (zero-based) selects other columns of the projection, e.g. ``[0, 1]`` for
        a 2-D view (T7), without refitting.
        """
        chosen = list(range(self.k)) if components is None else list(components)
        project = _pca_model(self.pca.pc.toArray()[:, chosen], self.explained_variance()).setOutputCol(self.output_col)
        with_vec = df.withColumn(_VEC, as_vector(df, self.input_col))
        out = project.transform(self.scaler.transform(with_vec)).drop(_VEC, _Z)
        if self.output == "array":
            out = out.withColumn(self.output_col, vector_to_array(F.col(self.output_col)))
        return out

    def save(self, path: str) -> None:
        """The pipeline, and in ``moments/`` the state it was fitted from."""
        self.pipeline.write().overwrite().save(path)
        if self.moments is not None:
            self.moments.save(SparkSession.getActiveSession(), f"{path}/moments")

    @classmethod
    def load(cls, path: str, input_col: str = "features", output: str = "vector") -> "ReductionModel":
        return cls(PipelineModel.load(path), input_col=input_col, output=output)


class Reducer:
    """Estimator: standardise (mean and sample std) then PCA keeping ``threshold`` of the variance."""

    def __init__(
        self,
        input_col: str = "features",
        output_col: str = "pca_features",
        threshold: float = 0.9,
        k: int | None = None,
        with_mean: bool = True,
        with_std: bool = True,
        output: str = "vector",
    ):
        if output not in ("vector", "array"):
            raise ValueError("output must be 'vector' or 'array'")
        self.input_col, self.output_col = input_col, output_col
        self.threshold, self.k = threshold, k
        self.with_mean, self.with_std = with_mean, with_std
        self.output = output

    def fit(self, df: DataFrame) -> ReductionModel:
        """Needs finite vectors of one length: others are an error that says how many there are, never left out silently."""
        return self.fit_moments(Moments.of(df, self.input_col))

    def refit(self, paths: list[str], *new: DataFrame) -> ReductionModel:
        """The model of the sets behind saved models (``paths``) and of new ones; only the new ones are read."""
        total = Moments.load(SparkSession.getActiveSession(), *[f"{p}/moments" for p in paths])
        for df in new:
            total = total + Moments.of(df, self.input_col)
        return self.fit_moments(total)

    def fit_moments(self, state: Moments) -> ReductionModel:
        """The model of all vectors that a state has seen."""
        dim, n, bad, mean, cross = state.dim, state.n, state.bad, state.mean, state.cross
        if bad:
            raise ValueError(f"{bad} of {bad + n} vectors are null or hold a null or non-finite value: set them aside before the fit")
        if n == 0 or dim == 0:
            raise ValueError("cannot fit on empty input")
        if n == 1:
            raise ValueError("cannot fit on 1 row: it has no variance")
        covariance = cross / max(n - 1, 1)
        std = np.sqrt(np.diag(covariance))
        scale = np.divide(1.0, std, out=np.zeros(dim), where=std > 0) if self.with_std else np.ones(dim)
        values, vectors = np.linalg.eigh(covariance * np.outer(scale, scale))
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(dim)] < 0, -1.0, 1.0)  # one sign for each fit
        with np.errstate(invalid="ignore", divide="ignore"):
            ratios = values / values.sum()
        k = self.k if self.k is not None else choose_k(ratios, self.threshold)
        if not 1 <= k <= dim:
            raise ValueError(f"k must be in [1, {dim}], got {k}")
        scaler = _java_model("StandardScalerModel", StandardScalerModel, Vectors.dense(std), Vectors.dense(mean))
        scaler._set(inputCol=_VEC, outputCol=_Z, withMean=self.with_mean, withStd=self.with_std)
        slicer = VectorSlicer(inputCol=_PC, outputCol=self.output_col, indices=list(range(k)))
        return ReductionModel(PipelineModel([scaler, _pca_model(vectors, ratios), slicer]), input_col=self.input_col, output=self.output, moments=state)
