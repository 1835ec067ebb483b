"""Fitted preprocessing as pipeline stages: what is learned from training data is saved with the model and applied again when scoring.

Candidate features travel as one struct column of doubles, so a stage may keep some of them without touching the columns of
the table: ``Gather`` makes it, filters and the imputer hand on a shorter or fuller one, ``ToVector`` ends it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.functions import scalars as S
from riskflow.operators import dataset as D
from riskflow.operators.features import top_values
from riskflow.operators.ordered import exact_quantiles
from riskflow.operators.profiling import correlation_with


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """All that a stage knows is in its parameters, which are saved as text."""


class Gather(Transformer, HasInputCols, HasOutputCol, _Saved):
    """A struct of doubles from numeric columns and from structs of flags. Infinite values become null."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = None, outputCol: str = "candidates"):
        super().__init__()
        self._setDefault(outputCol="candidates")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fields: list[Column] = []
        for c in self.getInputCols():
            kind = df.schema[c].dataType
            names = [f"{c}.{n}" for n in kind.names] if isinstance(kind, StructType) else [c]
            fields += [S.finite(n).alias(n.rsplit(".", 1)[-1]) for n in names]
        return df.withColumn(self.getOutputCol(), F.struct(*fields))


class CategoryFlagsModel(Model, HasInputCol, HasOutputCol, _Saved):
    """A struct with one flag per category of the fitted list; other values and null have none."""

    values = Param(Params._dummy(), "values", "categories, most frequent first", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        column = self.getInputCol()
        flags = S.one_hot(column, self.getOrDefault(self.values), column)
        return df.withColumn(self.getOutputCol(), F.struct(*[x.alias(n) for n, x in flags.items()]) if flags else F.struct())


class CategoryFlags(Estimator, HasInputCol, HasOutputCol, _Saved):
    """The k most frequent values of a column (ties by value)."""

    k = Param(Params._dummy(), "k", "number of categories", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None, k: int = 15):
        super().__init__()
        self._setDefault(k=15)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CategoryFlagsModel:
        values = [r[0] for r in top_values(df, self.getInputCol(), self.getOrDefault(self.k)).collect()]
        return CategoryFlagsModel()._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), values=values)


class _Chosen(Model, HasInputCol, HasOutputCol, _Saved):
    """Keeps some fields of the struct. ``measured`` is what decided, per field of ``names``."""

    names = Param(Params._dummy(), "names", "fields that were measured", TypeConverters.toListString)
    measured = Param(Params._dummy(), "measured", "value of each field; NaN if it has none", TypeConverters.toListFloat)
    kept = Param(Params._dummy(), "kept", "fields that stay, in order", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        fields = [F.col(f"`{self.getInputCol()}`.`{n}`").alias(n) for n in self.getOrDefault(self.kept)]
        return df.withColumn(self.getOutputCol(), F.struct(*fields))


class _Chooses(Estimator, HasInputCol, HasOutputCol, _Saved):
    def _model(self, cls, names: Sequence[str], measured: dict[str, float], kept: Sequence[str]):
        values = [float("nan") if measured.get(n) is None else float(measured[n]) for n in names]
        if not kept:
            raise ValueError(f"{type(self).__name__} leaves no feature")
        return cls()._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), names=list(names), measured=values, kept=list(kept))


class MissingRateFilterModel(_Chosen):
    pass


class MissingRateFilter(_Chooses):
    """Fields that are null in less than ``limit`` of the rows."""

    limit = Param(Params._dummy(), "limit", "share of nulls from which a field goes", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None, limit: float = 0.5):
        super().__init__()
        self._setDefault(limit=0.5)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MissingRateFilterModel:
        names = df.schema[self.getInputCol()].dataType.names
        found = D.missing_rates(df.select(f"{self.getInputCol()}.*"), names, self.getOrDefault(self.limit)).collect()
        keep = {r["feature"] for r in found if r["keep"]}
        return self._model(MissingRateFilterModel, names, {r["feature"]: r["missing_rate"] for r in found}, [n for n in names if n in keep])


class ConstantFilterModel(_Chosen):
    pass


class ConstantFilter(_Chooses):
    """Fields with more than one value; ``measured`` is 1 for a constant one."""

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ConstantFilterModel:
        names = df.schema[self.getInputCol()].dataType.names
        found = {r["feature"]: r["is_constant"] for r in D.constant_features(df.select(f"{self.getInputCol()}.*"), names).collect()}
        return self._model(ConstantFilterModel, names, found, [n for n in names if not found[n]])


class CorrelationFilterModel(_Chosen):
    pass


class CorrelationFilter(_Chooses, HasLabelCol):
    """The k fields with the largest absolute correlation with the label (ties by name); fields without one go."""

    k = Param(Params._dummy(), "k", "number of fields", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None, labelCol: str = "label", k: int = 20):
        super().__init__()
        self._setDefault(k=20, labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CorrelationFilterModel:
        names = df.schema[self.getInputCol()].dataType.names
        wide = df.select(f"{self.getInputCol()}.*", F.col(self.getLabelCol()).cast("double").alias("__label"))
        found = {r["feature"]: r["corr"] for r in correlation_with(wide, "__label", names).collect()}
        ranked = sorted((n for n in names if found[n] is not None and found[n] == found[n]), key=lambda n: (-abs(found[n]), n))
        return self._model(CorrelationFilterModel, names, found, ranked[: self.getOrDefault(self.k)])


class MedianImputerModel(Model, HasInputCol, HasOutputCol, _Saved):
    names = Param(Params._dummy(), "names", "fields", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "median of each field", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.names), self.getOrDefault(self.medians))
        fields = [F.coalesce(F.col(f"`{self.getInputCol()}`.`{n}`"), F.lit(m)).alias(n) for n, m in pairs]
        return df.withColumn(self.getOutputCol(), F.struct(*fields))


class MedianImputer(Estimator, HasInputCol, HasOutputCol, _Saved):
    """Exact medians of the known values; a field without any gets 0."""

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        names = df.schema[self.getInputCol()].dataType.names
        found = {r["column"]: r["median"] for r in exact_quantiles(df.select(f"{self.getInputCol()}.*"), names, {"median": 0.5}).collect()}
        return MedianImputerModel()._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), names=list(names), medians=[found.get(n, 0.0) for n in names])


class ClassWeightModel(Model, HasLabelCol, HasOutputCol, _Saved):
    weights = Param(Params._dummy(), "weights", "weight of class 0 and of class 1", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Tables without labels, as in scoring, stay as they are."""
        if self.getLabelCol() not in df.columns:
            return df
        negative, positive = self.getOrDefault(self.weights)
        return df.withColumn(self.getOutputCol(), F.when(F.col(self.getLabelCol()) == 1, positive).otherwise(negative))


class ClassWeight(Estimator, HasLabelCol, HasOutputCol, _Saved):
    """n / (2 n_class); 1 for a class that has no row."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", outputCol: str = "weight"):
        super().__init__()
        self._setDefault(labelCol="label", outputCol="weight")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ClassWeightModel:
        r = D.class_weights(df, self.getLabelCol()).first()
        weights = [1.0 if w is None else float(w) for w in (r["weight_neg"], r["weight_pos"])]
        return ClassWeightModel()._set(labelCol=self.getLabelCol(), outputCol=self.getOutputCol(), weights=weights)


class ToVector(Transformer, HasInputCol, HasOutputCol, _Saved):
    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = df.schema[self.getInputCol()].dataType.names
        wide = df.withColumns({f"__v_{n}": F.col(f"`{self.getInputCol()}`.`{n}`") for n in names})
        vector = VectorAssembler(inputCols=[f"__v_{n}" for n in names], outputCol=self.getOutputCol(), handleInvalid="error")
        return vector.transform(wide).drop(*[f"__v_{n}" for n in names])


def preparation(features: Sequence[str], label: str = "label", *, categories: Sequence[str] = (), limit: float = 0.5, k: int = 20, top: int = 15, weight: str | None = None) -> list:
    """Stages from raw features to the vector ``raw_features``: flags of the most frequent categories, fields that are often
    there, medians for the rest, no constants, the k fields that go with the label most; optionally class weights."""
    flags = [CategoryFlags(inputCol=c, outputCol=f"{c}_flags", k=top) for c in categories]
    return [
        *flags,
        Gather(inputCols=[*features, *[f.getOutputCol() for f in flags]], outputCol="candidates"),
        MissingRateFilter(inputCol="candidates", outputCol="present", limit=limit),
        MedianImputer(inputCol="present", outputCol="imputed"),
        ConstantFilter(inputCol="imputed", outputCol="varying"),
        CorrelationFilter(inputCol="varying", outputCol="selected", labelCol=label, k=k),
        *([ClassWeight(labelCol=label, outputCol=weight)] if weight else []),
        ToVector(inputCol="selected", outputCol="raw_features"),
    ]


def selected_features(model: PipelineModel) -> list[str]:
    """Names of the vector's positions."""
    for stage in reversed(model.stages):
        if isinstance(stage, _Chosen):
            return stage.getOrDefault(stage.kept)
    return next(s.getInputCols() for s in model.stages if s.hasParam("inputCols"))


def fitted_values(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(stage, feature, value, kept): everything that the preprocessing stages of a pipeline have learned."""
    rows: list[tuple] = []
    for stage in model.stages:
        name = type(stage).__name__.removesuffix("Model")
        if isinstance(stage, _Chosen):
            kept = set(stage.getOrDefault(stage.kept))
            rows += [(name, n, None if v != v else v, n in kept) for n, v in zip(stage.getOrDefault(stage.names), stage.getOrDefault(stage.measured))]
        elif isinstance(stage, MedianImputerModel):
            rows += [(name, n, v, True) for n, v in zip(stage.getOrDefault(stage.names), stage.getOrDefault(stage.medians))]
        elif isinstance(stage, ClassWeightModel):
            rows += [(name, str(i), v, True) for i, v in enumerate(stage.getOrDefault(stage.weights))]
        elif isinstance(stage, CategoryFlagsModel):
            rows += [(name, v, float(i), True) for i, v in enumerate(stage.getOrDefault(stage.values), 1)]
    return spark.createDataFrame(rows, "stage string, feature string, value double, kept boolean")
