"""The fitted preprocessing as Spark ML stages (survey §2.12 W1, §2.16, S10).

Every stage holds its statistics as parameters, so a fitted preprocessor is a ``PipelineModel``
that Spark ML saves and loads as a whole and that runs on a batch or on ``readStream`` alike:
no stage looks at the rows it transforms.  Dictionaries of wide columns are saved as Parquet
beside the stage and replayed by a join, on a stream by a stream-static join.

Unlike ``Preprocessor.transform``, which gives an unknown value the code of the most frequent
value of the frame at hand (E5), a saved stage gives it the code of the most frequent value of
the rows it was fitted on, and a column that was all NULL there stays NULL.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame

from retentio.operators import clean as CL
from retentio.operators import encode as EN
from retentio.operators import features as FE


def _param(name: str, convert=TypeConverters.identity):
    return Param(Params._dummy(), name, name, typeConverter=convert)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None


class CoerceNumeric(_Stage):
    """C1 for ``columns``."""
    columns = _param("columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return CL.coerce_numeric(df, self.value("columns"))


class DropColumns(_Stage):
    """The columns that were too sparse at fit."""
    columns = _param("columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.value("columns"))


class FillNulls(_Stage):
    """``values`` maps a column to its fill value."""
    values = _param("values")

    @keyword_only
    def __init__(self, *, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return CL.Imputer(self.value("values")).transform(df)


class AddFeatures(_Stage):
    """Those of ``names`` whose inputs are present."""
    names = _param("names", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return FE.add_features(df, names=FE.available(df, self.value("names")))


class ToBinary(_Stage):
    """``polarity`` maps a column to its spellings and their 0 / 1."""
    polarity = _param("polarity")

    @keyword_only
    def __init__(self, *, polarity=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return EN.BinaryEncoder(self.value("polarity")).transform(df)


class Scale(_Stage):
    """E8-E10 with fitted ``center`` and ``scale``."""
    center = _param("center")
    scale = _param("scale")

    @keyword_only
    def __init__(self, *, center=None, scale=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return EN.Scaler(self.value("center"), self.value("scale"), "saved").transform(df)


class MapTarget(_Stage):
    """C13 where the target column is present."""
    target = _param("target", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, target=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        target = self.value("target")
        return CL.map_target(df, target) if target in df.columns else df


class _Encoding(Transformer, MLWritable, MLReadable):
    """``narrow`` holds the values of small columns; ``wide`` names the columns whose
    (value, code) tables are in ``dictionaries``, in that order."""
    narrow = _param("narrow")
    wide = _param("wide", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(narrow={}, wide=[])
        self.dictionaries: list[DataFrame] = []

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(self.getOrDefault("wide"), self.dictionaries))

    def write(self) -> MLWriter:
        return _EncodingWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncodingReader(cls)


class _EncodingWriter(MLWriter):
    def __init__(self, stage: _Encoding):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        for i, table in enumerate(self.stage.dictionaries):
            table.write.parquet(f"{path}/dictionary-{i}")


class _EncodingReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _Encoding:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.dictionaries = [self.sparkSession.read.schema("value string, code int").parquet(f"{path}/dictionary-{i}")
                              for i in range(len(stage.getOrDefault("wide")))]
        return stage


class LabelCodes(_Encoding):
    """``unknown`` maps a column to the code of values that were not seen at fit."""
    unknown = _param("unknown")

    @classmethod
    def of(cls, encoder: EN.LabelEncoder, frequent: dict) -> LabelCodes:
        stage = cls()
        stage._set(narrow=encoder.classes, wide=list(encoder.dictionaries),
                   unknown={c: encoder.code_of(c, frequent[c]) for c in encoder.columns if frequent.get(c) is not None})
        stage.dictionaries = list(encoder.dictionaries.values())
        return stage

    def _transform(self, df: DataFrame) -> DataFrame:
        encoder = EN.LabelEncoder(self.getOrDefault("narrow"), self.tables())
        return encoder.transform(df, unknown="fitted", codes=self.getOrDefault("unknown"))


class OneHot(_Encoding):
    """Indicator columns of small columns, one sparse vector of each wide column."""
    dropFirst = _param("dropFirst", TypeConverters.toBoolean)
    sizes = _param("sizes", TypeConverters.toListInt)

    @classmethod
    def of(cls, encoder: EN.OneHotEncoder) -> OneHot:
        stage = cls()
        wide = list(encoder.dictionaries)
        stage._set(narrow=encoder.categories, wide=wide, dropFirst=encoder.drop_first, sizes=[encoder.sizes[c] for c in wide])
        stage.dictionaries = [encoder.dictionaries[c] for c in wide]
        return stage

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes = dict(zip(self.getOrDefault("wide"), self.getOrDefault("sizes")))
        return EN.OneHotEncoder(self.getOrDefault("narrow"), self.getOrDefault("dropFirst"), self.tables(), sizes).transform(df)


def pipeline_of(state: dict, roles) -> PipelineModel:
    """The stages of a fitted ``Preprocessor`` (its ``state``) in its order."""
    frequent = state["mode"].values
    stages = [CoerceNumeric(columns=list(roles.discrete)), DropColumns(columns=state["drop"].dropped),
              FillNulls(values={c: v for s in ("median", "mode") for c, v in state[s].values.items() if v is not None})]
    if "grouped" in state:
        stages.append(AddFeatures(names=state["grouped"]))
    stages += [ToBinary(polarity=state["binary"].polarity), LabelCodes.of(state["binary"].labels, frequent)]
    coded = state["categorical"]
    stages.append(OneHot.of(coded) if isinstance(coded, EN.OneHotEncoder) else LabelCodes.of(coded, frequent))
    if state.get("scaler") is not None:
        known = [c for c, m in state["scaler"].center.items() if m is not None]
        stages.append(Scale(center={c: state["scaler"].center[c] for c in known},
                            scale={c: state["scaler"].scale[c] for c in known}))
    return PipelineModel([*stages, MapTarget(target=roles.target)])
