"""Models that are wholly given by other models: storage of their parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class _Writer(MLWriter):
    """Metadata with the parts' number and names, and a folder for each part."""

    def __init__(self, model: Composite) -> None:
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        parts = self._model.parts()
        facts = {"parts": len(parts), "names": self._model.names()}
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession, extraMetadata=facts)
        for i, part in enumerate(parts):
            part.write().save(f"{path}/part-{i}")


class _Reader(MLReader):
    def __init__(self, kind: type[Composite]) -> None:
        super().__init__()
        self._kind = kind

    def load(self, path: str) -> Composite:
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = [load_model(self.sparkSession, f"{path}/part-{i}") for i in range(facts["parts"])]
        model = self._kind.of_parts(parts, facts["names"])
        model._resetUid(facts["uid"])
        return model


class Composite(Model, MLWritable, MLReadable):
    """A model that is wholly given by other models in an order, and by names."""

    def parts(self) -> list[Model]:
        raise NotImplementedError

    def names(self) -> list[str]:
        return []

    @classmethod
    def of_parts(cls, parts: Sequence[Model], names: Sequence[str]) -> Composite:
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def load_model(spark, path: str) -> Model:
    """A stored model of any class."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
