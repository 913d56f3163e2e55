"""Word vectors as a stage of a pipeline, with the parameters of Spark ML's ``Word2Vec``.

Spark ML's keeps the vocabulary, its tree and all vectors on the driver, several times over. Here the vectors are trained
over blocks (``word_vectors``), stay a table in the shared folder, and meet the texts by joins.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasMaxIter, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.operators.word_vectors import WINDOW, mean_word_vectors, train_word_vectors
from wordtide.session import fresh_path, stage, write_once

VECTORS = "word STRING, n BIGINT, vector ARRAY<FLOAT>"


class _Columns(HasInputCol, HasOutputCol):
    vectorSize = Param(Params._dummy(), "vectorSize", "numbers of a vector", TypeConverters.toInt)


class Word2Vec(Estimator, _Columns, HasMaxIter, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Skip-gram vectors of the words that occur ``minCount`` times. ``maxIter`` is how often each pair of neighbours is trained."""

    minCount = Param(Params._dummy(), "minCount", "occurrences that a word needs", TypeConverters.toInt)
    windowSize = Param(Params._dummy(), "windowSize", "places between neighbours", TypeConverters.toInt)
    numPartitions = Param(Params._dummy(), "numPartitions", "tasks that copies of the vectors are made for", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, vectorSize=100, minCount=5, numPartitions=1, maxIter=1, seed=None, inputCol=None, outputCol=None, windowSize=WINDOW):
        super().__init__()
        self._setDefault(vectorSize=100, minCount=5, numPartitions=1, maxIter=1, seed=0, windowSize=WINDOW)
        self._set(**self._input_kwargs)

    def setNumPartitions(self, n: int) -> Word2Vec:
        return self._set(numPartitions=n)

    def _fit(self, dataset: DataFrame) -> Word2VecModel:
        tokens, of = self.getInputCol(), self.getOrDefault
        vectors = train_word_vectors(
            dataset.select(tokens), tokens, of(self.vectorSize), of(self.minCount), of(self.windowSize), of(self.maxIter), of(self.seed), tasks=of(self.numPartitions)
        )
        path = fresh_path(dataset.sparkSession, "word2vec")
        write_once(vectors, path)
        return self._copyValues(Word2VecModel(path))


class Word2VecModel(Model, _Columns, MLReadable, MLWritable):
    """Adds the mean vector of each row's words; zeros where none has a vector."""

    vectors = Param(Params._dummy(), "vectors", "folder of the vectors", TypeConverters.toString)

    def __init__(self, vectors: str | None = None):
        super().__init__()
        self._setDefault(vectorSize=100)
        if vectors is not None:
            self._set(vectors=vectors)

    def getVectors(self) -> DataFrame:
        return SparkSession.active().read.schema(VECTORS).parquet(self.getOrDefault(self.vectors))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tokens, size, key = self.getInputCol(), self.getOrDefault(self.vectorSize), f"{self.uid}_key"
        # Rows are told by 128 bits of their words: ids may repeat, and rows of equal words have one mean.
        keyed = dataset.withColumn(key, F.concat_ws(" ", F.xxhash64(tokens), F.xxhash64(F.lit(1), tokens)))
        means = stage(mean_word_vectors(keyed.select(key, tokens), tokens, self.getVectors(), size, key), "word2vec-means")
        both = keyed.join(means.withColumnRenamed("vector", f"{key}_mean"), key)
        return both.select(*(F.col(f"`{c}`") for c in dataset.columns), array_to_vector(f"{key}_mean").alias(self.getOutputCol()))

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        write_once(self.instance.getVectors(), f"{path}/vectors")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> Word2VecModel:
        return super().load(path)._set(vectors=f"{path}/vectors")
