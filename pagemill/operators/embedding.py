"""Text to vector, with the model as a plug point."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import HashedWords

DIM = 64
Embedder = Callable[[pa.Array], np.ndarray]


def hashed_words(dim: int = DIM) -> Callable[[], Embedder]:
    return lambda: HashedWords(dim)


def embed(df: DataFrame, text: str, out: str = "embedding",
          model: Callable[[], Embedder] | None = None) -> DataFrame:
    """Add one vector per text.

    ``model`` is called once per task and returns a function from an Arrow array of
    texts to a matrix with one row per text. The default hashes words.
    """
    make = model or hashed_words()

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = make()
        for texts in batches:
            matrix = np.ascontiguousarray(run(texts), dtype=np.float32)
            offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))

    return df.withColumn(out, vectors(F.col(text)))


def weights(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """The non-zero elements of each vector as rows."""
    return (df.select(key, F.posexplode_outer(vector).alias("bucket", "weight"))
            .filter("weight <> 0"))
