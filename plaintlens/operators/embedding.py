"""Text to vectors: a native hashing embedder, and a hook for a model the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, HashingTF, Normalizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintlens import constants as K

Encoder = Callable[[Sequence[str]], "np.ndarray | Sequence[Sequence[float]]"]


def hash_embed(
    df: DataFrame,
    text_column: str = "chunk_text",
    dim: int = K.EMBEDDING_DIM,
    out: str = "embedding",
) -> DataFrame:
    """Feature hashing: word counts per hash bucket, scaled to length one.

    Stays in the JVM and needs no shuffle.
    """
    words = F.filter(
        F.split(F.lower(F.coalesce(text_column, F.lit(""))), r"\s+"), lambda w: w != ""
    )
    hashing = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim)
    scaler = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    return (
        scaler.transform(hashing.transform(df.withColumn("_words", words)))
        .withColumn(out, vector_to_array("_unit", "float32"))
        .drop("_words", "_counts", "_unit")
    )


def embed_with(
    df: DataFrame,
    make_encoder: Callable[[], Encoder],
    text_column: str = "chunk_text",
    batch_size: int = 64,
    normalize: bool = True,
    out: str = "embedding",
) -> DataFrame:
    """Embed with a caller's model. ``make_encoder`` runs once per task and returns a function
    from a list of texts to one vector each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            vectors: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                block = np.asarray(encode(texts[start : start + batch_size]), dtype="float32")
                if normalize:
                    norms = np.linalg.norm(block, axis=1, keepdims=True)
                    block = block / np.where(norms == 0, 1, norms)
                vectors.extend(block)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(vectors, pa.list_(pa.float32()))],
                names=[*batch.schema.names, out],
            )

    df = df.drop(out)
    schema = T.StructType([*df.schema.fields]).add(out, T.ArrayType(T.FloatType()))
    return df.mapInArrow(run, schema)


def pca_2d(
    df: DataFrame, vector_column: str = "embedding", k: int = 2
) -> tuple[DataFrame, list[float]]:
    """Project centred vectors on the first components; also the explained variance shares.

    Only the dim x dim covariance reaches the driver. A component's largest loading is positive.
    """
    vectors = df.withColumn("_v", array_to_vector(F.col(vector_column).cast("array<double>")))
    scaler = StandardScaler(inputCol="_v", outputCol="_centred", withMean=True, withStd=False)
    centred = scaler.fit(vectors).transform(vectors)
    model = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(centred)
    coordinates = model.transform(centred).withColumn("_pc", vector_to_array("_pc"))
    loadings = model.pc.toArray()
    signs = [1.0 if c[abs(c).argmax()] > 0 else -1.0 for c in loadings.T]
    names = [(F.get("_pc", F.lit(i)) * signs[i]).alias(f"pc{i + 1}") for i in range(k)]
    return coordinates.select(*df.columns, *names), list(model.explainedVariance.toArray())
