"""Vectors of texts: making them, reading them, class outliers, projection to two dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import PCA, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_vectors, vector_distance
from ..sources.writers import update_from
from ..session import cut_lineage
from .aggregates import group_mean, vector_centroid
from .joins import join_centroid
from .text import words


def embed_text(
    df: DataFrame, col: str, fn: Callable[[list[str]], Sequence[Sequence[float]]] | None = None, dim: int = 64,
    out: str = "embedding",
) -> DataFrame:
    """Adds a vector per text.

    ``fn`` maps a list of texts to vectors and is called once per Arrow batch. Without it the vector
    holds hashed token counts of unit length, computed without Python; an empty text gets zeros.
    """
    if fn is None:
        counted = HashingTF(numFeatures=dim, inputCol="_tokens", outputCol="_counts").transform(
            df.withColumn("_tokens", words(F.lower(col)))
        )
        unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
        return unit.withColumn(out, vector_to_array("_unit")).drop("_tokens", "_counts", "_unit")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def embed(batches):
        for batch in batches:
            vectors = fn(batch[col].tolist())
            yield batch.assign(**{out: [[float(x) for x in v] for v in vectors]})

    return df.mapInPandas(embed, schema)


def parse_embeddings(chunks: DataFrame, predictions: DataFrame, id: str) -> DataFrame:
    """Chunk rows with their ``embedding`` taken from the JSON payload of the matching prediction row."""
    parsed = predictions.select(id, F.explode(json_vectors("predictions")).alias("embedding"))
    return update_from(chunks, parsed, [id], ["embedding"])


def class_distances(df: DataFrame, by: str, vec: str, out: str = "distance") -> DataFrame:
    """Each row's distance to the centroid of its class, computed once."""
    centroids = cut_lineage(vector_centroid(df, by, vec, "_centroid"))  # sized, then joined
    return join_centroid(df, centroids, by).withColumn(out, vector_distance(vec, "_centroid")).drop("_centroid")


def class_outliers(df: DataFrame, by: str, vec: str, radius: float) -> DataFrame:
    """Rows farther than ``radius`` from their class centroid."""
    return class_distances(df, by, vec).filter(F.col("distance") > radius)


def radius_sweep(df: DataFrame, by: str, vec: str, radii: Sequence[float]) -> DataFrame:
    """Outlier count for each radius; every row is measured once and counted for all radii in the same pass."""
    counts = [F.count(F.when(F.col("distance") > r, 1)).alias(f"_{i}") for i, r in enumerate(radii)]
    one = class_distances(df, by, vec).agg(*counts)
    rows = [F.struct(F.lit(float(r)).alias("radius"), F.col(f"_{i}").alias("outliers")) for i, r in enumerate(radii)]
    return one.select(F.inline(F.array(*rows)))


def project_2d(df: DataFrame, vec: str, out: Sequence[str] = ("x", "y")) -> DataFrame:
    """Two coordinates per row: the first two principal components."""
    rows = df.withColumn("_vec", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=2, inputCol="_vec", outputCol="_plane").fit(rows)
    plane = vector_to_array("_plane")
    return model.transform(rows).withColumns({name: plane[i] for i, name in enumerate(out)}).drop("_vec", "_plane")


def plane_centroids(projected: DataFrame, by: str, out: Sequence[str] = ("x", "y")) -> DataFrame:
    return group_mean(projected, by, list(out))
