"""Attention over blocks of any length: tiles of keys, partial softmax sums, one merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tokenloom.operators.datasets import with_offsets

#: Rows of a tile; a task works on two of them at a time.
TILE = 256


def partial_votes(pair: pa.Table) -> pa.Table:
    """One pair of tiles: per query and label the weight exp(score - top) of its earlier keys.

    ``top`` is the query's best score inside this pair, so that sums of several pairs can
    be brought to a common top later. In the pair of a tile with itself, a query that has
    no earlier key there yields one row without label.
    """
    pair = pair.combine_chunks()
    place, asks = (pair.column(name).to_numpy() for name in ("place", "asks"))
    answers = pair.column("answers").to_numpy()
    flat = pair.column("vector").chunk(0).flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(len(place), -1).astype(np.float64)
    own = bool(pair.column("own")[0].as_py())
    queries, keys = np.flatnonzero(asks), np.flatnonzero(answers)
    encoded = pair.column("label").chunk(0).take(pa.array(keys)).dictionary_encode("encode")
    labels, codes = encoded.dictionary, encoded.indices.to_numpy()
    scores = vectors[queries] @ vectors[keys].T / np.sqrt(vectors.shape[1])
    scores[place[queries][:, None] <= place[keys][None, :]] = -np.inf
    top = scores.max(axis=1, initial=-np.inf)
    looking = np.flatnonzero(top > -np.inf)
    weights = np.exp(scores[looking] - top[looking, None])
    by_label = weights @ np.eye(len(labels))[codes]
    row, code = np.nonzero(by_label)
    found = queries[looking[row]]
    alone = queries[top == -np.inf] if own else queries[:0]
    ids, answer = pair.column("id").chunk(0), pair.column("label").chunk(0)
    nothing = len(alone)
    return pa.table(
        {
            "id": ids.take(pa.array(np.concatenate([found, alone]))),
            "y": pa.concat_arrays([labels.take(pa.array(code)), pa.nulls(nothing, answer.type)]),
            "label": answer.take(pa.array(np.concatenate([found, alone]))),
            "top": pa.concat_arrays([pa.array(top[looking[row]]), pa.nulls(nothing, pa.float64())]),
            "weight": pa.concat_arrays([pa.array(by_label[row, code]), pa.nulls(nothing, pa.float64())]),
        }
    )


def soft_knn_blocks(
    df: DataFrame,
    length: int,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """What ``models.soft_knn`` answers, for blocks of any length: (key, label, predicted, weight).

    Rows in key order form blocks of ``length`` rows. A block is cut into tiles; every tile
    of queries meets every tile of keys not after it in a group of its own, which holds two
    tiles at most, so no task ever holds a block. A row is sent once per tile of its block.
    The partial sums (top score, weight per label) of a query are merged by its key: each
    is scaled by exp(top - greatest top), as in a softmax over all keys at once.
    Keys without a label draw weight but get no vote. Vectors must not be null and must
    have one dimension; keys must be unique. ``df`` must be materialized.
    """
    placed = with_offsets(df.select(key, vector, label), key, F.lit(1))
    rows = placed.select(F.max("offset")).first()[0]
    if rows is None:
        rows = -1
    place = F.col("offset") % length
    # the last block may be shorter
    last = F.least(F.lit(rows) - (F.col("offset") - place), F.lit(length - 1))
    mine, other = F.col("mine"), F.col("other")
    full = F.coalesce(F.col(vector), F.raise_error(F.lit("vectors must not be null")))
    dealt = (
        placed.select(
            F.expr(f"offset div {length}").alias("block"),
            place.alias("place"),
            F.col(key).alias("id"),
            full.alias("vector"),
            F.col(label).alias("label"),
            F.floor(place / tile).alias("mine"),
            F.floor(last / tile).alias("last"),
        )
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
        .select(
            "block",
            F.greatest(mine, other).alias("later"),
            F.least(mine, other).alias("earlier"),
            "place",
            "id",
            "vector",
            "label",
            (mine >= other).alias("asks"),
            (mine <= other).alias("answers"),
            (mine == other).alias("own"),
        )
    )
    types = {field.name: field.dataType for field in df.schema.fields}
    partial = dealt.groupBy("block", "later", "earlier").applyInArrow(
        partial_votes,
        StructType(
            [
                StructField("id", types[key]),
                StructField("y", types[label]),
                StructField("label", types[label]),
                StructField("top", DoubleType()),
                StructField("weight", DoubleType()),
            ]
        ),
    )
    of_query = Window.partitionBy("id")
    merged = (
        partial.withColumn("weight", F.col("weight") * F.exp(F.col("top") - F.max("top").over(of_query)))
        .groupBy("id", "y")
        .agg(F.first("label", ignorenulls=True).alias("label"), F.sum("weight").alias("weight"))
        .withColumn("share", F.round(F.col("weight") / F.sum("weight").over(of_query), 9))
    )
    vote = F.when(F.col("y").isNotNull(), F.struct("share", (-F.col("y")).alias("negative")))
    best = merged.groupBy("id").agg(
        F.first("label", ignorenulls=True).alias("label"), F.max(vote).alias("best")
    )
    return best.select(
        F.col("id").alias(key),
        F.col("label").alias(label),
        (-F.col("best.negative")).alias("predicted"),
        F.col("best.share").alias("weight"),
    )
