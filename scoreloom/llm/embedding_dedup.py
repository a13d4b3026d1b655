"""Near-duplicate embeddings: int8 tile products with error bounds, exact where in doubt."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.components import connected_components
from scoreloom.llm.scratch import scratch_table

TILE = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, scale, error)``: int8 codes with ``unit ~ codes * scale``, and the norm of what is lost."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def doubtful_pairs(x: tuple, y: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two tiles whose product may reach ``threshold``.

    With unit vectors u, v and their quantised u', v': u.v - u'.v' =
    (u - u').v + u'.(v - v'), at most e_u + |u'| e_v, where |u'| <= 1 + e_u.
    The code products are whole numbers below 2**24, so exact in single precision
    up to 1,040 dimensions; beyond, double precision is used.
    """
    (cx, sx, ex), (cy, sy, ey) = x, y
    kind = np.float32 if cx.shape[1] <= 1_040 else np.float64
    whole = cx.astype(kind) @ cy.astype(kind).T
    product = whole.astype(np.float64) * sx[:, None] * sy[None, :]
    slack = ex[:, None] + (1.0 + ex[:, None]) * ey[None, :]
    return np.nonzero(product + slack + 1e-9 >= threshold)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _tile_links(threshold: float):
    """Links of two tiles: per vector how many, and edges that join what is joined."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"node": [], "links": [], "other": []}).astype("int64")
        if not len(left) or not len(right):
            return none
        own = bool(left["tile_a"].iat[0] == left["tile_b"].iat[0])
        ids = [d["node"].to_numpy() for d in (left, right)]
        copies = [d["copies"].to_numpy() for d in (left, right)]
        vectors = [np.array(d["vector"].tolist(), np.float64) for d in (left, right)]
        units = [v / np.sqrt((v * v).sum(axis=1))[:, None] for v in vectors]
        i, j = doubtful_pairs(quantised(units[0]), quantised(units[1]), threshold)
        if own:
            keep = ids[0][i] < ids[1][j]
            i, j = i[keep], j[keep]
        near = np.concatenate(
            [np.zeros(0, bool)] + [_cosines(vectors[0][i[k : k + 65536]], vectors[1][j[k : k + 65536]]) >= threshold for k in range(0, len(i), 65536)]
        )
        a, b = ids[0][i[near]], ids[1][j[near]]
        if not len(a):
            return none
        return _counted_and_spanned(a, b, copies[0][i[near]], copies[1][j[near]])

    return run


def _counted_and_spanned(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> pd.DataFrame:
    """Links of each node, and the smallest node it reaches over these links: one row per node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    links = np.bincount(x, n_b, len(nodes)) + np.bincount(y, n_a, len(nodes))
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = least[least]
        if (least == label).all():
            break
        label = least
    return pd.DataFrame({"node": nodes, "links": links.astype(np.int64), "other": nodes[label]})


def embedding_links(
    rows: DataFrame, threshold: float = 0.98, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(<id>, n_links, component_id, kept)`` of every row.

    Two vectors of equal, not null labels link if their cosine in double precision
    is ``threshold`` or more. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing, nor do vectors of different lengths
    with each other. ``component_id`` is the smallest id reachable over links;
    ``kept`` marks the rows that bear it. Rows that repeat an id are separate
    vectors; they and other copies link with each other. A null id is kept if its
    component has no other.

    Equal vectors of a label are compared once. Those of a label are dealt to tiles
    of about ``tile``; each pair of tiles is one task's product of int8 codes, and
    only pairs that the error bounds leave in doubt are recomputed exactly. All
    pairs of a label are looked at, so the work grows with their number, spread
    evenly over tile pairs however large a label is.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    sound = F.expr(
        "vector is not null and size(vector) > 0 and label is not null "
        "and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(vector, x -> x <> 0)"
    )
    # Scaled by a power of two near the largest component: cosines stay to the last
    # bit, and squares neither overflow nor vanish.
    power = F.floor(F.log2(F.array_max(F.transform("vector", F.abs)))).cast("double")
    half = F.floor(power / 2).cast("double")
    scaled = F.when(sound, F.transform("vector", lambda x: x * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - power)))
    # Negative and positive zero are one value.
    scaled = F.transform(scaled, lambda x: F.when(x == 0, 0.0).otherwise(x))
    base = base.select("id", "label", scaled.alias("vector")).withColumn(
        "node", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))
    )
    base = scratch_table(base, "embedding-rows")
    classes = base.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.size(F.first("vector")).alias("dims"), F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("copies"),
    )
    classes = scratch_table(classes, "embedding-classes")
    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    dealt = classes.join(sizes, ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    columns = ("label", "dims", "tile_a", "tile_b", "node", "copies", "vector")
    left = dealt.withColumn("tile_a", F.col("tile")).withColumn("tile_b", F.explode(F.expr("sequence(tile, tiles - 1)"))).select(*columns)
    right = dealt.withColumn("tile_b", F.col("tile")).withColumn("tile_a", F.explode(F.expr("sequence(0, tile)")))
    right = right.select(*[F.col(c).alias(c) for c in columns])
    keys = ["label", "dims", "tile_a", "tile_b"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_tile_links(threshold), "node long, links long, other long")
    found = scratch_table(found, "embedding-links")
    components = connected_components(found, "node", "other")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = base.join(classes.select("node", "copies"), "node", "left").join(counts, "node", "left").join(components, "node", "left")
    joined = joined.withColumn("key", F.coalesce("component", "node"))
    names = joined.where("node is not null").groupBy("key").agg(F.min("id").alias("least"))
    out = joined.join(names, "key", "left").withColumn("component_id", F.coalesce("least", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("node").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
