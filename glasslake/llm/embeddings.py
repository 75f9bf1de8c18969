"""Embedding near-dedup by collision-counting projections.

Unit vectors are projected on many random lines. In each table, rows with equal cells of a few coarse projections are
sorted along one more line; a vector's window there holds its possible partners. For each pair in a window the
collisions on COUNTED further lines are counted (projections less than a set distance apart), pairs with a count that
real partners reach with probability RECALL are verified by cosine in double precision, and each pair counts in the
first table that holds it, so no pair is kept as a row: tasks return link counts and spanning links.

Vectors are compared inside one label. Exact copies are one class with a multiplicity, so a vector that a third of
all rows share costs one row. Long runs are dealt out as tiles.

Defined results: a null label or vector, null, NaN or infinite components, and zero vectors link with nothing and
are kept; vectors of other lengths never link; rows of one id count as separate vectors, equal or not; rows with a
null id are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import components, forest, join_counted, materialize, run_pairs
from glasslake.llm.wordhash import mix

#: Tables, coarse lines per table, their cell width, counted lines, and the recall that the count is set for.
TABLES, COARSE, CELL, COUNTED, RECALL = 16, 6, 1.5, 32, 0.999


def lines(dim: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random lines for vectors of one length: coarse, their offsets, sorting, counted."""
    rng = np.random.default_rng([seed, dim])
    return rng.normal(size=(dim, TABLES * COARSE)), rng.uniform(0, CELL, TABLES * COARSE), rng.normal(size=(dim, TABLES)), rng.normal(size=(dim, COUNTED))


def least_collisions(distance: float, width: float, recall: float = RECALL) -> int:
    """Largest count that a pair at the distance reaches with the given probability: collisions are binomial."""
    p = erf(width / distance / sqrt(2))
    chance = np.cumsum([comb(COUNTED, k) * p**k * (1 - p) ** (COUNTED - k) for k in range(COUNTED, -1, -1)])[::-1]
    return max(k for k in range(COUNTED + 1) if chance[k] >= recall or k == 0)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(x: np.ndarray) -> np.ndarray:
    """(n, TABLES) hash of the coarse cells of each unit vector in each table."""
    coarse, offset, _, _ = lines(x.shape[1])
    at = np.floor((x @ coarse + offset) / CELL).astype(np.int64).view(np.uint64).reshape(len(x), TABLES, COARSE)
    h = np.repeat(np.arange(1, TABLES + 1, dtype=np.uint64)[None, :], len(x), axis=0)
    for k in range(COARSE):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + at[:, :, k])
    return h


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per vector and table: key (label, table, cells), place along the table's sorting line."""
    for batch in batches:
        lengths = batch.column("embedding").value_lengths().to_numpy()
        for dim in np.unique(lengths):
            part = batch.filter(pa.array(lengths == dim))
            for at in range(0, part.num_rows, 1024):
                rows = part.slice(at, 1024)
                raw = rows.column("embedding").flatten().to_numpy().reshape(rows.num_rows, dim)
                x = unit(raw)
                label = rows.column("label").to_numpy().astype(np.int64).view(np.uint64)
                key = mix(cells(x) + mix(label * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(dim))[:, None])
                place = x @ lines(int(dim))[2]
                pick = np.repeat(np.arange(rows.num_rows), TABLES)
                ends = np.arange(0, len(pick) * dim + 1, dim, dtype=np.int32)
                cols = [pa.array(key.ravel().view(np.int64)), pa.array(place.ravel()), rows.column("class").take(pa.array(pick)), rows.column("m").take(pa.array(pick)), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), rows.num_rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(raw[pick].ravel()))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "place", "class", "m", "tab", "vec"])


def _visit(threshold: float):
    distance = sqrt(2 * (1 - threshold))
    width = 1.5 * distance
    least = least_collisions(distance, width)

    def near(cols, i, j):
        return cols["place"][j] - cols["place"][i] <= 4 * distance

    def visit(cols, pairs):
        rep, m, tab = cols["class"], cols["m"], cols["tab"]
        length = np.array([len(v) for v in cols["vec"]])
        # vectors of other lengths have other keys; zeros behind the shorter ones change no product
        x, home, counted = np.zeros((len(rep), length.max(initial=0))), np.zeros((len(rep), TABLES), np.uint64), np.zeros((len(rep), COUNTED))
        for dim in np.unique(length):
            own = np.flatnonzero(length == dim)
            y = unit(np.stack([cols["vec"][k] for k in own]))
            x[own, :dim], home[own], counted[own] = y, cells(y), y @ lines(int(dim))[3]
        us, vs, n = [], [], 0
        count = np.zeros(len(rep), np.int64)
        for i, j in pairs:
            for at in range(0, len(i), 8192):
                a, b = i[at : at + 8192], j[at : at + 8192]
                ok = (np.abs(counted[a] - counted[b]) <= width).sum(axis=1) >= least
                a, b = a[ok], b[ok]
                ok = (x[a] * x[b]).sum(axis=1) >= threshold
                a, b = a[ok], b[ok]
                ok = (home[a] == home[b]).argmax(axis=1) == tab[a]  # the first table that holds the pair
                np.add.at(count, a[ok], m[b[ok]])
                np.add.at(count, b[ok], m[a[ok]])
                if len(a):
                    us.append(rep[a])
                    vs.append(rep[b])
                    n += len(a)
                    if n > 1_000_000:
                        u, v = forest(np.concatenate(us), np.concatenate(vs))
                        us, vs, n = [u], [v], len(u)
        u, v = forest(np.concatenate(us), np.concatenate(vs)) if us else (np.array([], np.int64), np.array([], np.int64))
        full = np.flatnonzero(count)
        # a count row names its vector twice, a link row has no count
        return {"u": np.append(rep[full], u), "v": np.append(rep[full], v), "n": np.append(count[full], np.zeros(len(u), np.int64))}

    return near, visit


def near_vectors(table: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector of embeddings(vec_id, embedding, label)."""
    vectors = table.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    marked = vectors.withColumn("good", good)
    usable = marked.where("good")
    # a 128-bit digest of label and vector stands for the vector wherever rows meet again
    usable = materialize(usable.withColumn("digest", F.struct(F.xxhash64("label", "embedding").alias("a"), F.xxhash64("embedding", F.lit(1)).alias("b"))).select("vec_id", "digest", "label", "embedding"), "vectors")
    classes = usable.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    near, visit = _visit(threshold)
    entries = classes.select("class", "m", "label", "embedding").mapInArrow(_entries, "key long, place double, class long, m long, tab int, vec array<float>")
    found = run_pairs(entries, ["place", "class"], visit, "u long, v long, n long", "vector-links", near=near)
    counts = found.where("n > 0").groupBy(F.col("u").alias("class")).agg(F.sum("n").alias("links"))
    groups = components(found.where("n = 0").select("u", "v"), "vector-components").select(F.col("node").alias("class"), F.col("component"))
    named = classes.select("class", "rep", "m", "digest").join(counts, "class", "left").join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = materialize(named.join(least, "component").select("digest", "m", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"), "vector-named")
    linked = join_counted(usable.select("vec_id", "digest"), named, ["digest"], "m").select("vec_id", "n_links", "component_id")
    alone = marked.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
