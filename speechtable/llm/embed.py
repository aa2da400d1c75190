"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector a key of concatenated random hashes (signs of random projections, most significant first)
and sorts vectors by it within their label; vectors at most ``window`` places apart are compared. A 256-bit
sign sketch travels with the key, so a pass moves some 60 bytes a vector whatever its dimension; pairs whose
sketches differ in no more bits than a true pair ever would (seven standard deviations) are verified by cosine in double
precision. Verified pairs of all passes are united into components, and the links inside a component are then counted
exactly, block by block, so a family wider than the window loses none.

Scale: identical vectors of a label are one row with a count, so a common vector is no hot key. Sorting is a range
partitioning over (pass, label, key); a hot label is just many ranges. Window blocks are cut by global rank
with the next block's first rows added, hence no result depends on partition borders. Components are compared in blocks of
``BLOCK`` rows; nothing is collected.

Null labels, null, empty or zero vectors, and vectors with null or non-finite components link with nothing and stay rows.
Vectors of different length are never compared. Repeated ids count as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings
from speechtable.llm.components import components

BLOCK = 1024
_SKETCH = 256
_KEY = 63


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares of extreme values finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def classes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(rep, label, vector, first, n, dims): one row per distinct usable vector of a label; rep is its hash, first its smallest id."""
    v = F.col(vector_col)
    good = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    usable = vectors.where(F.col(label_col).isNotNull() & v.isNotNull() & good)
    return usable.groupBy(F.col(label_col).alias("label"), v.alias("vector")).agg(
        F.min(id_col).alias("first"), F.count("*").alias("n")).select(
        F.xxhash64("label", "vector").alias("rep"), "label", "vector", "first", "n", F.size("vector").alias("dims"))


def _keys(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """One row per class and pass: the sort key and the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column(3).to_numpy()
            for dims in np.unique(size):
                part = batch.filter(pa.array(size == dims))
                dims = int(dims)
                if dims not in planes:
                    planes[dims] = np.random.default_rng([seed, dims]).standard_normal((dims, _SKETCH + passes * _KEY))
                for at in range(0, part.num_rows, 2048):
                    piece = part.slice(at, 2048)
                    n = piece.num_rows
                    signs = _unit(_matrix(piece.column(2), dims)) @ planes[dims] > 0
                    sketch = np.packbits(signs[:, :_SKETCH], axis=1)
                    bits = signs[:, _SKETCH:].reshape(n, passes, _KEY)
                    weights = 1 << np.arange(_KEY - 1, -1, -1, dtype=np.int64)
                    for k in range(passes):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(n, k, np.int32)), piece.column(1), piece.column(3), pa.array(bits[:, k] @ weights),
                            piece.column(0), pa.array([r.tobytes() for r in sketch], pa.binary())],
                            ["pass", "label", "dims", "key", "rep", "sketch"])

    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    return classes.select("rep", "label", "vector", "dims").mapInArrow(
        run, f"pass int, label {kind['label']}, dims int, key long, rep {kind['rep']}, sketch binary")


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Global dense rank: sorted ranges on the shared folder, and one offset per range."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    table = settings.materialize(sorted_rows, "passes")
    part = F.shiftright("_at", 33)
    counts = sorted((r["part"], r["n"]) for r in table.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for number, n in counts:
        offsets.append((number, total))
        total += n
    lookup = table.sparkSession.createDataFrame(offsets or [(0, 0)], "part long, before long")
    return table.withColumn("part", part).join(F.broadcast(lookup), "part").withColumn(
        "rank", F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "part", "before")


def candidate_pairs(classes: DataFrame, passes: int, window: int, cosine: float, seed: int) -> DataFrame:
    """(a, b): distinct pairs that stand within the window in some pass and whose sketches are near."""
    rows = _ranked(_keys(classes, passes, seed), ["pass", "label", "dims", "key", "rep"])
    p = float(np.arccos(cosine) / np.pi)
    limit = int(np.ceil(_SKETCH * p + 7 * np.sqrt(_SKETCH * p * (1 - p))))
    size = max(4096, 4 * window)
    block = F.floor(F.col("rank") / size)
    spread = F.when((F.col("rank") % size < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    kind = classes.schema["rep"].dataType.simpleString()

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint64).reshape(len(pdf), -1)
        rep = pdf["rep"].to_numpy()
        same = pdf.groupby(["pass", "label", "dims"], sort=False).ngroup().to_numpy()
        own = (pdf["rank"].to_numpy() // size) == key[0]
        left, right = [], []
        for step in range(1, min(window, len(pdf) - 1) + 1):
            apart = np.bitwise_count(sketch[:-step] ^ sketch[step:]).sum(axis=1)
            hit = np.flatnonzero((apart <= limit) & (same[:-step] == same[step:]) & own[:-step])
            left.append(rep[hit])
            right.append(rep[hit + step])
        pairs = pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)}) if left else pd.DataFrame({"a": rep[:0], "b": rep[:0]})
        return pairs.drop_duplicates()

    found = rows.withColumn("block", F.explode(spread)).groupBy("block").applyInPandas(compare, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold."""
    side = lambda name: classes.select(F.col("rep").alias(name), F.col("vector").alias(f"v{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            for dims in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dims))
                dot = np.einsum("ij,ij->i", _unit(_matrix(part.column(2), int(dims))), _unit(_matrix(part.column(3), int(dims))))
                yield part.filter(pa.array(dot >= cosine)).select([0, 1])

    kind = classes.schema["rep"].dataType.simpleString()
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "va", "vb")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def count_links(members: DataFrame, cosine: float) -> DataFrame:
    """(rep, links): vectors at or above the threshold inside the component, from blocks of rows against blocks of rows."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    chunked = members.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    # A row meets every chunk of its component once: as the left side of later chunks and the right side of earlier ones.
    spread = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "rep", "vector", "n")
    kind = members.schema["rep"].dataType.simpleString()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(np.stack(pdf["vector"].to_numpy()).astype(np.float64))
        n, rep, chunk = pdf["n"].to_numpy(), pdf["rep"].to_numpy(), pdf["chunk"].to_numpy()
        a = np.flatnonzero(chunk == key[1])
        b = np.flatnonzero(chunk == key[2])
        near = unit[a] @ unit[b].T >= cosine
        if key[1] == key[2]:
            np.fill_diagonal(near, False)
            return pd.DataFrame({"rep": rep[a], "links": near @ n[b]})
        return pd.DataFrame({"rep": np.concatenate([rep[a], rep[b]]), "links": np.concatenate([near @ n[b], n[a] @ near])})

    counted = spread.groupBy("component", "i", "j").applyInPandas(run, f"rep {kind}, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = 0.98, passes: int = 24, window: int = 32, seed: int = 7) -> DataFrame:
    """(id, n_links, component_id, kept) for every input row.

    n_links counts the other rows linked directly, equal vectors included; component_id is the smallest id reachable.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    classes = settings.materialize(classes_of(rows, "id", "vector", "label").where("first IS NOT NULL"), "classes")
    pairs = verified(candidate_pairs(classes, passes, window, cosine, seed), classes, cosine)
    found = settings.materialize(components(pairs, "a", "b"), "components")
    members = found.join(classes, found["node"] == classes["rep"]).select("component", "rep", "vector", "n")
    links = count_links(members, cosine)
    least = found.join(classes, found["node"] == classes["rep"]).groupBy("component").agg(F.min("first").alias("least"))
    roots = found.join(least, "component").select("node", "least")
    per_class = classes.join(roots, classes["rep"] == roots["node"], "left").join(links, "rep", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    out = rows.join(per_class, ["label", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (F.col("id") == component).alias("kept"))
