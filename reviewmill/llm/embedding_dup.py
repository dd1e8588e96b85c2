"""Near-duplicate vectors by sorted projection passes.

In every pass each vector gets a string of random hashes (signs of random projections) and the vectors of
a label are ordered by it. Projections are taken around the mean of the label, so that a label whose vectors
all point one way is told apart as well as any other. Neighbours in a bounded window of that order are
compared by cosine, and links of all passes are united. Similar vectors agree in long beginnings of the
string, so several short windows in different orders find nearly all of them. Passes are made in rounds with
new projections until a round unites hardly any more vectors, so a large or dense label gets as many as it
needs. Vectors of a component are then compared once more, block by block, so that the number of links
is whole however large a component is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.components import connected_components
from reviewmill.session import cut_lineage

BITS = 48


@dataclass(frozen=True)
class Settings:
    """A vector is compared with the next ``window`` ones in the order of each pass. Rounds have ``passes`` passes each;
    there are at least two, and they end with one that unites no more than ``settled`` of all vectors united
    by then. ``block`` vectors are handled together."""

    threshold: float = 0.93
    passes: int = 6
    settled: float = 0.001
    window: int = 256
    block: int = 1024
    seed: int = 41


def _prepare(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, settings.block):
                out = []
                for vec_id, vector, label in zip(*(c.to_pylist() for c in batch.slice(low, settings.block).columns), strict=True):
                    values = np.array(vector, dtype=np.float64) if vector and None not in vector else np.zeros(0)
                    # Scaling by the largest component first keeps the length of huge and tiny vectors finite.
                    top = np.abs(values).max(initial=0.0)
                    if vec_id is None or label is None or not np.isfinite(top) or top == 0:
                        continue
                    values = values / top
                    unit = values / np.sqrt(values @ values)
                    out.append((vec_id, label, len(unit), unit.tobytes()))
                columns = list(zip(*out, strict=True)) or [[]] * 4
                types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["vec_id", "label", "size", "unit"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each label and length in a task, a row per component."""
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        total: dict[tuple, np.ndarray] = {}
        for key, unit in zip(keys, batch.column(2).to_pylist()):
            found = total.get(key)
            total[key] = np.frombuffer(unit) if found is None else found + np.frombuffer(unit)
        label = np.repeat([k[0] for k in total], [k[1] for k in total]).astype(np.int64)
        size = np.repeat([k[1] for k in total], [k[1] for k in total]).astype(np.int32)
        place = np.concatenate([np.arange(k[1], dtype=np.int32) for k in total]) if total else np.zeros(0, dtype=np.int32)
        value = np.concatenate(list(total.values())) if total else np.zeros(0)
        yield pa.record_batch([pa.array(x) for x in (label, size, place, value)], names=["label", "size", "place", "value"])


def _centres(classes: DataFrame) -> DataFrame:
    """The mean unit vector of each label and length: as many numbers as a vector has, per label."""
    counts = classes.groupBy("label", "size").agg(F.count("*").alias("n"))
    sums = classes.select("label", "size", "unit").mapInArrow(_sums, "label long, size int, place int, value double")
    sums = sums.groupBy("label", "size", "place").agg(F.sum("value").alias("value"))
    listed = sums.groupBy("label", "size").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("listed"))
    mean = F.transform("listed", lambda x: x["value"] / F.col("n"))
    return listed.join(counts, ["label", "size"]).select("label", "size", mean.alias("centre"))


def _hash(settings: Settings, number: int):
    """The hashes of a round of passes, from rows ``label, size, unit, rep, centre``."""
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(BITS, dtype=np.int64))[::-1]
        for batch in batches:
            for low in range(0, batch.num_rows, settings.block):
                part = batch.slice(low, settings.block)
                sizes = part.column(1).to_numpy()
                hashes = np.zeros((part.num_rows, settings.passes), dtype=np.int64)
                for size in np.unique(sizes).tolist():
                    if size not in planes:
                        draw = np.random.default_rng([settings.seed, number, size])
                        planes[size] = draw.standard_normal((size, settings.passes * BITS))
                    at = np.flatnonzero(sizes == size)
                    chosen = part.take(pa.array(at))
                    units = np.frombuffer(b"".join(chosen.column(2).to_pylist())).reshape(-1, size)
                    centres = chosen.column(4).flatten().to_numpy().reshape(-1, size)
                    signs = ((units - centres) @ planes[size] > 0).reshape(-1, settings.passes, BITS)
                    hashes[at] = signs @ weights
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * settings.passes)
                lists = pa.ListArray.from_arrays(ends, pa.array(hashes.ravel()))
                yield pa.record_batch([*part.columns[:4], lists], names=["label", "size", "unit", "rep", "hashes"])

    return run


def _united(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row of its component."""
    labels = np.arange(len(near))
    near = near | np.eye(len(near), dtype=bool)
    while True:
        lowest = np.where(near, labels, len(near)).min(axis=1)
        lowest = lowest[lowest]
        if (lowest == labels).all():
            return labels
        labels = lowest


def _window_links(settings: Settings):
    def run(group: pa.Table) -> pa.Table:
        frame = group.to_pandas().sort_values("rank")
        place = frame["rank"].to_numpy()
        own = (frame["pass"].to_numpy(), frame["label"].to_numpy(), frame["size"].to_numpy())
        ids, a, b = frame["rep"].to_numpy(), [], []
        # Rows of one pass, label and length are next to each other.
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in own], axis=0)) + 1
        for part in np.split(np.arange(len(frame)), cuts):
            if len(part) < 2:
                continue
            units = np.stack([np.frombuffer(u) for u in frame["unit"].iloc[part]])
            apart = np.abs(place[part][:, None] - place[part])
            root = _united((units @ units.T >= settings.threshold) & (apart <= settings.window))
            moved = np.flatnonzero(root != np.arange(len(part)))
            a.append(ids[part][root[moved]])
            b.append(ids[part][moved])
        pairs = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a, b)]
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return run


def _count_links(settings: Settings):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["component", "side", "rep"])
        found = []
        for _, part in frame.groupby("component"):
            units = np.stack([np.frombuffer(u) for u in part["unit"]])
            sides, copies, ids = part["side"].to_numpy(), part["copies"].to_numpy(), part["rep"].to_numpy()
            near = units @ units.T >= settings.threshold
            np.fill_diagonal(near, False)
            if len(np.unique(sides)) > 1:  # two blocks of a large component: only links between them
                near &= sides[:, None] != sides
            elif frame["halves"].iloc[0]:
                near[:] = False
            found.append(pd.DataFrame({"rep": ids, "links": near @ copies}))
        return pd.concat(found)

    return run


def _round(classes: DataFrame, centres: DataFrame, settings: Settings, number: int) -> DataFrame:
    """Links of one round of passes, as stars: each vector with the first one of those it hangs together with."""
    schema = "label long, size int, unit binary, rep long, hashes array<long>"
    hashed = classes.select("label", "size", "unit", "rep").join(centres, ["label", "size"]).mapInArrow(_hash(settings, number), schema)
    # All passes in one order; the place of a row is its partition's first place and its place in there.
    passes = hashed.select("label", "size", "unit", "rep", F.posexplode("hashes").alias("pass", "hash"))
    order = ["pass", "label", "size", "hash", "rep"]
    ordered = passes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ordered = cut_lineage(ordered.drop("hash"), "ordered")
    part, before = F.shiftright("at", 33), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    firsts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = ordered.withColumn("part", part).join(firsts, "part")
    rank = F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.floor(F.col("rank") / settings.block)
    blocks = F.when(F.col("rank") % settings.block < settings.window, F.array(block, block - 1)).otherwise(F.array(block))
    placed = placed.withColumn("rank", rank).withColumn("block", F.explode(blocks))
    placed = placed.select("block", "rank", "pass", "label", "size", "rep", "unit")
    return cut_lineage(placed.groupBy("block").applyInArrow(_window_links(settings), "a long, b long").distinct(), "links")


def _components(classes: DataFrame, centres: DataFrame, settings: Settings) -> DataFrame:
    """Rounds of passes until they settle; two numbers a round come to the driver."""
    links, number, united, components = None, 0, 0, None
    while True:
        found = _round(classes, centres, settings, number)
        number += 1
        links = found if links is None else cut_lineage(
            components.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")).union(found), "links"
        )
        components = cut_lineage(connected_components(links), "components")
        now = components.filter("node <> component").count()
        if number > 1 and now - united <= settings.settled * now:
            return components
        united = now


def near_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Vectors are linked if their labels are equal and their cosine is at least the threshold. A vector
    that is null, zero, or holds nulls or values that are not finite, has a null label or a null id, links
    with nothing, and so do vectors of different lengths. Equal vectors of a label are one class with as many
    links as copies. A row that repeats a ``vec_id`` is a copy of its own.
    """
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    prepared = cut_lineage(rows.mapInArrow(_prepare(settings), "vec_id long, label long, size int, unit binary"), "vectors")
    classes = prepared.groupBy("label", "size", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = cut_lineage(classes, "classes")
    centres = cut_lineage(_centres(classes), "centres")
    components = _components(classes, centres, settings)
    spread = components.groupBy("component").agg(F.ceil(F.count("*") / settings.block).alias("parts"))
    # Members of each component in blocks; a large component as all pairs of its blocks.
    members = classes.join(components, classes.rep == components.node).join(spread, "component").withColumn(
        "side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    )
    buckets = max(1, components.count() // settings.block)
    small = members.filter("parts = 1").select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(buckets))).alias("key"),
        "component", "side", "rep", "copies", "unit", F.lit(False).alias("halves"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))
    large = members.filter("parts > 1").withColumn("other", other).select(
        F.concat_ws("/", "component", F.least("side", "other"), F.greatest("side", "other")).alias("key"),
        "component", "side", "rep", "copies", "unit", (F.col("side") != F.col("other")).alias("halves"),
    )
    counted = small.union(large).groupBy("key").applyInPandas(_count_links(settings), "rep long, links long")
    counted = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    labelled = classes.join(components, classes.rep == components.node, "left").join(counted, "rep", "left").select(
        "label", "size", "unit", F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    found = prepared.select("vec_id", "label", "size", "unit").join(labelled, ["label", "size", "unit"])
    found = found.select("vec_id", "n_links", "component_id")
    alone = rows.select("vec_id").join(prepared.select("vec_id"), "vec_id", "left_anti")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

