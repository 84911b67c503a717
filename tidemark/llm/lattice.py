"""Operator 11, near duplicates among embeddings by lattice hashing.

A vector is scaled to length one and, for each of ``tables`` tables, projected by a random matrix onto ``points``
times eight dimensions. Each run of eight is decoded to the nearest point of the E8 lattice; the points together are the
vector's cell. The ``probes`` neighbouring cells that the projection lies nearest to (a step along one of the lattice's
240 shortest vectors, or two such steps in different runs) are its cells too. Two vectors with equal labels that have any cell in
common are compared by their exact cosine. Recall follows from the parameters alone, not from the table's size: with the
defaults 0.97 of pairs at cosine 0.93 share a cell, 0.99 at 0.95 and all but a few in a million at 0.98.

How it is spread: equal (label, vector) rows are one class from the first aggregate on. Cells are counted by 8-byte keys; only classes
in a cell with others move with their vector, once for each such cell. A pair that shares several cells counts in the
first of them only, which each task sees from the cells that the rows carry, so link counts need no list of pairs. A cell of more than
``block`` classes is split into blocks, and each pair of blocks is a group of its own. Tasks return a number of links for each class and the
edges of a spanning forest, not the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
nothing; so do vectors of unequal lengths with each other. Every row counts as a vector of its own, also where ids repeat; a null
id takes part but is no component id (null only if the whole component has none); ``kept`` holds for rows that carry
the component's id, and for all rows of a component without one. Extra columns do not pass.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise
from tidemark.llm.components import components
from tidemark.llm.tokens import mix64

TABLES, POINTS, PROBES, WIDTH = 6, 2, 2, 2.1
BLOCK = 8192
SMALL = 32  # groups up to this size are compared together, larger ones by a product of matrices
ROWS = 256


def e8_shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out + halves)


def e8_nearest(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 to each row of eight: the better of the nearest points of D8 and of D8 moved by a half."""

    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        off = y - near
        odd = near.sum(-1) % 2 != 0
        worst = np.abs(off).argmax(-1)[..., None]
        step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
        moved = np.take_along_axis(near, worst, -1) + np.where(odd[..., None], step, 0.0)
        np.put_along_axis(near, worst, moved, -1)
        return near

    whole, half = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1))[..., None], whole, half)


class LatticeTables:
    """Cells of vectors of one length in all tables."""

    def __init__(self, dim: int, tables: int, points: int, probes: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dim, tables, points])
        self.tables, self.points, self.probes = tables, points, probes
        self.matrix = rng.normal(size=(dim, tables * points * 8)) / width
        self.steps = e8_shortest()
        # a random odd multiplier for each doubled coordinate: a cell's key is the scrambled sum
        self.weights = rng.integers(0, 1 << 63, size=(tables, points, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        doubled = (2 * self.steps).astype(np.int64).astype(np.uint64)
        self.step_keys = (doubled[None, None] * self.weights[:, :, None, :]).sum(-1, dtype=np.uint64)
        self.salt = rng.integers(0, 1 << 63, size=tables, dtype=np.uint64)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """int64 keys, for each vector the own cell and its probes, table by table."""
        out = np.empty((len(unit), self.tables, 1 + self.probes), np.uint64)
        for t in range(self.tables):
            width = self.points * 8
            x = (unit @ self.matrix[:, t * width: (t + 1) * width]).reshape(len(unit), self.points, 8)
            at = e8_nearest(x)
            own = ((2 * at).astype(np.int64).astype(np.uint64) * self.weights[t]).sum((1, 2), dtype=np.uint64)
            cost = 2 - 2 * ((x - at) @ self.steps.T)  # growth of the squared distance by one step
            few = min(self.probes, 240)
            best = np.argsort(cost, axis=2, kind="stable")[:, :, : few]
            costs = np.take_along_axis(cost, best, 2)
            keys = np.stack([self.step_keys[t, p][best[:, p]] for p in range(self.points)], 1)
            all_costs, all_keys = [costs.reshape(len(unit), -1)], [keys.reshape(len(unit), -1)]
            for p, q in itertools.combinations(range(self.points), 2):  # steps in two runs at once
                all_costs.append((costs[:, p, :, None] + costs[:, q, None, :]).reshape(len(unit), -1))
                all_keys.append((keys[:, p, :, None] + keys[:, q, None, :]).reshape(len(unit), -1))
            costs, keys = np.concatenate(all_costs, 1), np.concatenate(all_keys, 1)
            first = np.argsort(costs, axis=1, kind="stable")[:, : self.probes]
            out[:, t, 0] = own
            out[:, t, 1:] = own[:, None] + np.take_along_axis(keys, first, 1)
            out[:, t] = mix64(out[:, t] ^ self.salt[t])
        return out.reshape(len(unit), -1).view(np.int64)


def unit_rows(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def whole_groups(batches, keys: list[str], rows: int = 20_000):
    """Tables of about ``rows`` rows of a sorted stream that never cut a group of equal ``keys``."""
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        change = _starts(table, keys)
        cut = int(change[-1])
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        kept, held = table.to_batches(), table.num_rows
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First rows of the groups of a sorted table."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = table.column(k).combine_chunks()
        x = x.dictionary_encode().indices.to_numpy() if pa.types.is_string(x.type) else x.to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


class _Pairs:
    """Links inside groups: counts for each row and edges that span them."""

    def __init__(self, unit, sizes, cells, table, cell, own, cosine: float, width: int):
        self.unit, self.sizes, self.cosine, self.width = unit, sizes, cosine, width
        self.cells = cells.reshape(len(unit), -1, width)
        self.table, self.cell, self.own = table, cell, own
        self.links = np.zeros(len(unit), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def _first_here(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the group's cell is the first that rows i and j have in common."""
        first = np.ones(len(i), bool)
        for t in range(self.cells.shape[1]):
            now = np.flatnonzero(first & (self.table[i] >= t))
            if not len(now):
                break
            a, b = self.cells[i[now], t], self.cells[j[now], t]
            here = self.table[i[now]] == t
            for x, y in itertools.product(range(self.width), repeat=2):
                common = (a[:, x] == b[:, y]) & (~here | (a[:, x] < self.cell[i[now]]))
                first[now[common]] = False
        return first

    def _take(self, i: np.ndarray, j: np.ndarray) -> None:
        first = self._first_here(i, j)
        i, j = i[first], j[first]
        np.add.at(self.links, i, self.sizes[j])
        np.add.at(self.links, j, self.sizes[i])

    def small(self, group: np.ndarray, longest: int) -> None:
        """All groups at once: rows at distance 1, 2, ... of the same group."""
        for d in range(1, longest):
            i = np.flatnonzero(group[:-d] == group[d:])
            i = i[(group[i] >= 0)]
            j = i + d
            near = np.einsum("ij,ij->i", self.unit[i], self.unit[j]) >= self.cosine
            i, j = i[near], j[near]
            if len(i):
                self.edges.append((i, j))
                self._take(i, j)

    def large(self, start: int, end: int, two: bool) -> None:
        """One group by products of row blocks. Rows of ``two`` blocks (``own``) are compared across only."""
        rows = np.arange(start, end)
        low = self.own[rows] == self.own[start]
        left, right = (rows[low], rows[~low]) if two else (rows, rows)
        if not len(right):
            return
        root = np.arange(start, end)
        right_t = self.unit[right].T
        for at in range(0, len(left), ROWS):
            block = left[at: at + ROWS]
            near = self.unit[block] @ right_t >= self.cosine
            if not two:
                near &= block[:, None] < right[None, :]
            for k in np.flatnonzero(near.any(1)):
                i, js = block[k], right[near[k]]
                found = np.unique(root[np.append(js, i) - start])
                if len(found) > 1:
                    root[np.isin(root, found[1:])] = found[0]
                self._take(np.full(len(js), i), js)
        moved = np.flatnonzero(root != rows)
        if len(moved):
            self.edges.append((rows[moved], root[moved]))


def near_vectors(rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93,
                 tables: int = TABLES, points: int = POINTS, probes: int = PROBES, width: float = WIDTH, block: int = BLOCK,
                 seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; see above."""
    v = F.col(f"`{vector}`")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    able = (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)
    base = rows.select(
        F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.when(F.col(f"`{label}`").isNotNull() & able, v.cast("array<double>") if _wide(rows, vector) else v.cast("array<float>")).alias("v"))
    found = base.where("v is not null").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    numbered = found.select(F.monotonically_increasing_id().alias("class"), "*", F.size("v").alias("dim"))
    per_table = 1 + probes

    def cells_of(batches):
        known: dict[int, LatticeTables] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.empty((batch.num_rows, tables * per_table), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                lattice = known.setdefault(int(dim), LatticeTables(int(dim), tables, points, probes, width, seed))
                for k in range(0, len(at), 1024):
                    part = at[k: k + 1024]
                    out[part] = lattice.cells(unit_rows(_matrix(batch.column("v").take(pa.array(part)))))
            offsets = pa.array(np.arange(batch.num_rows + 1) * out.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cells"])

    schema = T.StructType([*numbered.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))])
    classes = materialise(numbered.mapInArrow(cells_of, schema), "lattice_classes")  # written once, so the numbers stay
    keyed = classes.select("class", F.posexplode("cells").alias("place", "cell"))
    shared = materialise(keyed.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1"), "lattice_shared")
    # at most tables * (1 + probes) places of a class
    places = keyed.join(shared, "cell").groupBy("class").agg(F.collect_list(F.struct("place", "cell", "members")).alias("at"))
    spread = (
        places.join(classes, "class")
        .select("class", "label", "dim", "n", "v", "cells", F.explode("at").alias("at"))
        .select("class", "label", "dim", "n", "v", "cells", F.col("at.cell").alias("cell"), (F.col("at.place") / per_table).cast("int").alias("table"),
                F.ceil(F.col("at.members") / block).cast("int").alias("blocks"))
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("cross", F.col("own") != F.col("other"))
        .withColumn("part", F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other"))
        .select("cell", "label", "dim", "part", "class", "n", "table", "own", "cross", "v", "cells")
    )
    keys = ["cell", "label", "dim", "part"]
    # sorted by block too: a group of two blocks has all its rows of one before the other
    dealt = spread.repartition("cell", "part").sortWithinPartitions(*keys, "own", "class")

    def compare(batches):
        for table in whole_groups(batches, keys):
            starts = _starts(table, keys)
            ends = np.append(starts[1:], table.num_rows)
            many = np.flatnonzero(ends - starts > 1)
            if not len(many):
                continue
            dims = table.column("dim").to_numpy()
            for dim in np.unique(dims[starts[many]]):
                chosen = many[dims[starts[many]] == dim]
                at = np.concatenate([np.arange(starts[g], ends[g]) for g in chosen])
                part = table.take(pa.array(at)).combine_chunks()
                sizes = (ends - starts)[chosen]
                first = np.concatenate([[0], np.cumsum(sizes)])
                col = {c: part.column(c).combine_chunks() for c in part.column_names}
                pairs = _Pairs(unit_rows(_matrix(col["v"])), col["n"].to_numpy(), _matrix(col["cells"]), col["table"].to_numpy(),
                               col["cell"].to_numpy(), col["own"].to_numpy(), cosine, per_table)
                cross = col["cross"].to_numpy(zero_copy_only=False)[first[:-1]]
                big = (sizes > SMALL) | cross
                group = np.repeat(np.where(big, -1, np.arange(len(sizes))), sizes)
                if (~big).any():
                    pairs.small(group, int(sizes[~big].max()))
                for g in np.flatnonzero(big):
                    pairs.large(int(first[g]), int(first[g + 1]), bool(cross[g]))
                ids = col["class"].to_numpy()
                linked = np.flatnonzero(pairs.links)
                none = np.full(len(linked), -1)
                out = [(ids[linked], none, pairs.links[linked])]
                out += [(ids[a], ids[b], np.zeros(len(a), np.int64)) for a, b in pairs.edges]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b", "links"])

    result = materialise(dealt.mapInArrow(compare, "a bigint, b bigint, links bigint"), "lattice_links")
    direct = result.where("b < 0").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(result.where("b >= 0").select("a", "b")).withColumnRenamed("node", "class")
    least = roots.join(classes.select("class", "least"), "class").groupBy("root").agg(F.min("least").alias("whole"))
    joined = (
        classes.select("class", "label", "v", "n", "least").join(direct, "class", "left").join(roots, "class", "left").join(least, "root", "left")
        .select("label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("whole")).alias("whole")))
    # copies of one vector may be a third of all rows: the adaptive skew join splits their side
    linkable = base.where("v is not null").join(joined, ["label", "v"], "left").select("id", "links", "whole")
    alone = base.where("v is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("whole"))
    return linkable.unionByName(alone).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("whole").alias("component_id"),
        F.coalesce(F.col("id") == F.col("whole"), F.col("whole").isNull()).alias("kept"))


def _wide(rows: DataFrame, vector: str) -> bool:
    """Whether components need double precision to be kept whole."""
    return rows.schema[vector].dataType.elementType.simpleString() not in ("float", "tinyint", "smallint")
