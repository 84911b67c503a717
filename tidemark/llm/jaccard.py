"""Operator 4, n-gram Jaccard join with count vectors, an R-tree and summed coordinate minima.

A document is the set of its distinct ``k``-word shingles. Two documents link when
100 * intersection >= ``percent`` * union. Sets are hashed to 54-bit integers.

Shingles are hashed into groups. With D the largest symmetric difference of a linked pair,
``K`` > D groups leave at least one group with equal content on both sides. Those groups are the
upper level of the index: documents that agree in a whole group share a cell. (A tree of
bounding boxes alone cannot serve as that level: the counts of unrelated documents of one size
lie closer together than the join's radius, so boxes over many documents prune nothing.) A pair is sought
in the size class of its smaller document; ``K`` follows the class. Should so many groups be empty that all
equal ones might be, the document also enters by its prefix in hash order, which
cannot fail either; so no pair is missed.

Below a cell, documents are points: the vector of their counts in ``DIMS`` groups. Points are
packed into an R-tree by size and coordinates; the overlap of two boxes or points is bounded by the sum of
coordinate minima, and only pairs whose bound allows a link are verified on the sets.

Cells are not joined with themselves outright. First every document is verified against
the most shared document of each of its cells; the components of those links leave most cells
with one component, where no pair can change a result. Only cells that hold several
components go through the tree, in blocks of bounded size, across components.

Equal sets are one node of the join, whatever their number, so exact copies cost nothing twice. Texts that pass
a task are whole; a task holds a slice of texts, or two blocks of ``BLOCK`` vectors.

Defined results: null or wordless texts have no shingles, link with nothing and are a component of their own;
with fewer words than ``k`` the whole sequence is the one shingle; rows that repeat are equal
sets and share a component; null ids are ignored when the smallest id is taken (null if there is no other);
empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, materialise, partitions
from tidemark.llm.components import components
from tidemark.llm.tokens import U, mix64, shingle_sets, slices

DIMS = 256
BLOCK, LEAF = 256, 16
RATIO = 1.6
HUB_ROWS = 512
FILTER_BITS = 1 << 26


def difference(n: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair whose smaller set has ``n`` elements."""
    return n * (100 - percent) // percent


def size_classes(largest: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(lower size, upper size exclusive, groups K, largest difference), ascending.

    ``K`` exceeds the difference by what may be empty: the expected number and six deviations.
    """
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo + 1, int(lo * RATIO))
        d = difference(hi - 1, percent)
        k = d + 1
        if d:
            for _ in range(6):
                empty = k * float(np.exp(-(hi - 1) / k))
                k = d + 2 + int(np.ceil(empty + 6 * np.sqrt(empty)))
        out.append((lo, hi, k, d))
        lo = hi
    return out


def set_hashes(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each set; 0 only for empty ones."""
    sums = np.zeros(len(sets) + 1, U)
    np.cumsum(mix64(sets), out=sums[1:])
    n = np.diff(offsets).astype(U)
    h = mix64(sums[offsets[1:]] - sums[offsets[:-1]] + mix64(n))
    h[h == 0] = 1
    h[n == 0] = 0
    return h


def cells(sets: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, document) of all cells of the documents of a slice."""
    n = np.diff(offsets)
    out_cell, out_doc = [], []
    if not len(n) or not n.max():
        return np.zeros(0, U), np.zeros(0, np.int64)
    least = -(-n * percent // 100)  # the smallest size that a partner can have
    for c, (lo, hi, k, d) in enumerate(size_classes(int(n.max()), percent)):
        docs = np.flatnonzero((n >= lo) & (least < hi))
        if not d or not len(docs):
            continue  # without a difference only equal sets link
        size = n[docs]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(offsets[docs] - first, size)
        x = sets[at]
        doc = np.repeat(np.arange(len(docs)), size)
        group = ((x >> U(22)) * U(k)) >> U(32)
        # within a document the elements ascend, and so do their groups
        start = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (doc[1:] != doc[:-1])]))
        content = np.add.reduceat(mix64(x), start)
        tag = mix64(group[start] + U((c + 1) << 40))
        out_cell.append(mix64(content ^ tag))
        out_doc.append(docs[doc[start]])
        empty = k - np.bincount(doc[start], minlength=len(docs))
        unlucky = np.flatnonzero(k - empty <= np.minimum(d, size * (100 - percent) // percent))
        for u in unlucky:
            head = x[first[u]: first[u] + size[u] - least[docs[u]] + 1]
            out_cell.append(mix64(mix64(head) ^ U((c + 1) << 32 | 7)))
            out_doc.append(np.full(len(head), docs[u]))
    if not out_cell:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(out_cell), np.concatenate(out_doc)


def count_vectors(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Point of each set: how many of its elements fall in each of ``DIMS`` groups. Of two bytes a count, or of four where a set is that large."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    group = (mix64(sets) >> U(56)).astype(np.int64)
    counts = np.bincount(doc * DIMS + group, minlength=(len(offsets) - 1) * DIMS).reshape(-1, DIMS)
    return counts.astype(np.uint32 if counts.size and counts.max() > np.iinfo(np.uint16).max else np.uint16)


def vectors_of(column: pa.Array) -> np.ndarray:
    """Points of a binary column, a row each; counts of two and of four bytes may stand together."""
    rows = column.to_pylist()
    narrow = 2 * DIMS
    if all(len(r) == narrow for r in rows):
        return np.frombuffer(b"".join(rows), np.uint16).reshape(-1, DIMS)
    return np.stack([np.frombuffer(r, np.uint16 if len(r) == narrow else np.uint32).astype(np.uint32) for r in rows])


def needed(n_a, n_b, percent: int):
    """Smallest intersection of a linked pair of these sizes: 100 i >= p (a + b - i)."""
    return -(-(percent * (n_a + n_b)) // (100 + percent))


class RTree:
    """Points packed into boxes of ``LEAF`` by size, then by their largest-spread coordinate."""

    def __init__(self, points: np.ndarray):
        n = points.sum(1, dtype=np.int64)  # a set's size
        spread = points[:, int(np.argmax(points.std(0)))] if len(points) else n
        strip = np.empty(len(n), np.int64)
        strip[np.argsort(n, kind="stable")] = np.arange(len(n)) // (LEAF * 4)
        self.order = np.lexsort((spread, strip))
        self.points, self.n = points[self.order], n[self.order]
        self.at = np.arange(0, len(n), LEAF)
        self.top = np.maximum.reduceat(self.points, self.at)
        self.least = np.minimum.reduceat(self.n, self.at)

    def pairs(self, other: RTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of pairs of points whose bound on the overlap allows a link."""
        bound = np.minimum(self.top[:, None, :], other.top[None, :, :]).sum(2, dtype=np.int64)
        left, right = np.nonzero(bound >= needed(self.least[:, None], other.least[None, :], percent))
        out_a, out_b = [], []
        for i, j in zip(left, right):
            a, b = slice(self.at[i], self.at[i] + LEAF), slice(other.at[j], other.at[j] + LEAF)
            bound = np.minimum(self.points[a][:, None, :], other.points[b][None, :, :]).sum(2, dtype=np.int64)
            x, y = np.nonzero(bound >= needed(self.n[a][:, None], other.n[b][None, :], percent))
            out_a.append(self.order[a][x])
            out_b.append(other.order[b][y])
        if not out_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_a), np.concatenate(out_b)


def _sets_of(batch: pa.RecordBatch, text: str, k: int):
    for first, raw, offsets in slices(batch.column(text)):
        sets, at = shingle_sets(raw, offsets, k)
        yield first, sets, at


def _placed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    row_id = F.col(doc_id).cast("long")
    return docs.select(row_id.alias("__id"), F.when(row_id.isNull(), F.xxhash64(text)).alias("__nameless"), F.col(text).alias("__t"))


def _nodes(docs: DataFrame, text: str, doc_id: str, k: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set) and two hashes of the text: ``nameless``, to find rows without an id
    by, and ``content``."""
    def run(batches):
        for batch in batches:
            n, h = [], []
            for _, sets, at in _sets_of(batch, "__t", k):
                n.append(np.diff(at))
                h.append(set_hashes(sets, at))
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            h = np.concatenate(h) if h else np.zeros(0, U)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(n, pa.int64()), pa.array(h.view(np.int64), pa.int64()), batch.column("__nameless"), batch.column("__content")],
                names=["doc_id", "n_shingles", "node", "nameless", "content"])

    return _placed(docs, text, doc_id).withColumn("__content", F.xxhash64("__t")).mapInArrow(
        lean(run), "doc_id bigint, n_shingles bigint, node bigint, nameless bigint, content bigint")


def _shared_cells(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(cell, node) of all cells with at least two nodes."""
    def emit(batches):
        for batch in batches:
            for _, sets, at in _sets_of(batch, text, k):
                node = set_hashes(sets, at)
                _, first = np.unique(node, return_index=True)  # copies within a slice count once
                n = np.diff(at)
                kept = np.zeros(len(n), bool)
                kept[first] = True
                small = np.concatenate([[0], np.cumsum(np.where(kept, n, 0))])
                cell, doc = cells(sets[np.repeat(kept, n)], small, percent)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(node[doc].view(np.int64))], names=["cell", "node"])

    def shared(batches):
        """Rows come sorted; only the group that a batch ends in is carried on."""
        cell = node = held = None  # held: the first row of a group, not given out so far
        for batch in batches:
            c, v = batch.column("cell").to_numpy(), batch.column("node").to_numpy()
            new = np.ones(len(c), bool)
            new[1:] = (c[1:] != c[:-1]) | (v[1:] != v[:-1])
            if len(c) and cell is not None:
                new[0] = c[0] != cell or v[0] != node
            c, v = c[new], v[new]
            if not len(c):
                continue
            start = np.ones(len(c), bool)
            start[1:] = c[1:] != c[:-1]
            start[0] = cell is None or c[0] != cell
            out = ~start
            out[:-1] |= ~start[1:]
            if held is not None and not start[0]:
                yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], names=["cell", "node"])
            cell, node = c[-1], v[-1]
            held = (int(cell), int(node)) if start[-1] else None
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[out]), pa.array(v[out])], names=["cell", "node"])

    schema = "cell bigint, node bigint"
    rows = docs.select(F.col(text)).mapInArrow(lean(emit), schema)
    return rows.repartition(partitions(docs.sparkSession), "cell").sortWithinPartitions("cell", "node").mapInArrow(lean(shared), schema)


def _maybe_in(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose key is not in ``keys``, so that their texts need no shuffle before
    the join. A key is one bit of a map of fixed size (``FILTER_BITS``), made by an aggregate over its
    words; with very many keys the map fills up and lets more rows pass, which the join then drops."""
    bit = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    words = keys.select(bit.alias("b")).select(
        F.expr("cast(b div 64 as int)").alias("at"), F.expr("shiftleft(1L, cast(b % 64 as int))").alias("w"))
    got = words.groupBy("at").agg(F.expr("bit_or(w)").alias("w")).toPandas()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[got["at"].to_numpy()] = got["w"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def known(b: pa.Array) -> pa.Array:
        b = b.to_numpy()
        return pa.array((shared.value[b // 64] >> (b % 64)) & 1 == 1)

    return rows.where(known(bit))


def _of_nodes(nodes: DataFrame, found: DataFrame, docs: DataFrame, text: str, doc_id: str, k: int, what: str) -> DataFrame:
    """node, n and ``what`` of every node of ``nodes``: its count vector (``vec``) or its whole ``set``. Sets are large, so
    they are made, from the texts again, only for documents whose vectors allow a link."""
    first = found.groupBy("node").agg(F.min("doc_id").alias("id"), F.min("nameless").alias("other"))
    chosen = nodes.join(first, "node").select("node", F.col("id").isNull().alias("__none"), F.coalesce("id", "other").alias("__key"))
    chosen = materialise(chosen, "jaccard_chosen")
    placed = _placed(docs, text, doc_id).select(F.col("__id").isNull().alias("__none"), F.coalesce("__id", "__nameless").alias("__key"), "__t")
    rows = _maybe_in(placed, chosen, ["__none", "__key"]).join(chosen, ["__none", "__key"]).select("node", "__t")

    def run(batches):
        seen: set[int] = set()  # rows that repeat give one set in a task; more than one in all does no harm
        for batch in batches:
            for first, sets, at in _sets_of(batch, "__t", k):
                v = count_vectors(sets, at) if what == "vec" else None
                node = batch.column("node").to_numpy()[first: first + len(at) - 1]
                same = set_hashes(sets, at).view(np.int64) == node  # ids can repeat with other texts
                pick = [i for i in np.flatnonzero(same) if not (int(node[i]) in seen or seen.add(int(node[i])))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(node[pick]), pa.array(np.diff(at)[pick]),
                    pa.array([(v[i] if what == "vec" else sets[at[i]: at[i + 1]]).tobytes() for i in pick], pa.binary())], names=["node", "n", what])

    return rows.mapInArrow(lean(run), f"node bigint, n bigint, {what} binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. The sets of all ``b`` of an ``a`` stream past the set of ``a``;
    an ``a`` with many partners is split into parts, each with a copy of its set."""
    keyed = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("parts"))
    split = materialise(
        pairs.join(keyed, "a").select("a", "b", "parts", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")), "pairs")
    heads = keyed.join(sets.select(F.col("node").alias("a"), "set"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "set")
    members = split.drop("parts").join(sets.select(F.col("node").alias("b"), "set"), "b").select("a", "part", "b", "set")

    def run(batches):
        key = head = None
        for batch in batches:
            out_a, out_b = [], []
            a, part, b, s = (batch.column(c) for c in ("a", "part", "b", "set"))
            a, part = a.to_numpy(), part.to_numpy()
            for i in range(batch.num_rows):
                x = np.frombuffer(s[i].as_py(), U)
                if not b[i].is_valid:
                    key, head = (a[i], part[i]), x
                    continue
                if key != (a[i], part[i]):
                    raise ValueError("a pair came without the set of its first document")
                both = len(np.intersect1d(head, x, assume_unique=True))
                if 100 * both >= percent * (len(head) + len(x) - both):
                    out_a.append(a[i])
                    out_b.append(b[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    rows = heads.union(members).repartition(partitions(pairs.sparkSession), "a", "part")
    return rows.sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).mapInArrow(lean(run), "a bigint, b bigint")


def _leaf_pairs(v: np.ndarray, n: np.ndarray, root: np.ndarray, group: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group and different components whose bound allows a link, for many groups of at most
    one leaf at once."""
    out_a, out_b = [], []
    for lag in range(1, LEAF):
        a = np.flatnonzero(group[lag:] == group[:-lag])
        if not len(a):
            break
        b = a + lag
        fits = (root[a] != root[b]) & (np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent)
        a, b = a[fits], b[fits]
        for k in range(0, len(a), 4096):
            x, y = a[k: k + 4096], b[k: k + 4096]
            ok = np.minimum(v[x], v[y]).sum(1, dtype=np.int64) >= needed(n[x], n[y], percent)
            out_a.append(x[ok])
            out_b.append(y[ok])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _tree_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, root_a, b, root_b) of different components in one cell whose bound allows a link.
    ``mixed``: cell, node, root, vec, block, blocks (of about ``BLOCK`` rows)."""
    schema = "a bigint, root_a bigint, b bigint, root_b bigint"

    def pairs_of(t: pa.Table):
        t = t.combine_chunks()
        node, root, block = (t.column(c).to_numpy() for c in ("node", "root", "block"))
        cell, i, j = (t.column(c).to_numpy() for c in ("cell", "i", "j"))
        v = vectors_of(t.column("vec"))
        n = v.sum(1, dtype=np.int64)
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        size = np.diff(np.append(at, len(cell)))
        small = (size <= LEAF) & (i[at] == j[at])  # one leaf is the whole tree
        rows = np.flatnonzero(small[group])
        x, y = _leaf_pairs(v[rows], n[rows], root[rows], group[rows], percent)
        found = [(rows[x], rows[y])]
        for g in np.flatnonzero(~small):
            own = np.arange(at[g], at[g] + size[g])
            first, second = own[block[own] == i[at[g]]], own[block[own] == j[at[g]]]
            if len(first) and len(second):
                x, y = RTree(v[first]).pairs(RTree(v[second]), percent)
                x, y = first[x], second[y]
                apart = root[x] != root[y]
                found.append((x[apart], y[apart]))
        x, y = (np.concatenate(z) for z in zip(*found))
        swap = node[x] > node[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        pairs = np.unique(np.stack([node[x], root[x], node[y], root[y]]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], names=[c.split()[0] for c in schema.split(", ")])

    def run(batches):
        """Rows come sorted by group; the group that a batch ends in waits for the next one."""
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if not t.num_rows:
                continue
            cell, i, j = (t.column(c).to_numpy() for c in ("cell", "i", "j"))
            other = np.flatnonzero((cell != cell[-1]) | (i != i[-1]) | (j != j[-1]))
            whole = int(other[-1]) + 1 if len(other) else 0
            if whole:
                yield pairs_of(t.slice(0, whole))
            rest = t.slice(whole)
        if rest is not None and rest.num_rows:
            yield pairs_of(rest)

    # a block meets itself and every other block of its cell once
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = mixed.select("cell", "node", "root", "vec", "block", F.explode(others).alias("o")).select(
        "cell", "node", "root", "vec", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    placed = rows.repartition(partitions(mixed.sparkSession), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return placed.mapInArrow(lean(run), schema).distinct()


def near_groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links; one row per input row."""
    keyed = _keyed(docs, text, doc_id, k, percent)
    # equal sets share a node, linked ones a root; documents without shingles stand alone
    least = materialise(keyed.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
                        .where("rows > 1").drop("rows"), "jaccard_components")
    return keyed.join(least, (keyed["key"] == least["key"]) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _keyed(docs: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, content (hash of the text), key (of the component); one row per input row."""
    found = materialise(_nodes(docs, text, doc_id, k), "jaccard_nodes")
    shared = materialise(_shared_cells(docs, text, k, percent), "jaccard_cells")
    vectors = materialise(_of_nodes(shared.select("node").distinct(), found, docs, text, doc_id, k, "vec"), "jaccard_vectors")

    def verified(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = materialise(_of_nodes(nodes, found, docs, text, doc_id, k, "set"), "jaccard_sets")
        return materialise(_verified(pairs, sets, percent), "jaccard_verified")

    # verify each node against the member of each of its cells that shares most with others
    sizes = shared.groupBy("cell").agg(F.count("*").alias("members"))
    weight = materialise(shared.join(sizes, "cell").groupBy("node").agg(F.sum("members").alias("weight")), "jaccard_weight")
    hubs = shared.join(weight, "node").groupBy("cell").agg(F.max(F.struct("weight", "node")).alias("top")).select("cell", F.col("top.node").alias("a"))
    to_hub = shared.join(hubs, "cell").where("a != node").select("a", F.col("node").alias("b")).distinct()
    tried = materialise(_fitting(to_hub, vectors, percent), "jaccard_hub_pairs")
    links = verified(tried)
    roots = components(links)

    # cells with several components left: through the tree
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")) \
        .where("lo != hi").select("cell", "members")
    mixed = rooted.join(materialise(several, "jaccard_mixed"), "cell").join(vectors.select("node", "n", "vec"), "node")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    blocked = mixed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialise(_tree_pairs(blocked.select("cell", "node", "root", "vec", "block", "blocks"), percent)
                       .join(done, ["a", "b"], "left_anti"), "jaccard_tree_pairs")
    # one pair for every two components first, as a link joins them; then what is left
    for once in (True, False):
        if rest.isEmpty():
            break
        next_pairs = rest.groupBy("root_a", "root_b").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b") if once else rest.select("a", "b")
        links = links.union(verified(next_pairs.distinct()))
        roots = components(links)
        if once:
            old = [f"root_{x}" for x in "ab"]
            for x in "ab":
                rest = rest.drop(f"root_{x}").join(roots.select(F.col("node").alias("__n"), F.col("root").alias("__r")), F.col(x) == F.col("__n"), "left") \
                    .withColumn(f"root_{x}", F.coalesce("__r", x)).drop("__n", "__r")
            rest = materialise(rest.where("root_a != root_b").select("a", "b", *old)
                               .join(next_pairs, ["a", "b"], "left_anti"), "jaccard_rest_pairs")

    return found.join(roots, "node", "left").select("doc_id", "n_shingles", "content", F.coalesce("root", "node").alias("key"))


def _fitting(pairs: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and count vectors allow a link; their sets need not move otherwise."""
    both = pairs.join(vectors.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("vec").alias("v_a")), "a") \
        .join(vectors.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("vec").alias("v_b")), "b")
    sized = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                x, y = (vectors_of(part.column(c)) for c in ("v_a", "v_b"))
                n = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
                ok = pa.array(np.minimum(x, y).sum(1, dtype=np.int64) >= needed(n, 0, percent))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    return sized.select("a", "b", "n_a", "n_b", "v_a", "v_b").mapInArrow(lean(run), "a bigint, b bigint")


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80, nameless: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the least by (id, hash of the text), and one of rows that share both.

    Rows are removed by id and text together, so another text under the same id stays. Rows without an id stay,
    unless ``nameless``: then they count as the last ids. Rows without shingles stay."""
    keyed = _keyed(docs, text, doc_id, k, percent).where("n_shingles > 0")
    if not nameless:
        keyed = keyed.where("doc_id is not null")
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "content")
    # one row for each id and text, so copies are combined on the map side
    rows = materialise(keyed.groupBy("key", row.alias("row")).agg(F.count("*").alias("n")), "jaccard_rows")
    least = rows.groupBy("key").agg(F.min("row").alias("least"), F.sum("n").alias("members")).where("members > 1").drop("members")
    found = rows.join(materialise(least, "jaccard_least"), "key")
    gone = materialise(found.where("row != least or n > 1").select(
        F.col("row.none").alias("__none"), F.col("row.id").alias("__id"), F.col("row.content").alias("__content"),
        (F.col("row") == F.col("least")).alias("__again")).distinct(), "jaccard_gone")
    place = F.col(doc_id).cast("long")
    named = docs.withColumns({"__none": place.isNull(), "__id": F.coalesce(place, F.lit(0)), "__content": F.xxhash64(text)})
    by = ["__none", "__id", "__content"]
    kept = named.join(gone.select(*by), by, "left_anti")
    again = gone.where("__again").select(*by)
    if not again.isEmpty():
        kept = kept.unionByName(named.join(again, by, "left_semi").dropDuplicates(by))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
