"""Operator 13, audit of how far the sources of a language differ, by single-pass in-memory indexing.

1. *Blocks.* A task reads its texts once. The postings of a block (term, source, occurrences, documents) are gathered until they fill
   ``BLOCK_TERMS`` entries; then the block is spilled as a run: its terms, in the order (language, term), dealt to hash shards and cut into
   chunks of at most ``CHUNK`` terms.
2. *Merge.* A shard's chunks arrive ordered by their first term. A heap holds the next term of each open chunk; a chunk is opened
   only when the heap has come to its first term, so about one chunk of each run is open. Equal terms meet at the top of the
   heap, their counts are added, and only terms in enough documents of the language leave the shard.
3. *Corrections.* With N and V known, a term that a source lacks has one fixed share there. The sum over all kept terms of a pair of sources is
   therefore V times the value of the two fixed shares, plus corrections: for the terms that only one side
   needs, from the histogram of that side's shares; for the terms that both sides hold, streamed term by term into tiles of
   sums, of which a task keeps a bounded number. No list of pairs of a term leaves a task.

Shares and sums are integers: ``1 + floor(SCALE * (count + 2) / (N + 2 V))`` by long division in three steps, which stays
within 64 bits up to counts of 9e15.

Defined results: null text, language or source count as ''; every occurring (language, source) is a group, also without any term; with
no kept term every pair has the value 0 and there are no term rows; rows that repeat are documents of their own; an empty table
gives no rows; extra columns do not pass. A term's list of sources and the pairs of a language are taken to fit one task's
tiles in turn; the result itself holds a row for each pair.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, partitions
from tidemark.llm.runs import LOWER, byte_class, runs, strings
from tidemark.llm.tokens import range_hashes, slices

SCALE = 1_000_000_000
BLOCK_TERMS = 2_000_000
CHUNK = 256
TILE, TILES = 256, 128
#: letters of ASCII and every character beyond it
TERM = byte_class([*range(65, 91), *range(97, 123)])


class Block:
    """Postings gathered from slices of texts until they are spilled."""

    def __init__(self):
        self.terms: list[pa.Array] = []
        self.postings: list[tuple[np.ndarray, ...]] = []  # number of the term in its slice, group, occurrences, documents
        self.size = 0

    def add(self, raw: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """``group`` is the (language, source) number of each text."""
        raw = LOWER[raw]
        content = TERM[raw]
        starts, ends, doc = runs(raw, offsets, content)
        if not len(starts):
            return
        words = strings(raw, content, starts, ends).dictionary_encode()
        n = len(words.dictionary)
        in_doc, tf = np.unique(doc * n + words.indices.to_numpy(), return_counts=True)
        key, back = np.unique(group[in_doc // n] * n + in_doc % n, return_inverse=True)
        self.terms.append(words.dictionary)
        self.postings.append((key % n, key // n, np.bincount(back, tf).astype(np.int64), np.bincount(back)))
        self.size += len(key)

    def run(self, lang_of: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms in order, then language, term, group, occurrences and documents of the postings in the order (language, term, group)."""
        first = np.cumsum([0] + [len(t) for t in self.terms])
        terms = pa.concat_arrays(self.terms).dictionary_encode()
        in_order = pc.sort_indices(terms.dictionary).to_numpy()
        rank = np.empty(len(in_order), np.int64)
        rank[in_order] = np.arange(len(in_order))
        rank = rank[terms.indices.to_numpy()]
        term, group, n, docs = (np.concatenate(x) for x in zip(*[(rank[t + at], *rest) for at, (t, *rest) in zip(first, self.postings)]))
        self.terms, self.postings, self.size = [], [], 0
        groups = int(group.max()) + 1
        key = (lang_of[group] * len(in_order) + term) * groups + group
        key, back = np.unique(key, return_inverse=True)
        n, docs = np.bincount(back, n).astype(np.int64), np.bincount(back, docs).astype(np.int64)
        term = key // groups
        return terms.dictionary.take(pa.array(in_order)), term // len(in_order), term % len(in_order), key % groups, n, docs


#: a chunk of a run: its place; each term's number of documents and of sources; for the sources one after another, their place in
#: ``names`` and the occurrences
RUN = ("shard int, lang string, first string, terms array<string>, docs array<bigint>, sizes array<int>, names array<string>, "
       "sources array<int>, counts array<bigint>")


def _lists(column: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(column)).astype(np.int32)), column)


def _spilled(block: Block, langs: list[str], groups: list[tuple[str, str]], shards: int):
    """The block's run in chunks, as batches of ``RUN``."""
    lang_number = {k: i for i, k in enumerate(langs)}
    names, lang, term, group, n, docs = block.run(np.array([lang_number[k] for k, _ in groups]))
    sources = sorted({s for _, s in groups})
    source_number = {s: i for i, s in enumerate(sources)}
    source = np.array([source_number[s] for _, s in groups], np.int32)[group]
    starts = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])]))
    sizes = np.diff(np.append(starts, len(term)))
    documents = np.add.reduceat(docs, starts)
    term, lang = term[starts], lang[starts]
    _, at, data = names.buffers()  # shard by a hash of the term's bytes alone, the same in every task
    at = np.frombuffer(at, np.int64)[names.offset: names.offset + len(names) + 1]
    shard = (range_hashes(np.frombuffer(data, np.uint8), at[:-1], at[1:]) % np.uint64(shards)).astype(np.int64)[term]
    order = np.lexsort((term, lang, shard))
    change = np.flatnonzero(np.concatenate([[True], (np.diff(shard[order]) != 0) | (np.diff(lang[order]) != 0)]))
    cuts = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(change, np.append(change[1:], len(order)))])
    for k in range(0, len(cuts), 256):
        part = cuts[k: k + 256]
        here = order[part[0]: cuts[k + 256] if k + 256 < len(cuts) else len(order)]
        inside, head = part - part[0], order[part]
        held = np.repeat(starts[here] - np.concatenate([[0], np.cumsum(sizes[here])[:-1]]), sizes[here]) + np.arange(sizes[here].sum())
        postings = np.concatenate([[0], np.cumsum(sizes[here])])[inside]
        # only the sources that a chunk has are named there
        chunk = np.searchsorted(postings, np.arange(len(held)), "right") - 1
        used, number = np.unique(chunk * len(sources) + source[held], return_inverse=True)
        named = np.searchsorted(used // len(sources), np.arange(len(part)))
        yield pa.RecordBatch.from_arrays([
            pa.array(shard[head].astype(np.int32)), pa.array([langs[i] for i in lang[head]]), names.take(pa.array(term[head])).cast(pa.string()),
            _lists(names.take(pa.array(term[here])).cast(pa.string()), inside), _lists(pa.array(documents[here]), inside),
            _lists(pa.array(sizes[here].astype(np.int32)), inside), _lists(pa.array(sources).take(pa.array(used % len(sources))), named),
            _lists(pa.array((number - named[chunk]).astype(np.int32)), postings), _lists(pa.array(n[held]), postings)],
            ["shard", "lang", "first", "terms", "docs", "sizes", "names", "sources", "counts"])


class Chunk:
    """A chunk as the merge reads it."""

    def __init__(self, lang: str, terms: list[str], docs: list[int], sizes: list[int], names: list[str], sources: list[int], counts: list[int]):
        self.lang, self.terms, self.docs, self.names, self.sources, self.counts = lang, terms, docs, names, sources, counts
        self.at = [0, *itertools.accumulate(sizes)]


def chunks_of(batches):
    """(shard, language) and chunk of every row."""
    lists = ["terms", "docs", "sizes", "names", "sources", "counts"]
    for batch in batches:
        shards, langs = batch.column("shard").to_pylist(), batch.column("lang").to_pylist()
        for k in range(batch.num_rows):
            values = [batch.column(c)[k].values for c in lists]
            yield (shards[k], langs[k]), Chunk(langs[k], *[v.to_pylist() if pa.types.is_string(v.type) else v.to_numpy().tolist() for v in values])


def merge_runs(chunks, min_docs: int):
    """(term, {source: count}) of the terms in ``min_docs`` documents, in order, from one language's chunks ordered by their first term.

    The heap holds the next term of each open chunk; a chunk is opened before anything behind its first term is given. Code points
    order strings as their bytes do in the runs and in Spark."""
    chunks = iter(chunks)
    following = next(chunks, None)
    heap: list[tuple] = []
    opened = 0
    while heap or following is not None:
        if not heap or (following is not None and following.terms[0] <= heap[0][0]):
            heapq.heappush(heap, (following.terms[0], opened, 0, following))
            opened += 1
            following = next(chunks, None)
            continue
        term, docs, postings = heap[0][0], 0, []
        # a chunk that begins with this very term belongs to it
        while True:
            while following is not None and following.terms[0] == term:
                heapq.heappush(heap, (term, opened, 0, following))
                opened += 1
                following = next(chunks, None)
            if not heap or heap[0][0] != term:
                break
            _, number, k, chunk = heap[0]
            docs += chunk.docs[k]
            postings.append((chunk, k))
            if k + 1 < len(chunk.terms):
                heapq.heapreplace(heap, (chunk.terms[k + 1], number, k + 1, chunk))
            else:
                heapq.heappop(heap)
        if docs >= min_docs:
            counts: dict[str, int] = {}
            for chunk, k in postings:
                for x in range(chunk.at[k], chunk.at[k + 1]):
                    name = chunk.names[chunk.sources[x]]
                    counts[name] = counts.get(name, 0) + chunk.counts[x]
            yield term, counts


def frequencies(docs: DataFrame, *, text: str, lang: str, source: str, min_docs: int, shards: int) -> DataFrame:
    """lang, term, entries (source and count of each source that holds the term) of terms in ``min_docs`` documents of the language."""
    base = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))])

    def spill(batches):
        block = Block()
        groups: dict[tuple[str, str], int] = {}

        def out():
            if block.size:
                yield from _spilled(block, list(dict.fromkeys(k for k, _ in groups)), list(groups), shards)
            groups.clear()

        for batch in batches:
            both = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            for first, raw, offsets in slices(batch.column("text")):
                here = both[first: first + len(offsets) - 1]
                block.add(raw, offsets, np.array([groups.setdefault(b, len(groups)) for b in here], np.int64))
                if block.size >= BLOCK_TERMS:
                    yield from out()
        yield from out()

    dealt = base.mapInArrow(spill, RUN).repartition("shard").sortWithinPartitions("shard", "lang", "first")

    def merge(batches):
        rows = []
        for (_, lang), chunks in itertools.groupby(chunks_of(batches), key=lambda c: c[0]):
            for term, counts in merge_runs((c for _, c in chunks), min_docs):
                rows.append((lang, term, counts))
                if len(rows) >= 4096:
                    yield _frequency_batch(rows)
                    rows = []
        if rows:
            yield _frequency_batch(rows)

    return materialise(dealt.mapInArrow(merge, "lang string, term string, entries array<struct<source string, count bigint>>"), "term_frequencies")


def _frequency_batch(rows: list[tuple[str, str, dict[str, int]]]) -> pa.RecordBatch:
    entries = pa.StructArray.from_arrays(
        [pa.array([s for _, _, c in rows for s in c], pa.string()), pa.array([n for _, _, c in rows for n in c.values()], pa.int64())], ["source", "count"])
    starts = np.concatenate([[0], np.cumsum([len(c) for _, _, c in rows])[:-1]])
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), _lists(entries, starts)], ["lang", "term", "entries"])


def share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * count / whole) for 0 <= count <= whole, by long division with base 1,000 (three digits)."""
    out, rest = F.lit(0).cast("long"), count.cast("long")
    for _ in range(3):
        step = rest * 1000
        out = out * 1000 + _div(step, whole)
        rest = step % whole
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def value(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q))."""
    return _div((p - q) * (p - q), p + q)


def _np_value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Tiles:
    """Sums for pairs of sources of a language, in square tiles; at most ``TILES`` are held."""

    def __init__(self):
        self.numbers: dict[tuple[str, str], int] = {}
        self.names: dict[str, list[str]] = {}
        self.tiles: dict[tuple[str, int, int], np.ndarray] = {}

    def add(self, lang: str, sources: list[str], p: np.ndarray, fixed: np.ndarray):
        """Corrections of one term that all ``sources`` hold; gives what has to leave to stay bounded."""
        names = self.names.setdefault(lang, [])
        at = np.empty(len(sources), np.int64)
        for k, s in enumerate(sources):
            number = self.numbers.setdefault((lang, s), len(names))
            if number == len(names):
                names.append(s)
            at[k] = number
        order = np.argsort(at)
        at, p, fixed = at[order], p[order], fixed[order]
        cuts = np.append(np.searchsorted(at, np.arange(0, at[-1] + 1, TILE)), len(at))
        spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        for i, a, b in spans:
            x, x0 = p[a:b, None], fixed[a:b, None]
            for j, c, d in spans:
                if j < i:
                    continue
                y, y0 = p[None, c:d], fixed[None, c:d]
                tile = self.tiles.get((lang, i, j))
                if tile is None:
                    if len(self.tiles) >= TILES:
                        yield from self.out()
                    tile = self.tiles[lang, i, j] = np.zeros((TILE, TILE), np.int64)
                tile[(at[a:b] - i * TILE)[:, None], (at[c:d] - j * TILE)[None, :]] += (
                    _np_value(x, y) - _np_value(x, y0) - _np_value(x0, y) + _np_value(x0, y0))

    def out(self):
        """Sums gathered so far, one row a pair."""
        for (lang, i, j), tile in self.tiles.items():
            a, b = np.nonzero(np.triu(tile, 1) if i == j else tile)  # each pair in one order
            names = self.names[lang]
            left, right = [names[k] for k in a + i * TILE], [names[k] for k in b + j * TILE]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(tile[a, b], pa.int64())],
                ["lang", "a", "b", "both"])
        self.tiles.clear()


def source_divergence(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10,
                      top: int = 10, shards: int | None = None) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank; see above."""
    shards = shards or 8 * partitions(docs.sparkSession)
    kept = frequencies(docs, text=text, lang=lang, source=source, min_docs=min_docs, shards=shards)
    groups = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"),
                         F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source")).groupBy("lang", "source").agg(F.count("*").alias("rows"))
    entry = kept.select("lang", "term", F.explode("entries").alias("e")).select("lang", "term", "e.source", F.col("e.count").alias("n"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.aggregate("entries", F.lit(0).cast("long"), lambda s, e: s + e["count"])).alias("lang_n"))
    held = entry.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    whole = F.col("group_n") + 2 * F.col("v")
    totals = materialise(
        groups.select("lang", "source").join(terms, "lang", "left").join(held, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"), F.coalesce("group_n", F.lit(0)).alias("group_n"))
        .withColumn("fixed", F.when(F.col("v") > 0, share(F.lit(2).cast("long"), whole)).otherwise(1)), "source_totals")
    shares = materialise(
        kept.select("lang", "term", F.aggregate("entries", F.lit(0).cast("long"), lambda s, e: s + e["count"]).alias("all_n"), F.explode("entries").alias("e"))
        .select("lang", "term", "all_n", F.col("e.source").alias("source"), F.col("e.count").alias("n"))
        .join(totals, ["lang", "source"])
        .select("lang", "source", "term", share(F.col("n") + 2, whole).alias("p"),
                share(F.col("all_n") + 2, F.col("lang_n") + 2 * F.col("v")).alias("q"), "fixed"), "source_shares")

    def ranked(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return df.withColumn("rank", F.row_number().over(order).cast("int"))

    # the window keeps the first rows of a group in each task before the shuffle
    by_term = ranked(shares.where("p > q").select("lang", "source", F.col("term").alias("item"), value(F.col("p"), F.col("q")).alias("value"))) \
        .where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    both = _both(shares)
    mirrored = both.union(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both")).groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))
    one = totals.select("lang", F.col("source").alias("a"), F.col("fixed").alias("a0"), "v")
    two = totals.select("lang", F.col("source").alias("b"), F.col("fixed").alias("b0"))
    histogram = shares.groupBy("lang", F.col("source").alias("a"), "p", F.col("fixed").alias("a0")).agg(F.count("*").alias("times"))
    single = histogram.join(two, "lang").where("a != b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("times") * (value(F.col("p"), F.col("b0")) - value(F.col("a0"), F.col("b0")))).alias("single"))
    other = single.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("single").alias("other"))
    pairs = (
        one.join(two, "lang").where("a != b").join(single, ["lang", "a", "b"], "left").join(other, ["lang", "a", "b"], "left").join(mirrored, ["lang", "a", "b"], "left")
        .select("lang", F.col("a").alias("source"), F.col("b").alias("item"),
                (F.col("v") * value(F.col("a0"), F.col("b0")) + F.coalesce("single", F.lit(0)) + F.coalesce("other", F.lit(0)) + F.coalesce("both", F.lit(0))).alias("value")))
    by_pair = ranked(pairs).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return by_pair.unionByName(by_term)


def _both(shares: DataFrame) -> DataFrame:
    """lang, a, b, both: sums of the corrections for terms that two sources hold, each pair in one order and partial for each task."""
    listed = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "fixed")).alias("entries")).where(F.size("entries") > 1)

    def stream(batches):
        tiles = Tiles()
        for batch in batches:
            entries = batch.column("entries")
            flat, at = entries.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(entries).to_numpy())])
            sources = flat.field("source").to_pylist()
            p, fixed = flat.field("p").to_numpy(), flat.field("fixed").to_numpy()
            for lang, a, b in zip(batch.column("lang").to_pylist(), at[:-1], at[1:]):
                yield from tiles.add(lang, sources[a:b], p[a:b], fixed[a:b])
        yield from tiles.out()

    # partial sums of the tasks, one order of each pair; sources are numbered as they come, so both orders may occur
    return listed.mapInArrow(stream, "lang string, a string, b string, both bigint")
