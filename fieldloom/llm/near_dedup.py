"""MinHash near-dedup by an inverted join on signature coordinates.

Method: documents with equal shingle sets form one class first (a 128-bit hash of the sorted
set), so copies never meet in a join. Each class has a signature of ``COORDINATES`` minima. The
pair (coordinate, value) is a token; two sets at the similarity asked for agree in at least
``matches(percent)`` coordinates but for a chance below 5e-5 at that similarity itself, and less
above it (42 of 64 at 0.85, 38 at 0.8). A pair with that many matches must share a token among the
``COORDINATES - matches(percent) + 1`` tokens of either that come first in a common order, so only this prefix is posted. The order is by
falling rarity: tokens of passages that a third of all documents share fall out of the
prefixes of documents that merely contain the passage. The frequent tokens are counted exactly
and are at most 2^18 by construction (a floor on their share), which bounds what is broadcast.

Long lists first lose what a few comparisons settle: in each round every long list names a hub (its
most central class outside the list's largest component: the one whose tokens most classes hold, so the
text that copies were made from rather than one of the copies, which are often similar to it alone), its members are held against the
hub, each class is linked to at most one hub, and confirmed links are contracted. So of a large group of near copies one
pair a class and round is written, and the group is one component after a round or two. Then the lists
that still hold several components are merged in cells of at most about ``BLOCK`` x ``BLOCK``
documents, so a long list is many tasks, none of them large; members of a list's largest component meet
only the others. A cell counts collisions of whole signatures with numpy, skips pairs
within a component and each pair that an earlier common prefix token has already taken, and keeps the
pairs with enough matches and compatible sizes: every pair between components that could be a link is
tried. Kept pairs travel as bundles of id arrays, meet the full sets once per bundle and
are confirmed exactly; a bundle reports a spanning forest of its links, not all of them.
Components of the links (``components``) give the answer.

Results in odd cases: a null text or one without words has no shingles and is linked with nothing;
with fewer words than ``width`` the whole sequence is the one shingle; exact copies share a
component; ids are expected to be unique (a repeated row is a copy of itself); an empty table
gives no rows; extra columns are not read; a document of any length is taken whole. ``near_duplicates``
links rows with a null id by their class only; ``one_of_each`` tells them apart by their text, so of
near copies one stays whatever the ids: the smallest id, or a row without one where none has an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.components import components
from fieldloom.llm.shared import cut, map_arrow, parted, read
from fieldloom.llm.words import BETWEEN_SPACE, FOLDED, U, chunks, rolling

COORDINATES, WIDTH = 64, 5
#: The chance at most that a pair at exactly the similarity asked for has too few matches.
MISSED = 5e-5
#: Documents of a posting list in one block; pairs compared at once; documents and pairs of a bundle.
BLOCK, AT_ONCE, BUNDLE_NODES, BUNDLE_PAIRS = 512, 1 << 15, 2048, 1 << 16
#: Lists with more members outside their largest component are long; rounds of hubs at most.
LONG_LIST, HUB_ROUNDS = 128, 2
#: At most so many tokens count as frequent.
FREQUENT = 1 << 18

_FACTORS = np.random.default_rng(404).integers(1, 2**63, COORDINATES, dtype=np.int64).astype(U) | U(1)


def matches(percent: int) -> int:
    """The most coordinates in which sets of that similarity agree but for a chance of ``MISSED``."""
    p, below, m = percent / 100, 0.0, 0
    while m < COORDINATES and (below := below + comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)) <= MISSED:
        m += 1
    return m


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, words, _ in chunks(texts, BETWEEN_SPACE, FOLDED):
        runs = rolling(words.hashes, width)
        for p, q in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            yield np.unique(runs[p : q - width + 1] if q - p >= width else rolling(words.hashes[p:q], q - p) if q > p else runs[:0])


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate's permutation (multiplication by an odd number), upper half."""
    low = np.full(COORDINATES, 2**64 - 1, U)
    for at in range(0, len(shingles), 4096):
        np.minimum(low, np.multiply.outer(_FACTORS, shingles[at : at + 4096]).min(axis=1), out=low)
    return (low >> U(32)).astype(np.uint32)


def _summaries(docs: DataFrame, doc: str, text: str, width: int) -> DataFrame:
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, signatures = [], [], []
        for s in shingle_sets(batch.column(1), width):
            sizes.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signatures.append(signature(s).tobytes() if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
            names=["doc", "n_shingles", "key", "signature"],
        )

    return map_arrow(docs.select(F.col(doc).cast("long").alias("doc"), F.col(text)), each, "doc long, n_shingles long, key binary, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _tokens(signatures: np.ndarray) -> np.ndarray:
    return (np.arange(COORDINATES, dtype=np.int64) << 32) | signatures.astype(np.int64)


def _frequent(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tokens whose count is at least a 2^18th of all, in order, and their counts."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, n = np.unique(_tokens(_matrix(batch.column(0))), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["token", "n"])

    floor = max(8, classes.count() * COORDINATES // FREQUENT)
    counts = map_arrow(classes.select("signature"), each, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= floor).toPandas().sort_values("token")
    return found["token"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _with_prefixes(classes: DataFrame, tokens: np.ndarray, counts: np.ndarray, percent: int) -> DataFrame:
    """``classes`` with their prefix: its tokens, and a bit for each of its coordinates; ``central``
    grows with the number of classes that hold a class's tokens, by their logarithms: a passage that
    very many hold counts little more than a group's own text."""
    spark = classes.sparkSession
    length = COORDINATES - matches(percent) + 1
    held = spark.sparkContext.broadcast((tokens, counts))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, n = held.value
        own = _tokens(_matrix(batch.column(3)))
        seen = np.zeros(own.shape, np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            seen = np.where(known[at] == own, n[at], 0)
        first = np.argsort(seen, axis=1, kind="stable")[:, :length]  # ties: the smaller coordinate
        bits = np.bitwise_or.reduce(U(1) << first.astype(U), axis=1).view(np.int64)
        central = np.log1p(seen).sum(axis=1)
        prefix = pa.ListArray.from_arrays(np.arange(0, own.shape[0] * length + 1, length, dtype=np.int32), np.take_along_axis(own, first, 1).ravel())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits), pa.array(central), prefix], names=["node", "key", "n_shingles", "signature", "bits", "central", "prefix"])

    return map_arrow(
        classes.select("node", "key", "n_shingles", "signature"), each,
        "node long, key binary, n_shingles long, signature binary, bits long, central double, prefix array<long>",
    )


def _lists(postings: DataFrame) -> DataFrame:
    """(token, n) of the lists of two classes or more."""
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _divided(rows: DataFrame) -> DataFrame:
    """(token, major, n_major, n_minor) of the lists that hold several components: ``major`` is the
    largest one."""
    by_comp = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
    found = by_comp.groupBy("token").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("n"))
    return found.select("token", F.col("most.comp").alias("major"), F.col("most.n").alias("n_major"), (F.col("n") - F.col("most.n")).alias("n_minor")).where("n_minor > 0")


def _minor() -> Column:
    return F.col("comp") != F.col("major")


def _placed(rows: DataFrame) -> DataFrame:
    """(token, node, block, last): classes outside their list's largest component meet all blocks,
    those within it meet the blocks of the others, which are the first."""
    minor_blocks, major_blocks = F.ceil(F.col("n_minor") / BLOCK).cast("int"), F.ceil(F.col("n_major") / BLOCK).cast("int")
    h = F.xxhash64("node")
    block = F.when(_minor(), F.pmod(h, minor_blocks)).otherwise(minor_blocks + F.pmod(h, F.greatest(major_blocks, F.lit(1)))).cast("int")
    last = F.when(_minor(), minor_blocks + major_blocks).otherwise(minor_blocks) - 1
    return rows.select("token", "node", block.alias("block"), last.alias("last"))


def _cells(classes: DataFrame, placed: DataFrame) -> DataFrame:
    """A row for each class in each cell of each list."""
    met = placed.select("token", "node", "block", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    cells = met.select("token", F.least("block", "other").alias("c1"), F.greatest("block", "other").alias("c2"), "node", "block")
    return cells.join(classes.select("node", "comp", "n_shingles", "bits", "signature"), "node")


def _labels(links: DataFrame) -> DataFrame:
    """(node, comp): a label for each linked class; classes of one label are connected. Each points
    at itself or the neighbour that has more links, by hash among equal ones, then at where that
    points, twice: enough for hubs."""
    both = links.where("a <> b").select(F.col("a").alias("node"), F.col("b").alias("comp"))
    both = both.unionByName(both.select(F.col("comp").alias("node"), F.col("node").alias("comp")))
    links_of = cut(both.groupBy("node").agg(F.count(F.lit(1)).alias("n")))
    rank = F.struct("n", F.xxhash64("comp").alias("h"), F.col("comp").alias("id"))
    found = both.join(links_of.select(F.col("node").alias("comp"), "n"), "comp").unionByName(links_of.withColumn("comp", F.col("node")))
    up = cut(found.groupBy("node").agg(F.max(rank).alias("most")).select("node", F.col("most.id").alias("comp")))
    for _ in range(2):
        over = up.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        up = cut(up.join(over, "comp", "left").select("node", F.coalesce("further", "comp").alias("comp")))
    return up


def _with_labels(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("comp", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _listed(classes: DataFrame) -> DataFrame:
    """A row for each of a class's ``tokens``."""
    return classes.withColumn("token", F.explode("tokens")).drop("tokens")


def _hub_pairs(rows: DataFrame, divided: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class of a long list with one hub of its lists that it may be similar to."""
    at_least = matches(percent)
    rows = rows.join(divided, "token").select("token", "node", "comp", "n_shingles", "signature", "central", _minor().alias("minor")).withColumnRenamed("n_shingles", "n")
    order = F.struct(-F.col("central"), F.xxhash64("node"), F.col("node"))
    hub = F.struct(F.col("node").alias("hub"), F.col("central").alias("hub_central"), F.col("comp").alias("hub_comp"), F.col("n").alias("hub_n"), F.col("signature").alias("hub_signature"))
    hubs = cut(rows.where("minor").groupBy("token").agg(F.min_by(hub, order).alias("h")).select("token", "h.*"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        n, m = batch.column(1).to_numpy(), batch.column(5).to_numpy()
        fits = np.minimum(n, m) * 100 >= percent * np.maximum(n, m)
        fits[fits] = (_matrix(batch.column(2).filter(pa.array(fits))) == _matrix(batch.column(6).filter(pa.array(fits)))).sum(axis=1) >= at_least
        return pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(fits)) for k in (0, 3, 4)], names=["node", "hub", "central"])

    met = rows.join(hubs, "token").where("comp <> hub_comp").select("node", "n", "signature", "hub", "hub_central", "hub_n", "hub_signature")
    near = map_arrow(met, each, "node long, hub long, central double")
    # The most central hub: most of a group then choose the same one.
    return near.groupBy("node").agg(F.min_by("hub", F.struct(-F.col("central"), F.xxhash64("hub"), F.col("hub"))).alias("hub")).select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _bundled(pairs: DataFrame, percent: int) -> DataFrame:
    """(bundle, a, b): the pairs as arrays, those of a hub together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _Merge(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, BUNDLE_NODES // 2):
                part = batch.slice(at, BUNDLE_NODES // 2)
                p, q = part.column(0).to_numpy(), part.column(1).to_numpy()
                merge.a.append(np.minimum(p, q))
                merge.b.append(np.maximum(p, q))
                yield from merge.bundle(end=False)
        yield from merge.bundle(end=True)

    return pairs.select("a", "b").sortWithinPartitions("b", "a").mapInArrow(run, "bundle long, a array<long>, b array<long>")


def _pair_index(sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers i < j of all pairs within each of several runs of rows."""
    left = [np.repeat(np.arange(s - 1), np.arange(s - 1, 0, -1)) + at for s, at in zip(sizes, starts, strict=True)]
    right = [np.concatenate([np.arange(i + 1, s) for i in range(s - 1)]) + at for s, at in zip(sizes, starts, strict=True)]
    return np.concatenate(left), np.concatenate(right)


class _Merge:
    """Counts collisions in the cells that one task reads, and bundles the pairs kept."""

    def __init__(self, percent: int):
        self.percent, self.matches = percent, matches(percent)
        self.part = TaskContext.get().partitionId()
        self.count = 0
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def pairs(self, rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> None:
        for at in range(0, len(i), AT_ONCE):
            x, y = i[at : at + AT_ONCE], j[at : at + AT_ONCE]
            n, m = rows["n"][x], rows["n"][y]
            fits = (rows["comp"][x] != rows["comp"][y]) & (np.minimum(n, m) * 100 >= self.percent * np.maximum(n, m))
            x, y = x[fits], y[fits]
            if not len(x):
                continue
            same = rows["signature"][x] == rows["signature"][y]
            enough = same.sum(axis=1) >= self.matches
            x, y, same = x[enough], y[enough], same[enough]
            both = (rows["bits"][x] & rows["bits"][y]).view(U)
            common = same & ((both[:, None] >> np.arange(COORDINATES, dtype=U)) & U(1)).astype(bool)
            mine = np.argmax(common, axis=1) == rows["token"][x] >> 32  # no earlier list took the pair
            p, q = rows["node"][x[mine]], rows["node"][y[mine]]
            if len(p):
                self.a.append(np.minimum(p, q))
                self.b.append(np.maximum(p, q))

    def bundle(self, end: bool) -> Iterator[pa.RecordBatch]:
        total = sum(map(len, self.a))
        if not total or not (end or total >= BUNDLE_PAIRS or total >= BUNDLE_NODES // 2):
            return
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        self.a, self.b = [], []
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        for at in range(0, total, BUNDLE_PAIRS):
            x, y = a[at : at + BUNDLE_PAIRS], b[at : at + BUNDLE_PAIRS]
            number = (self.part << 32) | self.count
            self.count += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([x], pa.list_(pa.int64())), pa.array([y], pa.list_(pa.int64()))], names=["bundle", "a", "b"]
            )


def _candidates(cells: DataFrame, percent: int) -> DataFrame:
    """(bundle, a, b): the pairs to be confirmed, as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge, rest = _Merge(percent), None
        for batch in batches:
            rest = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            token, c1, c2 = (rest.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((token[1:] != token[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])) + 1
            if len(change):
                yield from _merged(merge, rest.slice(0, change[-1]), np.concatenate([[0], change]))
                rest = rest.slice(change[-1])
        if rest is not None and rest.num_rows:
            yield from _merged(merge, rest, np.array([0, rest.num_rows]))
        yield from merge.bundle(end=True)

    keyed = cells.select("token", "c1", "c2", "node", "block", "n_shingles", "bits", "signature", "comp").repartition("token", "c1", "c2")
    return keyed.sortWithinPartitions("token", "c1", "c2", "node").mapInArrow(run, "bundle long, a array<long>, b array<long>")


def _merged(merge: _Merge, table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    columns = table.combine_chunks()
    rows = {name: columns.column(k).to_numpy() for name, k in (("token", 0), ("node", 3), ("n", 5), ("bits", 6), ("comp", 8))}
    rows["signature"] = _matrix(pa.chunked_array(columns.column(7)).combine_chunks() if columns.column(7).num_chunks != 1 else columns.column(7).chunk(0))
    c1, c2, block = (columns.column(k).to_numpy() for k in (1, 2, 4))
    starts, sizes = bounds[:-1], np.diff(bounds)
    within = (c1[starts] == c2[starts]) & (sizes > 1)
    at = 0
    starts_w, sizes_w = starts[within], sizes[within]
    while at < len(starts_w):  # small cells together, a large one alone
        stop = at + max(1, int(np.searchsorted(np.cumsum(sizes_w[at:] * (sizes_w[at:] - 1) // 2), 4 * AT_ONCE)))
        merge.pairs(rows, *_pair_index(sizes_w[at:stop], starts_w[at:stop]))
        yield from merge.bundle(end=False)
        at = stop
    for s, n in zip(starts[~within], sizes[~within], strict=True):
        left, right = s + np.flatnonzero(block[s : s + n] == c1[s]), s + np.flatnonzero(block[s : s + n] == c2[s])
        if len(left) and len(right) and c1[s] != c2[s]:
            merge.pairs(rows, np.repeat(left, len(right)), np.tile(right, len(left)))
            yield from merge.bundle(end=False)


def confirm(sets: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs have ``100 * intersection >= percent * union`` on the full sets."""
    nodes = np.array(sorted(sets), np.int64)
    sizes = np.array([len(sets[n]) for n in nodes], np.int64)
    _, codes = np.unique(np.concatenate([sets[n] for n in nodes]), return_inverse=True)
    ends = np.cumsum(sizes)
    mark = np.zeros(len(codes) + 1, bool)
    ia, ib = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    out = np.zeros(len(a), bool)
    order = np.argsort(ia, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(ia[order])) + 1):
        x = ia[group[0]]
        mine = codes[ends[x] - sizes[x] : ends[x]]
        mark[mine] = True
        for k in group:
            y = ib[k]
            inter = int(np.count_nonzero(mark[codes[ends[y] - sizes[y] : ends[y]]]))
            out[k] = 100 * inter >= percent * (sizes[x] + sizes[y] - inter)
        mark[mine] = False
    return out


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the given ones connect, one less than the nodes of each part."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _links(docs: DataFrame, doc: str, text: str, width: int, bundles: DataFrame, percent: int) -> DataFrame:
    """(a, b): confirmed links between classes, a spanning forest of each bundle's."""
    members = bundles.select(F.col("bundle").alias("of"), F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.tobytes() for s in shingle_sets(batch.column(1), width)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    # Documents that are in no bundle are filtered out where they lie, before Python: no text is shuffled.
    texts = docs.select(F.col(doc).cast("long").alias("node"), F.col(text).alias("text"))
    # A class is in many bundles; the filter takes it once.
    some, _ = parted(texts, "node", cut(members.select("node").distinct()), "node")
    sets = map_arrow(some, each, "node long, shingles binary")

    def run(pairs: pa.Table, held: pa.Table) -> pa.Table:
        full = {n: np.frombuffer(s, U) for n, s in zip(held.column("node").to_pylist(), held.column("shingles").to_pylist(), strict=True)}
        links: list[tuple[int, int]] = []
        for x, y in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            a, b = np.array(x, np.int64), np.array(y, np.int64)
            good = confirm(full, a, b, percent)
            links += forest(a[good], b[good])
        return pa.table({"a": pa.array([p for p, _ in links], pa.int64()), "b": pa.array([q for _, q in links], pa.int64())})

    held = members.join(sets, "node").select("of", "node", "shingles")
    return bundles.groupBy("bundle").cogroup(held.groupBy("of")).applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", percent: int = 85, width: int = WIDTH) -> DataFrame:
    """(doc, n_shingles, component) of each row of ``docs``; component: the smallest id reachable
    by links of ``100 * intersection >= percent * union``, of 80 or more: prefixes grow as it falls."""
    if percent < 80:
        raise ValueError("the similarity must be 0.8 or more (0.85 unless given)")
    rows = cut(_summaries(docs, doc, text, width))
    held = rows.where("key is not null").groupBy("key")
    classes = cut(held.agg(F.min("doc").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    tokens, counts = _frequent(classes)
    prefixed = cut(_with_prefixes(classes, tokens, counts, percent))
    postings = prefixed.select(F.explode("prefix").alias("token"), "node")
    lists = cut(_lists(postings))
    long_lists = lists.where(F.col("n") > LONG_LIST)
    confirmed: list[DataFrame] = []
    labels: DataFrame | None = None
    short = postings.join(lists.where(F.col("n") <= LONG_LIST), "token").select("token", "node", F.col("node").alias("comp"), F.lit(-(2**63)).alias("major"), F.lit(0).cast("long").alias("n_major"), F.col("n").alias("n_minor"))
    placed = _placed(short)
    if not long_lists.isEmpty():
        # A row for each class: labels are joined to classes, not to their postings.
        tokens_held = postings.join(long_lists.select("token"), "token").groupBy("node").agg(F.collect_list("token").alias("tokens"))
        members = cut(tokens_held.join(prefixed.select("node", "n_shingles", "signature", "central"), "node"))
        divided = long_lists.select("token", F.lit(-(2**63)).alias("major"), F.lit(0).cast("long").alias("n_major"), F.col("n").alias("n_minor"))
        for _ in range(HUB_ROUNDS):
            bundles = cut(_bundled(_hub_pairs(_listed(_with_labels(members, labels)), divided.where(F.col("n_minor") > LONG_LIST), percent), percent))
            confirmed.append(cut(_links(docs, doc, text, width, bundles, percent)))
            labels = _labels(reduce(DataFrame.unionByName, confirmed))
            divided = cut(_divided(_listed(_with_labels(members.select("node", "tokens"), labels))))
            if divided.where(F.col("n_minor") > LONG_LIST).isEmpty():
                break
        placed = placed.unionByName(_placed(_listed(_with_labels(members.select("node", "tokens"), labels)).join(divided, "token")))
    bundles = cut(_candidates(_cells(_with_labels(prefixed.drop("prefix"), labels), placed), percent))
    confirmed.append(_links(docs, doc, text, width, bundles, percent))
    parts = components(reduce(DataFrame.unionByName, confirmed))
    placed = prefixed.select("key", "node").join(parts, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    return rows.join(placed, "key", "left").select("doc", "n_shingles", F.coalesce("component", "doc").alias("component"))


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, all columns as they are.

    For the comparison a row without an id takes a hash of its text from 2^62 up, behind common ids;
    equal ones are copies, of which one stays, or all where they have no words.
    """
    own, spare = docs[doc].cast("long"), F.xxhash64(docs[text]).bitwiseAND(F.lit(2**62 - 1)) + F.lit(2**62)
    named = docs.select(F.coalesce(own, spare).alias("__id"), docs[text].alias("__text"))
    found = near_duplicates(named, "__id", "__text", percent)
    stays = F.max(F.col("doc") == F.col("component"))
    judged = cut(found.groupBy(F.col("doc").alias("__id")).agg(stays.alias("__stays"), F.max(F.col("n_shingles") == 0).alias("__blank")))
    gone = cut(judged.where(~F.col("__stays")).select("__id"))
    named_rows = docs.where(own.isNotNull()).withColumn("__own", own)
    some, rest = parted(named_rows, "__own", gone, "__id")  # most rows stay where they lie
    left = some.join(gone, F.col("__own") == F.col("__id"), "left_anti")
    left = (left if rest is None else left.unionByName(rest)).drop("__own")
    lone = docs.where(own.isNull()).withColumns({"__spare": spare, "__check": F.xxhash64(F.lit(11), docs[text])})
    lone = lone.join(judged.where("__stays"), F.col("__spare") == F.col("__id"))
    once = lone.where(~F.col("__blank")).dropDuplicates(["__spare", "__check"])
    nameless = lone.where("__blank").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])
    return left.unionByName(nameless)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))
