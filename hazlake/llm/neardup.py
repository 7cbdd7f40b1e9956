"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct word shingles; two are linked if their Jaccard similarity is
at least 0.8. Documents with equal sets are one class from the start. Classes carry 64 minwise
tokens. In every one of ``TREES`` independent trees a node branches by three chosen tokens: a
class goes to one child per token, named by the token's value. A node of at most ``LEAF`` classes
is compared exhaustively; a larger one branches on, with three further tokens, chosen by a hash of the node from those
that its path has not used, so that sibling branches do not fail together. Two sets of similarity s share a token with
probability s. Three trees miss a link at 0.8 with a probability of 2 in a million where nodes end at depth one and 3.4 in
a million at full depth, as computed for tokens drawn without replacement from 64 of which Binomial(64, 0.8) agree; the
comparison below misses 4.2 in a million: together less than 1 in 100,000. A node that ``DEPTH`` levels have not made
small holds a dense group; it is compared exhaustively too, as pairs of blocks of its classes, each a node of its own.

Inside a node, pairs whose sizes or tokens allow a link (36 of 64 tokens equal; expected are 51) join classes
into groups. A group is verified on full sets in one place: every class outside the largest component
found so far is compared with all others, so no link between two components is left out and pairs inside one
component cost nothing. Verified links of all groups then become components by alternating stars.

Defined cases: a text without words has an empty set and no link; one of fewer words than a shingle has one, its whole
sequence; a null doc_id is linked with nothing and kept; repeated rows are one class; several texts of one doc_id are
classes of their own, each with its own component; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from hazlake.llm.words import constants, minima, mix, shingle_hashes, slices, word_hashes
from hazlake.session import stage

SHINGLE = 5
PERCENT = 80
TOKENS = 64
TREES = 3
BRANCHES = 3
LEAF = 2048
DEPTH = 4
LEAST_EQUAL = 36
GROUP_SHINGLES = 4 << 20

_ORDER = np.random.Generator(np.random.PCG64(41)).permutation(TOKENS)


def _chosen(tree: int, node: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The tokens by which each node of a tree branches; ``used``: bits of the tokens on the way to it. Roots share none."""
    tokens = np.arange(TOKENS, dtype=np.uint64)
    order = mix(mix(node + np.uint64(tree + 1))[:, None] + tokens * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
    order[(used[:, None] >> tokens) & np.uint64(1) == 1] = np.iinfo(np.uint64).max
    chosen = np.argpartition(order, BRANCHES - 1, axis=1)[:, :BRANCHES]
    chosen[used == 0] = _ORDER[tree * BRANCHES : (tree + 1) * BRANCHES]
    return chosen


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    for _, some in slices(texts):
        hashes, at = shingle_hashes(*word_hashes(some), size)
        for i in range(len(some)):
            yield np.unique(hashes[at[i] : at[i + 1]])


def _name(own: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return np.array([own.sum(dtype=np.uint64), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]).tobytes()


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, name, tokens) of (doc_id, text); an empty set has neither name nor tokens."""
    factors = constants(TOKENS, 43)

    def sketch(batches):
        for batch in batches:
            counts, names, tokens = [], [], []
            for _, some in slices(batch.column("text")):
                hashes, at = shingle_hashes(*word_hashes(some), size)
                rows = iter(minima(hashes, at, factors))
                for i in range(len(some)):
                    own = np.unique(hashes[at[i] : at[i + 1]])
                    counts.append(len(own))
                    names.append(_name(own) if len(own) else None)
                    tokens.append(next(rows).tobytes() if len(own) else None)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "name", "tokens"])

    return _plain(docs).mapInArrow(sketch, "doc_id long, n_shingles long, name binary, tokens binary")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


def _children(rows: DataFrame, depth: int) -> DataFrame:
    """(tree, node, used, id) one level on; of (tree, node, used, id, tokens), or at the root of (id, tokens)."""
    def branch(batches):
        for batch in batches:
            if not len(batch):
                continue
            signatures, n = _signatures(batch.column("tokens")), len(batch)
            at_root = depth == 0
            for tree in range(TREES):
                own = np.arange(n) if at_root else np.flatnonzero(batch.column("tree").to_numpy() == tree)
                node, used = (np.zeros(n, np.uint64) if at_root else batch.column(c).to_numpy().view(np.uint64) for c in ("node", "used"))
                nodes, first, number = np.unique(node[own], return_index=True, return_inverse=True)
                chosen = _chosen(tree, nodes, used[own][first])[number]
                for token in chosen.T:
                    key = (np.uint64(tree * TOKENS) + token.astype(np.uint64)) << np.uint64(32)
                    child = mix(node[own] * np.uint64(0x9E3779B97F4A7C15) + key + signatures[own, token])
                    way = used[own] | (np.uint64(1) << token.astype(np.uint64))
                    columns = [pa.array(np.full(len(own), tree, np.int32)), pa.array(child.view(np.int64)), pa.array(way.view(np.int64)), batch.column("id").take(pa.array(own))]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "used", "id"])

    return rows.mapInArrow(branch, "tree int, node long, used long, id long")


def _blocks(rows: DataFrame) -> DataFrame:
    """Nodes that stay large, as nodes of two blocks of their classes each; every pair of classes meets in one."""
    blocks = F.greatest(F.lit(2), F.ceil(F.col("count") / (LEAF // 2))).cast("int")
    own = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other != own")
    pair = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return other.select("tree", pair.alias("node"), "id")


def _leaves(classes: DataFrame, spark) -> DataFrame:
    """(node, id) of all nodes with 2 to LEAF classes."""
    rows, leaves = _children(classes.select("id", "tokens"), 0), None
    for depth in range(1, DEPTH + 1):
        rows = stage(rows, f"level{depth}")
        sizes = rows.groupBy("node").count().filter("count > 1")
        sized = stage(rows.join(sizes, "node"), f"sized{depth}")
        small = sized.filter(F.col("count") <= LEAF).select("node", "id")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = sized.filter(F.col("count") > LEAF)
        if large.isEmpty():
            return leaves
        if depth < DEPTH:
            rows = _children(large.join(classes.select("id", "tokens"), "id"), depth)
    return leaves.unionByName(_blocks(large).select("node", "id"))


def _by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows that share ``key``, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            if held and held[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _likely(signatures: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Label of each class: classes with a chain of likely links share one."""
    n = len(sizes)
    label = np.full(n, -1)
    for first in range(n):
        if label[first] >= 0:
            continue
        label[first], waiting = first, [first]
        while waiting:
            i = waiting.pop()
            open_ = np.flatnonzero(label < 0)
            near = 100 * np.minimum(sizes[open_], sizes[i]) >= PERCENT * np.maximum(sizes[open_], sizes[i])
            open_ = open_[near]
            found = open_[np.count_nonzero(signatures[open_] == signatures[i], axis=1) >= LEAST_EQUAL]
            label[found] = first
            waiting.extend(found.tolist())
    return label


def _group_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, id): likely groups of every node, named by their members; one with many shingles as pairs of blocks."""
    groups, members = [], []

    def emit(ids: np.ndarray) -> None:
        ids = np.sort(ids)
        name = mix(ids.view(np.uint64) + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(ids))
        groups.append(np.full(len(ids), name.view(np.int64)))
        members.append(ids)

    def batch() -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(x)) for x in (groups, members)]
        groups.clear(), members.clear()
        return pa.RecordBatch.from_arrays(columns, ["group", "id"])

    for table in _by_group(batches, "node"):
        ids = table.column("id").to_numpy()
        if len(np.unique(ids)) < len(ids):
            table = table.take(pa.array(np.unique(ids, return_index=True)[1]))
            ids = table.column("id").to_numpy()
        sizes = table.column("n_shingles").to_numpy()
        label = _likely(_signatures(table.column("tokens").combine_chunks()), sizes)
        order = np.argsort(label, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            if len(own) < 2:
                continue
            block = np.cumsum(sizes[own]) // (GROUP_SHINGLES // 2)
            blocks = [own[block == b] for b in np.unique(block)]
            if len(blocks) == 1:
                emit(ids[own])
            for i in range(len(blocks)):
                for j in range(i):
                    emit(ids[np.concatenate([blocks[i], blocks[j]])])
        if sum(map(len, members)) > 10_000:
            yield batch()
    if members:
        yield batch()


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Label of each set, the same for sets connected by links; exact."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, flat, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    label, compared = np.arange(n), np.zeros(n, dtype=bool)
    # The set whose shingles the others share most is likely to link most of them at once.
    pivot = int(np.argmax(np.add.reduceat(often[flat].astype(float), starts) / sizes))
    while True:
        mark = np.zeros(len(often), dtype=np.int32)
        mark[flat[starts[pivot] : starts[pivot] + sizes[pivot]]] = 1
        shared = np.add.reduceat(mark[flat], starts)
        found = 100 * shared >= PERCENT * (sizes + sizes[pivot] - shared)
        label[np.isin(label, label[found])] = label[pivot]
        compared[pivot] = True
        labels, members = np.unique(label, return_counts=True)
        left = np.flatnonzero(~compared & (label != labels[members.argmax()]))
        if not len(left):
            return label
        pivot = int(left[0])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): every linked class of a group and the least class of its component there."""
    for table in _by_group(batches, "group"):
        ids, first = np.unique(table.column("id").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        label = linked([np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()])
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        root = least[label]
        own = np.flatnonzero(ids != root)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(root[own])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex of a component but its least, with its least, from edges (u, v) with u > v.

    Alternating large and small stars: each round joins neighbours to the least one they share. Both
    steps are aggregates with partial sums and joins that can be split, so no vertex is one task.
    """
    edges, seen = stage(edges.distinct(), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select("u", F.col("m").alias("v")).unionByName(near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stage(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            return edges
        seen = now


def _classes(sketched: DataFrame) -> DataFrame:
    """(name, id, least, copies, n_shingles, tokens): one row per different set; ``least`` is its least doc_id.

    ``id`` is ``least`` too, unless several classes have the same: then it is a hash of the set's name,
    so that no class takes another's links.
    """
    named = sketched.filter("name IS NOT NULL AND doc_id IS NOT NULL")
    classes = stage(
        named.groupBy("name").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
        ), "classes",
    )
    shared = classes.groupBy("least").count().filter("count > 1").select("least")
    if shared.isEmpty():
        return classes.withColumn("id", F.col("least"))
    marked = classes.join(shared.withColumn("shared", F.lit(True)), "least", "left")
    return stage(marked.withColumn("id", F.when(F.col("shared"), F.xxhash64("name")).otherwise(F.col("least"))).drop("shared"), "classes")


def _resolved(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, name, component, first) of every row; ``first``: whether its set is the one that stays.

    Rows without a set, or with one that is linked with nothing and has no copy, may have neither component nor first.
    """
    sketched = stage(sketches(docs, size), "sketches")
    classes = _classes(sketched)
    nodes = _leaves(classes, docs.sparkSession).join(classes.select("id", "n_shingles", "tokens"), "id")
    sorted_nodes = nodes.repartition("node").sortWithinPartitions("node")
    groups = stage(sorted_nodes.mapInArrow(_group_batches, "group long, id long").distinct(), "groups")

    def full_sets(batches):
        for batch in batches:
            own = list(_sets(batch.column("text"), size))
            # A doc_id may stand for several rows; a class is the one whose name it has.
            at = [i for i, (s, name) in enumerate(zip(own, batch.column("name").to_pylist())) if _name(s) == name]
            columns = [batch.column("group").take(pa.array(at, pa.int64())), batch.column("id").take(pa.array(at, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([own[i].tobytes() for i in at], pa.binary())], ["group", "id", "shingles"])

    # Members and documents both grow with the input, so neither is sent to all tasks, at any size.
    members = groups.join(classes.select("id", "least", "name"), "id").hint("merge")
    rows = docs.join(members, docs["doc_id"] == members["least"]).select("group", "id", "name", "text")
    sets = rows.mapInArrow(full_sets, "group long, id long, shingles binary")
    verified = sets.repartition("group").sortWithinPartitions("group").mapInArrow(_link_batches, "u long, v long")
    links = components(verified)
    joined = classes.join(links.withColumnRenamed("u", "id"), "id", "left").withColumn("root", F.coalesce("v", "id"))
    if classes.filter("id <> least").isEmpty():
        resolved = joined.withColumns({"component": F.col("root"), "first": F.col("id") == F.col("root")})
    else:
        # Roots may be hashes: a component is named by the least doc_id of its classes.
        heads = joined.groupBy("root").agg(F.min(F.struct("least", "name")).alias("head"))
        resolved = joined.join(heads, "root").withColumns({"component": F.col("head.least"), "first": F.col("name") == F.col("head.name")})
    marked = resolved.filter("copies > 1 OR v IS NOT NULL OR NOT first OR component <> id").select("name", "component", "first")
    return sketched.select("doc_id", "n_shingles", "name").join(marked, "name", "left")


def _component() -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text)."""
    return _resolved(_plain(docs), size).select(
        "doc_id", "n_shingles", _component().alias("component_id"), F.coalesce(F.col("doc_id") == _component(), F.lit(True)).alias("kept"),
    )


def _with_name(docs: DataFrame, size: int, column: str) -> DataFrame:
    """The rows with the name of their text's set in a column of their own."""
    def named(batches):
        for batch in batches:
            names = [_name(s) if len(s) else None for s in _sets(batch.column(column), size)]
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, pa.field(column, pa.binary()), pa.array(names, pa.binary()))

    text = docs.withColumn(column, F.col("text").cast("string"))
    return text.mapInArrow(named, T.StructType([*docs.schema.fields, T.StructField(column, T.BinaryType())]))


def without_near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of every component, the one with the least doc_id, with the columns it came with.

    Of texts that share a doc_id, each is judged by its own set: one that is a copy of an earlier document
    does not take another with it. Rows of one doc_id and one set are one document, the least text of them;
    without a set, rows of one doc_id and one text are.
    """
    resolved = stage(_resolved(_plain(docs), size).filter("first IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id", "name", ((F.col("doc_id") == F.col("component")) & F.col("first")).alias("stays"),
    ), "resolved")
    again = stage(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    dropped = resolved.filter("NOT stays").select("doc_id").distinct()
    if again.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    once_only = docs.join(dropped.unionByName(again).distinct(), "doc_id", "left_anti").select(*docs.columns)
    own = "_set"
    while own in docs.columns:
        own += "_"
    repeated = _with_name(docs.join(again, "doc_id", "left_semi").select(*docs.columns), size, own)
    gone = resolved.filter("NOT stays").select("doc_id", F.col("name").alias(own)).distinct()
    left = repeated.join(gone, ["doc_id", own], "left_anti").select(*repeated.columns)
    rank = own + "_rank"
    same = Window.partitionBy("doc_id", own, F.when(F.col(own).isNull(), F.col("text"))).orderBy("text")
    one = left.withColumn(rank, F.row_number().over(same)).filter(F.col(rank) == 1)
    return once_only.unionByName(one.select(*docs.columns))
