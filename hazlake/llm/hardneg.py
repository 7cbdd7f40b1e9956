"""Hard negatives: rotated one-bit codes with stored alignments bound every score, survivors are scored as integers.

Components are scaled and floored to integers; a score is an integer inner product. For the index, a vector is
rotated by a fixed random rotation, and its signs are its first code. What the code explains is the code times
its alignment with the vector; the signs of what is left are the next code, ``LEVELS`` in all. A row stores its
codes, their alignments and the length of the last residual.

An anchor is rotated and rounded to ``PLANES`` bits a component, so that its inner product with a code is a sum of
popcounts. The estimate is the sum over codes of alignment times that product. The score differs from it by at most
the residual's length times the anchor's part across the last code (Cauchy-Schwarz), and the rounding of the anchor:
a deterministic interval, no probability in it. For an anchor's positives a row falls out if its interval ends below
what five rows of the label are known to reach, by their lower ends or by scoring the rows of the best estimates; for
negatives, if it misses the window under the positive's score or ends below what five rows of the window are known to
reach. What survives is scored exactly, so results equal a full comparison.

Anchors meet all rows in cells of about ``ANCHORS`` anchors and ``ROWS`` rows, each a group of its own; a cell returns its
few best rows per anchor, and a window merges the cells. No group grows with the data, whatever the labels are.

Defined cases: rows with a null id, label, vector or component or a component that is not finite take no part; of rows
that share an id the least by (label, vector) takes part; shorter vectors end in zeros; equal scores go by smaller id;
no rows or no anchors give no rows; other columns are not read. Scores are exact while they fit in 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazlake.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80

LEVELS = 4
PLANES = 8
ANCHORS = 1024
ROWS = 2048
SOME_PAIRS = 1 << 14
SLACK = 1e-9


def rotation(size: int) -> np.ndarray:
    """A random rotation, the same in every run."""
    return np.linalg.qr(np.random.Generator(np.random.PCG64(12)).standard_normal((size, size)))[0]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Booleans (..., 64 n) as (..., n) words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes as words (n, LEVELS, words), weights (n, LEVELS + 2): alignments, length of the residual, length)."""
    left = vectors.astype(np.float64) @ rotate
    size = left.shape[1]
    codes = np.empty((len(left), LEVELS, size // 64), dtype=np.uint64)
    weights = np.empty((len(left), LEVELS + 2))
    weights[:, -1] = np.linalg.norm(left, axis=1)
    for level in range(LEVELS):
        positive = left >= 0
        codes[:, level] = _packed(positive)
        weights[:, level] = np.abs(left).sum(axis=1) / size
        left = left - np.where(positive, 1.0, -1.0) * weights[:, level : level + 1]
    weights[:, -2] = np.linalg.norm(left, axis=1)
    return codes, weights


def intervals(anchors: np.ndarray, codes: np.ndarray, weights: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) every anchor's score with every coded row can be."""
    turned = anchors.astype(np.float64) @ rotate
    size = turned.shape[1]
    length = np.linalg.norm(turned, axis=1)
    half = 1 << (PLANES - 1)
    grain = np.maximum(np.abs(turned).max(axis=1, initial=0), 1e-300) / (half - 1)
    rounded = np.rint(turned / grain[:, None])
    off = np.abs(turned - rounded * grain[:, None]).sum(axis=1)  # what a product with signs can be off
    whole = (rounded + half).astype(np.int64)
    planes = [_packed((whole >> j & 1).astype(bool)) for j in range(PLANES)]
    estimate = np.zeros((len(anchors), len(codes)))
    for level in range(LEVELS):
        held = codes[:, level]
        inside = np.zeros((len(anchors), len(codes)), dtype=np.int32)
        for word in range(held.shape[1]):
            for j, plane in enumerate(planes):
                inside += np.bitwise_count(plane[:, word, None] & held[None, :, word]).astype(np.int32) << j
        ones = np.bitwise_count(held).sum(axis=1, dtype=np.int64)
        product = (2 * (inside - half * ones[None, :]) - rounded.sum(axis=1)[:, None]) * grain[:, None]
        estimate += product * weights[None, :, level]
    along = np.maximum(np.abs(product) - off[:, None], 0) ** 2 / size
    width = weights[None, :, -2] * np.sqrt(np.maximum(length[:, None] ** 2 - along, 0))
    width += off[:, None] * weights[None, :, :LEVELS].sum(axis=2) + SLACK * length[:, None] * weights[None, :, -1] + SLACK
    return estimate - width, estimate + width


def _kth(values: np.ndarray, eligible: np.ndarray, k: int) -> np.ndarray:
    """Per anchor: the k-th best value of eligible rows, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(np.where(eligible, values, -np.inf), -k, axis=1)[:, -k]


def _reached(anchors, rows, estimate, eligible, k, least=-np.inf, most=np.inf) -> np.ndarray:
    """Per anchor: a score that k eligible rows reach, from scoring those of the best estimates; minus infinity where too few do."""
    m = min(2 * k, estimate.shape[1])
    if m < k:
        return np.full(len(estimate), -np.inf)
    masked = np.where(eligible, estimate, -np.inf)
    best = np.argpartition(masked, -m, axis=1)[:, -m:]
    a = np.repeat(np.arange(len(estimate)), m)
    score = _scores(anchors, rows, a, best.reshape(-1)).reshape(best.shape)
    return _kth(score.astype(np.float64), np.isfinite(np.take_along_axis(masked, best, axis=1)) & (score >= least) & (score <= most), k)


def _scores(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs."""
    out = np.empty(len(a), dtype=np.int64)
    for i in range(0, len(a), SOME_PAIRS):
        part = slice(i, i + SOME_PAIRS)
        out[part] = np.einsum("ij,ij->i", anchors[a[part]], rows[r[part]])
    return out


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of every group, by score, then smaller id."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return order[rank < k]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(n, -1)


class Cell:
    """Some anchors and some rows."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, rotate: np.ndarray):
        self.anchors, self.rows, self.rotate = anchors, rows, rotate
        n, m = len(anchors), len(rows)
        self.a_ids, self.a_labels = (np.asarray(anchors.column(c)) for c in ("a_id", "a_label"))
        self.r_ids, self.r_labels = (np.asarray(rows.column(c)) for c in ("id", "label"))
        self.a, self.r = _matrix(anchors.column("a_v"), n), _matrix(rows.column("v"), m)
        self.codes = _matrix(rows.column("code"), m).view(np.uint64).reshape(m, LEVELS, -1)
        self.weights = _matrix(rows.column("weight"), m)

    def parts(self):
        """(anchors of the part, lower ends, upper ends), a few anchors at a time."""
        step = max(1, (1 << 17) // max(1, len(self.r)))
        for i in range(0, len(self.a), step):
            yield slice(i, i + step), *intervals(self.a[i : i + step], self.codes, self.weights, self.rotate)

    def positives(self) -> pa.Table:
        out = []
        for part, low, high in self.parts():
            eligible = (self.a_labels[part, None] == self.r_labels) & (self.a_ids[part, None] != self.r_ids)
            bound = np.maximum(_kth(low, eligible, POSITIVES), _reached(self.a[part], self.r, (low + high) / 2, eligible, POSITIVES))
            a, r = np.nonzero(eligible & (high >= bound[:, None]))
            score = _scores(self.a[part], self.r, a, r)
            best = _best(a, score, self.r_ids[r], POSITIVES)
            out.append((self.a_ids[part][a[best]], self.r_ids[r[best]], score[best]))
        return pa.table([np.concatenate(c) for c in zip(*out)], names=["anchor_id", "positive_id", "positive_score"])

    def negatives(self) -> pa.Table:
        lists = self.anchors.column("a_positives").combine_chunks()
        at = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
        pair = lists.flatten()
        p_ids, p_scores = np.asarray(pair.field("positive_id")), np.asarray(pair.field("positive_score"))
        out = []
        for part, low, high in self.parts():
            other = self.a_labels[part, None] != self.r_labels
            n = np.diff(at[part.start : part.stop + 1])
            for k in range(int(n.max(initial=0))):
                own = np.flatnonzero(n > k)
                which = at[part.start : part.stop + 1][own] + k
                most = p_scores[which][:, None]
                least = -(-LEAST_PERCENT * most // 100)
                sure = other[own] & (low[own] >= least) & (high[own] <= most)
                estimate = (low[own] + high[own]) / 2
                reached = _reached(self.a[part][own], self.r, estimate, other[own] & (estimate <= most), NEGATIVES, least, most)
                bound = np.maximum(np.maximum(_kth(low[own], sure, NEGATIVES), reached)[:, None], least)
                a, r = np.nonzero(other[own] & (low[own] <= most) & (high[own] >= bound))
                score = _scores(self.a[part][own], self.r, a, r)
                keep = (LEAST_PERCENT * most[a, 0] <= 100 * score) & (score <= most[a, 0])
                a, r, score = a[keep], r[keep], score[keep]
                best = _best(a, score, self.r_ids[r], NEGATIVES)
                to = which[a[best]]
                out.append((self.a_ids[part][own][a[best]], p_ids[to], p_scores[to], self.r_ids[r[best]], score[best]))
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, dtype=np.int64)] * len(names)
        return pa.table(columns, names=names)


def whole(vectors: DataFrame) -> DataFrame:
    """(id, label, v) of the rows that take part, one per id; v holds integers."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    x = F.col("vector").cast("array<double>")
    kept = vectors.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    kept = kept.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", fine))
    scaled = kept.select("id", "label", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))
    return scaled.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def index(vectors: DataFrame, size: int) -> DataFrame:
    """Every row with its codes and weights; vectors end in zeros up to ``size`` components."""
    rotate = rotation(size)

    def coded(batches):
        for batch in batches:
            n = len(batch)
            codes, weights = encode(_matrix(pa.chunked_array([batch.column("v")]), n), rotate) if n else (np.zeros((0, LEVELS, size // 64), np.uint64), np.zeros((0, LEVELS + 2)))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.reshape(-1)), w) for a, w in ((codes.view(np.int64), LEVELS * size // 64), (weights, LEVELS + 2))]
            kinds = (pa.list_(pa.int64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(a.cast(k) for a, k in zip(lists, kinds))], [*batch.schema.names, "code", "weight"])

    padded = vectors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), size - F.size("v"))))
    return padded.mapInArrow(coded, "id long, label long, v array<long>, code array<long>, weight array<double>")


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, rotate: np.ndarray, what: str, schema: str) -> DataFrame:
    """What every cell of anchors and rows returns."""
    across, down = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // ROWS))
    to_all = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (down, across)]
    slot = [F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in (across, down)]
    # Anchors come from the rows' table: renamed, so that both sides can be told apart.
    renamed = [F.col(c).alias(f"a_{c}") for c in anchors.columns]
    left = anchors.select(*renamed, slot[0].alias("across"), to_all[0].alias("down"))
    right = rows.select("*", to_all[1].alias("across"), slot[1].alias("down"))

    def meet(own: pa.Table, held: pa.Table) -> pa.Table:
        if not len(own) or not len(held):
            return kind.empty_table()
        return getattr(Cell(own, held, rotate), what)()

    kind = pa.schema([(name.split()[0], pa.int64()) for name in schema.split(", ")])
    keys = ["across", "down"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def _ranked(df: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (id, label, vector).

    Anchors are the rows for which ``anchor``, a condition on id, holds.
    """
    rows = stage(whole(vectors), "vectors")
    size = rows.agg(F.max(F.size("v")), F.count("*"), F.count_if(anchor)).first()
    width, n_rows, n_anchors = max(64, -(-(size[0] or 0) // 64) * 64), size[1], size[2]
    rotate = rotation(width)
    coded = stage(index(rows, width), "codes")
    anchors = coded.filter(anchor).select("id", "label", "v")
    found = _met(anchors, coded, n_anchors, n_rows, rotate, "positives", "anchor_id long, positive_id long, positive_score long")
    best = _ranked(found, ["anchor_id"], "positive_score", "positive_id", POSITIVES)
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    # At most POSITIVES a list.
    lists = stage(lists.withColumnRenamed("anchor_id", "id"), "positives")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _met(anchors.join(lists, "id"), coded, n_anchors, n_rows, rotate, "negatives", schema)
    ranked = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
