"""How far each source's words lie from its language's and from every other source's, with strings left behind.

Texts are counted where they are read, a term as a 64-bit digest; the shuffle of counts moves digests and numbers,
packed by language and range of digests, and never a term. Terms stay in the staged rows of their tasks, once a task.
For the digests that a language keeps, the least and the greatest of their terms are found from those: where they
differ, two terms share a digest. Those digests are counted again with their terms and split into (digest, number).
Text is joined back at the end, to the rows whose value ranks high enough to be kept.

A language keeps the terms of at least ``LEAST_DOCS`` of its documents, V of them. For a group (lang, source) or a
whole language, N is the sum of its counts over kept terms and p(term) = 1 + floor(GRAIN * (count + 1) / (N + V)); the
value of p against q is floor((p - q)**2 / q). For a pair of sources the values of all kept terms are summed, also
those that neither has. The sum needs only terms that both have, from the terms' own rows, and each source's counts:

    sum over both (f(p,q) - f(p0,q) - f(p,q0) + f(p0,q0)) + sum over p's terms f(p,q0) + sum over q's f(p0,q)
    + (V - p's terms - q's) f(p0,q0),    p0 and q0 being the p of a count of 0.

Tasks add up their terms' shares per pair of sources before anything is shuffled. A language's list of sources is held
in one row: its pairs, which are the output, are that number's square.

Defined cases: a null text, lang or source reads as ''; a row is a document, repeated rows are several; a group without
terms still has its pairs; without kept terms all values are 0; equal values rank by the item's UTF-8 bytes; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazlake.llm.words import LETTERS, joined_bytes, mix, slices, span_hashes, word_spans
from hazlake.session import stage

LEAST_DOCS = 3
GRAIN = 1_000_000_000
TOP = 200
#: Bits of a digest.
BITS = 64

SLICE_BYTES = 1 << 20
HELD_ROWS = 1 << 19
#: Bytes of text whose terms one group of digests should have.
BUCKET_BYTES = 16 << 20
LIST_TERMS = 4096
SOME_PAIRS = 1 << 20
HELD_PAIRS = 1 << 20

#: A second number for every byte, so that a second hash tells apart what shares the first.
_OTHER = mix(np.arange(256, dtype=np.uint64) + np.uint64(12345))
_OTHER[65:91] = _OTHER[97:123]

#: A task's counts of one language and range of digests, one after the other; or, with neither, digests and their terms.
ROWS = (
    "lang string, bucket long, sources array<string>, source binary, digest binary, n binary, docs binary, "
    "digests array<long>, terms array<string>"
)


def _sums(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of the key columns with the sums of the value columns."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = np.zeros(len(order), dtype=bool)
    first[:1] = True
    for k in keys:
        first[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(first)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


class Counter:
    """Counts of a task's texts; gives ``ROWS``."""

    def __init__(self, bits: int, buckets: int):
        self.mask, self.buckets = np.uint64((1 << bits) - 1), np.uint64(buckets)
        self.groups: dict[tuple[str, str], int] = {}
        self.seen: set[int] = set()
        self.clear()

    def clear(self) -> None:
        self.keys, self.values, self.held = [], [], 0

    def add(self, texts: pa.Array, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        body, offsets = joined_bytes(texts)
        starts, ends, by_text = word_spans(body, offsets, LETTERS)
        if not len(starts):
            return
        digest = span_hashes(body, starts, ends)
        # A second hash tells apart terms that share a digest.
        whole, first, code = np.unique(digest ^ mix(span_hashes(body, starts, ends, _OTHER)), return_index=True, return_inverse=True)
        digest = digest[first] & self.mask
        yield from self._terms(body, starts[first], ends[first], digest, whole)
        size = len(digest)
        text = np.repeat(np.arange(len(texts)), np.diff(by_text))
        held, n = np.unique(text * size + code, return_counts=True)
        (key,), (n, docs) = _sums([groups[held // size] * size + held % size], [n, np.ones(len(n), dtype=np.int64)])
        self.keys.append((key // size, digest[key % size])), self.values.append((n, docs))
        self.held += len(n)
        if self.held > HELD_ROWS:
            yield from self.counts()

    def counts(self) -> Iterator[pa.RecordBatch]:
        """What was counted since the last call."""
        if self.held:
            (group, digest), (n, docs) = _sums(
                [np.concatenate(c) for c in zip(*self.keys)], [np.concatenate(c) for c in zip(*self.values)],
            )
            names = list(self.groups)
            langs: dict[str, int] = {}
            lang = np.array([langs.setdefault(l, len(langs)) for l, _ in names], dtype=np.int64)[group]
            bucket = (digest % self.buckets).astype(np.int64)
            order = np.lexsort((digest, bucket, lang))
            lang, bucket, group, digest, n, docs = (x[order] for x in (lang, bucket, group, digest, n, docs))
            cut = np.flatnonzero(np.append(True, (lang[1:] != lang[:-1]) | (bucket[1:] != bucket[:-1])))
            rows = []
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(n)).tolist()):
                own, source = np.unique(group[a:b], return_inverse=True)
                rows.append({
                    "lang": names[own[0]][0], "bucket": int(bucket[a]), "sources": [names[g][1] for g in own.tolist()],
                    "source": source.astype(np.uint32).tobytes(), "digest": digest[a:b].tobytes(),
                    "n": n[a:b].astype(np.uint32).tobytes(), "docs": docs[a:b].astype(np.uint32).tobytes(),
                })
            yield pa.RecordBatch.from_pylist(rows, _ARROW)
        self.clear()

    def _terms(self, body, starts, ends, digest, whole) -> Iterator[pa.RecordBatch]:
        """(digest, term) of terms this task has not given yet; ``whole`` tells terms apart."""
        new = [i for i, w in enumerate(whole.tolist()) if w not in self.seen]
        self.seen.update(whole[new].tolist())
        if len(self.seen) > HELD_ROWS:
            self.seen = set()
        if new:
            data = body.tobytes()
            terms = [data[a:b].decode("utf-8").translate(_LOWER) for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            digests = digest[new].view(np.int64).tolist()
            lists = [{"digests": digests[i : i + LIST_TERMS], "terms": terms[i : i + LIST_TERMS]} for i in range(0, len(new), LIST_TERMS)]
            yield pa.RecordBatch.from_pylist(lists, _ARROW)


_LOWER = {c: c + 32 for c in range(65, 91)}
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in ROWS.split(", "))])


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_rows(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``ROWS`` of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES

    def rows(batches):
        counter = Counter(bits, buckets)
        for batch in batches:
            groups = [counter.groups.setdefault(g, len(counter.groups)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
            groups = np.array(groups, dtype=np.int64)
            for first, some in slices(batch.column("text"), SLICE_BYTES):
                yield from counter.add(some, groups[first : first + len(some)])
        yield from counter.counts()

    return docs.mapInArrow(rows, ROWS)


_KEPT = "lang string, digest long, n_lang long, own array<struct<source: string, n: long>>"


def _kept(rows: pa.Table) -> pa.Table:
    """The digests that enough documents of a language have, with their counts by source."""
    codes: dict[str, int] = {}
    parts = []
    for row in rows.to_pylist():
        names = np.array([codes.setdefault(s, len(codes)) for s in row["sources"]], dtype=np.int64)
        numbers = [np.frombuffer(row[k], dtype=np.uint32) for k in ("source", "n", "docs")]
        parts.append((names[numbers[0]], np.frombuffer(row["digest"], dtype=np.uint64), *(x.astype(np.int64) for x in numbers[1:])))
    source, digest, n, docs = (np.concatenate(c) for c in zip(*parts))
    (digest, source), (n, docs) = _sums([digest, source], [n, docs])
    first = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
    size = np.diff(np.append(first, len(digest)))
    enough = np.add.reduceat(docs, first) >= LEAST_DOCS
    held = np.repeat(enough, size)
    own = pa.StructArray.from_arrays([pa.array(list(codes), pa.string()).take(pa.array(source[held])), pa.array(n[held])], ["source", "n"])
    offsets = pa.array(np.concatenate([[0], np.cumsum(size[enough])]).astype(np.int32))
    total = np.add.reduceat(n, first)[enough]
    columns = [pa.array([rows.column("lang")[0].as_py()] * len(total), pa.string()), pa.array(digest[first[enough]].view(np.int64)), pa.array(total)]
    return pa.table([*columns, pa.ListArray.from_arrays(offsets, own)], names=["lang", "digest", "n_lang", "own"])


def _recounted(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(lang, source, digest, part, n, docs) of the terms of the digests that several terms share."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x00-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    lower = F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.withColumn("_row", F.monotonically_increasing_id()).select("lang", "source", "_row", F.explode(words).alias("word"))
    words = words.select("lang", "source", "_row", lower.alias("term"))
    counted = words.groupBy("lang", "source", "_row", "term").count().groupBy("lang", "source", "term").agg(F.sum("count").alias("n"), F.count("*").alias("docs"))
    return counted.join(shared, "term")


def _by_term(counts: DataFrame) -> DataFrame:
    """Rows like ``_KEPT`` and their part from (lang, source, digest, part, n, docs)."""
    kept = counts.groupBy("lang", "digest", "part").agg(
        F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("own"),
    )
    return kept.filter(F.col("docs") >= LEAST_DOCS).drop("docs")


def _split(kept: DataFrame, rows: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept digests and their terms with ``part``: 0, or the term's number among those of its digest where there are several."""
    given = rows.filter("lang IS NULL").select(F.explode(F.arrays_zip("digests", "terms")).alias("t")).select(F.col("t.digests").alias("digest"), F.col("t.terms").alias("term"))
    given = given.join(kept.select("digest").distinct(), "digest", "left_semi")
    names = stage(given.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most")), "names")
    collided = names.filter(F.col("least") != F.col("most")).select("digest")
    kept, named = kept.withColumn("part", F.lit(0)), names.select("digest", F.lit(0).alias("part"), F.col("least").alias("term"))
    if collided.isEmpty():
        return kept, named
    number = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    shared = stage(given.join(collided, "digest", "left_semi").distinct().withColumn("part", number), "shared")
    return (
        kept.join(collided, "digest", "left_anti").unionByName(_by_term(_recounted(docs, shared))),
        named.join(collided, "digest", "left_anti").unionByName(shared),
    )


def _p(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(GRAIN * (count + 1) / (total + V)), in decimals, which hold any count; 1 without kept terms."""
    held = [c.cast("decimal(18,0)") for c in (count + 1, total + v)]
    share = F.call_function("div", held[0] * F.lit(GRAIN).cast("decimal(10,0)"), held[1])
    return F.when(v == 0, F.lit(1).cast("long")).otherwise(1 + share)


def _value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _np_value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shares(batches) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value) sums of a task over terms that both sources have, from (lang, own[source, p, p0])."""
    codes: dict[tuple[str, str], int] = {}
    keys, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def rows() -> pa.RecordBatch:
        names = list(codes)
        left, right = keys >> 32, keys & 0xFFFFFFFF
        lang, source = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
        columns = [lang.take(pa.array(left)), source.take(pa.array(left)), source.take(pa.array(right)), pa.array(values)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "value"])

    for batch in batches:
        own = batch.column("own")
        size = np.asarray(pc.list_value_length(own), dtype=np.int64)
        entry = own.flatten()
        row = np.repeat(np.arange(len(size)), size)
        lang, source = batch.column("lang").dictionary_encode(), entry.field("source").dictionary_encode()
        both = np.asarray(lang.indices, dtype=np.int64)[row] * len(source.dictionary) + np.asarray(source.indices, dtype=np.int64)
        named, at = np.unique(both, return_inverse=True)
        langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        numbers = [codes.setdefault((langs[k // len(sources)], sources[k % len(sources)]), len(codes)) for k in named.tolist()]
        code = np.array(numbers, dtype=np.int64)[at]
        p, p0 = np.asarray(entry.field("p")), np.asarray(entry.field("p0"))
        partners = size[row]
        done = np.concatenate([[0], np.cumsum(partners)])
        first_of_row = (np.cumsum(size) - size)[row]
        begin = 0
        while begin < len(row):
            end = max(begin + 1, int(np.searchsorted(done, done[begin] + SOME_PAIRS, side="right")) - 1)
            left = np.repeat(np.arange(begin, end), partners[begin:end])
            right = np.arange(len(left)) - np.repeat(done[begin:end] - done[begin], partners[begin:end]) + first_of_row[left]
            apart = left != right
            left, right = left[apart], right[apart]
            value = _np_value(p[left], p[right]) - _np_value(p0[left], p[right]) - _np_value(p[left], p0[right]) + _np_value(p0[left], p0[right])
            (keys,), (values,) = _sums([np.append(keys, code[left] << 32 | code[right])], [np.append(values, value)])
            begin = end
            if len(keys) > HELD_PAIRS:
                yield rows()
                keys, values = keys[:0], values[:0]
    yield rows()


def _alone(batches) -> Iterator[pa.RecordBatch]:
    """What a source's own terms add to its pairs, as their first and as their second, from its counts and its language's sources."""
    for batch in batches:
        for row in batch.to_pylist():
            names = [o["source"] for o in row["others"]]
            p0, terms = (np.array([o[k] for o in row["others"]], dtype=np.int64) for k in ("p0", "terms"))
            held = row["held"] or []
            p, times = (np.array([h[k] for h in held], dtype=np.int64)[:, None] for k in ("p", "times"))
            first = (row["v"] - row["terms"] - terms) * _np_value(np.int64(row["p0"]), p0)
            second = np.zeros_like(first)
            step = max(1, SOME_PAIRS // max(1, len(names)))
            for i in range(0, len(p), step):
                first += (times[i : i + step] * _np_value(p[i : i + step], p0)).sum(axis=0)
                second += (times[i : i + step] * _np_value(p0, p[i : i + step])).sum(axis=0)
            here, lang = [row["source"]] * len(names), [row["lang"]] * len(names)
            for columns in ([lang, here, names, first], [lang, names, here, second]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "source", "item", "value"])


def audit(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(lang, source, part, item, value, rank) of (lang, source, text)."""
    docs = _documents(docs)
    rows = stage(term_rows(docs, bits), "terms")
    kept = stage(rows.filter("lang IS NOT NULL").groupBy("lang", "bucket").applyInArrow(_kept, _KEPT), "kept")
    kept, names = _split(kept, rows, docs)

    term = ["lang", "digest", "part"]
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all_lang"))
    each = kept.select(*term, "n_lang", F.inline("own"))
    used = each.groupBy("lang", "source").agg(F.sum("n").alias("all"), F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(langs, "lang", "left")
    totals = groups.na.fill(0, ["all", "terms", "v", "all_lang"])
    totals = stage(totals.withColumn("p0", _p(F.lit(0), F.col("all"), F.col("v"))), "totals")

    each = each.join(totals.select("lang", "source", "all", "v", "all_lang", "p0"), ["lang", "source"]).select(
        *term, "source", _p(F.col("n"), F.col("all"), F.col("v")).alias("p"), _p(F.col("n_lang"), F.col("all_lang"), F.col("v")).alias("q"), "p0",
    )
    each = stage(each, "shares")
    return _pairs(each, totals).unionByName(_terms(each, names))


def _terms(each: DataFrame, names: DataFrame) -> DataFrame:
    """A group's terms that it has more of than its language; text is joined to those that can be among the first."""
    group = Window.partitionBy("lang", "source")
    over = each.filter(F.col("p") > F.col("q")).select("lang", "source", "digest", "part", _value(F.col("p"), F.col("q")).alias("value"))
    # All that tie with the last place stay until their text settles the order.
    first = over.withColumn("_rank", F.rank().over(group.orderBy(F.desc("value")))).filter(F.col("_rank") <= TOP).drop("_rank")
    named = first.join(names, ["digest", "part"]).withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term")))
    return named.filter(F.col("rank") <= TOP).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(each: DataFrame, totals: DataFrame) -> DataFrame:
    """Every source against every other of its language."""
    schema = "lang string, source string, item string, value long"
    own = each.groupBy("lang", "digest", "part").agg(F.collect_list(F.struct("source", "p", "p0")).alias("own"))
    shared = own.filter(F.size("own") > 1).select("lang", "own").mapInArrow(_shares, schema)
    held = each.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    held = held.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("held"))
    others = totals.groupBy("lang").agg(F.collect_list(F.struct("source", "p0", "terms")).alias("others"))
    alone = totals.select("lang", "source", "p0", "terms", "v").join(held, ["lang", "source"], "left").join(others, "lang").mapInArrow(_alone, schema)
    summed = shared.unionByName(alone).filter(F.col("source") != F.col("item")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
