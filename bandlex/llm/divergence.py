"""How far the sources of a language differ in their terms.

1. Every task takes its texts in slices.  Word starts are found in the Arrow buffer itself,
   by a table of bytes, and become pointers; nothing is cut out.  The pointers of a slice
   are sorted by eight bytes at a time, read as one number, all segments of a slice at once;
   pointers of a segment that are equal so far go on as a segment with the next eight bytes.
2. The sorts keep equal pointers in order, and a slice starts with one segment per language and
   source.  A run of equal words therefore lies in order of its documents: its length is
   the term's count in that source, and its changes of document the document frequency.
   One row per run leaves the task; rows are combined before and after the shuffle.
3. Each language keeps the terms of enough documents.  Sources are compared by sums over
   slices of the terms, taken as matrices of sources by terms, in blocks of sources.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandlex.llm.shared import settle

LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TERMS_SHOWN = 50
SLICE = 16 << 20  # bytes of text that are sorted at a time
SOURCES = 256  # of a block that is compared with another
CELLS = 1 << 20  # numbers of a matrix of terms or sources

_BYTES = np.arange(256)
#: What a word is made of: ASCII letters and every byte beyond ASCII.
IN_WORD = (_BYTES >= 0x80) | ((_BYTES | 0x20) >= 0x61) & ((_BYTES | 0x20) <= 0x7A) & (_BYTES >= 0x41)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES | 0x20, _BYTES).astype(np.uint8)
WIDE = 8
#: Masks that keep the first 0 to 8 bytes of a wide character.
_KEPT = np.array([((1 << 64) - 1) ^ ((1 << 8 * (WIDE - n)) - 1) for n in range(WIDE + 1)], np.uint64)


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, lengths, text`` of the words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IN_WORD[data]
    after = np.empty_like(inside)  # whether the byte before is in a word of the same text
    after[0] = False
    after[1:] = inside[:-1]
    after[offsets[:-1]] = False
    starts = np.flatnonzero(inside & ~after)
    # a word ends where a byte outside follows, or another text begins
    ending = inside[:-1] & ~inside[1:]
    last = offsets[1:] - 1
    last = last[last >= offsets[:-1]]
    ending[last] |= inside[last]
    ends = np.flatnonzero(ending) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, "right") - 1


def _wide(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number, with zeros beyond the ``left`` bytes of the
    word.  ``data`` has eight spare bytes at its end."""
    windows = np.ndarray((len(data) - WIDE + 1,), ">u8", data, strides=(1,))
    return windows[at].astype(np.uint64) & _KEPT[np.clip(left, 0, WIDE)]


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``order, heads``: pointers sorted by word within each segment, and where in that order
    a run of equal words of a segment begins.

    ``segments`` has the number of pointers of each segment, in their order.  ``data`` is in
    lower case and has eight spare bytes at its end.  Equal words keep their order.
    """
    n = len(starts)
    order, heads = np.arange(n), np.zeros(n, bool)
    place = np.arange(n)  # where in ``order`` the pointers at hand are
    at, segment = order.copy(), np.repeat(np.arange(len(segments)), segments)
    depth = 0
    while len(at):
        key = _wide(data, np.minimum(starts[at] + depth, len(data) - WIDE), lengths[at] - depth)
        by_key = np.argsort(key, kind="stable")
        # segments are in order already: a stable sort by them keeps the order of keys in each
        number = segment[by_key]
        to = by_key[np.argsort(number.astype(np.uint16) if segment[-1] < 1 << 16 else number, kind="stable")]
        at, key = at[to], key[to]  # a segment's pointers stay in its places
        order[place] = at
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (segment[1:] != segment[:-1])
        heads[place[new]] = True
        # equal keys go on as a segment, unless they are single or their words have ended
        segment = np.cumsum(new) - 1
        go_on = (key & np.uint64(0xFF) != 0) & (np.bincount(segment)[segment] > 1)
        at, place, segment = at[go_on], place[go_on], segment[go_on]
        segment = np.unique(segment, return_inverse=True)[1]
        depth += WIDE
    return order, heads


def _runs(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """``group, term, count, documents`` of the texts' words, one entry per group and term.
    ``group`` numbers the group of each text from 0."""
    data = np.concatenate((LOWER[data], np.zeros(WIDE, np.uint8)))
    starts, lengths, text = word_pointers(data[:-WIDE], offsets)
    if not len(starts):
        return np.empty(0, np.int64), [], np.empty(0, np.int64), np.empty(0, np.int64)
    of = group[text]
    by_group = np.argsort(of, kind="stable")
    starts, lengths, text, of = starts[by_group], lengths[by_group], text[by_group], of[by_group]
    order, heads = sort_pointers(data, starts, lengths, np.bincount(of))
    begin = np.flatnonzero(heads)
    count = np.diff(np.append(begin, len(order)))
    doc = text[order]
    new = np.ones(len(doc), np.int64)
    new[1:] = doc[1:] != doc[:-1]
    new[begin] = 1
    first = order[begin]
    raw = data.tobytes()
    terms = [raw[s : s + n] for s, n in zip(starts[first].tolist(), lengths[first].tolist())]
    return of[first], terms, count, np.add.reduceat(new, begin)


def _long_text(data: np.ndarray, size: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """`_runs` of one text, sorted in slices that end between words."""
    found: Counter = Counter()
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and IN_WORD[data[end - 1]]:  # up to the end of a word
            outside = np.flatnonzero(~IN_WORD[data[end : end + size]])
            end = min(end + size, len(data)) if not len(outside) else end + int(outside[0])
            if len(outside):
                break
        part = data[at:end]
        _, terms, count, _ = _runs(part, np.array([0, len(part)]), np.zeros(1, np.int64))
        for term, n in zip(terms, count.tolist()):
            found[term] += n
        at = end
    n = len(found)
    return np.zeros(n, np.int64), list(found), np.fromiter(found.values(), np.int64, n), np.ones(n, np.int64)


def source_terms(docs: DataFrame, size: int = SLICE) -> DataFrame:
    """``lang, source, term, n, docs``: count and document frequency of every term of a
    group, and one row of each group with a null term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "docs"]

        def rows(keys: list[tuple[str, str]], found: tuple) -> pa.RecordBatch:
            group, terms, n, docs_ = found
            lang, source = (pa.array([k[i] for k in keys], pa.string()) for i in (0, 1))
            group = pa.array(np.concatenate((group, np.arange(len(keys)))))
            term = pa.concat_arrays([pa.array(terms, pa.binary()).cast(pa.string()), pa.nulls(len(keys), pa.string())])
            more = [pa.array(np.concatenate((x, np.zeros(len(keys), np.int64)))) for x in (n, docs_)]
            return pa.RecordBatch.from_arrays([lang.take(group), source.take(group), term, *more], names)

        def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lang, source, text = (batch.column(i) for i in range(3))
            sizes = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            at = 0
            while at < len(sizes):
                base = ends[at] - sizes[at]
                end = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
                # a slice may be a view: its own offsets say where its bytes are
                part = text.slice(at, end - at)
                offsets = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
                data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
                pairs = list(zip(lang.slice(at, end - at).to_pylist(), source.slice(at, end - at).to_pylist()))
                numbers = {pair: i for i, pair in enumerate(dict.fromkeys(pairs))}
                if len(data) > size:
                    yield rows(pairs, _long_text(data, size))
                else:
                    group = np.fromiter((numbers[p] for p in pairs), np.int64, len(pairs))
                    yield rows(list(numbers), _runs(data, offsets - offsets[0], group))
                at = end

        held, bytes_held = [], 0
        for batch in batches:
            held.append(batch)
            bytes_held += batch.nbytes
            if bytes_held >= size:
                yield from slices(_joined(held))
                held, bytes_held = [], 0
        if held:
            yield from slices(_joined(held))

    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = docs.select(*filled).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


# divergences


def share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term in billionths, from 1."""
    n, total, terms = (c.cast("decimal(20,0)") for c in (n, total, terms))
    return F.call_function("div", (n + SMOOTHING) * F.lit(UNIT), total + terms * SMOOTHING) + 1


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, n``: terms of at least ``least`` documents of their language."""
    terms = counts.where("term is not null").groupBy("lang", "term")
    return terms.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")


def _distances(terms: DataFrame, block: int = SOURCES, cells: int = CELLS) -> DataFrame:
    """``lang, a, b, far``: of every two sources numbered ``a < b`` of a language, by how much
    the terms that either has differ more than terms that both lack.

    ``terms`` has, per kept term of a language, ``held``: an array of ``number, p`` of the
    sources that have it, and ``bases``: the share of a term that a source lacks, by its
    number.  A task adds up matrices of sources by sources, and hands over what it has
    whenever these, or the terms at hand, come to ``cells`` numbers.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far: dict[tuple, np.ndarray] = {}
        bases: dict[str, np.ndarray] = {}
        waiting: dict[str, list] = {}

        def count(lang: str) -> Iterator[pa.RecordBatch]:
            rows, base = waiting.pop(lang), bases[lang]
            p = np.zeros((len(rows), len(base)), np.int64)  # beyond the share of a lacking term
            for i, held in enumerate(rows):
                numbers = [h["number"] for h in held]
                p[i, numbers] = [h["p"] for h in held] - base[numbers]
            for i in range(0, len(base), block):
                for j in range(i, len(base), block):
                    a, b = p[:, i : i + block], p[:, j : j + block]
                    total = far.setdefault((lang, i, j), np.zeros((a.shape[1], b.shape[1]), np.int64))
                    gap = base[i : i + block, None] - base[None, j : j + block]
                    for k in range(a.shape[1]):
                        total[k] += (np.abs(a[:, k, None] - b + gap[k]) - np.abs(gap[k])).sum(axis=0)
                    if sum(x.size for x in far.values()) >= cells:
                        yield from done()

        def done() -> Iterator[pa.RecordBatch]:
            while far:
                (lang, i, j), total = far.popitem()
                a, b = np.indices(total.shape)
                some = a + i < b + j
                columns = [(a + i)[some], (b + j)[some], total[some]]
                language = pa.array([lang] * len(columns[0]), pa.string())
                yield pa.RecordBatch.from_arrays([language, *map(pa.array, columns)], ["lang", "a", "b", "far"])

        for batch in batches:
            for row in batch.to_pylist():
                base = bases.setdefault(row["lang"], np.array(row["bases"], np.int64))
                rows = waiting.setdefault(row["lang"], [])
                rows.append(row["held"])
                if len(rows) * len(base) >= cells:
                    yield from count(row["lang"])
        for lang in list(waiting):
            yield from count(lang)
        yield from done()

    found = terms.select("lang", "held", "bases").mapInArrow(add, "lang string, a long, b long, far long")
    return found.groupBy("lang", "a", "b").agg(F.sum("far").alias("far"))


def source_divergence(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, shown: int = TERMS_SHOWN, size: int = SLICE
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair`` has every two sources of a language, both ways round, and the sum of the
    differences of their terms' shares.  Part ``term`` has the ``shown`` terms of a source
    that are most above their share in the language.  Ranks count from 1 by value,
    descending, then by item.  Null languages, sources and texts count as empty; repeated
    rows count as often as they occur; other columns are ignored, whatever their names; a
    language without kept terms has pairs of value 0, one of a single source none; no rows
    give no rows.
    """
    counts = settle(source_terms(docs, size))
    kept = settle(kept_terms(counts, least))
    languages = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("all_n"))
    in_source = counts.where("term is not null").join(kept.withColumnRenamed("n", "lang_n"), ["lang", "term"])
    in_source = settle(in_source.select("lang", "source", "term", "n", "lang_n"))
    totals = in_source.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
    groups = groups.join(languages, "lang", "left").na.fill(0, ["total", "terms", "all_n"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    base = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0))
    groups = settle(groups.withColumns({"number": number.cast("long"), "base": base}))

    shares = in_source.join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("all_n"), F.col("terms"))
    shares = shares.withColumns({"p": p, "q": q})

    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("number", "p")).alias("held"))
    bases = groups.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("number", "base"))), lambda x: x["base"]).alias("bases")
    )
    far = _distances(held.join(bases, "lang"))
    # every two sources, with what they differ by in terms that neither has
    a, b = (groups.select("lang", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "number", "base", "terms"))) for s in "ab")
    pairs = a.join(b.drop("terms_b"), "lang").where("number_a < number_b")
    far = far.select("lang", F.col("a").alias("number_a"), F.col("b").alias("number_b"), "far")
    pairs = pairs.join(far, ["lang", "number_a", "number_b"], "left")
    value = F.coalesce("far", F.lit(0)) + F.abs(F.col("base_a") - F.col("base_b")) * F.col("terms_a")
    both = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                             F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    pairs = pairs.select("lang", both.alias("ends"), value.cast("long").alias("value"))
    pairs = pairs.select("lang", "ends.source", F.lit("pair").alias("part"), "ends.item", "value")

    in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    ranked = [t.withColumn("rank", F.row_number().over(in_order)) for t in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= shown))
