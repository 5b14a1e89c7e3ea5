"""Term counts and TF-IDF, for any number of windows in one job."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from storyweave.functions.text import Tokenizer, tokenise
from storyweave.operators.windows import RUN, Panes
from storyweave.session import staged

WINDOW_ROWS = 1_000_000  # term counts of a window that one task may hold
STRETCH_ROWS = 2_000_000  # term counts of neighbouring windows that one task may hold
STRETCH_SIZES = 4  # so many sizes of a window a stretch of windows is long, where a task may hold that
PACK_ROWS = 65_536  # term counts that are packed by article together


def term_counts(docs: DataFrame, tokens: Tokenizer = tokenise,
                runtime: datetime | Column | None = None) -> DataFrame:
    """``(article_id, term, count, added_at)``; rows keep their own ``added_at`` unless ``runtime`` is given.

    The tokens of an article in one row are counted there, as runs of the sorted tokens, and nothing is shuffled; only
    articles of several rows go through an aggregate.
    """
    at = F.col("added_at") if runtime is None else F.lit(runtime).cast("timestamp")
    rows = docs.select("article_id", at.alias("added_at"), "content")
    keys = ["article_id", "added_at"]
    repeated = staged(rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").select(*[F.col(c).alias(f"r_{c}") for c in keys]), "repeated")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys])
    alone = rows.join(repeated, same, "left_anti")
    # inline: the sorted tokens are worked out once, not in each place that names them.
    words = alone.select(*keys, F.inline(F.array(F.struct(F.sort_array(tokens(F.col("content"))).alias("words"))))).filter(F.size("words") > 0)
    last = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: ~F.get("words", i).eqNullSafe(F.get("words", i + 1)))
    runs = words.select(*keys, "words", F.inline(F.array(F.struct(last.alias("last")))))
    counted = F.transform("last", lambda e, i: F.struct(
        F.get("words", e).alias("term"), (e - F.when(i > 0, F.get("last", i - 1)).otherwise(-1)).cast("long").alias("count")))
    counts = runs.select(*keys, F.inline(counted)).select("article_id", "term", "count", "added_at")
    if repeated.isEmpty():
        return counts
    return counts.unionByName(
        rows.join(repeated, same, "left_semi").select(*keys, F.explode(tokens(F.col("content"))).alias("term"))
        .groupBy(*keys, "term").agg(F.count("*").alias("count")).select("article_id", "term", "count", "added_at"))


def article_total(counts: DataFrame) -> DataFrame:
    """n: articles having terms, per window."""
    return (counts.select(*RUN, "article_id").distinct()
            .groupBy(*RUN).agg(F.count("*").alias("n")))


def doc_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*RUN, "term").agg(F.count("*").alias("df"))


def tfidf_vectors(counts: DataFrame) -> DataFrame:
    """``(begin, end, article_id, vector)``: each article's terms with count and unit-norm weight, by term.

    idf = ln((1+n)/(1+df)) + 1 over the window. An article whose counts are all zero keeps zero weights.
    Windows of at most ``WINDOW_ROWS`` term counts are weighed by a task each, larger ones by joins with their frequencies.
    """
    rows = counts.select(*RUN, "article_id", "term", "count")
    sizes = staged(rows.groupBy(*RUN).agg(F.count("*").alias("rows")), "window_rows")
    small, large = [sizes.filter(f).select(*RUN) for f in (f"rows <= {WINDOW_ROWS}", f"rows > {WINDOW_ROWS}")]
    if large.isEmpty():
        return _weighed_in_tasks(rows.join(small, RUN, "left_semi"))
    weighed = _weighed_by_joins(rows.join(large, RUN, "left_semi"))
    return weighed if small.isEmpty() else weighed.unionByName(_weighed_in_tasks(rows.join(small, RUN, "left_semi")))


def _weighed_in_tasks(rows: DataFrame) -> DataFrame:
    """``tfidf_vectors`` of windows that a task holds whole: one shuffle of the rows, none of frequencies."""
    kinds = {f.name: f for f in rows.schema.fields}
    entry = T.StructType([T.StructField("term", kinds["term"].dataType), T.StructField("count", kinds["count"].dataType), T.StructField("weight", T.DoubleType())])
    schema = T.StructType([*[kinds[c] for c in (*RUN, "article_id")], T.StructField("vector", T.ArrayType(entry))])

    def run(window: pa.Table) -> pa.Table:
        bounds = [window.column(c)[0] for c in RUN]
        ids = window.column("article_id").combine_chunks().dictionary_encode(null_encoding="encode")
        n = len(ids.dictionary)
        article, term, count = ids.indices.to_numpy(), window.column("term").combine_chunks(), window.column("count").combine_chunks()
        if term.null_count:
            known = term.is_valid()
            article, term, count = article[known.to_numpy(zero_copy_only=False)], term.filter(known), count.filter(known)
        coded = term.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        code, held = rank[coded.indices.to_numpy()], count.fill_null(0).to_numpy()
        raw = held * (np.log((1 + n) / (1 + np.bincount(code, minlength=len(order))))[code] + 1)
        place = np.lexsort((held, code, article))
        article, code, raw = article[place], code[place], raw[place]
        norm = np.sqrt(np.bincount(article, weights=raw * raw, minlength=n))[article]
        weight = np.divide(raw, norm, out=np.zeros(len(raw)), where=norm > 0)
        starts = np.flatnonzero(np.diff(article, prepend=-1))
        vector = pa.ListArray.from_arrays(pa.array(np.append(starts, len(article)), pa.int32()), pa.StructArray.from_arrays(
            [coded.dictionary.take(pa.array(order)).take(pa.array(code)), count.take(pa.array(place)), pa.array(weight)], names=["term", "count", "weight"]))
        return pa.table([*[pa.repeat(b, len(starts)) for b in bounds], ids.dictionary.take(pa.array(article[starts])), vector],
                        names=[*RUN, "article_id", "vector"])

    return rows.groupBy(*RUN).applyInArrow(run, schema)


def _weighed_by_joins(rows: DataFrame) -> DataFrame:
    """``tfidf_vectors`` of windows of any size. A frequent term is one key of the frequency join; adaptive execution splits its rows."""
    raw = F.col("count") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)
    weighed = (rows.join(doc_frequency(rows), [*RUN, "term"])
               .join(article_total(rows), RUN)
                .select(*RUN, "article_id", "term", "count", raw.alias("weight")))
    gathered = weighed.groupBy(*RUN, "article_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "count", "weight"))).alias("vector"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    scaled = F.transform("vector", lambda e: F.struct(
        e["term"].alias("term"), e["count"].alias("count"),
        F.coalesce(F.try_divide(e["weight"], F.col("norm")), F.lit(0.0)).alias("weight")))
    return gathered.select(*RUN, "article_id", scaled.alias("vector"))


def sliding_tfidf_vectors(counts: DataFrame, size: timedelta, slide: timedelta) -> DataFrame:
    """``tfidf_vectors`` of ``sliding_windows(counts, size, slide)`` without a copy of each term count for every window.

    Neighbouring windows are weighed by one task: term counts are packed by article first and shuffled once, with few copies where
    stretches of windows meet. Stretches of more than ``STRETCH_ROWS`` term counts are weighed by joins.
    """
    panes = Panes(size, slide)
    rows = counts.select("article_id", "term", "count", panes.pane().alias("pane")).filter("pane is not null")
    held = staged(rows.groupBy("pane").agg(F.count("*").alias("rows")), "pane_rows")
    for length in (STRETCH_SIZES * panes.slides, panes.slides):
        stretches = held.select("rows", F.explode(panes.stretches(length)).alias("stretch")).groupBy("stretch").agg(F.sum("rows").alias("rows"))
        large = staged(stretches.filter(F.col("rows") > STRETCH_ROWS).select("stretch"), "large_stretches")
        if large.isEmpty():
            return _sliding_in_tasks(rows, panes, length)
    wide = rows.join(held.select("pane", F.explode(panes.stretches(length)).alias("stretch")).join(large, "stretch").select("pane").distinct(), "pane", "left_semi")
    return _sliding_in_tasks(rows, panes, length, large).unionByName(_sliding_by_joins(wide, panes, length, large))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(article_id, pane, terms, sizes, counts, known)`` of rows that come together: the bytes of their terms one after another, the length of each
    and its count, and which counts are not null where some are."""
    def pack(rows: pa.Table) -> pa.RecordBatch:
        article, pane = rows.column("article_id").combine_chunks(), rows.column("pane").to_numpy()
        code = article.dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.lexsort((code, pane))
        starts = np.flatnonzero((np.diff(pane[order], prepend=pane[order[0]] - 1) != 0) | (np.diff(code[order], prepend=-1) != 0))
        names, pane = article.take(pa.array(order[starts])), pane[order[starts]]
        # An article whose terms are all null counts as one of its window, without a vector.
        term = rows.column("term").combine_chunks().take(pa.array(order))
        named = term.is_valid().to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(named)])[np.append(starts, len(order))]
        term = term.filter(pa.array(named)).cast(pa.large_binary())
        count = rows.column("count").combine_chunks().take(pa.array(order[named]))
        ends, text = np.frombuffer(term.buffers()[1], np.int64, len(term) + 1, 8 * term.offset), term.buffers()[2]
        part = lambda buffer, cuts: pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts.astype(np.int32)), buffer])
        fixed = lambda values: part(pa.py_buffer(np.ascontiguousarray(values)), bounds * values.itemsize)
        known = pa.nulls(len(starts), pa.binary()) if not count.null_count else fixed(count.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))
        return pa.RecordBatch.from_arrays(
            [names, pa.array(pane), part(text, ends[bounds]), fixed(np.diff(ends).astype(np.int32)), fixed(count.fill_null(0).to_numpy()), known],
            names=["article_id", "pane", "terms", "sizes", "counts", "known"])

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= PACK_ROWS:
            yield pack(pa.Table.from_batches(waiting))
            waiting, held = [], 0
    if held:
        yield pack(pa.Table.from_batches(waiting))


def _bytes_of(packs: pa.Table, name: str) -> memoryview:
    """The values of a binary column, one after another."""
    column = packs.column(name).combine_chunks()
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return memoryview(column.buffers()[2] or b"")[ends[0]:ends[-1]]


def _sliding_in_tasks(rows: DataFrame, panes: Panes, length: int, without: DataFrame | None = None) -> DataFrame:
    """``sliding_tfidf_vectors`` of stretches of ``length`` windows that a task holds whole."""
    kinds = {f.name: f for f in rows.schema.fields}
    name, count_kind, k = kinds["article_id"], kinds["count"], panes.slides
    dtype = np.dtype(to_arrow_type(count_kind.dataType).to_pandas_dtype())
    entry = T.StructType([T.StructField("term", kinds["term"].dataType), T.StructField("count", count_kind.dataType), T.StructField("weight", T.DoubleType())])

    def weighed(packs: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = packs.column("article_id").combine_chunks().dictionary_encode(null_encoding="encode")
        article, pane, sizes = ids.indices.to_numpy(), packs.column("pane").to_numpy(), np.frombuffer(_bytes_of(packs, "sizes"), np.int32)
        held = pc.binary_length(packs.column("sizes")).to_numpy() // 4
        # An article's packs of one pane are one article of the window; articles by pane.
        order = np.lexsort((article, pane))
        new = (np.diff(pane[order], prepend=pane[order[0]] - 1) != 0) | (np.diff(article[order], prepend=-1) != 0)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        article, pane = article[order[new]], pane[order[new]]
        terms = pa.Array.from_buffers(pa.large_string(), len(sizes), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])), pa.py_buffer(_bytes_of(packs, "terms"))]).dictionary_encode()
        by_term = pc.sort_indices(terms.dictionary).to_numpy()
        rank = np.empty(len(by_term), np.int64)
        rank[by_term] = np.arange(len(by_term))
        names, code, owner = terms.dictionary.take(pa.array(by_term)).cast(pa.string()), rank[terms.indices.to_numpy()], np.repeat(number, held)
        count = np.frombuffer(_bytes_of(packs, "counts"), dtype)
        known = np.ones(len(count), bool)
        if packs.column("known").null_count < packs.num_rows:
            known = np.concatenate([np.ones(n, bool) if k is None else np.frombuffer(k, np.uint8) > 0 for k, n in zip(packs.column("known").to_pylist(), held)])
        place = np.lexsort((count, known, code, owner))
        code, owner, count, known = code[place], owner[place], count[place], known[place]
        starts = np.searchsorted(owner, np.arange(len(pane) + 1))
        # A null count leaves all weights of its article at zero.
        factor = np.where(known, count, np.nan)
        stretch = packs.column("stretch")[0].as_py()
        for end in range(stretch * length, (stretch + 1) * length):
            lo, hi = np.searchsorted(pane, 2 * (end - k), "left"), np.searchsorted(pane, 2 * end, "right")
            first, last = starts[lo], starts[hi]
            if first == last:
                continue
            mine, own = code[first:last], owner[first:last] - lo
            raw = factor[first:last] * (np.log((1 + (hi - lo)) / (1 + np.bincount(mine)))[mine] + 1)
            norm = np.sqrt(np.bincount(own, weights=raw * raw))[own]
            weight = np.divide(raw, norm, out=np.zeros(len(raw)), where=norm > 0)
            some = np.flatnonzero(np.diff(starts[lo:hi + 1]))
            vector = pa.ListArray.from_arrays(pa.array(np.append(starts[lo:hi][some], last) - first, pa.int32()), pa.StructArray.from_arrays(
                [names.take(pa.array(mine)), pa.array(count[first:last], mask=~known[first:last]), pa.array(weight)], names=["term", "count", "weight"]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), end)), ids.dictionary.take(pa.array(article[lo:hi][some])), vector],
                                             names=["nth", "article_id", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last stretch of a batch may go on in the next one.
        held = []
        for batch in batches:
            stretch = batch.column("stretch").to_numpy()
            cuts = np.flatnonzero(np.diff(stretch)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(stretch)]):
                if at < to and held and held[0].column("stretch")[0].as_py() != stretch[at]:
                    yield from weighed(pa.Table.from_batches(held))
                    held = []
                if at < to:
                    held.append(batch.slice(at, to - at))
        if held:
            yield from weighed(pa.Table.from_batches(held))

    packs = rows.mapInArrow(_packed, T.StructType([name, T.StructField("pane", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("terms", "sizes", "counts", "known")]]))
    dealt = packs.withColumn("stretch", F.explode(panes.stretches(length)))
    if without is not None:
        dealt = dealt.join(without, "stretch", "left_anti")
    found = dealt.repartition("stretch").sortWithinPartitions("stretch").mapInArrow(
        run, T.StructType([T.StructField("nth", T.LongType()), name, T.StructField("vector", T.ArrayType(entry))]))
    return found.select(*panes.bounds(F.col("nth")), "article_id", "vector")


def _sliding_by_joins(rows: DataFrame, panes: Panes, length: int, stretches: DataFrame) -> DataFrame:
    """``sliding_tfidf_vectors`` of the windows in ``stretches`` of ``length``, of any size.

    Frequencies and totals are counted once per pane; a window's are differences of their running sums. A term count meets the
    frequencies of all its windows in one array, and only an article's finished vector is written out for each window.
    """
    held = panes.sums(rows.filter("term is not null").groupBy(F.col("term").alias("key"), "pane").agg(F.count("*").alias("n")))
    articles = rows.select("article_id", "pane").distinct().groupBy("pane").agg(F.count("*").alias("n"))
    totals = panes.sums(articles.withColumn("key", F.lit(0))).select("pane", F.col("sums").alias("totals"))
    gathered = (rows.join(held.select(F.col("key").alias("term"), "pane", F.col("sums").alias("dfs")), ["term", "pane"])
                .groupBy("article_id", "pane").agg(F.sort_array(F.collect_list(F.struct("term", "count", "dfs"))).alias("entries")))
    of_window = (gathered.join(totals, "pane").select("article_id", "entries", panes.first_end().alias("first"), F.posexplode("totals").alias("nth", "n"))
                 .withColumn("stretch", F.floor((F.col("first") + F.col("nth")) / length).cast("long")).join(F.broadcast(stretches), "stretch", "left_semi")
                 .select("article_id", "entries", "nth", "n", *panes.bounds(F.col("first") + F.col("nth"))))
    raw = F.transform("entries", lambda e: F.struct(
        e["term"].alias("term"), e["count"].alias("count"),
        (e["count"] * (F.log((1 + F.col("n")) / (1 + F.get(e["dfs"], F.col("nth")))) + 1)).alias("weight")))
    weighed = of_window.select(*RUN, "article_id", F.inline(F.array(F.struct(raw.alias("raw")))))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"]))
    normed = weighed.select(*RUN, "article_id", F.inline(F.array(F.struct("raw", norm.alias("norm")))))
    scaled = F.transform("raw", lambda e: F.struct(
        e["term"].alias("term"), e["count"].alias("count"), F.coalesce(F.try_divide(e["weight"], F.col("norm")), F.lit(0.0)).alias("weight")))
    return normed.select(*RUN, "article_id", scaled.alias("vector"))


def explode_vectors(vectors: DataFrame) -> DataFrame:
    """``(begin, end, article_id, term, count, weight)``."""
    return vectors.select(*RUN, "article_id", F.inline("vector"))


def tfidf(counts: DataFrame) -> DataFrame:
    return explode_vectors(tfidf_vectors(counts)).drop("count")
