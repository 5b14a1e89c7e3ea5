"""Exact cosine self-join of TF-IDF vectors, per window.

Equal vectors are first collapsed to one representative, so a group of copies costs one row. The representatives of a window
are dealt into blocks of bounded size by their heaviest term, and block is multiplied with block inside tasks, so no list of pairs sharing
a term ever exists. A window whose blocks together are no more than one block at the default limits goes to a task whole, which deals
its blocks itself. The blocks of larger windows are stored once in the shared folder, and each task reads those that it compares, so what is shuffled
and written grows with the articles and not with the pairs of blocks. A block is summed up by its largest weight of every term, and only those of another's
articles are multiplied whose product with these weights, which none of the block's articles exceeds, reaches the threshold. Only
pairs that reach the threshold leave a task, or fewer still where the caller needs just connectivity or counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.operators.windows import RUN, Panes
from storyweave.session import staged

SLACK = 1e-9
DIGITS = 9
STRIP = 8  # blocks that a task compares a block with, one after another
MOST_TASKS = 4096  # beyond which a task has several strips
STRETCH_ROWS = 2_000_000  # term counts of neighbouring windows that one task may hold
TASK_BLOCKS = 64  # small blocks of one window that a task may hold together
_LOOSE = 1e-4  # what single precision may take from a bound, many times over


@dataclass(frozen=True)
class Limits:
    """Sizes that bound the work of one task; none of them changes a result."""

    block_postings: int = 1_000_000
    block_articles: int = 8192

    def blocks(self, postings: Column, articles: Column) -> Column:
        """How many blocks to cut so many articles with so many postings into."""
        return F.greatest(F.ceil(postings / self.block_postings), F.ceil(articles / self.block_articles), F.lit(1)).cast("int")


@dataclass(frozen=True)
class Corpus:
    """``members(begin, end, article_id, rep)`` and ``reps(begin, end, article_id, copies, vector)``."""

    members: DataFrame
    reps: DataFrame


def collapse_copies(vectors: DataFrame) -> Corpus:
    """One representative, the smallest article, per group of equal count vectors (told by a 128-bit hash)."""
    counts = F.transform("vector", lambda e: F.struct(e["term"].alias("term"), e["count"].alias("count")))
    # A vector of zeros is near nothing, its copies included, so it stays alone.
    alone = F.when(~F.exists("vector", lambda e: e["weight"] > 0), F.col("article_id"))
    signature = F.struct(F.xxhash64(F.lit(1), counts).alias("h1"), F.xxhash64(F.lit(2), counts).alias("h2"),
                         alone.alias("alone"))
    signed = staged(vectors.withColumn("signature", signature), "vectors")
    # Only groups of several articles are looked up, so that no vector has to be shuffled by its signature.
    groups = staged(signed.groupBy(*RUN, "signature").agg(F.min("article_id").alias("rep"), F.count("*").alias("copies")).filter("copies > 1"), "copies")
    members = signed.select(*RUN, "article_id", "signature").join(groups.withColumn("copied", F.lit(True)), [*RUN, "signature"], "left").select(
        *RUN, "article_id", F.when(F.col("copied"), F.col("rep")).otherwise(F.col("article_id")).alias("rep"))
    alone = signed.join(groups, [*RUN, "signature"], "left_anti").select(*RUN, "article_id", F.lit(1).cast("long").alias("copies"), "vector")
    first = (signed.join(groups, [*RUN, "signature"]).filter(F.col("article_id").eqNullSafe(F.col("rep")))
             .groupBy(*RUN, "signature", "article_id", "copies").agg(F.first("vector").alias("vector")).drop("signature"))
    # An article without a number is near nothing.
    vector = F.when(F.col("article_id").isNotNull(), F.col("vector")).alias("vector")
    return Corpus(staged(members, "members"), alone.unionByName(first).select(*RUN, "article_id", "copies", vector))


def copy_edges(corpus: Corpus) -> DataFrame:
    """Each copy tied to its representative, cosine 1."""
    return corpus.members.filter("article_id <> rep").select(
        *RUN, F.col("rep").alias("a"), F.col("article_id").alias("b"), F.lit(1.0).alias("cosine"))


def similar_pairs(vectors: DataFrame, threshold: float, limits: Limits = Limits()) -> DataFrame:
    """``(begin, end, a, b, cosine)``, a < b: all pairs of different vectors reaching the threshold, and each
    copy tied to its representative."""
    corpus = collapse_copies(vectors)
    return edges(corpus.reps, threshold, "pairs", limits).unionByName(copy_edges(corpus))


def edges(reps: DataFrame, threshold: float, keep: str = "pairs", limits: Limits = Limits()) -> DataFrame:
    """Pairs of representatives with cosine >= threshold.

    ``keep="pairs"`` gives all of them, ``"forest"`` enough of them to have the same components at the
    threshold and at every higher one. With a boolean column ``core`` in ``reps``, a forest is taken among core
    articles only; pairs with another article are all kept, and those without any core one dropped.
    """
    return _block_pairs(reps, threshold, keep, limits)


def degrees(reps: DataFrame, threshold: float, limits: Limits = Limits()) -> DataFrame:
    """``(begin, end, article_id, neighbours)``: articles, copies counted, within the threshold of each
    representative other than its own copies; representatives without any are absent."""
    return (_block_pairs(reps, threshold, "degree", limits).groupBy(*RUN, "article_id")
            .agg(F.sum("neighbours").alias("neighbours")))


def pair_dots(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(begin, end, a, b, dot)`` of the listed pairs; pairs without a common term are absent."""
    def end(name: str) -> DataFrame:
        entries = F.transform("vector", lambda e: F.struct(e["term"].alias("term"), e["weight"].alias("weight")))
        return vectors.select(*RUN, F.col("article_id").alias(name), entries.alias(f"{name}_vector"))

    return (pairs.select(*RUN, "a", "b").join(end("a"), [*RUN, "a"]).join(end("b"), [*RUN, "b"])
            .select(*RUN, "a", "b", F.inline(F.concat("a_vector", "b_vector")))
            .groupBy(*RUN, "a", "b", "term").agg(F.count("*").alias("held"), F.product("weight").alias("part"))
            .filter("held = 2").groupBy(*RUN, "a", "b").agg(F.sum("part").alias("dot")))


def _block_pairs(reps: DataFrame, threshold: float, keep: str, limits: Limits) -> DataFrame:
    """Block against block. A threshold of 0 or less means any cosine above 0, as an article shares nothing with most."""
    held = _held(reps)
    if "core" not in held.columns:
        held = held.withColumn("core", F.lit(True))
    kind = reps.schema["article_id"].dataType
    run = [T.StructField(c, reps.schema[c].dataType) for c in RUN]
    if keep == "degree":
        schema = T.StructType([*run, T.StructField("article_id", kind), T.StructField("neighbours", T.LongType())])
    else:
        schema = T.StructType([*run, T.StructField("a", kind), T.StructField("b", kind),
                               T.StructField("cosine", T.DoubleType())])
    windows = _windows(held, limits)
    spread = windows.filter("not whole").select(*RUN)
    whole, wide = held.join(windows.filter("whole").select(*RUN), RUN, "left_semi"), None if spread.isEmpty() else held.join(spread, RUN, "left_semi")
    found = _together(whole).groupBy(*RUN).applyInArrow(_multiply(threshold, keep, limits), schema)
    if wide is not None:
        strips = _strips(_placed(wide, limits))
        # As many tasks as strips, which adaptive execution would put together by their few bytes.
        found = found.unionByName(strips.repartition(min(max(strips.count(), 1), MOST_TASKS)).mapInArrow(_multiply_strip(threshold, keep, limits), schema))
    if keep == "degree":
        return found
    return found.select(*RUN, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")


def _held(reps: DataFrame) -> DataFrame:
    held = reps.withColumn("vector", F.filter("vector", lambda e: e["weight"] > 0)).filter(F.size("vector") > 0)
    return held if "copies" in held.columns else held.withColumn("copies", F.lit(1).cast("long"))


def dense_edges(reps: DataFrame, threshold: float, least: int, limits: Limits = Limits()) -> DataFrame:
    """``(begin, end, a, b, a_core, b_core, cosine)``: the pairs that ``edges`` keeps as a forest among core articles, and a row of each core
    article with itself, without a cosine.

    A core article has ``least`` articles within the threshold, itself and copies counted. Windows that a task holds whole are counted and
    linked there, from one shuffle of their vectors; of others densities come first, and vectors go out again with what they tell.
    """
    held = _held(reps)
    windows = _windows(held, limits)
    kind = reps.schema["article_id"].dataType
    schema = T.StructType([*[T.StructField(c, reps.schema[c].dataType) for c in RUN], T.StructField("a", kind), T.StructField("b", kind),
                           T.StructField("a_core", T.BooleanType()), T.StructField("b_core", T.BooleanType()), T.StructField("cosine", T.DoubleType())])
    together = _together(held.join(windows.filter("whole").select(*RUN), RUN, "left_semi").withColumn("core", F.lit(True)))
    found = together.groupBy(*RUN).applyInArrow(_multiply(threshold, "dense", limits, least), schema)
    # Articles without a weight are near nothing; their copies make them core all the same.
    empty = ~F.coalesce(F.exists("vector", lambda e: e["weight"] > 0), F.lit(False))
    lone = lambda core: core.select(*RUN, F.col("article_id").alias("a"), F.col("article_id").alias("b"), F.lit(True).alias("a_core"),
                                    F.lit(True).alias("b_core"), F.lit(None).cast("double").alias("cosine"))
    found = found.unionByName(lone(reps.filter(empty & (F.col("copies") >= least))))
    spread = windows.filter("not whole").select(*RUN)
    if spread.isEmpty():
        return found
    wide = held.join(spread, RUN, "left_semi")
    near = staged(degrees(wide, threshold, limits), "near")  # of known size, so it may be broadcast
    flagged = staged(wide.join(near, [*RUN, "article_id"], "left")
                     .withColumn("core", F.col("copies") + F.coalesce("neighbours", F.lit(0)) >= least).drop("neighbours"), "cores")
    core = flagged.filter("core").select(*RUN, "article_id")
    told = edges(flagged, threshold, "forest", limits)
    for side in "ab":
        told = told.join(core.select(*RUN, F.col("article_id").alias(side), F.lit(True).alias(f"{side}_core")), [*RUN, side], "left").fillna(False, [f"{side}_core"])
    return found.unionByName(told).unionByName(lone(core))


def block_copies(reps: DataFrame, threshold: float, limits: Limits = Limits()) -> DataFrame:
    """``(begin, end, lo, hi, block, article_id)``: which pairs of blocks each article is compared in, for measuring; the
    bound on its products is taken in the task."""
    held = _held(reps).withColumn("core", F.lit(True))
    windows = _windows(held, limits)
    none = F.lit(0).cast("bigint")
    whole = held.join(windows.filter("whole").select(*RUN), RUN, "left_semi").select(*RUN, none.alias("lo"), none.alias("hi"), none.alias("block"), "article_id")
    placed = _placed(held.join(windows.filter("not whole").select(*RUN), RUN, "left_semi"), limits)
    blocks = placed.select(*RUN, F.col("block").alias("other")).distinct()
    return whole.unionByName(placed.join(blocks, RUN).select(
        *RUN, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "article_id"))


def _dealt(held: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """``(articles, cuts)``: articles with ``lead``, their heaviest term, and for each lead its bin and the pieces this is cut into.

    Leads of few articles share a bin; a bin or lead beyond the limits is cut by the article's hash. One row per lead, not per article.
    """
    heaviest = F.array_max(F.transform("vector", lambda e: F.struct(F.round(e["weight"], DIGITS).alias("w"), e["term"].alias("t"))))["t"]
    led = held.withColumn("lead", heaviest)
    leads = led.groupBy(*RUN, "lead").agg(F.sum(F.size("vector")).alias("postings"), F.count("*").alias("n"))
    leads = leads.withColumn("pieces", limits.blocks(F.col("postings"), F.col("n")))
    few = F.col("pieces") == 1
    bins = leads.groupBy(*RUN).agg(limits.blocks(F.coalesce(F.sum(F.when(few, F.col("postings"))), F.lit(0)),
                                                 F.coalesce(F.sum(F.when(few, F.col("n"))), F.lit(0))).alias("bins"))
    hashed = F.xxhash64("lead")
    binned = leads.join(bins, RUN).withColumn("bin", F.when(few, F.pmod(hashed, F.col("bins"))).otherwise(hashed))
    sizes = binned.groupBy(*RUN, "bin").agg(limits.blocks(F.sum("postings"), F.sum("n")).alias("pieces"))
    return led, binned.select(*RUN, "lead", "bin").join(sizes, [*RUN, "bin"])


def _windows(held: DataFrame, limits: Limits) -> DataFrame:
    """``(begin, end, whole)``: the windows, told whether a task holds them whole."""
    room, few = Limits(), F.ceil(F.col("postings") / limits.block_postings) + F.ceil(F.col("n") / limits.block_articles) <= TASK_BLOCKS
    whole = (limits.blocks(F.col("postings"), F.col("n")) == 1) | ((room.blocks(F.col("postings"), F.col("n")) == 1) & few)
    return staged(held.groupBy(*RUN).agg(F.sum(F.size("vector")).alias("postings"), F.count("*").alias("n")).select(*RUN, whole.alias("whole")), "windows")


_COLUMNS = ["article_id", "copies", "core", "terms", "weights"]


def _parted(held: DataFrame) -> DataFrame:
    return held.withColumns({"terms": F.transform("vector", lambda e: e["term"]), "weights": F.transform("vector", lambda e: e["weight"])})


def _together(held: DataFrame) -> DataFrame:
    """Windows that a task holds whole."""
    return _parted(held).select(*RUN, *_COLUMNS)


def _placed(held: DataFrame, limits: Limits) -> DataFrame:
    """The articles of windows that are dealt over tasks, with their block; each block is stored in a folder of its own, once."""
    led, cuts = _dealt(held, limits)
    piece = F.pmod(F.xxhash64(F.lit(1), "article_id"), F.col("pieces"))
    # Blocks are named by a hash; two of one name would be one block, which changes no result.
    placed = _parted(led).join(staged(cuts, "cuts"), [*RUN, "lead"]).withColumn("block", F.xxhash64("bin", piece)).select(*RUN, "block", *_COLUMNS)
    return staged(placed.withColumn("part", F.xxhash64(*RUN, "block")).repartition("part"), "placed", "part")


def _strips(placed: DataFrame) -> DataFrame:
    """``(begin, end, lo, files, others)``: each block with the files of up to about ``STRIP`` blocks it is compared with, so that every pair
    of a window's blocks comes once, a block with itself too."""
    blocks = staged(placed.select(*RUN, "block", F.input_file_name().alias("file")).distinct()
                    .groupBy(*RUN, "block").agg(F.sort_array(F.collect_list("file")).alias("files")), "blocks")
    strips = blocks.groupBy(*RUN).agg(F.ceil(F.count("*") / STRIP).cast("int").alias("strips"))
    other = blocks.select(*RUN, F.col("block").alias("hi"), F.col("files").alias("hi_files"))
    pairs = blocks.withColumnRenamed("block", "lo").join(strips, RUN).join(other, RUN).filter("lo <= hi")
    return staged(pairs.groupBy(*RUN, "lo", "files", F.pmod(F.xxhash64("hi"), F.col("strips")).alias("strip"))
                  .agg(F.collect_list(F.struct("hi", "hi_files")).alias("others")).drop("strip"), "strips")


def _multiply_strip(threshold: float, keep: str, limits: Limits):
    """The task of one block and those it is compared with, read one after another from where they are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                begin, end, lo, files, others = (batch.column(c)[at] for c in (*RUN, "lo", "files", "others"))
                left = _read_block(files.as_py(), begin, end, lo)
                for other in others:
                    hi = other["hi"]
                    alone = hi.as_py() == lo.as_py()
                    both = left if alone else pa.concat_tables([left, _read_block(other["hi_files"].as_py(), begin, end, hi)])
                    split = None if alone else left.num_rows
                    yield from _compared(both, begin, end, split, threshold, keep, limits).to_batches()

    return run


def _read_block(files: list[str], begin: pa.Scalar, end: pa.Scalar, block: pa.Scalar) -> pa.Table:
    """The articles of one block from its files in the shared folder."""
    from pyarrow import fs, parquet

    parts = []
    for uri in files:
        system, place = fs.FileSystem.from_uri(uri)
        part = parquet.read_table(place, filesystem=system, columns=[*RUN, "block", *_COLUMNS], partitioning=None)
        for name, value in zip((*RUN, "block"), (begin, end, block)):  # a folder may hold two blocks whose names' hashes are equal
            part = part.filter(pc.equal(part.column(name), value.cast(part.schema.field(name).type)))
        parts.append(part.select(_COLUMNS))
    return pa.concat_tables(parts)


def _blocks_in_task(codes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, limits: Limits) -> list[np.ndarray]:
    """A whole window's articles, by their heaviest term, in blocks within the limits; an article beyond them is a block of its own."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    lead = codes[np.lexsort((-weights, owner))[offsets[:-1]]]
    order = np.argsort(lead, kind="stable")
    blocks, start, postings = [], 0, 0
    for at, size in enumerate(np.diff(offsets)[order].tolist()):
        if at > start and (postings + size > limits.block_postings or at - start == limits.block_articles):
            blocks.append(np.sort(order[start:at]))
            start, postings = at, 0
        postings += size
    return [*blocks, np.sort(order[start:])]


def _pairs_in_task(codes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, limits: Limits) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """All block pairs of a whole window, each told whether it is a block with itself."""
    blocks = _blocks_in_task(codes, weights, offsets, limits)
    return [(left, right, left is right) for i, right in enumerate(blocks) for left in blocks[:i + 1]]


def _products(pairs: list[tuple[np.ndarray, np.ndarray, bool]], codes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, core: np.ndarray,
              copies: np.ndarray, threshold: float, keep: str) -> _Collector:
    """What block pairs hold over the threshold."""
    owner = np.repeat(np.arange(len(core)), np.diff(offsets))
    n_terms = int(codes.max(initial=-1)) + 1
    out = _Collector(len(core), core, copies, keep)
    lists = None
    for left, right, diagonal in pairs:
        if lists is None or lists[0] is not right:
            lists = right, *_inverted(right, owner, codes, weights, n_terms)
        _, list_rows, list_weights, starts, tops = lists
        for row in left if diagonal else _admitted(left, tops, codes, weights, offsets, threshold):
            mine = codes[offsets[row]:offsets[row + 1]]
            spans = starts[mine + 1] - starts[mine]
            total = int(spans.sum())
            if not total:
                continue
            shift = np.concatenate([[0], np.cumsum(spans)[:-1]])
            index = np.repeat(starts[mine] - shift, spans) + np.arange(total)
            factor = np.repeat(weights[offsets[row]:offsets[row + 1]], spans)
            scores = np.bincount(list_rows[index], weights=list_weights[index] * factor, minlength=len(right))
            hits = np.flatnonzero((scores >= threshold - SLACK) & (scores > 0))
            cosine = np.round(scores[hits], DIGITS)
            partner = right[hits]
            good = cosine >= threshold
            if diagonal:
                good &= partner > row
            out.add(row, partner[good], cosine[good])
    return out


def sliding_links(counts: DataFrame, panes: Panes, threshold: float, limits: Limits = Limits()) -> DataFrame | None:
    """``(begin, end, a, b, cosine)`` of the windows of ``panes`` over ``counts(article_id, term, count, added_at)``: a forest of the pairs reaching
    the threshold among representatives, and each article ``b`` with its representative ``a`` and no cosine.

    A task holds as many neighbouring windows as a size has slides, so a term count is shuffled twice at most, not once for each window, and no
    vector leaves its task. None where any such stretch has more term counts than a task may hold.
    """
    k, step = panes.slides, panes.slide // timedelta(microseconds=1)
    rows = counts.select("article_id", "term", "count", panes.pane().alias("pane"))
    last = F.floor(F.col("pane") / 2).cast("long") + k
    rows = rows.withColumn("stretch", F.explode(F.sequence(F.floor(panes.first_end() / k).cast("long"), F.floor(last / k).cast("long"))))
    if not staged(rows.groupBy("stretch").agg(F.count("*").alias("rows")).filter(F.col("rows") > STRETCH_ROWS), "stretches").isEmpty():
        return None
    kind = counts.schema["article_id"].dataType
    schema = T.StructType([T.StructField("end", T.LongType()), T.StructField("a", kind), T.StructField("b", kind), T.StructField("cosine", T.DoubleType())])

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        stretch, ids = group.column("stretch")[0].as_py(), group.column("article_id").combine_chunks().dictionary_encode(null_encoding="encode")
        by_id = pc.sort_indices(ids.dictionary).to_numpy()  # null last
        rank = np.empty(len(by_id), np.int64)
        rank[by_id] = np.arange(len(by_id))
        article, pane = rank[ids.indices.to_numpy()], group.column("pane").to_numpy()
        names = ids.dictionary.take(pa.array(by_id))
        codes = group.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        count = group.column("count").to_numpy()
        place = np.lexsort((count, codes, article, pane))
        article, pane, codes, count = article[place], pane[place], codes[place], count[place]
        starts = np.flatnonzero((np.diff(pane, prepend=pane[0] - 1) != 0) | (np.diff(article, prepend=-1) != 0))
        offsets = np.append(starts, len(codes))
        article, pane = article[starts], pane[starts]
        alike: dict[tuple, int] = {}
        empty = np.maximum.reduceat(count, starts) <= 0
        sign = np.array([alike.setdefault((codes[i:j].tobytes(), count[i:j].tobytes(), int(article[d]) if empty[d] else -1), len(alike))
                         for d, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist()))])
        unnamed = len(names) - 1 if names.null_count else len(names)
        ends, of_a, of_b, cosines = [], [], [], []
        for end in range(stretch * k, stretch * k + k):
            lo, hi = np.searchsorted(pane, 2 * (end - k), "left"), np.searchsorted(pane, 2 * end, "right")
            if lo == hi:
                continue
            cut, sizes = slice(offsets[lo], offsets[hi]), np.diff(offsets[lo:hi + 1])
            mine, owner = codes[cut], np.repeat(np.arange(hi - lo), sizes)
            raw = count[cut] * (np.log((1 + (hi - lo)) / (1 + np.bincount(mine)))[mine] + 1)
            norm = np.sqrt(np.bincount(owner, weights=raw * raw))[owner]
            weight = np.divide(raw, norm, out=np.zeros(len(raw)), where=norm > 0)
            order = np.lexsort((article[lo:hi], sign[lo:hi]))
            new = np.flatnonzero(np.diff(sign[lo:hi][order], prepend=-1))
            first = np.repeat(order[new], np.diff(np.append(new, hi - lo)))
            reps = np.zeros(hi - lo, bool)
            reps[order[new]] = True
            reps &= (article[lo:hi] != unnamed) & ~empty[lo:hi]
            used = reps[owner] & (weight > 0)
            rows_of, local = np.flatnonzero(reps), np.append(0, np.cumsum(np.bincount(owner[used], minlength=hi - lo)[reps]))
            a, b, w = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if len(rows_of):
                _, dense = np.unique(mine[used], return_inverse=True)
                ones = np.ones(len(rows_of), bool)
                out = _products(_pairs_in_task(dense, weight[used], local, limits), dense, weight[used], local, ones, ones, threshold, "forest")
                out._thin()
                a, b, w = out._edges()
                a, b = article[lo + rows_of[a]], article[lo + rows_of[b]]
            of_a += [np.minimum(a, b), article[lo + first]]
            of_b += [np.maximum(a, b), article[lo + order]]
            cosines += [w, np.full(hi - lo, np.nan)]
            ends.append(np.full(len(a) + hi - lo, end * step))
        gather = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table([pa.array(gather(ends, np.int64), pa.int64()), names.take(pa.array(gather(of_a, np.int64), pa.int64())),
                         names.take(pa.array(gather(of_b, np.int64), pa.int64())), pa.array(gather(cosines, float), pa.float64(), from_pandas=True)],
                        names=["end", "a", "b", "cosine"])

    found = rows.filter("term is not null").groupBy("stretch").applyInArrow(run, schema)
    bounds = [F.timestamp_micros(F.col("end") - panes.slides * step).alias("begin"), F.timestamp_micros("end").alias("end")]
    return staged(found.select(*bounds, "a", "b", "cosine"), "links")


def _multiply(threshold: float, keep: str, limits: Limits, least: int = 0):
    """The task of a whole window."""

    def run(window: pa.Table) -> pa.Table:
        begin, end = (window.column(c)[0] for c in RUN)
        return _compared(window, begin, end, None, threshold, keep, limits, least)

    return run


def _compared(articles: pa.Table, begin: pa.Scalar, end: pa.Scalar, split: int | None, threshold: float, keep: str, limits: Limits, least: int = 0) -> pa.Table:
    """All block pairs of the articles, or the first ``split`` of them, one block, against the others: rows against inverted lists."""
    articles = articles.combine_chunks()
    ids = articles.column("article_id")
    core = articles.column("core").to_numpy()
    copies = articles.column("copies").to_numpy()
    terms = articles.column("terms").combine_chunks()
    codes = pa.array(terms.flatten()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    weights = articles.column("weights").combine_chunks().flatten().to_numpy()
    offsets = np.concatenate([[0], np.cumsum(np.diff(terms.offsets.to_numpy()))])
    if split is None:
        pairs = _pairs_in_task(codes, weights, offsets, limits)
    else:
        pairs = [(np.arange(split), np.arange(split, len(core)), False)]
    products = lambda core, keep: _products(pairs, codes, weights, offsets, core, copies, threshold, keep)
    if keep == "dense":
        core = products(core, "degree").neighbours + copies >= least
        columns = products(core, "forest").told(ids)
    else:
        columns = products(core, keep).result(ids)
    size = len(next(iter(columns.values())))
    head = {"begin": pa.array([begin.as_py()] * size, begin.type), "end": pa.array([end.as_py()] * size, end.type)}
    return pa.table({**head, **columns})


def _inverted(right: np.ndarray, owner: np.ndarray, codes: np.ndarray, weights: np.ndarray, n_terms: int) -> tuple[np.ndarray, ...]:
    """A block's postings ordered by term, addressed by starts, and its largest weight of every term."""
    place = np.full(int(owner.max(initial=-1)) + 1, -1)
    place[right] = np.arange(len(right))
    mine = np.flatnonzero(place[owner] >= 0)
    order = mine[np.argsort(codes[mine], kind="stable")]
    counts = np.bincount(codes[order], minlength=n_terms)
    tops = np.zeros(n_terms)
    np.maximum.at(tops, codes[order], weights[order])
    return place[owner[order]], weights[order], np.concatenate([[0], np.cumsum(counts)]), tops


def _admitted(left: np.ndarray, tops: np.ndarray, codes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, threshold: float) -> np.ndarray:
    """The articles whose product with the other block's largest weights reaches the threshold."""
    sizes = offsets[left + 1] - offsets[left]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    index = np.repeat(offsets[left] - starts, sizes) + np.arange(int(sizes.sum()))
    return left[np.add.reduceat(weights[index] * tops[codes[index]], starts) >= threshold - _LOOSE] if len(left) else left


class _Collector:
    """Pairs found in one block pair, thinned to what the caller keeps."""

    def __init__(self, n: int, core: np.ndarray, copies: np.ndarray, keep: str):
        self.n, self.core, self.copies, self.keep = n, core, copies, keep
        self.limit = max(200_000, 4 * n)
        self.neighbours = np.zeros(n, dtype=np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, row: int, partners: np.ndarray, cosine: np.ndarray) -> None:
        if not len(partners):
            return
        if self.keep == "degree":
            self.neighbours[row] += self.copies[partners].sum()
            self.neighbours[partners] += self.copies[row]
            return
        wanted = self.core[partners] | self.core[row]
        partners, cosine = partners[wanted], cosine[wanted]
        self.parts.append((np.full(len(partners), row), partners, cosine))
        self.held += len(partners)
        if self.keep == "forest" and self.held > self.limit:
            self._thin()

    def _edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(p) for p in zip(*self.parts))

    def _thin(self) -> None:
        """Of the edges between core articles, keep a maximum spanning forest."""
        a, b, w = self._edges()
        both = self.core[a] & self.core[b]
        parent = list(range(self.n))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        kept = list(np.flatnonzero(~both))
        inner = np.flatnonzero(both)
        for i in inner[np.argsort(-w[inner], kind="stable")].tolist():
            x, y = root(int(a[i])), root(int(b[i]))
            if x != y:
                parent[x] = y
                kept.append(i)
        kept = np.array(sorted(kept), dtype=np.int64)
        self.parts = [(a[kept], b[kept], w[kept])]
        self.held = len(kept)
        self.limit = max(self.limit, 2 * self.held)

    def result(self, ids: pa.ChunkedArray) -> dict[str, pa.Array]:
        if self.keep == "degree":
            rows = np.flatnonzero(self.neighbours)
            return {"article_id": ids.take(pa.array(rows)), "neighbours": pa.array(self.neighbours[rows])}
        if self.keep == "forest":
            self._thin()
        a, b, w = self._edges()
        return {"a": ids.take(pa.array(a)), "b": ids.take(pa.array(b)), "cosine": pa.array(w)}

    def told(self, ids: pa.ChunkedArray) -> dict[str, pa.Array]:
        """A forest's pairs, the smaller article first, with which ends are core, and each core article with itself."""
        self._thin()
        a, b, w = self._edges()
        lone = np.flatnonzero(self.core)
        rank = np.empty(len(ids), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        a, b = np.where(rank[a] < rank[b], a, b), np.where(rank[a] < rank[b], b, a)
        a, b, w = np.concatenate([a, lone]), np.concatenate([b, lone]), np.concatenate([w, np.full(len(lone), np.nan)])
        return {"a": ids.take(pa.array(a)), "b": ids.take(pa.array(b)), "a_core": pa.array(self.core[a]), "b_core": pa.array(self.core[b]),
                "cosine": pa.array(w, from_pandas=True)}
