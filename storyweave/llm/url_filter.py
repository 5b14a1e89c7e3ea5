"""URL filter: rules by host and path, and a character language-model ratio for what no rule decides. DataFrame functions only.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, are counted on the URLs that a rule decides. A
character's probability mixes its count after the three characters before it with its probability after two, and so on down to
none, so a context that was not seen falls back to a shorter one. A URL's score is the difference of its log-likelihoods divided by
its length; the cut between allow and block is calibrated on a part of the decided URLs that the models did not see.

Characters are lower-cased, digits are alike, and what is not usual in URLs is one character: 43 symbols, so the table of
four-symbol contexts that is broadcast has 43^4 rows (about 200 MB) at the very most, however many URLs there are.

A null or empty URL, and any URL when one of the classes has no decided URL, is allowed unless a rule blocks it. Equal URLs are judged
once; rows that repeat give a row each. An empty table gives an empty table; only page_id and url are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyweave.llm.common import once, staged

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 3
WEIGHT = 4.0  # of the shorter context, in characters seen
SYMBOLS = 43  # a-z, 0, 13 marks, any other, start, end
STEP = 100  # cuts are multiples of 1 / STEP
_USUAL = r"[^a-z0./?=&#%:_+~@-]"
_SIZE = ORDER + 1


def host(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of verdict and rule; null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(text).alias("rule"))).otherwise(found)
    return found


def _contexts(urls: DataFrame, *columns: str) -> DataFrame:
    """A row for each character of ``urls(id, url, ...)``: ``gram``, the character with the three before it."""
    plain = F.regexp_replace(F.regexp_replace(F.lower("url"), "[0-9]", "0"), _USUAL, "*")
    marked = F.encode(F.concat(F.lit("^" * ORDER), plain, F.lit("$")), "UTF-8")
    single = once(urls, *columns, marked.alias("marked"), F.sequence(F.lit(1), F.length("url") + 1).alias("places"))
    return (single.select(*columns, "marked", F.explode("places").alias("at"))
            .select(*columns, F.expr(f"cast(substring(marked, at, {_SIZE}) as string)").alias("gram")))


def _ratios(counts: DataFrame) -> DataFrame:
    """``(gram, ratio)`` of ``counts(gram, accepted, rejected)``: log-probability among accepted less that among rejected URLs."""
    classes = ("accepted", "rejected")
    lower = None
    for order in range(_SIZE):
        here = (counts.groupBy(F.substring("gram", _SIZE - order, order + 1).alias("part")).agg(*[F.sum(c).alias(c) for c in classes])
                .withColumn("context", F.substring("part", 1, order)))
        seen = here.groupBy("context").agg(*[F.sum(c).alias(f"{c}_all") for c in classes])
        here = here.join(seen, "context")
        if lower is None:
            probability = {c: (F.col(c) + 1.0) / (F.col(f"{c}_all") + float(SYMBOLS)) for c in classes}
        else:
            here = here.withColumn("shorter", F.substring("part", 2, order)).join(lower, "shorter")
            probability = {c: (F.col(c) + WEIGHT * F.col(f"{c}_p")) / (F.col(f"{c}_all") + WEIGHT) for c in classes}
        lower = here.select(F.col("part").alias("shorter"), *[probability[c].alias(f"{c}_p") for c in classes])
    return lower.select(F.col("shorter").alias("gram"), (F.ln("accepted_p") - F.ln("rejected_p")).alias("ratio"))


def _cut(scores: DataFrame) -> float:
    """The score that best tells accepted from rejected ones, each class counting as one: the middle of the gap between two cells
    of 1 / STEP; of equally good gaps the widest, then the lowest."""
    cells = scores.groupBy(F.floor(F.col("score") * STEP).alias("cell")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("r"))
    # A row per cell: scores are differences of logarithms of bounded numbers.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    right = (F.sum("a").over(every) - F.coalesce(F.sum("a").over(before), F.lit(0))) / F.sum("a").over(every)
    wrong = F.coalesce(F.sum("r").over(before), F.lit(0)) / F.sum("r").over(every)
    both = (F.sum("a").over(every) > 0) & (F.sum("r").over(every) > 0)
    gap = F.col("cell") - F.coalesce(F.lag("cell").over(Window.orderBy("cell")) + 1, F.col("cell"))
    rated = cells.select("cell", gap.alias("gap"), F.when(both, F.round(right + wrong, 9)).alias("good")).filter("good is not null")
    best = rated.orderBy(F.desc("good"), F.desc("gap"), "cell").first()
    return (2 * best["cell"] - best["gap"]) / (2 * STEP) if best else 0.0


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, score, verdict)`` of each row; score is null where no model was asked."""
    rows = pages.select("page_id", "url")
    parts = rows.select("url").distinct().withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    ruled = parts.withColumn("found", rule(rules)).select("url", "host", "path", "found.verdict", "found.rule")
    # Numbered once and written, so that the number stays.
    urls = staged(ruled.withColumn("id", F.monotonically_increasing_id()), "urls")
    held = F.substring(F.md5("url"), 1, 1).isin("0", "1", "2")
    asked = urls.filter("url <> ''").withColumn("held", held)
    learnt = {"accepted": "allow", "rejected": "block"}
    counts = (_contexts(asked, "verdict", "held").groupBy("gram")
              .agg(*[F.count(F.when((F.col("verdict") == v) & ~F.col("held"), 1)).alias(c) for c, v in learnt.items()]))
    ratios = F.broadcast(staged(_ratios(staged(counts, "grams")), "ratios"))
    scores = staged(_contexts(asked, "id", "verdict", "held").join(ratios, "gram").groupBy("id")
                    .agg(F.avg("ratio").alias("score"), F.first("verdict").alias("verdict"), F.first("held").alias("held")), "scores")
    known = scores.filter("verdict is not null")
    some = {r["verdict"] for r in known.filter("not held").groupBy("verdict").count().collect()}
    cut = _cut(known.filter("held")) if len(some) == 2 else None
    said = F.lit("allow") if cut is None else F.when(F.coalesce(F.col("score"), F.lit(cut)) >= cut, "allow").otherwise("block")
    judged = (urls.join(scores.select("id", "score"), "id", "left")
              .select(F.col("url").alias("of"), "host", "path", "rule", F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
                      F.coalesce("verdict", said).alias("verdict")))
    return (rows.join(judged, F.col("url").eqNullSafe(F.col("of")))
            .select("page_id", "host", "path", "rule", "score", "verdict"))
