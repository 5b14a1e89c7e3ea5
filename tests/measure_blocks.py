"""How many block pairs and article copies the bounds of the similarity join save: python tests/measure_blocks.py FOLDER"""

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from storyweave.operators import similarity, terms  # noqa: E402
from storyweave.operators.windows import RUN  # noqa: E402
from storyweave.plans import catalog  # noqa: E402
from storyweave.session import build_session  # noqa: E402


def main(folder: str) -> None:
    spark = build_session("blocks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
                                                   "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    at = F.lit("2024-01-01").cast("timestamp")
    counts = catalog.termcount(spark, folder).withColumns({"begin": at, "end": at + F.lit(catalog.LONG)})
    reps = similarity.collapse_copies(terms.tfidf_vectors(counts)).reps
    n = reps.count()
    for limits in (similarity.Limits(block_articles=64), similarity.Limits(block_articles=512), similarity.Limits()):
        for threshold in (0.2, 0.45):
            start = time.time()
            found = similarity.block_copies(reps, threshold, limits).groupBy(*RUN, "lo", "hi").agg(
                F.count("*").alias("copies"), F.count_distinct("block").alias("sides"))
            rows = found.select("lo", "hi", "copies", "sides").collect()
            blocks = sum(r.lo == r.hi for r in rows)
            live = sum(r.lo != r.hi and r.sides == 2 for r in rows)
            pairs, copies = blocks * (blocks - 1) // 2, sum(r.copies for r in rows)
            print(f"{limits.block_articles:5d} articles a block, t {threshold}: {blocks} blocks, {live} of {pairs} block pairs multiplied, "
                  f"{copies} of {n * blocks} article copies shuffled, {time.time() - start:.1f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1])
