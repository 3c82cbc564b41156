"""Headline queries, warm, median of three, into a no-op sink. Prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores;
``BENCH_COMMUNITY_ROWS`` (default 50000, 0 to skip) the size of the community detection run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from quillon.operators import graph as G
from quillon.plans import registry
from quillon.session import scratch_path, session

HEADLINE = [
    "d03_group_by", "d04_sql_view", "d08_correlation_matrix", "d10_spearman", "c02_lookup_join", "e01_top_k", "f03_random_split",
    "g05_search_tokens", "g08_passage_windows", "h12_bag_of_words", "h14_word_vector_sentences", "h11_nested_stages",
    "j01_semantic_search", "j01_semantic_search_blocks", "j02_paraphrase_mining", "j04_community_detection",
    "j06_threshold_clusters", "j07_ivf_search", "j10_bm25_search", "j14_margin_bitext", "j15_lexrank", "j16_transitive_closure",
    "k01_embedding_similarity", "k05_binary_report", "k06_information_retrieval", "k09_mining_evaluation",
    "m05_logistic", "n02_label_triplets", "n06_filtered_negatives", "n13_task_files", "n19_no_duplicate_batches",
]


def run(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(make, times: int = 3) -> float:
    run(make)
    return round(statistics.median(run(make) for _ in range(times)), 3)


def noisy_copies(spark, sf: str, rows: int):
    """The embeddings table, replicated with seeded noise to ``rows`` rows."""
    base = spark.read.parquet(f"{sf}/embeddings.parquet")
    n = base.count()
    copies = -(-rows // n)
    noise = F.transform("embedding", lambda x, i: (x + 0.04 * (F.pmod(F.xxhash64("vec_id", "c", i), F.lit(2000)) / 1000.0 - 1.0)).cast("float"))
    out = base.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select((F.col("vec_id") + F.col("c") * n).alias("id"), noise.alias("embedding"))
    return out.where(F.col("id") < rows)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_COMMUNITY_ROWS", "50000"))
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                                  "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered, times = registry(), {}
    for name in HEADLINE:
        times[name] = median(lambda: registered[name][0](spark, sf))
    if rows:
        path = scratch_path(spark, f"bench-{rows}")
        noisy_copies(spark, sf, rows).repartition(int(cpus)).write.parquet(path)
        emb = spark.read.parquet(path)
        times[f"community_detection_{rows}"] = median(lambda: G.community_detection(emb, 0.75, 25))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(os.path.normpath(sf))}))


if __name__ == "__main__":
    main()
