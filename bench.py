"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON: the median of three warm runs each."""

import json
import os
import sys
import tempfile
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

HEADLINES = ["p4_datasets_total", "p2_file_chunk_stats", "c8_renumber_chunks", "e3_knn_topk", "d2_question_communities", "v13_domain_coverage", "v12_semantic_diversity", "p8_qa_category_by_hop", "t3_topic_keywords", "j1_pictures_in_tables"]


def main() -> None:
    from pyspark.sql import SparkSession

    from ragset.jobs import catalog

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalog.queries(), {}
    for name in HEADLINES:
        runs = []
        for _ in range(4):
            began = time.time()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
