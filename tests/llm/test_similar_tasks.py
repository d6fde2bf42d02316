"""The near-duplicate stage on small tables dealt over many partitions: few tasks, same rows, no files left."""

import os
import random

import corpus_pipeline
from folioforge.llm.common import TASK_ROWS, observed, release
from pyspark.sql import functions as F


def tasks_of(spark, group):
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))


def test_stage_takes_few_tasks(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for k in range(12):
        text = [rng.choice(words) for _ in range(300)]
        for i in range(6 if k % 3 else 1):
            copy = list(text)
            for _ in range(i):
                copy[rng.randrange(300)] = "x"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    firsts = [i for i, (_, t) in enumerate(rows) if "x" not in t.split()]
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("few-tasks", "near-duplicates")
        kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(kept) == firsts
    done = tasks_of(spark, "few-tasks")
    assert 0 < done < 48 * 140, done


def test_counted_tables_are_read_in_few_tasks_and_released(spark):
    frame, seen = observed(spark.range(0, 1000, 1, 40).where("id % 2 = 0"), top=F.max("id"))
    assert seen == {"n": 500, "top": 998} and frame.count() == 500
    assert frame.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    folder = frame._jdf.queryExecution().analyzed().collectLeaves().head().rdd().getCheckpointFile().get().removeprefix("file:")
    assert os.path.isdir(folder)
    release(frame)
    assert not os.path.exists(folder)
    many, seen = observed(spark.range(0, TASK_ROWS * 9, 1, 40))
    assert seen == {"n": TASK_ROWS * 9} and many.rdd.getNumPartitions() == 9
    none, seen = observed(spark.range(5).where("id < 0").groupBy("id").count())
    assert seen == {"n": 0} and none.collect() == []
