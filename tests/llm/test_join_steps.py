"""Steps of the join that grew with the number of partitions or held needless memory."""

import numpy as np
import pyarrow as pa

from parchline.llm import jaccard_join, words


def _word_texts(spark, n):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(n)]
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


def test_few_and_many_ids_fetch_the_same_sets(spark):
    docs, ids = _word_texts(spark, 60), spark.createDataFrame([(i,) for i in (3, 7, 41, 99)], "id long")
    found = [{r["id"]: bytes(r["codes"]) for r in jaccard_join.fetched(docs, ids, few=few).collect()} for few in (10, 0)]
    assert found[0] == found[1] and set(found[0]) == {3, 7, 41}


def test_filter_is_read_in_few_jobs_and_sets_in_one_python_pass(spark):
    docs, ids = _word_texts(spark, 10), spark.createDataFrame([(i,) for i in range(500)], "id long")
    context, names = spark.sparkContext, ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in zip(names, ("40", "false")):
            spark.conf.set(name, value)
        context.setJobGroup("filter", "id_filter")
        table = jaccard_join.id_filter(ids)
        assert len(context.statusTracker().getJobIdsForGroup("filter")) < 10  # one job a partition before
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert 490 <= np.unpackbits(table).sum() <= 500
    many = jaccard_join.fetched(docs, ids, few=0)._jdf.queryExecution().toString()
    assert many[many.index("Physical Plan") :].count("MapInArrow") == 1  # two Python processes in a task before


def test_pairs_that_may_link_are_worked_out_once(spark):
    marks = spark.createDataFrame([(i, 3, jaccard_join.bitmap(np.arange(3, dtype=np.uint64))) for i in range(9)], "id long, n long, bitmap binary")
    named = spark.createDataFrame([(i, (i + 1) % 9) for i in range(9)], "id long, partner long")
    chosen = jaccard_join.at_most_two_each(named, marks)
    plan = chosen._jdf.queryExecution().toString()
    assert plan[plan.index("Physical Plan") :].count("MapInArrow") == 1
    assert {(r["a"], r["b"]) for r in chosen.collect()} == {tuple(sorted((i, (i + 1) % 9))) for i in range(9)}


def test_arrow_batches_are_bounded_by_bytes(spark):
    key, held = words._BATCH_KEY, spark.conf.getAll.get(words._BATCH_KEY)
    spark.conf.unset(key)
    frame = spark.range(4000, numPartitions=1).selectExpr("id doc_id", "repeat('x ', 2000) text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    words.per_text(words.with_text(frame), lambda: lambda texts: [pa.array([1] * len(texts))], "one bigint")
    found = [r["n"] for r in frame.mapInArrow(sizes, "n bigint").collect()]
    assert max(found) < words.BATCH_BYTES + (1 << 16)  # 16 MB before
    spark.conf.set(key, "1m")
    words.bound_batches(spark)
    assert spark.conf.get(key) == "1m"  # a session's own bound stays
    spark.conf.set(key, held) if held else spark.conf.unset(key)
