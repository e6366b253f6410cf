"""What the toxicity fit holds on the driver."""

import tracemalloc

import numpy as np

from shardlog.llm import toxicity


def _texts(n, slots, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    y[:2] = 0, 1
    low = np.arange(1 << toxicity.BITS) < 1 << 17
    pools = [np.flatnonzero(low | (np.arange(1 << toxicity.BITS) % 3 == k)) for k in (0, 1)]
    return [rng.choice(pools[k], slots, replace=False).astype(np.int32) for k in y], y.astype(np.int64)


def test_fit_takes_few_bytes_a_slot():
    docs, y = _texts(300, 20_000)
    tracemalloc.start()
    toxicity.fit_arrays(docs, y, 0.2, least_ratio=0.0, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * 300 * 20_000


def test_blocks_do_not_change_the_fit():
    docs, y = _texts(60, 500)
    docs[7] = docs[11] = np.empty(0, np.int32)
    whole = toxicity.fit_arrays(docs, y, 0.2, least_docs=1, rounds=20, block=1 << 30)
    assert np.abs(whole.weights).sum() > 0
    for block in (1, 700, 4000):
        some = toxicity.fit_arrays(docs, y, 0.2, least_docs=1, rounds=20, block=block)
        assert np.allclose(some.weights, whole.weights, atol=1e-6) and abs(some.bias - whole.bias) < 1e-9


def test_packed_slots():
    rng = np.random.default_rng(1)
    top = (1 << toxicity.BITS) - 1
    sets = [[], [0], [254], [255], [256], [0, 255, 510, top], [253, 254, 255, 256], list(range(top + 1)), rng.choice(top, 4000, replace=False).tolist()]
    sets = [np.array(x, np.int32) for x in sets]
    packed = [np.frombuffer(toxicity._pack(x), np.uint8) for x in sets]
    for x, got in zip(sets, toxicity._Packed(packed), strict=True):
        assert got.tolist() == sorted(x.tolist())
    assert len(packed[-1]) < 1.1 * 4000


def test_as_many_jobs_whatever_the_partitions(spark):
    rows = [(i, f"text number {i} {'filth' if i % 5 == 0 else 'calm'} " * 3) for i in range(200)] + [(0, "the same id again"), (1, None), (2, "")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    made, jobs = [], []
    for n in (2, 40):
        group = f"fit-{n}"
        spark.sparkContext.setJobGroup(group, group)
        docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, n), "doc_id long, text string")
        made.append(toxicity.fit(docs, labels))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[0] == jobs[1]
    assert np.allclose(made[0].weights, made[1].weights) and made[0].bias == made[1].bias
