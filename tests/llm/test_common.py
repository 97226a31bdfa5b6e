import random

from lettermill.llm.common import connected_components, tidy


def components(pairs):
    root = {n: n for p in pairs for n in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


def test_components_of_chains_stars_and_noise(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(draw.randint(200, 300), draw.randint(200, 300)) for _ in range(60)] + [(7, 7), (5, 6), (400, 400)]
    df = spark.createDataFrame(pairs + [(None, 1)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == components(pairs)
    assert connected_components(df.limit(0)).count() == 0


def test_a_worker_gives_back_what_a_task_held():
    import gc
    import weakref

    import pyarrow as pa

    class Held:
        pass

    seen = []

    def run(batches):
        held = Held()
        held.own = held  # a cycle, as the states of an automaton are
        seen.append(weakref.ref(held))
        yield from batches

    gc.disable()
    try:
        batch = pa.RecordBatch.from_pydict({"a": [1, 2]})
        assert list(tidy(run)([batch, batch])) == [batch, batch] and seen[0]() is None
        rest = tidy(run)([batch, batch])
        next(rest)
        rest.close()
        assert seen[1]() is None
    finally:
        gc.enable()
