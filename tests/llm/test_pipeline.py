"""The pipeline's stages, each against a plain version of it on the rows it was given."""

import random

import corpus_pipeline
from test_near import letter_words, prose, removed

from lettermill.llm import mixing, simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, path, documents, labels, items):
    spark.createDataFrame(documents, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def row(i, text, source="s"):
    return (i, text, "en", source, len(text or ""))


def test_stages_equal_plain_versions(spark, tmp_path):
    draw = random.Random(12)
    passage, item = prose(draw, 60, 5000), prose(draw, 25, 5000)
    texts = [prose(draw, 60, 5000) for _ in range(120)]
    documents = [row(i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    documents += [row(200 + i, prose(draw, 40, 5000) + " scumbag vilest", None) for i in range(60)]
    documents += [row(300, texts[3]), row(301, texts[4] + " tail"), row(302, prose(draw, 30, 5000) + "\n" + passage), row(303, passage + " " + prose(draw, 30, 5000)),
                  row(304, prose(draw, 20, 5000) + " " + item.upper()), row(305, None), row(306, ""), row(5, texts[5])]
    labels = [(i, 1, int(200 <= i < 260)) for i, *_ in documents]
    path = tables(spark, str(tmp_path / "t"), documents, labels, [(1, item), (2, None)])
    docs, outs = spark.read.parquet(f"{path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{path}/out{k}")
        docs = spark.read.parquet(f"{path}/out{k}")
        outs.append([tuple(r) for r in docs.collect()])
    clean = [d for d in documents if not 200 <= d[0] < 260]
    assert sorted(outs[0]) == sorted(clean) or {d[0] for d in outs[0]} == {d[0] for d in clean}
    prints = {(d[0], d[1]): simhash.fingerprint(d[1]) for d in clean}
    root = {k: k[0] for k in prints}
    while True:
        new = {a: min(root[b] for b in prints if bin(prints[a] ^ prints[b]).count("1") <= 4) for a in prints}
        if new == root:
            break
        root = new
    stay = {k[0] for k in prints if root[k] == k[0]}
    assert sorted(d[0] for d in outs[1]) == sorted(stay)
    want = removed([(d[0], d[1]) for d in outs[1]])
    left = {i: text for i, (n, gone, text) in want.items() if not gone or gone < n}
    got = {d[0]: d for d in outs[2]}
    assert set(got) == set(left) and want[303][1] > 40
    assert all(" ".join((got[i][1] or "").split()) == left[i] and got[i][4] == len(got[i][1] or "") for i in got)
    words = letter_words(item)
    windows = {tuple(words[s:s + 10]) for s in range(len(words) - 9)}
    leaks = {d[0] for d in outs[2] if any(tuple(letter_words(d[1])[s:s + 10]) in windows for s in range(max(0, len(letter_words(d[1])) - 9)))}
    assert leaks == {304} and sorted(d[0] for d in outs[3]) == sorted(set(got) - leaks)
    sizes = {}
    for d in outs[3]:
        sizes[d[3]] = sizes.get(d[3], 0) + len((d[1] or "").split())
    wanted, taken = mixing.targets(sizes), {}
    for _, source, size, source_size, target, n in outs[4]:
        assert source_size == sizes[source] and target == wanted[source] and n <= 2 * size
        taken[source] = taken.get(source, 0) + n
    assert all(abs(taken.get(s, 0) - wanted[s]) <= 1 for s in sizes)


def test_pipeline_of_empty_tables(spark, tmp_path):
    path = tables(spark, str(tmp_path / "e"), [], [], [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_stages_leave_the_callers_columns(spark, tmp_path):
    draw = random.Random(3)
    path = tables(spark, str(tmp_path / "t"), [row(i, prose(draw, 50, 5000)) for i in range(6)], [(i, 1, 0) for i in range(6)], [(1, prose(draw, 12, 9))])
    names = ("n_words", "n_removed", "kept_text", "toxicity", "row_one", "bad_id", "text_hash", "doc", "_doc")
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", *[f"concat('{n} ', doc_id) AS `{n}`" for n in names], "map('k', doc_id) AS `a map`")
    want = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and sorted(map(str, out.collect())) == want, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == 6
