"""Branches of the operators on literal frames, and what the last round's probes found."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.functions import jsonish, text as T
from lettermill.operators import contain, extract, gate, packing, prep, requests, retrieval, select, urls
from lettermill.rules import ExtractRule, RewriteRule, RewriteSet, rewrite
from lettermill.sources import readers, writers


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


def test_cascade_takes_the_first_long_capture(spark):
    rules = (ExtractRule(r"wants (\w+)"), ExtractRule(r"needs (\w+) or (\w+)", 2))
    df = spark.createDataFrame([(1, "He wants it"), (2, "wants it, needs rest or SLEEP"), (3, "none"), (4, None)], "id int, t string")
    got = df.select("id", extract.cascade(F.col("t"), rules, F.lit("fallback")).alias("x"))
    assert values(got) == [(1, "fallback"), (2, "SLEEP"), (3, "fallback"), (4, "fallback")]


def test_category_fallback(spark):
    df = spark.createDataFrame([("A", "b"), ("A", "Other"), ("Other", "b"), (None, None)], "c string, s string")
    assert [r[0] for r in df.select(extract.category_fallback(F.col("c"), F.col("s"))).collect()] == ["Ab", "A", None, ""]


@pytest.mark.parametrize("path,expected", [
    ("l/C1_appeal.txt", ("C1", "", "appeal")), ("l/C1MAGIC60-1denial2.txt", ("C1", "MAGIC60-1", "rejection")),
    ("l/C1EXTRACTEDreason_for_denial.txt", ("C1", "EXTRACTED", "reason_for_denial")), ("l/C1_notes.txt", (None, None, None)), ("C1_appeal.txt", (None, None, None))])
def test_decode_name(spark, path, expected):
    df = extract.decode_name(spark.createDataFrame([(path,)], "path string"))
    assert tuple(df.select("case_id", "producer", "letter_type").first()) == expected


@pytest.mark.parametrize("raw,result", [
    ("ask and tell", " and tell"), ("x[ASN]yes[ASN]no", "yes"), ("x[OUT]yes", "yes"), ("x[/INST]yes", "yes"), ("plain", "plain"),
    ("The reviewer determined that the requested x", None), (None, None)])
def test_completion_branches(spark, raw, result):
    row = spark.createDataFrame([("ask", raw)], "p string, r string").select(T.cleaned_or_error(F.col("p"), F.col("r")).alias("x")).first()["x"]
    assert (row["result"], row["error"] is None) == (result, result is not None)


@pytest.mark.parametrize("text,valid", [
    ('{"a": 1}', True), ('{"a": 1},', True), ('{a: 1}', True), ('{"a": 1', True), ('{"a": "b', True), ('{"a": None}', True), ('{"a": 1}}', False),
    ('condition: "x"\napproval_reason: y', True), ("other: x", False), ("", False), (None, False)])
def test_tolerant_json(spark, text, valid):
    assert (one(spark, text, jsonish.tolerant_json) is not None) == valid


def test_repair_json(spark):
    assert one(spark, '{a: 1, b "x"}', jsonish.repair_json_text) == '{"a": 1, "b": "x"}'
    assert one(spark, '{a: "one, two: 3", b_2 4,\n c :\t5 , "d, e: 6": {f: [g, h]}}', jsonish.repair_json_text) == (
        '{"a": "one, two: 3", "b_2": 4,\n "c" :\t5 , "d, e: 6": {"f": [g, "h"]}}'.replace('"h"', "h"))
    assert one(spark, r'{a: "say \"x, b: 1\" \\", c: 2}', jsonish.quote_keys) == r'{"a": "say \"x, b: 1\" \\", "c": 2}'
    for same in ('{"a": "open, b', "", " \n ", "plain words, and: more", '"', '{"a\n: 1}', "{1: 2, x"):
        assert one(spark, same, jsonish.quote_keys) == same.replace(", and:", ', "and":')
    assert one(spark, None, jsonish.repair_json_text) is None


def test_lines_as_json(spark):
    import json

    found = json.loads(one(spark, 'condition: "old"\napproval_reason: a: b,\ncondition: new\nn: 5\nnull: None', jsonish.tolerant_json))
    assert found == {"condition": "new", "approval_reason": "a: b", "n": 5, "null": None}


@pytest.mark.parametrize("line", ["some key {0}: a value, with words", "k{0}: {0}", '"q{0}": "v {0}', 'x: \\"' + '\\"' * 3])
def test_long_texts_are_read_in_a_moment(spark, line):
    import time

    long = "\n".join(["condition: x", "approval_reason: y", *[line.format(i) for i in range(20_000)]])
    df = spark.createDataFrame([(long,)], "t string").select(F.length(jsonish.tolerant_json(F.col("t"))).alias("n"))
    df.collect()
    began = time.time()
    assert df.first()["n"] > 20
    assert time.time() - began < 8  # about a second on an idle machine



def test_rewrite_settles_on_long_runs(spark):
    squeeze = [RewriteRule("  ", " ")]
    assert one(spark, "a" + " " * 140_000 + "b", lambda c: rewrite(c, squeeze)) == "a b"
    one_by_one = [RewriteRule("ab", "b")]
    assert one(spark, "a" * 300 + "b", lambda c: rewrite(c, one_by_one)) == "b"
    assert one(spark, None, lambda c: rewrite(c, squeeze)) is None


def test_rewrite_ends_with_rules_that_feed_one_another(spark):
    cycle = [RewriteRule("bq", "cq"), RewriteRule("aq", "bq"), RewriteRule("cq", "aq")]
    assert one(spark, "x aq", lambda c: rewrite(c, cycle)) == "x aq"
    assert one(spark, "x a", lambda c: rewrite(c, [RewriteRule("a", "b"), RewriteRule("b", "c"), RewriteRule("c", "a d")])).startswith("x a d d")
    with pytest.raises(ValueError):
        rewrite(F.lit("x"), [RewriteRule("a", "aa")])


def test_rewrite_in_rounds(spark, tmp_path):
    from lettermill.operators.rewriting import rewrite_in_rounds

    rules = RewriteSet(general=[RewriteRule("xx", "x"), RewriteRule("bq", "cq"), RewriteRule("aq", "bq"), RewriteRule("cq", "aq")], by_type={"denial": [RewriteRule("z", "")]})
    rows = [(i, "appeal", "y" + "x" * i) for i in range(1, 90, 8)] + [(200, "appeal", "bq and xx"), (201, "rejection", "zz cq"), (202, "appeal", None), (203, "appeal", ""),
            (204, "rejection", "z"), (205, None, "xxz")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "id int, kind string, t string, converged string")
    got = {r["id"]: (r["t"], r["converged"]) for r in rewrite_in_rounds(df, "t", "kind", rules, str(tmp_path / "r"), first_passes=1).collect()}
    want = {i: ("yx", True) for i in range(1, 90, 8)} | {202: (None, True), 203: ("", True), 204: ("", True), 205: ("xz", True)}
    assert {i: v for i, v in got.items() if i not in (200, 201)} == want
    assert got[200][0] in ("aq and x", "bq and x") and not got[200][1] and not got[201][1] and "z" not in got[201][0]
    growing = RewriteSet(general=[RewriteRule("a", "b"), RewriteRule("b", "c"), RewriteRule("c", "a d")])
    last = rewrite_in_rounds(df.filter("id = 200"), "t", "kind", growing, str(tmp_path / "g"), max_passes=16).first()
    assert not last["converged"] and last["t"].count(" d") > 10


def test_rewrite_finds_letters_that_fold(spark):
    assert one(spark, "this iſ x", lambda c: rewrite(c, [RewriteRule("is x", "was")])) == "this was"


def test_rewrite_by_type_uses_own_rules_only(spark):
    rules = RewriteSet(general=[RewriteRule("a", "")], by_type={"denial": [RewriteRule("b", "c")]})
    from lettermill.rules import rewrite_by_type

    df = spark.createDataFrame([("rejection", "ab"), ("appeal", "ab")], "k string, t string")
    assert [r[0] for r in df.select(rewrite_by_type(F.col("t"), F.col("k"), rules)).collect()] == ["c", "b"]


def test_response_store_is_written_once_per_key(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("i", "appeal", 0, 0, "good"), ("i", "appeal", 0, 0, "also good"), ("j", "appeal", 0, 0, "bad one")],
                                 "index string, kind string, model_index bigint, variant bigint, response string")
    assert writers.append_responses(rows, path, {"appeal": ["bad"]})
    assert writers.append_responses(rows, path, {"appeal": ["bad"]})
    assert values(readers_of(spark, path)) == [("also good", "i")]
    # What was good is bad by another list, so its key is open again.
    writers.append_responses(rows, path, {"appeal": ["also"]})
    assert values(readers_of(spark, path)) == [("also good", "i"), ("bad one", "j"), ("good", "i")]
    known = spark.createDataFrame([("i", "treatment", "x"), ("i", "treatment", "y")], "index string, kind string, value string")
    for _ in range(2):
        writers.append_known(known, str(tmp_path / "known"))
    assert values(writers.known_store(spark, str(tmp_path / "known")).current()) == [("i", "x", "treatment")]


def test_store_commits_whole_batches(spark, tmp_path):
    from lettermill.sources.store import KeyedStore

    store = KeyedStore(spark, str(tmp_path / "s"), "k bigint, v string", ["k"], buckets=4)
    of = lambda *rows: spark.createDataFrame(list(rows), "v string, k bigint, other int")
    assert values(store.current()) == [] and store.batches() == [] and not store.compact("0")
    assert store.append("1", of(("a", 1, 0), ("b", 1, 0), ("n", None, 0)))
    assert not store.append("1", of(("x", 9, 0)))
    # A batch that broke off: rows, but no commit, or a commit without its marker.
    of(("lost", 7, 0)).select("k", "v").write.parquet(str(tmp_path / "s/data/batch=2/bucket=0"))
    (tmp_path / "s/commits/batch=2").mkdir()
    (tmp_path / "s/commits/batch=2/part-0.json").write_text('{"replaces": ["1"], "buckets": [0], "n": 1}')
    assert values(store.current()) == [(1, "a"), (None, "n")] and store.batches() == ["1"]
    assert store.append("2", of(("c", 2, 0), ("again", 1, 0), ("again", None, 0)))
    assert store.append("3", of())
    want = [(1, "a"), (2, "c"), (None, "n")]
    assert values(store.current()) == want
    assert store.compact("4") and values(store.current()) == want and store.batches() == ["4"]
    assert not store.compact("5") and not store.append("2", of(("late", 5, 0)))
    with pytest.raises(ValueError):
        store.append("35", of(("late", 5, 0)))
    assert store.append("5", of(("e", 5, 0), ("again", 2, 0))) and values(store.current()) == [*want[:2], (5, "e"), want[2]]


def readers_of(spark, path):
    return writers.read_responses(spark, path).select("response", "index")


def test_bad_urls_ignore_letter_case(spark):
    letters = spark.createDataFrame([(1, "see http://Site.org/A and http://gone.org/b."), (2, "none"), (3, None)], "id int, text string")
    status = spark.createDataFrame([("http://site.org/a", 1), ("http://gone.org/b", 0)], "url string, ok int")
    got = urls.bad_urls(letters, status, ["id"])
    assert [(r["id"], r["bad_urls"]) for r in got.collect()] == [(1, ["http://gone.org/b."])]


def test_topk_leaves_out_zero_vectors_and_keeps_equal_ids(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0]), (4, None)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    assert [r["vec_id"] for r in retrieval.topk(queries, vectors, 5).orderBy("rank").collect()] == [1, 3]
    assert [r["vec_id"] for r in retrieval.topk(queries, vectors, 5, exclude_self=True).collect()] == [3]


def test_topk_asks_few_lists_and_misses_nothing(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    every = [(i, (centres[i % 12] + rng.normal(size=8) * 0.15).tolist()) for i in range(600)]
    every += [(1000 + i, rng.normal(size=3).tolist()) for i in range(4)] + [(2000, every[0][1]), (2001, every[0][1]), (2002, None), (2003, [float("nan")] * 8), (None, [1.0] * 8), (2004, [0.0] * 8)]
    asked = [(i, v) for i, v in every if i is not None and i % 7 == 0 or i in (1001, 2000, 2003)]
    vectors, queries = spark.createDataFrame(every, "vec_id bigint, embedding array<double>"), spark.createDataFrame(asked, "query_id bigint, embedding array<double>")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in every if i is not None and v and np.isfinite(v).all() and any(v)}
    want = []
    for i, _ in asked:
        if i in unit:
            near = sorted((-(round(float(unit[i] @ v), 6) + 0.0), j) for j, v in unit.items() if j != i and len(v) == len(unit[i]))[:6]
            want += [(i, j, -s, n) for n, (s, j) in enumerate(near, 1)]
    for pivots, cell in ((256, 20_000), (5, 40), (1, 7)):
        got = retrieval.topk(queries, vectors, 6, exclude_self=True, pivots=pivots, cell_rows=cell).collect()
        assert sorted((r["query_id"], r["vec_id"], round(r["similarity"], 5), r["rank"]) for r in got) == sorted((a, b, round(c, 5), d) for a, b, c, d in want)
    assert retrieval.topk(queries, vectors.limit(0), 3).count() == 0 and retrieval.topk(queries.limit(0), vectors, 3).count() == 0


def test_contained_equals_trying_all_pairs(spark):
    draw = random.Random(3)
    words = ["a", "bb", "ccc", "a b", "", "the"]
    texts = [(i % 2, i, " ".join(draw.choice(words) for _ in range(12))) for i in range(20)]
    needles = [(i % 2, i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 4)))) for i in range(30)]
    got = contain.contained(spark.createDataFrame(texts, "g int, t int, x string"), ["t"], "x", spark.createDataFrame(needles, "g int, n int, y string"), ["n"], "y", "g")
    want = sorted((g, t, n) for g, t, x in texts for h, n, y in needles if g == h and y in x)
    assert values(got) == sorted(want, key=str)


def test_phrases_in_equals_trying_all_pairs(spark):
    draw = random.Random(6)
    words = ["a", "ab", "abc", "é", "😀x", "of", "the", "\n", "x" * 9]
    texts = [(draw.randint(0, 2), i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 12)))) for i in range(60)] + [(None, 90, "a"), (1, 91, None), (1, 92, "")]
    needles = [(draw.randint(0, 3), " ".join(draw.choice(words) for _ in range(draw.randint(1, 6)))) for _ in range(150)]
    needles += [(0, t[3:9]) for _, _, t in texts[:40] if t] + [(1, ""), (1, None), (None, "a"), (1, "b"), (1, "b"), (2, " ")]
    got = contain.phrases_in(spark.createDataFrame(texts, "g int, t int, x string"), ["t"], "x", spark.createDataFrame(needles, "g int, p string"), "p", "g")
    want = {(g, i, p) for g, i, x in texts for h, p in needles if g is not None and g == h and x is not None and p and p in x}
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 200
    none = spark.createDataFrame([], "g int, p string")
    assert contain.phrases_in(spark.createDataFrame(texts, "g int, t int, x string"), ["t"], "x", none, "p", "g").count() == 0


def test_few_phrases_are_tried_on_the_texts_as_they_are(spark):
    texts = spark.createDataFrame([(1, 1, "a blue pill"), (1, 2, "a red one"), (2, 3, "a blue pill"), (None, 4, "blue")], "g int, t int, x string")
    found = contain.phrases_in(texts, ["t"], "x", spark.createDataFrame([(1, "blue"), (1, "e"), (3, "a")], "g int, p string"), "p", "g")
    assert sorted(map(tuple, found.collect())) == [(1, 1, "blue"), (1, 1, "e"), (1, 2, "e")]
    assert "regexp_extract_all" not in found._jdf.queryExecution().toString()  # no runs of characters come out of the texts


def test_phrases_meet_texts_by_long_runs(spark):
    draw = random.Random(8)
    words = ["aba", "bab", "abb", "baa"]  # every run of five characters stands in about every text
    texts = [(1, i, " ".join(draw.choice(words) for _ in range(200))) for i in range(60)]
    phrases = [(1, t[at:at + 60]) for _, _, t in texts for at in (40, 333)] + [(1, "aba"), (1, "no such"), (2, texts[0][2][:50])]
    found = contain.phrases_in(spark.createDataFrame(texts, "g int, t int, x string"), ["t"], "x", spark.createDataFrame(phrases, "g int, p string"), "p", "g")
    plan = found._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "mapinarrow" in plan.lower()
    want = {(g, i, p) for g, i, x in texts for h, p in phrases if g == h and p in x}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    # A text sends what may be one of the phrases, not all it holds.
    runs = contain._with_runs(spark.createDataFrame(phrases, "_g int, _p string").distinct())
    sizes = [r[0] for r in runs.select("_size").distinct().collect()]
    marks = spark.sparkContext.broadcast(contain._marked(runs, contain.FEWEST_BITS))
    dealt = spark.createDataFrame([(g, i, x.encode()) for g, i, x in texts], "_g int, _cell int, _text binary")
    assert 180 <= contain._held_runs(dealt, sizes, contain.FEWEST_BITS, marks).count() <= 200


def test_equal_rows_repeat_what_is_found(spark):
    texts = spark.createDataFrame([(1, 1, "a blue pill")] * 3 + [(1, 2, "blue"), (1, 2, "blue one")], "g int, t int, x string")
    for more in (0, contain.TRIED):
        phrases = spark.createDataFrame([(1, "blue")] + [(2, f"no {i}") for i in range(more)], "g int, p string")
        found = contain.phrases_in(texts, ["t"], "x", phrases, "p", "g").collect()
        assert sorted(map(tuple, found)) == [(1, 1, "blue")] * 9 + [(1, 2, "blue")] * 2


def test_phrases_are_found_once_in_texts_cut_in_pieces(monkeypatch):
    monkeypatch.setattr(contain, "PIECE", 50)
    draw = random.Random(4)
    texts = ["".join(draw.choice("ab") for _ in range(draw.choice((0, 3, 60, 400)))).encode() for _ in range(40)]
    phrases = sorted({t[at:at + n] for t in texts for at in (0, 20, 45) for n in (1, 2, 5, 8, 30, 100)} - {b""})
    got = [(int(t), phrases[p]) for whose, phrase in contain._Listed(phrases).found_in(texts) for t, p in zip(whose, phrase)]
    assert sorted(got) == sorted((i, p) for i, t in enumerate(texts) for p in phrases if p in t)


def test_blocks_of_places_join_up(monkeypatch):
    monkeypatch.setattr(contain, "BLOCK", 32)
    draw = random.Random(5)
    texts = ["".join(draw.choice("abc") for _ in range(draw.randint(0, 200))).encode() for _ in range(60)]
    phrases = sorted({t[at:at + n] for t in texts for at in (0, 29, 60) for n in (*range(1, 14), 27, 60)} - {b""})
    got = [(int(t), phrases[p]) for whose, phrase in contain._Listed(phrases).found_in(texts) for t, p in zip(whose, phrase)]
    assert sorted(got) == sorted((i, p) for i, t in enumerate(texts) for p in phrases if p in t)
    strings = contain._Strings(texts)
    for size, lo, h in strings.every(contain.SIZES):
        assert (h == strings.at(np.arange(lo, lo + len(h)), np.full(len(h), size))).all()


def test_texts_of_many_phrases_are_staged_once(spark, tmp_path):
    spark.createDataFrame([(1, i, f"text {i}") for i in range(50)], "g int, t int, x string").write.parquet(f"{tmp_path}/given")
    phrases = spark.createDataFrame([(1, f"t {i}") for i in range(100)], "g int, p string")
    found = contain.phrases_in(spark.read.parquet(f"{tmp_path}/given"), ["t"], "x", phrases, "p", "g")
    assert found.inputFiles() and not any("/given/" in f for f in found.inputFiles())  # the job reads what was grouped and dealt, not the table again
    assert sorted(map(tuple, found.collect())) == sorted((1, i, f"t {k}") for i in range(50) for k in range(100) if f"t {k}" in f"text {i}")


def test_best_per_rejection_prefers_contained_options(spark):
    rows = [("c", "rejection", "r1", "we refuse the blue pill now", 0.0), ("c", "treatment", "t1", "a red pill", 5.0), ("c", "treatment", "t2", "the blue pill", 1.0)]
    scored = spark.createDataFrame(rows, "case_id string, letter_type string, path string, text string, base_score double")
    assert select.best_per_rejection(scored).select("option_path", "score").first() == ("t2", 21.0)


def test_gate_runs_across_lines_and_types(spark):
    df = spark.createDataFrame([("appeal", "BAD\nword"), ("rejection", "badword"), ("notes", "badword")], "letter_type string, text string")
    assert values(gate.gate(df, {"appeal": ["badword"], "denial": ["badword"]}).select("letter_type")) == [("notes",)]


def test_prompts_and_requests(spark):
    decisions = spark.createDataFrame([("r", "found in a journal", "grounds", "pill", "Other")], "ReferenceID string, Findings string, Type string, treatment_extracted string, diagnosis_extracted string")
    prompts = requests.PromptSet({"studies": ("S {findings}",), "appeal": ("A{treatment_clause}{diagnosis_clause}", "B"), "icd10": ("I",)}, " t={value}", " d={value}")
    built = requests.build_prompts(decisions, prompts)
    asked = requests.expand_requests(built, [("m", 0), ("n", 2)])
    assert sorted({(r["kind"], r["prompt"]) for r in asked.collect()}) == [("appeal", "A t=pill"), ("appeal", "B"), ("studies", "S found in a journal")]


def next_fit(rows, limit):
    """Rows (key, n) put one after the other, a new bin where one does not fit."""
    import hashlib

    sized = [(int(hashlib.md5(f"{k}|0".encode()).hexdigest()[:8], 16), k, min(max(n or 0, 0), limit)) for k, n in rows]
    out, number, at = [], 0, 0
    for _, k, n in sorted(sized):
        if at + n > limit:
            number, at = number + 1, 0
        out.append((k, n, number, at))
        at += n
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes,limit,parts", [([0, 1, 3, 700, 999, 1000, 1001, 5000, None, -4], 1000, 16), ([1], 7, 1), ([0], 10, 1), ([10, 0], 10, 1)])
def test_pack_equals_next_fit(spark, sizes, limit, parts):
    draw = random.Random(limit)
    rows = [(k, draw.choice(sizes)) for k in range(100)]
    assert values(packing.pack(spark.createDataFrame(rows, "k bigint, n bigint").repartition(parts), "k", "n", limit)) == next_fit(rows, limit)


def test_pack_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_ROWS", 40)
    monkeypatch.setattr(packing, "CELLS", 3)
    draw = random.Random(3)
    rows = [(k, draw.randint(0, 60)) for k in range(1000)]
    assert values(packing.pack(spark.createDataFrame(rows, "k bigint, n bigint"), "k", "n", 64)) == next_fit(rows, 64)
    assert packing.pack(spark.createDataFrame([], "k bigint, n bigint"), "k", "n").count() == 0


def sentence_bounds(counts, size, overlap):
    spans, first, filled = [], 0, 0
    for i, count in enumerate(counts):
        if filled + count > size:
            spans.append((first, i))
            first, filled = i, 0
            while first > 0 and filled + counts[first - 1] <= overlap and filled + counts[first - 1] + count <= size:
                first -= 1
                filled += counts[first]
        filled += count
    return [*spans, (first, len(counts))]


def test_chunk_sentences_equals_a_plain_loop(spark):
    draw = random.Random(5)
    texts = [[draw.randint(1, 14) for _ in range(draw.randint(1, 40))] for _ in range(20)]
    rows = [(i, " ".join(" ".join(["w"] * (n - 1) + ["w."]) for n in counts)) for i, counts in enumerate(texts)] + [(98, ""), (99, None)]
    got = prep.chunk_sentences(spark.createDataFrame(rows, "k bigint, text string"), "k", size=20, overlap=5)
    want = [(i, at, sum(counts[a:b])) for i, counts in enumerate(texts) for at, (a, b) in enumerate(sentence_bounds(counts, 20, 5))]
    assert sorted((r["k"], r["chunk_no"], r["n_tokens"]) for r in got.collect()) == want


def test_split_is_exact_disjoint_and_independent_of_partitions(spark):
    rows = [(i,) for i in range(300)]
    splits = [values(prep.split_exact(spark.createDataFrame(rows, "k bigint").repartition(parts), "k", 40)) for parts in (1, 64)]
    assert splits[0] == splits[1] and sum(s == "eval" for _, s in splits[0]) == 40
