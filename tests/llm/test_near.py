"""Near-duplicates, passages, contamination and toxicity against brute force, and their odd cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import mixing, passages, quantised, simhash, tokens, toxicity, winnow

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id bigint"


def docs(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, 9) for i, t in texts], DOCS).repartition(parts)


def prose(draw, n, words=60):
    return " ".join(f"w{draw.randint(0, words)}" for _ in range(n))


# --- simhash ---


def test_simhash_equals_brute_force(spark):
    draw = random.Random(1)
    base = [prose(draw, draw.randint(1, 80), 30) for _ in range(40)]
    texts = [(i, t) for i, t in enumerate(base)] + [(100 + i, t + " end") for i, t in enumerate(base)] + [(200, None), (201, ""), (202, " \t"), (203, base[0]), (None, base[1]), (3, base[3]), (300, "É é K")]
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs(spark, texts)).collect()), key=str)
    prints = [(i, simhash.fingerprint(t)) for i, t in texts]
    root = list(range(len(prints)))
    while True:
        new = [min(root[j] for j in range(len(prints)) if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4) for i in range(len(prints))]
        if new == root:
            break
        root = new
    least = {}
    for (i, _), r in zip(prints, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    assert got == sorted(((i, format(f, "016x"), least[r]) for (i, f), r in zip(prints, root)), key=str)
    assert simhash.near_duplicates(docs(spark, []).limit(0)).count() == 0


def test_keep_one_keeps_columns_and_one_row(spark):
    texts = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "quite another text with other words"), (4, None), (5, "")]
    kept = simhash.keep_one(docs(spark, texts))
    assert kept.columns == [c.split(" ")[0] for c in DOCS.split(", ")]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_keep_one_chooses_in_every_component(spark):
    draw = random.Random(14)
    alone, (a, b, c) = [prose(draw, 60, 5000) for _ in range(5)], [prose(draw, 60, 5000) for _ in range(3)]
    # Rows without an id, unrelated and twice; 5 on a copy of 3's text and on one of its own; no id beside one.
    texts = [(None, t) for t in alone] + [(None, alone[0]), (3, a), (5, a), (5, b), (None, c), (8, c)]
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(docs(spark, texts)).collect()), key=str)
    assert kept == sorted([(None, t) for t in alone] + [(3, a), (5, b), (8, c)], key=str)


def test_dense_group_in_blocks_is_one_component(spark):
    draw = random.Random(4)
    values = {draw.getrandbits(64) for _ in range(30)}
    centre = draw.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    from lettermill.llm.common import connected_components

    edges = simhash.link_edges(df, block_rows=64)
    assert edges.count() < 60 * len(values)
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    near = [v - (1 << 64) if v >> 63 else v for v in values if bin(v ^ centre).count("1") <= 2]
    assert len({found[v] for v in near}) == 1


def test_pivot_distances_bound_the_distance():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 63, 200, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    difference = np.abs(simhash.pivot_table(a, simhash.pivots()).astype(int) - simhash.pivot_table(b, simhash.pivots()).astype(int)).max(axis=1)
    assert (difference <= np.bitwise_count(a ^ b)).all()
    assert len(set(simhash.pivots().tolist())) == simhash.PIVOTS


def fingerprint_bit_by_bit(text):
    """The contract's words, without the operator's code."""
    import xxhash

    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_bit_by_bit(spark):
    draw = random.Random(21)
    texts = [(i, prose(draw, draw.randint(0, 90), 40).replace(" w1", draw.choice([" É", "\n\x0bW1", " A\x1cB", "\u00a0w"]))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "one"), (203, "a b c"), (204, "a b c d"), (205, "x " * 70_000)]
    got = {r["key"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(docs(spark, texts)).collect()}
    assert got == {i: fingerprint_bit_by_bit(t) for i, t in texts}


# --- passages ---


def removed(texts, window=20):
    seen, out = set(), {}
    for i, text in sorted(texts, key=lambda x: (x[0] is None, x[0])):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        gone = set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = (len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone))
    return out


def test_passages_equal_brute_force(spark):
    draw = random.Random(6)
    shared = [prose(draw, n, 500) for n in (19, 20, 21, 45)]
    texts = [(i, " ".join(draw.choice([prose(draw, 15, 500), *shared]) for _ in range(6))) for i in range(40)]
    texts += [(50, "ü  ö\n" * 30), (51, "ü ö " * 30), (52, None), (53, ""), (54, "of " * 300), (55, "of " * 3 + " of" * 25), (56, texts[0][1]), (None, texts[1][1])]
    for shard_bytes in (500, 8 << 20):
        later = passages.later_windows(docs(spark, texts), shard_bytes=shard_bytes)
        covered = defaultdict(set)
        for r in later.collect():
            covered[r["doc_id"]].update(range(r["start"], r["stop"] if r["stop"] is not None else r["start"] + 20))
        assert {i: len(c) for i, c in covered.items()} == {i: n for i, (_, n, _) in removed(texts).items() if n}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in passages.remove_passages(docs(spark, texts)).collect()}
    assert got == removed(texts)


def test_passages_odd_tables(spark):
    twice = passages.remove_passages(docs(spark, [(1, "a " * 40), (1, "a " * 40)])).collect()
    assert [(r["n_words"], r["n_removed"]) for r in twice] == [(40, 39), (40, 39)]
    assert passages.remove_passages(docs(spark, []).limit(0)).count() == 0


def test_long_words_and_pieces_hash_alike():
    line = b" ".join([b"x" * 10, b"y" * (3 << 20), b"z"] + [b"word%d" % i for i in range(200_000)])
    words = line.split(b" ")
    hashes = passages.word_hashes(line)
    assert len(hashes) == len(words) and hashes[0] == passages.word_hashes(b"x" * 10)[0] and hashes[-1] == passages.word_hashes(words[-1])[0]
    assert len(np.unique(hashes)) == len(set(words))


# --- contamination ---


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_contamination_equals_brute_force(spark):
    draw = random.Random(8)
    items = [(1, prose(draw, 30)), (2, prose(draw, 10)), (3, "Only four Words here"), (4, None), (5, "..."), (6, "of of of of of of of of of of of"), (2, prose(draw, 12)), (None, "Él no VA")]
    texts = [(i, " ".join([prose(draw, 8), draw.choice([x for _, x in items if x]).upper(), prose(draw, 8)])) for i in range(25)]
    texts += [(40, items[0][1][20:70]), (41, None), (42, ""), (43, "of, " * 60), (44, "only four words HERE"), (45, "El no va él no va Él NO va"), (0, "second text of id 0 " + items[1][1])]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, n_hit string")
    windows = defaultdict(set)
    for i, t in items:
        w = letter_words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add("" if i is None else str(i))
    want = []
    for i, t in texts:
        w, hit, found = letter_words(t), set(), set()
        for key, ids in windows.items():
            for s in range(len(w) - len(key) + 1):
                if tuple(w[s:s + len(key)]) == key:
                    hit.update(range(s, s + len(key)))
                    found |= ids
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    for bound in (1_000_000, 0):
        got = winnow.contamination(docs(spark, texts), bench, max_broadcast=bound).drop("text_hash").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    clean = winnow.drop_contaminated(docs(spark, texts), bench)
    assert sorted(r["text"] or "" for r in clean.collect()) == sorted(t or "" for (_, t), row in zip(texts, want) if not row[5])
    assert winnow.contamination(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0
    assert winnow.contamination(docs(spark, []).limit(0), bench).count() == 0


# --- vectors ---


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (v + rng.normal(size=16) * 0.1).tolist()) for i, v in enumerate(base[:30])]
    rows += [(200, base[0].tolist()), (201, (base[0] * 3).tolist()), (202, None), (203, [0.0] * 16), (204, [float("nan")] * 16), (205, [None] + [1.0] * 15), (206, [float("inf")] * 16), (207, [1.0, 2.0]), (208, [2.0, 4.0]), (209, [])]
    got = {r["vec_id"]: tuple(r)[1:] for r in quantised.near_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, n_links int"), spread=None).collect()}
    sound = {i: np.array(v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j, u in sound.items() if j != i and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9} for i, v in sound.items()}
    for i, _ in rows:
        reach, stack = {i}, [i]
        while stack:
            for j in links.get(stack.pop(), ()):
                if j not in reach:
                    reach.add(j)
                    stack.append(j)
        assert got[i] == (len(links.get(i, ())), min(reach), i == min(reach)), i


def test_recall_with_the_default_spread(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 32))
    near = base[:400] + rng.normal(size=(400, 32)) * 0.25
    every = np.concatenate([base, near])
    got = quantised.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id bigint, embedding array<double>"))
    unit = every / np.linalg.norm(every, axis=1, keepdims=True)
    want = int((unit @ unit.T >= 0.9).sum()) - len(every)
    assert 0.9 * want <= sum(r["n_links"] for r in got.collect()) <= want


def low_rank(rng, n, inner, dim, near):
    """``n`` vectors that fill ``inner`` of ``dim`` dimensions and ``near`` near-copies of the first of them."""
    base = rng.normal(size=(n, inner))
    every = np.concatenate([base, base[:near] + rng.normal(size=(near, inner)) * 0.15])
    return every @ np.linalg.qr(rng.normal(size=(dim, inner)))[0].T


def cosine_links(every):
    unit = every / np.linalg.norm(every, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    return close


def test_links_found_from_one_side_count_for_both_ends(spark):
    every = low_rank(np.random.default_rng(13), 1200, 6, 48, 300)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id bigint, embedding array<double>")
    close = cosine_links(every)
    # A margin that leaves out some lists: what is found is counted at both ends, so in all an even number, and no
    # vector of a component of two is without its link.
    got = {r["vec_id"]: r for r in quantised.near_vectors(df, spread=0.5).collect()}
    assert all(got[i]["n_links"] <= n for i, n in enumerate(close.sum(1).tolist()))
    groups = defaultdict(list)
    for r in got.values():
        groups[r["component_id"]].append(r["n_links"])
    assert all(min(g) > 0 and sum(g) % 2 == 0 for g in groups.values() if len(g) > 1)


def test_all_links_of_low_rank_vectors_are_found(spark):
    every = low_rank(np.random.default_rng(17), 1200, 6, 48, 300)
    got = quantised.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id bigint, embedding array<double>"))
    assert {r["vec_id"]: r["n_links"] for r in got.collect()} == dict(enumerate(cosine_links(every).sum(1).tolist()))


def test_vectors_without_a_key_link_like_others(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.1]), (7, [1.0, 0.2]), (None, [0.0, 1.0]), (None, [0.1, -1.0]), (None, [0.1, -1.0]), (8, [-1.0, 0.0]), (None, None)]
    got = quantised.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (None, 2, 7, None), (None, 2, 7, None), (7, 2, 7, True), (None, 0, None, None), (None, 1, None, None), (None, 1, None, None),
        (8, 0, 8, True), (None, 0, None, None)], key=str)


def test_code_distances_stand_by_code_and_query():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    quantiser = quantised.fit(x, 2000)
    codes, error = quantiser.encode(x[:100], np.full(100, 3))
    q = x[100:150]
    tables = quantiser.tables(q, 3)
    assert tables.shape == (len(quantiser.books), quantiser.books.shape[1], len(q)) and tables.dtype == np.float32
    stands_for = quantiser.centroids[3] + np.concatenate([book[codes[:, p]] for p, book in enumerate(quantiser.books)], axis=1)
    exact = np.linalg.norm(q[:, None] - stands_for[None], axis=2)
    reach = 0.9 + error
    i, j = quantiser.within(q, 3, codes, reach + quantised.SLACK)
    got = set(zip(i.tolist(), j.tolist()))
    assert set(zip(*map(np.ndarray.tolist, np.nonzero(exact <= reach[None])))) <= got
    assert got <= set(zip(*map(np.ndarray.tolist, np.nonzero(exact <= reach[None] + 1e-4)))) and got


# --- toxicity ---


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_lexicon_equals_trying_every_term():
    draw = random.Random(9)
    terms = {"".join(draw.choice("abc") for _ in range(draw.randint(3, 10))) + draw.choice(["", "*"]): draw.random() for _ in range(12)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(600):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 12)))
        best = None
        for term, weight in terms.items():
            letters = term.rstrip("*")
            near = min(edits(letters, word[:k]) for k in range(len(word) + 1)) if term.endswith("*") else edits(letters, word)
            if near <= toxicity.allowed(len(letters)) and (best is None or (near, -weight) < (best[0], -best[1])):
                best = (near, weight)
        assert lexicon.look(word) == (None if best is None else (best[1], best[0])), word


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon({"moron": 5.0}, exempt=["oron"])
    names = dict(zip(toxicity.FEATURES, toxicity.features("He said “you moron” there", lexicon)))
    assert names["exact"] == 0 and names["quoted_hits"] > 0 and names["cued_hits"] > 0
    names = dict(zip(toxicity.FEATURES, toxicity.features("you M0ron, morron! oron", lexicon)))
    assert names["near"] > 0 and names["near_hits"] > 0 and names["exact"] == 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_toxicity_learns_and_is_held_out(spark):
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        rows.append((i, prose(draw, 20, 200) + (" " + draw.choice(["scumbag", "vilestem" + draw.choice("abcdefgh"), "wretched"]) if toxic else "")))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "you scumbagg " * 3), (None, "plain words")]
    known = spark.createDataFrame(labels + [(5, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs(spark, rows), known)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs(spark, rows).drop("score"), model).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels)
    assert got[1000] == got[1001] < 0.5 and all(0 <= s <= 1 for s in got.values())
    kept = toxicity.drop_toxic(docs(spark, rows), known)
    assert kept.count() == 600 - 150 + 4 - (got[1002] >= 0.5)
    scores = toxicity.score_texts(docs(spark, rows).drop("score"), model).select("doc_id", "score").collect()
    assert all(r["score"] == model.scorer()(dict(rows)[r["doc_id"]]) for r in scores)
    assert toxicity.fit(docs(spark, rows), known.limit(0)).base == 0.0 and toxicity.fit(docs(spark, []).limit(0), known).base == 0.0


def test_tail_is_the_whole_tail():
    from math import comb, log

    for t, n, share in [(0, 5, 0.3), (3, 3, 0.1), (2, 40, 0.5), (100, 1000, 0.5), (7, 900, 0.002), (990, 1000, 0.9)]:
        want = log(sum(comb(n, k) * share ** k * (1 - share) ** (n - k) for k in range(t, n + 1)))
        assert abs(toxicity._tail(t, n, share) - want) < 1e-6
    fewest = toxicity.least_count(300, 2700, 100_000)
    assert toxicity._tail(fewest, fewest, 0.1) <= log(0.05 / 100_000) < toxicity._tail(fewest - 1, fewest - 1, 0.1)


def test_toxicity_query_says_who_was_held_out(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    got = toxicity.op10_toxicity(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1


# --- columns of the caller ---

CLASHING = ("_toxicity", "toxicity", "row_one", "_row", "bad_id", "text_hash", "_id", "_hash", "doc", "starts", "n_words", "kept_text", "members", "_key", "given", "TOXICITY", "score")


@pytest.mark.parametrize("name", ["drop_toxic", "keep_one", "remove_passages", "drop_contaminated", "mix", "keyed"])
def test_columns_of_the_caller_stay(spark, name):
    draw = random.Random(2)
    texts = [(i, prose(draw, 40, 5000)) for i in range(12)] + [(None, "no id"), (20, None)]
    columns = [c for c in dict.fromkeys(CLASHING) if c != "TOXICITY"]
    rows = [(i, t, "en", "s", 1, {"k": str(i)}, *[f"{c} {i}" for c in columns]) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, `a map` map<string,string>, " + ", ".join(f"`{c}` string" for c in columns))
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, prose(draw, 12, 9))], "item_id bigint, text string")
    done = {
        "drop_toxic": lambda: toxicity.drop_toxic(df, labels), "keep_one": lambda: simhash.keep_one(df),
        "remove_passages": lambda: passages.remove_passages(df, results=("r1", "r2", "r3")).drop("r1", "r2", "r3"),
        "drop_contaminated": lambda: winnow.drop_contaminated(df, items),
        "mix": lambda: mixing.mix(df, F.array("source"), F.length(F.coalesce("text", F.lit(""))).cast("bigint"), F.col("doc_id"))[0].drop("size", "parts", "taken"),
        "keyed": lambda: tokens.keyed(df)}[name]()
    assert done.columns == df.columns
    got = {r["n_words"]: tuple(r)[1:] for r in done.collect()}
    assert got == {f"n_words {i}": tuple(r[1:]) for r, (i, _) in zip(rows, texts)}
