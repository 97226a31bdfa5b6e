"""The filter audit against a plain loop over all orders, arrivals in any order, and its odd rows."""

import random
import re
from collections import Counter
from itertools import permutations

from lettermill.llm import filter_audit
from lettermill.llm.common import fresh_dir

DOCS = "doc_id bigint, text string, source string, part string, mask string, n string"
LABELS = "doc_id bigint, quality int, toxic int, good string"


def failed(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text))}


def brute_force(docs, labels):
    judged = []
    for i, text, source in docs:
        fails = failed(text)
        fails["E"] = any((t or "") == (text or "") and j is not None and (i is None or j < i) for j, t, _ in docs)
        own = [x for x in labels if i is not None and x[0] == i]
        judged.append((source or "", {f for f in fails if fails[f]}, any(q == 1 for _, q, _ in own), any(t == 1 for *_, t in own)))
    out, shapley = [], Counter()
    for part in {p for p, *_ in judged}:
        for order in permutations("ABCDE"):
            left = [x for x in judged if x[0] == part]
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                earlier = [x for x in judged if x[0] == part and f in x[1] and not any(x is y for y in left)]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), len(earlier),
                            sum(x[0] == part and x[1] == {f} for x in judged), sum(x[2] for x in gone), sum(x[3] for x in gone), f])
    return sorted(tuple([*r[:-1], shapley[r[0], r[-1]]]) for r in out)


def prose(draw, n, kinds=300):
    return " ".join(f"w{draw.randrange(kinds)}" for _ in range(n))


def some_texts(draw):
    texts = [prose(draw, draw.choice([5, 150, 199, 200, 201, 230]), draw.choice([60, 100, 800])) for _ in range(25)]
    texts += [t + draw.choice([" #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3, "é" * 40, " x", "\x0b|"]) for t in texts[:12]]
    return [*texts, None, "", " ", "A", "É", "\t\n", "AB" + "x" * 98, "AB" + "x" * 97]


def write(spark, rows, files):
    """The rows as files that are read one after the other in this order."""
    place = fresh_dir(spark, "docs")
    for n in range(files):
        spark.createDataFrame([(*r, "p", "m", "n") for r in rows[n::files]], DOCS).coalesce(1).write.mode("append").parquet(place)
    return place


def audit(spark, rows, labels, files=3, **how):
    marks = spark.createDataFrame([(*x, "g") for x in labels], LABELS)
    counters = filter_audit.count_masks(spark, write(spark, rows, files), marks, **how)
    return sorted(tuple(r) for r in filter_audit.interactions(counters).collect())


def test_equals_a_plain_loop(spark):
    draw = random.Random(4)
    texts = some_texts(draw)
    rows = [(draw.randrange(1000), draw.choice(texts), draw.choice(["s", "t", "", None])) for _ in range(160)]
    rows += [(None, texts[0], "s"), (None, texts[0], "t"), (None, texts[0], "s"), (None, "only without ids", "s"), (None, "only without ids", "s"),
             (2000, texts[3], "s"), (2000, texts[3], "t"), (2000, "another text of 2000", "t"), (-5, texts[5], "late"), (-(1 << 63), texts[6], "s")]
    rows += [(5000 - i, texts[1], "s") for i in range(60)]  # smaller ids of one text keep arriving
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, 2])) for i in range(0, 1000, 2)]
    labels += [(2000, 1, 0), (2000, 0, 1), (None, 1, 1), (9999, 1, 1), (4950, 1, 1)]
    assert audit(spark, rows, labels, files=4, texts_per_key=20) == brute_force(rows, labels)


def test_any_order_of_arrival_gives_the_same_counters():
    import pandas as pd

    draw = random.Random(9)
    rows = [(draw.choice([b"a", b"b", b"c", None]), draw.choice([1, 2, 3, 4, 5]), draw.random() < 0.2, draw.randrange(16), draw.choice("st"), True, False, draw.randint(1, 3))
            for _ in range(80)]
    rows = [(d, 0 if u else i, u, {b"a": 3, b"b": 0, b"c": 9, None: m}[d], p, g, t, n) for d, i, u, m, p, g, t, n in rows]
    results = []
    for _ in range(20):
        draw.shuffle(rows)
        held, total = None, Counter()
        cuts = sorted(draw.sample(range(1, 79), 5))
        for a, b in zip([0, *cuts], [*cuts, 80]):
            held, deltas = filter_audit.settle(held, pd.DataFrame(rows[a:b], columns=filter_audit.HELD))
            held = filter_audit._unpack(filter_audit._pack(held))
            for part, mask, *counts in deltas.itertuples(index=False):
                for name, c in zip(("n", "good", "toxic"), counts):
                    total[part, mask, name] += c
        results.append({k: v for k, v in total.items() if v})
    assert all(r == results[0] for r in results)
    want = Counter()
    for d, i, u, m, p, *_, n in rows:
        copy = d is None or any(e == d and (u, i) > (v, j) for e, j, v, *_ in rows)
        want[p, m | 16 * copy, "n"] += n
        want[p, m | 16 * copy, "good"] += n
    assert results[0] == want


def test_all_steps_are_there_with_zeros(spark):
    got = audit(spark, [(1, prose(random.Random(1), 300, 9000), "s")], [], files=1)
    assert len(got) == 600 and {r[3:] for r in got} == {(1, 0, 0, 0, 0, 0, 0)} and len({r[1] for r in got}) == 120
    assert audit(spark, [], [], files=1) == []


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    df, want = filter_audit.op13_filter_audit(spark, sf), db.execute(filter_audit.OP13_SQL)
    assert df.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.fetchall()))
