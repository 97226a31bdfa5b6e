"""Archives, chats, licences, tokens, mixing: brute force and round trips on small rows."""

import base64
import gzip
import hashlib
import re

import pytest

from lettermill.llm import chat, licences, mixing, tokens, warc
from lettermill.llm.common import fresh_dir

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, size string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", s, None, "x", "y") for i, t, s in texts], DOCS)


# --- warc ---


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip_with_odd_bodies(version):
    records = [("http://a b/c", "1.2.3.4", "text/html", b"HTTP/1.1 200 OK\r\n\r\nx\nhttp://fake 1.1.1.1 2000 text/html 3\n"), ("http://d", "0.0.0.0", "image/gif", b"\x00\xff\n"), ("http://e", "0.0.0.0", "t/p", b"")]
    content = warc.arc_bytes(records, version, "n.arc", "19990203040506")
    for given in (content, gzip.compress(content)):
        read = list(warc.parse_arc(given))
        assert read[0].is_description and [(r.fields["URL"], r.body) for r in read[1:]] == [(u, b) for u, _, _, b in records]
        assert not any(r.problem for r in read)


def test_arc_damage_is_told():
    content = warc.arc_bytes([("http://a", "0.0.0.0", "t/p", b"body")], 1, "n.arc", "2000")
    assert list(warc.parse_arc(content[:-3]))[-1].problem == "2 bytes missing"
    assert "skipped" in list(warc.parse_arc(content.replace(b"http://a", b"junk\nhttp://a")))[-1].problem
    assert list(warc.parse_arc(b"")) == []


def test_damaged_archives_are_read_as_far_as_they_go(spark):
    records = [(f"http://a/{i}", "0.0.0.0", "t/p", b"body %d " % i * 300) for i in range(40)]
    content = warc.arc_bytes(records, 1, "n.arc", "2000")
    packed = gzip.compress(content)
    cut = list(warc.parse_arc(packed[:-40]))
    assert [r.body for r in cut[1:-1]] == [b for *_, b in records[:len(cut) - 2]] and len(cut) > 20
    broken = list(warc.parse_arc(packed[:len(packed) // 2] + b"\xff" * 60 + packed[len(packed) // 2 + 60:]))
    assert broken and all(r.fields["Archive-length"].isdecimal() for r in broken)
    assert [r.body for r in warc.parse_arc(gzip.compress(content[:5000]) + gzip.compress(content[5000:]))] == [r.body for r in warc.parse_arc(content)]
    assert list(warc.parse_arc(b"\x1f\x8b junk")) == []
    assert len(list(warc.parse_arc(content.replace(b"\n1 0 lettermill\n", b"\n1.1 0 x\n        \n")))) == 41
    odd = content.replace(b"http://a/7 0.0.0.0 2000 t/p 2100", "http://a/7 0.0.0.0 2000 t/p ²²²".encode())
    assert [r.problem is None for r in warc.parse_arc(odd)].count(False) == 1 and len(list(warc.parse_arc(odd))) == 40
    archives = spark.createDataFrame([("a", packed[:-40]), ("b", odd), ("c", b""), ("d", None), ("e", b"\x1f\x8b\x08")], "path string, content binary")
    assert warc.convert_arc(archives).count() == len(cut) + 40


def test_warc_date_and_digest():
    assert warc.warc_date("20010203") == "2001-02-03T00:00:00Z" and warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert warc.digest32(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode()


def test_pages_through_warc(spark):
    pages = [(3, "u", "same"), (1, "http://x", "same"), (2, None, None), (5, "http://y z", ""), (9, "u", "WARC/1.1\r\n\r\nWARC/1.1"), (None, "u", "same"), (7, "u", "ü" * 70000), (1, "http://x", "same")]
    df = spark.createDataFrame([(i, u, h, "extra") for i, u, h in pages], "page_id bigint, url string, html string, record_type string")
    got = sorted((tuple(r)[:6] for r in warc.pages_through_warc(df, fresh_dir(spark, "t")).collect()), key=str)
    want = []
    for i, _, h in pages:
        payload = (h or "").encode()
        first = min(x for x, _, g in pages if (g or "") == (h or "") and x is not None)
        revisit = i != first
        want.append((i, len(payload), warc.digest32(payload), "revisit" if revisit else "response", first if revisit else None, None if revisit else True))
    assert got == sorted(want, key=str)
    assert warc.pages_through_warc(df.limit(0), fresh_dir(spark, "t")).count() == 0


# --- chat ---


def test_chat_round_trip_and_order(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\s>", "[\\\\INST]", "<<s>", "[", "\\", "", "[END][/ROLE]", "a\n<s>b", "$1 \\1"]
    rows = [(i, t, r, x, "e") for i, x in enumerate(nasty) for t, r in ((0, "user"), (1, "assistant"))] + [
        (50, 1, "user", "late", "e"), (50, 0, "assistant", "early", "e"), (51, None, None, None, "e"), (51, 1, "tool [END]", "x", "e"), (52, 0, "user", "a", "e"), (52, 0, "user", "a", "e"), (None, 0, "user", "q", "e")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, valid string")
    got = {r["conv_id"]: r for r in chat.chat_digest(chat.format_conversations(df)).collect()}
    for key in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x, _ in rows if i == key))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        learned = "".join(x for _, _, r, x in turns if r == "assistant")
        assert got[key]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest(), key
        assert (got[key]["n_turns"], got[key]["loss_chars"], got[key]["loss_sha256"]) == (len(turns), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[0]["valid"] and not got[50]["valid"] and got[50]["first_bad_turn"] == 0 and got[52]["first_bad_turn"] == 1
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_templates_are_checked():
    with pytest.raises(ValueError):
        chat.ChatTemplate(other=chat.RoleMarks("[A[B]", "[END]"))


# --- licences ---


def test_licence_scan(spark):
    texts = [(1, "Released UNDER the MIT-License, and under the mit license.", "a"), (2, "licensed under the apachi licence version 2", "a"), (3, "nothing here", "a"), (4, None, "a"), (5, "", "a"),
             (6, "CC BY-NC and cc by nc", "a"), (7, "word " * 40000 + "all rights reserved", "a"), (8, "permitted all right reserve d", "a")]
    got = {r["doc_id"]: r for r in licences.scan_digest(licences.scan_licences(docs(spark, texts))).collect()}
    for i, text, _ in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        places = [(p, lab) for phrase, lab in licences.BASE_PHRASES for p in range(len(words)) if words[p:p + len(phrase.split())] == phrase.split()]
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(p for p, _ in places), max(p for p, _ in places)) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted({lab for _, lab in places})) and 0 <= row["score"] <= 1
    assert got[2]["labels"] == "apache-2" and got[2]["score"] < 1 and got[7]["labels"] == "reserved" and got[3]["labels"] == "" and got[3]["score"] == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_labels_equal_trying_every_place():
    """A notice is found if and only if some run of whole words is within its errors; its span is such a run."""
    import random

    draw = random.Random(4)
    notices = [licences.Notice("one", "all rights reserved", 1), licences.Notice("two", "free of charge to any", 2), licences.Notice("three", "gnu public license", 3)]
    scanner = licences.Scanner(notices, [])
    words = ["all", "rights", "reserved", "free", "of", "charge", "to", "any", "gnu", "public", "license", "x", "oft", "right"]

    def damaged(text):
        letters = list(text)
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(letters))
            letters[at:at + draw.randint(0, 1)] = draw.choice(["", "e", " ", "q"])
        return "".join(letters)

    found_any = 0
    for _ in range(250):
        line = " ".join(" ".join(draw.choice([draw.choice(words), damaged(draw.choice(notices).words)]) for _ in range(draw.randint(1, 4))).split())
        starts, ends = [0, *[i + 1 for i, c in enumerate(line) if c == " "]], [*[i for i, c in enumerate(line) if c == " "], len(line)]
        want = {n.label for n in notices if any(a < b <= a + len(n.words) + n.max_errors and distance(line[a:b], n.words) <= n.max_errors for a in starts for b in ends)}
        got = scanner.fuzzy(line)
        assert {label for label, *_ in got} == want, line
        cut = line.split(" ")
        for label, first, last, errors in got:
            notice = next(n for n in notices if n.label == label)
            assert distance(" ".join(cut[first:last + 1]), notice.words) <= errors <= notice.max_errors
        found_any += bool(want)
    assert found_any > 100


def test_base_columns_equal_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = db.execute(licences.OP6_BASE_SQL)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, licences.op6_licences(spark, sf).select(*names).collect())) == sorted(want.fetchall())


def test_pieces_cover_the_notice():
    for notice in licences.NOTICES:
        assert "".join(p for _, p in licences.pieces(notice)) == notice.words and len(licences.pieces(notice)) == notice.max_errors + 1


def test_licences_after_other_lead_ins(spark):
    texts = [(1, "Distributed under the MIT Licence", "a"), (2, "available under the Apache Lisense, Version 2.0", "a"), (3, "terms: CCBY-NC", "a"),
             (4, "distributed under the MPL License", "a"), (5, "the Apache License, Version 1.1", "a"), (6, "under CC BY-ND", "a")]
    got = {r["doc_id"]: r["labels"] for r in licences.scan_digest(licences.scan_licences(docs(spark, texts))).collect()}
    assert got == {1: "mit", 2: "apache-2", 3: "cc-by-nc", 4: "", 5: "", 6: ""}


# --- tokens ---


def test_documents_without_an_id_are_all_counted(spark, tmp_path):
    rows = [(None, "one two", "s"), (None, "one two", "s"), (None, "other words here", "s"), (None, "", "s"), (None, None, "s"), (4, "one two", "s"), (None, "one two", "t")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["source"], r["n_docs"], r["n_chars"]) for r in tokens.op5_tokens(spark, str(tmp_path)).collect())
    assert got == [("s", 4, 7 + 7 + 16 + 7), ("t", 1, 7)]


def test_totals_are_those_of_every_document(spark):
    import base64
    from collections import defaultdict

    import tiktoken

    with open(tokens.TOKENIZER_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("plain", pat_str=tokens.TOKENIZER_PATTERN, mergeable_ranks=ranks, special_tokens={})
    sf, want = "/root/testdata/sf0.001", defaultdict(lambda: [0, 0, 0])
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = len(encoding.encode_ordinary(r["text"] or ""))
        if n:
            for k, x in enumerate((1, n, len(r["text"]))):
                want[r["source"], r["lang"]][k] += x
    got = {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"], r["n_chars"]] for r in tokens.op5_tokens(spark, sf).collect()}
    assert got == dict(want)


def test_rollup_is_idempotent_and_signed(spark):
    store = tokens.TokenRollup(spark, fresh_dir(spark, "rollup"))
    schema = "doc_id bigint, tokenizer string, source string, lang string, deleted boolean, n_tokens bigint, n_chars bigint"
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    first = batch((1, "t", "a", "en", False, 10, 5), (2, "t", "a", "en", False, 1, 1), (3, "t", None, None, False, 7, 7), (2, "t", "a", "en", False, 1, 1))
    assert store.commit("1", first) and not store.commit("1", first)
    assert store.commit("2", batch((1, "t", "b", "en", False, 12, 5), (2, "t", "a", "en", True, 0, 0), (9, "t", "a", "en", True, 0, 0), (1, "u", "b", "en", False, 4, 5)))
    got = sorted((tuple(r) for r in store.totals().collect()), key=str)
    assert got == sorted([("b", "en", "t", 1, 12, 5), (None, None, "t", 1, 7, 7), ("b", "en", "u", 1, 4, 5)], key=str)
    with pytest.raises(ValueError):
        store.commit("0", first)


def test_rollup_writes_a_broken_batch_anew(spark):
    path = fresh_dir(spark, "rollup")
    store = tokens.TokenRollup(spark, path)
    rows = spark.createDataFrame([(1, "t", "a", "en", False, 3, 3)], "doc_id bigint, tokenizer string, source string, lang string, deleted boolean, n_tokens bigint, n_chars bigint")
    rows.write.parquet(f"{path}/ledger/batch=1")  # broke off before its rollup
    assert store.totals().count() == 0 and store.commit("1", rows) and store.totals().first()["n_tokens"] == 3


def test_count_tokens(spark):
    got = tokens.count_tokens(docs(spark, [(1, "a b c", "s"), (2, None, "s"), (3, "", "s")]), lambda: lambda text: len(text.split()))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect()) == [(1, 3), (2, 0), (3, 0)]


# --- mixing ---


def test_targets_fill_like_vessels():
    sizes = {"a": 10, "b": 1000, "c": 1000, None: 500}
    got = mixing.targets(sizes)
    assert got["a"] == 20 and abs(sum(got.values()) - 1.5 * 2510) < 1e-6 and all(got[s] <= 2 * n + 1e-9 for s, n in sizes.items())
    assert mixing.targets({"a": 0}) == {"a": 0.0} and mixing.targets({}) == {}


def test_flow_prefers_first_copies_and_fills_quotas():
    patterns = {("a",): 100, ("a", "b"): 100, ("b",): 10}
    flow = mixing.route(patterns, {"a": 120, "b": 90})
    assert flow[("a",)]["a"] + flow[("a", "b")]["a"] == 120 and flow[("a", "b")]["b"] + flow[("b",)]["b"] == 90
    assert all(sum(f.values()) <= patterns[p] for p, f in flow.items())  # no second copies: the first suffice
    flow = mixing.route({("a",): 50}, {"a": 80})
    assert flow == {("a",): {"a": 80}} and mixing.route({("a",): 50}, {"a": 500}) == {("a",): {"a": 100}}


def test_mix_comes_near_targets_and_reruns_agree(spark):
    texts = [(i, "w " * (i % 17), ["a", "b", None, "c"][i % 4] if i % 3 else "a") for i in range(300)] + [(500, None, "a"), (None, "x y", "b"), (7, "dup dup", "a"), (7, "dup dup", "a")]
    df = docs(spark, texts)
    runs = [sorted((tuple(r) for r in mixing.mix_documents(df.repartition(n)).collect()), key=str) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == len(texts)
    taken = {}
    for _, source, size, source_size, target, got in runs[0]:
        assert 0 <= got <= 2 * size
        taken.setdefault(source, [0, target])[0] += got
    assert all(abs(got - target) <= 1 for got, target in taken.values())
    assert mixing.mix_documents(df.limit(0)).count() == 0


def test_mix_of_overlapping_sources(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, ["a"] if i % 2 else ["a", "b"], 10) for i in range(40)], "doc_id bigint, m array<string>, n bigint")
    mixed, sizes, wanted = mixing.mix(rows, F.col("m"), F.col("n"), F.col("doc_id"))
    got = {}
    for r in mixed.collect():
        assert r["taken"] == sum(p["taken"] for p in r["parts"]) <= 20
        for p in r["parts"]:
            got[p["source"]] = got.get(p["source"], 0) + p["taken"]
    flow = mixing.route({("a",): 200, ("a", "b"): 200}, {s: int(t) for s, t in wanted.items()})
    assert sizes == {"a": 400, "b": 200} and got == {s: sum(f.get(s, 0) for f in flow.values()) for s in sizes}
