"""Token files: the code against plain versions, texts cut at spaces against whole ones, files against a plain loop."""

import heapq
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lettermill.llm import token_files
from lettermill.llm.common import fresh_dir

BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
OTHER = public_tokenizers.path("word_bpe_49k.json")
ROWS = "doc_id bigint, text string, part int, n string, ids array<int>"


def docs(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, 1, "x", [3]) for i, t in texts], ROWS).repartition(parts)


def free_cost(counts):
    """Total size of a Huffman code without a limit."""
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_lengths_are_the_best_under_the_limit():
    draw = random.Random(1)
    for _ in range(60):
        counts = np.array([draw.choice([0, 1, 1, 2, 5, 40, 1000]) for _ in range(draw.randint(2, 6))])
        n, limit = int((counts > 0).sum()), draw.randint(3, 5)
        lengths = token_files.limited_lengths(counts, limit)
        if n > 1:
            fits = [x for x in itertools.product(range(1, limit + 1), repeat=n) if sum(2.0 ** -v for v in x) <= 1]
            assert (lengths * counts).sum() == min(sum(a * b for a, b in zip(x, counts[counts > 0])) for x in fits)
            assert sum(2.0 ** -int(v) for v in lengths if v) == 1 and ((lengths > 0) == (counts > 0)).all()
    skewed = np.array([1 << min(k, 40) for k in range(60)])
    assert (token_files.limited_lengths(skewed, 60) * skewed).sum() == free_cost(skewed)
    assert token_files.limited_lengths(skewed, 7).max() == 7
    assert token_files.limited_lengths(np.ones(300, int), 5).max() == 9  # raised: 5 bits cannot tell 300 apart
    assert token_files.limited_lengths(np.array([0, 7]), 9).tolist() == [0, 1] and not token_files.limited_lengths(np.zeros(3, int)).any()


def bit_by_bit(code, data, sizes):
    """Decodes rows with no table: bits are read until they are a code word."""
    words = {(int(code.lengths[s]), int(code.codes[s])): s for s in code.symbols}
    out, at = [], 0
    for n in sizes:
        for _ in range(n):
            size, value = 0, 0
            while (size, value) not in words:
                value = value << 1 | data[at >> 3] >> (7 - (at & 7)) & 1
                size, at = size + 1, at + 1
            out.append(words[size, value])
        at = -(-at // 8) * 8
    return out


@pytest.mark.parametrize("n_symbols, limit", [(1, 18), (2, 18), (700, 18), (700, 10), (60_000, 18)])
def test_packed_rows_decode_from_their_checkpoints(n_symbols, limit):
    rng = np.random.default_rng(n_symbols)
    sizes = np.array([1, 63, 64, 65, 1, 500, 128, 7])
    ids = (n_symbols * rng.random(sizes.sum()) ** 4).astype(np.int64)
    counts = np.bincount(ids, minlength=n_symbols) + (np.arange(n_symbols) % 3 == 0)
    code = token_files.Code(token_files.limited_lengths(counts, limit))
    bits, n_bytes, run_bits = token_files.pack(code, ids, sizes)
    assert bit_by_bit(code, bits, sizes) == ids.tolist()
    flags = np.array([2, 3, 2, 2, 2, 2, 2, 0])
    content = b"\n".join([token_files.file_header(4, code), token_files.block(np.arange(8), flags, sizes, run_bits.astype("<u2").tobytes(), bits)] * 1) + b"\n"
    content += content[len(token_files.file_header(4, code)) + 1:]  # the block once more
    file, = token_files.parts(content)
    assert file.part == 4 and [(i.tolist(), f.tolist(), s.tolist(), x.tolist()) for i, f, s, x in file.blocks()] == [
        (list(range(8)), flags.tolist(), sizes.tolist(), ids.tolist())] * 2
    twice = ids.tolist() * 2
    for start, n in [(0, 1), (0, len(twice)), (100, 64), (len(ids) - 3, 9), (len(ids), 5), (700, 0), (len(twice) - 1, 50)]:
        assert file.ids(start, n).tolist() == twice[start:start + n]
    damaged = bytearray(content)
    damaged[-5] ^= 1
    with pytest.raises(ValueError):
        token_files.parts(bytes(damaged))


def test_pieces_change_no_id():
    encode, whole = token_files.TextEncoder(BYTE_PAIRS, known=50), Tokenizer.from_file(BYTE_PAIRS)
    assert encode.by_piece
    draw = random.Random(3)
    odd = ["a", "'s", "'S", "it's", "1", "42", "é", "ß ü", "中文", "́", "٣", "²", "😀", "<|endoftext|>", "<|end", " ", "  ", "\n", " \n", "\n ", "\t", "\x1c", " ", " ", "᠎", "​", "\x00", ".", "...", "_", "﻿"]
    texts = ["".join(draw.choice(odd) for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    texts += [f"a {chr(c)}b {chr(c)} c{chr(c)} d1{chr(c)}2" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    other, plain = token_files.TextEncoder(OTHER), Tokenizer.from_file(OTHER)
    assert not other.by_piece and np.frombuffer(other("It's  A b"), "<u4").tolist() == plain.encode("It's  A b", add_special_tokens=False).ids


def expected(texts, path=BYTE_PAIRS):
    whole, at, out = Tokenizer.from_file(path), 0, []
    for i, t in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("path", [BYTE_PAIRS, OTHER])
def test_files_equal_a_plain_loop(spark, path):
    draw = random.Random(5)
    texts = [(draw.randint(-10**12, 10**12), " ".join(draw.choice(["the", "naïve", "ox", "1.5\n", "  tab\t"]) for _ in range(draw.randint(0, 200)))) for _ in range(150)]
    texts += [(7, None), (8, ""), (9, " "), (None, "no id"), (-(1 << 63), "least"), ((1 << 63) - 1, "most"), (10, "long " * 90_000)]
    place = fresh_dir(spark, "t")
    token_files.write_token_files(docs(spark, texts), place, path, file_tokens=4000)
    got = sorted((tuple(r) for r in token_files.documents_in(spark, place).collect()), key=lambda r: r[1])
    assert got == expected(texts, path)
    contents = [r["content"] for r in spark.read.format("binaryFile").load(place).collect() if r["content"]]
    assert len(contents) > 3
    files = sorted((f for c in contents for f in token_files.parts(c)), key=lambda f: f.part)
    assert len({f.part for f in files}) == len(files)
    whole = np.concatenate([x for f in files for *_, x in f.blocks()])
    plain = Tokenizer.from_file(path)
    assert whole.tolist() == [x for i, t in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0))
                              for x in plain.encode(t or "", add_special_tokens=False).ids + [2]]


def test_repeated_rows_follow_each_other(spark):
    texts = [(1, "a"), (2, "same"), (2, "same"), (2, "another text"), (None, "x"), (None, "x"), (3, "b")]
    place = fresh_dir(spark, "t")
    token_files.write_token_files(docs(spark, texts), place, BYTE_PAIRS, file_tokens=3)
    got = sorted((tuple(r) for r in token_files.documents_in(spark, place).collect()), key=lambda r: r[1])
    want = expected(texts)
    assert sorted((r[0] is None, r[0], r[2], r[3]) for r in got) == sorted((r[0] is None, r[0], r[2], r[3]) for r in want)
    assert [r[0] for r in got] == [1, 2, 2, 2, 3, None, None]
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))


def test_hot_ids_and_rows_without_one_are_spread(spark):
    texts = [(5, f"text {i}") for i in range(60)] + [(None, f"none {i}") for i in range(60)] + [(i, "x y") for i in range(60)]
    place = fresh_dir(spark, "t")
    token_files.write_token_files(docs(spark, texts), place, BYTE_PAIRS, file_tokens=40)
    got = sorted((tuple(r) for r in token_files.documents_in(spark, place).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([t[0] for t in texts], key=lambda i: (i is None, i or 0))
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:])) and sorted(r[3] for r in got) == sorted(r[3] for r in expected(texts))
    sizes = [sum(len(x) for *_, x in f.blocks()) for r in spark.read.format("binaryFile").load(place).collect() for f in token_files.parts(r["content"])]
    assert len(sizes) > 8 and max(sizes) < sum(sizes) / 4


def test_empty_table(spark):
    place = fresh_dir(spark, "t")
    token_files.write_token_files(docs(spark, [(1, "x")]).limit(0), place, BYTE_PAIRS)
    assert token_files.documents_in(spark, place).count() == 0


def test_query_equals_a_plain_loop(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in token_files.op11_token_files(spark, sf).collect()), key=lambda r: r[1])
    assert got == expected([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
