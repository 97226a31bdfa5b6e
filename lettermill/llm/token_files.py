"""Token ids in binary files under a canonical, length-limited Huffman code fitted on the counts of all ids.

1. Every text is encoded once; its ids are staged (Parquet), cut into rows of at most ``ROW_TOKENS``.
2. All ids are counted. The counts, one per id of the vocabulary, give the code; it is stated by its lengths alone.
3. Rows are coded, dealt into ranges of doc_id and sorted there; a range is a part, written by Spark's text writer
   and its commit, so that lost executors and repeated tasks leave no half or double file.
4. A reader needs a part alone: its header holds the code lengths. Files are read whole, blocks one at a time.

A file holds one part or more, a part is a row of frames, each ``<4s magic><u32 bytes><u32 crc32 of the body><body><line feed>``:

* ``HTF1``, first: ``<u32 part><u32 ids in the code><u8 longest code>`` and the code lengths, a byte per id, deflated.
* ``HTB1``, a block that can be decoded by itself: ``<u32 rows>``, then arrays by row (doc_id i64; flags u8: 1 no doc_id, 2 a
  document starts; tokens u32), bits of every run of ``RUN`` tokens (u16, the bit offsets of the checkpoints by adding
  them up), and the bits. A row starts at a byte, and so every checkpoint's place is known without reading any bits.

All numbers are little-endian, bits stand from the highest of a byte down.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.llm.common import fresh_dir, table

END_ID = 2
MAX_BITS = 18
RUN = 64
ROW_TOKENS = 1 << 16
BLOCK_TOKENS = 1 << 18
FILE_TOKENS = 1 << 24
KNOWN_PIECES = 400_000  # pieces whose ids a worker remembers, and stretches of them; it only saves work
FILE, BLOCK = b"HTF1", b"HTB1"

# A single space between characters that are no white space: byte-level pieces never reach across its left side.
_BORDER = re.compile(r"(?<=\S) (?=\S)")
# White space other than the space and the line feed. Looked for one by one, which costs a tenth of a pattern of them all.
_ODD_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_ODD_ASCII = [c for c in _ODD_SPACES if c.isascii()]
_ASCII_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
# A word of Latin letters and what closes it: two pieces at most.
_WORD = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([,.;:!?]*)")


# --- ids of texts ---


class TextEncoder:
    """The ids the tokenizers library gives whole texts, without special tokens of its own, as little-endian u32.

    Where the tokenizer is plain byte-level pairs, texts are cut at single spaces first, which changes no id, and the
    pieces between are encoded once each; any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, known: int = KNOWN_PIECES) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), known
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before, added = told.get("pre_tokenizer") or {}, told.get("added_tokens") or []
        self.special = [a["content"] for a in added]
        self.by_piece = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
            and told.get("normalizer") is None and told.get("truncation") is None and told["model"].get("type") == "BPE"
            and not any(told["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
            and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or re.search(r"\s", a["content"]) for a in added))
        # Byte-level pairs are over characters: a printable Latin-1 byte stands for itself, the others follow from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.letters = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in printable)}
        self.space = chr(self.letters[32])
        self.by_word = self.by_piece and not any(_WORD.fullmatch(s) for s in self.special)
        if self.by_piece:  # the model alone, without its own memory of pieces, which costs more than it saves here
            from tokenizers.models import BPE

            pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in told["model"]["merges"]]
            self.pairs = BPE(told["model"]["vocab"], pairs, cache_capacity=0)
        self.pieces, self.stretches = _Known(self._piece, known), _Known(self._after_border, known)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, letters: str) -> bytes:
        """Ids of a piece in the vocabulary's own letters."""
        return array("I", [t.id for t in self.pairs.tokenize(letters)]).tobytes()

    def _stretch(self, text: str) -> bytes:
        """Ids of a text that starts and ends where pieces do."""
        if any(s in text for s in self.special):
            return self._whole(text)
        if text.isascii():
            return b"".join([self.pieces[p.translate(self.letters)] for p in _ASCII_PIECES.findall(text)])
        return b"".join([self.pieces[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)])

    def _after_border(self, rest: str) -> bytes:
        """Ids of a stretch that comes after a border, given without its space; a line feed at its start it keeps."""
        if self.by_word and rest.isascii():
            # Most stretches: a word, or a word and a mark.
            if rest.isalpha():
                return self._piece(self.space + rest)
            if rest[-1] in ",.;:!?" and rest[:-1].isalpha():
                return self.stretches[rest[:-1]] + self.pieces[rest[-1]]
        line = rest[0] == "\n"
        word = self.by_word and _WORD.fullmatch(rest, line)
        if not word:
            return self._stretch(rest if line else " " + rest)
        letters, close = word.groups()
        if close and not line:
            return self.stretches[letters] + self.pieces[close]
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.letters)
        if not line:
            return self._piece(self.space + letters)
        found = self.pieces[chr(self.letters[10])] + self.pieces[letters]
        return found + self.pieces[close] if close else found

    def __call__(self, text: str) -> bytes:
        if not self.by_piece:
            return self._whole(text)
        if not text:
            return b""
        if ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace()
                or any(map(text.__contains__, _ODD_ASCII if text.isascii() else _ODD_SPACES))):
            first, *rest = _BORDER.split(text)
        else:
            # A line feed between other characters is a piece of its own, so what comes before it ends there.
            first, *rest = text.replace("\n", " \n").split(" ")
        return self._stretch(first) + b"".join(map(self.stretches.__getitem__, rest))


class _Known(dict):
    """What was worked out lately: at most twice ``size`` values, of which those not asked for longest go."""

    def __init__(self, work_out: Callable[[str], bytes], size: int) -> None:
        super().__init__()
        self.work_out, self.size, self.before = work_out, size, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key) or self.work_out(key)
        if len(self) >= self.size:
            self.before = self.copy()
            self.clear()
        self[key] = found
        return found


_ENCODERS: dict[str, TextEncoder] = {}


def encoder_of(path: str) -> TextEncoder:
    """One encoder per worker process, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def stage_ids(documents: DataFrame, tokenizer: str, end_id: int, path: str) -> DataFrame:
    """(doc_id, told, nth, part, n, ids) written to ``path``: the ids of every text and the end id after them.

    ``told`` is a hash of the text, ``nth`` a number of the row that no other has; ids are little-endian, of two bytes
    if the vocabulary allows it, else of four.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder_of(tokenizer), width_of(tokenizer, end_id)
        for batch in batches:
            rows: list[tuple[int, int, int, bytes]] = []
            size = 0
            for at, text in enumerate(batch.column(3)):
                ids = np.frombuffer(encode(text.as_py() or ""), "<u4")
                ids = np.append(ids, np.uint32(end_id)).astype(kind)
                for part in range(ceil(len(ids) / ROW_TOKENS)):
                    cut = ids[part * ROW_TOKENS:(part + 1) * ROW_TOKENS]
                    rows.append((at, part, len(cut), cut.tobytes()))
                    size += len(cut)
                if size >= 1 << 20:
                    yield _staged(batch, rows)
                    rows, size = [], 0
            if rows:
                yield _staged(batch, rows)

    sent = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("told"),
                            F.monotonically_increasing_id().alias("nth"), "text")
    (sent.mapInArrow(run, "doc_id bigint, told bigint, nth bigint, part int, n int, ids binary")
     .write.option("compression", "zstd").mode("error").parquet(path))
    return documents.sparkSession.read.parquet(path)


def _staged(batch: pa.RecordBatch, rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    at, part, n, ids = zip(*rows)
    whose = pa.array(at, pa.int32())
    return pa.RecordBatch.from_arrays([*[batch.column(c).take(whose) for c in range(3)], pa.array(part, pa.int32()), pa.array(n, pa.int32()),
                                       pa.array(ids, pa.binary())], ["doc_id", "told", "nth", "part", "n", "ids"])


def width_of(tokenizer: str, end_id: int) -> str:
    return "<u2" if max(encoder_of(tokenizer).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"


def count_ids(staged: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs: one number per id of the vocabulary comes to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(own) > len(total):
                own, total = total, own.astype(np.int64)
            total[:len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "n": total[used]})

    found = staged.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


# --- the code ---


def limited_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code lengths (0: not in the code) of least total size with none above ``max_bits``, by package-merge.

    The limit is raised if there are more symbols than it can tell apart. A symbol alone has one bit.
    """
    symbols = np.flatnonzero(counts)
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    lengths, n = np.zeros(len(counts), np.uint8), len(symbols)
    if n < 2:
        lengths[symbols] = 1
        return lengths
    weights = counts[symbols].astype(np.int64)
    level, leaves = weights, [np.ones(n, bool)]
    for _ in range(max(max_bits, (n - 1).bit_length()) - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        level = both[order]
        leaves.append(order < n)
    take = 2 * n - 2
    for own in reversed(leaves):
        chosen = int(own[:take].sum())
        lengths[symbols[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Code:
    """A canonical code: shorter codes first, equal lengths in the order of ids."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.uint8)
        self.symbols = np.flatnonzero(lengths)
        self.symbols = self.symbols[np.argsort(lengths[self.symbols], kind="stable")]
        own = lengths[self.symbols].astype(np.int64)
        self.bits = int(own.max()) if len(own) else 1
        spans = np.int64(1) << (self.bits - own)
        begins = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.symbols] = (begins >> (self.bits - own)).astype(np.uint64)
        self._spans, self._tables = spans, None

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length by the next ``bits`` bits; what no code starts with takes one bit."""
        if self._tables is None:
            symbol, length = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.int64)
            used = int(self._spans.sum())
            symbol[:used] = np.repeat(self.symbols, self._spans)
            length[:used] = np.repeat(self.lengths[self.symbols], self._spans)
            self._tables = symbol, length
        return self._tables


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first token, tokens) of every run of rows of these sizes, one after the other."""
    per_row = -(-sizes // RUN)
    nth = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return np.repeat(np.cumsum(sizes) - sizes, per_row) + nth * RUN, np.minimum(RUN, np.repeat(sizes, per_row) - nth * RUN)


def pack(code: Code, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Rows of ``sizes`` ids (none empty) as bits: the bytes, bytes per row, bits of every run."""
    lengths = code.lengths[ids].astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    n_bytes = -(-np.add.reduceat(lengths, starts) // 8)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    row_at = 8 * (np.cumsum(n_bytes) - n_bytes)
    begins += np.repeat(row_at - begins[starts], sizes)
    word, room = begins >> 6, 64 - lengths - (begins & 63)
    codes, over = code.codes[ids], room < 0
    value = np.where(over, codes >> np.where(over, -room, 0).astype(np.uint64), codes << np.where(over, 0, room).astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[first]] = np.bitwise_or.reduceat(value, first)
    out[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)
    runs, _ = _runs(sizes)
    return out.astype(">u8").tobytes()[:int(n_bytes.sum())], n_bytes, np.add.reduceat(lengths, runs).astype(np.uint16)


def unpack(code: Code, data: bytes, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of runs that begin at bits ``at`` and have ``sizes`` ids, one run after the other.

    All runs are decoded side by side, a symbol of each at a time, out of the tables.
    """
    symbol, length = code.tables()
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
    word = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    limit, shift = 8 * (len(word) - 1), np.uint32(32 - code.bits)
    found, place = np.zeros((int(sizes.max(initial=0)), len(at)), np.uint32), at.astype(np.int64)
    for k in range(len(found)):
        index = word[place >> 3] << (place & 7).astype(np.uint32) >> shift
        found[k] = symbol[index]
        place = np.minimum(place + length[index], limit)
    return found.T[np.arange(len(found))[None] < sizes[:, None]]


# --- files ---


def _frame(magic: bytes, body: bytes) -> bytes:
    return magic + struct.pack("<II", len(body), zlib.crc32(body)) + body


def file_header(part: int, code: Code) -> bytes:
    return _frame(FILE, struct.pack("<IIB", part, len(code.lengths), code.bits) + zlib.compress(code.lengths.tobytes()))


def block(doc_ids: np.ndarray, flags: np.ndarray, sizes: np.ndarray, run_bits: bytes, bits: bytes) -> bytes:
    return _frame(BLOCK, struct.pack("<I", len(sizes)) + doc_ids.astype("<i8").tobytes() + flags.astype(np.uint8).tobytes()
                  + sizes.astype("<u4").tobytes() + run_bits + bits)


def frames(content: bytes) -> Iterator[tuple[bytes, memoryview]]:
    """(magic, body) of every frame; a damaged one is an error."""
    at = 0
    while at < len(content):
        magic, size, check = struct.unpack_from("<4sII", content, at) if at + 12 <= len(content) else (b"", 0, 0)
        body = memoryview(content)[at + 12:at + 12 + size]
        if magic not in (FILE, BLOCK) or len(body) < size or zlib.crc32(body) != check:
            raise ValueError(f"damaged frame at byte {at}")
        yield magic, body
        at += 13 + size


def parts(content: bytes) -> list[TokenFile]:
    """The parts in a file's bytes, one after the other: each begins with a header of its own."""
    found: list[TokenFile] = []
    for magic, body in frames(content):
        if magic == FILE:
            found.append(TokenFile(body))
        elif not found:
            raise ValueError("a block before any header")
        else:
            found[-1].frames.append(body)
    return found


class TokenFile:
    """A part's code and blocks; blocks are decoded when they are asked for."""

    def __init__(self, header: memoryview) -> None:
        self.part, n, _ = struct.unpack_from("<IIB", header)
        lengths = np.frombuffer(zlib.decompress(header[9:]), np.uint8)
        if len(lengths) != n:
            raise ValueError("damaged code")
        self.code, self.frames = Code(lengths), []

    def _layout(self, body: memoryview) -> tuple[np.ndarray, ...]:
        n, = struct.unpack_from("<I", body)
        ids, flags = np.frombuffer(body, "<i8", n, 4), np.frombuffer(body, np.uint8, n, 4 + 8 * n)
        sizes = np.frombuffer(body, "<u4", n, 4 + 9 * n).astype(np.int64)
        per_row = -(-sizes // RUN)
        bits = np.frombuffer(body, "<u2", int(per_row.sum()), 4 + 13 * n).astype(np.int64)
        before = np.cumsum(bits) - bits
        row_first = np.cumsum(per_row) - per_row
        row_bits = np.add.reduceat(bits, row_first)
        n_bytes = -(-row_bits // 8)
        row_at = 8 * (np.cumsum(n_bytes) - n_bytes)
        checkpoints = before + np.repeat(row_at - before[row_first], per_row)
        return ids, flags, sizes, checkpoints, _runs(sizes)[1], body[4 + 13 * n + 2 * len(bits):]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(doc_id, flags, sizes) of the rows of every block, and all its ids."""
        for body in self.frames:
            ids, flags, sizes, at, run_sizes, bits = self._layout(body)
            yield ids, flags, sizes, unpack(self.code, bytes(bits), at, run_sizes)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th of the part on: only the blocks and runs that hold them are decoded."""
        out, before = [], 0
        for body in self.frames:
            _, _, sizes, at, run_sizes, bits = self._layout(body)
            total = int(sizes.sum())
            if before < start + n and start < before + total:
                ends = before + np.cumsum(run_sizes)
                begins = ends - run_sizes
                a, b = np.searchsorted(ends, start, "right"), np.searchsorted(begins, start + n, "left")
                found = unpack(self.code, bytes(bits), at[a:b], run_sizes[a:b])
                skip = max(0, start - int(begins[a]))
                out.append(found[skip:skip + min(n, start + n - max(start, before))])
            before += total
        return np.concatenate(out) if out else np.empty(0, np.uint32)


def file_bounds(staged: DataFrame, files: int) -> tuple[list[int], int]:
    """(doc_ids that part the rows with an id into files of about as many rows, files of the rows without one)."""
    rows, unnamed = staged.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    own = ceil(files * unnamed / rows) if rows else 0
    named = max(1, files - own)
    shares = [i / named for i in range(1, named)]
    found = staged.approxQuantile("doc_id", shares, 1 / (20 * named)) if shares and rows > unnamed else []
    return [int(b) for b in found], own


def file_numbers(doc_ids: pa.Array, told: np.ndarray, bounds: list[int], unnamed: int) -> np.ndarray:
    """The file of every row, in the order of doc_id and ``told``; an id that makes several bounds is spread over their
    files by ``told``, and so are the rows without one over theirs."""
    missing = doc_ids.is_null().to_numpy(zero_copy_only=False)
    ids, edges = doc_ids.fill_null(0).to_numpy(), np.array(bounds, np.int64)
    first, last = np.searchsorted(edges, ids, "left"), np.searchsorted(edges, ids, "right")
    first, last = np.where(missing, len(edges) + 1, first), np.where(missing, len(edges) + max(1, unnamed), last)
    share = (told.view(np.uint64) ^ np.uint64(1 << 63)).astype(np.float64) / 2.0 ** 64  # in the order of the signed numbers
    return np.minimum(last, first + np.floor(share * (last - first + 1)).astype(np.int64)).astype(np.int32)


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, max_bits: int = MAX_BITS,
                      file_tokens: int = FILE_TOKENS) -> None:
    """The ids of all texts (null: empty), each closed by ``end_id``, as files under ``path`` in ascending doc_id order.

    Null ids come last; rows of one doc_id follow each other by a hash of their text. A document never lies in two
    files, a file has about ``file_tokens`` ids. The tokenizer's file must be on every machine. Other columns are
    ignored. An empty table gives no file with ids.
    """
    staged = stage_ids(documents, tokenizer, end_id, fresh_dir(documents.sparkSession, "token-ids"))
    kind = width_of(tokenizer, end_id)
    counts = count_ids(staged, kind)
    lengths = limited_lengths(counts, max_bits)
    bounds, unnamed = file_bounds(staged, max(1, ceil(int(counts.sum()) / file_tokens)))

    def code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            sizes = batch.column(4).to_numpy().astype(np.int64)
            for begin, end in _stretches(sizes, 1 << 20):
                part, own = batch.slice(begin, end - begin), sizes[begin:end]
                ids = np.frombuffer(b"".join(part.column(5).to_pylist()), kind)
                bits, n_bytes, run_bits = pack(code, ids, own)
                files = file_numbers(part.column(0), part.column(1).to_numpy(), bounds, unnamed)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:5], _cut(run_bits.astype("<u2").tobytes(), 2 * -(-own // RUN)), _cut(bits, n_bytes), pa.array(files, pa.int32())],
                    ["doc_id", "told", "nth", "part", "n", "run_bits", "bits", "file"])

    def file_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, current = Code(lengths), None
        for batch in batches:
            sizes, numbers = batch.column(4).to_numpy().astype(np.int64), batch.column(7).to_numpy()
            for begin, end in _stretches(sizes, BLOCK_TOKENS, numbers):
                rows = batch.slice(begin, end - begin)
                head = file_header(int(numbers[begin]), code) if numbers[begin] != current else None
                current = numbers[begin]
                doc_ids = rows.column(0)
                flags = doc_ids.is_null().to_numpy(zero_copy_only=False) + 2 * (rows.column(3).to_numpy() == 0)
                body = block(doc_ids.fill_null(0).to_numpy(), flags, sizes[begin:end], b"".join(rows.column(5).to_pylist()), b"".join(rows.column(6).to_pylist()))
                frames = [body] if head is None else [head, body]
                yield pa.RecordBatch.from_pydict({"value": pa.array(frames, pa.binary())})

    coded = staged.mapInArrow(code_rows, "doc_id bigint, told bigint, nth bigint, part int, n int, run_bits binary, bits binary, file int")
    placed = coded.repartition(len(bounds) + 1 + unnamed, "file").sortWithinPartitions("file", F.asc_nulls_last("doc_id"), "told", "nth", "part")
    placed.mapInArrow(file_of, "value binary").select(F.col("value").cast("string").alias("value")).write.mode("error").text(path)


def _stretches(sizes: np.ndarray, tokens: int, of: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Rows one after the other that have at most ``tokens`` ids together, or one row; none with another value of ``of``."""
    ends, begin = np.cumsum(sizes), 0
    cuts = np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(sizes)) if of is not None else np.array([len(sizes)])
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + tokens, "right")))
        end = min(end, int(cuts[np.searchsorted(cuts, begin, "right")]))
        yield begin, end
        begin = end


def _cut(data: bytes, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


READ = "part bigint, nth bigint, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, nth, doc_id, before, n_tokens, ids_crc32) of every document in the files, decoded from them.

    ``before`` counts the ids of the part before the document. A damaged file ends the job.
    """
    names = [c.split(" ")[0] for c in READ.split(", ")]

    def rows(file: TokenFile) -> Iterator[pa.RecordBatch]:
        nth, before, open_row, done = 0, 0, None, []
        for doc_ids, flags, sizes, ids in file.blocks():
            data, at = ids.astype("<u4").tobytes(), 0
            for doc_id, flag, n in zip(doc_ids.tolist(), flags.tolist(), sizes.tolist()):
                if flag & 2:
                    if open_row:
                        done.append(tuple(open_row))
                    open_row = [file.part, nth, None if flag & 1 else doc_id, before, 0, 0]
                    nth += 1
                open_row[4] += n
                open_row[5] = zlib.crc32(data[4 * at:4 * (at + n)], open_row[5])
                at, before = at + n, before + n
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], names)
                done = []
        if open_row:
            done.append(tuple(open_row))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for file in parts(content.as_py()):
                    yield from rows(file)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, READ)


def documents_in(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files under ``path``.

    The files are decoded once; what is added up across them is one number per file.
    """
    place = fresh_dir(spark, "token-rows")
    read_token_files(spark, path).write.parquet(place)
    rows = spark.read.parquet(place)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    first = sums.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_first"))
    return rows.join(first, "part").select("doc_id", (F.col("_first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return documents_in(spark, path)
