"""Operator 8: byte-level BPE encoding and decoding through a global table of distinct words.

1. Documents are cut into pre-tokens (the tokenizer's split pattern, as
   vectorised class runs over code points) and packed into blocks of about
   ``BLOCK_BYTES``.  A block keeps its pre-tokens by position, as codes into
   the block's own distinct words.
2. Only a block's distinct words are shuffled, by ranges of the word's hash:
   every distinct word of the corpus meets in one task and is merged once.
3. The words' ids go back to their blocks; each block rebuilds its
   documents' ids by position.

Texts themselves are never exploded into one shuffled row per pre-token: a
frequent word crosses the network once per block, whatever its frequency, so
no key is hot.  Both passes over the documents read the same rows in the same
order (a table scan); a block is named by its content, and a block without
its words raises an error rather than losing rows.

Decoding joins ids with the token-byte table, whose size is the vocabulary's.

Defined cases: null text encodes to no ids; repeated rows give repeated
results; a null id is returned as it is; an empty table gives an empty
result; other input columns are ignored.  One document is held by one task.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetzone.llm import vectext
from fleetzone.llm.common import columns, partitions

BLOCK_BYTES = 12 << 20
CHUNK_CHARS = 1 << 18
ROWS_AT_ONCE = 256
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(1)
def _char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    import regex
    chars = "".join(map(chr, range(0x110000)))
    out = np.full(0x110000, _OTHER, np.uint8)
    for pattern, value in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
        for m in regex.finditer(pattern, chars):
            out[m.start():m.end()] = value
    return out


def _spans(cp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pre-token spans over code points ``cp``; texts begin at ``starts``.

    The pattern, on runs of one class: a run of letters, numbers or others
    takes one space before it; white space before other text leaves its last
    character (alone, unless it is that space); an apostrophe on its own
    takes one of s t re ve m ll d from the letters after it.
    """
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cls = _char_classes()[cp]
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = cls[1:] != cls[:-1]
    text_start = np.zeros(n + 1, bool)
    text_start[starts[starts < n]] = True
    first |= text_start[:n]
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], n)
    kind = cls[begin]
    joined = ~text_start[begin]                  # the run goes on from the run before it
    after_space = np.zeros(len(begin), bool)
    after_space[1:] = joined[1:] & (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)
    takes = after_space & (cp[np.maximum(begin - 1, 0)] == 32)
    tok_start = begin - takes
    tok_end = end.copy()
    # Contractions.
    quote = (kind == _OTHER) & (end - begin == 1) & (cp[begin] == 39) & ~takes
    quote[:-1] &= (kind[1:] == _LETTER) & joined[1:]
    quote[-1] = False
    at = np.flatnonzero(quote)
    if len(at):
        a = cp[begin[at] + 1]
        b = np.where(end[at + 1] - begin[at + 1] > 1, cp[np.minimum(begin[at] + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
        size = np.where(one, 1, np.where(two, 2, 0))
        tok_end[at] += size
        tok_start[at + 1] += size
    text = kind != _SPACE
    # White space: all but the last character, then the last one unless the next run takes it.
    ws = np.flatnonzero(~text)
    followed = np.zeros(len(begin), bool)
    followed[:-1] = after_space[1:]
    taken = np.zeros(len(begin), bool)
    taken[:-1] = takes[1:]
    head_end = end[ws] - followed[ws]
    last_start = head_end
    s = np.concatenate([tok_start[text], begin[ws], last_start])
    e = np.concatenate([tok_end[text], head_end, np.where(taken[ws], last_start, end[ws])])
    keep = e > s
    s, e = s[keep], e[keep]
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def _pieces(text: str) -> list[str]:
    """A long text cut where white space follows other text: no pre-token spans such a place."""
    if len(text) <= CHUNK_CHARS:
        return [text]
    import regex
    gap = regex.compile(r"(?<=\S)\s")
    out, at = [], 0
    while len(text) - at > CHUNK_CHARS:
        m = gap.search(text, at + CHUNK_CHARS)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    return out + [text[at:]]


class Block:
    """Pre-tokens of some texts: ``codes`` by position into the distinct ``words``.

    ``words`` are ordered by hash (``hashes``); ``counts`` are pre-tokens per text.
    """

    def __init__(self, texts: list[str]):
        # A chunk's pre-tokens become codes before the next chunk is split: only distinct words and codes are kept.
        self.counts = np.zeros(len(texts), np.int64)
        name = hashlib.blake2b(digest_size=8)
        self.hashes, rank = np.zeros(0, np.uint64), np.zeros(0, np.uint32)      # sorted hashes, their words' order of appearance
        words, codes = [], []
        for group, owners in self._chunks(texts):
            buf, s, e, owner = self._split(group, owners)
            np.add.at(self.counts, owner, 1)
            name.update(buf)
            hashes, at, code = np.unique(vectext.span_hashes(buf, s, e), return_index=True, return_inverse=True)
            size = e - s
            # Equal hash must mean equal bytes: rebuild the chunk from its words, and compare those seen before.
            for a in range(0, len(code), 1 << 16):
                c = at[code[a:a + (1 << 16)]]
                if not np.array_equal(vectext.gather(buf, s[c], size[c]), buf[s[a]:e[min(a + (1 << 16), len(code)) - 1]]):
                    raise ValueError("two different words of a block have the same hash")
            data = buf.tobytes()
            place = np.searchsorted(self.hashes, hashes)
            seen = np.zeros(len(hashes), bool)
            inside = place < len(self.hashes)
            seen[inside] = self.hashes[place[inside]] == hashes[inside]
            order = np.zeros(len(hashes), np.uint32)
            order[seen] = rank[place[seen]]
            for k, f, n in zip(order[seen].tolist(), s[at[seen]].tolist(), size[at[seen]].tolist()):
                if words[k] != data[f:f + n]:
                    raise ValueError("two different words of a block have the same hash")
            order[~seen] = np.arange(len(words), len(words) + np.count_nonzero(~seen), dtype=np.uint32)
            words += [data[f:f + n] for f, n in zip(s[at[~seen]].tolist(), size[at[~seen]].tolist())]
            self.hashes = np.insert(self.hashes, place[~seen], hashes[~seen])
            rank = np.insert(rank, place[~seen], order[~seen])
            codes.append(order[code])
        self.words = [words[k] for k in rank.tolist()]
        back = np.zeros(len(words), np.uint32)
        back[rank] = np.arange(len(words), dtype=np.uint32)
        self.codes = np.concatenate([back[c] for c in codes] or [back])
        self.name = int.from_bytes(name.digest(), "little", signed=True)

    @staticmethod
    def _split(group: list[str], owners: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The UTF-8 bytes of a chunk, the byte spans of its pre-tokens and the text of each."""
        joined = "".join(group)
        cp = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        buf = np.frombuffer(joined.encode(), np.uint8)
        limits = np.cumsum([len(g) for g in group])
        s, e = _spans(cp, np.concatenate(([0], limits)))
        owner = np.array(owners)[np.searchsorted(limits, s, side="right")]
        if len(buf) > len(cp):
            place = np.zeros(len(cp) + 1, np.int64)
            np.cumsum(1 + (cp >= 0x80).view(np.uint8) + (cp >= 0x800) + (cp >= 0x10000), out=place[1:])
            s, e = place[s], place[e]
        return buf, s, e, owner

    @staticmethod
    def _chunks(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
        group, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                group.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= CHUNK_CHARS:
                    yield group, owners
                    group, owners, size = [], [], 0
        if group:
            yield group, owners


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged, leftmost first, until none is left."""
    if word in ranks:
        return [ranks[word]]
    if len(word) <= 24:
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]
    # A long word: candidate pairs in a heap, parts as a linked list of end offsets.
    n = len(word)
    end = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            r = ranks.get(word[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop or not alive[end[i]]:
            continue
        gone = end[i]
        alive[gone] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class ByteTable:
    """A byte string per id, for gathering many at once."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def of(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[list[bytes]]:
        """The joined strings of ``ids[offsets[i]:offsets[i+1]]`` for every i, as lists of parts."""
        i, n, limit = 0, len(offsets) - 1, 1 << 18
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
            if offsets[j] - offsets[i] > limit:
                parts = [ids[a:min(a + limit, offsets[j])] for a in range(offsets[i], offsets[j], limit)]
                yield [vectext.gather(self.flat, self.start[p], self.length[p]).tobytes() for p in parts]
                i = j
                continue
            p = ids[offsets[i]:offsets[j]]
            size = self.length[p]
            data = vectext.gather(self.flat, self.start[p], size).tobytes()
            edge = np.concatenate(([0], np.cumsum(size)))[offsets[i:j + 1] - offsets[i]].tolist()
            for a, b in zip(edge[:-1], edge[1:]):
                yield [data[a:b]]
            i = j


@functools.lru_cache(4)
def token_bytes(path: str) -> ByteTable:
    """The token-byte table of a rank file."""
    ranks = read_ranks(path)
    strings = [b""] * (max(ranks.values()) + 1)
    for k, v in ranks.items():
        strings[v] = k
    return ByteTable(strings)


@functools.lru_cache(4)
def _decimals(path: str) -> ByteTable:
    return ByteTable([b"%d " % i for i in range(len(token_bytes(path).length))])


Emit = Callable[[np.ndarray, np.ndarray, np.ndarray, str], pd.DataFrame]


def emit_arrays(ids: pd.Series, tokens: np.ndarray, offsets: np.ndarray, path: str) -> pd.DataFrame:
    """doc_id, n_tokens and the ids as an array."""
    return pd.DataFrame({"doc_id": ids, "n_tokens": np.diff(offsets),
                         "ids": pd.Series([tokens[a:b].astype(np.int32) for a, b in zip(offsets[:-1], offsets[1:])],
                                          dtype=object)})


def emit_digests(ids: pd.Series, tokens: np.ndarray, offsets: np.ndarray, path: str) -> pd.DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids and of the decoded bytes."""
    def digest(parts: list[bytes], trim: int) -> str:
        h = hashlib.sha256()
        for p in parts[:-1]:
            h.update(p)
        h.update(parts[-1][:len(parts[-1]) - trim] if parts[-1] and trim else parts[-1])
        return h.hexdigest()

    return pd.DataFrame({
        "doc_id": ids, "n_tokens": np.diff(offsets),
        "ids_sha256": [digest(p, 1) for p in _decimals(path).of(tokens, offsets)],
        "decoded_sha256": [digest(p, 0) for p in token_bytes(path).of(tokens, offsets)]})


ARRAYS = "doc_id long, n_tokens long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``limit`` characters each, in row order; null text is empty."""
    ids, texts, size = [], [], 0
    for part in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
        for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1]) + 16
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(data[:8 * len(kinds)], "<i8")
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


_ROWS = "block long, bucket int, data binary"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    b, k, d = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(k, pa.int32()), pa.array(d, pa.binary())],
                                      names=["block", "bucket", "data"])


def _block_id(block: Block, ids: list) -> int:
    return (block.name * 31 + hash(tuple(-1 if i is None else i for i in ids))) % (1 << 63)


def _word_rows(bits: int):
    """The distinct words of each block, one row per hash range."""
    def run(batches):
        for ids, texts in text_blocks(batches):
            block = Block(texts)
            name = _block_id(block, ids)
            cuts = np.searchsorted(block.hashes, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            edges = [0, *cuts.tolist(), len(block.words)]
            found = []
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if b > a:
                    words = block.words[a:b]
                    found.append((name, k, _pack(np.array([len(w) for w in words], "<u4"),
                                                 np.frombuffer(b"".join(words), np.uint8))))
            if found:
                yield _rows(found)
    return run


def _code_rows():
    """The pre-tokens by position of each block, with its documents."""
    def run(batches):
        for ids, texts in text_blocks(batches):
            block = Block(texts)
            known = np.array([i is not None for i in ids])
            yield _rows([(_block_id(block, ids), -1, _pack(
                np.array([i or 0 for i in ids], "<i8"), known.view(np.uint8), block.counts.astype("<i8"),
                np.array([len(block.words)], "<i8"), *[
                    (block.codes >> np.uint32(8 * k) & np.uint32(255)).astype(np.uint8) for k in range(4)]))])
    return run


def _encode_words(path: str):
    """Ids of the words of one hash range: each distinct word is merged once."""
    def run(batches):
        ranks, seen = read_ranks(path), {}
        for batch in batches:
            found = []
            for name, k, blob in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                lengths, flat = _unpack(blob, "<u4", "u1")
                data, ends = flat.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
                ids = []
                for a, b in zip([0, *ends[:-1]], ends):
                    word = data[a:b]
                    got = seen.get(word)
                    if got is None:
                        got = seen[word] = np.array(merge(word, ranks), "<u4").tobytes()
                    ids.append(got)
                found.append((name, k, _pack(np.array([len(x) // 4 for x in ids], "<u4"),
                                             np.frombuffer(b"".join(ids), "<u4"))))
            if found:
                yield _rows(found)
    return run


def _rebuild(path: str, emit: Emit):
    """Ids of a block's documents, by position."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        words = f[f["bucket"] >= 0].drop_duplicates("bucket").sort_values("bucket")
        parts = [_unpack(x, "<u4", "<u4") for x in words["data"]]
        none = np.zeros(0, np.uint32)
        size = np.concatenate([p[0] for p in parts] or [none]).astype(np.int64)
        flat = np.concatenate([p[1] for p in parts] or [none])
        first = np.cumsum(size) - size
        out = []
        for blob in f.loc[f["bucket"] < 0, "data"]:
            ids, known, counts, n_words, *planes = _unpack(blob, "<i8", "u1", "<i8", "<i8", "u1", "u1", "u1", "u1")
            if n_words[0] != len(size):
                raise ValueError("a block's words are missing: the documents must be read in a fixed order")
            ends = np.concatenate(([0], np.cumsum(counts)))
            doc_ids = pd.array(ids, dtype="Int64")
            doc_ids[known == 0] = pd.NA
            # Some documents at a time: bounded token arrays.
            i, n = 0, len(ids)
            while i < n:
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + CHUNK_CHARS, side="right")) - 1)
                c = sum(p[ends[i]:ends[j]].astype(np.int64) << (8 * k) for k, p in enumerate(planes))
                tokens = vectext.gather(flat, first[c], size[c])
                edge = np.concatenate(([0], np.cumsum(size[c])))[ends[i:j + 1] - ends[i]]
                out.append(emit(doc_ids[i:j], tokens, edge, path))
                i = j
        return pd.concat(out, ignore_index=True) if out else emit(
            pd.array([], dtype="Int64"), none, np.zeros(1, np.int64), path)
    return run


def encode(docs: DataFrame, vocabulary: str | None = None, emit: Emit = emit_arrays, schema: str = ARRAYS) -> DataFrame:
    """Ids of every row of ``docs`` (doc_id, text) by the ranks of ``vocabulary``.

    ``emit`` turns the ids of some documents into the result rows.
    """
    path = vocabulary or default_vocabulary()
    src = columns(docs, doc_id="long", text="string")
    n = partitions(docs.sparkSession)
    bits = max(4, int(n - 1).bit_length() + 1)
    words = src.mapInArrow(_word_rows(bits), _ROWS).repartition(n, "bucket").mapInArrow(_encode_words(path), _ROWS)
    return src.mapInArrow(_code_rows(), _ROWS).union(words).groupBy("block").applyInPandas(_rebuild(path, emit), schema)


def decode(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Replaces ``ids`` (array of token ids) of every row by ``data``, the decoded bytes; null ids give null."""
    path = vocabulary or default_vocabulary()
    rest = [c for c in rows.columns if c != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids")

    def run(frames):
        for f in frames:
            arrays = [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in f["ids"]]
            offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int64)
            flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
            data = [b"".join(p) for p in token_bytes(path).of(flat, offsets)]
            yield f[rest].assign(data=pd.Series([None if x is None else d for x, d in zip(f["ids"], data)],
                                                index=f.index, dtype=object))

    return rows.select(*rest, F.col("ids")).mapInPandas(run, (schema + ", " if schema else "") + "data binary")
