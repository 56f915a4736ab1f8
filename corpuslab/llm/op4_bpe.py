"""Operator 4, byte-level BPE: global distinct-word shuffle.

Encoding: each block of documents (about ``block_chars`` characters) lists its distinct
pre-tokens (matches of the pattern) and keeps, for every document, their positions as
numbers. The distinct words of all blocks are shuffled by word; there each word is encoded
once and its ids go back to the blocks that asked, which reassemble their documents by
position. A frequent word is asked for once per block, not once per occurrence, so hot
words are combined before the shuffle. Requests and answers travel as compressed columns,
one row per (block, word partition).

Decoding: the ids take their bytes from the token-byte table (one row per rank, a fixed
size), column at a time.

The input is read twice (words, positions); blocks carry a digest of their words, and an
answer is only used for the block with the same digest, so an input that changes between
the two reads stops the job instead of giving wrong ids.

Defined results: null and empty texts have no ids and decode to an empty text; repeated
rows and null ids are encoded one by one; extra columns are not read; empty in, empty out.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import offsets, ragged_index, slices
from .tokens import _FIRST, cut


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pack(**columns: pa.Array) -> bytes:
    """Columns of one length as compressed Arrow bytes."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return next(iter(stream))


def pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane: the high bytes are mostly alike."""
    planes = np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


class Block:
    """Documents in order, their chunks as numbers, and the pre-tokens of each chunk."""

    def __init__(self, find):
        self.find = find
        self.chunk_no: dict = defaultdict(count().__next__)
        self.docs: list = []
        self.positions: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id, text: str):
        chunks = cut(text)
        self.docs.append(doc_id)
        self.positions.append(np.fromiter(map(self.chunk_no.__getitem__, chunks), np.int32, len(chunks)))
        self.chars += len(text)

    def words(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens; for each chunk the numbers of its pre-tokens, ragged."""
        word_no: dict = defaultdict(count().__next__)
        found = [self.find(c[1:] if c[:1] == _FIRST else " " + c) for c in self.chunk_no]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(map(word_no.__getitem__, chain.from_iterable(found)), np.int32, int(lens.sum()))
        return list(word_no), flat, lens


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int, pat: str) -> Iterator[Block]:
    import regex

    find = regex.compile(pat).findall
    block = Block(find)
    for b in batches:
        ids = b.column("doc_id").to_pylist()
        for first, texts in slices(b, "text"):
            for k, text in enumerate(texts):
                block.add(ids[first + k], text)
                if block.chars >= block_chars or len(block.docs) >= 100_000:
                    yield block
                    block = Block(find)
    if block.docs:
        yield block


def _name(block: Block, words: list[str]) -> str:
    """The same only for the same documents with the same words in the same order."""
    h = hashlib.blake2b(digest_size=16)
    h.update(repr(block.docs).encode())
    h.update("\0".join(words).encode("utf-8", "surrogatepass"))
    for p in block.positions:
        h.update(p.tobytes())
    return h.hexdigest()


def _word_rows(block_chars: int, pat: str, parts: int):
    def run(batches):
        for block in _blocks(batches, block_chars, pat):
            words, _, _ = block.words()
            raw = [w.encode("utf-8", "surrogatepass") for w in words]
            to = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % parts
            order = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[order], np.arange(parts + 1))
            column = pa.array(raw, pa.binary()).take(pa.array(order))
            name = _name(block, words)
            rows = [(name, p, pack(word=column.slice(a, b - a), at=pa.array(order[a:b].astype(np.int32))))
                    for p, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())) if b > a]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("block", "part", "data"), zip(*rows))),
                                                 schema=pa.schema([("block", pa.string()), ("part", pa.int32()), ("data", pa.binary())]))
    return run


def _position_rows(block_chars: int, pat: str):
    def run(batches):
        for block in _blocks(batches, block_chars, pat):
            words, flat, lens = block.words()
            sizes = np.fromiter(map(len, block.positions), np.int64, len(block.positions))
            at = np.concatenate(block.positions)
            data = [pack_numbers(at), pack(flat=pa.array(flat)), pack(lens=pa.array(lens)), pack(sizes=pa.array(sizes), doc=pa.array(block.docs, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_name(block, words)]), pa.array([len(words)], pa.int64()), pa.array([data], pa.list_(pa.binary()))],
                names=["block", "n_words", "data"])
    return run


_WORDS: dict = {}


def _word_encoder(path: str, pat: str):
    if path not in _WORDS:
        import tiktoken

        _WORDS[path] = tiktoken.Encoding("ranks", pat_str=pat, mergeable_ranks=read_ranks(path), special_tokens={})
    return _WORDS[path]


def _encode_words(path: str, pat: str):
    def run(key, table):
        """All requests for the words of one part: each distinct word is encoded once."""
        asked = [unpack(x) for x in table.column("data").to_pylist()]
        words = pa.chunked_array([x.column("word") for x in asked]).dictionary_encode().combine_chunks()
        one = _word_encoder(path, pat).encode_ordinary
        ids = [one(w.decode("utf-8", "surrogatepass")) for w in words.dictionary.to_pylist()]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lens.sum()))
        starts = offsets(lens)
        which = words.indices.to_numpy()
        out, begin = [], 0
        for x in asked:
            mine = which[begin:begin + len(x)]
            begin += len(x)
            ids_of = pa.ListArray.from_arrays(offsets(lens[mine]).astype(np.int32), flat[ragged_index(starts[mine], lens[mine])])
            out.append(pack(at=x.column("at"), ids=ids_of))
        return pa.table({"block": table.column("block"), "data": pa.array(out, pa.binary())})
    return run


def _reassemble(left: pa.Table, right: pa.Table) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """doc_id and ids of a block's documents, some at a time."""
    if not left.num_rows:
        raise RuntimeError("the input changed between the two reads")
    n_words = left.column("n_words")[0].as_py()
    answers = [unpack(x) for x in right.column("data").to_pylist()]
    at = np.concatenate([x.column("at").to_numpy() for x in answers]) if answers else np.zeros(0, np.int32)
    if len(at) != n_words * left.num_rows and len(at) != n_words:
        raise RuntimeError("the input changed between the two reads")
    lens = np.zeros(n_words, np.int64)
    starts = np.zeros(n_words, np.int64)
    flat, begin = [], 0
    for x in answers:
        own = x.column("ids")
        edge = np.asarray(own.offsets)
        lens[x.column("at").to_numpy()] = np.diff(edge)
        starts[x.column("at").to_numpy()] = begin + edge[:-1]
        begin += int(edge[-1])
        flat.append(own.values.to_numpy())
    word_ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    for row in left.column("data").to_pylist():
        at = unpack_numbers(row[0])
        of_chunk, chunk_lens, docs = (unpack(x) for x in row[1:])
        of_chunk, chunk_lens = of_chunk.column("flat").to_numpy(), chunk_lens.column("lens").to_numpy()
        chunk_starts = offsets(chunk_lens)
        sizes = docs.column("sizes").to_numpy()
        edges = offsets(sizes)
        done, doc = 0, docs.column("doc")
        while done < len(sizes):  # about 250,000 chunks at a time
            to = max(done + 1, int(np.searchsorted(edges, edges[done] + 250_000, "right")) - 1)
            here = at[edges[done]:edges[to]]
            words = of_chunk[ragged_index(chunk_starts[here], chunk_lens[here])]
            ids = word_ids[ragged_index(starts[words], lens[words])]
            word_edge = offsets(chunk_lens[here])[edges[done:to + 1] - edges[done]]
            id_edge = offsets(lens[words])[word_edge]
            yield doc.slice(done, to - done), pa.ListArray.from_arrays(id_edge.astype(np.int32), ids)
            done = to


def token_bytes(path: str) -> pa.Array:
    """The token-byte table: the bytes of each rank."""
    ranks = read_ranks(path)
    by_id: list = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    return pa.array(by_id, pa.large_binary())


def joined_bytes(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The bytes of each list of ids: one lookup in the table for all of them, cut where the lists end."""
    edge = np.asarray(ids.offsets)
    taken = tokens.take(ids.values.slice(int(edge[0]), int(edge[-1] - edge[0])))
    at = np.asarray(pa.Array.from_buffers(pa.int64(), len(taken) + 1, [None, taken.buffers()[1]]))[edge - edge[0]]
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(at)), taken.buffers()[2]])
    return out.cast(pa.binary())


def encode(docs: DataFrame, ranks: str | None = None, pat: str | None = None, block_chars: int = 10 << 20, decoded: bool = False) -> DataFrame:
    """doc_id and ids (array) of every row; with ``decoded`` also the bytes that the ids
    stand for, decoded where the ids are reassembled."""
    ranks, pat = ranks or rank_file(), pat or pattern()
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    asked = rows.mapInArrow(_word_rows(block_chars, pat, parts), "block string, part int, data binary")
    answers = asked.groupBy("part").applyInArrow(_encode_words(ranks, pat), "block string, data binary")
    placed = rows.mapInArrow(_position_rows(block_chars, pat), "block string, n_words bigint, data array<binary>")

    def whole(left, right):
        tokens = token_bytes(ranks) if decoded else None
        names = ["doc_id", "ids"] + ["decoded"] * decoded
        return pa.concat_tables(pa.table([doc, ids] + ([joined_bytes(ids, tokens)] if decoded else []), names=names)
                                for doc, ids in _reassemble(left, right))

    schema = "doc_id bigint, ids array<int>" + ", decoded binary" * decoded
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(whole, schema)


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for."""
    ranks = ranks or rank_file()

    def run(batches):
        tokens = token_bytes(ranks)
        for b in batches:
            ids = b.column("ids")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, joined_bytes(ids, tokens)], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
