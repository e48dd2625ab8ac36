"""Byte-level BPE by merge replay over the distinct pieces of the whole corpus.

1. ``numbered``: one scan cuts the texts into pieces (words) and numbers them within
   blocks of some megabytes of text. It is written once, bucketed by block: a row per
   document with its piece numbers, and the block's distinct pieces, dealt by digest
   into parts, a row per block and part. Numbers and pieces are packed.
2. ``replayed``: all rows of a part meet in one task, and with them all copies of its
   pieces. The merges are replayed over the distinct ones: an inverted index leads
   from a token pair's rank to the places in the pieces where that pair stands; the
   ranks are taken in order, all places of a rank are merged at once, and only the
   pairs with the two neighbours of a merged place are looked up and filed again.
3. ``encode``: a block's documents and the ids of its pieces are cogrouped, and texts
   put together from their pieces' ids. Only the pieces are shuffled: the documents
   lie in their buckets. ``round_trip`` decodes the ids in the same step.

A piece that stands everywhere counts once a block, a small part of each block's
pieces, so no part is hot. Tasks hold a block, or a bounded table of pieces, at a time.

The result is that of the usual word-by-word rule (lowest rank first, leftmost
among equals, a piece that is itself a token at once). A merge can bring up a
pair of lower rank than its own; pieces where that happens are done again one
merge at a time.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, PandasCogroupedOps, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import scratch

NONE = 1 << 30  # the rank of a pair that does not merge
MAX_PIECES = 250_000  # pieces remembered by a task before the table is begun anew
CHUNK_CHARS, BLOCK = 8_000_000, 200_000
BLOCK_BYTES, BLOCK_PIECES = 4 * CHUNK_CHARS, 500_000  # a block ends at the first of them
PART_PIECES = 1_000_000  # pieces remembered in a part; beyond, the table is begun anew
REPLAY_BYTES = 2_000_000  # pieces read before the new ones are replayed


class Vocabulary:
    """Token ranks, and for every way to cut a token in two, the merged rank."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        self.bytes = np.array([self.ranks[bytes([x])] for x in range(256)], dtype=np.int64)
        top = max(self.ranks.values()) + 1
        table = [b""] * top
        for token, rank in self.ranks.items():
            table[rank] = token
        self.sizes = np.array([len(t) for t in table], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.content = np.frombuffer(b"".join(table), dtype=np.uint8)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """(left << 32 | right) -> merged rank; only encoding needs it."""
        out = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    out[a << 32 | b] = rank
        return out

    @cached_property
    def keys(self) -> np.ndarray:
        return np.array(sorted(self.pairs), dtype=np.int64)

    @cached_property
    def merged(self) -> np.ndarray:
        return np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)


@lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _one(piece: bytes, v: Vocabulary) -> list[int]:
    """One piece, one merge at a time."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((v.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
        if rank == NONE:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [v.ranks[p] for p in parts]


def replay(pieces: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces, number of ids of each piece)."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n = len(data)
    word = np.repeat(np.arange(len(pieces)), sizes)
    token = np.append(v.bytes[data], -1)  # place n stands for the edge of a piece
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    ends = np.cumsum(sizes)
    after[ends[sizes > 0] - 1] = n
    before[(ends - sizes)[sizes > 0]] = n
    whole = np.array([v.ranks.get(p, -1) for p in pieces], dtype=np.int64)
    live = np.append(whole[word] < 0, False)  # a piece that is a token needs no merge
    current = np.full(n + 1, NONE, dtype=np.int64)
    # the inverted index: rank -> places, as arrays where there are many of them
    many: dict[int, list[np.ndarray]] = {}
    few: dict[int, list[int]] = {}
    heap: list[int] = []
    redo: set[int] = set()
    token_at, after_at, before_at, current_at, live_at = map(memoryview, (token, after, before, current, live))
    rank_of = v.pairs.get
    floor = 0

    def file(places: np.ndarray) -> None:
        """Look up the pair at each place and add the place to its rank's list."""
        ranks = v.rank(token[places], token[after[places]])
        current[places] = ranks
        good = ranks < NONE
        places, ranks = places[good], ranks[good]
        redo.update(word[places[ranks < floor]].tolist())
        if len(places) < 4096:
            for rank, place in zip(ranks.tolist(), places.tolist(), strict=True):
                file_one(rank, place)
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
        for rank, group in zip(ranks[cuts].tolist(), np.split(places, cuts[1:]), strict=True):
            if rank not in many and rank not in few:
                heapq.heappush(heap, rank)
            many.setdefault(rank, []).append(group)

    def file_one(rank: int, place: int) -> None:
        if rank in few:
            few[rank].append(place)
        else:
            few[rank] = [place]
            if rank not in many:
                heapq.heappush(heap, rank)

    def merge_few(places: list[int]) -> None:
        for at in sorted(places):
            if current_at[at] != floor:
                continue  # merged meanwhile, with a neighbour or as an overlapping place
            right = after_at[at]
            beyond, left = after_at[right], before_at[at]
            token_at[at], after_at[at], before_at[beyond] = floor, beyond, at
            current_at[right], live_at[right], current_at[at] = NONE, False, NONE
            for place, other in ((at, beyond), (left, at)):
                if place < n and other < n:
                    rank = rank_of(token_at[place] << 32 | token_at[other], NONE)
                    current_at[place] = rank
                    if rank < NONE:
                        file_one(rank, place)
                        if rank < floor:
                            redo.add(int(word[place]))

    def merge_many(at: np.ndarray) -> None:
        at = at[current[at] == floor]
        chained = at[1:] == after[at[:-1]]
        if chained.any():  # overlapping places, as in "aaaa": every second one, from the left
            k = np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.append(False, chained), 0, k))
            at = at[(k - first) % 2 == 0]
        right = after[at]
        beyond = after[right]
        # one by one, the next place would still stand as it is now
        passing = v.rank(np.full(len(at), floor), token[beyond])
        redo.update(word[at[passing < floor]].tolist())
        token[at], after[at], before[beyond] = floor, beyond, at
        current[right], live[right], current[at] = NONE, False, NONE
        left = before[at]
        file(np.concatenate([at[beyond < n], left[left < n]]))

    file(np.flatnonzero(live[:n] & (after[:n] < n)))
    while heap:
        floor = heapq.heappop(heap)
        arrays, places = many.pop(floor, []), few.pop(floor, [])
        if sum(map(len, arrays)) + len(places) > 48:
            merge_many(np.unique(np.concatenate([*arrays, np.array(places, dtype=np.int64)])))
        else:
            merge_few([p for a in arrays for p in a.tolist()] + places)

    dead = np.zeros(n + 1, dtype=bool)
    dead[:n] = ~live[:n] & (whole[word] < 0)
    first = (ends - sizes)[sizes > 0]
    token[first] = np.where(whole[sizes > 0] >= 0, whole[sizes > 0], token[first])
    keep = ~dead[:n] & ((whole[word] < 0) | np.isin(np.arange(n), first))
    ids, counts = token[:n][keep], np.bincount(word[keep], minlength=len(pieces))
    if redo:
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for w in redo:
            parts[w] = np.array(_one(pieces[w], v), dtype=np.int64)
        ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
    return ids, counts


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class _Pieces(dict):
    """piece -> number, in order of first sight."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


def cut(text: str, pattern: regex.Pattern, number: Callable[[str], int]) -> np.ndarray:
    """The numbers of the text's pieces."""
    if len(text) < CHUNK_CHARS:
        return np.fromiter(map(number, pattern.findall(text)), dtype=np.int32)
    found, parts = (m[0] for m in pattern.finditer(text)), []
    while block := list(islice(found, BLOCK)):
        parts.append(np.fromiter(map(number, block), dtype=np.int32, count=len(block)))
    return np.concatenate(parts)


class Known:
    """Pieces seen so far and their ids."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.pieces, self.done = _Pieces(), 0
        self.ids, self.starts, self.counts = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def replay_new(self) -> None:
        """Replay the merges over the pieces that are new."""
        fresh = [p if isinstance(p, bytes) else p.encode() for p in islice(self.pieces, self.done, None)]
        if fresh:
            ids, counts = replay(fresh, self.v)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.done = len(self.pieces)

    def join(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        numbers = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        sizes = self.counts[numbers]
        edges = np.cumsum([0, *map(len, rows)])
        totals = np.concatenate([[0], np.cumsum(sizes)])[edges]
        return self.ids[_spread(self.starts[numbers], sizes)], np.diff(totals)


class Encoder(Known):
    """Encodes the texts of one task, remembering the pieces it has seen."""

    def __init__(self, v: Vocabulary, pattern: str):
        super().__init__(v)
        self.pattern = regex.compile(pattern)

    def learn(self, texts: list[str]) -> list[np.ndarray]:
        """The piece numbers of each text, after replaying the merges over the
        pieces that are new."""
        if self.done > MAX_PIECES:
            self.clear()
        rows = [cut(t, self.pattern, self.pieces.__getitem__) for t in texts]
        self.replay_new()
        return rows


def _chunks(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batch of about ``limit`` in size, at least a row each."""
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
    return _chunks(batch, sizes.to_numpy(zero_copy_only=False).astype(np.int64), limit)


def _lists(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers follow the order of first sight, so most are small: their bytes are
    stored lowest first, all of one place together, and compressed."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


NUMBERED = "block long, doc_id long, n int, numbers binary, part int, sizes binary, words binary"
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _rows(size: int, block: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of ``NUMBERED``; columns that are not given are null."""
    columns["block"] = pa.array([block] * size, pa.int64())
    names, types = zip(*(c.split() for c in NUMBERED.split(", ")), strict=True)
    arrays = [columns[c] if c in columns else pa.nulls(size, ARROW[t]) for c, t in zip(names, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def numbered(docs: DataFrame, pattern: str, parts: int, block_bytes: int = BLOCK_BYTES, most: int = BLOCK_PIECES) -> DataFrame:
    """Rows of two kinds: block, doc_id, n, numbers (a document's n pieces by their
    numbers in the block), and block, part, n, numbers, sizes, words (n distinct pieces
    of the block with one digest modulo ``parts``: steps between their ascending
    numbers, bytes of each, and the bytes). A block ends when it holds
    ``block_bytes`` of text or more than ``most`` pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, block = regex.compile(pattern), TaskContext.get().partitionId() << 32
        known, seen = _Pieces(), 0

        def pieces() -> pa.RecordBatch:
            found = np.array([p.encode() for p in known], dtype=object)
            part = np.array([zlib.crc32(p) % parts for p in found], dtype=np.int64)
            order = np.argsort(part, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []
            sizes = [np.array([len(p) for p in found[g]], dtype=np.int32) for g in groups]
            return _rows(
                len(groups), block, part=pa.array([int(part[g[0]]) for g in groups], pa.int32()),
                n=pa.array([len(g) for g in groups], pa.int32()), sizes=pa.array(map(_packed, sizes), pa.binary()),
                numbers=pa.array([_packed(np.diff(g, prepend=0)) for g in groups], pa.binary()),
                words=pa.array([pa.compress(b"".join(found[g]), codec="zstd", asbytes=True) for g in groups], pa.binary()),
            )

        for batch in batches:
            for chunk in text_chunks(batch, min(CHUNK_CHARS, block_bytes)):
                texts = [t or "" for t in chunk.column("text").to_pylist()]
                rows = [cut(t, cutter, known.__getitem__) for t in texts]
                numbers = pa.array(map(_packed, rows), pa.binary())
                yield _rows(len(rows), block, doc_id=chunk.column("doc_id"), n=pa.array(map(len, rows), pa.int32()), numbers=numbers)
                seen += sum(map(len, texts))
                if seen >= block_bytes or len(known) > most:
                    yield pieces()
                    known, block, seen = _Pieces(), block + 1, 0
        yield pieces()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, NUMBERED)


def _words(row: dict) -> list[bytes]:
    """The pieces of a row."""
    edges = np.cumsum(np.append(0, _unpacked(row["sizes"], row["n"])), dtype=np.int64).tolist()
    data = pa.decompress(row["words"], edges[-1], codec="zstd", asbytes=True)
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


REPLAYED = "block long, n int, numbers binary, counts binary, n_ids long, ids binary"


def replayed(pieces: DataFrame, ranks: Broadcast, limit: int = REPLAY_BYTES, most: int = PART_PIECES) -> DataFrame:
    """block, n, numbers, counts, n_ids, ids: the pieces' numbers, how many ids each has,
    and these. All rows of a part lie together in one task, so a piece is replayed there
    for all blocks; only where a part has more than ``most`` pieces can one come again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = Known(vocabulary(ranks.value)), [], 0

        def done() -> pa.RecordBatch:
            known.replay_new()
            out = []
            for row, which in held:
                ids, counts = known.join([which])[0], known.counts[which]
                packed = {"counts": _packed(counts), "n_ids": len(ids), "ids": _packed(ids)}
                out.append({"block": row["block"], "n": row["n"], "numbers": row["numbers"]} | packed)
            if known.done > most:
                known.clear()
            fields = [c.split() for c in REPLAYED.split(", ")]
            return pa.RecordBatch.from_pylist(out, pa.schema([(c, ARROW[t]) for c, t in fields]))

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                words = _words(row)
                held.append((row, np.fromiter(map(known.pieces.__getitem__, words), dtype=np.int64)))
                size += sum(map(len, words))
                if size >= limit:
                    yield done()
                    held, size = [], 0
        if held:
            yield done()

    rows = pieces.select("block", "part", "n", "numbers", "sizes", "words").repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(run, REPLAYED)


IDS = "doc_id long, ids array<int>"
DECODED = f"{IDS}, decoded binary"
DECODED_FIELDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def _assembled(texts: pa.Table, pieces: pa.Table) -> Iterator[pa.RecordBatch]:
    """doc_id, ids of a block's documents, from the ids of its pieces; in batches of
    about 2 ``BLOCK`` ids, at least a document each."""
    rows = pieces.to_pylist()
    none = [np.zeros(0, dtype=np.int64)]
    numbers = np.concatenate(none + [np.cumsum(_unpacked(r["numbers"], r["n"])) for r in rows])
    lengths = np.concatenate(none + [_unpacked(r["counts"], r["n"]).astype(np.int64) for r in rows])
    ids = np.concatenate([np.zeros(0, np.int32)] + [_unpacked(r["ids"], r["n_ids"]) for r in rows])
    starts, counts = np.empty_like(lengths), np.empty_like(lengths)
    starts[numbers], counts[numbers] = np.cumsum(lengths) - lengths, lengths
    docs, held, size = [], [ids[:0]], 0

    def done() -> pa.RecordBatch:
        totals = np.array([len(x) for x in held[1:]], dtype=np.int64)
        lists = pa.ListArray.from_arrays(_lists(totals), pa.array(np.concatenate(held), pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), lists], ["doc_id", "ids"])

    for batch in texts.to_batches():
        for doc, n, data in zip(batch.column("doc_id"), batch.column("n"), batch.column("numbers"), strict=True):
            places = _unpacked(data.as_py(), n.as_py())
            docs.append(doc.as_py())
            held.append(ids[_spread(starts[places], counts[places])])
            size += len(held[-1])
            if size >= 2 * BLOCK:
                yield done()
                docs, held, size = [], [ids[:0]], 0
    yield done()


def _decoded(batch: pa.RecordBatch, v: Vocabulary) -> Iterator[pa.RecordBatch]:
    """doc_id, ids, decoded of a batch of doc_id, ids."""
    sizes = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for b in _chunks(batch, sizes.astype(np.int64), 2 * BLOCK):
        lists = b.column("ids")
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = v.sizes[ids]
        data = v.content[_spread(v.starts[ids], lengths)]
        edges = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        out = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists, out], ["doc_id", "ids", "decoded"])


def _bucketed(frame: DataFrame, path: str, column: str, buckets: int) -> DataFrame:
    """Cut the lineage as ``written`` does, with rows in files by ``column``, so that
    a later grouping by it reads them in place. The table's name is needed only to
    read the files back as buckets, and goes; the files stay under ``path``."""
    name = f"numbered_{uuid.uuid4().hex}"
    frame.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    read = frame.sparkSession.table(name)
    frame.sparkSession.sql(f"DROP TABLE {name}")
    return read


def _shared(spark: SparkSession, ranks_path: str) -> Broadcast:
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _blocks(docs: DataFrame, shared: Broadcast, pattern: str, **sizes: int) -> PandasCogroupedOps:
    """Each block's documents beside the ids of its pieces. Parts and buckets are as
    many as the session's shuffle partitions."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _bucketed(numbered(docs, pattern, parts, **sizes), scratch(spark, "pieces"), "block", parts)
    ids = replayed(rows.where("part is not null"), shared)
    texts = rows.where("part is null").select("block", "doc_id", "n", "numbers")
    return texts.groupBy("block").cogroup(ids.groupBy("block"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, **sizes: int) -> DataFrame:
    """doc_id, ids: the token ids of every text. ``ranks_path`` names a rank file
    that the driver reads; its size is that of the vocabulary. ``sizes``: other bounds
    for ``numbered``."""

    def run(texts: pa.Table, pieces: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_assembled(texts, pieces))

    return _blocks(docs, _shared(docs.sparkSession, ranks_path), pattern, **sizes).applyInArrow(run, IDS)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids, decoded: the bytes that the ids stand for."""
    shared = _shared(encoded.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _decoded(batch, vocabulary(shared.value))

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, **sizes: int) -> DataFrame:
    """``decode`` of ``encode``, in one step: the ids are decoded by the Python worker
    that has put them together, so a task keeps one worker and not two, and they pass
    through Spark's memory once."""
    shared = _shared(docs.sparkSession, ranks_path)

    def run(texts: pa.Table, pieces: pa.Table) -> pa.Table:
        v = vocabulary(shared.value)
        return pa.Table.from_batches((d for batch in _assembled(texts, pieces) for d in _decoded(batch, v)), DECODED_FIELDS)

    return _blocks(docs, shared, pattern, **sizes).applyInArrow(run, DECODED)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    return round_trip(docs, ranks_path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
