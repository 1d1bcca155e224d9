"""Token ids in files, compressed by Re-Pair grammars with random access.

Documents are encoded, put in order of their id, and cut into shards of about a million ids. In
each shard the most frequent pairs of neighbouring symbols are replaced by nonterminals, again
and again until no pair occurs LEAST_PAIRS times; a pair never reaches over the end of a
document. A shard stores its rules, how many ids each rule stands for, the shortened sequence
and where each document starts in it, so one document is decoded without the others. Shards
are rows of a Parquet table:

    part, shard        number of the partition (in order of doc_id) and of the shard in it
    first_token        ids of all documents of the partition before the shard
    n_tokens, doc_ids  ids in the shard, documents in order
    grammar            the binary form below

    4 bytes  RPG1
    5 x u32  size of the alphabet, rules, sequence, documents; bytes per symbol (2 or 4)
    u32[]    rules, two per rule: symbols below the alphabet are ids, others earlier rules
    u32[]    ids that each rule stands for
    u32[]    where each document starts in the sequence, and the end
    u16[] or u32[]  the sequence

All numbers are little-endian. A document longer than a shard is a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martloom.llm.bpe import PIECE as _PIECE, PLAIN as _PLAIN, Chunks, byte_characters

END_ID = 1
SHARD_IDS = 1 << 20
# Rules made at a time: those of the most frequent pairs first, the next ones in a later round.
ROUND_RULES = 4096
# How often a pair must occur to become a rule. A rule takes 12 bytes and each use saves 2 or 4:
# rarer pairs save little or nothing, as not every occurrence can be used.
LEAST_PAIRS = 12

_MAGIC = b"RPG1"
_HASHED = 1 << 20


def _frequent(codes: np.ndarray, least: int) -> np.ndarray:
    """The most frequent pair codes, sorted. Equally frequent ones: the smaller first."""
    ordered = np.sort(codes)
    if not len(ordered):
        return ordered
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(ordered)]]))
    often = counts >= least
    starts, counts = starts[often], counts[often]
    best = np.argsort(-counts, kind="stable")[:ROUND_RULES]
    return np.sort(ordered[starts[best]])


def _alternate(places: np.ndarray) -> np.ndarray:
    """Which of ascending places to take: of each run of neighbours every second one, from the
    first. Pairs must not overlap."""
    number = np.arange(len(places))
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1] + 1
    begin = np.maximum.accumulate(np.where(first, number, 0))
    return (number - begin) % 2 == 0


def compress(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST_PAIRS) -> bytes:
    """The binary form of documents of the given sizes, one after another. No size may be 0.
    No pair is left that occurs `least` times or more.

    After the first round only pairs with a symbol of the round before are counted: others were
    counted then, and only lose occurrences. Those that had to wait are found by one more count of
    all pairs at the end, which starts the rounds again if there are any.
    """
    sequence = ids.astype(np.uint32)
    last = np.zeros(len(sequence), bool)  # ends of documents; ids cannot tell
    last[np.cumsum(sizes) - 1] = True
    alphabet = int(sequence.max()) + 1 if len(sequence) else 0
    rules: list[np.ndarray] = []
    lengths = np.ones(alphabet, np.int64)
    symbols = alphabet
    new = 0  # symbols from here on are counted
    while len(sequence) > 1:
        # symbols of 16 bits, as of most vocabularies, make codes that sort faster
        wide = symbols > 1 << 16
        shift = 32 if wide else 16
        places = ~last[:-1]
        if new:
            fresh = sequence >= new
            places &= fresh[:-1] | fresh[1:]
        places = np.flatnonzero(places)
        kind = np.uint64 if wide else np.uint32
        codes = (sequence[places].astype(kind) << kind(shift)) | sequence[places + 1]
        chosen = _frequent(codes, least)
        if not len(chosen):
            if not new:
                break
            new = 0
            continue
        # a table by hash gives each place its rule; of two pairs with one hash, one must wait
        table = np.full(_HASHED, -1, np.int32)
        table[_hashed(chosen)] = np.arange(len(chosen))
        rank = table[_hashed(codes)]
        exact = np.flatnonzero(rank >= 0)
        exact = exact[chosen[rank[exact]] == codes[exact]]
        places, rank = places[exact], rank[exact]
        use = _alternate(places)
        places, rank = places[use], rank[use]
        used, number = np.unique(rank, return_inverse=True)
        pairs = chosen[used].astype(np.int64)
        pairs = np.stack([pairs >> shift, pairs & ((1 << shift) - 1)], axis=1)
        sequence[places] = symbols + number
        keep = np.ones(len(sequence), bool)
        keep[places + 1] = False
        last[places] = last[places + 1]
        sequence, last = sequence[keep], last[keep]
        rules.append(pairs)
        lengths = np.concatenate([lengths, lengths[pairs].sum(axis=1)])
        new = symbols
        symbols += len(pairs)
    every = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], ends])
    width = 2 if symbols <= 1 << 16 else 4
    head = np.array([alphabet, len(every), len(sequence), len(ends), width], "<u4")
    parts = [head, every.ravel(), lengths[alphabet:], starts]
    numbers = b"".join(p.astype("<u4").tobytes() for p in parts)
    return _MAGIC + numbers + sequence.astype(f"<u{width}").tobytes()


def _hashed(codes: np.ndarray) -> np.ndarray:
    """Places of codes in a table: some bits of a product that wraps around."""
    multiplier, bits = (0x9E3779B97F4A7C15, 44) if codes.dtype == np.uint64 else (0x9E3779B1, 12)
    return (codes * codes.dtype.type(multiplier)) >> codes.dtype.type(bits)


class Shard:
    """A shard's grammar, opened for reading."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != _MAGIC:
            raise ValueError("not a grammar shard")
        self.alphabet, rules, size, documents, width = np.frombuffer(data, "<u4", 5, 4).tolist()
        cuts = np.cumsum([0, 2 * rules, rules, documents + 1])
        numbers = np.frombuffer(data, "<u4", cuts[-1], 24).astype(np.int64)
        self.rules, own, self.starts = (
            numbers[a:b] for a, b in zip(cuts, cuts[1:], strict=False)
        )
        place = 24 + 4 * int(cuts[-1])
        self.sequence = np.frombuffer(data, f"<u{width}", size, place).astype(np.int64)
        self.rules = self.rules.reshape(-1, 2)
        self.lengths = np.concatenate([np.ones(self.alphabet, np.int64), own])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that symbols stand for. Each pass replaces all rules by their pairs."""
        while len(symbols) and symbols.max() >= self.alphabet:
            rule = symbols >= self.alphabet
            place = np.cumsum(1 + rule) - 1 - rule
            out = np.empty(len(symbols) + int(rule.sum()), np.int64)
            out[place[~rule]] = symbols[~rule]
            pairs = self.rules[symbols[rule] - self.alphabet]
            out[place[rule]], out[place[rule] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out
        return symbols.astype("<u4")

    def ids(self) -> np.ndarray:
        """The ids of all documents: every rule is expanded once, and copied where it stands."""
        rules = np.arange(self.alphabet, self.alphabet + len(self.rules))
        written = np.concatenate([np.arange(self.alphabet, dtype="<u4"), self.expand(rules)])
        begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        sizes = self.lengths[self.sequence]
        ends = np.cumsum(sizes)
        shift = begin[self.sequence] - (ends - sizes)
        return written[np.repeat(shift, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def document(self, number: int) -> np.ndarray:
        """The ids of one document; only its part of the sequence is read."""
        return self.expand(self.sequence[self.starts[number] : self.starts[number + 1]])

    def sizes(self) -> np.ndarray:
        """Ids of each document, from the lengths of rules alone."""
        sums = np.concatenate([[0], np.cumsum(self.lengths[self.sequence])])
        return np.diff(sums[self.starts])


class _Ids:
    """Ids of texts from the tokenizers library. Chunks between white space are encoded on
    their own and remembered: the tokenizer drops white space and joins nothing over it."""

    def __init__(self, text: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.source = text
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.as_character = dict(enumerate(byte_characters()))
        self.remembered = Chunks(self.encode)
        self.pieces = Chunks(self.piece)

    def piece(self, text: str) -> bytes:
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.as_character)
        ids = [t.id for t in self.model.tokenize(text)]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, chunk: bytes) -> bytes:
        """Chunks of Latin letters and ASCII marks have plain pieces, which go to the library's
        model at once and are remembered, too: many chunks differ in their marks only. All others
        go through the whole of the library."""
        text = chunk.decode()
        if len(text) < 200 and _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))
        ids = self.library.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def of(self, text: bytes | None) -> bytes:
        return b"".join(map(self.remembered.__getitem__, text.split())) if text else b""


_libraries: dict[int, _Ids] = {}


def _library(text: str) -> _Ids:
    if 0 not in _libraries or _libraries[0].source != text:
        _libraries[0] = _Ids(text)
    return _libraries[0]


def write_shards(documents: DataFrame, tokenizer: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode all documents and write them to `path` in ascending order of doc_id, rows without
    an id first, those of one id by the hash of their text. Repeated rows are documents of their
    own; null text has END_ID only. Any number of rows may share an id, or be equal: ranges end
    within them, too.

    Texts are put in order before they are encoded: they are what Spark samples and shuffles,
    and encoding, compressing and writing are one pass over each range of ids.
    """
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(partitions, "doc_id", "key", "row")
        .sortWithinPartitions("doc_id", "key", "row")
        .select("doc_id", "text")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    doc_type = to_arrow_type(documents.schema["doc_id"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(shared.value)
        last = np.array([END_ID], "<u4").tobytes()
        part = [0, 0]  # shards and ids so far

        def shard(doc_ids: list, texts: list[bytes]) -> pa.RecordBatch:
            numbers = np.frombuffer(b"".join(texts), "<u4")
            sizes = np.array([len(t) // 4 for t in texts])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part[0]], pa.int32()), pa.array([part[1]], pa.int64()),
                    pa.array([len(numbers)], pa.int64()), pa.array([doc_ids], pa.list_(doc_type)),
                    pa.array([compress(numbers, sizes)], pa.binary()),
                ],
                ["shard", "first_token", "n_tokens", "doc_ids", "grammar"],
            )
            part[0] += 1
            part[1] += len(numbers)
            return row

        doc_ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                text = library.of(value.as_py()) + last
                if texts and size + len(text) > 4 * shard_ids:
                    yield shard(doc_ids, texts)
                    doc_ids, texts, size = [], [], 0
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield shard(doc_ids, texts)

    shards = ordered.mapInArrow(
        cut, f"shard int, first_token bigint, n_tokens bigint, doc_ids array<{kind}>, grammar binary"
    )
    shards = shards.select(F.spark_partition_id().alias("part"), "*")
    shards.write.option("compression", "zstd").parquet(path)


def read_documents(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards at `path`; start
    counts the ids of all documents before it."""
    shards = spark.read.parquet(path)
    # one number per partition of the writing job
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before: dict[int, int] = {}
    total = 0
    for row in sizes:
        before[row["part"]] = total
        total += row["n"]
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, doc_ids, grammar in zip(
                batch.column("part").to_pylist(), batch.column("first_token").to_pylist(),
                batch.column("doc_ids"), batch.column("grammar"), strict=True,
            ):
                shard = Shard(grammar.as_py())
                sizes = shard.sizes()
                starts = before[part] + first + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                ids = shard.ids()
                sums = [zlib.crc32(x) for x in np.split(ids, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.select("part", "first_token", "doc_ids", "grammar").mapInArrow(
        decode, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
