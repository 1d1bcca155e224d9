"""Exact BPE encoding by backtracking, and decoding through an offset table.

An encoding is exact if every token stands for its own text and every two neighbours are
compatible: plain merging of both texts together gives the two tokens back. A text has one such
sequence, and so has each of its beginnings. The encoder therefore goes forward with the longest
token at each place, found by an Aho-Corasick automaton; takes a shorter one where neighbours do
not fit; and steps back where none fits. A place that was left is never entered again, so the
time is linear. Compatibility of a pair is worked out once by plain merging and kept in a table.

The vocabulary file is read on the driver from a path given by the caller, and its tables, whose
size is that of the vocabulary, are broadcast.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Stands for the mark of a word's end, outside the 256 byte characters.
END = "Ā"
# Chunks of a text that a worker remembers; the memory is emptied when it is full.
REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64

# Chunks of these characters are normalised and cut here; all others by the library's parts.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: the tokenizer's pieces, for lower-case text of those characters.
PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]"
    r"|[^\sa-zß-öø-ÿ0-9]+"
)


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE vocabulary with marked word ends."""

    def __init__(self, text: str) -> None:
        self.text = text
        spec = json.loads(text)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        self.names: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        as_byte = {c: chr(b) for b, c in enumerate(byte_characters())}
        self.piece: dict[str, int] = {}
        for token, number in model["vocab"].items():
            body, end = (token[: -len(self.mark)], END) if token.endswith(self.mark) else (token, "")
            self.piece["".join(as_byte[c] for c in body) + end] = number
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = (model["vocab"][left], model["vocab"][right])
            self.merge.setdefault(pair, (rank, model["vocab"][left + right]))
        self.spelt = {number: piece for piece, number in self.piece.items()}

    def symbols(self, piece: str) -> list[int]:
        """The piece in single bytes, the last one with the mark if the piece has it."""
        if piece.endswith(END):
            return [*(self.piece[c] for c in piece[:-2]), self.piece[piece[-2:]]]
        return [self.piece[c] for c in piece]

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain BPE: the pair of lowest rank first, the leftmost of equal ones."""
        tokens: list[int | None] = list(symbols)
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if i >= 0 and j < n and (found := self.merge.get((tokens[i], tokens[j]))):
                heapq.heappush(heap, (found[0], i, tokens[i], tokens[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != left or j >= n or tokens[j] != right:
                continue
            tokens[i], tokens[j] = self.merge[(left, right)][1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in tokens if t is not None]

    @cached_property
    def usable(self) -> frozenset[int]:
        """Tokens that plain merging of their own text gives."""
        return frozenset(
            number
            for piece, number in self.piece.items()
            if piece != END and self.merged(self.symbols(piece)) == [number]
        )

    @cached_property
    def shorter(self) -> dict[int, int | None]:
        """For each usable token the longest usable one that begins it."""
        known = {piece: n for piece, n in self.piece.items() if n in self.usable}
        return {
            n: next((known[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in known), None)
            for piece, n in known.items()
        }

    @cached_property
    def decimals(self) -> dict[int, bytes]:
        return {number: b"%d" % number for number in self.names}

    @cached_property
    def offset_table(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' text, each with a space after it, in one run of bytes; where each id's
        text starts and, at the next place, ends. Ids that are not in use are empty."""
        texts = [
            f"{self.names[i]} ".encode() if i in self.names else b""
            for i in range(max(self.names) + 1)
        ]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return np.frombuffer(b"".join(texts), np.uint8), ends


class Encoder:
    """Encodes texts with the tables of a vocabulary; made once per worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        self.length = {n: len(p) for p, n in vocabulary.piece.items()}
        for number in vocabulary.usable:
            self.automaton.add_word(vocabulary.spelt[number], number)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.remembered = Chunks(self.encode_chunk)

    def fits(self, left: int, right: int) -> bool:
        known = self.compatible.get((left, right))
        if known is None:
            table = self.vocabulary
            symbols = table.symbols(table.spelt[left]) + table.symbols(table.spelt[right])
            known = self.compatible[(left, right)] = table.merged(symbols) == [left, right]
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of a piece given as byte characters, without its end mark."""
        if not piece:
            return []
        piece += END
        length, shorter = self.length, self.vocabulary.shorter
        longest: list[int | None] = [None] * (len(piece) + 1)
        for last, number in self.automaton.iter(piece):
            longest[last - length[number] + 1] = number  # longer ones end later
        tokens: list[int] = []
        open_place = bytearray(b"\1" * (len(piece) + 1))
        place, token = 0, longest[0]
        while place < len(piece):
            while token is not None:
                behind = place + length[token]
                if open_place[behind] and (not tokens or self.fits(tokens[-1], token)):
                    break
                token = shorter[token]
            if token is None:
                open_place[place] = 0
                last = tokens.pop()
                place -= length[last]
                token = shorter[last]
            else:
                tokens.append(token)
                place = behind
                token = longest[place]
        return tokens

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a text without special tokens, as byte characters."""
        if PLAIN.fullmatch(text):
            found = PIECE.findall(text.lower())
            return found if text.isascii() else [p.encode().decode("latin-1") for p in found]
        parts = self._parts
        as_byte = self._as_byte
        normal = parts.normalizer.normalize_str(text)
        return [
            "".join(as_byte[c] for c in piece)
            for piece, _ in parts.pre_tokenizer.pre_tokenize_str(normal)
        ]

    @cached_property
    def _parts(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.vocabulary.text)

    @cached_property
    def _as_byte(self) -> dict[str, str]:
        return {c: chr(b) for b, c in enumerate(byte_characters())}

    @cached_property
    def _special(self) -> re.Pattern[str]:
        longest_first = sorted(self.vocabulary.special, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def encode_chunk(self, chunk: bytes) -> bytes:
        """Ids of a text without white space, as little-endian unsigned 32-bit integers."""
        text = chunk.decode()
        special = self.vocabulary.special
        ids: list[int] = []
        for part in self._special.split(text) if special and "<" in text else (text,):
            if part in special:
                ids.append(special[part])
            else:
                for piece in self._pieces(part) if part else ():
                    ids += self.encode_piece(piece)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a UTF-8 text; none for null."""
        return b"".join(map(self.remembered.__getitem__, text.split())) if text else b""

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' text with a space between two of them; unknown ids are left out."""
        table, ends = self.vocabulary.offset_table
        ids = ids[ids < len(ends) - 1].astype(np.int64)
        sizes = ends[ids + 1] - ends[ids]
        stops = np.cumsum(sizes)
        if not len(stops) or not stops[-1]:
            return b""
        from_where = np.repeat(ends[ids] - (stops - sizes), sizes)
        from_where += np.arange(stops[-1])
        return table[from_where][:-1].tobytes()


class Chunks(dict):
    """Remembers what chunks became."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.encode(chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = ids
        return ids


_encoders: dict[int, tuple[str, Encoder]] = {}


def _encoder(broadcast) -> Encoder:
    """The worker's encoder of a broadcast vocabulary, made when it is first asked for."""
    vocabulary = broadcast.value
    if len(_encoders) != 1 or next(iter(_encoders.values()))[0] != vocabulary.text:
        _encoders.clear()
        _encoders[0] = (vocabulary.text, Encoder(vocabulary))
    return _encoders[0][1]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as file:
        vocabulary = Vocabulary(file.read())
    vocabulary.usable, vocabulary.shorter  # noqa: B018  made once, sent with the rest
    return vocabulary


def encoded(documents: DataFrame, path: str, decode: bool = False, keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256), and ids (array of int) with
    `keep_ids`, decoded_sha256 with `decode`.

    One row per document, repeated rows too; null text has no ids, like an empty one. Other
    columns are not looked at. The hash of the ids is that of their decimals joined by a space.
    """
    import hashlib

    shared = documents.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string"
    schema += ", decoded_sha256 string" if decode else ""
    schema += ", ids array<int>" if keep_ids else ""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        decimals = encoder.vocabulary.decimals
        for batch in batches:
            counts, hashes, texts, arrays = [], [], [], []
            for value in batch.column("text").cast(pa.binary()):
                ids = np.frombuffer(encoder.encode(value.as_py()), "<u4")
                counts.append(len(ids))
                line = b" ".join(map(decimals.__getitem__, ids.tolist()))
                hashes.append(hashlib.sha256(line).hexdigest())
                if decode:
                    texts.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if keep_ids:
                    arrays.append(ids.astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes)]
            names = ["doc_id", "n_tokens", "ids_sha256"]
            if decode:
                columns.append(pa.array(texts, pa.string()))
                names.append("decoded_sha256")
            if keep_ids:
                columns.append(pa.array(arrays, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select("doc_id", F.col("text")).mapInArrow(of_batches, schema)
