"""Byte-level BPE encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How the vocabulary's pre-tokenizer cuts a text, with its white space written out.
_WHITE = r"\t-\r\x20\x85\xa0  -     　"
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)

# Texts encoded together, in characters, and distinct pieces that a task remembers.
GROUP = 1 << 20
REMEMBERED = 200_000


def byte_characters() -> dict[str, int]:
    """Character of a vocabulary entry -> byte: printable Latin-1 stands for itself, the rest for 256 and up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Merge table and token bytes as arrays: a few MB, whatever is encoded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        byte_of = byte_characters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.uint64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.uint64)
        keys = left << np.uint64(32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.first = np.zeros(256, dtype=np.int64)
        for character, byte in byte_of.items():
            self.first[byte] = vocab[character]
        size = max([*vocab.values(), *self.added.values()]) + 1
        texts = [b""] * size
        for token, number in vocab.items():
            texts[number] = bytes(byte_of[c] for c in token)
        for token, number in self.added.items():
            texts[number] = token.encode()
        self.lengths = np.array([len(x) for x in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)


class Numbers(dict):
    """Numbers pieces as they first occur; ``new`` lists those since it was last emptied."""

    def __init__(self, pieces):
        super().__init__({piece: k for k, piece in enumerate(pieces)})
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes and decodes lists of texts; remembers a bounded number of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cut = regex.compile(PIECES).findall
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")").split if added else None
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers(self.v.added)
        self.flat = np.fromiter(self.v.added.values(), dtype=np.int64)
        self.counts = np.ones(len(self.known), dtype=np.int64)
        self.at = np.arange(len(self.known), dtype=np.int64)

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number by piece): each round merges, in every piece, all places of its lowest-ranked pair."""
        v = self.v
        raw = [p.encode() for p in pieces]
        symbols = v.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
        done_ids, done_piece = [], []
        while len(symbols):
            keys = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:].astype(np.uint64)
            place = np.searchsorted(v.keys, keys)
            place[place == len(v.keys)] = 0
            found = (v.keys[place] == keys) & (piece[:-1] == piece[1:])
            rank = np.full(len(symbols), len(v.keys), dtype=np.int64)
            rank[:-1][found] = v.ranks[place[found]]
            begins = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            sizes = np.diff(np.r_[begins, len(piece)])
            lowest = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            over = lowest == len(v.keys)  # nothing to merge in these pieces any more
            done_ids.append(symbols[over])
            done_piece.append(piece[over])
            hit = (rank == lowest) & ~over
            # in a run of overlapping places, every other one from the left merges
            where = np.flatnonzero(hit)
            if not len(where):
                break
            fresh = np.r_[True, np.diff(where) > 1]
            offset = np.arange(len(where)) - np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
            where = where[offset % 2 == 0]
            symbols[where] = v.made[rank[where]]
            stay = ~over
            stay[where + 1] = False
            symbols, piece = symbols[stay], piece[stay]
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        of = np.concatenate(done_piece) if done_piece else np.zeros(0, np.int64)
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=len(pieces))

    def _pieces(self, text: str) -> list[str]:
        if self.split is None:
            return self.cut(text)
        out: list[str] = []
        for k, part in enumerate(self.split(text)):
            out += [part] if k % 2 else self.cut(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number by text)."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known, lists = self.known, []
        for text in texts:
            cut = self._pieces(text)
            lists.append(np.fromiter(map(known.__getitem__, cut), dtype=np.int64, count=len(cut)))
        if known.new:
            ids, counts = self._merged(known.new)
            known.new = []
            self.at = np.r_[self.at, len(self.flat) + np.cumsum(counts) - counts]
            self.flat, self.counts = np.r_[self.flat, ids], np.r_[self.counts, counts]
        words = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        sizes = self.counts[words]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.arange(total) + np.repeat(self.at[words] - (ends - sizes), sizes)]
        bounds = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
        reach = np.r_[0, ends]
        return flat, reach[bounds[1:]] - reach[bounds[:-1]]

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        v = self.v
        sizes = v.lengths[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        body = v.bytes[np.arange(total) + np.repeat(v.starts[flat] - (ends - sizes), sizes)].tobytes()
        reach = np.r_[0, ends][np.r_[0, np.cumsum(counts)].astype(np.int64)].tolist()
        return [body[a:b].decode("utf-8", errors="replace") for a, b in zip(reach[:-1], reach[1:], strict=True)]


def _groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, n in enumerate(lengths):
        size += n
        if size >= GROUP:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


def load(spark: SparkSession, path: str):
    """The vocabulary as a broadcast: its size is that of the vocabulary file, not of the data."""
    return spark.sparkContext.broadcast(Vocabulary(path))


def _packed(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    body, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
    return pa.array([body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], type=pa.binary())


def encode_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), decode: bool = False
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit integers), with ``decode`` also
    ``decoded``, the text of those ids, and the columns to ``keep``, in one pass without a shuffle.

    ``path``: a byte-level BPE vocabulary file, read by the driver. Added tokens that occur in a text become their own
    id. Null or empty text: no tokens, decoded empty. Repeated rows and null doc_ids are carried along; other columns
    are not read. Texts are encoded in groups of about ``GROUP`` characters, a longer text by itself. No rows give no
    rows.
    """
    vocabulary = load(docs.sparkSession, path)
    chosen = docs.select(F.col(text).alias("__text"), F.col(doc_id).alias("doc_id"), *keep)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:]]
    out = [kinds[0], "n_tokens long", "ids binary", *(["decoded string"] if decode else []), *kinds[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for first, last in _groups([n or 0 for n in pc.utf8_length(batch.column(0)).to_pylist()]):
                rows = batch.slice(first, last - first)
                flat, counts = encoder.encode([x or "" for x in rows.column(0).to_pylist()])
                made = [rows.column(1), pa.array(counts, pa.int64()), _packed(flat, counts)]
                if decode:
                    made.append(pa.array(encoder.decode(flat, counts), type=pa.string()))
                names = ["doc_id", "n_tokens", "ids", *(["decoded"] if decode else []), *rows.schema.names[2:]]
                yield pa.RecordBatch.from_arrays(made + rows.columns[2:], names)

    return chosen.mapInArrow(run, ", ".join(out))


def decode_documents(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` added (or replaced): the text of packed ids. Bytes that are no UTF-8 become U+FFFD, null
    ids an empty text."""
    vocabulary = load(rows.sparkSession, path)
    chosen = rows.drop("decoded").select(F.col(ids).alias("__ids"), *(c for c in rows.columns if c != "decoded"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for first, last in _groups([n or 0 for n in pc.binary_length(batch.column(0)).to_pylist()]):
                part = batch.slice(first, last - first)
                packed = [x or b"" for x in part.column(0).to_pylist()]
                flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64)
                texts = encoder.decode(flat, np.array([len(x) // 4 for x in packed], dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, type=pa.string())], [*part.schema.names[1:], "decoded"])

    return chosen.mapInArrow(run, ", ".join([*kinds, "decoded string"]))
