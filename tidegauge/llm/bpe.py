"""Byte-level BPE over a shuffle of distinct words.

Documents are cut into *chunks* of some megabytes of text. A task takes one chunk, splits its texts
into pre-tokens, and keeps the chunk's distinct pre-tokens and, for every position, the number of
the pre-token there. Only the distinct pre-tokens are exploded and shuffled, by their hash: a word
of a hundred thousand documents travels once per chunk, and the merges run once per distinct word.
The ids go back to the chunks, which put them together by position. Decoding joins the token-byte
table, which has a fixed size, to the ids.

Nothing holds more than one chunk or one share of the words. A chunk is closed by its size, the
number of shares follows the size of the data, and words are dealt by hash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import math
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

#: Text of a chunk in code points.
CHUNK_CHARS = 8_000_000
#: Distinct words of all chunks that one task encodes, roughly.
SHARE_BYTES = 64_000_000


# Reading rank files, merging


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of the tokens in a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: of all neighbours the pair with the lowest rank, the first of equals, is merged
    until no pair has a rank. Short words look through all pairs, long ones keep them in a heap."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
    while True:
        best, at = None, -1
        for i, rank in enumerate(pairs):
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 when it was merged away
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def push(a: int) -> None:
        b = end[a]
        if b < n:
            rank = ranks.get(word[a : end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or end[b] != c:
            continue
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
        push(a)
        if before[a] >= 0:
            push(before[a])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


# Splitting


class Splitter:
    """Splits texts into numbered pre-tokens, each distinct one once.

    A single space between two other characters always starts a pre-token, so what lies between
    such spaces, a *piece*, is split once per distinct string and looked up afterwards.
    """

    def __init__(self, pattern: str) -> None:
        self.findall = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.bare: dict[str, int] = {}
        self.spaced: dict[str, int] = {}  # pieces with a space before, which is not in the key
        self.flat = array("I")  # the words of all pieces
        self.lengths = array("I")  # and how many each piece has

    def _new(self, known: dict[str, int], key: str, piece: str) -> int:
        number = known[key] = len(self.lengths)
        words, before = self.words, len(self.flat)
        self.flat.extend([words.setdefault(w, len(words)) for w in self.findall(piece)])
        self.lengths.append(len(self.flat) - before)
        return number

    def pieces_of(self, text: str) -> np.ndarray:
        """Numbers of the pieces of a text, in order."""
        if not text:
            return np.zeros(0, np.uint32)
        parts = text.split(" ")
        bare, spaced, new = self.bare.get, self.spaced.get, self._new
        if "" in parts or not text.isprintable():
            whole = self._joined(parts)
            found = [new(self.bare, p, p) if (n := bare(p)) is None else n for p in whole]
        else:
            first = parts.pop(0)
            found = [new(self.bare, first, first) if (n := bare(first)) is None else n]
            found += [new(self.spaced, p, " " + p) if (n := spaced(p)) is None else n for p in parts]
        return np.array(found, dtype=np.uint32)

    @staticmethod
    def _joined(parts: list[str]) -> list[str]:
        """Pieces with their spaces: a part that is empty or ends in white space goes on with the next."""
        done: list[str] = []
        run: list[str] = []
        for part in parts:
            if run and run[-1] and not run[-1][-1].isspace():
                done.append(" ".join(run))
                run = ["", part]  # the space before the part is its own
            else:
                run.append(part)
        done.append(" ".join(run))
        return done

    def word_numbers(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pre-tokens of texts given by their pieces, and how many each text has."""
        lengths = np.array(self.lengths, dtype=np.int64)
        flat = np.array(self.flat, dtype=np.uint32)
        pieces = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        numbers = spread(flat, np.cumsum(lengths) - lengths, lengths, pieces)
        ends = np.concatenate([[0], np.cumsum(lengths[pieces])])
        stops = np.cumsum([len(t) for t in texts], dtype=np.int64)
        return numbers, np.diff(ends[np.concatenate([[0], stops])])


def spread(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i] : starts[i] + lengths[i]]`` of all chosen i, one after the other."""
    n = lengths[chosen]
    stops = np.cumsum(n)
    total = int(stops[-1]) if len(stops) else 0
    return flat[np.repeat(starts[chosen] - (stops - n), n) + np.arange(total)]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32, byte plane by byte plane, which compresses better."""
    return _pack(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(_unpack(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], dtype="<u4")
    return _pack(len(words).to_bytes(4, "little") + sizes.tobytes() + b"".join(words))


def _unpack_words(data: bytes) -> list[bytes]:
    raw = _unpack(data)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, dtype="<u4", count=n, offset=4), dtype=np.int64) + 4 + 4 * n
    starts = [4 + 4 * n, *ends[:-1].tolist()]
    return [raw[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]


def _share(word: bytes, shares: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % shares


CHUNK_SCHEMA = pa.schema(
    [
        ("chunk", pa.binary()),
        ("doc_ids", pa.binary()),
        ("n_words", pa.binary()),
        ("numbers", pa.binary()),
        ("at", pa.binary()),
        ("words", pa.list_(pa.struct([("share", pa.int32()), ("data", pa.binary())]))),
    ]
)


def _chunk_row(ids: list, texts: list[np.ndarray], split: Splitter, shares: int, mark: bytes) -> pa.RecordBatch:
    """A closed chunk. Its words are numbered by falling frequency, so that small numbers are common;
    ``at`` has these numbers in the order of the words sent, which is by share, then by bytes."""
    numbers, sizes = split.word_numbers(texts)
    words = [w.encode() for w in split.words]
    rank = np.empty(len(words), dtype=np.uint32)
    counts = np.bincount(numbers, minlength=len(words))
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(words), dtype=np.uint32)
    by_share: dict[int, list[int]] = {}
    for i in sorted(range(len(words)), key=words.__getitem__):
        by_share.setdefault(_share(words[i], shares), []).append(i)
    sent = sorted(by_share.items())
    order = np.array([i for _, mine in sent for i in mine], dtype=np.int64)
    row = {
        "doc_ids": _pack(json.dumps(ids).encode()),
        "n_words": _pack_numbers(sizes),
        "numbers": _pack_numbers(rank[numbers]),
        "at": _pack_numbers(rank[order]),
        "words": [{"share": k, "data": _pack_words([words[i] for i in mine])} for k, mine in sent],
    }
    # chunks with equal contents must stay apart, hence the mark
    row["chunk"] = hashlib.sha256(mark + row["doc_ids"] + row["numbers"]).digest()
    return pa.RecordBatch.from_pylist([row], schema=CHUNK_SCHEMA)


def split_chunks(docs: DataFrame, pattern: str, shares: int, chunk_chars: int) -> DataFrame:
    """One row per chunk: its documents, the numbers of their pre-tokens in order, and by share of the
    word hash the distinct pre-tokens. The rows are packed; see the module."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[np.ndarray] = []
        split, chars, made, task = Splitter(pattern), 0, 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                task = part["task"][0].as_py()
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids.append(doc_id)
                    texts.append(split.pieces_of(text))
                    chars += len(text)
                    if chars >= chunk_chars:
                        yield _chunk_row(ids, texts, split, shares, b"%d %d " % (task, made))
                        made += 1
                        ids, texts, split, chars = [], [], Splitter(pattern), 0
        if ids:
            yield _chunk_row(ids, texts, split, shares, b"%d %d " % (task, made))

    columns = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.spark_partition_id().alias("task"),
    )
    return columns.mapInArrow(
        run,
        "chunk binary, doc_ids binary, n_words binary, numbers binary, at binary,"
        " words array<struct<share: int, data: binary>>",
    )


def encode_words(chunks: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Ids of the distinct words, by chunk and share. All chunks' words of one share meet in one
    task, where each distinct word is merged once; equal words are of the same share."""
    sent = chunks.sparkSession.sparkContext.broadcast(ranks)  # a fixed vocabulary

    def run(_: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, known = sent.value, {}
        for batch in batches:
            sizes, packed = [], []
            for data in batch["data"]:
                found = []
                for word in _unpack_words(data):
                    mine = known.get(word)
                    if mine is None:
                        mine = known[word] = tuple(merge_word(word, table))
                    found.append(mine)
                sizes.append(_pack_numbers(np.array([len(f) for f in found])))
                packed.append(_pack_numbers(np.array([i for f in found for i in f])))
            yield pd.DataFrame(
                {"chunk": batch["chunk"], "share": batch["share"], "sizes": sizes, "ids": packed}
            )

    words = chunks.select("chunk", F.explode("words").alias("w")).select("chunk", "w.*")
    return words.groupBy("share").applyInPandas(
        run, "chunk binary, share int, sizes binary, ids binary"
    )


def token_documents(
    chunks: DataFrame, encoded: DataFrame, ranks: dict[bytes, int] | None = None
) -> DataFrame:
    """``doc_id`` and ``ids`` of each document: the numbers of a chunk replaced by the ids of its words.
    With ``ranks`` also ``bytes``, what the ids are decoded to."""
    answers = encoded.groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("share", "sizes", "ids"))).alias("answers")
    )
    joined = chunks.drop("words").join(answers, "chunk", "left")
    sent = None if ranks is None else _send_tokens(chunks, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for part in _assemble(batch.slice(i, 1).to_pylist()[0]):
                    yield part if sent is None else _decoded(part, sent.value)

    columns = joined.select("doc_ids", "n_words", "numbers", "at", "answers")
    more = "" if ranks is None else ", bytes binary"
    return columns.mapInArrow(run, "doc_id bigint, ids binary" + more)


def _assemble(row: dict) -> Iterator[pa.RecordBatch]:
    parts = row["answers"] or []
    at = _unpack_numbers(row["at"])
    empty = [np.zeros(0, np.uint32)]
    ids = np.concatenate([_unpack_numbers(p["ids"]) for p in parts] or empty)
    sizes = np.concatenate([_unpack_numbers(p["sizes"]) for p in parts] or empty).astype(np.int64)
    starts, lengths = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    starts[at], lengths[at] = np.cumsum(sizes) - sizes, sizes
    numbers = _unpack_numbers(row["numbers"])
    names = json.loads(_unpack(row["doc_ids"]))
    ends = np.concatenate([[0], np.cumsum(_unpack_numbers(row["n_words"]), dtype=np.int64)])
    for i in range(0, len(names), 256):
        cuts = ends[i : i + 257]
        here = numbers[cuts[0] : cuts[-1]]
        tokens = spread(ids, starts, lengths, here).astype("<u4")
        stops = np.concatenate([[0], np.cumsum(lengths[here])])[cuts - cuts[0]]
        packed = [tokens[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[i : i + 256], pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "ids"]
        )


def encode_documents(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    chunk_chars: int = CHUNK_CHARS,
    decode: bool = False,
) -> DataFrame:
    """``doc_id`` and ``ids`` of each row of ``docs``: the token ids, packed as little-endian unsigned
    32-bit numbers; ``unpacked`` makes an array of them. With ``decode`` also ``bytes``, as by
    ``decode_documents`` but in the same task.

    A null or empty text has no ids. Repeated rows are each encoded, null ids passed on, other
    columns not read, and an empty table gives no rows. The split texts are stored once, bucketed by
    chunk in a table of the warehouse, so that the ids come to them and they do not move.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shares = max(8, math.ceil(size / SHARE_BYTES))
    buckets = max(8, math.ceil(size / chunk_chars))
    held = store_bucketed(split_chunks(docs, pattern, shares, chunk_chars), "chunk", buckets)
    # dealt like the buckets, so that neither the grouping nor the join deals anew
    encoded = encode_words(held, ranks).repartition(buckets, "chunk")
    return token_documents(held, encoded, ranks if decode else None)


def store_bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` in a table of the warehouse whose later joins and groupings by ``key`` do not shuffle it."""
    name = f"held_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def unpacked(ids: Column) -> Column:
    """Packed ids as an array; null stays null."""

    @pandas_udf("array<bigint>")
    def numbers(packed: pd.Series) -> pd.Series:
        return packed.map(lambda b: None if b is None else np.frombuffer(b, "<u4").astype(np.int64))

    return numbers(ids)


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``ids`` and ``bytes``: the token bytes of the ids, in order.

    Any packed ids may be decoded. The table of token bytes has the fixed size of the vocabulary and
    is joined by broadcast. Null or empty ids give empty bytes, an id that the table does not
    have fails.
    """
    sent = _send_tokens(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                yield _decoded(batch.slice(low, 512), sent.value)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, bytes binary")


def _send_tokens(df: DataFrame, ranks: dict[bytes, int]):
    """Broadcast of the token-byte table, by id; an id without a token has None."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return df.sparkSession.sparkContext.broadcast(tokens)


def _decoded(part: pa.RecordBatch, tokens: list[bytes | None]) -> pa.RecordBatch:
    token_of = tokens.__getitem__
    texts = [
        b"".join(map(token_of, np.frombuffer(ids or b"", "<u4").tolist()))
        for ids in part["ids"].to_pylist()
    ]
    columns = [part["doc_id"], part["ids"], pa.array(texts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "bytes"])


def token_digests(decoded: DataFrame) -> DataFrame:
    """Number of ids, and SHA-256 of the packed ids and of the decoded bytes."""
    ids = F.coalesce("ids", F.lit("").cast("binary"))
    return decoded.select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def tokenizer(spark: SparkSession, path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of the public byte-level vocabulary; read on the driver."""
    import public_tokenizers

    return load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
