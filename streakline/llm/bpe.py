"""Byte-pair encoding over a table of distinct words, and decoding.

Texts are cut into words where a single space stands between two other characters; the
tokenizer's own splitting always cuts there, so words can be encoded apart. Documents are
gathered into blocks of bounded size. Each block gives its distinct words, dealt by hash into
shares and packed; equal words of all blocks meet in one share, where each is encoded once,
and their ids go back to the blocks, packed in the same order, to be joined with the texts.
There, each text's ids are its words' ids in order of position. Decoding looks up the piece
of every id in the vocabulary, which every task holds.

A block is a stretch of an input partition. Should a lost task read other rows again, words
that a block's join lacks are encoded on the spot, so results never depend on the cut.

``decode_table`` decodes any table of id lists through a join with the table of pieces.

Defined cases: null and empty texts have no ids and decode to the empty text; a special
token's text in a document is that token, as the library reads it; repeated rows are all
returned; an empty table gives no rows; columns not named in ``keep`` are dropped.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CUT = re.compile(r"(?<=\S)(?= \S)")
BLOCK_CHARS, PACK_CHARS, SHARE_CHARS, ENCODE_WORDS = 32_000_000, 2_000_000, 16_000_000, 20_000
PIECES = "id int, piece binary"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def words_of(text: str | None) -> list[str]:
    """The text in words; joined, they are the text."""
    return CUT.split(text) if text else []


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: a byte that is a visible
    Latin-1 character stands for itself, the others for the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(spec: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer."""
    data, letters = json.loads(spec), _byte_letters()
    named = {i: token for token, i in data["model"]["vocab"].items()}
    named |= {t["id"]: t["content"] for t in data["added_tokens"]}
    as_bytes = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
    return [as_bytes(named[i]) if i in named else b"" for i in range(max(named) + 1)]


def _encoder(spec: str) -> Callable[[list[str]], list[list[int]]]:
    """A function from words to ids; used in tasks, where one thread is a task's share."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda words: [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the input with the number of their block: about ``BLOCK_CHARS`` of a partition."""
    part, chars, slice_rows = TaskContext.get().partitionId(), 0, 256
    for whole in batches:
        for at in range(0, whole.num_rows, slice_rows):
            b = whole.slice(at, slice_rows)
            yield part << 24 | chars // BLOCK_CHARS, b
            chars += b.column("text").nbytes


def _pack(parts: list[bytes]) -> bytes:
    """Byte strings in one compressed value, in order."""
    sizes = np.array([len(parts), *map(len, parts)], "<u4")
    return zstandard.compress(sizes.tobytes() + b"".join(parts), 6)


def _unpack(packed: bytes) -> list[bytes]:
    data = zstandard.decompress(packed)
    count = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", count, 4), dtype=np.int64) + 4 * (count + 1)
    starts = [4 * (count + 1), *ends[:-1].tolist()]
    return [data[x:y] for x, y in zip(starts, ends.tolist(), strict=True)] if count else []


def _block_words(docs: DataFrame, shares: int) -> DataFrame:
    """``share, block, words``: each block's distinct words, sorted, in one value per share of all words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            dealt: dict[int, list[bytes]] = {}
            for w in sorted(word.encode("utf-8", "surrogatepass") for word in found):
                dealt.setdefault(zlib.crc32(w) % shares, []).append(w)
            for share, words in dealt.items():
                yield pa.RecordBatch.from_pylist([{"share": share, "block": block, "words": _pack(words)}], schema=target)

        target = pa.schema([("share", pa.int32()), ("block", pa.int64()), ("words", pa.binary())])
        block, found = None, set()
        for number, b in _blocks(batches):
            if number != block:
                yield from flush()
                block, found = number, set()
            for text in b.column("text").to_pylist():
                found.update(words_of(text))
        yield from flush()

    return docs.select("text").mapInArrow(rows, "share int, block bigint, words binary")


def _coded_words(words: DataFrame, spec: str) -> DataFrame:
    """``block, words, ids``: the ids of each word in its place; every distinct word is encoded once.

    Equal words are in one share, and a share is in one task.
    """
    kind = _id_type(spec)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.schema([("block", pa.int64()), ("words", pa.binary()), ("ids", pa.binary())])
        encode, known, share = _encoder(spec), {}, None
        for b in batches:
            for row in b.to_pylist():
                if row["share"] != share:
                    share, known = row["share"], {}
                words = _unpack(row["words"])
                new = [w for w in words if w not in known]
                for at in range(0, len(new), ENCODE_WORDS):
                    part = new[at : at + ENCODE_WORDS]
                    for w, ids in zip(part, encode([w.decode("utf-8", "surrogatepass") for w in part]), strict=True):
                        known[w] = np.array(ids, kind).tobytes()
                yield pa.RecordBatch.from_pylist(
                    [{"block": row["block"], "words": row["words"], "ids": _pack([known[w] for w in words])}], schema=target
                )

    dealt = words.repartition("share").sortWithinPartitions("share")
    return dealt.mapInArrow(rows, "block bigint, words binary, ids binary")


def _block_texts(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``block, packed``: the blocks' documents, compressed by a few megabytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            if held:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, held[0].schema) as out:
                    for b in held:
                        out.write_batch(b)
                packed = zstandard.compress(sink.getvalue(), 6)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed], pa.binary())], names=["block", "packed"])

        block, held, chars = None, [], 0
        for number, b in _blocks(batches):
            if number != block or chars >= PACK_CHARS:
                yield from flush()
                block, held, chars = number, [], 0
            held.append(b)
            chars += b.column("text").nbytes
        yield from flush()

    return docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])]).mapInArrow(rows, "block bigint, packed binary")


def _id_type(spec: str) -> type:
    return np.uint16 if len(pieces(spec)) <= 2**16 else np.uint32


def per_document(
    docs: DataFrame, path: str, make: Callable[[np.ndarray, str], tuple], ddl: str, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` and the columns ``ddl`` that ``make`` gives for a text's ids and its decoded text."""
    spec = Path(path).read_text(encoding="utf-8")
    kind = _id_type(spec)
    schema = StructType([*[docs.schema[c] for c in keep], *StructType.fromDDL(ddl).fields])
    target = to_arrow_schema(schema)

    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    coded = _coded_words(_block_words(docs, max(8, chars // SHARE_CHARS)), spec)

    def finish(texts: pa.Table, table: pa.Table) -> pa.Table:
        known = {}
        for words, ids in zip(table.column("words").to_pylist(), table.column("ids").to_pylist(), strict=True):
            known |= zip([w.decode("utf-8", "surrogatepass") for w in _unpack(words)], _unpack(ids), strict=True)
        piece, encode, out = pieces(spec), None, []
        for packed in texts.column("packed").to_pylist():
            with pa.ipc.open_stream(zstandard.decompress(packed)) as stream:
                for b in stream:
                    made = []
                    for text in b.column("text").to_pylist():
                        words = words_of(text)
                        lacking = [w for w in dict.fromkeys(words) if w not in known]
                        if lacking:
                            encode = encode or _encoder(spec)
                            known |= {w: np.array(i, kind).tobytes() for w, i in zip(lacking, encode(lacking), strict=True)}
                        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), kind)
                        decoded = b"".join(map(piece.__getitem__, ids.tolist())).decode("utf-8", "replace")
                        made.append(make(ids, decoded))
                    columns = list(zip(*made, strict=True)) if made else [[] for _ in target]
                    arrays = [b.column(c).cast(target.field(c).type) for c in keep]
                    arrays += [pa.array(c, f.type) for c, f in zip(columns, list(target)[len(keep) :], strict=False)]
                    out.append(pa.RecordBatch.from_arrays(arrays, schema=target))
        return pa.Table.from_batches(out, schema=target)

    texts = _block_texts(docs, keep)
    return texts.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(finish, schema)


def encode_documents(docs: DataFrame, path: str | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` of every row."""
    return per_document(docs, path or default_path(), lambda ids, decoded: (ids.tolist(), decoded), "ids array<int>, decoded string", keep)


def measure_encoding(docs: DataFrame, path: str | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens, ids_sha256, decoded_sha256`` of every row."""

    def digests(ids: np.ndarray, decoded: str) -> tuple:
        return (
            len(ids),
            hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
        )

    return per_document(docs, path or default_path(), digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", keep)


def piece_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``id, piece``: a tokenizer's vocabulary as a table, one row per id."""
    found = pieces(Path(path or default_path()).read_text(encoding="utf-8"))
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(found), dtype=np.int32), "piece": found}), PIECES)


def decode_table(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of a table with ``doc_id, ids``; ids unlike in the vocabulary vanish.

    The table of pieces is broadcast: it has a row per id of the vocabulary, whatever the input.
    """
    table = piece_table(encoded.sparkSession, path)
    rows = encoded.select("doc_id", "ids").withColumn("row", F.monotonically_increasing_id())
    spread = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    named = spread.join(F.broadcast(table), "id", "left")
    listed = named.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("piece", F.lit(b"")).alias("piece")))).alias("list"),
    )
    joined = F.aggregate("list", F.lit(b""), lambda done, x: F.concat(done, x["piece"]))
    return listed.select("doc_id", F.make_valid_utf8(joined.cast("string")).alias("text"))
