"""Encoding and decoding with a sentence-piece model through a table of distinct chunks.

A blank becomes a marker, and where no piece of the model has a marker behind another
character, no merge can reach over the start of a marker run. So a text is cut into
marked words (a run of markers and what follows up to the next run), and

1. each block of texts (``BLOCK_BYTES`` of them) numbers its distinct chunks and writes its
   texts as numbers, in one bucket of a table, and its chunks by hash shard;
2. all uses of a chunk meet in its shard, which keeps the table of the chunks it has seen and
   segments each distinct one once, however many blocks use it;
3. ids go back to the blocks, whose texts have not moved, and are joined by position.

What is shuffled grows with the distinct chunks of the blocks, not with the words of the texts,
and nothing is broadcast but the model, whose size is that of its file. A task holds one
block, or one text that is longer, and the table of one shard; a table of over
``TABLE_ENTRIES`` chunks is begun anew, so such a shard segments some chunks again.

Defined results: a NULL or empty text has no ids and decodes to ''; blanks are kept,
at the ends too, and a marker in the text decodes to a blank as in the library; a text
without blanks is one chunk; repeated rows and NULL ids give a row each; an empty
table gives no rows; other columns never matter. A model that rewrites blanks or whose
pieces cross markers is refused with a ValueError, as chunks would then not be exact.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.llm.frames import bounded_batches, shuffle_partitions
from comarca.llm.packing import packed, unpacked
from comarca.session import scratch_path

MARK = "▁"
BLOCK_BYTES = 12 << 20
TABLE_ENTRIES = 2_000_000

# What a row holds where it is not the number of a shard.
TEXT, SHARDS_OF = -1, -2

_CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def read_model(path: str) -> bytes:
    """The model's bytes, refused where chunks between markers could not be segmented alone."""
    model = Path(path).read_bytes()
    pieces = processor(model)
    if pieces.normalize("  a  \tb ") != f"{MARK * 3}a{MARK * 2}\tb{MARK}" or pieces.decode(pieces.encode("  a ")) != "  a ":
        raise ValueError("the model does not keep blanks as markers behind one marker in front")
    crossing = [p for i in range(pieces.get_piece_size()) if MARK in (p := pieces.id_to_piece(i)).lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross markers: {crossing[:5]}")
    return model


def chunks_of(text: str) -> list[str]:
    """The marked words of a text, the marker in front of a text that is not empty included."""
    return _CHUNKS.findall(MARK + text.replace(" ", MARK)) if text else []


def segment(pieces, chunks: list[str]) -> list[list[int]]:
    """Ids of each chunk; the library puts the first marker in front itself, but not of an empty text."""
    found = pieces.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
    return [ids or [pieces.piece_to_id(MARK)] for ids in found]


def surfaces(pieces) -> list[bytes]:
    """What each piece decodes to behind the first one."""
    def of(i: int) -> bytes:
        if pieces.is_byte(i):
            return bytes([int(pieces.id_to_piece(i)[3:-1], 16)])
        if pieces.is_control(i):
            return b""
        return pieces.id_to_piece(i).replace(MARK, " ").encode()

    return [of(i) for i in range(pieces.get_piece_size())]


class Block:
    """Texts as numbers of their distinct chunks."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.ids: list[pa.Array] = []
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        text = text or ""
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, chunks_of(text)), dtype=np.uint32))
        self.size += len(text)

    def rows(self, block: int, shards: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per text, one with the shard of every chunk and, for each shard, one of its chunks in the order of their numbers."""
        chunks = [c.encode() for c in self.numbers]
        shard = np.fromiter((zlib.crc32(c) % shards for c in chunks), dtype=np.int64, count=len(chunks))
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        ids = pa.concat_arrays(self.ids)
        yield _batch(schema, len(ids), block=block, doc_id=ids, codes=[packed(c) for c in self.codes], shard=TEXT)
        used = np.unique(shard).tolist()
        parts = [[chunks[i] for i in order[cuts[s] : cuts[s + 1]]] for s in used]
        yield _batch(
            schema, len(used) + 1, block=block, shard=[SHARDS_OF, *used], codes=[packed(shard), *[None] * len(used)],
            n=[0, *map(len, parts)], chunks=[None, *(packed(np.array([*map(len, x)]), b"".join(x)) for x in parts)],
        )


def _batch(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    """A batch of lists, arrays and values that all rows share; columns that aren't given are NULL."""
    def of(field):
        value = columns.get(field.name)
        if isinstance(value, pa.Array):
            return value.cast(field.type)
        return pa.array(value if isinstance(value, list) else [value] * size, field.type)

    return pa.RecordBatch.from_arrays([of(f) for f in schema], schema=schema)


def numbered_blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of texts (block, doc_id, codes) and of chunks (block, shard, n, chunks), in buckets by block.

    A task writes few blocks, so the table has about as many files as blocks.
    """
    spark = docs.sparkSession
    shards = shuffle_partitions(spark)
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    kind = rows.schema["doc_id"].dataType

    def numbered(batches):
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            ids, first = batch.column("doc_id"), 0
            schema = pa.schema([
                ("block", pa.int64()), ("doc_id", ids.type), ("codes", pa.binary()), ("shard", pa.int32()),
                ("n", pa.int64()), ("chunks", pa.binary()),
            ])
            for i, text in enumerate(batch.column("text")):
                block.add(text.as_py())
                if block.size >= BLOCK_BYTES:
                    block.ids.append(ids.slice(first, i + 1 - first))
                    yield from block.rows(number, shards, schema)
                    number, block, first = number + 1, Block(), i + 1
            if first < len(ids):
                block.ids.append(ids.slice(first))
        if block.ids:
            yield from block.rows(number, shards, schema)

    written = rows.mapInArrow(numbered, T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_id", kind), T.StructField("codes", T.BinaryType()),
        T.StructField("shard", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("chunks", T.BinaryType()),
    ]))
    name, path = f"pieces_{uuid.uuid4().hex}", scratch_path(spark, "piece-blocks")
    written.write.bucketBy(shards, "block").format("parquet").option("path", path).saveAsTable(name)
    found = spark.table(name)
    # The frame keeps files and buckets; only the name goes.
    found.schema  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return found


def segmented(uses: DataFrame, model: Broadcast) -> DataFrame:
    """(of, at, n, ids): the chunks of each block and shard segmented, in the order of their numbers."""

    def per_shard(batches):
        pieces, table = processor(model.value), {}
        kind = id_type(pieces)
        for batch in batches:
            held = []
            for block, shard, n, chunks in zip(batch["block"], batch["shard"], batch["n"], batch["chunks"]):
                lengths, text = unpacked(chunks, n)
                ends = np.cumsum(lengths).tolist()
                keys = [text[a:b] for a, b in zip([0, *ends], ends)]
                if new := [k for k in keys if k not in table]:
                    if len(table) > TABLE_ENTRIES:
                        table, new = {}, keys
                    table.update(zip(new, segment(pieces, [k.decode() for k in new])))
                ids = [table[k] for k in keys]
                flat = np.array([i for x in ids for i in x], dtype=kind)
                held.append((block, shard, n, packed(np.array([*map(len, ids)]), flat.tobytes())))
            yield pd.DataFrame(held, columns=["of", "at", "n", "ids"])

    dealt = uses.repartition(shuffle_partitions(uses.sparkSession), "shard")
    return dealt.mapInPandas(per_shard, "of long, at int, n long, ids binary")


def id_type(pieces) -> str:
    return "<u2" if pieces.get_piece_size() <= 1 << 16 else "<u4"


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and decoded (string) of every row, as the library gives them for whole texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(read_model(model_path))
    blocks = numbered_blocks(docs, doc_id, text)
    texts = blocks.where("shard < 0").select("block", "doc_id", "codes", "shard")
    found = segmented(blocks.where("shard >= 0").select("block", "shard", "n", "chunks"), model)

    def placed(texts: pa.Table, found: pa.Table) -> pa.Table:
        pieces = processor(model.value)
        plain, kind = surfaces(pieces), id_type(pieces)
        whole = pc.equal(texts["shard"], TEXT)
        shards = unpacked(texts.filter(pc.invert(whole))["codes"][0].as_py())[0]
        texts = texts.filter(whole)
        # The chunks of a shard, shard after shard: the places that their ids go to.
        order = np.argsort(shards, kind="stable")
        lengths, starts, surface = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64), [b""] * len(order)
        flat, done, before = [np.zeros(0, dtype=kind)], 0, 0
        found = found.sort_by("at")
        for n, ids in zip(found["n"].to_pylist(), found["ids"].to_pylist()):
            at = order[done : done + n]
            each, rest = unpacked(ids, n)
            each = each.astype(np.int64)
            flat.append(np.frombuffer(rest, dtype=kind))
            ends = np.cumsum(each)
            lengths[at], starts[at] = each, before + ends - each
            seen = [plain[i] for i in flat[-1].tolist()]
            for i, a, b in zip(at.tolist(), (ends - each).tolist(), ends.tolist()):
                surface[i] = b"".join(seen[a:b])
            done, before = done + n, before + len(seen)
        flat = np.concatenate(flat)
        all_ids, ends_of_text, decoded = [np.zeros(0, dtype=np.int32)], [0], []
        for codes in texts["codes"].to_pylist():
            at = unpacked(codes)[0]
            each = lengths[at]
            ends = np.cumsum(each)
            all_ids.append(flat[np.repeat(starts[at] - (ends - each), each) + np.arange(each.sum())].astype(np.int32))
            ends_of_text.append(ends_of_text[-1] + len(all_ids[-1]))
            # The first marker is the library's own.
            decoded.append(b"".join(map(surface.__getitem__, at.tolist()))[1:].decode("utf-8", "replace"))
        ids = pa.ListArray.from_arrays(pa.array(ends_of_text, pa.int32()), pa.array(np.concatenate(all_ids)))
        return pa.table({"doc_id": texts["doc_id"], "ids": ids, "decoded": pa.array(decoded, pa.string())})

    kind = T.StructType([
        blocks.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
    ])
    return texts.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(placed, kind)
