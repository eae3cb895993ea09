"""BPE encoding and decoding through one table of distinct words.

Documents are dealt to blocks of a few megabytes, packed as they leave their task. A block gives its distinct words, sorted, to buckets
by hash; a bucket unites what all blocks sent, encodes each distinct word once, and answers every
block with the ids of its words in the order sent. The block then puts the ids back by position. Words
and answers travel packed, since the word lists are what shuffles besides the texts themselves.
Decoding joins each id to its piece.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import flattened, give_back, nested, slices, text_or_empty, texts, words
from .encoding import encode_words, gathered, word_tokenizer

BLOCK_BYTES = 8 << 20
#: Words of a block whose ids are gathered and decoded at once.
WORDS_TOGETHER = 1 << 17


def _in_buckets(distinct: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by bucket and code point, and the buckets in that order."""
    names = distinct.to_numpy(zero_copy_only=False).astype(object)
    at = (pd.util.hash_array(names, categorize=False) % np.uint64(buckets)).astype(np.int64)
    order = pc.sort_indices(distinct).to_numpy()
    order = order[np.argsort(at[order], kind="stable")]
    return order, at[order]


#: Bytes of text whose documents are packed together, block by block.
PACKED_BYTES = 64 << 20


def _packed(batches):
    """The documents of each block in a slice, as one compressed Arrow message."""
    import zstandard

    for batch in batches:
        for part in slices(batch, "text", PACKED_BYTES):
            pack = zstandard.ZstdCompressor(level=3).compress
            block = part.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1))
            rows = part.select(["id", "print", "text"]).take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[order][edges], pa.int32()),
                 pa.array([pack(memoryview(_message(rows.slice(a, b - a)).serialize()))
                           for a, b in zip(edges, [*edges[1:], len(order)])], pa.binary())], ["block", "docs"])
            give_back()


def _message(rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.concat_batches([rows])  # a slice of its own, so that nothing around it is written


def _unpacked(table: pa.Table, kind: pa.DataType) -> pa.RecordBatch:
    import zstandard

    schema = pa.schema([("id", kind), ("print", pa.int64()), ("text", pa.string())])
    unpack = zstandard.ZstdDecompressor().decompress
    found = [pa.ipc.read_record_batch(pa.py_buffer(unpack(d)), schema) for d in table.column("docs").to_pylist()]
    return pa.concat_batches(found) if found else pa.RecordBatch.from_pylist([], schema)


def _block_words(buckets: int, kind: pa.DataType):
    def run(key, table):
        import zstandard

        give_back()
        flat, _ = words(texts(_unpacked(table, kind), "text"))
        distinct = flat.unique()
        order, at = _in_buckets(distinct, buckets) if len(distinct) else (np.empty(0, int),) * 2
        edges = np.flatnonzero(np.diff(at, prepend=-1))
        names = distinct.take(pa.array(order)).to_pylist()
        pack = zstandard.ZstdCompressor(level=3).compress
        return pa.table({
            "bucket": pa.array(at[edges], pa.int32()),
            "block": pa.array([key[0].as_py()] * len(edges), pa.int32()),
            "words": pa.array([pack("\n".join(names[a:b]).encode("utf-8", "surrogatepass"))
                               for a, b in zip(edges, [*edges[1:], len(names)])], pa.binary())})
    return run


def _bucket_ids(tokenizer_path: str | None):
    held: list = []  # the tokenizer, loaded once in a task

    def run(key, table):
        import zstandard

        give_back()
        if not held:
            held.append(word_tokenizer(tokenizer_path))
        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        lists = [unpack(w).decode("utf-8", "surrogatepass").split("\n") for w in table.column("words").to_pylist()]
        coded = pa.array([w for x in lists for w in x], pa.large_string()).dictionary_encode()
        ids, sizes = encode_words(held[0], coded.dictionary.to_pylist())
        starts, which = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        ends, answers = np.cumsum([len(x) for x in lists]), []
        wide = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
        for a, b in zip([0, *ends[:-1]], ends):
            own = which[a:b]
            head = np.array([b - a, int(wide[2])], "<u4").tobytes()
            answers.append(pack(head + sizes[own].astype("<u4").tobytes()
                                + gathered(ids, starts, sizes, own).astype(wide).tobytes()))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "ids": pa.array(answers, pa.binary())})
    return run


def _block_ids(tokenizer_path: str | None, buckets: int, kind: pa.DataType, with_ids: bool, with_digests: bool):
    held: list = []  # the pieces, read once in a task

    def run(left, right):
        import zstandard

        give_back()
        if with_digests and not held:
            held.append(pieces(tokenizer_path))
        unpack = zstandard.ZstdDecompressor().decompress
        batch = _unpacked(left, kind)
        flat, at = words(texts(batch))
        batch, coded = batch.select(["id", "print"]), flat.dictionary_encode()
        distinct, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        del flat, coded
        order, _ = _in_buckets(distinct, buckets) if len(distinct) else (np.empty(0, int),) * 2
        sizes, ids = [], []
        right = right.sort_by("bucket")
        for answer in right.column("ids").to_pylist():
            answer = unpack(answer)
            n, width = np.frombuffer(answer, "<u4", 2)
            sizes.append(np.frombuffer(answer, "<u4", int(n), 8))
            ids.append(np.frombuffer(answer, f"<u{width}", -1, 8 + 4 * int(n)))
        sizes = np.concatenate(sizes or [np.empty(0, np.int64)]).astype(np.int64)
        ids = np.concatenate(ids or [np.empty(0, np.uint16)])
        if len(sizes) != len(order):
            raise RuntimeError("a block's answers do not match its words")
        nth, starts = np.empty(len(order), np.int32), np.cumsum(sizes) - sizes
        nth[order] = np.arange(len(order))
        del distinct, order, right
        give_back()
        found, first = [], 0
        while first < len(batch):  # the ids of some documents at a time
            last = max(first + 1, int(np.searchsorted(at, at[first] + WORDS_TOGETHER, "right")) - 1)
            found.append(rows(batch.slice(first, last - first), nth[place[at[first]:at[last]]],
                              at[first:last + 1] - at[first], ids, starts, sizes))
            first = last
        return pa.concat_tables(found or [rows(batch, nth[:0], at, ids, starts, sizes)])

    def rows(some, which, at, ids, starts, sizes):
        own = gathered(ids, starts, sizes, which)
        ends = np.concatenate([[0], np.cumsum(sizes[which])])[at]
        out = {"id": some.column("id"), "print": some.column("print"),
               "n_tokens": pa.array(np.diff(ends), pa.int64())}
        if with_digests:
            raw = memoryview(own.astype("<u4").tobytes())
            out["ids_sha256"] = pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest()
                                          for a, b in zip(ends[:-1], ends[1:])], pa.string())
            text = decoded_texts(own, ends, held[0])
            out["decoded_sha256"] = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in text], pa.string())
        if with_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own.astype(np.int32)))
        return pa.table(out)
    return run


def pieces(tokenizer_path: str | None) -> pa.Array:
    """The vocabulary: the piece of each id, null where an id has none."""
    vocab = word_tokenizer(tokenizer_path).get_vocab(with_added_tokens=True)
    found: list[str | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        found[i] = piece
    return pa.array(found, pa.string())


def decoded_texts(ids: np.ndarray, ends: np.ndarray, table: pa.Array) -> pa.Array:
    """Texts of id lists: the pieces joined by blanks, as a tokenizer without a decoder does."""
    found = table.take(pa.array(ids.astype(np.int64)))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found), " ")


def _encoded(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str | None,
             block_bytes: int, with_ids: bool, with_digests: bool) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, held[0] // block_bytes)
    rows = rows.withColumn("print", F.xxhash64("text")).withColumn(
        "block", F.pmod(F.xxhash64("id", "print"), F.lit(blocks)).cast("int"))
    kind, arrow = rows.schema["id"].dataType, to_arrow_type(rows.schema["id"].dataType)
    rows = rows.mapInArrow(_packed, "block int, docs binary")
    answers = (rows.groupBy("block").applyInArrow(_block_words(blocks, arrow), "bucket int, block int, words binary")
               .groupBy("bucket").applyInArrow(_bucket_ids(tokenizer_path), "block int, bucket int, ids binary"))
    more = ", ids_sha256 string, decoded_sha256 string" * with_digests + ", ids array<int>" * with_ids
    return (rows.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_block_ids(tokenizer_path, blocks, arrow, with_ids, with_digests),
                          f"id {kind.simpleString()}, print bigint, n_tokens bigint{more}"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           tokenizer_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every input row with ``n_tokens`` and ``ids``; null texts are empty and have no ids."""
    found = _encoded(docs, id_col, text_col, tokenizer_path, block_bytes, True, False)
    once = found.select(F.col("id").alias("id2"), F.col("print").alias("print2"), "n_tokens", "ids").dropDuplicates(
        ["id2", "print2"])
    rows = nested(docs, id=F.col(f"`{id_col}`"), print=F.xxhash64(text_or_empty(f"`{text_col}`")))
    both = rows.join(once.hint("merge"), F.col("id").eqNullSafe(F.col("id2")) & (F.col("print") == F.col("print2")))
    return flattened(both, "n_tokens", "ids")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
               block_bytes: int = BLOCK_BYTES, with_ids: bool = True) -> DataFrame:
    """The id of every row, its number of tokens, SHA-256 of its ids and of the text they decode to,
    and the ids themselves."""
    found = _encoded(docs, id_col, text_col, tokenizer_path, block_bytes, with_ids, True)
    return found.select(F.col("id").alias(id_col), "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256")


def decode(encoded: DataFrame, ids_col: str = "ids", tokenizer_path: str | None = None) -> DataFrame:
    """Every row with ``decoded``, the text of its ids; a null list gives null, an empty one an empty text.

    Ids without a piece (beyond the vocabulary, negative, null) are left out, as the library does. A
    tokenizer file with a decoder of its own is an error: pieces are joined by blanks here.
    """
    if word_tokenizer(tokenizer_path).decoder is not None:
        raise ValueError("the tokenizer has a decoder; only pieces joined by blanks are decoded")

    def run(batches):
        table = pieces(tokenizer_path)
        known = table.is_valid().to_numpy(zero_copy_only=False)
        for batch in batches:
            lists = batch.column("ids")
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            inside = (flat >= 0) & (flat < len(known))
            inside[inside] = known[flat[inside]]
            ends = np.concatenate([[0], np.cumsum(inside)])[np.concatenate([[0], np.cumsum(size)]).astype(np.int64)]
            text = decoded_texts(flat[inside], ends, table)
            text = pc.if_else(pc.is_null(lists), pa.scalar(None, pa.string()), text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), text], ["row", "decoded"])

    rows = nested(encoded, ids=F.col(f"`{ids_col}`").cast("array<bigint>"))
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())])
    return flattened(rows.mapInArrow(run, schema), "decoded")
