"""Packing: concatenate the token ids of all documents and cut them into fixed windows.

First pass: tokenise, write, and total the tokens of each written partition. Prefix sums over the
totals (one row per partition) give every partition its global offset. Second pass: each partition
cuts its part of the stream into windows. Whole windows are finished on the spot; the ends that a
partition shares with its neighbours become boundary records, which are joined by window.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdex.llm.common import stored

WINDOW = 2048
#: Ends each document.
END_ID = 1

#: A text may be cut before a blank unless white space stands on both sides of it.
_UNSAFE = re.compile(r"[\s\x1c-\x1f] (?=[\s\x1c-\x1f]|$)")
_SPECIAL = "<|endoftext|>"
_RARE = re.compile("[^\x00-\u024f]")

_TOKENS = "part long, at long, n long, doc_id long, ids binary"
_WINDOW = (
    "sequence_id long, first long, n long, ids binary, "
    "pieces array<struct<doc_id:long,start:long,length:long,offset:long,doc_tokens:long>>"
)


class Encoder:
    """Ids of texts by a byte-level BPE file, as one little-endian unsigned 32-bit byte string each.

    `ranks_path` names the same vocabulary as ranks, which `tiktoken` reads; Latin letters and signs
    go there, since it takes a third of the time for the same ids. Characters beyond, whose classes
    may differ between the libraries' Unicode versions, never do: no token crosses a blank that has
    no white space on one of its sides, so a text is cut there and only the chunks with such
    characters go to the file's own tokenizer. A text with a blank inside white space, or with the
    special token's name, goes there whole.
    """

    def __init__(self, path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.quick = Tokenizer.from_file(path), None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if not self.quick or _SPECIAL in text:
            return self.whole(text)
        if not _RARE.search(text):
            return self.quick(text)
        if _UNSAFE.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        chunks, out = [first, *[" " + x for x in rest]], []
        for rare, some in groupby(chunks, key=lambda x: bool(_RARE.search(x))):
            out += (self.whole if rare else self.quick)("".join(some))
        return out

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype="<u4").tobytes()


def tokenise(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Token ids of `docs` (doc_id, text): part, at (offset in the part), n, doc_id, ids.

    `part` is the task's partition. Null text is empty, and so only the end id.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = Encoder(tokenizer_path, ranks_path), np.array([end_id], dtype="<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            # few long texts at a time, so that no batch of ids outgrows the worker
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                ids = [encoder.encode(x or "") + end for x in some.column(1).to_pylist()]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                begins = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part)), pa.array(begins), pa.array(n), some.column(0).cast(pa.int64()),
                     pa.array(ids, type=pa.binary())],
                    names=["part", "at", "n", "doc_id", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(code, _TOKENS)


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, ranks_path: str | None = None, window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pack all of `docs` (doc_id, text) into sequences of `window` tokens.

    `tokenizer_path` is a `tokenizers` file and `ranks_path`, if any, its vocabulary as ranks;
    without the first both are the public 50k byte-level files.

    Columns: sequence_id, n_tokens, padded_to, ids (binary: little-endian unsigned 32-bit ids without
    padding), pieces (array of doc_id, start, length, offset, doc_tokens in the order of `offset`).
    Only the last sequence may be shorter than `window`; it is padded to the next power of two, all
    others need no padding.

    Null and empty texts are a piece of one end id. Repeated rows and repeated ids are packed each;
    a null id stays null; a text of any length is cut over as many sequences as it needs; an empty
    table gives no sequences; other columns are ignored. The order of documents is that of the
    first pass's partitions, in them that of the rows.
    """
    if tokenizer_path is None:
        tokenizer_path, ranks_path = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    coded = stored(tokenise(docs, tokenizer_path, ranks_path, end_id), "tokens")
    totals = coded.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the first pass
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, begin, ids, pieces, length = -1, 0, [], [], 0  # of the run now gathered, within one window

        def flush() -> tuple:
            return (number, begin, length, b"".join(ids), pieces)

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["sequence_id", "first", "n", "ids", "pieces"])

        for batch in batches:
            out = []
            for at, n, doc, data in zip(batch["at"], batch["n"], batch["doc_id"], batch["ids"]):
                start, doc = 0, None if pd.isna(doc) else int(doc)
                while start < n:
                    seq, offset = divmod(at + start, window)
                    if number != seq or begin + length != offset:
                        if length:
                            out.append(flush())
                        number, begin, ids, pieces, length = seq, offset, [], [], 0
                    take = min(n - start, window - offset)
                    ids.append(data[4 * start : 4 * (start + take)])
                    pieces.append((doc, start, take, offset, n))
                    length, start = length + take, start + take
                if len(out) >= 512:
                    yield frame(out)
                    out = []
            if out:
                yield frame(out)
        if length:
            yield frame([flush()])

    runs = (
        coded.join(F.broadcast(offsets), "part")
        .select((F.col("base") + F.col("at")).alias("at"), "n", "doc_id", "ids")
        .mapInPandas(cut, _WINDOW)
    )
    written = stored(runs, "windows")
    whole = written.where(F.col("n") == window).select("sequence_id", "n", "ids", "pieces")
    run = F.struct("first", "ids", "pieces")
    boundary = (
        written.where(F.col("n") < window)
        .groupBy("sequence_id")
        # at most `window` tokens in all, so the list is bounded
        .agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(run)).alias("runs"))
        .select(
            "sequence_id", "n",
            F.aggregate("runs", F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r["ids"])).alias("ids"),
            F.flatten("runs.pieces").alias("pieces"),
        )
    )
    up = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("long")
    return whole.unionByName(boundary).select(
        "sequence_id", F.col("n").alias("n_tokens"),
        F.when(F.col("n") == window, F.lit(window)).otherwise(F.least(up, F.lit(window))).cast("long").alias("padded_to"),
        "ids", "pieces",
    )


def pieces_of(packed: DataFrame) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    p = F.col("p")
    own = F.substring(F.col("ids"), p["offset"].cast("int") * 4 + 1, p["length"].cast("int") * 4)
    return packed.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"),
        F.crc32(own).alias("ids_crc32"), p["doc_tokens"].alias("doc_tokens"), "sequence_id", p["offset"].alias("offset"),
    )
