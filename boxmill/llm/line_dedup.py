"""Lines that many documents share, taken out of all but one of them, by a perfect hash.

1. Each document gives the distinct 128-bit hashes of its long lines; Spark counts the
   documents of each and keeps the greatest id.
2. Hashes of enough documents are dealt to shards of bounded size. A task builds a
   shard: a minimal perfect hash and, in its order, arrays of fingerprints (64 bits),
   counts and greatest ids, about 20 bytes a line. Hashes of fewer documents are left
   out: no line of them is dropped, and a probe for them meets another fingerprint.
3. Documents probe the arrays. Where all shards together have at most `index_bytes`, they
   are sent to all tasks. Otherwise only the hashes that many lines have are (HOT_SHARE
   at most), and the others are probed in a task for each shard; what it finds goes back
   to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, hot_keys, join_lookup, materialise
from .perfect_hash import Index, Shard

SPACES = b"\t\n\x0b\x0c\r "
UPPER = bytes(range(65, 91))
CASE = bytes.maketrans(UPPER, UPPER.lower())
#: Bytes of UTF-8 that begin no code point.
LATER = bytes(range(0x80, 0xC0))
#: Hashes of a shard, and lines that are probed in one task, about.
SHARD_KEYS, SHARD_PROBES = 100_000, 2_000_000
#: Lines that are looked up at once.
PROBED = 20_000
#: Rows without an id count as one document of this id.
NO_ID = -(1 << 63)
LOW = (1 << 64) - 1


def line_keys(lines: list[bytes], least: int) -> list[int | None]:
    """The hash of each line's key, None for keys of under `least` code points."""
    out: list[int | None] = []
    for line in lines:
        key = line.strip(SPACES) if len(line) >= least else b""
        if len(key) >= least and (key.isascii() or len(key.translate(None, LATER)) >= least):
            out.append(xxhash.xxh3_128_intdigest(key.translate(CASE)))
        else:
            out.append(None)
    return out


def _halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([k >> 64 for k in keys], np.uint64), np.array([k & LOW for k in keys], np.uint64)


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _keys_of(docs: DataFrame, least: int) -> DataFrame:
    """a, b, doc: the distinct hashes of each row of docs (doc, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int] = []
            ids: list[int] = []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                own = set(line_keys(_lines(text.as_py()), least)) - {None}
                keys += own
                ids += [doc] * len(own)
            a, b = _halves(keys)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(ids, pa.int64())], names=["a", "b", "doc"])

    return docs.mapInArrow(read, "a long, b long, doc long")


def _shards(counted: DataFrame, count: int) -> DataFrame:
    """shard, content of all hashes (a, b, n, last), `count` shards at most; a written table."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        as_bits = lambda c: rows[c].to_numpy().view(np.uint64)
        content = Shard.of(as_bits("a"), as_bits("b"), rows["n"].to_numpy(), rows["last"].to_numpy()).to_bytes()
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "content": [content]})

    return materialise(counted.select(_shard_of(count), "a", "b", "n", "last").groupBy("shard").applyInPandas(build, "shard long, content binary"))


def _shard_of(count: int) -> Column:
    return F.pmod("a", F.lit(count)).alias("shard")


def _index(shards: DataFrame, count: int) -> Index:
    """All shards of a table whose size has been checked."""
    return Index({r["shard"]: bytes(r["content"]) for r in shards.collect()}, count)


def _cleaned(docs: DataFrame, index: Index, least: int, min_docs: int) -> DataFrame:
    """doc_id, n_lines, n_dropped, text of docs (doc_id, doc, text, and gone: more hashes to drop, as array of (a, b), or null)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    has_gone = "gone" in docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column("gone") if has_gone else None
            ids, docs_of = batch.column("doc_id"), batch.column("doc").to_numpy()
            waiting: list[tuple[int, list[bytes], list[int | None]]] = []
            keyed = 0
            for i, text in enumerate(batch.column("text")):
                lines = _lines(text.as_py())
                keys = line_keys(lines, least)
                waiting.append((i, lines, keys))
                keyed += len(keys)
                if keyed >= PROBED:
                    yield flush(waiting, ids, docs_of, gone)
                    waiting, keyed = [], 0
            yield flush(waiting, ids, docs_of, gone)

    def flush(waiting: list[tuple[int, list[bytes], list[int | None]]], ids: pa.Array, docs_of: np.ndarray, gone: pa.Array | None) -> pa.RecordBatch:
        """The rows of the waiting documents, all of whose lines are looked up together."""
        flat = [k for _, _, keys in waiting for k in keys if k is not None]
        owner = np.repeat([docs_of[i] for i, _, _ in waiting], [sum(k is not None for k in keys) for _, _, keys in waiting]) if flat else np.zeros(0, np.int64)
        counts, last = shared.value.find(*_halves(flat))
        drop = iter(((counts >= min_docs) & (last != owner)).tolist())
        n_lines, n_dropped, texts = [], [], []
        for i, lines, keys in waiting:
            listed = {((k["a"] & LOW) << 64) | (k["b"] & LOW) for k in gone[i].as_py()} if gone is not None and gone[i].is_valid else ()
            kept = [x for x, k in zip(lines, keys, strict=True) if k is None or not (next(drop) or k in listed)]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
        rows = ids.take(pa.array([i for i, _, _ in waiting], pa.int64()))
        return pa.RecordBatch.from_arrays([rows, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return docs.mapInArrow(clean, "doc_id long, n_lines long, n_dropped long, text string")


def _found_in_shards(docs: DataFrame, shards: DataFrame, hot: DataFrame, count: int, least: int, min_docs: int) -> DataFrame:
    """doc, gone: the hashes (a, b) that a document loses, of those in shards but not hot."""

    def probe(lines: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(lines):
            return pd.DataFrame({"doc": [], "a": [], "b": []}, dtype="int64")
        a, b = (lines[c].to_numpy().view(np.uint64) for c in ("a", "b"))
        counts, last = Shard.from_bytes(bytes(shard["content"].iloc[0])).find(a, b)
        return lines.loc[(counts >= min_docs) & (last != lines["doc"].to_numpy()), ["doc", "a", "b"]]

    rare = _keys_of(docs, least).join(F.broadcast(hot.select("a", "b")), ["a", "b"], "left_anti")
    given = rare.select(_shard_of(count), "a", "b", "doc").groupBy("shard")
    found = given.cogroup(shards.groupBy("shard")).applyInPandas(probe, "doc long, a long, b long")
    return found.distinct().groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("gone"))


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, index_bytes: int = 64_000_000) -> DataFrame:
    """doc_id, n_lines, n_dropped, text of every row of docs, without the lines that other documents share.

    Lines end at \\n. A line's key is the line without white space at both ends and with
    A-Z lower-cased. Keys of at least min_chars code points in at least min_docs documents
    lose all their lines except in the document of the greatest id. Keys are told apart by
    128-bit hashes.

    Null or empty text is one empty line and stays empty. Ids are whole numbers; rows of
    one id are one document and keep or lose the same keys, rows without an id are one
    document before all others. Repeated rows are each returned. Other columns are
    ignored; an empty table gives no rows. Beyond index_bytes a document's dropped hashes
    are gathered by its id, so ids should be all but unique.
    """
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    keys = _keys_of(rows.select("doc", "text"), min_chars).distinct()
    counted = materialise(keys.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc").alias("last")).filter(F.col("n") >= min_docs))
    keys_there, probes = counted.agg(F.count("*"), F.sum("n")).first()
    count = max(1, -(-keys_there // SHARD_KEYS), -(-(probes or 0) // SHARD_PROBES))
    shards = _shards(counted, count)
    size = shards.agg(F.sum(F.length("content"))).first()[0] or 0
    if size <= index_bytes:
        return _cleaned(rows, _index(shards, count), min_chars, min_docs)
    # Few hashes are hot, so one shard holds them.
    hot = materialise(counted.filter(F.col("n") * HOT_SHARE > probes))
    found = materialise(_found_in_shards(rows.select("doc", "text"), shards, hot, count, min_chars, min_docs))
    both = join_lookup(rows, found, "doc", hot_keys(rows, "doc"), how="left").select("doc_id", "doc", "text", "gone")
    return _cleaned(both, _index(_shards(hot, 1), 1), min_chars, min_docs)
