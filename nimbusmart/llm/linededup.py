"""Line dedup: keep bitmaps per document.

The key of a line is the line stripped of ``[\\x20\\x09-\\x0D]`` and with A-Z
lowered. Keys of at least ``MIN_CHARS`` code points that are found in at least
``MIN_DOCS`` documents stay only in the largest doc_id that holds them.

Every line with a long enough key becomes a fingerprint with its document and
position. Fingerprints are range-partitioned with a secondary sort by document
(descending) and position; each partition streams its runs, keeps the first
document's lines and gives out the others (see ``runs``). Up to there only
fingerprints and positions are shuffled. The result is one compressed bitmap a
document: bit i says whether line i stays. It meets its document in a join on the
id, which moves the texts once.

Defined cases: a null or empty text is one empty line. A document without an id
keeps its lines and counts for nobody. Rows with the same id and text are one
document and get the same result; rows with the same id and different texts
count as one document but are cut separately. An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.llm.runs import repeats
from nimbusmart.llm.tables import columns_of, fresh, text_key

MIN_CHARS, MIN_DOCS = 40, 5
_STRIP = b" \t\n\x0b\f\r"
# Places: 31 bits of the text, 32 of the line number.
_SHIFT = 32


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _fingerprints(least: int):
    schema = pa.schema([(c, pa.int64()) for c in ("high", "low", "doc", "pos")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                digests, docs, places = [], [], []
                for d, k, t in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                    for i, line in enumerate(t.encode().split(b"\n")):
                        if len(line) >= least and _long_enough(key := line_key(line), least):
                            digests.append(xxhash.xxh3_128_digest(key))
                            docs.append(d)
                            places.append(k << _SHIFT | i)
                if digests:
                    halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                    arrays = [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(docs, pa.int64()), pa.array(places, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, key, lines): positions of the lines that go, for documents that lose any."""
    source = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), "text"
    )
    lines = source.mapInArrow(_fingerprints(min_chars), "high long, low long, doc long, pos long")
    # Largest document first: ~doc turns the order round without overflow.
    found = repeats(lines.withColumn("doc", F.bitwise_not("doc")), min_docs, "doc", "doc", "line-runs")
    return (
        found.select(
            F.bitwise_not("doc").alias("doc_id"),
            F.shiftright("pos", _SHIFT).alias("key"),
            F.col("pos").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int").alias("line"),
        )
        .groupBy("doc_id", "key")
        .agg(F.sort_array(F.collect_set("line")).alias("lines"))
    )


def _bitmap(n: int, dropped) -> bytes:
    keep = np.ones(n, dtype=np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


@F.pandas_udf(T.BinaryType())
def _bitmaps(n: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else _bitmap(k, x) for k, x in zip(n, lines, strict=True)], dtype=object)


def apply_bitmap(text: str, bitmap: bytes | None) -> str:
    """The lines of ``text`` that ``bitmap`` keeps; all of them without one."""
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=len(lines))
    return "\n".join([line for line, k in zip(lines, keep.tolist(), strict=True) if k])


def _with_lines(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, Column]:
    """``docs`` with a column of the positions that go (null: none), and that column."""
    doc, key, lines = fresh(docs, "__id", "__key", "__lines")
    keyed = docs.withColumns({key: text_key(F.col("text")), doc: F.col("doc_id").cast("long")})
    lost = dropped_lines(docs, min_chars, min_docs).toDF(doc, key, lines)
    return keyed.join(lost, [doc, key], "left"), F.col(lines)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id and text) with n_lines, n_dropped and ``keep``: the
    compressed bitmap of the lines that stay, null if all do."""
    joined, lines = _with_lines(docs, min_chars, min_docs)
    text = F.coalesce("text", F.lit(""))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_dropped = F.when(lines.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    rest = [c for c, name in zip(columns_of(docs), docs.columns, strict=True) if name not in ("n_lines", "n_dropped", "keep")]
    return joined.select(*rest, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"), _bitmaps(n_lines, lines).alias("keep"))


@F.pandas_udf(T.StringType())
def _apply(text: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else apply_bitmap(t, k) for t, k in zip(text, keep, strict=True)], dtype=object)


def with_kept_text(bitmaps: DataFrame) -> DataFrame:
    """The documents of ``keep_bitmaps`` with the bitmap applied to the text;
    texts that lose nothing stay in the JVM."""
    cut = _apply(F.when(F.col("keep").isNotNull(), F.col("text")), F.col("keep"))
    return bitmaps.withColumn("text", F.when(F.col("keep").isNull(), F.col("text")).otherwise(cut))


@F.pandas_udf(T.StringType())
def _cut(text: pd.Series, lines: pd.Series) -> pd.Series:
    """Bitmap and text in one step, so a task needs one Python worker for both."""
    cut = [None if t is None else apply_bitmap(t, _bitmap(t.count("\n") + 1, x)) for t, x in zip(text, lines, strict=True)]
    return pd.Series(cut, dtype=object)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without the repeated lines; the columns stay as they are. The bitmap
    is made and applied in one step here; texts that lose nothing stay in the JVM."""
    joined, lines = _with_lines(docs, min_chars, min_docs)
    has = lines.isNotNull()
    text = F.when(has, _cut(F.when(has, F.col("text")), lines)).otherwise(F.col("text")).alias("text")
    return joined.select(*[text if name == "text" else c for c, name in zip(columns_of(docs), docs.columns, strict=True)])
