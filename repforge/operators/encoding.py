"""Residue tokenisation over whole Arrow batches (``mapInArrow``).

Same output as ``repforge.functions.tokens.tokenize`` (the expression form,
kept as the definition and for small inputs), but vectorised: a batch of
ASCII text is one byte buffer, mapped through a 256-entry lookup table and
scattered into an (n x max_length) matrix. Non-ASCII batches fall back to
one code-point array per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from repforge.functions.tokens import BOS, EOS, MAX_LENGTH, PAD, UNK, VOCAB
from repforge.session import ship_package

TOKEN_COLUMNS = ["input_ids", "attention_mask", "special_tokens_mask"]

_LUT = np.full(256, UNK, dtype=np.int32)
for _tok, _idx in VOCAB.items():
    if len(_tok) == 1:
        _LUT[ord(_tok)] = _idx


def _codes(texts: pa.Array):
    """Per-row character codes as one flat int array plus row lengths."""
    texts = texts.fill_null("") if texts.null_count else texts
    bufs = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(bufs[1], dtype=width)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and len(texts)
            else np.zeros(0, np.uint8))
    data = data[offsets[0]:offsets[-1]] if len(offsets) else data[:0]
    if not data.size or data.max() < 128:
        return data.astype(np.int64), np.diff(offsets)
    rows = [np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
            for s in texts.to_pylist()]
    lens = np.array([r.size for r in rows], dtype=np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)), lens


def token_matrix(codes: np.ndarray, lengths: np.ndarray, max_length: int = MAX_LENGTH):
    """(input_ids, attention_mask, special_tokens_mask) as (n x max_length)."""
    n = lengths.size
    body = np.minimum(lengths, max_length - 2)
    ids = np.full((n, max_length), PAD, dtype=np.int32)
    ids[:, 0] = BOS
    row = np.repeat(np.arange(n), body)
    starts = np.repeat(np.cumsum(lengths) - lengths, body)
    j = np.arange(row.size, dtype=np.int64) - np.repeat(np.cumsum(body) - body, body)
    src = codes[starts + j]
    ids[row, 1 + j] = np.where(src < 256, _LUT[np.minimum(src, 255)], UNK)
    ids[np.arange(n), body + 1] = EOS
    col = np.arange(max_length)[None, :]
    attention = (col < (body + 2)[:, None]).astype(np.int32)
    special = ((col == 0) | (col >= (body + 1)[:, None])).astype(np.int32)
    return ids, attention, special


def tokenize_batches(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                     max_length: int = MAX_LENGTH) -> DataFrame:
    """``keep`` columns plus the three token arrays; no shuffle."""
    keep = list(keep or [])
    arr = ArrayType(IntegerType(), True)
    schema = StructType([df.schema[c] for c in keep] + [StructField(c, arr) for c in TOKEN_COLUMNS])
    src = df.select(*keep, text_col)

    def run(batches):
        for b in batches:
            codes, lens = _codes(b.column(len(keep)))
            mats = token_matrix(codes, lens, max_length)
            n = len(lens)
            offsets = pa.array((np.arange(n + 1) * max_length).astype(np.int32))
            cols = [b.column(i) for i in range(len(keep))]
            cols += [pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1), pa.int32())) for m in mats]
            yield pa.RecordBatch.from_arrays(cols, names=keep + TOKEN_COLUMNS)

    ship_package(src.sparkSession)
    return src.mapInArrow(run, schema)
