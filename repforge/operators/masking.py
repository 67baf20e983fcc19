"""Masked-language-model masking over token arrays, one Arrow batch at a
time (``mapInArrow``): array work in Spark's higher-order functions is
interpreted per element, while numpy does a whole batch in a few vector
operations. The mask is a pure function of (seed, epoch, row id, position), so
retries and re-reads give the same result.

Rule (BERT): a non-special position is selected with probability 0.15;
selected positions become ``<mask>`` (80 %), a random token (10 %) or stay
(10 %); labels keep the original id where selected and -100 elsewhere.

Randomness is a counter of two words, so any position of any row has its own
draw in every epoch, whatever the order of the work:

    low  = (id << 8) | (position & 255)
    high = (epoch << 32) | (id >> 56 << 24) | (position >> 8)
    h    = fmix64(low xor (seed * 0x9E3779B97F4A7C15) xor fmix64(high))

(fmix64: the 64-bit MurmurHash3 finaliser, arithmetic mod 2^64, 0 for 0);
three 21-bit fields of ``h`` give the three uniforms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from repforge.functions.tokens import MASK, MASK_SHARE, MLM_PROBABILITY, RANDOM_SHARE, VOCAB_SIZE
from repforge.session import ship_package

# The mixing constants (golden ratio, MurmurHash3 fmix64).
GOLDEN = 0x9E3779B97F4A7C15
FMIX_1 = 0xFF51AFD7ED558CCD
FMIX_2 = 0xC4CEB9FE1A85EC53
FIELD_BITS = 21


def fmix64(h: np.ndarray) -> np.ndarray:
    u = np.uint64
    h = h ^ (h >> u(33))
    h = h * u(FMIX_1)
    h = h ^ (h >> u(33))
    h = h * u(FMIX_2)
    return h ^ (h >> u(33))


def mix(row_ids: np.ndarray, positions: np.ndarray, seed: int, epoch: int = 0) -> np.ndarray:
    """``h`` of (row, position) in an epoch (below 2^32), vectorised,
    arithmetic mod 2^64. Positions below 2^32."""
    u = np.uint64
    ids, places = row_ids.astype(u), positions.astype(u)
    with np.errstate(over="ignore"):
        low = (ids << u(8)) | (places & u(255))
        high = u(epoch << 32) | ((ids >> u(56)) << u(24)) | (places >> u(8))
        return fmix64(low ^ u((seed * GOLDEN) % 2 ** 64) ^ fmix64(high))


def uniforms(h: np.ndarray):
    u = np.uint64
    m = u((1 << FIELD_BITS) - 1)
    scale = float(1 << FIELD_BITS)
    return (((h >> u(43)) & m) / scale, ((h >> u(22)) & m) / scale, ((h >> u(1)) & m) / scale)


def mask_arrays(row_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, special: np.ndarray,
                seed: int, probability: float = MLM_PROBABILITY, epoch: int = 0):
    """Flat token ids (rows concatenated) -> (masked ids, labels)."""
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    pos = np.arange(ids.size, dtype=np.int64) - starts
    u1, u2, u3 = uniforms(mix(np.repeat(row_ids, lengths), pos, seed, epoch))
    sel = (special == 0) & (u1 < probability)
    rand_tok = np.floor(u3 * VOCAB_SIZE).astype(np.int32)
    masked = np.where(sel & (u2 < MASK_SHARE), np.int32(MASK),
                      np.where(sel & (u2 < MASK_SHARE + RANDOM_SHARE), rand_tok, ids)).astype(np.int32)
    labels = np.where(sel, ids, np.int32(-100)).astype(np.int32)
    return masked, labels


def mlm_mask(df: DataFrame, id_col: str = "Sequence_ID", ids_col: str = "input_ids",
             special_col: str = "special_tokens_mask", seed: int = 42,
             probability: float = MLM_PROBABILITY, epoch: int = 0) -> DataFrame:
    """Replace ``ids_col`` by its masked version and add ``labels``. Each
    ``epoch`` masks anew. Rows stay in their partitions (no shuffle)."""
    int_array = ArrayType(IntegerType(), True)
    out_schema = StructType([f for f in df.schema.fields] + [StructField("labels", int_array)])
    names = df.columns
    i_ids, i_sp, i_id = names.index(ids_col), names.index(special_col), names.index(id_col)

    def run(batches):
        for b in batches:
            toks, spec = b.column(i_ids), b.column(i_sp)
            lengths = np.diff(toks.offsets.to_numpy()).astype(np.int64)
            flat = toks.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            flat_sp = spec.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            rid = b.column(i_id).to_numpy(zero_copy_only=False).astype(np.int64)
            masked, labels = mask_arrays(rid, lengths, flat, flat_sp, seed, probability, epoch)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            cols = list(b.columns)
            cols[i_ids] = pa.ListArray.from_arrays(offsets, pa.array(masked, pa.int32()))
            cols.append(pa.ListArray.from_arrays(offsets, pa.array(labels, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=names + ["labels"])

    ship_package(df.sparkSession)
    return df.mapInArrow(run, out_schema)
