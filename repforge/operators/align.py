"""Residue comparison of many pairs at once on flat buffers.

A batch's texts are one array of codes; a pair is a place in it for the
centre, one for the member and a diagonal. Without gaps the equal residues of
all pairs are counted in one pass; with gaps all pairs take one step of a
banded alignment together, residue by residue.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Codes that one numpy pass holds.
SLICE = 2_000_000
_COST = np.int64(1 << 31)
_FAR = np.int64(1) << np.int64(61)


def codes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets) of a string column: bytes where all are ASCII, else
    code points."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, width)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.empty(0, np.uint8)
    if not len(flat) or flat.max() < 0x80:
        return flat, offsets - offsets[0]
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    return points, np.concatenate([[0], np.cumsum(lengths)])


def slices(sizes: np.ndarray, limit: int = SLICE):
    """Bounds of runs of pairs that hold about ``limit`` codes each."""
    bucket = (np.cumsum(sizes) - sizes) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(sizes)]])
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def equal_codes(codes: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each pair the equal codes of codes[a: a + n] and codes[b: b + n]."""
    out = np.zeros(len(n), np.int64)
    for low, high in slices(n):
        m = n[low:high]
        pair = np.repeat(np.arange(len(m)), m)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
        same = codes[a[low:high][pair] + step] == codes[b[low:high][pair] + step]
        out[low:high] = np.bincount(pair[same], minlength=len(m))
    return out


def apart(codes: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, band: int) -> np.ndarray:
    """For each pair a lower bound of the columns that do not match, in any
    alignment of codes[b: b + n] within ``band`` places of the diagonal that
    puts codes[b] on codes[a]. Two neighbours of the member that lie nowhere
    in the band side by side cost a column at least (one of them differs or
    meets a gap, or a gap parts them), and the neighbours taken are disjoint.
    Codes beyond the centre's ends can only lower the bound."""
    out = np.zeros(len(n), np.int64)
    if len(codes) < 2 or not len(n):
        return out
    shift, kind = (8, np.uint16) if codes.dtype == np.uint8 else (32, np.uint64)
    twos = (codes[:-1].astype(kind) << kind(shift)) | codes[1:]
    padded = np.concatenate([np.zeros(band, kind), twos, np.zeros(band + 1, kind)])
    half = n // 2
    for low, high in slices(half):
        m = half[low:high]
        pair = np.repeat(np.arange(len(m)), m)
        step = 2 * (np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m))
        mine = twos[b[low:high][pair] + step]
        at = np.clip(a[low:high][pair] + step, 0, len(codes) - 1)
        lost = np.ones(len(pair), bool)
        for off in range(2 * band + 1):
            lost &= padded[at + off] != mine
        out[low:high] = np.bincount(pair[lost], minlength=len(m))
    return out


def banded(codes: np.ndarray, centre: np.ndarray, c_len: np.ndarray, start: np.ndarray, member: np.ndarray,
           n: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, matches) of the best alignment of codes[member: member + n]
    with any part of the centre codes[centre: centre + c_len], at most
    ``band`` places off the diagonal that puts the member's first residue on
    the centre's place ``start``. Best is the least number of columns that do
    not match (differing residues or gaps), then the fewest columns. The ends
    of the centre are free."""
    columns, matches = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    order = np.argsort(-n, kind="stable")  # pairs that end leave from the back
    for low, high in slices(np.maximum(n[order], 1) * (2 * band + 1), 4 * SLICE):
        pairs = order[low:high]
        value = _aligned(codes, centre[pairs], c_len[pairs], start[pairs], member[pairs], n[pairs], band)
        cost = value >> 31
        columns[pairs] = value & (_COST - 1)
        matches[pairs] = columns[pairs] - cost
    return columns, matches


def _aligned(codes, centre, c_len, start, member, n, band) -> np.ndarray:
    """Least ``non-matching columns * 2^31 + columns`` of each pair, which
    come longest first."""
    off = np.arange(-band, band + 1)
    slope = off * (_COST + 1)
    at = start[:, None] + off[None, :]  # place in the centre before the next residue
    state = np.where((at >= 0) & (at <= c_len[:, None]), np.int64(0), _FAR)
    out = np.zeros(len(n), np.int64)
    live = len(n)
    for step in range(int(n[0]) + 1 if len(n) else 0):
        ended = np.searchsorted(-n[:live], -step, side="left")  # those with n > step stay
        if ended < live:
            out[ended:live] = state[ended:live].min(1)
            live = int(ended)
            state, at = state[:live], at[:live]
        if not live:
            break
        inside = (at >= 0) & (at < c_len[:live, None])
        c = codes[centre[:live, None] + np.where(inside, at, 0)]
        differ = c != codes[member[:live] + step][:, None]
        both = np.where(inside, state + differ * _COST + 1, _FAR)  # residue on residue
        alone = np.full_like(state, _FAR)  # residue on a gap: one place back
        alone[:, :-1] = state[:, 1:] + _COST + 1
        state = np.minimum(both, alone)
        at = at + 1
        # gaps in the member: from any smaller offset of the same residue
        state = np.minimum.accumulate(state - slope, axis=1) + slope
        state = np.where((at >= 0) & (at <= c_len[:live, None]), np.minimum(state, _FAR), _FAR)
    return out
