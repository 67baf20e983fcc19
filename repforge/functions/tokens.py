"""Residue tokenisation and masked-language-model masking as array
expressions (no Python on the hot path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokenizer vocabulary (token -> id).
VOCAB = {
    "<s>": 0, "<pad>": 1, "</s>": 2, "<unk>": 3, "<mask>": 4,
    "A": 5, "C": 6, "D": 7, "E": 8, "F": 9, "G": 10, "H": 11, "I": 12, "K": 13,
    "L": 14, "M": 15, "N": 16, "P": 17, "Q": 18, "R": 19, "S": 20, "T": 21,
    "V": 22, "W": 23, "Y": 24,
}
BOS, PAD, EOS, UNK, MASK = 0, 1, 2, 3, 4
MAX_LENGTH = 150
VOCAB_SIZE = len(VOCAB)
# Masking rule (share of maskable positions selected, then
# share of those replaced by <mask>, by a random token, kept).
MLM_PROBABILITY = 0.15
MASK_SHARE, RANDOM_SHARE = 0.8, 0.1


def _vocab_map() -> Column:
    pairs = []
    for tok, idx in VOCAB.items():
        if len(tok) == 1:
            pairs += [F.lit(tok), F.lit(idx)]
    return F.create_map(*pairs)


def tokenize(text: Column, max_length: int = MAX_LENGTH) -> Column:
    """Struct of ``input_ids``, ``attention_mask``, ``special_tokens_mask``,
    each of length ``max_length``: ``<s>`` + residues (unknown -> ``<unk>``,
    truncated to ``max_length - 2``) + ``</s>``, padded with ``<pad>``."""
    vocab = _vocab_map()
    chars = F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != F.lit(""))
    body = F.transform(F.slice(chars, 1, max_length - 2),
                       lambda c: F.coalesce(F.try_element_at(vocab, c), F.lit(UNK)))
    seq = F.concat(F.array(F.lit(BOS)), body, F.array(F.lit(EOS)))
    n = F.size(seq)
    pad = F.lit(max_length) - n
    return F.struct(
        F.concat(seq, F.array_repeat(F.lit(PAD), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
        F.concat(F.array(F.lit(1)), F.array_repeat(F.lit(0), n - 2), F.array(F.lit(1)),
                 F.array_repeat(F.lit(1), pad)).alias("special_tokens_mask"),
    )
