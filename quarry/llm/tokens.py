"""Operator 1: token counts.

Texts are cut at boundaries where the pieces provably encode as the whole
does, long runs too (``PIECE_CHARS``), and the pieces that a worker's
bounded memo doesn't know are encoded by the public tokenizer's own library
in batches of about ``BATCH_BYTES`` of UTF-8, however many rows that is.
For tokenizers without such boundaries whole texts are encoded.  Only
lengths leave the Arrow function.

Null and empty texts count 0 bytes and 0 tokens; repeated rows are counted
each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import SAFE_CUT, chunks, safe_pieces, texts_of
from quarry.llm.units import UnitMemo

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 15
#: Bytes of text counted at a time.
TEXT_BYTES = 4 << 20

_LOADED: dict[str, Callable] = {}


def cuts_are_safe(spec: dict) -> bool:
    """Whether the boundaries of ``safe_pieces`` hold for this tokenizer: a
    byte-level pattern split without normaliser, prefix or added tokens
    that take white space with them."""
    pre = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or SAFE_CUT.search(t["content"]) for t in spec.get("added_tokens", [])))


def load(path: str) -> Callable[[list[str]], Iterable[int]]:
    """The function from texts to token counts; one per worker and file."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: batched(texts, lambda part: [len(x) for x in model.encode(part, num_threads=1)])
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)

            def lengths(texts: list[str]) -> list[int]:
                return batched(texts, lambda part: [len(x) for x in own.encode_batch_fast(part, add_special_tokens=False)])

            if cuts_are_safe(spec):
                memo = UnitMemo(lengths, lambda text: lengths(list(safe_pieces(text, PIECE_CHARS))), {t["content"]: 1 for t in spec.get("added_tokens", [])}, sum)
                _LOADED[path] = lambda texts: memo.values(texts)
            else:
                _LOADED[path] = lengths
    return _LOADED[path]


def batched(texts: list[str], encode: Callable[[list[str]], list[int]], batch_bytes: int = BATCH_BYTES) -> list[int]:
    """``encode`` over batches of about ``batch_bytes`` of UTF-8 each."""
    out: list[int] = []
    waiting: list[str] = []
    held = 0
    for text in texts:
        waiting.append(text)
        held += len(text) if text.isascii() else len(text.encode())
        if held >= batch_bytes:
            out += encode(waiting)
            waiting, held = [], 0
    return out + encode(waiting) if waiting else out


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every
    row of ``docs`` by the tokenizer file ``tokenizer`` (.json: tokenizers,
    .model: sentencepiece), without added special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load(tokenizer)
        for batch in batches:
            for at, end, chunk in chunks(batch, TEXT_BYTES):
                totals = list(count(batch.column(1).slice(at, end - at).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(np.diff(chunk.off), pa.int64()), pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
