"""Token counts of whole texts with a public tokenizer's own library.

Arrow functions encode in batches and return lengths only. Batches are balanced by
bytes. With a byte-level tokenizer texts are split before single spaces between two
characters that aren't white space: no token reaches over such a place, so the lengths of
the parts add up. Arrow finds the distinct parts of a slice of texts, and the library encodes
each of them once. Nothing is kept from one slice to the next but what the library keeps.
With other tokenizers texts are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sieveline.llm.bpe import cut_safely
from sieveline.llm.common import only, pieces_of

#: Bytes of a slice of texts, and of a batch for the library.
SLICE, BATCH = 8 << 20, 1 << 18


class Counter:
    """Lengths of texts under one tokenizer file, ``.json`` or ``.model``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.encode, self.splits = self._load(path)

    @staticmethod
    def _load(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], False
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        plain = not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in said.get("added_tokens") or [])
        safe = not said.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and plain
        return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], bool(safe)

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text; of a null one 0."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        parts, of = cut_safely(texts, self.splits)  # without safe places a part is a text
        coded = parts.dictionary_encode()
        lengths = np.zeros(len(coded.dictionary), dtype=np.int64)
        for begin, batch in _batches(coded.dictionary, BATCH):
            lengths[begin : begin + len(batch)] = self.encode(batch)
        return np.bincount(of, lengths[coded.indices.to_numpy()], len(texts)).astype(np.int64)


def _batches(texts: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of about ``most`` bytes, and the number of the first; a longer text is alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        upto = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield begin, texts[begin:upto].to_pylist()
        begin = upto


_LOADED: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row.

    A null text counts as empty: no bytes, no tokens. Repeated rows stay repeated; an empty
    table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for part in pieces_of(batches, 1, slice_bytes):
            n_bytes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            n_tokens = pa.array(own.count(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), n_bytes, n_tokens, pc.greater(n_tokens, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
