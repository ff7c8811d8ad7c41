"""Sizes of texts in tokens of a public tokenizer. The vocabulary file's path is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def counter(path: str):
    """texts -> number of tokens of each, for a .tiktoken, .json (tokenizers) or .model (sentencepiece) file."""
    kind = Path(path).suffix
    if kind == ".tiktoken":
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
        encoding = tiktoken.Encoding(Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
    if kind == ".json":
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    if kind == ".model":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    raise ValueError(f"no tokenizer for {path}")


def token_sizes(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and n_tokens (long) of every row; a null text has null tokens, an empty one 0."""
    schema = docs.select(*keep).schema.add("n_tokens", "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            sizes = iter(count([t for t in texts if t is not None]))
            n = pa.array([None if t is None else next(sizes) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*keep, "n_tokens"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(rows, schema)


