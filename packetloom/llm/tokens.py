"""Token counts of texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: The vocabulary file of ranks; a parameter everywhere, never copied into the repository.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are split before merging; a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``docs`` with ``n_tokens`` (0 for null and empty texts) in place of ``text``; one map-side pass."""
    from pyspark.sql import types as T

    keep = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*keep, T.StructField("n_tokens", T.LongType(), False)])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            names = batch.schema.names
            counts = [len(encode(t)) if t else 0 for t in batch.column(names.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(f.name)) for f in keep), pa.array(counts, pa.int64())], [f.name for f in schema.fields])

    return docs.mapInArrow(scan, schema)
