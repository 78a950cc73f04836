"""Token counts of whole texts."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.llm.frames import fresh, q, slices
from tokenloom.llm.subwords import subwords

#: Bytes of text encoded at once.
BATCH_BYTES = 1 << 20


def token_count(text: Column, tokenizer: str, batch_bytes: int = BATCH_BYTES) -> Column:
    """Number of tokens of a text column; only lengths leave the Python worker."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = subwords(tokenizer)
        for batch in batches:
            texts = [x or "" for x in batch.to_pylist()]
            counts: list[int] = []
            for start, end in slices([len(x) for x in texts], batch_bytes):
                counts += [len(ids) // 4 for ids in encoder.encode(texts[start:end])]
            yield pa.array(counts, pa.int64())

    return count(text)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns plus n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    No shuffle: one pass over the table. Counts equal those of the tokenizer's library
    over the whole text, without begin, end or added special tokens, truncation or padding;
    special strings inside texts are the library's special tokens.
    A null or empty text has 0 bytes and 0 tokens. Long texts are cut at safe places and
    batches are balanced by their size. Repeated rows and null keys are counted like
    any row; other columns are not read, whatever their names.
    """
    source = docs.select(*[q(name) for name in dict.fromkeys([*keep, text])])
    n = fresh(source, "n")
    counted = source.withColumn(n, token_count(q(text), tokenizer))
    return counted.select(
        *[q(name) for name in keep],
        F.coalesce(F.octet_length(q(text)), F.lit(0)).cast("long").alias("n_bytes"),
        q(n).alias("n_tokens"),
        (q(n) > limit).alias("over_limit"),
    )
