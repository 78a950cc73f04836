"""Hash buckets of pretokens, counted by row: an Arrow column function."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from tokenloom.functions.merging import KEPT, LETTERS, pieces


class WordBuckets:
    """Buckets of pretokens; equal ones are hashed once per worker."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.known: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def bucket(self, word: str) -> int:
        """The first four bytes of the md5 sum, modulo the number of buckets."""
        digest = hashlib.md5(word.encode(), usedforsecurity=False).digest()
        return int.from_bytes(digest[:4], "big") % self.buckets

    def counts(self, batch: pa.ListArray) -> pa.ListArray:
        """Of every row its (bucket, n, total), total being all its pretokens; null rows have none."""
        coded = batch.flatten().dictionary_encode()
        if len(self.known) > KEPT:
            self.known = {}
        numbers = []
        for word in coded.dictionary.to_pylist():
            number = self.known.get(word)
            if number is None:
                number = self.bucket(word)
                if len(word) <= LETTERS:
                    self.known[word] = number
            numbers.append(number)
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        found = np.array(numbers, np.int64)[coded.indices.to_numpy()]
        pairs, n = np.unique(rows * self.buckets + found, return_counts=True)
        rows, found = np.divmod(pairs, self.buckets)
        ends = np.cumsum([0, *np.bincount(rows, minlength=len(sizes))])
        columns = [found, n, sizes[rows]]
        entries = pa.StructArray.from_arrays(
            [pa.array(column, pa.int32()) for column in columns], names=["bucket", "n", "total"]
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


def bucket_counts(pretokens: Column, buckets: int) -> Column:
    """(bucket, n, total) of the distinct buckets of an array of pretokens."""
    hashed = WordBuckets(buckets)

    @F.arrow_udf("array<struct<bucket:int,n:int,total:int>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for piece in pieces(batch):
                yield hashed.counts(piece)

    return count(pretokens)
