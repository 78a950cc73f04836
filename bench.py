"""Headline timings: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from tokenloom.operators import codec as cd, pretokens as pt, training as tr
from tokenloom.plans.queries import (
    QUERIES,
    codec,
    documents,
    encoded as encoded_documents,
    next_token_table,
    stream,
)
from tokenloom.session import local_session

REGISTERED = [
    "pretoken_counts_top",
    "pretoken_spans",
    "pair_counts_top",
    "pair_index_sizes",
    "pair_occurrences",
    "bpe_merges",
    "encode_documents",
    "encode_conversations",
    "decode_roundtrip",
    "token_counts",
    "word_compression",
    "pack_sequences",
    "sample_windows_random",
    "ngram_model",
    "score_documents",
    "nucleus_table",
    "generate",
    "cross_entropy",
    "softmax_temperature",
    "soft_knn",
    "classifier_scores",
    "quality_classifier",
    "stream_encode",
]


def timed(action) -> float:
    began = time.time()
    action()
    return round(time.time() - began, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def listed_codec(docs, n: int) -> cd.Codec:
    """A vocabulary of about 10,000 tokens: frequent words, spelled from left to right."""
    counts = pt.pretoken_counts(docs).where(F.octet_length("pretoken") > 1)
    words = [row["pretoken"].encode() for row in counts.orderBy(F.desc("freq")).limit(n).collect()]
    known, merges = {bytes([b]) for b in range(256)}, []
    for word in words:
        for end in range(2, len(word) + 1):
            if word[:end] not in known and len(merges) < n:
                known.add(word[:end])
                merges.append((word[: end - 1], word[end - 1 : end]))
    tokens = [bytes([b]) for b in range(256)] + [left + right for left, right in merges]
    return cd.Codec(enumerate(tokens), merges)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bench")
    run(documents(spark, sf).select(F.octet_length("text")))
    # what several queries share, timed apart, so that no query pays for another
    cold = {
        "train_bpe": timed(lambda: codec(spark, sf)),
        "encode_documents": timed(lambda: encoded_documents(spark, sf)),
        "token_stream": timed(lambda: stream(spark, sf)),
        "next_token_table": timed(lambda: next_token_table(spark, sf)),
    }
    seconds = {name: timed(lambda: run(QUERIES[name](spark, sf))) for name in REGISTERED}

    docs = documents(spark, sf).persist()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] / (1 << 20)
    learned = []
    seconds["train_bpe_500"] = timed(lambda: learned.append(tr.train_bpe(docs, 500)))
    coder = cd.Codec.from_model(learned[0])
    for plan in cd.PLANS:
        seconds[f"encode_500_{plan}"] = timed(lambda p=plan: run(cd.encode_corpus(docs, coder, plan=p)))
    large = listed_codec(docs, 9_743)
    encoded = []
    seconds["encode_10000"] = timed(
        lambda: encoded.append(
            cd.encode_corpus(docs, large).agg(F.sum(F.size("tokens"))).first()[0]
        )
    )
    seconds["encode_500_totals"] = timed(
        lambda: run(cd.word_compression(pt.pretoken_counts(docs), coder))
    )
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()) + sum(cold.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "corpus_mb": round(size, 2),
                "encode_mb_per_sec": round(size / seconds["encode_500_map"], 2),
                "encode_10000_mb_per_sec": round(size / seconds["encode_10000"], 2),
                "bytes_per_token_10000": round(size * (1 << 20) / encoded[0], 3),
                "cold": cold,
                "encode_totals_mb_per_sec": round(size / seconds["encode_500_totals"], 2),
            }
        )
    )


if __name__ == "__main__":
    main()
