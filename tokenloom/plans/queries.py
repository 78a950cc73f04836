"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.functions import arrays as ar, optimizer as opt, text as tx
from tokenloom.operators import (
    attention as at,
    backoff as bo,
    codec as cd,
    datasets as ds,
    generation as gen,
    models as md,
    pairs as pr,
    pretokens as pt,
    scoring as sc,
    sparse_models as sm,
    training as tr,
    vocabulary as vc,
)
from tokenloom.session import materialize, scratch_path
from tokenloom.sources import artifacts, corpus, ranges, snapshots
from tokenloom.streaming import jobs

N_MERGES = 32
END_ID = 256 + N_MERGES
VOCAB_SIZE = END_ID + 1
WINDOW = 64
SEED = 42
VALID_SHARE = 0.1
TEMPERATURE = 0.8
NUCLEUS = 0.9
PROMPT_LENGTH = 32
ORDER = 3
FEW_TOKENS = 5
NEW_TOKENS = 10
KNN_LENGTH, LONG_KNN = 32, 10_000
BATCH = 64
HISTOGRAM_DRAWS = 100_000
PLAN = {"batch": 8, "length": WINDOW, "total_tokens": 2_000_000, "schedule_epochs": 2}
RATES = (2e-3, 2e-4)
WARMUP = 100
FEATURES, SPARSE_BUCKETS, SPARSE_STEPS = 32, 1 << 20, 100
MAX_NORM = 0.1
ONE_FILE = 64 << 20
LONG_LIST, LONG_SQUARE = 900, 12
ANY_LIST, ANY_SQUARE = 30, 6
WHOLE_WORDS = 50
FILE_DOCUMENTS, FILE_RANGE, FILE_ROW = 250, 1 << 16, 1 << 13
FILE_TASK, ARRIVING_ROWS = 8 << 20, 5_000
NESTED = ["<|part|>", "<|part|><|end|>", "<|end|>"]
BATCH_STEPS, BATCH_SHARE, EVALUATE_EVERY = 20, 0.25, 10

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# What several queries share, computed once per session and folder.
_shared: dict[tuple, object] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def shared(name: str, spark: SparkSession, sf: str, build):
    key = (name, spark.sparkContext.applicationId, sf)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table of one small file to all cores: such a file is a single split.

    Only for the test tables, which are below ``ONE_FILE`` bytes; operators never do this.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > ONE_FILE:
        return df
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", *columns), "doc_id")


def comma(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), ",")


def model(spark: SparkSession, sf: str) -> tr.BpeModel:
    return shared(
        "model", spark, sf, lambda: tr.train_bpe(documents(spark, sf), VOCAB_SIZE)
    )


def codec(spark: SparkSession, sf: str) -> cd.Codec:
    return shared("codec", spark, sf, lambda: cd.Codec.from_model(model(spark, sf)))


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, lang, tokens) of all documents, written once to the shared folder."""
    return shared(
        "encoded",
        spark,
        sf,
        lambda: materialize(
            cd.encode_corpus(
                documents(spark, sf, "lang"), codec(spark, sf), keep=("doc_id", "lang")
            )
        ),
    )


def stream(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as one delimited token stream."""
    return shared(
        "stream",
        spark,
        sf,
        lambda: materialize(ds.token_stream(ds.delimited(encoded(spark, sf), END_ID))),
    )


def next_token_table(spark: SparkSession, sf: str) -> DataFrame:
    """Bigram counts of the delimited training documents."""

    def build() -> DataFrame:
        split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
        train = stream(spark, sf).where(split == "train")
        return materialize(sc.ngram_model(sc.bigrams(train), VOCAB_SIZE))

    return shared("ngram", spark, sf, build)


def words(spark: SparkSession, sf: str) -> DataFrame:
    return pr.byte_words(pt.pretoken_counts(documents(spark, sf)))


# Pretokens.


@query
def pretoken_counts_top(spark, sf):
    counts = pt.pretoken_counts(documents(spark, sf))
    return counts.orderBy(F.col("freq").desc(), "pretoken").limit(100)


@query
def pretoken_counts(spark, sf):
    return pt.pretoken_counts(documents(spark, sf))


@query
def pretokens_per_lang_source(spark, sf):
    counts = pt.pretoken_counts(documents(spark, sf, "lang", "source"), by=["lang", "source"])
    return counts.groupBy("lang", "source").agg(
        F.sum("freq").alias("n_pretokens"),
        F.sum(F.col("freq") * F.octet_length("pretoken")).alias("n_bytes"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


@query
def page_pretokens(spark, sf):
    pages = spread(table(spark, sf, "pages").select("page_id", "html"), "page_id")
    counts = pt.pretokenize(pages, "html", keep=("page_id",)).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n_pretokens"),
        F.count_if(F.octet_length("pretoken") >= 2).alias("n_long"),
    )
    found = pages.select("page_id").join(counts, "page_id", "left")
    return found.fillna(0, ["n_pretokens", "n_long"])


@query
def pretoken_spans(spark, sf):
    return pt.pretoken_spans(documents(spark, sf), least=2).select(
        "doc_id", "pos", "pretoken", F.col("start").alias("start_byte"), F.col("end").alias("end_byte")
    )


@query
def pretokens_at(spark, sf):
    labels = table(spark, sf, "labels")
    wanted = labels.select(
        "doc_id", F.explode(F.array(F.col("quality"), F.col("toxic") + 5)).alias("pos")
    )
    return pt.pretokens_at(pt.pretoken_spans(documents(spark, sf)), wanted).select(
        "doc_id", "pos", "pretoken"
    )


def _delimited_text(spark, sf):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(tx.END_OF_TEXT))
    return documents(spark, sf).withColumn("text", text)


@query
def special_segments(spark, sf):
    return pt.split_special(_delimited_text(spark, sf), [tx.END_OF_TEXT])


@query
def special_pretokens(spark, sf):
    counts = pt.pretoken_counts(_delimited_text(spark, sf), specials=[tx.END_OF_TEXT])
    return counts.orderBy(F.col("freq").desc(), "pretoken").limit(100)


@query
def split_documents(spark, sf):
    return corpus.split_documents(_delimited_text(spark, sf))


@query
def document_lines(spark, sf):
    lines = corpus.explode_lines(documents(spark, sf)).where(F.col("line_no").isNotNull())
    return lines.select("doc_id", "line_no", F.octet_length("text").alias("n_bytes"))


@query
def nested_specials(spark, sf):
    """Specials of which one begins with another: the longest wins."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("<|part|><|end|>"))
    text = F.replace(F.replace(text, F.lit(", "), F.lit("<|part|>")), F.lit(". "), F.lit("<|end|>"))
    return pt.split_special(documents(spark, sf).withColumn("text", text), NESTED)


# Files.


def text_folder(spark: SparkSession, sf: str) -> str:
    """The documents as text files, so many consecutive ids each, in order of their ids."""

    def build() -> str:
        path = scratch_path(spark, "text_files")
        part = F.floor(F.col("doc_id") / FILE_DOCUMENTS).cast("long").alias("part")
        rows = documents(spark, sf).where(F.col("text").isNotNull()).select(part, "doc_id", "text")
        rows = rows.repartition("part").sortWithinPartitions("part", "doc_id")
        rows.select("part", "text").write.partitionBy("part").text(path)
        return path

    return shared("text_files", spark, sf, build)


def part_of(path: str) -> Column:
    return F.regexp_extract(path, "part=([0-9]+)", 1).cast("long").alias("part")


@query
def file_pretokens(spark, sf):
    """Pretokens of files read in byte ranges, with the places of the first and the last."""
    rows = ranges.read_ranges(spark, text_folder(spark, sf), FILE_RANGE, FILE_ROW, task_bytes=FILE_TASK)
    # the number of a part is found once per row of text
    return (
        ranges.file_spans(rows.withColumn("path", part_of("path")))
        .groupBy(F.col("path").alias("part"), "pretoken")
        .agg(
            F.count(F.lit(1)).alias("freq"),
            F.min("start").alias("first_byte"),
            F.max("end").alias("last_byte"),
        )
    )


@query
def file_lines(spark, sf):
    lines = ranges.range_lines(spark, text_folder(spark, sf), FILE_RANGE, FILE_TASK)
    return lines.select(
        part_of("path"), F.col("start").alias("start_byte"), F.octet_length("text").alias("n_bytes")
    )


@query
def corpus_files(spark, sf):
    """Whole files, and their lines as the built-in reader cuts them."""
    folder = text_folder(spark, sf)
    lines = corpus.read_lines(spark, folder).groupBy(part_of("path")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("text")).alias("line_bytes")
    )
    whole = corpus.read_corpus(spark, folder).select(
        part_of("path"), F.octet_length("text").alias("n_bytes"), F.md5("text").alias("md5")
    )
    return whole.join(lines, "part")


@query
def byte_histogram(spark, sf):
    counts = pt.pretoken_counts(documents(spark, sf))
    return (
        pt.explode_bytes(counts, keep=("freq",))
        .groupBy("byte")
        .agg(F.sum("freq").alias("n"))
    )


# Pairs.


def _pair_hex(pairs: DataFrame) -> DataFrame:
    return pr.pair_sides(pairs).drop("pair")


@query
def pair_counts_top(spark, sf):
    return _pair_hex(pr.top_pairs(pr.pair_counts(words(spark, sf)), 50))


@query
def top_pair(spark, sf):
    return _pair_hex(pr.top_pair(pr.pair_counts(words(spark, sf))))


@query
def pair_index_sizes(spark, sf):
    return _pair_hex(pr.pair_index_sizes(words(spark, sf)))


@query
def words_with_pair(spark, sf):
    return pr.words_with_pair(words(spark, sf), "th").select("pretoken", "freq")


@query
def pair_counts_after_merge(spark, sf):
    steps = [("th", chr(256)), ("in", chr(257)), (" " + chr(256), chr(258))]
    before = words(spark, sf).select("sym", "freq")
    after = pr.apply_deltas(pr.pair_counts(before), pr.pair_deltas(before, steps))
    return after.select(
        F.ascii(F.substring("pair", 1, 1)).alias("left_code"),
        F.ascii(F.substring("pair", 2, 1)).alias("right_code"),
        "n",
    )


@query
def pair_occurrences(spark, sf):
    spans = pt.pretoken_spans(documents(spark, sf), least=2)
    return pt.find_occurrences(spans, "th").withColumnRenamed("offset", "offset_byte")


@query
def token_occurrences(spark, sf):
    """All tokens of more than one byte, wherever they stand in the texts, in one pass."""
    tokens = [bytes(x) for x in model(spark, sf).tokens[256:END_ID]]
    spans = pt.pretoken_spans(documents(spark, sf), least=2)
    return (
        pt.find_all_occurrences(spans, tokens)
        .groupBy("doc_id", (F.col("needle") + 256).alias("token_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("offset").alias("first_byte"),
            F.max("offset").alias("last_byte"),
        )
    )


@query
def unmerged_occurrences(spark, sf):
    spans = materialize(pt.pretoken_spans(documents(spark, sf), least=2))
    merged = pt.find_occurrences(spans, "th")
    return pt.find_occurrences(spans, "he", merged=merged).withColumnRenamed("offset", "offset_byte")


# Vocabulary.


def _merge_rows(merges: DataFrame) -> DataFrame:
    return merges.select(
        "rank", F.hex("left_bytes").alias("left_hex"), F.hex("right_bytes").alias("right_hex")
    )


def _vocab_rows(vocab: DataFrame) -> DataFrame:
    return vocab.select("token_id", F.hex("token_bytes").alias("token_hex"))


@query
def bpe_merges(spark, sf):
    return _merge_rows(model(spark, sf).merges_frame(spark))


@query
def bpe_merges_500(spark, sf):
    """A vocabulary of 500 entries: bytes, 243 merges, the delimiter."""
    learned = shared("model_500", spark, sf, lambda: tr.train_bpe(documents(spark, sf), 500))
    return _merge_rows(learned.merges_frame(spark))


@query
def bpe_merges_resumed(spark, sf):
    state = artifacts.TrainingState(scratch_path(spark, "training"))
    half = VOCAB_SIZE - N_MERGES // 2
    tr.train_bpe(documents(spark, sf), half, state=state, checkpoint_every=3)
    learned = tr.train_bpe(documents(spark, sf), VOCAB_SIZE, state=state, resume=True)
    return _merge_rows(learned.merges_frame(spark))


@query
def bpe_vocab(spark, sf):
    return _vocab_rows(model(spark, sf).vocab_frame(spark))


@query
def bpe_char_vocab(spark, sf):
    def build():
        counts = pt.pretoken_counts(documents(spark, sf)).persist()
        size = 1 + len(tr.character_alphabet(counts)) + N_MERGES
        counts.unpersist()
        return tr.train_bpe(documents(spark, sf), size, specials=(), alphabet="char")

    learned = shared("char", spark, sf, build)
    return learned.vocab_frame(spark).select(
        "token_id", F.col("token_bytes").cast("string").alias("token")
    )


@query
def printable_vocab(spark, sf):
    vocab = model(spark, sf).vocab_frame(spark)
    return artifacts.printable_tokens(vocab).select("token_id", "token")


def _files(spark, sf) -> tuple[str, str]:
    def build():
        paths = scratch_path(spark, "vocab"), scratch_path(spark, "merges")
        artifacts.write_vocab(model(spark, sf).vocab_frame(spark), paths[0])
        artifacts.write_merges(model(spark, sf).merges_frame(spark), paths[1])
        return paths

    return shared("files", spark, sf, build)


@query
def vocab_from_json(spark, sf):
    return _vocab_rows(artifacts.read_vocab(spark, _files(spark, sf)[0]))


@query
def merges_from_text(spark, sf):
    vocab_path, merges_path = _files(spark, sf)
    vocab = artifacts.read_vocab(spark, vocab_path)
    return _merge_rows(artifacts.read_merges(spark, merges_path, vocab))


@query
def valid_merges(spark, sf):
    learned = model(spark, sf)
    known = learned.vocab_frame(spark).where("token_id <> 256")
    return _merge_rows(vc.valid_merge_filter(learned.merges_frame(spark), known))


@query
def finalize_vocab(spark, sf):
    learned = model(spark, sf)
    specials = [tx.END_OF_TEXT, "<|pad|>"]
    return _vocab_rows(
        vc.finalize_vocab(learned.vocab_frame(spark), learned.merges_frame(spark), specials)
    )


# Encoding and decoding.


def _encoded_rows(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.size("tokens").alias("n_tokens"), comma("tokens").alias("tokens"))


@query
def encode_documents(spark, sf):
    return _encoded_rows(cd.encode_corpus(documents(spark, sf), codec(spark, sf)), "doc_id")


@query
def encode_documents_inline(spark, sf):
    done = cd.encode_corpus(documents(spark, sf), codec(spark, sf), plan="inline")
    return _encoded_rows(done, "doc_id")


@query
def encode_documents_by_words(spark, sf):
    # Small limits, so that the broadcast and the salted shuffle both take part.
    done = cd.encode_by_words(
        documents(spark, sf), codec(spark, sf), broadcast_rows=0, hot_rows=1000
    )
    return _encoded_rows(done, "doc_id")


def _frequent_pairs(spark, sf, n: int) -> list[tuple[bytes, bytes]]:
    """The most frequent byte pairs of the documents, greater bytes first among equals."""
    rows = pr.pair_counts(words(spark, sf)).orderBy(F.desc("n"), F.desc("pair")).limit(n).collect()
    return [(row["pair"][0].encode("latin-1"), row["pair"][1].encode("latin-1")) for row in rows]


def _pairs_of_pairs(pairs: list[tuple[bytes, bytes]], first: int) -> list[tuple[bytes, bytes]]:
    joined = [left + right for left, right in pairs[:first]]
    return [(left, right) for left in joined for right in joined]


def _listed_codec(tokens: list[bytes], merges: list[tuple[bytes, bytes]], **options) -> cd.Codec:
    return cd.Codec(enumerate([bytes([b]) for b in range(256)] + tokens), merges, **options)


@query
def encode_long_list(spark, sf):
    pairs = _frequent_pairs(spark, sf, LONG_LIST)
    merges = pairs + _pairs_of_pairs(pairs, LONG_SQUARE)
    long_codec = _listed_codec([left + right for left, right in merges], merges)
    return _encoded_rows(cd.encode_corpus(documents(spark, sf), long_codec), "doc_id")


@query
def encode_long_list_by_words(spark, sf):
    pairs = _frequent_pairs(spark, sf, LONG_LIST)
    merges = pairs + _pairs_of_pairs(pairs, LONG_SQUARE)
    long_codec = _listed_codec([left + right for left, right in merges], merges)
    return _encoded_rows(cd.encode_corpus(documents(spark, sf), long_codec, plan="words"), "doc_id")


@query
def encode_any_order(spark, sf):
    # Merges of merged pairs rank before the pairs they are made of.
    pairs = _frequent_pairs(spark, sf, ANY_LIST)
    later = _pairs_of_pairs(pairs, ANY_SQUARE)
    tokens = [left + right for left, right in pairs + later]
    return _encoded_rows(
        cd.encode_corpus(documents(spark, sf), _listed_codec(tokens, later + pairs)), "doc_id"
    )


def _whole_words(spark, sf) -> list[str]:
    counts = pt.pretoken_counts(documents(spark, sf)).where(F.length("pretoken") > 2)
    rows = counts.orderBy(F.desc("freq"), "pretoken").limit(WHOLE_WORDS).collect()
    return [row["pretoken"] for row in rows]


@query
def encode_whole_words(spark, sf):
    pairs = _frequent_pairs(spark, sf, ANY_LIST)
    tokens = [left + right for left, right in pairs]
    tokens += [word.encode() for word in _whole_words(spark, sf)]
    return _encoded_rows(
        cd.encode_corpus(documents(spark, sf), _listed_codec(tokens, pairs)), "doc_id"
    )


@query
def encode_drop(spark, sf):
    # Bytes above 127 have no token; a whole word that holds some is still one token.
    pairs = [(a, b) for a, b in _frequent_pairs(spark, sf, ANY_LIST) if a < b"\x80" and b < b"\x80"]
    vocab = [(b, bytes([b])) for b in range(128)]
    tokens = [left + right for left, right in pairs]
    tokens += [word.encode() for word in _whole_words(spark, sf)]
    ascii_codec = cd.Codec(vocab + list(enumerate(tokens, 256)), pairs, oov="drop")
    return _encoded_rows(cd.encode_corpus(documents(spark, sf), ascii_codec), "doc_id")


@query
def encode_duplicate_keys(spark, sf):
    done = cd.encode_corpus(documents(spark, sf, "lang"), codec(spark, sf), keep=("lang",))
    return _encoded_rows(done, "lang")


@query
def encode_conversations(spark, sf):
    turns = spread(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id")
    done = cd.encode_corpus(turns, codec(spark, sf), keep=("conv_id", "turn"))
    return _encoded_rows(done, "conv_id", "turn")


@query
def encode_ascii_only(spark, sf):
    ascii_bytes = cd.Codec([(b, bytes([b])) for b in range(128)], [], oov="drop")
    done = cd.encode_corpus(documents(spark, sf), ascii_bytes)
    return done.select("doc_id", F.size("tokens").alias("n_tokens"))


@query
def encode_file_codec(spark, sf):
    def build():
        vocab_path, merges_path = _files(spark, sf)
        vocab = artifacts.read_vocab(spark, vocab_path)
        merges = artifacts.read_merges(spark, merges_path, vocab)
        return cd.Codec.from_frames(vocab, merges, [tx.END_OF_TEXT])

    loaded = shared("loaded", spark, sf, build)
    items = spread(table(spark, sf, "benchmark"), "item_id")
    return _encoded_rows(cd.encode_corpus(items, loaded, keep=("item_id",)), "item_id")


@query
def decode_roundtrip(spark, sf):
    return cd.decode_tokens(encoded(spark, sf), codec(spark, sf)).select("doc_id", "decoded")


@query
def roundtrip_check(spark, sf):
    return cd.roundtrip_check(documents(spark, sf), codec(spark, sf))


@query
def token_counts(spark, sf):
    return cd.token_counts(encoded(spark, sf))


@query
def delimiter_check(spark, sf):
    return cd.delimiter_check(stream(spark, sf), codec(spark, sf))


@query
def compression_stats(spark, sf):
    texts = documents(spark, sf).join(encoded(spark, sf), "doc_id")
    stats = cd.compression_stats(texts, by=["lang"])
    return stats.select(
        "lang",
        "n_bytes",
        "n_tokens",
        F.round("bytes_per_token", 6).alias("bytes_per_token"),
        F.round("uint16_ratio", 6).alias("uint16_ratio"),
    )


@query
def word_compression(spark, sf):
    counts = pt.pretoken_counts(documents(spark, sf, "source"), by=["source"])
    return cd.word_compression(counts, codec(spark, sf), by=["source"])


@query
def tokenize_dataset(spark, sf):
    split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
    docs = documents(spark, sf).withColumn("split", split)
    parts = {
        name: docs.where(F.col("split") == name).select("doc_id", "text")
        for name in ("train", "valid")
    }
    stats = corpus.tokenize_dataset(
        parts, codec(spark, sf), scratch_path(spark, "dataset"), unit="line"
    )
    return stats.select(
        "split", "n_bytes", "n_tokens", F.round("bytes_per_token", 6).alias("bytes_per_token")
    )


@query
def tokenize_dataset_skip(spark, sf):
    # One split is finished and skipped; of the other an interrupted write is left.
    split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
    docs = documents(spark, sf).withColumn("split", split)
    parts = {
        name: docs.where(F.col("split") == name).select("doc_id", "text")
        for name in ("train", "valid")
    }
    path = scratch_path(spark, "dataset")
    corpus.tokenize_dataset({"train": parts["train"]}, codec(spark, sf), path, unit="line")
    broken = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/split=valid/_temporary/0")
    broken.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(broken)
    parts["train"] = parts["train"].withColumn("text", F.raise_error(F.lit("not skipped")).cast("string"))
    stats = corpus.tokenize_dataset(parts, codec(spark, sf), path, unit="line")
    return stats.select(
        "split", "n_bytes", "n_tokens", F.round("bytes_per_token", 6).alias("bytes_per_token")
    )


# Token datasets.


@query
def token_offsets_by_name(spark, sf):
    # Offsets need the sizes only, so token lists do not travel.
    named = encoded(spark, sf).select(
        F.md5(F.col("doc_id").cast("string")).alias("name"), F.size("tokens").alias("n_tokens")
    )
    return ds.with_offsets(named, "name", F.col("n_tokens")).select("name", "offset", "n_tokens")


@query
def token_offsets(spark, sf):
    return stream(spark, sf).select("doc_id", "offset", F.size("tokens").alias("n_tokens"))


def _window_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "start", comma("input").alias("input"), comma("target").alias("target"))


@query
def pack_sequences(spark, sf):
    return _window_rows(ds.pack_sequences(stream(spark, sf), WINDOW), "window_id")


@query
def next_token_labels(spark, sf):
    labels = ds.next_token_labels(ds.pack_sequences(stream(spark, sf), WINDOW))
    return labels.groupBy("token_id", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def sample_windows_random(spark, sf):
    return _window_rows(ds.sample_windows(stream(spark, sf), BATCH, WINDOW, "random", SEED), "sample_id")


@query
def sample_windows_aligned(spark, sf):
    return _window_rows(ds.sample_windows(stream(spark, sf), BATCH, WINDOW, "aligned", SEED), "sample_id")


def token_blocks(spark: SparkSession, sf: str) -> snapshots.Snapshot:
    """The token stream as a stored snapshot of blocks."""

    def build() -> snapshots.Snapshot:
        return snapshots.write_token_blocks(stream(spark, sf), scratch_path(spark, "token_blocks"))

    return shared("token_blocks", spark, sf, build)


@query
def sample_windows_indexed(spark, sf):
    """The windows of ``sample_windows_random``, read from the files that hold them only."""
    plan = snapshots.plan_windows(spark, token_blocks(spark, sf), BATCH, WINDOW, "random", SEED)
    return _window_rows(snapshots.read_windows(spark, plan, WINDOW), "sample_id")


@query
def token_block_manifest(spark, sf):
    """Blocks of the last snapshot, as its readers see them."""
    made = token_blocks(spark, sf)
    rows = snapshots.read_snapshot(spark, made.path)
    return rows.select("block_id", F.size("tokens").alias("n_tokens"), F.md5(comma("tokens")).alias("md5"))


def _n_tokens(spark, sf) -> int:
    return stream(spark, sf).agg(F.sum(F.size("tokens"))).first()[0]


@query
def window_start_histogram(spark, sf):
    total = _n_tokens(spark, sf)
    starts = ds.sample_starts(spark, total, HISTOGRAM_DRAWS, WINDOW, "aligned", SEED)
    n_starts = -(-(total - WINDOW) // WINDOW)
    return ds.window_start_histogram(starts, n_starts).withColumn(
        "expected", F.round("expected", 6)
    )


@query
def epoch_plan(spark, sf):
    return ds.epoch_plan(stream(spark, sf), **PLAN).withColumn("epochs", F.round("epochs", 6))


@query
def lr_schedule(spark, sf):
    plan = ds.epoch_plan(stream(spark, sf), **PLAN)
    steps = plan.select("cycle_iters", F.explode(F.sequence(F.lit(0), F.col("max_iters"))).alias("it"))
    rate = opt.cosine_rate(F.col("it"), *RATES, WARMUP, F.col("cycle_iters"))
    return steps.select("it", F.round(rate, 9).alias("lr"))


# Logits and next-token tables.


def _vectors(spark, sf):
    return spread(table(spark, sf, "embeddings"), "vec_id")


def _by_dim(df: DataFrame, column: Column, out: str) -> DataFrame:
    return df.select("vec_id", F.posexplode(column).alias("dim", out)).withColumn(
        out, F.round(out, 6)
    )


@query
def softmax_temperature(spark, sf):
    return _by_dim(_vectors(spark, sf), ar.softmax(F.col("embedding"), 0.5), "prob")


def _long_logits(spark, sf):
    return _vectors(spark, sf).select(
        F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("token_id", "logit")
    ).withColumn("logit", F.col("logit").cast("double"))


@query
def softmax_long(spark, sf):
    return sc.softmax_long(_long_logits(spark, sf), 0.5).select(
        F.col("row_id").alias("vec_id"), F.col("token_id").alias("dim"), F.round("prob", 6).alias("prob")
    )


def _loss_rows(df: DataFrame, *keys: str) -> DataFrame:
    others = [name for name in df.columns if name not in {*keys, "loss", "perplexity"}]
    return df.select(
        *keys, *others, F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity")
    )


@query
def cross_entropy(spark, sf):
    return _loss_rows(sc.cross_entropy(_vectors(spark, sf), "embedding", "label", ["label"]), "label")


@query
def cross_entropy_long(spark, sf):
    targets = _vectors(spark, sf).select(F.col("vec_id").alias("row_id"), F.col("label").alias("target"))
    return _loss_rows(sc.cross_entropy_long(_long_logits(spark, sf), targets))


@query
def rms_normalize(spark, sf):
    return _by_dim(_vectors(spark, sf), ar.rms_normalize(F.col("embedding")), "x")


@query
def soft_knn(spark, sf):
    votes = md.soft_knn(materialize(_vectors(spark, sf)), KNN_LENGTH)
    return votes.withColumn("weight", F.round("weight", 6))


@query
def soft_knn_long(spark, sf):
    # Blocks of 10,000 rows, by tiles.
    votes = at.soft_knn_blocks(materialize(_vectors(spark, sf)), LONG_KNN)
    return votes.withColumn("weight", F.round("weight", 6))


@query
def ngram_model(spark, sf):
    return next_token_table(spark, sf).withColumn("prob", F.round("prob", 9))


def _scores(spark, sf):
    split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
    docs = stream(spark, sf).withColumn("split", split)
    return sc.score_documents(
        docs, next_token_table(spark, sf), VOCAB_SIZE, keep=("doc_id", "split")
    )


@query
def score_documents(spark, sf):
    return _loss_rows(_scores(spark, sf), "doc_id", "split")


def backoff_model(spark: SparkSession, sf: str) -> bo.BackoffModel:
    """Kneser-Ney tables over the training documents, contexts of two tokens."""

    def build() -> bo.BackoffModel:
        split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
        train = ds.delimited(encoded(spark, sf), END_ID).where(split == "train")
        return bo.kneser_ney(bo.ngram_counts(train, ORDER), ORDER, VOCAB_SIZE)

    return shared("backoff", spark, sf, build)


@query
def kneser_ney_table(spark, sf):
    return backoff_model(spark, sf).grams[ORDER].withColumn("prob", F.round("prob", 9))


@query
def kneser_ney_contexts(spark, sf):
    shares = backoff_model(spark, sf).shares[ORDER]
    return shares.withColumn("share", F.round("share", 9))


@query
def kneser_ney_losses(spark, sf):
    """Loss of every document, each token predicted from its longest known context."""
    split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED).alias("split")
    docs = ds.delimited(encoded(spark, sf), END_ID).select("doc_id", split, "tokens")
    scores = bo.score_backoff(docs, backoff_model(spark, sf), ["doc_id", "split"])
    return _loss_rows(scores, "doc_id", "split")


@query
def split_losses(spark, sf):
    return _loss_rows(sc.eval_losses(_scores(spark, sf)), "split")


@query
def sampled_losses(spark, sf):
    split = sc.split_by_draw(F.col("doc_id"), VALID_SHARE, SEED)
    docs = ds.delimited(encoded(spark, sf), END_ID).withColumn("split", split)
    parts = []
    for name in ("train", "valid"):
        tokens = materialize(ds.token_stream(docs.where(F.col("split") == name)))
        drawn = ds.sample_windows(tokens, BATCH, WINDOW, "aligned", SEED)
        parts.append(drawn.withColumn("split", F.lit(name)))
    losses = sc.window_losses(parts[0].union(parts[1]), next_token_table(spark, sf), VOCAB_SIZE)
    return _loss_rows(losses, "split")


def _probs(spark, sf):
    return gen.next_token_probs(next_token_table(spark, sf), TEMPERATURE)


@query
def next_token_probs(spark, sf):
    return _probs(spark, sf).withColumn("prob", F.round("prob", 9))


@query
def nucleus_table(spark, sf):
    return gen.nucleus_filter(_probs(spark, sf), NUCLEUS).select(
        "prev", "next", "rank", F.round("prob", 6).alias("prob"), F.round("upper", 6).alias("upper")
    )


def _prompts(spark, sf):
    turns = table(spark, sf, "conversations").where("role = 'user'")
    named = turns.select(F.concat_ws(":", "conv_id", "turn").alias("prompt_id"), "text")
    return cd.encode_corpus(spread(named, "prompt_id"), codec(spark, sf), keep=("prompt_id",))


@query
def prepare_prompts(spark, sf):
    return gen.prepare_prompts(_prompts(spark, sf), PROMPT_LENGTH, END_ID).select(
        "prompt_id", "truncated", comma("model_input").alias("model_input")
    )


@query
def generate(spark, sf):
    nucleus = gen.nucleus_filter(_probs(spark, sf), NUCLEUS)
    choices = materialize(gen.draw_table(nucleus, sc.contexts(next_token_table(spark, sf))))
    done = gen.generate(_prompts(spark, sf), choices, END_ID, NEW_TOKENS, SEED)
    return done.select(
        "prompt_id", F.size("generated").alias("n_new"), comma("generated").alias("generated")
    )


@query
def generate_from_contexts(spark, sf):
    """Continuations drawn from contexts of two tokens, shorter ones where they are unknown."""
    done = bo.generate_backoff(_prompts(spark, sf), backoff_model(spark, sf), END_ID, FEW_TOKENS, SEED)
    return done.select(
        "prompt_id", F.size("generated").alias("n_new"), comma("generated").alias("generated")
    )


@query
def generate_shuffled(spark, sf):
    # The same by the shuffled join; finished prompts and frequent contexts are spread.
    nucleus = gen.nucleus_filter(_probs(spark, sf), NUCLEUS)
    choices = materialize(gen.draw_table(nucleus, sc.contexts(next_token_table(spark, sf))))
    prompts = materialize(_prompts(spark, sf))
    done = gen.generate(
        prompts, choices, END_ID, NEW_TOKENS, SEED, checkpoint_every=1, small=False
    )
    return done.select(
        "prompt_id", F.size("generated").alias("n_new"), comma("generated").alias("generated")
    )


# Table models.


def _first_gradient(spark, sf):
    matrix = [[0.0] * 64 for _ in range(10)]
    return md.classifier_gradient(_vectors(spark, sf), matrix, "embedding", "label")


@query
def grad_norm(spark, sf):
    return md.grad_norm(_first_gradient(spark, sf)).select(F.round("grad_norm", 9).alias("grad_norm"))


@query
def classifier_step(spark, sf):
    gradients = md.clip_gradients(_first_gradient(spark, sf), MAX_NORM)
    done = md.apply_adamw(md.initial_parameters(spark, 10, 64), gradients, RATES[0], 1)
    return done.select(
        "class",
        "dim",
        F.round("value", 8).alias("value"),
        F.round("m", 8).alias("m"),
    )


@query
def sgd_step(spark, sf):
    gradients = md.clip_gradients(_first_gradient(spark, sf), MAX_NORM)
    done = md.apply_sgd(md.initial_parameters(spark, 10, 64), gradients, 0.5, 3)
    return done.select("class", "dim", F.round("value", 8).alias("value"))


@query
def classifier_scores(spark, sf):
    rows = materialize(_vectors(spark, sf))
    learned = md.train_classifier(
        rows, 10, steps=3, features="embedding", rates=(0.05, 0.01), max_norm=MAX_NORM
    )
    return md.classify(rows, learned, "embedding", ("vec_id", "label")).withColumn(
        "prob", F.round("prob", 4)
    )


@query
def classifier_resumed(spark, sf):
    rows = materialize(_vectors(spark, sf))
    path = scratch_path(spark, "state")
    learn = {"features": "embedding", "rates": (0.05, 0.01), "max_norm": MAX_NORM, "cycle": 3}

    def save(step, parameters, _):
        artifacts.save_state(parameters, path, step, {"classes": 10})

    md.train_classifier(rows, 10, steps=2, on_step=save, **learn)
    saved, step, config = artifacts.load_state(spark, path)
    learned = md.train_classifier(
        rows, config["classes"], steps=3, start=saved, start_step=step + 1, **learn
    )
    return md.classify(rows, learned, "embedding", ("vec_id", "label")).withColumn(
        "prob", F.round("prob", 4)
    )


@query
def training_metrics(spark, sf):
    path = scratch_path(spark, "metrics")

    def log(step, _, values):
        artifacts.write_metrics(spark, path, "embeddings", step, values)

    md.train_classifier(
        materialize(_vectors(spark, sf)),
        10,
        steps=3,
        features="embedding",
        rates=(0.05, 0.01),
        max_norm=MAX_NORM,
        on_step=log,
    )
    return artifacts.read_metrics(spark, path).select(
        "iteration", "metric", F.round("value", 6).alias("value")
    )


@query
def training_losses(spark, sf):
    # Seeded batches; losses of both splits every few steps.
    path = scratch_path(spark, "metrics")
    split = sc.split_by_draw(F.col("vec_id"), VALID_SHARE, SEED)
    rows = materialize(_vectors(spark, sf).withColumn("split", split))
    parts = {name: rows.where(F.col("split") == name) for name in ("train", "valid")}

    def log(step, _, values):
        artifacts.write_metrics(spark, path, "batches", step, values)

    md.train_classifier(
        parts["train"],
        10,
        steps=BATCH_STEPS,
        features="embedding",
        rates=(0.05, 0.01),
        max_norm=MAX_NORM,
        on_step=log,
        batch_share=BATCH_SHARE,
        key="vec_id",
        seed=SEED,
        evaluate=parts,
        evaluate_every=EVALUATE_EVERY,
    )
    return artifacts.read_metrics(spark, path).where("metric = 'loss'").select(
        "iteration", "split", F.round("value", 5).alias("loss")
    )


@query
def quality_classifier(spark, sf):
    # Learned from the labelled documents, predicted for all.
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    every = documents(spark, sf).join(labels, "doc_id", "left")
    rows = materialize(md.hashed_features(every, FEATURES, keep=("doc_id", "quality")))
    learned = md.train_classifier(
        rows.where("quality is not null"), 2, steps=3, label="quality", rates=(0.05, 0.01), max_norm=MAX_NORM
    )
    return md.classify(rows, learned, keep=("doc_id", "quality")).withColumn(
        "prob", F.round("prob", 4)
    )


@query
def classifier_loss(spark, sf):
    rows = materialize(_vectors(spark, sf))
    learned = md.train_classifier(
        rows, 10, steps=3, features="embedding", rates=(0.05, 0.01), max_norm=MAX_NORM
    )
    return _loss_rows(md.classifier_losses(rows, learned, ["label"], "embedding"), "label")


def _sparse_quality(spark, sf):
    """(entries of all documents, weights learned from the labelled ones)."""

    def build():
        labels = table(spark, sf, "labels").select("doc_id", "quality")
        every = documents(spark, sf).join(labels, "doc_id", "left")
        entries = sm.with_frequencies(
            sm.hashed_entries(every, SPARSE_BUCKETS, keep=("doc_id", "quality"))
        )
        learned = sm.train_sparse_classifier(
            entries.where("quality is not null"),
            2,
            SPARSE_STEPS,
            label="quality",
            rates=(0.05, 0.01),
            max_norm=MAX_NORM,
        )
        return entries, materialize(learned)

    return shared("sparse quality", spark, sf, build)


@query
def quality_classifier_sparse(spark, sf):
    # 2^20 hash buckets, 100 steps; predicted for all documents.
    entries, learned = _sparse_quality(spark, sf)
    found = sm.classify_entries(entries, learned, 2, keep=("quality",))
    return found.withColumn("prob", F.round("prob", 4))


@query
def quality_loss_sparse(spark, sf):
    entries, learned = _sparse_quality(spark, sf)
    labelled = entries.where("quality is not null")
    return _loss_rows(sm.sparse_losses(labelled, learned, 2, ["quality"], label="quality"), "quality")


# Streams.


def _document_stream(spark, sf):
    return jobs.read_text_stream(spark, f"{sf}/documents*.parquet")


@query
def stream_encode(spark, sf):
    out = scratch_path(spark, "stream")
    jobs.stream_encode(
        _document_stream(spark, sf), codec(spark, sf), out, scratch_path(spark, "progress")
    ).awaitTermination()
    return _encoded_rows(spark.read.parquet(out), "doc_id")


def _arrivals(spark, sf, source: str) -> tuple[Callable[[int], None], int]:
    """What writes the documents of a remainder by six as an arrival, and the files of each."""
    docs = documents(spark, sf)
    remainder = F.pmod("doc_id", F.lit(6))
    n = {r: count for r, count in docs.groupBy(remainder).count().collect() if r is not None}
    files = max(1, -(-max(n.values(), default=0) // ARRIVING_ROWS))

    def arrive(r: int) -> None:
        jobs.write_arrival(docs.where(remainder == r), source, files)

    return arrive, files


@query
def stream_encode_batches(spark, sf):
    # Four arrivals, one a batch, and a second run that finds two more.
    source, out, progress = (scratch_path(spark, name) for name in ("files", "stream", "progress"))
    arrive, files = _arrivals(spark, sf, source)
    for remainders in ((0, 1, 2, 3), (4, 5)):
        for r in remainders:
            arrive(r)
        arriving = jobs.read_text_stream(spark, source, files_per_batch=files)
        jobs.stream_encode(arriving, codec(spark, sf), out, progress).awaitTermination()
    return _encoded_rows(spark.read.parquet(out), "doc_id")


@query
def stream_offsets(spark, sf):
    # Places of pretokens in one stream, over six arrivals, one a batch, and a restart.
    source, out, totals, progress = (
        scratch_path(spark, name) for name in ("files", "offsets", "totals", "progress")
    )
    arrive, files = _arrivals(spark, sf, source)
    for remainders in ((0, 1, 2, 3), (4, 5)):
        for r in remainders:
            arrive(r)
        arriving = jobs.read_text_stream(spark, source, files_per_batch=files)
        size = F.size(F.coalesce(tx.pretokens(F.col("text")), F.array()))
        jobs.stream_offsets(arriving, out, totals, progress, size).awaitTermination()
    placed = spark.read.parquet(out)
    return placed.select("doc_id", F.col("batch_id").cast("int").alias("batch_id"), "offset", "size")


@query
def stream_counts(spark, sf):
    out = scratch_path(spark, "stream")
    jobs.stream_pretoken_counts(
        _document_stream(spark, sf), out, scratch_path(spark, "progress")
    ).awaitTermination()
    return jobs.latest_counts(spark, out, "pretoken", "freq")


@query
def stream_token_counts(spark, sf):
    # The stream reads an encoded dataset that was written to the shared folder.
    source, out = scratch_path(spark, "encoded"), scratch_path(spark, "stream")
    encoded(spark, sf).select("doc_id", "tokens").write.parquet(source)
    arriving = jobs.read_text_stream(spark, source, "doc_id long, tokens array<int>", 4)
    jobs.stream_token_counts(arriving, out, scratch_path(spark, "progress")).awaitTermination()
    return jobs.latest_counts(spark, out, "token_id", "n")
